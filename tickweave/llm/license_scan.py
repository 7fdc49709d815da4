"""Licence notices in texts: a trained paragraph classifier, confirmed by templates.

Lines are joined to paragraphs, which end at a line without words or at the end of a block
comment; long ones are cut into overlapping windows of words. A logistic regression over
hashed word one- and two-grams tells windows of notices from others, a second one, multinomial,
their families. Both are trained here: on the templates, whole, in pieces and with words left
out, and on a bounded sample of the corpus' own paragraphs, labelled by the templates. The
temperature and the least probability of a notice are calibrated on held-out paragraphs.

Windows that look like notices are joined to regions. In a region, a stretch of words is a
family's notice if the classifier deems the family possible and a template confirms it: enough of
its word pairs are there, its version follows the same word, its name and its marks
("lesser", "nc", ...) agree. Conditions and disclaimers that follow a notice belong to it. What
surely is a notice but is no family's, is ``unknown``.

Scoring is one pass over whole texts without a shuffle; the models are of fixed size.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, in_chunks, mix, ragged, run_hashes, texts_of, word_bounds

NONE, UNKNOWN = "none", "unknown"
#: Conditions and disclaimers that many licences share: no notice by themselves, part of one that stands before.
TERMS = "terms"

#: Names and versions of licences that are commonly named in one sentence.
_NAMED = {
    "MIT": ("MIT License", ""), "MIT-0": ("MIT No Attribution License", ""), "Apache-1.1": ("Apache License", "1.1"), "Apache-2.0": ("Apache License", "2.0"),
    "GPL-2.0": ("GNU General Public License", "2"), "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"), "LGPL-3.0": ("GNU Lesser General Public License", "3"), "AGPL-3.0": ("GNU Affero General Public License", "3"),
    "BSD-2-Clause": ("BSD 2-Clause License", ""), "BSD-3-Clause": ("BSD 3-Clause License", ""), "0BSD": ("BSD Zero Clause License", ""), "ISC": ("ISC License", ""),
    "MPL-1.1": ("Mozilla Public License", "1.1"), "MPL-2.0": ("Mozilla Public License", "2.0"), "EPL-1.0": ("Eclipse Public License", "1.0"), "EPL-2.0": ("Eclipse Public License", "2.0"),
    "CDDL-1.0": ("Common Development and Distribution License", "1.0"), "BSL-1.0": ("Boost Software License", "1.0"), "Zlib": ("zlib License", ""),
    "Unlicense": ("Unlicense", ""), "WTFPL": ("WTFPL", ""), "Artistic-2.0": ("Artistic License", "2.0"), "CC0-1.0": ("CC0", "1.0"), "OFL-1.1": ("SIL Open Font License", "1.1"),
}
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; version {version} of the License.",
)
_LONG = {
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",),
    "BSD-2-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License.",),
    "EPL-1.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "CDDL-1.0": ("The contents of this file are subject to the terms of the Common Development and Distribution License, Version 1.0 only (the License). You may not use this file except in compliance with the License.",),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "WTFPL": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.",),
    TERMS: (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the License for more details.",
        "You should have received a copy of the License along with this program. If not, see https://www.gnu.org/licenses/.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    UNKNOWN: (
        "Licensed under the terms of the vendor software license agreement.",
        "This work is distributed under the terms of its own public license; see the file COPYING for details.",
        "This software is licensed under the company source license, version 4. You may not use this file except in compliance with it.",
        "Use of this source code is governed by a license that can be found in the LICENSE file.",
        "Released under a custom community license, see LICENSE for the full license information.",
    ),
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: Words that make another licence of one: a notice has those of its template and no others.
_MARKS = frozenset("lesser affero sa nc nd sharealike noncommercial noderivatives zero no".split())
#: A notice of the first kind with a condition of the second is one of the second.
_EXTENDED = {("BSD-2-Clause", "BSD-3-Clause"): "BSD-3-Clause"}


def _templates() -> dict[str, tuple[str, ...]]:
    out: dict[str, list[str]] = defaultdict(list)
    for family, (name, version) in _NAMED.items():
        for named in ([f"{name}, version {version}", f"{name} {version}"] if version else [name]):
            out[family] += [f"Licensed under the {named}.", f"Released under the {named}.", f"This work is licensed under the {named}."]
        if "GNU" in name:
            for text in _GNU:
                out[family].append(text.format(what="library" if "Lesser" in name else "program", name=name, version=version))
        out[family].append(f"SPDX-License-Identifier: {family}")
    for version in ("3.0", "4.0"):
        for short, words in _CC.items():
            out[f"CC-{short}-{version}"] += [f"Licensed under CC {short} {version}.", f"This work is licensed under a Creative Commons {words} {version} International License.", f"SPDX-License-Identifier: CC-{short}-{version}"]
    for family, texts in _LONG.items():
        out[family] += texts
    return {family: tuple(texts) for family, texts in out.items()}


TEMPLATES = _templates()

_WORD = re.compile(rb"[a-z0-9]+")
_VERSION = re.compile(rb"v([0-9]+)$")


def tokens_of(raw: bytes) -> tuple[list[bytes], list[int], list[int]]:
    """Words of small letters and digits with their places; ``v2`` reads as ``version 2``, a bare ``v`` as ``version``."""
    words, starts, ends = [], [], []
    for m in _WORD.finditer(raw.lower()):
        w = m[0]
        v = _VERSION.match(w)
        if v or w == b"v":
            words.append(b"version")
            starts.append(m.start())
            ends.append(m.end())
            w = v[1] if v else b""
        if w:
            words.append(b"license" if w == b"licence" else w)
            starts.append(m.start())
            ends.append(m.end())
    return words, starts, ends


@dataclass
class Template:
    family: str
    words: list[bytes]
    pairs: set[tuple[bytes, bytes]] = field(default_factory=set)
    needed: set[tuple[bytes, bytes]] = field(default_factory=set)  # a version after its word
    names: set[bytes] = field(default_factory=set)
    marks: set[bytes] = field(default_factory=set)


def _read_templates() -> list[Template]:
    out = [Template(f, tokens_of(text.encode())[0]) for f, texts in TEMPLATES.items() if f != UNKNOWN for text in texts]
    marks = {m.encode() for m in _MARKS}
    brief = [t for t in out if len(t.words) <= 16]
    families = defaultdict(set)
    for t in brief:
        for w in t.words:
            families[w].add(t.family)
    for t in out:
        t.pairs = set(zip(t.words[:-1], t.words[1:], strict=True))
        t.needed = {(a, b) for a, b in t.pairs if b.isdigit()}
        t.marks = marks & set(t.words)
        if len(t.words) <= 16:
            t.names = {w for w in t.words if len(families[w]) <= 6 and not w.isdigit()}
    return out


_READ = _read_templates()
_BY_PAIR: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
for _i, _t in enumerate(_READ):
    for _p in _t.pairs:
        _BY_PAIR[_p].append(_i)
_ALL_MARKS = frozenset(m.encode() for m in _MARKS)


def _stretches(hits: list[int], pairs: list[tuple[bytes, bytes]], need: float, reach: int) -> Iterator[tuple[int, int, int]]:
    """(distinct pairs, first, last) of stretches of at most ``reach`` words, each the fullest of its surroundings."""
    counts: Counter = Counter()
    low, best, i = 0, None, 0
    while i < len(hits):
        h = hits[i]
        if best and h - best[1] >= reach:
            yield best
            counts.clear()  # the next stretch begins behind this one
            low = i = bisect_left(hits, best[2] + 1)
            best = None
            continue
        counts[pairs[h]] += 1
        while h - hits[low] >= reach or (low < i and counts[pairs[hits[low]]] > 1):
            gone = pairs[hits[low]]
            counts[gone] -= 1
            if not counts[gone]:
                del counts[gone]
            low += 1
        if len(counts) >= need and (best is None or len(counts) > best[0]):
            best = (len(counts), hits[low], h)
        i += 1
    if best:
        yield best


def confirmed(words: list[bytes], confirm: float = 0.6, possible: set[str] | None = None) -> list[tuple[int, int, str, float]]:
    """(first word, last word, family, similarity) of notices that templates confirm, in order, without overlaps.

    Similarity is the share of the template's word pairs. Of overlapping notices the one with the most
    pairs in common stands. ``possible`` limits the families (``TERMS`` always counts).
    """
    pairs = list(zip(words[:-1], words[1:], strict=True))
    hits: dict[int, list[int]] = defaultdict(list)
    for k, pair in enumerate(pairs):
        for i in _BY_PAIR.get(pair, ()):
            hits[i].append(k)
    found = []
    for i, at in hits.items():
        t = _READ[i]
        need = confirm * len(t.pairs)
        if len(at) < need or (possible is not None and t.family != TERMS and t.family not in possible):
            continue
        for n, first, last in _stretches(at, pairs, need, len(t.words) * 3 // 2 + 2):
            inside = words[first : last + 2]
            if t.needed <= {pairs[k] for k in range(first, last + 1)} and t.names <= set(inside) and _ALL_MARKS & set(inside) == t.marks:
                found.append((-n, -n / len(t.pairs), first, last + 1, t.family))
    taken: list[tuple[int, int, str, float]] = []
    for _, share, first, last, family in sorted(found):
        at = bisect_left(taken, (first,))
        if (at == len(taken) or taken[at][0] > last) and (at == 0 or taken[at - 1][1] < first):
            taken.insert(at, (first, last, family, -share))
    return taken


def joined(notices: list[list], gap: int = 12) -> list[list]:
    """Notices (first, last, family, probability, similarity) whose parts stand within ``gap`` words, as one each."""
    out: list[list] = []
    for n in notices:
        if out and n[0] - out[-1][1] <= gap + 1:
            a, b = out[-1][2], n[2]
            family = a if a == b or b == TERMS else _EXTENDED.get((a, b))
            if family:
                out[-1][1:] = [n[1], family, max(out[-1][3], n[3]), max(out[-1][4], n[4])]
                continue
        out.append(list(n))
    return out


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32


@dataclass
class Linear:
    """Logistic regression over hashed features; a row for the intercept behind."""

    weights: np.ndarray
    temperature: float = 1.0

    def probabilities(self, rows: np.ndarray, features: np.ndarray, count: int) -> np.ndarray:
        logits = np.zeros((count, self.weights.shape[1]))
        for k in range(self.weights.shape[1]):
            logits[:, k] = np.bincount(rows, self.weights[features, k], minlength=count)
        logits = (logits + self.weights[-1]) / self.temperature
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def margin(self, rows: np.ndarray, features: np.ndarray, count: int) -> np.ndarray:
        """The probability of the second of two classes."""
        w = self.weights[:, 1] - self.weights[:, 0]
        x = (np.bincount(rows, w[features], minlength=count) + w[-1]) / self.temperature
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    families: list[str]
    gate: Linear  # none, notice
    kinds: Linear  # families
    least: float = 0.5  # from here on a notice of no family is unknown
    flag: float = 0.5  # from here on templates are asked
    window: int = 30

    @property
    def features(self) -> int:
        return len(self.gate.weights) - 1


@dataclass
class Paragraphs:
    """Windows of words: text of each, its place in bytes, its first word, number of words and paragraph."""

    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    count: np.ndarray
    words: np.ndarray
    begin: np.ndarray  # of each word, in bytes
    finish: np.ndarray
    paragraph: np.ndarray
    per_text: np.ndarray  # paragraphs of each text


def paragraphs(texts: Texts, window: int) -> Paragraphs:
    plain = Texts(_PLAIN[texts.data], texts.bounds)
    starts, ends, first = word_bounds(plain)
    words = run_hashes(plain.data, starts, ends)
    line = np.cumsum(texts.data == 10, dtype=np.int32)  # line feeds up to each byte
    closed = np.zeros(len(texts.data), np.int32)
    closed[1:] = (texts.data[:-1] == 42) & (texts.data[1:] == 47)
    closed = np.cumsum(closed, dtype=np.int32)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    new = np.ones(len(starts), bool)
    new[1:] = (line[starts[1:]] - line[starts[:-1]] > 1) | (closed[starts[1:]] != closed[starts[:-1]]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(starts)))
    half = window // 2
    parts = np.maximum(1, -(-(size - window) // half) + 1)
    at = np.repeat(begin, parts) + half * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.minimum(window, np.repeat(begin + size, parts) - at)
    per_text = np.bincount(owner[begin], minlength=len(texts))
    return Paragraphs(owner[at], starts[at], ends[at + count - 1], at, count, words, starts, ends, np.repeat(np.arange(len(begin)), parts), per_text)


def features_of(p: Paragraphs, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, feature) of all words and pairs of words, each once: a word said thirty times tells no more than said once."""
    one = ragged(p.first, p.count)
    row = np.repeat(np.arange(len(p.first)), p.count)
    two = ragged(p.first, p.count - 1)
    pair = mix(p.words[two] * np.uint64(0x9E3779B97F4A7C15) + p.words[np.minimum(two + 1, max(len(p.words) - 1, 0))]) if len(two) else p.words[:0]
    h = np.concatenate([p.words[one], pair])
    row = np.concatenate([row, np.repeat(np.arange(len(p.first)), p.count - 1)])
    key = np.sort(row * size + (h % np.uint64(size)).astype(np.int64))
    key = key[np.flatnonzero(np.diff(key, prepend=-1))]
    return key // size, key % size


def fit(p: Paragraphs, y: np.ndarray, classes: int, features: int, rounds: int = 80, decay: float = 1e-4) -> Linear:
    """Logistic regression by full-batch AdaGrad; classes weigh alike in sum."""
    row, feature = features_of(p, features)
    share = 1 / np.maximum(np.bincount(y, minlength=classes), 1)[y]
    share = (share / share.sum()).astype(np.float32)[:, None]
    used, feature = np.unique(feature, return_inverse=True)  # others keep the weight 0
    by_row, by_feature = np.argsort(row, kind="stable"), np.argsort(feature, kind="stable")
    of_row, row_at = feature[by_row], np.flatnonzero(np.diff(row[by_row], prepend=-1))
    of_feature, feature_at = row[by_feature], np.flatnonzero(np.diff(feature[by_feature], prepend=-1))
    w = np.zeros((len(used) + 1, classes), np.float32)
    square = np.full_like(w, 1e-8)
    goal = np.eye(classes, dtype=np.float32)[y]
    for _ in range(rounds):
        logits = np.add.reduceat(w[of_row], row_at, axis=0) + w[-1]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        gap = (e / e.sum(axis=1, keepdims=True) - goal) * share
        grad = decay * w
        grad[:-1] += np.add.reduceat(gap[of_feature], feature_at, axis=0)
        grad[-1] += gap.sum(axis=0)
        square += grad**2
        w -= 0.5 * grad / np.sqrt(square)
    whole = np.zeros((features + 1, classes), np.float32)
    whole[used], whole[-1] = w[:-1], w[-1]
    return Linear(whole)


#: Paragraphs that speak like notices without being confirmed are no examples of either kind.
_DOUBTFUL = re.compile(r"(?i)(licen[sc]ed|released|distributed|available|governed)\s+(\w+\s+)?(under|by)|terms of|public licen[sc]e|permission (is|to)|creative commons|spdx|copyright|warrant|redistribut")


def label_of(text: str) -> str:
    """The family that templates find in a text, ``NONE``, or nothing where that is not sure."""
    found = {f for _, _, f, _ in confirmed(tokens_of(text.encode())[0])}
    if len(found) == 1:
        return found.pop()
    return "" if found or _DOUBTFUL.search(text) else NONE


def sample_lines(docs: DataFrame, text_col: str, most: int) -> DataFrame:
    """At most ``most`` distinct paragraphs ``line`` of 10 to 2,000 characters, the first by a hash of their text.

    Half of them, at most, hold a word that notices use. Distinct paragraphs are estimated by
    their hashes; only those near the bound are shuffled, copies combined before.
    """
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where("length(line) between 10 and 2000")
    lines = lines.withColumn("like", F.col("line").rlike("(?i)licen|creative commons|redistribution|permission |warrant|public domain|spdx"))
    lines = lines.withColumn("u", F.pmod(F.xxhash64("line"), F.lit(1 << 40)) / float(1 << 40))
    about = lambda x: F.approx_count_distinct(F.when(x, F.col("u")))
    counts = lines.agg(about(F.col("like")).alias("like"), about(~F.col("like")).alias("other")).first()
    half = most // 2
    near = {name: 1.5 * half / max(counts[name], 1) for name in ("like", "other")}  # room for the estimates' error
    picked = lines.where(F.when(F.col("like"), F.col("u") < near["like"]).otherwise(F.col("u") < near["other"])).distinct()
    part = lambda x: picked.where(x).orderBy("u", "line").limit(half).select("line")
    return part(F.col("like")).unionByName(part(~F.col("like")))


def train(docs: DataFrame, text_col: str = "text", sample_paragraphs: int = 8000, features: int = 1 << 16, window: int = 30, seed: int = 3) -> Model:
    """A model from templates and at most ``sample_paragraphs`` different lines of ``docs``.

    Which those are says ``sample_lines``. Without any line the prose is a single made-up one.
    """
    own = sorted(r.line for r in sample_lines(docs, text_col, sample_paragraphs).collect())
    rng = np.random.default_rng(seed)
    sampled = [(line, label_of(line)) for line in own]
    prose = [w for line, label in sampled[:2000] if label == NONE for w in line.split()[:40]]
    texts, labels = [], []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            words = notice.split()
            for k in range(12 if len(words) <= window else 24):
                kept = [w for w in words if k < 2 or len(words) < 10 or rng.random() > 0.08]
                if k > 1 and len(kept) > window:  # a window of a long notice
                    cut = rng.integers(0, len(kept) - window // 2)
                    kept = kept[cut : cut + window]
                if k % 2 and prose:  # as it stands in a window with other words
                    around = rng.choice(prose, max(0, window - len(kept)))
                    cut = rng.integers(0, len(around) + 1)
                    kept = [*around[:cut], *kept, *around[cut:]]
                texts.append(" ".join(kept))
                labels.append(family)
    for line, label in sampled:
        if label == NONE or (label and len(line.split()) <= window):  # a window of a longer one may lack the notice
            texts.append(line)
            labels.append(label)
    if NONE not in labels:
        texts.append("ordinary words")
        labels.append(NONE)
    families = list(TEMPLATES)
    held = rng.random(len(texts)) < 0.2
    part = lambda pick: paragraphs(texts_of(pa.array([" ".join(t.split()) for t, h in zip(texts, pick, strict=True) if h])), window)
    of = lambda pick, p: np.array([x for x, h in zip(labels, pick, strict=True) if h])[p.owner]
    learn, test = part(~held), part(held)
    seen, asked = of(~held, learn), of(held, test)
    model = Model(families, fit(learn, (seen != NONE).astype(int), 2, features), None, window=window)
    notices = np.array([x != NONE for x in labels])
    learn_kinds, test_kinds = part(~held & notices), part(held & notices)
    number = lambda names: np.array([families.index(x) for x in names], dtype=int)
    model.kinds = fit(learn_kinds, number(of(~held & notices, learn_kinds)), len(families), features)
    _calibrate(model.gate, test, (asked != NONE).astype(int), features)
    _calibrate(model.kinds, test_kinds, number(of(held & notices, test_kinds)), features)
    sure = model.gate.margin(*features_of(test, features), len(test.first))
    model.least = float(np.clip(sure[asked == NONE].max(initial=0.0) * 1.05, 0.5, 0.99))
    model.flag = float(np.clip(sure[asked != NONE].min(initial=0.5) / 2, 0.02, 0.5))
    return model


def _calibrate(model: Linear, p: Paragraphs, y: np.ndarray, features: int) -> None:
    """The temperature of the lowest loss on held-out paragraphs."""
    if not len(p.first):
        return
    row, feature = features_of(p, features)
    losses = {}
    for t in (0.25, 0.5, 1.0, 2.0, 4.0):
        model.temperature = t
        losses[t] = -np.log(model.probabilities(row, feature, len(y))[np.arange(len(y)), y] + 1e-12).mean()
    model.temperature = min(losses, key=losses.get)


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("similarity", T.DoubleType())]))


def _regions(p: Paragraphs, flagged: np.ndarray, margin: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first word, end word, flagged windows) of runs of windows of a text that touch once widened by ``margin`` words."""
    run: list[int] = []
    for i in flagged.tolist():
        if run and (p.owner[i] != p.owner[run[-1]] or p.first[i] > p.first[run[-1]] + p.count[run[-1]] + 2 * margin):
            yield _widened(p, run, margin)
            run = []
        run.append(i)
    if run:
        yield _widened(p, run, margin)


def _widened(p: Paragraphs, run: list[int], margin: int) -> tuple[int, int, np.ndarray]:
    low, high = np.searchsorted(p.owner, p.owner[run[0]]), np.searchsorted(p.owner, p.owner[run[0]], "right") - 1
    first, end = p.first[low], p.first[high] + p.count[high]  # the words of the text
    return max(first, p.first[run[0]] - margin), min(end, p.first[run[-1]] + p.count[run[-1]] + margin), np.array(run)


def _notices(p: Paragraphs, model: Model, texts: Texts, sure: np.ndarray, flagged: np.ndarray, confirm: float, possible: float) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    picked = Paragraphs(p.owner[flagged], p.start[flagged], p.end[flagged], p.first[flagged], p.count[flagged], p.words, p.begin, p.finish, p.paragraph[flagged], p.per_text)
    q = model.kinds.probabilities(*features_of(picked, model.features), len(flagged))
    place = {w: k for k, w in enumerate(flagged.tolist())}
    raw, chars = texts.data.tobytes(), np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    for first, end, run in _regions(p, flagged, model.window // 2):
        own = q[[place[w] for w in run.tolist()]]
        names = {model.families[k] for k in np.flatnonzero((own >= possible).any(axis=0))}
        base = int(p.begin[first])
        words, starts, ends = tokens_of(raw[base : int(p.finish[end - 1])])
        found = []
        for a, b, family, share in confirmed(words, confirm, names):
            near = (p.end[run] > base + starts[a]) & (p.start[run] < base + ends[b])
            chance = sure[run] * own[:, model.families.index(family)]
            found.append([a, b, family, float(chance[near].max() if near.any() else chance.max()), share])
        found = joined(found)
        alone = [n for n in found if n[2] != TERMS]
        spans = [(base + starts[a], base + ends[b], family, chance, share) for a, b, family, chance, share in alone]
        if not alone and sure[run].max() >= model.least:
            strong = run[sure[run] >= 0.5]
            spans = [(int(p.start[strong[0]]), int(p.end[strong].max()), UNKNOWN, float(sure[run].max()), max((n[4] for n in found), default=0.0))]
        owner = p.owner[run[0]]
        zero = chars[texts.bounds[owner]]
        for a, b, family, chance, share in spans:
            out[owner].append({"start": int(chars[a] - zero), "end": int(chars[b] - zero), "family": family, "probability": chance, "similarity": float(share)})
    return out


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", confirm: float = 0.6, possible: float = 0.001) -> DataFrame:
    """One row per row of ``docs``: id, ``n_paragraphs`` and ``notices`` (start, end, family, probability, similarity).

    Offsets count code points, ends are exclusive. A family is a candidate in a region where some
    window gives it the probability ``possible`` among notices. ``n_paragraphs`` counts paragraphs
    with words. Notices of a family within twelve words of each other are one. Null and empty
    texts have no paragraphs, an empty table no rows; repeated rows are scanned each, long
    lines in windows. Other columns, whatever their names, are not read.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in in_chunks(batches, "text"):
            p = paragraphs(texts, model.window)
            out: list[list[dict]] = [[] for _ in range(len(texts))]
            if len(p.first):
                sure = model.gate.margin(*features_of(p, model.features), len(p.first))
                flagged = np.flatnonzero(sure >= model.flag)
                if len(flagged):
                    out = _notices(p, model, texts, sure, flagged, confirm, possible)
            yield pa.RecordBatch.from_arrays([rows["id"].combine_chunks(), pa.array(p.per_text.astype(np.int64)), pa.array(out, kind)], names=["id", "n_paragraphs", "notices"])

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return source.mapInArrow(run, T.StructType([source.schema["id"], T.StructField("n_paragraphs", T.LongType()), T.StructField("notices", _SPAN)]))
