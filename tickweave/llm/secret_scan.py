"""Secrets in texts, judged by who else has them.

Patterns find candidates: the three base kinds, and tokens that merely look random. A random
looking token is noise in one text, but the corpus tells: the hash of every candidate value is
aggregated over the distinct repositories and owners that hold it. A value that many owners
have is a copied example (documentation, fixtures, test vectors); one that a single owner
has is likely live. So

* base spans always stay, each with the verdict on its value (``live`` or ``example``), and
* credential-like tokens become spans of kind ``owned`` where one owner has them. Such a token
  has a known key prefix, or is no URL, path, DOI, slug or identifier: see ``credential_like``.

Only hashes and positions are shuffled, never texts or values. A value that a third of all
documents hold is combined before the shuffle and meets its spans again by a join that
splits hot keys.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialise, split_by_ids

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "owned")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: What stands before a token that is part of a URL, a path, a DOI or an address, and what behind.
_LEAD = re.compile(r"www\.|doi:|10\.[0-9]{4,}/", re.I | re.A)
_HOST = re.compile(r"[A-Za-z0-9.-]*", re.A)
_FILE = re.compile(r"@|\.[A-Za-z][A-Za-z0-9]{1,4}(?![A-Za-z0-9])|\.[A-Za-z0-9-]+[/.]", re.A)
_EDGE = re.compile(r"[\s\"'`<>(){}\[\]|,;]")
#: Prefixes that issuers give their keys; an unbroken tail of 16 or more characters must follow.
_PREFIXED = re.compile(r"(?:gh[pousr]_|github_pat_|glpat-|[spr]k_(?:live|test)_|sk-(?:proj-|ant-[a-z0-9]+-)?|xox[abeoprs]-(?:[0-9]+-)*|AIza|ya29|npm_|pypi-|hf_|shp(?:at|ca|pa|ss)_|dop_v1_|eyJ)([A-Za-z0-9]{16,})")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_CHANGE = re.compile(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]|[0-9]+")
#: A whole run of key characters; ``credential_like`` decides on all of it.
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
_SPAN = "array<struct<kind:int,start:int,end:int,hash:string>>"


def entropy(text: str) -> float:
    """Bits per character of the text's own character distribution."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def _ordinary(piece: str) -> bool:
    """Whether a piece of one kind of characters reads like a word or a number."""
    if piece.isdigit():
        return len(piece) >= 4
    return len(piece) >= 3 and (any(c in "aeiouyAEIOUY" for c in piece) or len(piece) >= 6)


class Places:
    """Whether tokens of one text, asked for in order, stand inside a URL, path, DOI or address.

    What decides lies between the last separator and the token, however far that is; it is
    looked at once for all tokens behind the same separator.
    """

    def __init__(self, text: str):
        self.text, self.edges = text, _EDGE.finditer(text)
        self.following, self.edge = next(self.edges, None), 0
        self._look()

    def _look(self) -> None:
        stop = self.following.start() if self.following else len(self.text)
        lead, scheme = _LEAD.match(self.text, self.edge, stop), self.text.find("://", self.edge, stop)
        self.settled = min(lead.end() if lead else stop + 1, scheme + 3 if scheme >= 0 else stop + 1)
        self.host = _HOST.match(self.text, self.edge, stop).end()
        twice = self.text.find("..", self.edge, self.host)
        if twice >= 0:
            self.host = twice + 1

    def inside(self, start: int) -> bool:
        moved = False
        while self.following and self.following.end() <= start:
            self.edge, self.following, moved = self.following.end(), next(self.edges, None), True
        if moved:
            self._look()
        if start == self.edge:
            return False
        if self.settled <= start or self.text[start - 1] in "/\\~@#?&%":
            return True
        dot = self.text.rfind(".", self.edge, start) if start <= self.host else -1
        return dot > self.edge and (dot + 1 == start or self.text[dot + 1 : start].isalpha())


def credential_like(text: str, start: int, end: int, places: Places, least: float = 3.5) -> bool:
    """Whether the token ``text[start:end]`` looks like a key that somebody was given.

    A known prefix with a random tail always does. Other tokens must stand outside URLs, paths,
    DOIs, addresses and file names, hold eight characters without a separator, few separators, letters
    with digits or both cases of letters, an entropy of ``least`` bits a character, and
    either a change between letters and digits in every five characters, or (of one run) pieces
    of less than three characters, or less than three fifths
    of their characters in words and numbers as slugs and identifiers have them. UUIDs are none.
    """
    word = text[start:end]
    known = _PREFIXED.match(word)
    if known and entropy(known[1]) >= 3.0 and len({(c.isdigit(), c.isupper()) for c in known[1]}) > 1:
        return True
    parts = re.split(r"[+/_-]+", word)
    if max(map(len, parts)) < 8 or 8 * (len(parts) - 1) > len(word) or entropy(word) < least:
        return False
    if len({"d" if c.isdigit() else "u" if c.isupper() else "l" for c in "".join(parts)}) < 2:
        return False
    pieces = [x for part in parts for x in _PIECE.findall(part)]
    changes = len(_CHANGE.findall(word))
    if _UUID.fullmatch(word) or 5 * changes < len(word) and (len(parts) > 1 or 3 * len(pieces) <= len(word)) and 5 * sum(len(x) for x in pieces if _ordinary(x)) >= 3 * sum(map(len, parts)):
        return False
    return not (word[0] == "/" or places.inside(start) or _FILE.match(text, end))


def candidates(text: str, min_entropy: float = 3.0) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, value start, value end) of all candidates of a text, in order.

    Base kinds are leftmost and non-overlapping each for itself; a match that is too short is
    dropped after it has used up its text. Credential-like tokens neither overlap base spans nor
    have a low entropy.
    """
    out = [(0, m.start(), m.end(), *m.span(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    out += [(1, *m.span(), *m.span()) for m in _ACCESS.finditer(text)]
    out += [(2, *m.span(), *m.span()) for m in _HEX.finditer(text)]
    begins, reach, furthest = [], [], 0  # base spans by start, and how far those up to each reach
    for s, e in sorted((s, e) for _, s, e, _, _ in out):
        furthest = max(furthest, e)
        begins.append(s)
        reach.append(furthest)

    def covered(s: int, e: int) -> bool:
        before = bisect_left(begins, e)
        return before > 0 and reach[before - 1] > s

    places = Places(text)
    for m in _RANDOM.finditer(text):
        s, e = m.span()
        word = m.group()
        if entropy(word) >= min_entropy and credential_like(text, s, e, places) and not covered(s, e):
            out.append((3, s, e, s, e))
    out.sort(key=lambda x: (x[1], x[0]))
    return out


def _hash(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))
    for batch in batches:
        spans = []
        for text in batch.column("text").to_pylist():
            found = candidates(text or "")
            spans.append([{"kind": k, "start": s, "end": e, "hash": _hash(text[a:b])} for k, s, e, a, b in found])
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(spans, kind)], names=[*rest, "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository: str = "lang", example_owners: int = 3, example_repositories: int = 8) -> DataFrame:
    """One row per row of ``docs``: (id, spans), spans of (start, kind, end, live, owners, repositories, hash).

    Offsets count code points, ends are exclusive. An owner is a value of ``owner_col``, a
    repository a pair of that and ``repository``; null is an owner, too. A value is an
    example if ``example_owners`` or more owners, or ``example_repositories`` or more
    repositories hold it, else live; a token of kind ``owned`` needs exactly one owner. Null and empty
    texts have no spans. Rows that repeat an id are scanned each for itself.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"), F.col(repository).cast("string").alias("repo"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_scan, f"{_as(rows, 'id')}, owner string, repo string, spans {_SPAN}")
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()))
    with_spans = found.where(F.size("spans") > 0)
    each = with_spans.select("row", "owner", "repo", F.explode("spans").alias("s"))
    held = each.select("s.hash", "owner", "repo").distinct()
    held = held.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    judged = each.select("row", "s.*").join(held, "hash")
    live = (F.col("owners") < example_owners) & (F.col("repositories") < example_repositories)
    judged = judged.where((F.col("kind") < 3) | (F.col("owners") == 1))
    span = F.struct("start", "kind", "end", live.alias("live"), "owners", "repositories", "hash")
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("judged"))
    out = found.select("row", "id").join(spans, "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,owners:bigint,repositories:bigint,hash:string>>")
    return out.select("id", F.coalesce("judged", none).alias("spans"))


def _as(df: DataFrame, column: str) -> str:
    return f"{column} {df.schema[column].dataType.simpleString()}"


def rendered(spans, kinds=KINDS):
    """``kind:start:end`` of the spans of ``kinds``, by start and kind, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    some = F.filter(spans, lambda s: s["kind"] < len(kinds)) if len(kinds) < len(KINDS) else spans
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _redacted(batches: Iterator[pa.RecordBatch], column: str, values: str, mark: str, kinds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, live in zip(batch.column(column).to_pylist(), batch.column(values).to_pylist(), strict=True):
            if text is not None:
                live, out, at = set(live), [], 0
                for kind, _, _, a, b in sorted(candidates(text), key=lambda c: (c[3], -c[4])):
                    if kind in kinds and a >= at and _hash(text[a:b]) in live:
                        out += [text[at:a], mark]
                        at = b
                text = "".join([*out, text[at:]])
            texts.append(text)
        names = [n for n in batch.schema.names if n != values]
        columns = [pa.array(texts, batch.schema.field(n).type) if n == column else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names=names)


#: Kinds that are replaced: a bare run of hex digits is as often a commit, a digest or an order number.
REDACTED = (0, 1, 3)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", kinds: tuple[int, ...] = REDACTED, **options) -> DataFrame:
    """``docs`` with the live values of ``find_secrets`` replaced by ``mark``; examples and other ``kinds`` stay.

    All rows and columns are kept, a null text stays null. Only texts that may hold a live
    value are joined (by id) to the hashes of theirs and scanned again; a row with another row's id
    loses no more than values that are live there.
    """
    spans = find_secrets(docs, id_col, text_col, **options)
    key, values = free_name(docs, "key"), free_name(docs, "live")
    chosen = F.filter("spans", lambda s: s["live"] & s["kind"].isin(*kinds))
    live = spans.select(F.col("id").alias(key), F.explode(chosen).alias("s")).select(key, F.col("s.hash").alias("hash"))
    live = materialise(live.distinct().groupBy(key).agg(F.collect_list("hash").alias(values)))
    maybe, clean = split_by_ids(docs, live, id_col, key)
    maybe = maybe.join(live, maybe[id_col].eqNullSafe(live[key]), "left").drop(key)
    maybe = maybe.withColumn(values, F.coalesce(values, F.array().cast("array<string>")))
    return clean.unionByName(maybe.mapInArrow(lambda it: _redacted(it, text_col, values, mark, kinds), docs.schema))
