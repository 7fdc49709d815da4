"""Language identification by interpolated Kneser-Ney character models.

Every language gets a character model of order four over letters (lower-cased) and single
spaces. A text goes to the language with the lowest cross-entropy per character, unless it
has no letter or its cross-entropy lies above what texts of that language, held out from the
counts, ever show (calibrated rejection), with an allowance for short texts.

Counting runs on Spark over a bounded sample of labelled texts; what is collected is one
row per distinct character sequence of that sample and language. The model is a few sorted
arrays of 64-bit hashes with a row of log-probabilities, one per language: a sequence that
any language has seen is one binary search, the rest back off order by order. Scoring is one
pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, free_name, in_chunks, mix

ORDER = 4
SLACK = 8.0
_SPACE = 32
_CHUNK = 1 << 20  # several arrays per letter are alive at once
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for everything that is no letter."""
    global _letters
    if _letters is None:
        table = np.full(0x110000, _SPACE, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letters = table
    return _letters


def sequences(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four letters in a row, everywhere: (codes n x 4, text of each, letters per text).

    Runs of anything but letters are one space; three spaces go before a text and one behind.
    """
    codes = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))[texts.bounds]
    mapped = letters()[codes]
    of = np.repeat(np.arange(len(texts)), np.diff(ends))
    keep = mapped != _SPACE
    found = np.bincount(of[keep], minlength=len(texts))
    keep[1:] |= (mapped[:-1] != _SPACE) & (of[1:] == of[:-1])
    mapped, of = mapped[keep], of[keep]
    room = np.bincount(of, minlength=len(texts)) + 4
    out = np.full(int(room.sum()), _SPACE, np.uint32)
    out[np.arange(len(of)) + 4 * of + 3] = mapped
    owner = np.repeat(np.arange(len(texts)), room)
    valid = owner[: len(out) - 3] == owner[3:] if len(out) > 3 else np.zeros(0, bool)
    at = np.flatnonzero(valid)
    return np.stack([out[at + k] for k in range(ORDER)], axis=1) if len(at) else np.zeros((0, ORDER), np.uint32), owner[at], found


def keys(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of code points."""
    h = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        h = (h + codes[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix(h)


def _grouped(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, their summed weights, and how many rows each had."""
    if not len(codes):
        return codes, weights, weights
    rows, inverse = np.unique(codes, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    return rows, np.bincount(inverse, weights), np.bincount(inverse).astype(float)


@dataclass
class Level:
    """Sequences of one length: hash -> log-probability of the last letter, per language."""

    seen: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray  # hashes of what stands before the last letter
    log_backoff: np.ndarray


@dataclass
class Model:
    languages: list[str]
    levels: list[Level] = field(default_factory=list)  # longest first
    log_unknown: np.ndarray | None = None
    limits: np.ndarray | None = None  # highest accepted cross-entropy, per language

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each row's last letter given those before, per language."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        rest = np.arange(len(codes))
        for k, level in enumerate(self.levels):
            part = codes[rest, k:]
            h = keys(part)
            at = np.minimum(np.searchsorted(level.seen, h), len(level.seen) - 1)
            hit = level.seen[at] == h
            out[rest[hit]] += level.log_p[at[hit]]
            rest, part = rest[~hit], part[~hit]
            if not len(rest):
                return out
            if part.shape[1] > 1:
                h = keys(part[:, :-1])
                at = np.minimum(np.searchsorted(level.contexts, h), len(level.contexts) - 1)
                hit = level.contexts[at] == h
                out[rest[hit]] += level.log_backoff[at[hit]]
        out[rest] += self.log_unknown
        return out

    def score(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: best language, its cross-entropy (nats per letter), confidence, letters."""
        codes, owner, found = sequences(texts)
        n = np.bincount(owner, minlength=len(texts))
        first = np.searchsorted(owner, np.arange(len(texts)))
        total = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(n)
        if len(some):
            total[some] = np.add.reduceat(self.log_p(codes), first[some], axis=0, dtype=np.float64)
        entropy = -total / np.maximum(n, 1)[:, None]
        best = entropy.argmin(axis=1)
        lead = entropy - entropy.min(axis=1, keepdims=True)
        confidence = 1 / np.exp(-np.minimum(lead * np.minimum(n, 100)[:, None], 700)).sum(axis=1)
        return best, entropy[np.arange(len(texts)), best], confidence, found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in in_chunks(batches, "text", _CHUNK):
        codes, owner, _ = sequences(texts)
        langs = np.array(rows["lang"].to_pylist(), object)
        for lang in set(langs.tolist()):
            got, count, _ = _grouped(codes[(langs == lang)[owner]], np.ones(int((langs == lang)[owner].sum())))
            if len(got):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(got)), *(pa.array(got[:, k].astype(np.int32)) for k in range(ORDER)), pa.array(count.astype(np.int64))], names=["lang", "a", "b", "c", "d", "n"])


def fit(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of (distinct sequences, counts) per language."""
    model = Model(languages)
    per: list[dict[str, tuple]] = [{} for _ in range(ORDER)]
    for lang in languages:
        codes, n = counts[lang]
        for k in range(ORDER):
            per[k][lang] = (codes, n)
            # Shorter sequences count the distinct letters they were seen behind.
            codes, _, n = _grouped(codes[:, 1:], n) if codes.shape[1] > 1 else (codes, n, n)
    alphabet = len({int(c) for codes, _ in per[ORDER - 1].values() for c in codes[:, 0]}) + 1
    lower: Model = Model(languages, [], np.full(len(languages), -np.log(alphabet), np.float32))
    for k in reversed(range(ORDER)):
        seen = np.unique(np.concatenate([c for c, _ in per[k].values()]), axis=0)
        ctx = np.unique(seen[:, :-1], axis=0)
        seen_key, ctx_key = keys(seen), keys(ctx)
        order, ctx_order = np.argsort(seen_key), np.argsort(ctx_key)
        seen, seen_key, ctx_key = seen[order], seen_key[order], ctx_key[ctx_order]
        below = lower.log_p(seen[:, 1:]) if k < ORDER - 1 else np.tile(lower.log_unknown, (len(seen), 1))
        log_p, backoff = np.zeros((len(seen), len(languages)), np.float32), np.zeros((len(ctx), len(languages)), np.float32)
        for i, lang in enumerate(languages):
            codes, n = per[k][lang]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            d = ones / (ones + 2 * twos) if ones else 0.5
            at = np.searchsorted(ctx_key, keys(codes[:, :-1]))
            total, kinds = np.bincount(at, n, len(ctx)), np.bincount(at, minlength=len(ctx))
            weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            own = np.zeros(len(seen))
            own[np.searchsorted(seen_key, keys(codes))] = np.maximum(n - d, 0)
            of = np.searchsorted(ctx_key, keys(seen[:, :-1]))
            log_p[:, i] = np.log(own / np.maximum(total[of], 1) + weight[of] * np.exp(below[:, i].astype(float)))
            backoff[:, i] = np.log(weight)
        unknown = lower.log_unknown + backoff[0] if k == ORDER - 1 and len(ctx) else lower.log_unknown
        lower = Model(languages, [Level(seen_key, log_p, ctx_key, backoff), *lower.levels], unknown)
    model.levels, model.log_unknown = lower.levels, lower.log_unknown
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", use: Column | None = None, per_language: int = 1500) -> Model:
    """A model of the languages in ``docs``; null languages and rows outside ``use`` teach nothing.

    About ``per_language`` texts of each language, chosen by a hash of the id, are used (the
    documented bound): three quarters for the counts, one quarter to calibrate rejection. A
    language whose texts hold no letters is not learned.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), (F.lit(True) if use is None else use).alias("use"))
    rows = rows.where("use and lang is not null and text is not null and id is not null").drop("use")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([])
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))))
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.withColumn("u", u / share[F.col("lang")]).where("u < 1")
    counted = sample.where("u < 0.75 or u is null").select("lang", "text").mapInArrow(_count, "lang string, a int, b int, c int, d int, n long")
    table = counted.groupBy("lang", "a", "b", "c", "d").agg(F.sum("n").alias("n")).toPandas()
    counts = {lang: (g[["a", "b", "c", "d"]].to_numpy(np.uint32), g["n"].to_numpy(float)) for lang, g in table.groupby("lang")}
    model = fit(sorted(counts), counts)
    held = sample.where("u >= 0.75")
    seen = annotate(held.select("lang", "text"), model, "text", ["lang"]).where("letters > 0 and lang_pred = lang")
    stats = {r.lang_pred: r for r in seen.groupBy("lang_pred").agg(F.max("entropy").alias("hi"), F.percentile("entropy", F.lit(0.5)).alias("mid"), F.count("*").alias("n")).collect()}
    # As far above the worst held-out text as that lies above the middle, and one nat at least.
    model.limits = np.array([stats[x].hi + max(1.0, stats[x].hi - stats[x].mid) if x in stats else np.inf for x in model.languages])
    return model


def annotate(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, only_accepted: bool = False) -> DataFrame:
    """Rows of ``docs`` with ``lang_pred``, ``score``, ``entropy``, ``letters`` and ``accepted``.

    ``und`` with score 0 is the verdict on null and empty texts, texts without a letter, and
    all texts if no language was learned; they are not accepted. ``keep`` names the columns
    passed on (default: all; those named like a new one give way); with ``only_accepted`` they come alone, of accepted rows.
    """
    if keep is None:
        keep = [c for c in docs.columns if only_accepted or c not in NEW]
    fields = [docs.schema[c] for c in keep]
    own = text_col not in keep
    body = free_name(docs, "body") if own else text_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in in_chunks(batches, body, _CHUNK):
            if model.languages:
                best, entropy, confidence, found = model.score(texts)
                # The mean over few letters strays farther: the allowance falls with the root of their number.
                limit = np.inf if model.limits is None else model.limits[best] + SLACK / np.sqrt(np.maximum(found, 1))
                known = found > 0
                names = np.where(known, np.array(model.languages, object)[best], "und")
                accepted = known & (entropy <= limit)
            else:
                known = accepted = np.zeros(len(texts), bool)
                names, entropy, confidence, found = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            kept = [rows[c].combine_chunks() for c in keep]
            if only_accepted:
                yield pa.RecordBatch.from_arrays(kept, names=keep).filter(pa.array(accepted))
                continue
            more = [pa.array(names, pa.string()), pa.array(np.where(known, confidence, 0.0)), pa.array(np.where(known, entropy, np.nan)), pa.array(found.astype(np.int64)), pa.array(accepted)]
            yield pa.RecordBatch.from_arrays([*kept, *more], names=[*keep, *NEW])

    source = docs.select(*keep, F.col(text_col).alias(body)) if own else docs.select(*keep)
    new = [] if only_accepted else [T.StructField(n, t) for n, t in zip(NEW, (T.StringType(), T.DoubleType(), T.DoubleType(), T.LongType(), T.BooleanType()), strict=True)]
    return source.mapInArrow(run, T.StructType([*fields, *new]))


NEW = ["lang_pred", "score", "entropy", "letters", "accepted"]
