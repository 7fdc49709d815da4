"""Perplexity by a hierarchical Pitman-Yor language model over words.

Every word seen before another (and the start of a text) is a restaurant whose dishes are the
words that followed it. All of them share one parent, the restaurant of all words; its parent
spells words backwards, byte by byte (two bytes of context, then one, then none, then uniform).
An end token closes every text. Nothing is classed or capped: each seen pair of words is a row.

Seating is a Chinese-restaurant process, sampled by Gibbs sweeps: a sweep re-seats the
customers of every dish, given how many tables its restaurant had in the sweep before and
what the parent predicts; tables are the parent's customers. So a dish needs its own count, its
context's tables and its word's probability only. Customers are
seated in runs of a quarter of those already there, so a dish with millions costs some seventy
draws; draws are hashes of dish, sweep and run, so reruns agree. A dish with one customer
has one table, whatever is drawn: such pairs enter the sweeps as sums by context and by word.
Predictive probabilities are averaged over the sweeps after the burn-in.

Texts are dealt into parts of about ``part_bytes``, as places in a part's list of words. Parts
send the hashes of their distinct words and pairs to buckets of hashes and are told their counts in
all, in the same order. A pair is seated by the first part that has it; in a sweep a part sends
sums of tables by word, and the buckets of words tell the parts the sums over all. So a hot word
or pair is one number a part. When texts are scored, a part seats all its pairs once more: the
draws are the same. Numbers travel and lie compressed, and parts meet answers in slices.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.session import shared_folder

from .common import BATCH_ROWS, Texts, in_chunks, mix, ragged, settings, words_of

_BEGIN = 256
_SYMBOLS = 257
_FAR = 16  # classes of the farther of two context symbols
CONTEXTS = _SYMBOLS * _FAR
#: Rounds in which parts (or buckets) meet their answers, so that not all of both is shuffled at a time.
SLICES = 4
#: What stands for the start and the end of a text among hashes of words.
START, END = (int(h) for h in mix(np.array([0x5EED, 0xE4D], np.uint64)).view(np.int64))


def new_table_odds(theta: float, discount: float, tables, base):
    return (theta + discount * tables) * base


def seat(customers: np.ndarray, base: np.ndarray, tables: np.ndarray | float, theta: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after seating its customers, the rest of the restaurant given."""
    shape = customers.shape
    fresh = np.broadcast_to(new_table_odds(theta, discount, tables, base), shape).ravel()
    customers = customers.ravel()
    t = (customers > 0).astype(np.int64)
    k = t.copy()
    live = np.flatnonzero(customers > k)
    while len(live):
        run = np.minimum(np.maximum(k[live] // 4, 1), customers[live] - k[live])
        p = fresh[live] / (k[live] - discount * t[live] + fresh[live])
        t[live] += rng.binomial(run, np.clip(p, 0, 1))
        k[live] += run
        live = live[customers[live] > k[live]]
    return t.reshape(shape)


def discount_of(counts: np.ndarray) -> float:
    """The usual estimate from how many counts are one and two, kept off its limits."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return float(np.clip(one / (one + 2 * two), 0.1, 0.95)) if one else 0.5


def _uniform(bits: np.ndarray) -> np.ndarray:
    return (bits >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def draw(bits: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Binomial draws from 64 random bits each: by inversion, or the normal limit where the variance exceeds 50."""
    flip = p > 0.5
    q = np.where(flip, 1 - p, p)
    mean, var = n * q, n * q * (1 - q)
    u = _uniform(bits)
    out = np.zeros(len(n))
    large = np.flatnonzero(var > 50)
    if len(large):
        angle = _uniform(mix(bits[large] + np.uint64(1)))
        normal = np.sqrt(-2 * np.log(u[large])) * np.cos(2 * np.pi * angle)
        out[large] = np.clip(np.rint(mean[large] + np.sqrt(var[large]) * normal), 0, n[large])
    term = np.exp(n * np.log1p(-q))
    live = np.flatnonzero((term < u) & (var <= 50) & (n > 0))  # the others are zero
    most, u, term, ratio = n[live].astype(float), u[live], term[live], q[live] / (1 - q[live])
    total, got, k = term, np.ones(len(live)), 0
    while len(live):
        term = term * ratio * (most - k) / (k + 1)
        total, k = total + term, k + 1
        more = (total < u) & (k < most)
        got += more
        if 2 * np.count_nonzero(more) < len(live):  # until then those that are done are carried on: they get no more
            out[live] = got
            live, most, u, term, total, ratio, got = (x[more] for x in (live, most, u, term, total, ratio, got))
    return np.where(flip, n - out, out).astype(np.int64)


def coin(bits: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``draw`` where every ``n`` is one."""
    u = _uniform(bits)
    return np.where(p > 0.5, u <= p, u > 1 - p)


def falling(n: np.ndarray) -> np.ndarray:
    """The order of counts from the largest; few are large, the others are sorted as short numbers."""
    top = 65_535
    order = np.argsort(top - np.minimum(n, top).astype(np.uint16), kind="stable")
    large = int((n >= top).sum())
    order[:large] = order[:large][np.argsort(-n[order[:large]], kind="stable")]
    return order


def seat_rows(customers: np.ndarray, fresh: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of dishes that lie anywhere: ``fresh`` is a new table's odds, ``keys`` their 64-bit names.

    All dishes with customers left have as many seated. They lie by falling customers, so those
    still to seat come first. Runs of one, all that most dishes have, are a coin each.
    """
    t = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    live = live[falling(customers[live])]
    n, fresh, keys, tables = -customers[live], fresh[live], keys[live], np.ones(len(live))
    step, k, left = 0, 1, len(live)
    while left:
        run = max(k // 4, 1)
        odds = fresh[:left]
        p = odds / (k - discount * tables[:left] + odds)
        bits = mix(keys[:left] ^ np.uint64((sweep + 1) * 100_003 + step))
        tables[:left] += coin(bits, p) if run == 1 else draw(bits, np.minimum(run, -n[:left] - k), np.clip(p, 0, 1))
        k, step = k + run, step + 1
        left = int(np.searchsorted(n, -k))
    t[live] = tables
    return t


def pair_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(u * np.uint64(0x9E3779B97F4A7C15) + v)


def ordered(keys: np.ndarray) -> np.ndarray:
    """The stable order of hashes: their first bits are sorted with their places in the last; if that does not tell all apart, they are."""
    bits = np.uint64(max(len(keys) - 1, 1).bit_length())
    first = keys & ~((np.uint64(1) << bits) - np.uint64(1))
    first |= np.arange(len(keys), dtype=np.uint64)
    first.sort()
    order = (first & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = keys[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(keys, kind="stable")


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes ascending, where each first stands, the order of all, and where each begins in it."""
    order = ordered(keys)
    found = keys[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), found[1:] != found[:-1])))
    return found[starts], order[starts], order, starts


def ranks(order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each hash its place among the distinct ones."""
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(order)))
    return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so sorted keys lie in runs of one bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    found, starts = np.unique(bucket_of(keys, buckets), return_index=True)
    for b, s, e in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
        yield b, slice(s, e)


@dataclass
class Spelling:
    """Words from their last byte to the first: pairs of last bytes, then one byte at a time."""

    pair: np.ndarray  # log10 of the two last symbols
    step: np.ndarray  # log10 of a symbol, given the context row of the two after it

    def log_p(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        last, before = last_symbols(data, starts, ends)
        out = self.pair[last, before]
        # Symbols 2, 3, … of the reversed word and its closing begin mark.
        n = np.maximum(ends - starts - 1, 0)
        owner = np.repeat(np.arange(len(starts)), n)
        at = ragged(ends - 3 - n + 1, n)
        symbol = np.where(at < starts[owner], _BEGIN, data[np.maximum(at, 0)])
        return out + np.bincount(owner, self.step[context_row(data[at + 1].astype(np.int64), data[at + 2].astype(np.int64)), symbol], minlength=len(starts)) if len(at) else out


def last_symbols(data, starts, ends):
    last = data[ends - 1].astype(np.int64)
    return last, np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], _BEGIN).astype(np.int64)


def context_row(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The row of a context: the nearer symbol, and a class of the farther."""
    return one * _FAR + (mix(two.astype(np.uint64) + np.uint64(1)) % np.uint64(_FAR)).astype(np.int64)


def lowered(texts: Texts) -> np.ndarray:
    return np.where((texts.data >= 65) & (texts.data <= 90), texts.data + 32, texts.data).astype(np.uint8)


def _spelling_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often symbols follow contexts in words, weighted by the words' tables, per task."""
    size = (CONTEXTS + _SYMBOLS) * _SYMBOLS
    total = np.zeros(size)
    for batch in batches:
        texts = _binary(batch.column("word"))
        starts, ends = texts.bounds[:-1], texts.bounds[1:]
        some = ends > starts
        starts, ends, weight = starts[some], ends[some], np.ones(int(some.sum()))
        data = texts.data
        last, before = last_symbols(data, starts, ends)
        keys, weights = [CONTEXTS * _SYMBOLS + last * _SYMBOLS + before], [weight]
        n = np.maximum(ends - starts - 1, 0)
        owner = np.repeat(np.arange(len(starts)), n)
        at = ragged(ends - 3 - n + 1, n)
        if len(at):
            symbol = np.where(at < starts[owner], _BEGIN, data[np.maximum(at, 0)])
            one, two = data[at + 1].astype(np.int64), data[at + 2].astype(np.int64)
            keys.append(context_row(one, two) * _SYMBOLS + symbol)
            weights.append(weight[owner])
        np.add.at(total, np.concatenate(keys), np.concatenate(weights))
    key = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total[key].astype(np.int64))], names=["key", "n"])


def _binary(column: pa.Array) -> Texts:
    column = column.cast(pa.large_binary())
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return Texts(np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0])


def fit_spelling(counts: pd.DataFrame, theta: float, sweeps: int, seed: int) -> Spelling:
    """The backward model of bytes; its tables have a fixed number of rows."""
    dense = np.zeros((CONTEXTS + _SYMBOLS, _SYMBOLS))
    dense.ravel()[counts["key"].to_numpy(np.int64)] = counts["n"].to_numpy(float)
    two, pair = dense[:CONTEXTS].astype(np.int64), dense[CONTEXTS:]
    rng = np.random.default_rng(seed)
    near = np.arange(CONTEXTS) // _FAR  # rows that share their nearer symbol share a parent
    uniform = np.full(_SYMBOLS, 1 / _SYMBOLS)
    p1, p0 = np.tile(uniform, (_SYMBOLS, 1)), uniform
    d2 = discount_of(two)
    total, used = np.zeros_like(two, float), 0
    tables2 = (two > 0).sum(axis=1, keepdims=True).astype(float)
    tables1 = np.zeros((_SYMBOLS, 1))
    for sweep in range(sweeps):
        t2 = seat(two, p1[near], tables2, theta, d2, rng)
        tables2 = t2.sum(axis=1, keepdims=True).astype(float)
        c1 = np.zeros((_SYMBOLS, _SYMBOLS), np.int64)
        np.add.at(c1, near, t2)
        d1 = discount_of(c1)
        t1 = seat(c1, p0[None, :], tables1, theta, d1, rng)
        tables1 = t1.sum(axis=1, keepdims=True).astype(float)
        c0 = t1.sum(axis=0)
        d0 = discount_of(c0)
        t0 = seat(c0, uniform, float((c0 > 0).sum()), theta, d0, rng)
        p0 = (c0 - d0 * t0 + new_table_odds(theta, d0, t0.sum(), uniform)) / (c0.sum() + theta)
        p1 = (c1 - d1 * t1 + new_table_odds(theta, d1, tables1, p0[None, :])) / (c1.sum(axis=1, keepdims=True) + theta)
        if sweep >= sweeps // 2:
            total += (two - d2 * t2 + new_table_odds(theta, d2, tables2, p1[near])) / (two.sum(axis=1, keepdims=True) + theta)
            used += 1
    q = (pair + 0.05) / (pair.sum() + 0.05 * pair.size)
    return Spelling(np.log10(q), np.log10(total / used).astype(np.float32))


def _discount(one: int, two: int) -> float:
    return float(np.clip(one / (one + 2 * two), 0.1, 0.95)) if one else 0.5


def shrunk(values, kind) -> bytes:
    """Numbers as bytes: first bytes of all, then second bytes, and so on as far as some are not zero, compressed."""
    values = np.ascontiguousarray(values, kind)
    n, width = len(values), values.itemsize
    used = width if values.dtype.kind == "f" or not n else -(-int(values.view(f"u{width}").max()).bit_length() // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(n, width)[:, :used].T)
    return n.to_bytes(7, "little") + bytes([used]) + pa.compress(planes, codec="zstd", asbytes=True)


def grown(blob: bytes, kind) -> np.ndarray:
    n, used, width = int.from_bytes(blob[:7], "little"), blob[7], np.dtype(kind).itemsize
    if not n * used:
        return np.zeros(n, kind)
    planes = np.frombuffer(pa.decompress(memoryview(blob)[8:], n * used, codec="zstd"), np.uint8).reshape(used, n)
    out = np.zeros((n, width), np.uint8)
    for i in range(used):
        out[:, i] = planes[i]
    return out.view(kind).ravel()


def shrunk_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes as their steps."""
    return shrunk(np.diff(keys, prepend=np.zeros(1, np.uint64)), np.uint64)


def grown_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(grown(blob, np.uint64), dtype=np.uint64)


def shrunk_words(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def grown_words(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _kind(text: str) -> pa.Schema:
    """The Arrow schema of columns given as ``name type, …`` in long and binary."""
    return pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (c.split() for c in text.split(", "))])


PART = "learn binary, sizes binary, token binary, h binary, lens binary, word binary, tokens long"
WORDS_SENT = "bucket long, part long, h binary, n binary, lens binary, word binary"
LEXICON = "bucket long, part binary, runs binary, at binary, h binary, n binary, lens binary, word binary, seen long, words long, ends long"
SPELLED = "bucket long, part binary, runs binary, at binary, h binary, n binary, base binary"
PAIRS_SENT = "bucket long, part long, k binary, n binary"
ANSWERS = "part long, bucket long, pair binary, count binary, base binary, once long, twice long"
PAIRS = "part long, runs binary, base binary, su binary, sv binary, k binary, u binary, v binary, n binary"
MESSAGES = "bucket long, part long, tu binary, tv binary"
SEATS = "part long, bucket long, sweep long, tables binary, c binary, t binary, customers long, seated long"


def _parts(batches: Iterator[pa.RecordBatch], part_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts as places in the list of their part's distinct words, one row a part; the list holds both marks."""
    task, made = TaskContext.get().partitionId(), 0
    marks = np.array([START, END], np.int64).view(np.uint64)

    def sent(held):
        rows, n, places, hashes, lens, flat = zip(*held, strict=True)
        ids, n, lens = pa.concat_tables(rows).combine_chunks(), np.concatenate(n), np.concatenate([*lens, np.zeros(2, np.int64)])
        flat = np.concatenate(flat)
        h, at, *by = distinct(np.concatenate([*hashes, marks]))
        inverse = ranks(*by)
        shift = np.concatenate(([0], np.cumsum([len(x) for x in hashes])))
        words = np.concatenate([inverse[p + s] for p, s in zip(places, shift[:-1], strict=True)])
        token = np.full(len(words) + len(n), np.searchsorted(h, marks[1]))
        token[np.arange(len(words)) + np.repeat(np.arange(len(n)), n)] = words
        begin = np.concatenate(([0], np.cumsum(lens)))[at]
        word = shrunk_words(flat[ragged(begin, lens[at])].tobytes())
        listed = pa.StructArray.from_arrays([ids[c].combine_chunks() for c in ("id", "row_tag")], names=["id", "row_tag"])
        learn = ids["learn"].to_numpy().astype(np.uint8)
        row = [pa.array([(task << 32) + made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)]
        blobs = [shrunk(learn, np.uint8), shrunk(n + 1, np.int64), shrunk(token, np.int32), shrunk_keys(h), shrunk(lens[at], np.int32), word]
        return pa.RecordBatch.from_arrays([*row, *(pa.array([b], pa.binary()) for b in blobs), pa.array([len(token)], pa.int64())], names=["part", "rows", *_kind(PART).names])

    held, size = [], 0
    for rows, texts in in_chunks(batches, "text", min(part_bytes, 2 << 20)):
        if held and size + len(texts.data) > part_bytes:
            yield sent(held)
            held, size, made = [], 0, made + 1
        words = words_of(texts)
        h, at, *by = distinct(words.hashes)
        starts, lens = words.starts[at], (words.ends - words.starts)[at]
        held.append((rows.select(["id", "row_tag", "learn"]), np.diff(words.first), ranks(*by), h, lens, lowered(texts)[ragged(starts, lens)]))
        size += len(texts.data)
    if held:
        yield sent(held)


def _pairs_of(row: dict) -> tuple[np.ndarray, ...]:
    """A part's distinct pairs by ascending key: key, both words' places; the order of its tokens by pair, where each pair begins; and per token its place."""
    h, v, n = grown_keys(row["h"]), grown(row["token"], np.int32), grown(row["sizes"], np.int64)
    u = np.empty_like(v)
    u[1:] = v[:-1]
    u[np.cumsum(n) - n] = np.searchsorted(h, np.int64(START).view(np.uint64))
    key, at, order, starts = distinct(pair_key(h[u], h[v]))
    return key, u[at], v[at], order, starts, v


def _send_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            h, token, n = grown_keys(row["h"]), grown(row["token"], np.int32), grown(row["sizes"], np.int64)
            learnt = np.repeat(grown(row["learn"], np.uint8), n).astype(float)
            count = np.bincount(token, learnt, len(h)).astype(np.int64)
            count[h == np.int64(START).view(np.uint64)] = count[h == np.int64(END).view(np.uint64)]
            lens = grown(row["lens"], np.int32).astype(np.int64)
            word, ends = grown_words(row["word"]), np.concatenate(([0], np.cumsum(lens)))
            rows = [(b, row["part"], shrunk_keys(h[s]), shrunk(count[s], np.int64), shrunk(lens[s], np.int32), shrunk_words(word[ends[s.start] : ends[s.stop]])) for b, s in _runs(h, buckets)]
            yield from _table(rows, _kind(WORDS_SENT)).to_batches()


def _gather_words(sent: pa.Table) -> pa.Table:
    """A bucket's distinct words, and where those of each part lie among them."""
    sent = sent.sort_by("part").to_pylist()
    hashes = [grown_keys(r["h"]) for r in sent]
    h, at, *by = distinct(np.concatenate(hashes))
    inverse = ranks(*by)
    n = np.zeros(len(h), np.int64)
    np.add.at(n, inverse, np.concatenate([grown(r["n"], np.int64) for r in sent]))
    lens = np.concatenate([grown(r["lens"], np.int32) for r in sent]).astype(np.int64)
    begin = np.cumsum(lens) - lens
    flat = np.frombuffer(b"".join(grown_words(r["word"]) for r in sent), np.uint8)
    real = ~np.isin(h.view(np.int64), [START, END])
    row = (sent[0]["bucket"], shrunk([r["part"] for r in sent], np.int64), shrunk([len(x) for x in hashes], np.int64), shrunk(inverse, np.int32), shrunk_keys(h), shrunk(n, np.int64), shrunk(lens[at], np.int32), shrunk_words(flat[ragged(begin[at], lens[at])].tobytes()))
    return _table([(*row, int(n[real].sum()), int((n[real] > 0).sum()), int(n[h.view(np.int64) == END].sum()))], _kind(LEXICON))


def _words(row: dict) -> Texts:
    return Texts(np.frombuffer(grown_words(row["word"]), np.uint8), np.concatenate(([0], np.cumsum(grown(row["lens"], np.int32), dtype=np.int64))))


def _spelling_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbol counts of the words that stand in texts learnt from."""

    def words():
        for batch in batches:
            for row in batch.to_pylist():
                texts, some = _words(row), grown(row["n"], np.int64) > 0
                bounds = pa.py_buffer(texts.bounds)
                word = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, bounds, pa.py_buffer(texts.data)])
                yield pa.RecordBatch.from_arrays([word.filter(pa.array(some))], names=["word"])

    return _spelling_counts(words())


def _spell(batches: Iterator[pa.RecordBatch], spelling: Spelling, share: float) -> Iterator[pa.RecordBatch]:
    """log10 of what the base gives to each word; the start of a text is never a dish."""
    for batch in batches:
        for row in batch.to_pylist():
            texts, h = _words(row), grown_keys(row["h"])
            base, some = np.full(len(h), -np.inf), np.diff(texts.bounds) > 0
            base[some] = spelling.log_p(texts.data, texts.bounds[:-1][some], texts.bounds[1:][some]) + np.log10(share)
            base[h.view(np.int64) == END] = np.log10(1 - share)
            yield from _table([(*(row[c] for c in ("bucket", "part", "runs", "at", "h", "n")), shrunk(base, np.float64))], _kind(SPELLED)).to_batches()


def _by_part(row: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that has words of a bucket, and their places in the bucket."""
    at, ends = grown(row["at"], np.int32), np.cumsum(grown(row["runs"], np.int64))
    for part, e, n in zip(grown(row["part"], np.int64).tolist(), ends.tolist(), grown(row["runs"], np.int64).tolist(), strict=True):
        yield part, at[e - n : e]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To every part the counts and bases of its words."""
    for batch in batches:
        for row in batch.to_pylist():
            n, base = grown(row["n"], np.int64), grown(row["base"], np.float64)
            rows = [(part, row["bucket"], None, shrunk(n[at], np.int64), shrunk(base[at], np.float64), 0, 0) for part, at in _by_part(row)]
            yield from _table(rows, _kind(ANSWERS)).to_batches()


def _send_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            key, _, _, order, starts, _ = _pairs_of(row)
            learnt = np.repeat(grown(row["learn"], np.uint8), grown(row["sizes"], np.int64))
            n = np.add.reduceat(learnt[order], starts, dtype=np.int64) if len(key) else np.zeros(0, np.int64)
            rows = [(b, row["part"], shrunk_keys(key[s]), shrunk(n[s], np.int64)) for b, s in _runs(key, buckets)]
            yield from _table(rows, _kind(PAIRS_SENT)).to_batches()


def _count_pairs(sent: pa.Table) -> pa.Table:
    """To every part how often its pairs are seen in all: twice that, and one more where the part is the first to have it."""
    rows = sent.sort_by("part").to_pylist()
    keys, n = [grown_keys(r["k"]) for r in rows], np.concatenate([grown(r["n"], np.int64) for r in rows])
    key = np.concatenate(keys)
    order = ordered(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    group, total = np.cumsum(new) - 1, np.add.reduceat(n[order], np.flatnonzero(new))
    seen = np.flatnonzero(n[order] > 0)
    code = np.empty(len(key), np.int64)
    code[order] = 2 * total[group]
    code[order[seen[np.diff(group[seen], prepend=-1) > 0]]] += 1
    ends = np.cumsum([len(k) for k in keys])
    out = []
    for r, k, e in zip(rows, keys, ends.tolist(), strict=True):
        first = not out
        out.append((r["part"], r["bucket"], shrunk(code[e - len(k) : e], np.int64), None, None, int(first and (total == 1).sum()), int(first and (total == 2).sum())))
    return _table(out, _kind(ANSWERS))


def _joined(rows: list[dict], column: str, kind) -> np.ndarray:
    """What the buckets sent, in the order of their numbers: that of the keys."""
    return np.concatenate([np.zeros(0, kind), *(grown(r[column], kind) for r in rows if r[column] is not None)])


def _keep_pairs(parts: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    """A part's pairs to seat (seen more than once, first here), and by word how many seen once it opens and closes."""
    row, answers = parts.to_pylist()[0], answers.sort_by("bucket").to_pylist()
    key, u, v, *_ = _pairs_of(row)
    code, h = _joined(answers, "pair", np.int64), grown_keys(row["h"])
    mine, once = (code & 1 == 1) & (code > 3), code == 3
    runs = np.bincount(bucket_of(h, buckets), minlength=buckets)
    sums = [shrunk(np.bincount(x[once], minlength=len(h)), np.int64) for x in (u, v)]
    base = np.zeros(len(h))
    base[v[mine]] = _joined(answers, "base", np.float64)[v[mine]]
    return _table([(row["part"], shrunk(runs, np.int64), shrunk(base, np.float64), *sums, shrunk_keys(key[mine]), shrunk(u[mine], np.int32), shrunk(v[mine], np.int32), shrunk(code[mine] >> 1, np.int64))], _kind(PAIRS))


def _message(row: dict, t: np.ndarray) -> pa.Table:
    """To every bucket of words the tables that its words open and close in a part."""
    tu, tv = (grown(row[s], np.int64) for s in ("su", "sv"))
    for sums, side in ((tu, "u"), (tv, "v")):
        sums += np.bincount(grown(row[side], np.int32), t, len(sums)).astype(np.int64)
    runs = grown(row["runs"], np.int64)
    ends = np.cumsum(runs)
    some = np.flatnonzero(runs)
    return _table([(b, row["part"], *(shrunk(x[ends[b] - runs[b] : ends[b]], np.int64) for x in (tu, tv))) for b in some.tolist()], _kind(MESSAGES))


def _first_message(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from _message(row, np.ones(len(grown(row["n"], np.int64)))).to_batches()


@dataclass
class Sweep:
    """What a sweep gives the restaurant of all words: customers, and the share of new tables."""

    customers: float
    fresh: float

    def p(self, c, t, given, theta: float, discount: float) -> np.ndarray:
        return (c - discount * t) / (self.customers + theta) + self.fresh * given


def _seat_pairs(pairs: pa.Table, seats: pa.Table, sweep: int, made: Sweep, theta: float, discount: float, word_discount: float) -> pa.Table:
    row, seats = pairs.to_pylist()[0], seats.sort_by("bucket").to_pylist()
    u, v = (grown(row[x], np.int32) for x in "uv")
    tables, c, t = (_joined(seats, x, np.int64) for x in ("tables", "c", "t"))
    p = made.p(c, t, 10 ** grown(row["base"], np.float64), theta, word_discount)[v]
    return _message(row, seat_rows(grown(row["n"], np.int64), new_table_odds(theta, discount, tables[u], p), discount, grown_keys(row["k"]), sweep))


def _tables_of(row: dict, messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    sent = {m["part"]: m for m in messages.to_pylist()}
    tables, c = (np.zeros(len(grown(row["h"], np.uint64)), np.int64) for _ in range(2))
    for part, at in _by_part(row):
        tables[at] += grown(sent[part]["tu"], np.int64)
        c[at] += grown(sent[part]["tv"], np.int64)
    return tables, c


def _seldom(words: pa.Table, messages: pa.Table) -> pa.Table:
    _, c = _tables_of(words.to_pylist()[0], messages)
    return pa.table({k: [int(x.sum())] for k, x in (("once", c == 1), ("twice", c == 2), ("some", c > 0))})


def _seat_words(words: pa.Table, messages: pa.Table, odds: float, discount: float, sweep: int) -> pa.Table:
    """A bucket's words seated in the restaurant of all words; to every part what holds for its words."""
    row = words.to_pylist()[0]
    tables, c = _tables_of(row, messages)
    t = seat_rows(c, odds * 10 ** grown(row["base"], np.float64), discount, grown_keys(row["h"]), sweep)
    out = []
    for part, at in _by_part(row):
        sums = (0, 0) if out else (int(c.sum()), int(t.sum()))
        out.append((part, row["bucket"], sweep, *(shrunk(x[at], np.int64) for x in (tables, c, t)), *sums))
    return _table(out, _kind(SEATS))


class Store:
    """Named Parquet tables in the session's shared folder; a table goes when its successor is written."""

    def __init__(self, spark):
        self.spark, self.folder = spark, os.path.join(shared_folder(spark), f"restaurants-{uuid.uuid4().hex}")
        self.made: dict[str, int] = {}

    def keep(self, name: str, *frames: DataFrame, batch: int = 16) -> DataFrame:
        """``frames`` written one after the other; rows of whole parts and buckets go to Python ``batch`` at a time."""
        made = self.made[name] = self.made.get(name, 0) + 1
        paths = [f"{self.folder}/{name}-{made}/{i}" for i in range(len(frames))]
        with settings(self.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", spark__sql__execution__arrow__maxRecordsPerBatch=str(batch)):
            for path, df in zip(paths, frames, strict=True):
                df.write.parquet(path)
        self.drop(name, made - 1)
        return self.spark.read.schema(frames[0].schema).parquet(*paths)

    def meet(self, name: str, key: str, left: DataFrame, right: DataFrame, function, kind: str, slices: int) -> DataFrame:
        """``function`` of the rows that share ``key``, a slice of all keys at a time: its shuffle files go before the next."""
        mine = [F.pmod(F.xxhash64(key), F.lit(slices)) == i for i in range(slices)]
        return self.keep(name, *(left.where(m).groupBy(key).cogroup(right.where(m).groupBy(key)).applyInArrow(function, kind) for m in mine))

    def drop(self, name: str, made: int = 1) -> None:
        old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}-{made}")
        old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)


@dataclass
class Model:
    spelling: Spelling
    theta: float
    discount: float  # of the restaurants of pairs
    word_discount: float
    burn_in: int
    share: float  # what the base gives to words, the rest to the end
    tokens: int
    words: int
    sweeps: list[Sweep]


def train(rows: DataFrame, sweeps: int = 3, burn_in: int = 1, theta: float = 1.0, seed: int = 11, bucket_tokens: int = 1_000_000, part_bytes: int = 4 << 20) -> tuple[Model, DataFrame, DataFrame, Store, int]:
    """The model of a column of texts ``text``: its numbers, the parts, what they were told; and the tables behind them, in how many slices to score.

    With a column ``learn``, other rows (``id``, ``row_tag``) are dealt into parts as well, and
    their words and pairs asked for, but not counted. The sweeps after ``burn_in`` (fewer than
    ``sweeps``) give a sample each.
    """
    spark, store = rows.sparkSession, Store(rows.sparkSession)
    if "learn" not in rows.columns:
        rows = rows.select(F.lit(0).alias("id"), F.lit(False).alias("row_tag"), F.lit(True).alias("learn"), "text")
    kind = f"part long, rows array<struct<id:{rows.schema['id'].dataType.simpleString()},row_tag:boolean>>, {PART}"
    parts = store.keep("parts", rows.mapInArrow(lambda it: _parts(it, part_bytes), kind), batch=BATCH_ROWS)
    buckets = max(1, -(-(parts.agg(F.sum("tokens")).first()[0] or 0) // bucket_tokens))
    shelves, slices = -(-buckets // 4), min(SLICES, buckets)  # shelves are buckets of words

    texts = parts.select("part", "learn", "sizes", "token", "h")
    asked = texts.mapInArrow(lambda it: _send_pairs(it, buckets), PAIRS_SENT)
    counts = store.keep("counts", asked.groupBy("bucket").applyInArrow(_count_pairs, ANSWERS))
    d2 = _discount(*(x or 0 for x in counts.agg(F.sum("once"), F.sum("twice")).first()))
    sent = parts.drop("rows").mapInArrow(lambda it: _send_words(it, shelves), WORDS_SENT)
    lexicon = store.keep("lexicon", sent.groupBy("bucket").applyInArrow(_gather_words, LEXICON))
    seen, listed, ends = (int(x or 0) for x in lexicon.agg(F.sum("seen"), F.sum("words"), F.sum("ends")).first())
    tokens = seen + ends
    spelled = lexicon.select("n", "lens", "word").mapInArrow(_spelling_symbols, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    spelling, share = fit_spelling(spelled, theta, 4, seed), 1 - (ends + 0.5) / (tokens + 1)
    words = store.keep("words", lexicon.drop("seen", "words", "ends").mapInArrow(lambda it: _spell(it, spelling, share), SPELLED))
    store.drop("lexicon")
    told = counts.unionByName(store.keep("bases", words.mapInArrow(_listed, ANSWERS)))
    pairs = store.meet("pairs", "part", texts, told, lambda p, a: _keep_pairs(p, a, shelves), PAIRS, slices)
    store.drop("bases")  # until the texts are scored

    messages = store.keep("messages", pairs.mapInArrow(_first_message, MESSAGES))
    seldom = store.meet("seldom", "bucket", words, messages, _seldom, "once long, twice long, some long", slices)
    one, two, some = (x or 0 for x in seldom.agg(F.sum("once"), F.sum("twice"), F.sum("some")).first())
    d1, tables, done, seats = _discount(one, two), float(some), [], []
    for sweep in range(sweeps + 1):
        odds = theta + d1 * tables
        held = store.meet(f"seats{sweep}", "bucket", words, messages, lambda w, m, *, odds=odds, s=sweep: _seat_words(w, m, odds, d1, s), SEATS, slices)
        customers, tables = (float(x or 0) for x in held.agg(F.sum("customers"), F.sum("seated")).first())
        done.append(Sweep(customers, (theta + d1 * tables) / (customers + theta)))
        if sweep < sweeps:
            messages = store.meet("messages", "part", pairs, held, lambda p, a, *, s=sweep, now=done[-1]: _seat_pairs(p, a, s, now, theta, d2, d1), MESSAGES, slices)
        if sweep < burn_in:
            store.drop(f"seats{sweep}")
        else:
            seats.append(held)
    for name in ("pairs", "messages"):
        store.drop(name, store.made[name])
    bases = store.keep("bases", words.mapInArrow(_listed, ANSWERS))
    store.drop("words")
    model = Model(spelling, theta, d2, d1, burn_in, share, tokens, listed + (ends > 0), done)
    told = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), seats, counts.unionByName(bases))
    return model, parts.select("part", "rows", "learn", "sizes", "token", "h"), told, store, slices


def _score_part(parts: pa.Table, answers: pa.Table, model: Model) -> pa.Table:
    row, answers = parts.drop_columns(["rows"]).to_pylist()[0], answers.sort_by("bucket").to_pylist()
    key, u, v, order, starts, token = _pairs_of(row)
    seen = (_joined(answers, "pair", np.int64) >> 1).astype(np.int64)
    count, base = _joined(answers, "count", np.int64), _joined(answers, "base", np.float64)
    theta, multi, new, given = model.theta, np.flatnonzero(seen > 1), count == 0, 10**base
    mu, mv = u[multi], v[multi]
    off, shared, samples = np.zeros(len(multi)), np.zeros(len(key)), len(model.sweeps) - 1 - model.burn_in
    for s in range(model.burn_in, len(model.sweeps)):
        held = [a for a in answers if a["sweep"] == s]
        tables, c, t = (_joined(held, x, np.int64) for x in ("tables", "c", "t"))
        parent = model.sweeps[s].p(c, t, given, theta, model.word_discount)
        if s < len(model.sweeps) - 1:
            off += seat_rows(seen[multi], new_table_odds(theta, model.discount, tables[mu], parent[mv]), model.discount, key[multi], s)
        if s > model.burn_in:
            parent = np.where(new, model.sweeps[s].fresh, parent)  # the spelling is added as a logarithm
            shared += ((theta + model.discount * tables) / (count + theta))[u] * parent[v]
    own = np.where(seen > 0, 1 - model.discount, 0.0)
    own[multi] = seen[multi] - model.discount * off / samples
    own = own.astype(np.float32).astype(float)
    p = np.log10(own / (count[u] + theta) + shared / samples) + np.where(new, base, 0)[v]
    plain = np.log10(count + 0.5) - np.log10(model.tokens + 0.5 * (model.words + 1))
    n = grown(row["sizes"], np.int64)
    owner, pair = np.repeat(np.arange(len(n)), n), ranks(order, starts)
    ids = parts["rows"].combine_chunks().flatten()
    sums = [np.bincount(owner, x, len(n)) for x in ((~new)[token], plain[token], p[pair])]
    return pa.table([ids.field(0), ids.field(1), pa.array(n), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=NAMES)


NAMES = ["id", "row_tag", "n_tokens", "n_known", "base_score", "score"]


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", tag: Column | None = None, **options) -> DataFrame:
    """One row per row of ``docs``: id, ``row_tag`` (the value of ``tag``), ``n_tokens``, ``n_known``, ``base_score``, ``score``, ``train_tokens``.

    ``score`` is the log10 probability of the text: a word that was not seen in training is
    spelled out, so what unseen words get sums to the share left for them.

    Learns from the rows for which ``learn`` holds (null: it does not). Null texts are empty:
    an end token alone. Rows that repeat an id are scored each for itself. A part holds about
    ``part_bytes`` of text, or one text that is longer. An empty table gives no rows; without
    a row to learn from, words are spelled out by bytes that are all alike.
    Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), (F.lit(False) if tag is None else tag).alias("row_tag"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).alias("text"))
    model, parts, told, store, slices = train(rows, **options)
    kind = f"id {docs.schema[id_col].dataType.simpleString()}, row_tag boolean, n_tokens long, n_known long, base_score double, score double"
    scored = store.meet("scores", "part", parts, told, lambda p, a: _score_part(p, a, model), kind, slices)
    for name in [n for n in store.made if n != "scores"]:
        store.drop(name, store.made[name])
    return scored.withColumn("train_tokens", F.lit(int(model.tokens)).cast("long"))
