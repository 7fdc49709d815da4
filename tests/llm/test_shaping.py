"""Whitening, sharding and infilling against plain versions."""

import collections
import hashlib
import heapq
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import bidiagonal, fill_middle, queries, sharding, whitening


def plain_shards(texts, shards):
    """Longest processing time, group by group; ties as the operator breaks them do not change loads."""
    groups = collections.Counter()
    for t in texts:
        groups[t] += len((t or "").encode()) + 1
    heap = [(0, j) for j in range(shards)]
    for size in sorted(groups.values(), reverse=True):
        load, j = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, j))
    return {j: load for load, j in heap}


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_are_those_of_the_heap(documents, shards):
    more = documents.sparkSession.createDataFrame([(1000 + i, "z" * (i % 37)) for i in range(700)], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(more)
    rows = sharding.shard_documents(docs, shards).collect()
    source = docs.collect()
    loads = collections.Counter({j: 0 for j in range(shards)})
    for r in rows:
        loads[r.shard] += r["size"]
    assert dict(loads) == plain_shards([r.text for r in source], shards)
    assert collections.Counter((r.id, r["size"], r.text_crc32) for r in rows) == collections.Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source
    )
    for j in range(shards):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sum(r.shard == j for r in rows)))
    homes = collections.defaultdict(set)
    for r in rows:
        homes[r["size"], r.text_crc32].add(r.shard)
    nulls_and_empties = homes.pop((1, 0))
    assert len(nulls_and_empties) <= 2 and all(len(s) == 1 for s in homes.values())
    again = sharding.shard_documents(docs.repartition(5), shards).collect()
    place = lambda rs: sorted((str(r.id), r["size"], r.text_crc32, r.shard) for r in rs)
    assert place(rows) == place(again)


def test_no_documents_need_no_shards(nothing):
    assert sharding.shard_documents(nothing).collect() == []


def test_a_class_is_dealt_as_the_heap_deals_it():
    rnd = random.Random(5)
    for _ in range(300):
        loads = [rnd.choice((0, rnd.randrange(50), rnd.randrange(5000))) for _ in range(rnd.randrange(1, 9))]
        size, n = rnd.randrange(1, 60), rnd.randrange(0, 400)
        heap, counts = [(x, j) for j, x in enumerate(loads)], [0] * len(loads)
        heapq.heapify(heap)
        for _ in range(n):
            load, j = heapq.heappop(heap)
            counts[j] += 1
            heapq.heappush(heap, (load + size, j))
        assert sharding.place(loads, size, n) == counts


def test_a_group_larger_than_a_share_stays_whole(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same words " * 40).otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    rows = sharding.shard_documents(docs, 4).collect()
    assert len({r.shard for r in rows if r.id % 3 == 0}) == 1
    rest = [sum(r["size"] for r in rows if r.shard == j) for j in {r.shard for r in rows if r.id % 3}]
    assert len(rest) == 3 and max(rest) - min(rest) <= 20


def plain_cuts(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, e = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    text, n = text or "", len(text or "")
    p, q = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m in text for m in fill_middle.MARKERS) or c % 100 >= 90:
        return n, "plain", None, None, text
    if e % 100 < 20:
        return n, "spm", p, q - p, f"<S>{text[q:]}<P>{text[:p]}<M>{text[p:q]}"
    return n, "psm", p, q - p, f"<P>{text[:p]}<S>{text[q:]}<M>{text[p:q]}"


def test_infilling_equals_slicing_and_is_undone(spark, documents, nothing):
    rnd = random.Random(3)
    texts = ["<" + "S" * k + ">" for k in range(3)] + ["a<P>b", "<M", "é" * 5, "🙂", "\x00", "<<S", "P>"]
    texts += ["".join(rnd.choice("ab<>SPMé🙂 \n") for _ in range(rnd.randrange(40))) for _ in range(300)]
    texts += ["x" * 3_000_000, "xé🙂" * 400_000, "".join(rnd.choice(("a", "aaaaaaaaaaaaa", "é")) for _ in range(100_000))]
    more = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(more)
    out = fill_middle.transform(docs).withColumn("back", fill_middle.restored("output", "form")).collect()
    want = [(r.doc_id, *plain_cuts(r.doc_id, r.text), r.text or "") for r in docs.collect()]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fill_middle.transform(nothing).count() == 0


def test_other_markers_and_shares(spark):
    docs = spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("some text "), "id").alias("body"))
    out = fill_middle.transform(docs, "k", "body", seed=7, plain_percent=0, suffix_first_percent=100, markers=("[[", "]]", "||"))
    rows = out.withColumn("back", fill_middle.restored("output", "form", ("[[", "]]", "||"))).collect()
    assert {r.form for r in rows} == {"spm"} and all(r.back == f"some text {r.id}" and r.output.startswith("]]") for r in rows)


@pytest.mark.parametrize("make", [lambda r: "x" * 200_000, lambda r: "é" * 100_000, lambda r: "".join(r.choice("aé🙂") for _ in range(90_000)), lambda r: "🙂" * 9 + "a" * 70_000 + "é"])
def test_boundary_sets_select_code_points(make):
    text = make(random.Random(1))
    marks = fill_middle.BoundarySet(np.frombuffer(text.encode(), np.uint8))
    assert len(marks) == len(text)
    for k in {0, 1, len(text) // 3, len(text) // 2, len(text) - 1, len(text)}:
        assert marks.select(k) == len(text[:k].encode())
    with pytest.raises(IndexError):
        marks.select(len(text) + 1)


def test_containers_take_the_smallest_form():
    rnd = np.random.default_rng(0)
    few, many, runs = np.zeros(65536, bool), rnd.random(65536) < 0.5, np.arange(65536) < 60000
    few[rnd.choice(65536, 50, replace=False)] = True
    for inside, kind in ((few, "ArrayContainer"), (many, "BitmapContainer"), (runs, "RunContainer")):
        made = fill_middle.container(inside)
        places = np.flatnonzero(inside)
        assert type(made).__name__ == kind and all(made.select(k) == places[k] for k in range(0, len(places), 7))


MATRICES = {
    "random": lambda r: r.standard_normal((300, 24)),
    "few rows": lambda r: r.standard_normal((5, 24)),
    "low rank": lambda r: r.standard_normal((300, 4)) @ r.standard_normal((4, 24)),
    "equal values": lambda r: np.linalg.qr(r.standard_normal((300, 24)))[0],
    "close values": lambda r: np.linalg.qr(r.standard_normal((300, 24)))[0] * (1 + 1e-8 * np.arange(24)),
    "graded": lambda r: np.linalg.qr(r.standard_normal((300, 24)))[0] * 10.0 ** -(np.arange(24) / 4),
    "one column": lambda r: r.standard_normal((9, 1)),
    "constant": lambda r: np.ones((9, 6)),
}


@pytest.mark.parametrize("kind", MATRICES)
def test_bidiagonal_values_and_vectors(kind):
    a = MATRICES[kind](np.random.default_rng(2))
    a = a - a.mean(0)
    r = np.zeros((a.shape[1],) * 2)
    factor = np.linalg.qr(a, mode="r")
    r[: len(factor)] = factor
    values, vectors = bidiagonal.leading(r, 32)
    want = np.linalg.svd(r, compute_uv=False)
    want = want[want > 1e-12 * max(want[0], 1e-3)] ** 2
    assert len(values) == len(want)
    np.testing.assert_allclose(values, want, rtol=1e-10)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-11)
    np.testing.assert_allclose(r.T @ r @ vectors, vectors * values, atol=1e-12 * max(1, *values, 1))


def plain_whitening(vectors, components):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    return [sum(int(d) ** 2 for d in row) for row in n * x - s], centred @ directions[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("parts", [1, 40])
def test_whitening_equals_eigenvectors(spark, parts):
    rnd = np.random.default_rng(4)
    good = (rnd.standard_normal((400, 12)) @ rnd.standard_normal((12, 12)) * 3).astype(np.float32)
    rows = [(i, v.tolist(), "x", 0.5) for i, v in enumerate(good)]
    rows += [(900, None, "x", 0.5), (901, [float("nan")] * 12, "x", 0.5), (902, [None] * 12, "x", 0.5), (903, [1.0] * 5, "x", 0.5), (904, [], "x", 0.5), (905, [1e30] * 12, "x", 0.5)]
    rows += [(None, good[3].tolist(), "x", 0.5), (7, good[7].tolist(), "x", 0.5)]
    kept = np.vstack((good, good[[3, 7]]))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, x double").repartition(parts)
    out = whitening.whitened_components(table, 8).collect()
    deviation, whitened, explained = plain_whitening(kept, 8)
    ids = [*range(400), None, 7]
    assert len(out) == len(kept) * 8 and {r.n for r in out} == {len(kept)}
    assert collections.Counter((r.id, r.deviation) for r in out if r.component == 1) == collections.Counter(zip(ids, deviation, strict=True))
    by = {(r.id, r.component): r for r in out}
    for c in range(8):
        mine = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ whitened[:, c])
        np.testing.assert_allclose(mine * sign, whitened[:, c], atol=1e-9)
        assert by[0, c + 1].explained == pytest.approx(explained[c], rel=1e-9)
    error = {r.identity_error for r in out}
    mine = np.array([[by[i, c + 1].whitened for c in range(8)] for i in ids])
    assert len(error) == 1 and error.pop() == pytest.approx(np.abs(np.cov(mine.T, bias=True) - np.eye(8)).max(), abs=1e-12)


def test_whitening_without_variance_or_rows(spark):
    table = spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whitened_components(table).count() == 0
    assert whitening.whitened_components(table.where("false")).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    out = whitening.whitened_components(line).collect()
    assert {r.component for r in out} == {1} and out[0].explained == pytest.approx(1.0) and out[0].identity_error < 1e-12


def test_deviations_stay_exact():
    x = np.array([[1 << 40, 5], [3, 9]], np.int64)
    n, sums = 7, np.array([(1 << 41) + 3, 14])
    whole, rest = sums // n, sums % n
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    assert whitening._deviations(x, n, whole, rest) == [v if v < 1 << 63 else None for v in exact]
    assert whitening._deviations(np.array([[3, 9]]), n, np.array([1, 2]), np.array([3, 0])) == [(21 - 10) ** 2 + (63 - 14) ** 2]


def test_infilling_query_reads_whole_texts(spark):
    rows = queries.QUERIES["op13_fill_middle"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
