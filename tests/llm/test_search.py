"""Exact and approximate search, against brute force."""

import numpy as np
import pandas as pd

from tickweave.llm import ann_search, topk_search

NAN, INF = float("nan"), float("inf")
KIND = "vec_id long, embedding array<float>, label int, id long"


def vectors(spark, n=600, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=(n, dim)), 2)
    v[5] = v[6]  # ties
    rows = [(i, v[i].tolist(), 0, 7) for i in range(n)]
    rows += [(10_001, None, 0, 0), (10_002, [None] * dim, 0, 0), (10_003, [NAN] * dim, 0, 0), (10_004, [INF] * dim, 0, 0), (None, v[0].tolist(), 0, 0), (3, v[3].tolist(), 0, 0)]
    return spark.createDataFrame(rows, KIND), v.astype(np.float32).astype(float)


def ranked(scores, own, k):
    order = [i for i in np.lexsort((np.arange(len(scores)), -scores)) if i != own][:k]
    return [(i, scores[i]) for i in order]


def test_exact_top_k(spark):
    df, v = vectors(spark)
    w = np.floor(v * 256).astype(np.int64)
    got = {}
    q = topk_search.quantised(df)
    for r in topk_search.top_k(q.where("id % 50 = 0"), q, 5, block_rows=100, group_rows=5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    assert got == {i: ranked(w @ w[i], i, 5) for i in range(0, 600, 50)}


def test_exact_top_k_of_few_and_none(spark):
    df, _ = vectors(spark)
    q = topk_search.quantised(df.where("vec_id in (0, 1, 2)"))
    assert topk_search.top_k(q.where("id = 0"), q, 5).count() == 2
    none = topk_search.quantised(df.where("false"))
    assert topk_search.top_k(none, none, 5).count() == 0


def test_sparse_rows_score_only_common_terms(spark):
    rows = spark.createDataFrame([(1, [0, 5], [2, 3]), (2, [5, 9], [10, 1]), (3, [], []), (4, [0], [-4])], "id long, terms array<int>, weights array<bigint>")
    got = [(r.id, r.score) for r in topk_search.top_k(rows.where("id = 1"), rows, 3).orderBy("rank").collect()]
    assert got == [(2, 30), (3, 0), (4, -8)]


def test_ann_finds_at_least_nine_in_ten(spark):
    df, v = vectors(spark, 3000, 24)
    u = ann_search.usable(df)
    found = ann_search.search(u.where("id % 20 = 0"), u, 20, ann_search.build_index(u, list_rows=40), cell_rows=64, cell_queries=8).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    right = 0
    for q in range(0, 3000, 20):
        scores = np.zeros(3000)
        for d in range(24):
            scores += v[:, d] * v[q, d]
        want = ranked(scores, q, 20)
        assert len(got[q]) == 20 and all(scores[i] == s for i, s in got[q])
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        right += len(set(want) & set(got[q]))
    assert right >= 0.9 * 150 * 20


def test_ann_of_few_and_none(spark):
    df, _ = vectors(spark)
    zero = spark.createDataFrame([(50, [0.0] * 8, 0, 0)], KIND)
    u = ann_search.usable(df.where("vec_id between 0 and 4").unionByName(zero))
    assert ann_search.search(u.where("id = 0"), u, 20, ann_search.build_index(u)).count() == 4
    none = ann_search.usable(df.where("false"))
    assert ann_search.search(none, none, 20, ann_search.build_index(none)).count() == 0


def test_vectors_of_another_length_take_no_part(spark):
    rows = [(i, [float(i % 7), float(i), 1.0]) for i in range(30)] + [(100 + i, [1.0]) for i in range(20)]
    u = ann_search.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = ann_search.search(u.where("id = 0"), u, 5, ann_search.build_index(u)).collect()
    assert len(found) == 5 and all(r.id < 30 for r in found)


def test_ann_searches_as_many_lists_as_the_vectors_need(spark):
    """Tight groups of five: most of the twenty nearest lie in lists far beyond the nearest one."""
    rng = np.random.default_rng(3)
    v = np.repeat(rng.normal(size=(600, 24)), 5, axis=0) + 0.02 * rng.normal(size=(3000, 24))
    v = v[rng.permutation(3000)]
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32).astype(float)
    u = ann_search.usable(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"))
    found = ann_search.search(u.where("id % 20 = 0"), u, 20, ann_search.build_index(u, list_rows=10)).collect()
    right = 0
    for q in range(0, 3000, 20):
        right += len({i for i, _ in ranked(v @ v[q], q, 20)} & {r.id for r in found if r.query_id == q})
    assert right >= 0.9 * 150 * 20


def test_ann_cell_returns_only_what_can_be_among_the_best():
    """A cell's rows follow the answers: none worse than the query's floor, a vector in several lists once."""
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(size=(500, 6)), 1)
    v[40:60] = v[39]  # ties at a floor go on by id
    places = [(int(i), int(x)) for i in range(500) for x in {i % 25, 0 if i % 10 == 0 else i % 25}]
    vectors = pd.DataFrame({"list": [x for _, x in places], "id": [i for i, _ in places], "v": [v[i] for i, _ in places]})
    lists = [np.arange(25), np.arange(0, 25, 2)]
    floors = [(-np.inf, -1), ranked(v @ v[1], 1, 30)[-1][::-1]]
    queries = pd.DataFrame({"id": [0, 1], "v": [v[0], v[1]], "lists": lists, "floor": [f for f, _ in floors], "floor_id": [i for _, i in floors]})
    got = ann_search._cell(queries, vectors, 20, 25)
    for query, searched, (floor, last) in zip((0, 1), lists, floors, strict=True):
        held = sorted({i for i, x in places if x in searched and i != query})
        scores = ann_search.exact_products(v[held], v[query])
        order = np.lexsort((held, -scores))[:20]
        want = [(held[i], scores[i]) for i in order if scores[i] > floor or (scores[i] == floor and held[i] <= last)]
        rows = got[got["query_id"] == query]
        assert list(zip(rows["id"], rows["score"], strict=True)) == want
    assert len(got[got["query_id"] == 1]) < 20


def test_ann_floors_and_shelves_lose_nothing(spark):
    """With every list searched the result is exact, over several samples and shelves and many copies of one vector."""
    rng = np.random.default_rng(6)
    v = np.round(rng.normal(size=(1500, 8)), 1)
    v[100:400] = v[100]
    u = ann_search.usable(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    found = ann_search.search(u.where("id % 100 = 0"), u, 20, ann_search.build_index(u, list_rows=30), recall=2.0, cell_rows=32, cell_queries=8).collect()
    for q in range(0, 1500, 100):
        got = [(r.id, r.score) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])]
        assert got == ranked(ann_search.exact_products(v, v[q]), q, 20)
