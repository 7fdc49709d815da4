"""The n-gram Jaccard join, against all pairs."""

import random

import numpy as np
import pyarrow as pa

from tickweave.llm import common, jaccard_join

from .conftest import shingles


def brute(rows, percent=75):
    sets = {i: shingles(t) for i, t in rows}
    head = {i: i for i in sets}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df):
    return {r.id: (r.n_shingles, r.component_id) for r in df.collect() if r.id is not None}


def edited(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words]


def test_random_copies_and_passages(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(800)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(40):
        text = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 9, 15, 40, 120, 400)))]
        rows.append(text)
        for share in (0.0, 0.01, 0.03, 0.05, 0.1)[: rng.randrange(6)]:
            rows.append(edited(rng, text, share))
        if rng.random() < 0.5:
            rows.append(text[: int(len(text) * 0.8)])
    rows += [passage + [rng.choice(vocabulary) for _ in range(25)] for _ in range(30)]
    original = [rng.choice(vocabulary) for _ in range(150)]
    rows += [edited(rng, original, rng.choice((0.01, 0.03, 0.06))) for _ in range(60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(jaccard_join.near_duplicate_components(df)) == brute(rows)


def test_lower_similarity(spark):
    rng = random.Random(6)
    texts = [[f"v{rng.randrange(300)}" for _ in range(80)] for _ in range(10)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts + [edited(rng, t, 0.05) for t in texts])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard_join.near_duplicate_components(df, percent=50)) == brute(rows, 50)


def test_edge_cases(spark, documents):
    got = jaccard_join.near_duplicate_components(documents)
    assert got.count() == documents.count()
    rows = [(r.doc_id, r.text) for r in documents.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    assert found(got) == brute(rows)
    assert [r.component_id for r in got.where("id is null").collect()] == [None]


def test_empty_and_wordless(spark, nothing):
    assert jaccard_join.near_duplicate_components(nothing).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert found(jaccard_join.near_duplicate_components(blank)) == {1: (0, 1), 2: (0, 2)}


def test_one_id_with_two_texts_ties_them(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (7, a), (9, b)], "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.near_duplicate_components(df).collect()} == {5}


def test_too_few_segments_fall_back_to_deletions(monkeypatch, spark):
    """With four segments no set fills enough, so all links come from one-deletion tokens or shingles."""
    monkeypatch.setattr(jaccard_join, "segments_of", lambda band: np.full(len(band), 4))
    scheme = jaccard_join.Scheme(75)
    texts = [" ".join(f"w{i}" for i in range(24)), " ".join(f"w{i}" for i in range(23))]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    packed = pa.Table.from_batches(list(jaccard_join.emit_tokens(iter([batch]), "text", 5, scheme, 1)))
    tokens = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in packed["tokens"]])
    assert (tokens & 3 == 2).any()
    shared = jaccard_join.shared_tokens(packed, 1)
    assert sum(len(x.as_py()) for x in shared["sids"]) > 0


def test_words_and_hashes_do_not_depend_on_chunks():
    texts = ["Ab c", "", "c  ab\x0bAB", "é ß x", "a" * 9000 + " ab"]
    one = common.words_of(common.texts_of(pa.array(texts)))
    each = [common.words_of(common.texts_of(pa.array([t]))).hashes.tolist() for t in texts]
    assert one.hashes.tolist() == [h for x in each for h in x]
    assert np.diff(one.first).tolist() == [2, 0, 3, 3, 2]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
