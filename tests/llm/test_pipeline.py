"""The stages of the pipeline, on small inputs, against what they must keep."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from .conftest import shingles


def test_stages_keep_columns_and_clean_documents(spark, documents, tmp_path):
    docs, kept = documents, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, "/nowhere")
        if name != "tokens":
            assert out.columns == documents.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
    ids = lambda name: sorted((r.doc_id for r in kept[name].select("doc_id").collect()), key=str)
    assert not {5, 6, 7} & set(ids("language_id"))
    rows = kept["language_id"].collect()
    assert len(ids("near_duplicates")) == len(set(ids("near_duplicates"))) and not {2, 3} & set(ids("near_duplicates")) and 1 in ids("near_duplicates") and None not in ids("near_duplicates")
    sets = [shingles(r.text) for r in kept["near_duplicates"].where("doc_id is not null").collect()]
    assert all(4 * len(a & b) < 3 * len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :])
    assert len(rows) >= len(ids("near_duplicates")) == kept["secrets"].count()
    assert "[SECRET]" in kept["secrets"].where("doc_id = 12").first().text
    assert set(ids("mixing")) <= set(ids("secrets")) and kept["tokens"].count() == kept["mixing"].count()


def test_stages_on_an_empty_table(spark, nothing):
    docs = nothing
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, "/nowhere")
        assert docs.count() == 0, name


def test_run_keeps_all_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert pipeline.identify_language(spark, docs, folder).count() == docs.count()
    out = pipeline.run(spark, folder)
    assert out.where("not round_trip").count() == 0 and out.count() > 0


def test_repeated_and_null_ids_neither_merge_nor_drop_texts(spark):
    text = lambda name, last="end": " ".join([*(f"{name}{i}" for i in range(80)), last])
    rows = [(7, text("a")), (7, text("b")), (9, text("a", "fin")), (10, text("b", "fin")), (11, text("c")), (11, text("d")), (None, text("e")), (None, text("e")), (None, text("e", "fin")), (None, None), (None, None), (None, ""), (12, text("d")), (3, text("f", "x")), (3, text("f", "w"))]
    df = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = sorted(((r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, df.repartition(3), "/nowhere").collect()), key=str)
    want = [(7, text("a")), (7, text("b")), (11, text("c")), (11, text("d")), (None, text("e")), (None, None), (None, None), (None, ""), (3, text("f", "w"))]
    assert got == sorted(want, key=str)


def test_mixing_takes_clean_texts_before_junk(spark):
    rows = [(i, "ein klarer Satz über Flüsse." if i % 2 else "a### b%%% c*** d$$$ e&&& f!!", "de", f"s{i // 2 % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = {r.odd: r["count"] for r in pipeline.mix_sources(spark, df, "/nowhere").groupBy((F.col("doc_id") % 2).alias("odd")).count().collect()}
    assert taken[1] > 1.1 * taken[0]
