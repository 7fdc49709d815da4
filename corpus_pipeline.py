"""From raw documents to tokens: five stages, each a function of (spark, docs, folder).

A stage works on all that the one before kept. All but the last return the columns of
``documents``. Python UDFs run in every stage but the mixing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import jaccard_join, language_id, mixing, queries, secret_scan, sentence_pieces
from tickweave.llm.common import free_name, materialise, small_batches, split_by_ids


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus is labelled with; texts that it rejects go.

    Without a letter, or with a cross-entropy beyond any held-out text's, a text is rejected.
    """
    small_batches(spark)
    return language_id.annotate(docs, language_id.train(docs), only_accepted=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near duplicates connect: the smallest id, then text.

    Texts are linked by a digest of their content, so rows that repeat an id stand for
    themselves. Documents without id come after all that have one. Documents without words stay.
    """
    small_batches(spark)
    key, of, group, row = (free_name(docs, n) for n in ("key", "of", "group", "row"))
    keyed = docs.withColumn(key, F.xxhash64("text"))
    found = materialise(jaccard_join.near_duplicate_components(keyed, key).where("n_shingles > 0"))
    groups = found.groupBy("component_id").count().where("count > 1").select("component_id")
    listed = found.join(groups, "component_id").select(F.col("id").alias(of), F.col("component_id").alias(group)).distinct()
    listed = materialise(listed)
    maybe, single = split_by_ids(keyed, listed, key, of)
    maybe = maybe.join(listed, maybe[key] == listed[of], "left")
    rest = maybe.where(F.col(group).isNull())
    # Aggregates combine a task's rows first, so a group may hold any share of the table.
    first = F.min_by(F.struct(*docs.columns), F.struct(F.isnull("doc_id"), "doc_id", "text", "source", "lang")).alias(row)
    first = maybe.where(F.col(group).isNotNull()).groupBy(group).agg(first).select(f"{row}.*")
    return single.select(*docs.columns).unionByName(rest.select(*docs.columns)).unionByName(first)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the values of live secrets replaced by a mark; widely copied examples stay."""
    small_batches(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them, clean texts before junk."""
    small_batches(spark)
    return mixing.mixed_documents(docs, quality=mixing.text_quality(F.col("text")))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    small_batches(spark)
    return sentence_pieces.encode(docs, queries.piece_vocabulary(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: SQL has no language models and piece tables; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
