"""The dealt operators applied to whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_search, fill_middle, jaccard_join, language_id, license_scan, lm_scoring, mixing, secret_scan, sentence_pieces, sharding, topk_search, warc, whitening
from .common import materialise, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


@query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    out = jaccard_join.near_duplicate_components(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op1_exact_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk_search.quantised(table(spark, folder, "embeddings"))
    found = topk_search.top_k(vectors.where("id % 50 = 0"), vectors, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op2_mix_sources", """
WITH d AS (
    SELECT doc_id, source, size, -ln(u) / CASE WHEN size = 0 OR length(text) / size BETWEEN 4 AND 11 THEN 1.0 ELSE 0.25 END AS key
    FROM (SELECT *, COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                 (CAST('0x' || substr(md5('0' || chr(31) || COALESCE(doc_id::VARCHAR, chr(30)) || chr(31) || COALESCE(md5(text), chr(30))), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
          FROM documents)),
s AS (
    SELECT source, sum(size)::DOUBLE AS n, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS w
    FROM d GROUP BY source),
c AS (SELECT *, 2 * n AS cap, sum(n) OVER () * 1.5 AS total FROM s),
l AS (
    SELECT *, (total - COALESCE(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM c WINDOW o AS (ORDER BY cap / w, source IS NULL, source)),
t AS (
    SELECT source, n::BIGINT AS n, least(cap, COALESCE((SELECT max(level) FROM l WHERE cap > level * w) * w, cap)) AS target FROM l),
e AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 1 END AS epochs FROM t),
r AS (
    SELECT d.doc_id, d.size, e.n, e.target, e.epochs, floor(e.target)::BIGINT - e.epochs * e.n
           - COALESCE(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, n AS source_size, target, (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM r""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    quality = mixing.word_length_quality(docs["text"], mixing.word_count(docs["text"]))
    return mixing.mix_sources(docs, quality=quality).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op10_secret_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS)),
        F.sha2(secret_scan.rendered(F.col("spans"), secret_scan.KINDS[:3]), 256).alias("base_sha256"),
        secret_scan.rendered(F.col("spans")).alias("spans"),
        live.alias("n_live"),
    )


def fold(count: int, column: str = "doc_id"):
    """The remainder that deals documents to folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(count))


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.train(docs, use=fold(4) != 2)
    out = language_id.annotate(docs.select("doc_id", "text", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")), model, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "entropy", "accepted")


@query("op3_arc_to_warc", """
WITH p AS (
    SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha256(COALESCE(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lead FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> lead THEN lead END AS refers_to
FROM m""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    arcs, warcs = warc.new_folder(spark, "arc"), warc.new_folder(spark, "warc")
    warc.write_arc(table(spark, folder, "pages"), arcs)
    warc.convert(spark, arcs, warcs)
    return warc.read_warc(spark, warcs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_ann_posting_lists")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    vectors = materialise(ann_search.usable(table(spark, folder, "embeddings")))
    found = ann_search.search(vectors.where("id % 20 = 0"), vectors, 20, ann_search.build_index(vectors))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op8_lm_scoring")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    held = F.coalesce(fold(5) == 1, F.lit(False))
    out = lm_scoring.score(table(spark, folder, "documents"), fold(5) != 1, tag=held)
    return out.select(F.col("id").alias("doc_id"), F.col("row_tag").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def piece_vocabulary(path: str | None = None) -> sentence_pieces.Vocabulary:
    """The vocabulary of a model file; without a path, of the installed public 32k model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return sentence_pieces.Vocabulary.load(path)


@query("op7_sentencepiece")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.encode(table(spark, folder, "documents"), piece_vocabulary(), keep=["doc_id"])


@query("op9_license_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = license_scan.scan(docs, license_scan.train(docs))
    families = F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"])))
    spans = F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"], n["end"])), ",")
    return found.select(F.col("id").alias("doc_id"), "n_paragraphs", F.size("notices").cast("long").alias("n_notices"), F.array_join(families, ",").alias("families"), spans.alias("spans"))


@query("op11_whiten")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op12_shard_groups")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), 16)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op13_fill_middle", """
WITH d AS (
    SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n, sha256('1:' || COALESCE(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (
    SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
           ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS e FROM d),
f AS (
    SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) AS q,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM g)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (q - p)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substr(t, 1, p) || '<S>' || substr(t, q + 1) || '<M>' || substr(t, p + 1, q - p)
              ELSE '<S>' || substr(t, q + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, q - p) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    out = fill_middle.transform(table(spark, folder, "documents"))
    digest = lambda c: F.sha2(c, 256)
    return out.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored("output", "form")).alias("restored_sha256"),
    )
