"""Mixing sources to target weights by weighted sampling with exponential keys.

DataFrame expressions only. Sources share a total by weight; a target stops at ``most`` times
its source's size and the excess goes to the others by weight (water filling). A source then
takes whole epochs of all its documents, and for the remaining budget documents by
Efraimidis-Spirakis keys: an exponential variable, made from a hash of the document, divided
by the document's quality weight; the smallest keys are taken until their sizes fill the
budget, the last one in part.

A source may hold any share of the rows: keys fall into bins of equal ratio, ``bins`` to a
doubling, sizes are summed by bin (combined before the shuffle), and only the rows of the one bin
per source in which the budget ends are sorted. An exponential variable of any rate has less
than a ``1 / (3.9 * bins)`` share of its values in such a bin, so weights do not crowd rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise

#: Sources whose goals are sent to every task; beyond that they are joined by shuffling.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Words in a text: ``WORD`` matches; null has none.

    Every maximal run is first made one letter, then letters are counted, which spares an
    array of all words of a long text.
    """
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "w"), r"[\x20\x09-\x0D]", "")), F.lit(0)).cast("long")


def uniform(*keys: Column) -> Column:
    """A number in (0, 1) with 52 random bits, the same for the same keys everywhere."""
    name = F.concat_ws("\x1f", *(F.coalesce(k.cast("string"), F.lit("\x1e")) for k in keys))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def text_quality(text: Column) -> Column:
    """A weight from 0.05 to 1: the eighth power of the share of letters and white space in a text.

    Prose with its punctuation weighs about 0.8; a text with a quarter of marks and digits, as
    in symbol noise, tables of numbers and markup, 0.1. Empty and null texts weigh 1.
    """
    share = F.length(F.regexp_replace(text, r"[^\p{L}\p{M}\s]+", "")) / F.length(text)
    return F.when(F.length(text) > 0, F.greatest(F.lit(0.05), F.pow(share, F.lit(8)))).otherwise(1.0)


def word_length_quality(text: Column, size: Column) -> Column:
    """A weight from the mean room of a word, its gap included: 1 from 4 to 11 code points, else 0.25.

    Prose lies well inside; lists of marks or numbers and texts without gaps lie outside. A text
    without words weighs 1. It costs a length, so a whole corpus can be weighed by it.
    """
    room = F.length(text) / size
    return F.when(size == 0, 1.0).when(room.between(4.0, 11.0), 1.0).otherwise(0.25)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) of rows (source, size).

    Sources rank by code point, null last, and weigh ``weights`` in turn. The targets sum to
    ``share`` of all sizes where that is below ``most`` of them. Filling order: source ``i`` is
    capped exactly if its cap divided by its weight is at most the level at which what is
    left over is shared out. One row per source meets in one task; sources are a vocabulary.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    s = s.withColumn("total", F.sum("source_size").over(W.partitionBy()) * float(share))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", (F.col("total") - before) / behind)
    s = s.withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    # All from the first open source on share the level there, the highest of theirs.
    level = F.max(F.when(F.col("open"), F.col("level"))).over(W.partitionBy())
    return s.select("source", "source_size", F.least("cap", F.coalesce(level * F.col("weight"), "cap")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None, seed: int = 0, bins: int = 256, carry: bool = False, **targets) -> DataFrame:
    """One row per row of ``docs``: id, source, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``taken`` counts the words that the mix takes of the document, ``copies`` how often it is
    taken whole (the one that ends the budget counts if at least half of it fits). ``quality``
    weighs documents within their source (null or not positive: 1). Null texts have size 0
    and are taken with their epochs; rows that repeat an id are documents of their own, those with the
    same text have equal keys; a null source is a source, an empty table gives no rows, other columns
    are not looked at, whatever they are called. The result depends on the rows alone. With ``carry`` the columns
    of ``docs`` come as one struct ``row``; they are shuffled only where a budget ends.
    """
    q = F.lit(1.0) if quality is None else F.when(quality > 0, quality.cast("double")).otherwise(1.0)
    # With the text in the key, rows without or with repeated ids do not meet in one bin.
    u = uniform(F.lit(seed), docs[id_col], F.md5(docs[text_col].cast("binary")))
    columns = [docs[id_col].alias("id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"), (-F.ln(u) / q).alias("key")]
    in_bin = F.floor(F.log2("key") * bins).cast("int")
    rows = materialise(docs.select(*columns).withColumn("bin", in_bin))
    goals = source_targets(rows, **targets)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("budget", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size"))
    filled = rows.groupBy("source", "bin").agg(F.sum("size").alias("s"))
    upto = F.sum("s").over(W.partitionBy("source").orderBy("bin"))
    filled = filled.withColumn("upto", upto).withColumnRenamed("source", "at")
    ends = filled.join(goals.select(F.col("source").alias("goal_source"), "budget"), F.col("at").eqNullSafe(F.col("goal_source")))
    ends = ends.where("upto > budget").groupBy("at").agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("s")).alias("offset")), "bin").alias("end"))
    goals = goals.join(ends, F.col("source").eqNullSafe(F.col("at")), "left").select(F.col("source").alias("goal_source"), "source_size", "target", "epochs", "budget", "end")
    goals = materialise(goals)
    if goals.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        goals = F.broadcast(goals)
    if carry:
        rows = docs.select(*columns, F.struct(*docs.columns).alias("row")).withColumn("bin", in_bin)
    placed = rows.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    settled = placed.where("end is null or bin <> end.bin").withColumn("extra", F.when(F.col("end").isNull() | (F.col("bin") < F.col("end.bin")), F.col("size")).otherwise(F.lit(0)))
    ending = placed.where("bin = end.bin")
    order = W.partitionBy("source").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    room = F.col("budget") - F.col("end.offset") - F.coalesce(F.sum("size").over(order), F.lit(0))
    ending = ending.withColumn("extra", F.greatest(F.lit(0), F.least("size", room)))
    out = settled.unionByName(ending)
    whole = F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    more = ["row"] if carry else []
    return out.select(*more, "id", "source", "size", "source_size", "target", (F.col("epochs") + whole).cast("int").alias("copies"), (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken whole."""
    mixed = mix_sources(docs, carry=True, **options)
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
