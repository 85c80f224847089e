"""Mix sources to target weights by repeating whole documents.

Tokens are summed per source, every source gets a target, and a document of a source with
rate ``target / source_size`` is emitted ``floor(rate)`` times plus one further time when a
hash of (seed, document id) falls below the fractional part. Nothing is drawn at random, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import count_words, materialise

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` for a frame with ``source, size``.

    Sources are ordered by code point (null last) and weigh ``weights`` in turn. They share the
    sum of all sizes by weight; a target stops at ``max_repeat`` times its source's size and the
    excess goes to the others by weight until none is above. The source table stays distributed:
    ranks come from a range sort and per-partition offsets, and each resharing round sends two
    sums to the driver. The caps are compared in whole numbers. An empty table gives no rows.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = materialise(
        by_source.orderBy(F.col("source").isNull(), "source").withColumn("pos", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("pos", 33)
    offsets = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # one row per partition of the sort
    before = offsets.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    rank = F.col("before") + F.col("pos") - F.shiftleft(F.col("part"), 33)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = materialise(
        ordered.withColumn("part", part).join(F.broadcast(before), "part")
        .select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_repeat).alias("cap")),
        "weights")

    whole = lambda c: c.cast("decimal(38,0)")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, share = total, None
    capped, n_capped = F.lit(False), -1
    while True:
        row = ranked.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("taken"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0)).alias("share"),
            F.sum(capped.cast("long")).alias("n"),
        ).first()
        if (row["n"] or 0) == n_capped or not row["share"]:
            break
        n_capped, left, share = row["n"], total - row["taken"], row["share"]
        capped = whole(F.col("weight") * F.lit(left)) > whole(F.col("cap")) * F.lit(share).cast("decimal(19,0)")
    own = (F.col("weight").cast("double") * F.lit(float(left))) / F.lit(float(share or 1))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(own) if share else F.col("cap").cast("double")
    return ranked.select("source", "source_size", target.alias("target"))


def copies(doc_id, rate, seed: str):
    """floor(rate) copies, and one more when the keyed hash of the id is below the fraction."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    u = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return F.floor(rate).cast("int") + (u < rate - F.floor(rate)).cast("int")


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, max_repeat: int = MAX_REPEAT, carry: bool = False) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, copies, taken`` (and with ``carry`` its row).

    Null text has size 0. A source without words has target 0 and its documents no copies. Rows
    that repeat an id share that id's draw. Further columns of ``docs`` take no part.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), *row)
    sized = materialise(sized, "sized")
    targets = source_targets(sized, weights, max_repeat)
    # null is a source like any other; a hot source is split by adaptive execution
    joined = sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return joined.withColumn("copies", copies(F.col("doc_id"), rate, seed)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        *(["row"] if carry else []))


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    return (mix(docs, seed, carry=True).where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
