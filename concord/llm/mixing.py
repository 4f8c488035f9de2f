"""Mixing sources to target weights by Pareto order sampling (DataFrame operations only).

Every source gets a target number of words.  A document's expected copies are target / source size (times its
relative importance where one is given); the whole part is taken for certain, and the fractional part is the
inclusion odds of one more copy.  Documents of a source are ranked by

    (u / (1 - u)) / (p / (1 - p)),     u random in (0, 1) from the id, p the inclusion probability

and the head of that order is taken, as many as bring the source's words nearest to its target.

Edge cases: NULL text has size 0 and takes 0 words; NULL sources are one source, ranked last; NULL ids are mixed
like any other id (they share one random number); repeated rows and ties are ordered by id and size, and rows equal
in both are interchangeable; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of, unit_hash, word_count

#: Bins of the sampling order per source: only one bin of a source is ever sorted row by row.
BINS = 65_536
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   limit: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code point order, NULL last, get the weights in turn.  The targets share ``share`` times all sizes by
    weight; none exceeds ``limit`` times its source's size, the excess going to the others by weight.  That is
    least(limit * size, theta * weight) for the one theta that makes the total right: with sources ordered by
    limit * size / weight, theta is what remains at the first source that stays below its limit.
    The window runs over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "rank")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("rank", F.row_number().over(by_name))
         .withColumn("weight", F.element_at(w, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(limit)))
         .withColumn("room", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("weights", F.sum("weight").over(everything))
         .withColumn("pos", F.row_number().over(by_room))
         .withColumn("theta", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("below", F.col("theta") * F.col("weight") <= F.col("cap"))
         .withColumn("theta", F.min_by(F.when(F.col("below"), F.col("theta")),
                                       F.when(F.col("below"), F.col("pos"))).over(everything)))
    # every source is at its limit when the limit leaves less room than the mix asks for
    target = F.coalesce(F.least(F.col("cap"), F.col("theta") * F.col("weight")), F.col("cap"))
    return s.select("source", "source_size", target.alias("target"))


def expected_copies(sizes: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """(source, scale, full_from): a document expects importance * scale copies, or ``limit`` where its importance is
    at least ``full_from``.  Each round fixes the documents that would exceed the limit and reshares the rest."""
    state = targets.withColumn("full_from", F.lit(float("inf")))
    while True:
        rows = sizes.join(state, sizes["source"].eqNullSafe(state["source"]))
        full = F.col("importance") >= F.col("full_from")
        sums = (rows.groupBy(state["source"], "target", "full_from")
                .agg(F.sum(F.when(full, F.col("size") * F.lit(limit)).otherwise(0.0)).alias("fixed"),
                     F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("importance"))).alias("mass"),
                     F.max(F.when(~full & (F.col("size") > 0), F.col("importance"))).alias("top"))
                .withColumn("scale", F.when(F.col("mass") > 0, (F.col("target") - F.col("fixed")) / F.col("mass"))
                            .otherwise(0.0))
                .withColumn("over", F.coalesce(F.col("top") * F.col("scale") > limit, F.lit(False))))
        sums = materialize(sums.select("source", "target", "full_from", "scale", "over"), "mix-copies")
        if sums.filter("over").isEmpty():
            return sums.select("source", "scale", "full_from")
        state = sums.select("source", "target", F.when(F.col("over"), F.lit(limit) / F.col("scale"))
                            .otherwise(F.col("full_from")).alias("full_from"))


def pareto_mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
               weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
               importance: Column | None = None, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, probability (of the last copy), copies and taken words per row.

    ``importance`` (a positive expression on ``docs``) makes the expected copies unequal within a source.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       word_count(text_of(text)).alias("size"),
                       (F.lit(1.0) if importance is None else importance.cast("double")).alias("importance"))
    rows = materialize(rows, "mix-sizes")
    targets = materialize(source_targets(rows, weights, share, limit), "mix-targets")

    def with_source(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnRenamed("source", "_source")
        return left.join(r, left["source"].eqNullSafe(r["_source"])).drop("_source")

    if importance is None:
        copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        rows = with_source(rows, targets)
    else:
        rows = with_source(with_source(rows, targets), expected_copies(rows, targets, limit))
        copies = F.when(F.col("importance") >= F.col("full_from"), F.lit(limit)).otherwise(
            F.col("importance") * F.col("scale"))
    u = F.col("u")
    p = F.col("probability")
    rows = (rows.withColumn("expected", F.least(copies, F.lit(limit)))
            .withColumn("whole", F.floor("expected"))
            .withColumn("probability", F.col("expected") - F.col("whole"))
            .withColumn("u", unit_hash(seed, F.col("doc_id")))
            .withColumn("q", F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) * ((1 - p) / p)))
            .withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS))
            .select("doc_id", "source", "size", "source_size", "target", "probability", "whole", "q", "bin"))
    # what the whole copies leave, and the bin of the order in which that is used up
    by_bin = (rows.groupBy("source", "target", "bin")
              .agg(F.sum(F.col("whole") * F.col("size")).alias("fixed"),
                   F.sum(F.when(F.col("q").isNotNull(), F.col("size")).otherwise(0)).alias("words")))
    order = Window.partitionBy("source").orderBy(F.col("bin").asc_nulls_first())
    cross = (by_bin.withColumn("rest", F.col("target") - F.sum("fixed").over(Window.partitionBy("source")))
             .withColumn("upto", F.sum("words").over(order))
             .filter("bin is not null and upto > rest")
             .groupBy("source").agg(F.min("bin").alias("cross"),
                                    F.min_by(F.col("rest") - (F.col("upto") - F.col("words")), "bin").alias("room")))
    cross = cross.withColumnRenamed("source", "_source")
    rows = rows.join(cross, rows["source"].eqNullSafe(cross["_source"]), "left").drop("_source")
    inside = F.col("bin") == F.col("cross")
    # only rows of the crossing bin share a window; all others get one of their own by their (source, bin)
    edge = (rows.filter(inside)
            .withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("q", "doc_id", "size")
                                                   .rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("extra", (F.col("upto") - F.col("size") / 2 <= F.col("room")).cast("int")).drop("upto"))
    sure = (rows.filter(~F.coalesce(inside, F.lit(False)))
            .withColumn("extra", (F.col("q").isNotNull()
                                  & (F.col("cross").isNull() | (F.col("bin") < F.col("cross")))).cast("int")))
    out = sure.unionByName(edge)
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "probability", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))
