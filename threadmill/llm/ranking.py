"""One ranking from differently scaled scores: median rank aggregation.

Every item gets its rank in each score, so no score rules by its range. Items
are ordered by the weighted median of their ranks, then by the mean, then by
identifier. Equal values share the rank 1 + number of strictly better items, so
an item that is better somewhere and worse nowhere has no larger median and a
smaller mean, and stands strictly higher.

Ranks are found without a global window: values are counted first, the distinct
values are range-partitioned, and a rank is the count before the partition plus
the count before the value within it. Values that many items share are joined by
broadcast (fewer than HOT_SHARE of them can exist), the others by shuffle.

Cases: a missing or NaN score is the worst, all missing ones tie. Rows without a
key are no items. Of a key's rows the one with the largest user_turns counts
(missing is smallest), then the latest export, then the larger scores. Extra
columns are ignored. An empty table gives an empty ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.operators.incremental import record_key
from threadmill.session import cut

#: score -> (weight, whether more is better)
SCORES = {"authored_words": (1.0, True), "own_voice_words": (1.0, True), "max_user_turn_words": (1.0, True), "code_ratio": (1.0, False)}
#: A value held by more than this share of the items is hot: at most 1 / HOT_SHARE of them per score.
HOT_SHARE = 1 / 500


def current_rows(index: DataFrame, scores: dict = SCORES) -> DataFrame:
    """One row per key: rec_key and the scores as doubles."""
    fields = [F.col(s).cast("double").alias(s) for s in scores]
    newest = F.max(F.struct(F.col("user_turns").cast("long"), F.col("exported_at"), *fields)).alias("r")
    return index.select(record_key().alias("rec_key"), "user_turns", "exported_at", *scores).where("rec_key is not null").groupBy("rec_key").agg(newest).select("rec_key", *[f"r.{s}" for s in scores])


def ranks(items: DataFrame, scores: dict = SCORES) -> DataFrame:
    """(rec_key, score, rank) of every item in every score."""

    def badness(s: str, more: bool) -> Column:
        value = F.when(F.isnan(s), None).otherwise(F.col(s))
        return F.coalesce((-value if more else value) + F.lit(0.0), F.lit(float("inf")))

    long = items.select("rec_key", F.explode(F.array(*[F.struct(F.lit(s).alias("score"), badness(s, more).alias("badness")) for s, (_, more) in scores.items()])).alias("x")).select("rec_key", "x.*")
    counts = long.groupBy("score", "badness").agg(F.count("*").alias("n"))
    ranged = cut(counts.repartitionByRange("score", "badness").withColumn("part", F.spark_partition_id()))
    # one row for each score and partition
    totals = ranged.groupBy("score", "part").agg(F.sum("n").alias("n"))
    before = totals.select("score", "part", (F.sum("n").over(Window.partitionBy("score").orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("score")).alias("items"))
    inside = Window.partitionBy("score", "part").orderBy("badness")
    ranked = ranged.withColumn("within", F.sum("n").over(inside) - F.col("n")).join(F.broadcast(before), ["score", "part"])
    ranked = ranked.select("score", "badness", (F.col("before") + F.col("within") + 1).alias("rank"), (F.col("n") > F.col("items") * HOT_SHARE).alias("hot"))
    hot = F.broadcast(ranked.where("hot").select("score", "badness", F.col("rank").alias("hot_rank")))
    first = long.join(hot, ["score", "badness"], "left")
    rest = first.where("hot_rank is null").drop("hot_rank").join(ranked.where("not hot"), ["score", "badness"])
    return first.where("hot_rank is not null").select("rec_key", "score", F.col("hot_rank").alias("rank")).unionByName(rest.select("rec_key", "score", "rank"))


def weighted_median(pairs: Column) -> Column:
    """Of an array of (rank, weight): mean of the lower and the upper weighted median."""
    ordered = F.array_sort(pairs)
    half = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x["weight"]) / 2
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))

    def step(a: Column, x: Column) -> Column:
        total = a["sum"] + x["weight"]
        rank = x["rank"].cast("double")
        return F.struct(total.alias("sum"), F.coalesce(a["low"], F.when(total >= half, rank)).alias("low"), F.coalesce(a["high"], F.when(total > half, rank)).alias("high"))

    return F.aggregate(ordered, start, step, lambda a: (a["low"] + F.coalesce(a["high"], a["low"])) / 2)


def aggregate(index: DataFrame, scores: dict = SCORES) -> DataFrame:
    """(rec_key, median_rank, mean_rank): smaller is better."""
    weight = F.create_map(*[x for s, (w, _) in scores.items() for x in (F.lit(s), F.lit(float(w)))])
    pairs = ranks(current_rows(index, scores), scores).withColumn("weight", weight[F.col("score")])
    by = pairs.groupBy("rec_key").agg(F.collect_list(F.struct("rank", "weight")).alias("pairs"), (F.sum(F.col("rank") * F.col("weight")) / F.sum("weight")).alias("mean_rank"))
    return by.select("rec_key", weighted_median(F.col("pairs")).alias("median_rank"), "mean_rank")


def top(index: DataFrame, n: int = 10, scores: dict = SCORES) -> DataFrame:
    return aggregate(index, scores).orderBy("median_rank", "mean_rank", "rec_key").limit(n)
