"""Branch duplicates, score, topics, delta candidates and the shortlist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import patterns as P
from threadmill.functions import text as X
from threadmill.operators.incremental import record_key


def mark_branches(index: DataFrame, order: str = "file") -> DataFrame:
    """Adds branch_dup and branch_of: of a fork and its parent the one with fewer user words is a duplicate of the other.

    A fork's parent is the first other row, by ``order``, that has the title
    without the fork's prefix; titles are compared without case and outer space.
    At most two rows a title are kept before the join (limited before the
    shuffle), so a title that many rows share stays small. Null titles fork nothing.
    """
    title = F.lower(X.strip(F.coalesce("title", F.lit(""))))
    rows = index.drop("branch_dup", "branch_of").withColumn("_title", title)
    first = Window.partitionBy("_title").orderBy(order)
    parents = rows.withColumn("_k", F.row_number().over(first)).where("_k <= 2").select(F.col("_title").alias("p_title"), F.col(order).alias("p_file"), F.col("user_words").alias("p_words"), "_k")
    forks = rows.where(F.col("_title").rlike(f"(?i){P.BRANCH_TITLE}")).withColumn("p_title", F.lower(X.strip(F.regexp_replace("_title", f"(?i){P.BRANCH_TITLE}", ""))))
    pairs = forks.select(F.col(order).alias("fork"), F.col("user_words").alias("words"), "p_title").join(parents, "p_title").where("p_file <> fork")
    pairs = pairs.groupBy("fork").agg(F.min_by(F.struct("p_file", "p_words", "words"), "_k").alias("x")).select("fork", "x.*")
    fork_wins = F.col("words") >= F.col("p_words")
    loser = F.when(fork_wins, F.col("p_file")).otherwise(F.col("fork"))
    keeper = F.when(fork_wins, F.col("fork")).otherwise(F.col("p_file"))
    lost = pairs.groupBy(loser.alias(order)).agg(F.max_by(keeper, "fork").alias("_kept"))
    own = pairs.select(F.col("fork").alias(order), keeper.alias("_own"))
    out = rows.join(lost, order, "left").join(own, order, "left")
    return out.withColumn("branch_dup", F.col("_kept").isNotNull()).withColumn("branch_of", F.coalesce("_kept", "_own")).drop("_title", "_kept", "_own")


def score(cfg: Config | None = None, has_content_days: bool = True) -> Column:
    """The triage score of an index row, to two digits."""
    cfg = cfg or Config()
    w, p = cfg.weights, cfg.penalties
    col = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    authored, days = col("authored_words"), col("days_touched")
    pace = authored / F.greatest(days, F.lit(1.0))
    fallback = F.when(pace < w["routine_min_wpd"], F.lit(1.0)).otherwise(days)
    visits = F.coalesce(F.col("content_days").cast("double"), fallback) if has_content_days else fallback
    depth = w["turn_depth"] * F.log1p(col("authored_turns")) + w["turn_length"] * F.log1p(col("avg_authored_turn_words")) + w["return_visit"] * F.least(F.greatest(visits - 1, F.lit(0.0)), F.lit(float(w["return_cap"])))
    routine = F.when((days >= 3) & (pace < w["routine_min_wpd"]), p["routine"] * F.log1p(days)).otherwise(0.0)
    skew = col("assistant_words") / F.greatest(authored, F.lit(1.0))
    consumption = F.when((authored > 0) & (skew > 6) & (col("avg_authored_turn_words") < 40), p["consumption"] * F.log1p(F.greatest(skew - 6, F.lit(0.0)))).otherwise(0.0)
    base = w["authored_words"] * F.log1p(authored) + w["own_voice"] * F.log1p(col("own_voice_words")) + w["longest_turn"] * F.log1p(col("max_user_turn_words"))
    course = F.coalesce("coursework", F.lit(False))
    return F.bround(base + F.when(course, -p["coursework"]).otherwise(depth - routine) - p["code"] * col("code_ratio") - consumption, 2)


def topics(cfg: Config | None = None) -> Column:
    """Topics of title and terms: every pattern of a topic must match min_term_hits distinct strings; a topic may replace others."""
    cfg = cfg or Config()
    text = X.fold(F.concat_ws(" ", F.lower(F.coalesce("title", F.lit(""))), F.when(F.size("terms") > 0, F.array_join("terms", " "))))
    hits = []
    for name, spec in cfg.topics.items():
        spec = {"pattern": spec} if isinstance(spec, str) else spec
        patterns = [spec["pattern"]] if "pattern" in spec else list(spec.get("all_of", []))
        found = F.lit(True)
        for pattern in patterns:
            groups = __import__("re").compile(pattern).groups
            found = found & (F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), min(groups, 1)))) >= cfg.min_term_hits)
        hits.append(F.struct(F.when(found, F.lit(name)).alias("topic"), F.when(found, F.array(*[F.lit(r) for r in spec.get("replaces", [])]).cast("array<string>")).alias("replaces")))
    rows = F.filter(F.array(*hits), lambda x: x["topic"].isNotNull())
    return F.array_except(F.transform(rows, lambda x: x["topic"]), F.flatten(F.transform(rows, lambda x: x["replaces"])))


def age_days(date: Column, as_of: str) -> Column:
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.try_to_date(date, "yyyy-MM-dd")), F.lit(0))


def delta_candidate(cfg: Config, date: Column) -> Column:
    """A row that predates a dated change in one of its topics, or an old row in a volatile topic without a dated change."""
    dated = F.lit(False)
    for change in cfg.position_changes:
        dated = dated | (F.array_contains("topics", change["topic"]) & (date < change["date"]))
    loose = [t for t in cfg.volatile if t not in {c["topic"] for c in cfg.position_changes}]
    stale = F.arrays_overlap("topics", F.array(*[F.lit(t) for t in loose]).cast("array<string>")) & (F.col("age_days") > cfg.stale_after_days)
    return F.coalesce(dated, F.lit(False)) | F.coalesce(stale, F.lit(False))


def scored(index: DataFrame, cfg: Config, as_of: str, date: str = "conv_date") -> DataFrame:
    """Index rows with topics, age_days, delta_candidate and score. Dates that can't be read are of age 0."""
    when = F.coalesce(date, F.lit("0000-00-00"))
    return index.withColumn("topics", topics(cfg)).withColumn("age_days", age_days(when, as_of)).withColumn("delta_candidate", delta_candidate(cfg, when)).withColumn("score", score(cfg))


def review_state(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Adds review_state: null, reviewed, or continued if user_turns grew since. ledger: one row a key, (rec_key, seen_turns)."""
    key = record_key()
    seen = ledger.select(F.col("rec_key").alias("_key"), "seen_turns")
    state = F.when(F.col("_key").isNull(), None).when(F.col("user_turns") > F.col("seen_turns"), "continued").otherwise("reviewed")
    return rows.join(seen, key == F.col("_key"), "left").withColumn("review_state", state).drop("_key", "seen_turns")


def shortlist(rows: DataFrame, n: int, key: str = "file") -> DataFrame:
    """The n best rows that are no branch duplicates, ties by key."""
    return rows.where(~F.coalesce("branch_dup", F.lit(False))).orderBy(F.desc("score"), key).limit(n)


def delta_list(rows: DataFrame, n: int, key: str = "file") -> DataFrame:
    """The best delta candidates of all rows, with a mark on those already in the first n."""
    kept = rows.where(~F.coalesce("branch_dup", F.lit(False)))
    top = shortlist(rows, n, key).select(F.col(key), F.lit(True).alias("in_top"))
    best = kept.where("delta_candidate").orderBy(F.desc("score"), key).limit(max(n // 2, 20))
    return best.join(top, key, "left").withColumn("in_top", F.coalesce("in_top", F.lit(False)))
