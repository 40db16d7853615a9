"""Labels, echoes and credited words of user turns; metrics of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import patterns as P
from threadmill.functions import text as X
from threadmill.functions.classify import MINE, coursework, is_drill, school_patterns, turn_label
from threadmill.functions.running import STRETCH, running
from threadmill.session import stored


def labelled(turns: DataFrame, cfg: Config | None = None) -> DataFrame:
    """User turns with folded prose, word counts and label. turns: conv_no, pos, role, text, ts. No shuffle."""
    rows = turns.where("role = 'user'").withColumn("prose", X.prose(F.col("text")))
    rows = rows.withColumn("folded", X.fold(F.col("prose"))).withColumn("n_all", X.words(X.fold(F.col("text")))).withColumn("n_prose", X.words(F.col("folded")))
    # the label comes out of a generator, as no condition on it is then pushed below, where texts would be folded and counted anew for every use
    return rows.select("*", F.explode(F.array(turn_label(F.col("folded"), F.col("n_prose"), cfg))).alias("label"))


def with_before(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """turns with ``before``: the text of the turn before, if it is the assistant's.

    A conversation is read in stretches of positions, so one that holds a third
    of all rows is spread over many tasks. The last turn of a stretch is lent to
    the next one: one row in so many, in conversations of several stretches only.
    """
    rows = turns.withColumn("_stretch", F.floor(F.col("pos") / stretch))
    ends = rows.groupBy("conv_no", "_stretch").agg(F.max("pos").alias("pos"))
    following = F.lead("_stretch").over(Window.partitionBy("conv_no").orderBy("_stretch"))
    hops = stored(ends.select("conv_no", "pos", following.alias("_stretch")).where("_stretch is not null"))
    lent = turns.join(hops, ["conv_no", "pos"]).select(*turns.columns, "_stretch", F.lit(True).alias("_lent"))
    both = rows.withColumn("_lent", F.lit(False)).unionByName(lent)
    ahead = Window.partitionBy("conv_no", "_stretch").orderBy("pos")
    before = F.when(F.lag("role").over(ahead) == "assistant", F.lag("text").over(ahead))
    return both.withColumn("before", before).where("not _lent").drop("_stretch", "_lent")


def _tokens(text: Column) -> Column:
    return X.tokens(X.norm(text))


def echoes(rows: DataFrame) -> DataFrame:
    """(conv_no, pos, n_tokens, n_covered) of turns that repeat runs of the assistant turn before.

    rows: conv_no, pos, text, before, label. Tokens are columns of a projection of
    their own, so no text is normalised more than once. Runs are compared inside
    the row first; only turns that share one are looked at further, and only
    their conversations' turns are searched for an earlier owner of the run.
    """
    n = P.ECHO_RUN
    mine = rows.where(F.col("label").isin(*MINE)).select("conv_no", "pos", "text", "before")
    said = mine.select("conv_no", "pos", _tokens(X.prose(F.col("text"))).alias("toks"))
    replies = mine.where("before is not null").select("conv_no", "pos", _tokens(X.prose(F.col("text"))).alias("toks"), _tokens(F.col("before")).alias("theirs"))
    # outer, so that no filter on the runs is inferred below the generator, where it would be worked out a second time
    common = replies.select("conv_no", "pos", F.explode_outer(F.array_intersect(X.grams(F.col("toks"), n), X.grams(F.col("theirs"), n))).alias("run")).where("run is not null")
    shared = stored(common)
    near = said.join(shared.select("conv_no").distinct(), "conv_no", "left_semi")
    owners = near.select("conv_no", F.col("pos").alias("own_pos"), F.explode_outer(X.grams(F.col("toks"), n)).alias("run")).join(shared.select("conv_no", "run").distinct(), ["conv_no", "run"], "left_semi")
    first = owners.groupBy("conv_no", "run").agg(F.min("own_pos").alias("own_pos"))
    kept = shared.join(first, ["conv_no", "run"]).where("own_pos >= pos").select("conv_no", "pos", "run")
    places = said.join(shared.select("conv_no", "pos").distinct(), ["conv_no", "pos"], "left_semi").select("conv_no", "pos", F.size("toks").alias("n_tokens"), F.posexplode_outer(X.grams(F.col("toks"), n)).alias("at", "run"))
    hits = places.join(kept, ["conv_no", "pos", "run"])
    by = hits.groupBy("conv_no", "pos").agg(F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list("at")).alias("hits"))
    return by.select("conv_no", "pos", "n_tokens", X.covered(F.col("hits"), n).alias("n_covered"))


def _credited(turns: DataFrame, cfg: Config | None) -> DataFrame:
    # the labels cost most and are read several times below
    mine = F.col("label").isin(*MINE)
    rows = stored(labelled(with_before(turns), cfg).drop("folded", "prose").withColumn("before", F.when(mine, F.col("before"))))
    share = F.coalesce(F.col("n_covered") / F.col("n_tokens"), F.lit(0.0))
    echoed = F.when(mine, F.rint(F.col("n_prose") * share)).otherwise(F.lit(0.0)).cast("long")
    return rows.join(echoes(rows), ["conv_no", "pos"], "left").withColumn("echo_share", share).withColumn("echoed", echoed).withColumn("credited", F.col("n_prose") - F.col("echoed")).drop("n_covered", "n_tokens", "before")


def credited(turns: DataFrame, cfg: Config | None = None) -> DataFrame:
    """User turns with ``echoed`` and ``credited`` words; of turns that aren't the owner's nothing is an echo."""
    return _credited(stored(turns.select("conv_no", "pos", "role", "text", "ts")), cfg)


def term_bags(rows: DataFrame, cap: int = P.TERM_CAP) -> DataFrame:
    """(conv_no, terms): the most frequent content words of the owner's turns, by count, then word."""
    word = F.rtrim("w", F.lit("'-"))  # a term begins with a letter
    # outer, so that no filter on the found words is inferred, for which they would be found twice
    w = rows.where(F.col("label").isin(*MINE)).select("conv_no", F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit(P.TERM), 0)).alias("w")).where("w is not null").select("conv_no", word.alias("word"))
    counts = w.where((F.length("word") >= 3) & ~F.col("word").isin(*P.STOP_WORDS)).groupBy("conv_no", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("conv_no").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= cap)
    return top.groupBy("conv_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("terms"))


def fence_chars(turns: DataFrame) -> DataFrame:
    """(conv_no, fences): characters inside fenced code of a conversation's texts joined by line breaks.

    A fence may open in one turn and close in a later one, so each turn needs to
    know whether it begins inside one: the parity of the fence marks before it,
    a running sum. A mark that nothing closes opens no fence. Conversations
    without any mark have no row.
    """
    pieces = F.split("text", "```", -1)
    sums = F.aggregate(pieces, F.struct(F.lit(0).alias("i"), F.lit(0).alias("even"), F.lit(0).alias("odd")), lambda a, x: F.struct((a["i"] + 1).alias("i"), (a["even"] + F.when(a["i"] % 2 == 0, F.length(x)).otherwise(0)).alias("even"), (a["odd"] + F.when(a["i"] % 2 == 1, F.length(x)).otherwise(0)).alias("odd")))
    with_mark = turns.where(F.col("text").contains("```")).select("conv_no").distinct()
    slim = turns.join(with_mark, "conv_no", "left_semi").select("conv_no", "pos", F.length("text").cast("long").alias("size"), sums.alias("s"), F.length(F.element_at(pieces, -1)).alias("tail"))
    at = running(slim.withColumn("marks", F.col("s.i") - 1), "conv_no", "pos", {"marks_before": F.col("marks"), "chars_before": F.col("size") + 1})
    began, ended = F.col("marks_before") % 2, (F.col("marks_before") + F.col("marks")) % 2
    inside = 3 * F.col("marks") + F.when(began == 0, F.col("s.odd")).otherwise(F.col("s.even")) + ended
    last = F.when(F.col("marks") > 0, F.col("chars_before") + F.col("size") - F.col("tail") - 3)
    by = at.groupBy("conv_no").agg(F.sum(inside).alias("inside"), F.sum("marks").alias("marks"), F.sum(F.col("size") + 1).alias("all"), F.max(last).alias("last"))
    return by.select("conv_no", (F.col("inside") - F.when(F.col("marks") % 2 == 1, F.col("all") - F.col("last")).otherwise(0)).alias("fences"))


#: User turns that are joined before the coursework patterns are tried, and how many of the next ones are joined to them:
#: a marker spans at most three turns and three option lines at most six, so every match lies in one such stretch.
JOINED_TURNS, OVERLAP_TURNS = 256, 8


def school_signs(rows: DataFrame, cfg: Config | None = None, joined: int = JOINED_TURNS) -> DataFrame:
    """(conv_no, third, school, marker, block): which coursework patterns the user texts, joined by line breaks, match.

    The texts of a conversation are joined in overlapping stretches of turns, so
    none is gathered whole. Patterns of the configuration are matched within
    OVERLAP_TURNS consecutive turns.
    """
    at = running(rows.select("conv_no", "pos", "text"), "conv_no", "pos", {"k": F.lit(1)}).withColumn("_s", F.floor(F.col("k") / joined))
    lent = F.when((F.col("k") % joined < OVERLAP_TURNS) & (F.col("_s") > 0), F.array("_s", F.col("_s") - 1)).otherwise(F.array("_s"))
    by = at.select("conv_no", "k", "text", F.explode(lent).alias("_s")).groupBy("conv_no", "_s").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n").alias("body"))
    folded = by.select("conv_no", X.fold(F.col("body")).alias("body"))
    signs = folded.select("conv_no", *[c.alias(n) for n, c in school_patterns(F.col("body"), cfg).items()])
    return signs.groupBy("conv_no").agg(*[F.max(n).alias(n) for n in ("third", "school", "marker", "block")])


def metrics(turns: DataFrame, cfg: Config | None = None) -> DataFrame:
    """One row per conversation with at least one turn: the index fields that texts and times give.

    No text of a conversation is gathered: what needs the joined text is found
    from running sums (code) or overlapping stretches (coursework).
    """
    turns = stored(turns.select("conv_no", "pos", "role", "text", "ts"))
    rows = _credited(turns, cfg)
    mine = F.col("label").isin(*MINE)
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    by_turn = rows.groupBy("conv_no").agg(
        F.count("*").alias("user_turns"), n("n_all").alias("user_words"), n(F.when(mine, F.col("credited"))).alias("authored_words"), n(F.when(F.col("label") == "own_voice", F.col("credited"))).alias("own_voice_words"),
        n(F.when(~mine, F.col("n_prose")).otherwise(0) + F.col("n_all") - F.col("n_prose")).alias("pasted_words"), n("echoed").alias("echoed_words"), F.count_if(mine).alias("authored_turns"),
        F.coalesce(F.max(F.when(mine, F.col("credited"))), F.lit(0)).cast("long").alias("max_user_turn_words"), F.count_if(is_drill(X.fold(F.col("text")))).alias("drills"),
    )
    days = rows.where(mine & F.col("ts").isNotNull()).groupBy("conv_no", X.day(F.col("ts")).alias("day")).agg(F.sum("credited").alias("w")).groupBy("conv_no").agg(F.count_if(F.col("w") >= P.CONTENT_DAY_WORDS).alias("content_days"))
    every = turns.groupBy("conv_no").agg(
        F.count_if(F.col("role") == "assistant").alias("assistant_turns"), n(F.when(F.col("role") == "assistant", X.words(X.fold(F.col("text"))))).alias("assistant_words"),
        F.countDistinct(X.day(F.col("ts"))).alias("days_touched"), F.max("ts").alias("_last"), F.min("ts").alias("_first"), F.count("ts").alias("_timed"), (F.sum(F.length("text") + 1) - 1).cast("long").alias("chars"),
    )
    every = every.join(fence_chars(turns), "conv_no", "left")
    every = every.select("conv_no", "assistant_turns", "assistant_words", "days_touched", F.when(F.col("_timed") > 1, F.bround((F.col("_last") - F.col("_first")) / 3600, 2)).otherwise(F.lit(0.0)).alias("span_hours"), X.rounded(F.coalesce("fences", F.lit(0)), F.col("chars"), 3).alias("code_ratio"), "chars")
    fill = {c: 0 for c in ("user_turns", "user_words", "authored_words", "own_voice_words", "pasted_words", "echoed_words", "authored_turns", "max_user_turn_words", "content_days", "drills")}
    out = every.join(by_turn, "conv_no", "left").join(days, "conv_no", "left").na.fill(fill).join(term_bags(rows), "conv_no", "left").join(school_signs(rows, cfg), "conv_no", "left")
    out = out.withColumn("coursework", coursework(F.col("user_turns"), F.col("drills"))).withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    return out.withColumn("avg_user_turn_words", X.rounded(F.col("user_words"), F.col("user_turns"), 1)).withColumn("avg_authored_turn_words", X.rounded(F.col("authored_words"), F.col("authored_turns"), 1)).drop("drills", "third", "school", "marker", "block")


def calibration(rows: DataFrame) -> DataFrame:
    """(label, turns, words, share) of labelled turns; words of code count as pasted."""
    words = F.explode(F.array(F.struct(F.col("label").alias("label"), F.lit(1).alias("t"), F.col("n_prose").alias("w")), F.struct(F.lit("pasted").alias("label"), F.lit(0).alias("t"), (F.col("n_all") - F.col("n_prose")).alias("w"))))
    by = rows.select(words.alias("x")).groupBy("x.label").agg(F.sum("x.t").cast("long").alias("turns"), F.sum("x.w").cast("long").alias("words"))
    # five labels: a window over them is bounded
    return by.where("turns > 0 or words > 0").withColumn("share", F.coalesce(F.col("words") / F.nullif(F.sum("words").over(Window.partitionBy()), F.lit(0)), F.lit(0.0)))


def voice_histogram(rows: DataFrame, width: int = 4) -> DataFrame:
    """(bucket, turns, at_floor) of the voice scores of long turns."""
    long = rows.where(F.col("n_prose") >= P.LONG_TURN_WORDS).withColumn("bucket", (F.floor(X.voice_score(F.col("folded"), F.col("n_prose")) / width) * width).cast("long"))
    at = (F.col("bucket") <= P.AUTHORED_FLOOR) & (F.col("bucket") + width > P.AUTHORED_FLOOR)
    return long.groupBy("bucket").agg(F.count("*").alias("turns")).withColumn("at_floor", at)


def near_floor(rows: DataFrame, samples: int = 3, seed: int = 0) -> DataFrame:
    """A few long turns whose score is near the floor, chosen by a hash of their key: the same on every run."""
    score = X.voice_score(F.col("folded"), F.col("n_prose"))
    near = rows.where((F.col("n_prose") >= P.LONG_TURN_WORDS) & (F.col("label") != "own_voice")).withColumn("score", score).where(F.abs(F.col("score") - P.AUTHORED_FLOOR) < 6)
    chance = F.md5(F.concat_ws("-", F.lit(seed), F.col("conv_no").cast("string"), F.col("pos").cast("string")))
    return near.orderBy(chance, "conv_no", "pos").limit(samples).select("conv_no", "pos", "label", "score")
