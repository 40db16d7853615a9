"""The index of an archive: kept conversations with titles, dates, file names and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import text as X
from threadmill.functions.running import running
from threadmill.operators import authorship, shortlist, turns
from threadmill.session import stored


def heads(conversations: DataFrame) -> DataFrame:
    """(conv_no, conversation_id, title, create_time, conv_date, slug), one row a conversation; without title 'Untitled', without time 0000-00-00."""
    slim = turns.latest(conversations.select("conv_no", "conversation_id", "id", "title", "create_time", "exported_at"))
    return slim.select(
        "conv_no", F.coalesce(F.nullif("conversation_id", F.lit("")), "id").alias("conversation_id"), F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")).alias("title"), "create_time",
        F.coalesce(X.day(F.col("create_time")), F.lit("0000-00-00")).alias("conv_date"), X.slug(F.col("title")).alias("slug"),
    )


def named(rows: DataFrame) -> DataFrame:
    """rows with ``file``: date and slug, the second of one name with -2 and so on, by conv_no.

    The number is a running count in stretches, so a name that a third of all
    rows share (undated and untitled ones) is not gathered in one task.
    """
    at = running(rows.withColumn("_base", F.concat_ws("-", "conv_date", "slug")), "_base", "conv_no", {"_k": F.lit(1)})
    return at.withColumn("file", F.concat("_base", F.when(F.col("_k") > 0, F.concat(F.lit("-"), F.col("_k") + 1)).otherwise(""), F.lit(".md"))).drop("_base", "_k", "slug")


def volumes(said: DataFrame) -> DataFrame:
    """(conv_no, user_turns, user_words, days_touched, said_chars): what packing needs to know, without labels and echoes."""
    user = F.col("role") == "user"
    n = lambda c: F.coalesce(F.sum(F.when(user, c)), F.lit(0)).cast("long")
    return said.groupBy("conv_no").agg(F.count_if(user).alias("user_turns"), n(X.words(X.fold(F.col("text")))).alias("user_words"), F.countDistinct(X.day(F.col("ts"))).alias("days_touched"), n(F.length("text")).alias("said_chars"))


def kept(conversations: DataFrame, said: DataFrame, floor: int) -> DataFrame:
    """Conversations of at least ``floor`` user words, with their volumes, titles and file names."""
    return named(volumes(said).where(F.col("user_words") >= floor).join(heads(conversations), "conv_no"))


def index(conversations: DataFrame, cfg: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """(index rows, turns): kept conversations with file names, metrics and branch marks."""
    cfg = cfg or Config()
    said = stored(turns.linearized(conversations))
    rows = authorship.metrics(said, cfg).where(F.col("user_words") >= cfg.min_user_words).join(heads(conversations), "conv_no")
    return shortlist.mark_branches(stored(named(rows))), said


def first(conversations: DataFrame, n: int) -> DataFrame:
    """The first n conversations in the order of the export; only their numbers are sorted, not their records."""
    ids = conversations.select("conv_no").where("conv_no is not null").distinct().orderBy("conv_no").limit(n)
    return conversations.join(ids, "conv_no", "left_semi")


#: Index fields that older indexes lack; without one of them an index is read again from its transcripts.
NEW_FIELDS = ("authored_words", "own_voice_words", "avg_authored_turn_words", "coursework", "terms", "echoed_words")


def stale_fields(index_rows: DataFrame) -> list[str]:
    """The fields an index lacks; it is stale if there is any. Looks at the columns only."""
    return [f for f in NEW_FIELDS if f not in index_rows.columns]


RESCANNED = ("authored_words", "own_voice_words", "pasted_words", "echoed_words", "authored_turns", "max_user_turn_words", "avg_authored_turn_words", "coursework", "terms")


def rescan(index_rows: DataFrame, dialogue: DataFrame, cfg: Config | None = None) -> DataFrame:
    """index rows with the fields of authorship found again from transcripts (file, pos, role, text).

    Transcripts have no times of turns, so content_days is dropped and scores
    fall back to days_touched. Rows without a transcript stay as they are.
    """
    keys = dialogue.select("file").distinct().withColumn("conv_no", F.xxhash64("file"))
    said = dialogue.join(keys, "file").withColumn("ts", F.lit(None).cast("double"))
    found = authorship.metrics(said, cfg).select("conv_no", *RESCANNED)
    found = stored(keys.join(found, "conv_no").select("file", *[F.col(c).alias(f"_{c}") for c in RESCANNED]))
    old = [c if c in index_rows.columns else None for c in RESCANNED]
    rows = index_rows.join(found, "file", "left")
    fresh = [F.coalesce(f"_{c}", o).alias(c) if o else F.col(f"_{c}").alias(c) for c, o in zip(RESCANNED, old)]
    rest = [c for c in index_rows.columns if c not in (*RESCANNED, "content_days")]
    return shortlist.mark_branches(rows.select(*rest, *fresh))
