"""The record of what was reviewed, as keyed tables, and the reading of ticked shortlists and of notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.operators.incremental import record_key
from threadmill.operators.shortlist import review_state
from threadmill.session import stored

# How links, ticks, sources and dated names are written.
STEM = r"\[\[([^\]|\\]+)|\]\(([^)]+?)\.md\)"
TICKED = r"^\|\s*\[[xX]\]"
SOURCES = r"(?im)^\*?Sources?:\*?(.*)$"
DATED = r"^\d{4}-\d{2}-\d{2}-"
FRONTMATTER = r"(?s)\A---\n(.*?)\n---\n"
CONVERSATION_ID = r'(?m)^conversation_id:\s*"?([^"\n]+)"?\s*$'
# End of the fixed values.
RANK = {"reviewed": 1, "promoted": 2}


def stems(text: Column) -> Column:
    """The names links in a text lead to, in order."""
    wiki = F.regexp_extract_all(text, F.lit(STEM), 1)
    path = F.transform(F.regexp_extract_all(text, F.lit(STEM), 2), lambda p: F.regexp_replace(p, r".*/", ""))
    both = F.zip_with(wiki, path, lambda a, b: F.trim(F.when(F.coalesce(a, F.lit("")) != "", a).otherwise(F.coalesce(b, F.lit("")))))
    return F.filter(both, lambda s: s != "")


def recorded(ledger: DataFrame) -> DataFrame:
    """One row a key of ledger rows: the highest status, the latest date and the most turns seen.

    Statuses in any case, outer spaces ignored; rows of other statuses and without a key record nothing.
    """
    status = F.lower(F.trim("status"))
    rank = F.create_map(*[x for s, r in RANK.items() for x in (F.lit(s), F.lit(r))])[status]
    rows = ledger.select(record_key().alias("rec_key"), rank.alias("rank"), "marked_on", F.col("user_turns").cast("long").alias("user_turns")).where("rank is not null and rec_key is not null")
    by = rows.groupBy("rec_key").agg(F.max("rank").alias("rank"), F.max("marked_on").alias("marked_on"), F.max("user_turns").alias("seen_turns"))
    return by.select("rec_key", F.when(F.col("rank") == 2, "promoted").otherwise("reviewed").alias("status"), "marked_on", "seen_turns")


def mark(ledger: DataFrame, rows: DataFrame, status: str, on: str) -> DataFrame:
    """The ledger (rec_key, status, marked_on, seen_turns) with rows recorded; promoted is never lowered, date and turns are renewed."""
    new = rows.select(record_key().alias("rec_key"), F.col("user_turns").cast("long").alias("_turns")).where("rec_key is not null").groupBy("rec_key").agg(F.max("_turns").alias("_turns"))
    joined = ledger.join(new.withColumn("_new", F.lit(True)), "rec_key", "full")
    new_status = F.when(F.col("status") == "promoted", "promoted").otherwise(status)
    is_new = F.col("_new").isNotNull()
    return joined.select("rec_key", F.when(is_new, new_status).otherwise(F.col("status")).alias("status"), F.when(is_new, F.lit(on)).otherwise(F.col("marked_on")).alias("marked_on"), F.when(is_new, F.col("_turns")).otherwise(F.col("seen_turns")).alias("seen_turns"))


def pend(pending: DataFrame, rows: DataFrame, note: str) -> DataFrame:
    """pending (rec_key, file, user_turns, notes) with one more note citing rows; the first turns stay."""
    new = rows.select(record_key().alias("rec_key"), "file", F.col("user_turns").cast("long").alias("user_turns"), F.array(F.lit(note)).alias("notes"))
    both = pending.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    return both.groupBy("rec_key").agg(F.min_by("file", "_o").alias("file"), F.min_by("user_turns", "_o").alias("user_turns"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("notes")))).alias("notes"))


def finalize(ledger: DataFrame, pending: DataFrame, hold: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(ledger, what stays pending): pending rows become promoted but for files whose stem is on hold."""
    stem = F.regexp_replace("file", r"\.md$", "")
    held = pending.join(hold, stem == hold.stem, "left_semi")
    done = pending.join(hold, stem == hold.stem, "left_anti").withColumn("conversation_id", F.col("rec_key"))
    return mark(ledger, done, "promoted", on), held


def shortlist_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, line, ticked, stems) of the table rows of shortlists (doc_id, text) that link to something."""
    at = texts.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "row")).where(F.col("row").startswith("|"))
    return at.select("doc_id", (F.col("i") + 1).alias("line"), F.col("row").rlike(TICKED).alias("ticked"), stems(F.col("row")).alias("stems")).where(F.size("stems") > 0)


def sync(shortlists: DataFrame, index: DataFrame) -> DataFrame:
    """(stem, ticked) of the first known name in each row, and of every name in rows that aren't ticked; ticked wins."""
    rows = shortlist_rows(shortlists)
    known = index.select(F.regexp_replace("file", r"\.md$", "").alias("stem")).distinct()
    named = rows.select("doc_id", "line", "ticked", F.posexplode("stems").alias("k", "stem")).join(known, "stem")
    first = named.where("ticked").groupBy("doc_id", "line").agg(F.min_by("stem", "k").alias("stem")).select("stem", F.lit(True).alias("ticked"))
    rest = named.where("not ticked").select("stem", F.lit(False).alias("ticked"))
    return first.unionByName(rest).groupBy("stem").agg(F.max("ticked").alias("ticked"))


def unknown_rows(shortlists: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, line) of ticked rows none of whose names the index knows; they mark nothing."""
    rows = shortlist_rows(shortlists).where("ticked")
    known = index.select(F.regexp_replace("file", r"\.md$", "").alias("stem")).distinct()
    named = rows.select("doc_id", "line", F.explode("stems").alias("stem")).join(known, "stem", "left_semi").select("doc_id", "line")
    return rows.select("doc_id", "line").join(named, ["doc_id", "line"], "left_anti")


def by_stem(index: DataFrame) -> DataFrame:
    """index with one row a file and its name without ending as ``stem``; of rows of one file the one with most user turns."""
    rows = index.select("file", "conversation_id", F.col("user_turns").cast("long").alias("user_turns")).where("file is not null")
    best = rows.groupBy("file").agg(F.max(F.struct(F.col("user_turns"), F.col("conversation_id"))).alias("r"))
    return best.select(F.regexp_replace("file", r"\.md$", "").alias("stem"), "file", "r.conversation_id", "r.user_turns")


def mark_stems(ledger: DataFrame, index: DataFrame, stems: DataFrame, status: str, on: str) -> tuple[DataFrame, DataFrame]:
    """(the ledger with the conversations of these names recorded, the names the index lacks). stems: (stem)."""
    names, known = stems.select("stem").distinct(), by_stem(index)
    return mark(ledger, known.join(names, "stem", "left_semi"), status, on), names.join(known, "stem", "left_anti")


def sync_ledger(ledger: DataFrame, pending: DataFrame, shortlists: DataFrame, index: DataFrame, on: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ledger, pending, unknown rows) after a shortlist was read: ticked rows are reviewed, pending ones promoted unless on hold."""
    said = stored(sync(shortlists, index))
    marked, _ = mark_stems(ledger, index, said.where("ticked"), "reviewed", on)
    done, held = finalize(marked, pending, holds(shortlists), on)
    return done, held, unknown_rows(shortlists, index)


def holds(shortlists: DataFrame) -> DataFrame:
    """(stem) of every name in rows that aren't ticked."""
    return shortlist_rows(shortlists).where("not ticked").select(F.explode("stems").alias("stem")).distinct()


def state_counts(index: DataFrame, ledger: DataFrame) -> DataFrame:
    """(state, conversations): unreviewed, reviewed and continued ones of the index, and what the ledger records in all."""
    states = review_state(index, ledger).groupBy(F.coalesce("review_state", F.lit("unreviewed")).alias("state")).agg(F.count("*").alias("conversations"))
    recorded_ = ledger.groupBy(F.concat(F.lit("recorded as "), F.col("status")).alias("state")).agg(F.count("*").alias("conversations"))
    return states.unionByName(recorded_)


def promote(notes: DataFrame, problems: DataFrame, pending: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(notes without problems, pending with the conversations they cite). problems: as ``note_problems`` gives them.

    Nothing is written: sinks.put_notes copies the notes, and sync_ledger turns what is pending into promoted.
    """
    passed = notes.join(problems.where(F.size("problems") == 0).select("file", "cited"), "file")
    cites = passed.select(F.col("file").alias("note"), F.explode("cited").alias("stem"))
    new = by_stem(index).join(cites, "stem").select(record_key().alias("rec_key"), "file", "user_turns", F.array("note").alias("notes"))
    both = pending.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    merged = both.groupBy("rec_key").agg(F.min_by("file", "_o").alias("file"), F.min_by("user_turns", "_o").alias("user_turns"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("notes")))).alias("notes"))
    return passed.select("file", "content"), merged


def note_problems(notes: DataFrame, index: DataFrame, results: DataFrame | None = None, present: DataFrame | None = None) -> DataFrame:
    """(file, problems, cited) of notes (file, content): reasons against each, and the known names it cites.

    ``results`` are the checked quotations, ``present`` (file) the notes that exist already and must not be replaced.
    """
    front = F.regexp_extract("content", FRONTMATTER, 1)
    has_front = F.col("content").rlike(FRONTMATTER)
    cited = F.filter(F.flatten(F.transform(F.regexp_extract_all("content", F.lit(SOURCES), 1), stems)), lambda s: s.rlike(DATED))
    rows = notes.select("file", F.coalesce("content", F.lit("")).alias("content")).select("file", has_front.alias("has_front"), front.rlike(r"(?m)^source:\s*\S").alias("has_source"), cited.alias("cited"))
    known = index.select(F.regexp_replace("file", r"\.md$", "").alias("stem")).distinct().withColumn("known", F.lit(True))
    each = rows.select("file", F.explode(F.array_distinct("cited")).alias("stem")).join(known, "stem", "left")
    by = each.groupBy("file").agg(F.array_sort(F.collect_list(F.when(F.col("known").isNull(), F.col("stem")))).alias("missing"), F.array_sort(F.collect_list(F.when(F.col("known"), F.col("stem")))).alias("found"))
    out = rows.join(by, "file", "left")
    reasons = [F.when(~F.col("has_front"), "no frontmatter block"), F.when(F.col("has_front") & ~F.col("has_source"), "frontmatter has no source"), F.when(F.size("cited") == 0, "cites no conversation"), F.when(F.size(F.coalesce("missing", F.array().cast("array<string>"))) > 0, "cites an unknown conversation")]
    if results is not None:
        failed = results.where("status <> 'ok' and not labeled").groupBy("file").agg(F.count("*").alias("failed"))
        out = out.join(failed, "file", "left")
        reasons.append(F.when(F.col("failed") > 0, "quotations fail"))
    if present is not None:
        taken = present.select("file").distinct().withColumn("_taken", F.lit(True))
        out = out.join(taken, "file", "left")
        reasons.append(F.when(F.col("_taken"), "a note of this name exists"))
    return out.select("file", F.array_compact(F.array(*reasons)).alias("problems"), F.coalesce("found", F.array().cast("array<string>")).alias("cited"))
