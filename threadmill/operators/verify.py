"""Quotations in notes against what the owner wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions import patterns as P
from threadmill.functions import text as X
from threadmill.functions.classify import MINE, turn_label
from threadmill.session import stored

# What counts as a quotation and as a label.
STRAIGHT = r'(?:^|(?<=[\s(>\[*_]))"(?=\S)([^"\n]{40,}?)(?<=\S)"(?=[\s.,;:!?)\]*_]|$)'
CURLY = r"“([^”\n]{40,})”"
ELISION = r"\.\.\.|…|\[\.\.\.\]"
BOLD = r"\*\*([^*\n]+?)\*\*"
LABEL_WORDS = {"echoed": r"assistant[- ]coined|echoed", "unsourced": "cleaned|paraphrase", "not_authored": "pasted|chip|clicked"}
ANY_STATUS = "unverifiable"
# End of the fixed values.


def quotes(notes: DataFrame) -> DataFrame:
    """(file, line, quote, context) of notes (file, content). Files that begin with '_' are skipped; context: three lines before to one after."""
    lines = notes.where("content is not null and not regexp_replace(file, '.*/', '') like '\\\\_%'").withColumn("lines", F.split("content", "\n"))
    at = lines.select("file", "lines", F.posexplode("lines").alias("i", "text"))
    found = F.concat(F.regexp_extract_all("text", F.lit(STRAIGHT), 1), F.regexp_extract_all("text", F.lit(CURLY), 1))
    context = F.array_join(F.slice("lines", F.greatest(F.col("i") - 2, F.lit(1)), F.least(F.col("i"), F.lit(3)) + 2), "\n")
    rows = at.where(F.size(found) > 0).select("file", (F.col("i") + 1).alias("line"), context.alias("context"), F.explode(found).alias("raw"))
    quote = F.replace("raw", F.lit("**"), F.lit(""))
    kept = rows.withColumn("quote", quote).where(~(F.col("quote").contains("[[") | F.col("quote").contains("source:") | F.col("quote").contains("`")))
    return kept.where(F.length(X.norm(F.col("quote"))) >= 30).drop("raw")


def segments(quote: Column) -> Column:
    """The pieces between elisions that are long enough, normalised; the whole quotation if none is."""
    pieces = F.filter(F.transform(F.split(quote, ELISION), X.norm_ascii), lambda s: F.length(s) >= P.MIN_SEGMENT)
    return F.when(F.size(pieces) > 0, pieces).otherwise(F.array(X.norm_ascii(quote)))


def spoken(turns: DataFrame) -> DataFrame:
    """(conv_no, pos, role, text, said): turns with their normalised text."""
    return turns.select("conv_no", "pos", "role", "text", X.norm(F.col("text")).alias("said"))


def _anchors(segs: Column) -> Column:
    """What a turn must hold to hold the longest piece, as (kind, key) of which one suffices.

    A piece may begin and end inside a word of the turn, so only its inner words
    are whole words there: runs of three of them, or the longest single one, or,
    where a piece has no inner word, the first characters of its longest word,
    which are part of a long word of the turn.
    """
    longest = F.element_at(F.array_sort(F.transform(segs, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s")))), 1)["s"]
    words = F.split(longest, " ")
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    long_first = lambda ws: F.element_at(F.array_sort(F.transform(ws, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), 1)["w"]
    runs = F.transform(F.sequence(F.lit(1), F.size(inner) - 2), lambda i: F.struct(F.lit("run").alias("kind"), F.array_join(F.slice(inner, i, F.lit(3)), " ").alias("key")))
    word = F.array(F.struct(F.lit("word").alias("kind"), long_first(inner).alias("key")))
    part = F.array(F.struct(F.lit("part").alias("kind"), F.substring(long_first(words), 1, PART).alias("key")))
    return F.when(F.size(inner) >= 3, runs).when(F.size(inner) >= 1, word).otherwise(part)


#: A piece without an inner word has at most two words and MIN_SEGMENT characters or more, so one word has at least this many.
PART = (P.MIN_SEGMENT - 1) // 2


def _keys(words: DataFrame, kind: str) -> DataFrame:
    """(kind, key, conv_no, pos) of every key of one kind in turns (conv_no, pos, words)."""
    runs = F.transform(F.when(F.size("words") >= 3, F.sequence(F.lit(1), F.size("words") - 2)).otherwise(F.array().cast("array<int>")), lambda i: F.array_join(F.slice("words", i, F.lit(3)), " "))
    inside = F.flatten(F.transform(F.filter("words", lambda w: F.length(w) >= PART), lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - (PART - 1)), lambda i: F.substring(w, i, F.lit(PART)))))
    keys = {"run": runs, "word": F.col("words"), "part": inside}[kind]
    return words.select(F.lit(kind).alias("kind"), F.explode_outer(F.array_distinct(keys)).alias("key"), "conv_no", "pos").where("key is not null")


def hits(quoted: DataFrame, said: DataFrame) -> DataFrame:
    """(quote, conv_no, pos, role) of every turn that holds all pieces of a quotation. said: conv_no, pos, role, said.

    Turns are looked up by keys of the quotations alone. Of a quotation's keys
    the rarest in the archive is joined, so a run that everybody uses gathers
    nothing; containment is the residual on these few candidates.
    """
    plain = quoted.select("quote").distinct().withColumn("plain", X.nfkc(F.col("quote")))
    q = stored(plain.select("quote", segments(F.col("plain")).alias("segs")))
    asked = stored(q.select("quote", F.explode(_anchors(F.col("segs"))).alias("a")).select("quote", "a.kind", "a.key"))
    kinds = sorted(r["kind"] for r in asked.select("kind").distinct().collect())  # at most three
    none = said.sparkSession.createDataFrame([], "quote string, conv_no long, pos int, role string")
    if not kinds:
        return none
    words = said.select("conv_no", "pos", F.split("said", " ").alias("words"))
    wanted = asked.select("kind", "key").distinct()
    found = None
    for kind in kinds:
        at = _keys(words, kind).join(wanted.where(F.col("kind") == kind), ["kind", "key"], "left_semi")
        found = at if found is None else found.unionByName(at)
    found = stored(found)
    often = found.groupBy("kind", "key").agg(F.count("*").alias("n"))
    # a quotation whose rarest key stands nowhere stands nowhere itself
    counted = asked.join(often, ["kind", "key"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy("quote").agg(F.min(F.struct("n", "kind", "key")).alias("a")).where("a.n > 0").select("quote", "a.kind", "a.key")
    candidates = rarest.join(found, ["kind", "key"]).select("quote", "conv_no", "pos")
    held = candidates.join(q, "quote").join(said.select("conv_no", "pos", "role", "said"), ["conv_no", "pos"])
    return held.where(F.forall("segs", lambda s: F.col("said").contains(s))).select("quote", "conv_no", "pos", "role")


def statuses(quoted: DataFrame, turns: DataFrame) -> DataFrame:
    """(quote, status): ok, unsourced, not_authored or echoed.

    A hit is an echo if the assistant said a run of seven of its words earlier in
    the conversation, and the owner hadn't before that. One hit that is none is
    enough. Labels are of the raw text, and are worked out only in conversations
    that hold a quotation.
    """
    said = stored(spoken(turns))
    me = stored(hits(quoted, said).where("role = 'user'"))
    near = said.join(me.select("conv_no").distinct(), "conv_no", "left_semi")
    folded = X.fold(F.col("text"))
    label = near.where("role = 'user'").select("conv_no", "pos", "said", folded.alias("f")).withColumn("n", X.words(F.col("f")))
    mine = stored(label.select("conv_no", "pos", "said", turn_label(F.col("f"), F.col("n")).isin(*MINE).alias("mine")))
    hit = me.join(mine.select("conv_no", "pos", "mine"), ["conv_no", "pos"])
    toks = quoted.select("quote").distinct().select("quote", X.tokens(X.norm(F.col("quote"))).alias("toks"))
    runs = toks.select("quote", F.explode_outer(F.array_distinct(X.grams(F.col("toks"), P.QUOTE_RUN))).alias("run")).where("run is not null")
    wanted = hit.where("mine").select("quote", "conv_no").distinct().join(runs, "quote")
    others = near.where("role = 'assistant'").select("conv_no", "pos", F.lit(False).alias("own"), X.tokens(F.col("said")).alias("toks"))
    owned = mine.where("mine").select("conv_no", "pos", F.lit(True).alias("own"), X.tokens(F.col("said")).alias("toks"))
    spoken_runs = others.unionByName(owned).select("conv_no", "pos", "own", F.explode_outer(X.grams(F.col("toks"), P.QUOTE_RUN)).alias("run")).where("run is not null")
    owner = F.min(F.when(F.col("own"), F.col("pos"))).alias("owner")
    theirs = F.min(F.when(~F.col("own"), F.col("pos"))).alias("theirs")
    asked = wanted.select("conv_no", "run").distinct()
    first = spoken_runs.join(asked, ["conv_no", "run"], "left_semi").groupBy("conv_no", "run").agg(owner, theirs)
    borrowed = wanted.join(first.where("theirs is not null and (owner is null or owner >= theirs)"), ["conv_no", "run"]).groupBy("quote", "conv_no").agg(F.min("theirs").alias("theirs"))
    judged = hit.join(borrowed, ["quote", "conv_no"], "left").withColumn("clean", F.col("mine") & (F.col("theirs").isNull() | (F.col("theirs") >= F.col("pos"))))
    by = judged.groupBy("quote").agg(F.max("mine").alias("any_mine"), F.max("clean").alias("any_clean"))
    status = F.when(F.col("any_mine").isNull(), "unsourced").when(~F.col("any_mine"), "not_authored").when(F.col("any_clean"), "ok").otherwise("echoed")
    return quoted.select("quote").distinct().join(by, "quote", "left").select("quote", status.alias("status"))


def check(notes: DataFrame, turns: DataFrame) -> DataFrame:
    """(file, line, quote, status, labeled) of every quotation."""
    q = stored(quotes(notes))
    bold = F.regexp_extract_all("context", F.lit(BOLD), 1)
    pattern = F.create_map(*[x for s, w in LABEL_WORDS.items() for x in (F.lit(s), F.lit(rf"(?i)\b({w}|{ANY_STATUS})\b"))])
    rows = q.join(statuses(q, turns), "quote")
    labeled = (F.col("status") != "ok") & F.coalesce(F.exists(bold, lambda b: F.regexp(b, pattern[F.col("status")])), F.lit(False))
    return rows.select("file", "line", "quote", "status", labeled.alias("labeled"))


def failures(results: DataFrame) -> DataFrame:
    return results.where("status <> 'ok' and not labeled")


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status", "labeled").agg(F.count("*").alias("quotes"))
