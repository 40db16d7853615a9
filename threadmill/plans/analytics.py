"""The analytics queries over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import patterns as P
from threadmill.functions import text as X
from threadmill.operators import authorship as A
from threadmill.operators import catalog, chunks, profile, review, shortlist, turns, verify
from threadmill.plans import sql as S
from threadmill.session import spread, stored, table
from threadmill.sources import markdown, sinks

AS_OF = "2026-06-01"
#: A configuration that uses every part of the routing: a topic of two patterns that replaces another, volatile topics, dated changes.
CONFIG = Config(
    topics=Config().topics | {"garden": {"pattern": r"\b(orchard|allotment|hedge|beehive|compost|seedling\w*|meadow|lawn)\b"}, "craft": {"all_of": [r"\b(lathe|kiln|loom|workshop|hammer|chisel|workbench)\b", r"\b(notebook|sketchbook|draft|diary|manuscript|outline)\b"], "replaces": ["garden"]}},
    volatile=("garden", "tech", "creative"),
    position_changes=({"date": "2025-01-01", "topic": "craft", "what": "from plans to things"}, {"date": "2024-06-01", "topic": "tech", "what": "less of it"}),
)
TOP = 60
BUDGET = 3000
FLOOR = 50


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return turns.linearized(table(spark, folder, "conversations"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return A.labelled(turns.from_documents(spread(table(spark, folder, "documents").select("doc_id", "text"))))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return review.recorded(table(spark, folder, "ledger"))


def linearized_turns(spark: SparkSession, folder: str) -> DataFrame:
    return _turns(spark, folder).select("conv_no", "conversation_id", "pos", "role", "text", "ts")


def turn_labels(spark: SparkSession, folder: str) -> DataFrame:
    return A.labelled(_turns(spark, folder)).select("conv_no", "pos", "label", F.col("n_all").cast("long"), F.col("n_prose").cast("long"))


def document_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select(F.col("conv_no").alias("doc_id"), "label", F.col("n_all").cast("long"), F.col("n_prose").cast("long"))


def voice_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select(F.col("conv_no").alias("doc_id"), F.round(X.voice_score(F.col("folded"), F.col("n_prose")), 4).alias("voice_score"))


def label_calibration(spark: SparkSession, folder: str) -> DataFrame:
    return A.calibration(_documents(spark, folder)).withColumn("share", F.round("share", 6))


def voice_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return A.voice_histogram(_documents(spark, folder))


def voice_near_floor(spark: SparkSession, folder: str) -> DataFrame:
    return A.near_floor(_documents(spark, folder), samples=10).withColumn("score", F.round("score", 4))


def echo_shares(spark: SparkSession, folder: str) -> DataFrame:
    return A.credited(_turns(spark, folder)).where("echo_share > 0").select("conv_no", "pos", F.round("echo_share", 6).alias("echo_share"), "echoed")


def normalised_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text")).where("text is not null").select("doc_id", F.md5(X.norm(F.col("text"))).alias("norm_md5"))


def document_terms(spark: SparkSession, folder: str) -> DataFrame:
    return A.term_bags(_documents(spark, folder)).select(F.col("conv_no").alias("doc_id"), F.array_join("terms", " ").alias("terms"))


METRICS = ("user_turns", "assistant_turns", "user_words", "assistant_words", "avg_user_turn_words", "days_touched", "code_ratio", "chars", "authored_words", "own_voice_words", "pasted_words", "echoed_words", "authored_turns", "max_user_turn_words", "avg_authored_turn_words", "content_days", "coursework")


def conv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    m = A.metrics(_turns(spark, folder))
    return m.select("conv_no", *METRICS, F.array_join("terms", " ").alias("terms"))


def span_hours(spark: SparkSession, folder: str) -> DataFrame:
    by = _turns(spark, folder).groupBy("conv_no").agg(F.round((F.max("ts") - F.min("ts")) / 3600, 4).alias("span"), F.count("ts").alias("timed"))
    return by.select("conv_no", F.when(F.col("timed") > 1, F.col("span")).otherwise(0.0).alias("span_hours"))


def authorship_shortlist(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: from nested exports to the best conversations by what their owner wrote."""
    rows = A.metrics(_turns(spark, folder)).withColumn("branch_dup", F.lit(False)).withColumn("score", shortlist.score()).join(catalog.heads(table(spark, folder, "conversations")).select("conv_no", "title"), "conv_no")
    return shortlist.shortlist(rows, TOP, "conv_no").select("conv_no", "title", "score", "authored_words", "own_voice_words", "max_user_turn_words", "authored_turns", "days_touched")


def _kept(spark: SparkSession, folder: str, said: DataFrame | None = None) -> DataFrame:
    return catalog.kept(table(spark, folder, "conversations"), _turns(spark, folder) if said is None else said, FLOOR)


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder).select("conv_no", "file")


def intake_account(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every exported conversation; the rows add up to all of them."""
    all_ = turns.latest(table(spark, folder, "conversations").select("conv_no", "exported_at"))
    words = catalog.volumes(_turns(spark, folder)).select("conv_no", "user_words")
    fate = F.when(F.col("user_words").isNull(), "empty").when(F.col("user_words") < FLOOR, "short").otherwise("kept")
    return all_.join(words, "conv_no", "left").groupBy(fate.alias("fate")).agg(F.count("*").alias("conversations"))


def archive_totals(spark: SparkSession, folder: str) -> DataFrame:
    kept = A.metrics(_turns(spark, folder)).where(F.col("user_words") >= FLOOR)
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return kept.agg(F.count("*").alias("conversations"), s("user_words"), s("authored_words"), s("pasted_words"), s("echoed_words"), F.count_if("coursework").alias("coursework"), F.count_if(F.col("own_voice_words") > 0).alias("with_memos"))


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.block_sizes(_kept(spark, folder))


def year_rollup(spark: SparkSession, folder: str) -> DataFrame:
    by = _blocks(spark, folder).groupBy(F.substring("conv_date", 1, 4).alias("year"))
    return by.agg(F.count("*").alias("conversations"), F.sum("chars").alias("chars"), F.floor(F.sum("chars") / 4).alias("tokens"))


def chunk_pack(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.pack(stored(_blocks(spark, folder).select("conv_no", "conv_date", "file", "tokens")), BUDGET).select("conv_no", "tokens", "chunk")


def chunk_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.manifest(chunks.pack(stored(_blocks(spark, folder).select("conv_date", "file", "chars", "tokens")), BUDGET), BUDGET)


def unreviewed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What is left to read: the packing without conversations that were reviewed and have not gone on since."""
    fresh = chunks.unreviewed(_blocks(spark, folder), _ledger(spark, folder))
    return chunks.pack(stored(fresh.select("conv_no", "conv_date", "file", "tokens")), BUDGET).select("conv_no", "tokens", "chunk")


def first_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 25 conversations of the export, as a limited intake reads them."""
    return catalog.first(turns.latest(table(spark, folder, "conversations").select("conv_no", "exported_at")), 25).select("conv_no")


def word_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Words in of kept conversations against words out of their blocks' turns."""
    said = stored(_turns(spark, folder))
    kept = _kept(spark, folder, said).select("conv_no", "user_words")
    out = said.where("role = 'user'").join(kept, "conv_no", "left_semi").agg(F.sum(X.words(X.fold(F.col("text")))).cast("long").alias("words_out"))
    both = kept.agg(F.sum("user_words").cast("long").alias("words_in")).join(out, F.lit(True))  # one row on either side
    return both.withColumn("reconciled", F.col("words_out") >= F.col("words_in") * 0.98)


def _transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_no, pos, role, text, ts) of the documents that are transcripts: read back from markdown."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text", "source")).where("lower(trim(source)) = 'transcript'")
    return markdown.dialogue(docs.select(F.col("doc_id").alias("file"), F.col("text").alias("content"))).select(F.col("file").alias("conv_no"), "pos", "role", "text", F.lit(None).cast("double").alias("ts"))


def transcript_turns(spark: SparkSession, folder: str) -> DataFrame:
    return _transcripts(spark, folder).select(F.col("conv_no").alias("doc_id"), "pos", "role", "text")


def transcript_echoes(spark: SparkSession, folder: str) -> DataFrame:
    return A.credited(_transcripts(spark, folder)).where("echo_share > 0").select(F.col("conv_no").alias("doc_id"), "pos", F.round("echo_share", 6).alias("echo_share"), "echoed")


def _message_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The kept messages of the archive as turns, by position. One conversation holds a large share of them."""
    m = table(spark, folder, "messages").where("conversation_id is not null and node_id is not null and node_pos is not null")
    last = F.max(F.struct("ingested_at", "msg_id", "role", "content_type", "parts", "hidden", "create_time", "node_pos")).alias("m")
    once = m.groupBy("conversation_id", "node_id").agg(last).select("conversation_id", "m.*")
    kept = once.where(F.lower("role").isin("user", "assistant") & F.col("content_type").isin(*P.TEXT_TYPES) & ~F.coalesce("hidden", F.lit(False)))
    return kept.select(F.xxhash64("conversation_id").alias("conv_no"), "conversation_id", F.col("node_pos").cast("int").alias("pos"), F.lower("role").alias("role"), F.explode(F.array(X.message_text(F.col("parts")))).alias("text"), F.nullif("create_time", F.lit(0.0)).alias("ts")).where("text <> ''").dropDuplicates(["conv_no", "pos"])


def message_echoes(spark: SparkSession, folder: str) -> DataFrame:
    """Words of user messages that repeat the assistant message before them, by conversation."""
    said = stored(_message_turns(spark, folder))
    by = A.credited(said).where("echoed > 0").groupBy("conv_no").agg(F.count("*").alias("turns"), F.sum("echoed").alias("echoed"))
    return by.join(said.select("conv_no", "conversation_id").distinct(), "conv_no").select("conversation_id", "turns", "echoed")


def rescanned_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts scored from what they say alone, as an index without the fields of authorship is read again."""
    m = A.metrics(_transcripts(spark, folder))
    return m.select(F.col("conv_no").alias("doc_id"), *catalog.RESCANNED[:8], shortlist.score(has_content_days=False).alias("score"))


def _index(spark: SparkSession, folder: str) -> DataFrame:
    """conv_index with one row per file: the latest export, then the most user turns."""
    rows = table(spark, folder, "conv_index")
    best = F.max(F.struct("exported_at", "user_turns", *[c for c in rows.columns if c not in ("exported_at", "user_turns", "file")])).alias("r")
    return rows.groupBy("file").agg(best).select("file", "r.*")


def branch_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return shortlist.mark_branches(_index(spark, folder)).where("branch_dup or branch_of is not null").select("file", "branch_dup", "branch_of")


def index_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _index(spark, folder).select("file", shortlist.score().alias("score"))


def topic_routes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _index(spark, folder).select("file", F.array_join(shortlist.topics(CONFIG), " ").alias("topics"))
    return rows.where("topics <> ''")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return shortlist.scored(shortlist.mark_branches(_index(spark, folder)), CONFIG, AS_OF)


def delta_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).where("delta_candidate").select("file", "age_days", F.array_join("topics", " ").alias("topics"))


def review_states(spark: SparkSession, folder: str) -> DataFrame:
    return shortlist.review_state(_index(spark, folder), _ledger(spark, folder)).select("file", F.coalesce("review_state", F.lit("unreviewed")).alias("review_state"))


def ledger_records(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder)


def review_shortlist(spark: SparkSession, folder: str) -> DataFrame:
    rows = shortlist.review_state(_scored(spark, folder), _ledger(spark, folder)).where("review_state is null or review_state <> 'reviewed'")
    return shortlist.shortlist(rows, TOP).select("file", "score", "delta_candidate", F.coalesce("review_state", F.lit("new")).alias("review_state"))


def delta_shortlist(spark: SparkSession, folder: str) -> DataFrame:
    return shortlist.delta_list(_scored(spark, folder), TOP).select("file", "score", "in_top")


def format_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.messages(table(spark, folder, "conversations"))


def format_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return profile.verdict(table(spark, folder, "conversations"))


def _notes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("lower(trim(source)) in ('note_staged', 'note_final')")
    return docs.select(F.format_string("note-%d.md", "doc_id").alias("file"), F.col("text").alias("content"))


def note_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return verify.quotes(_notes(spark, folder)).select("file", "line", "quote")


def quote_checks(spark: SparkSession, folder: str) -> DataFrame:
    return verify.check(_notes(spark, folder), _turns(spark, folder))


def excerpt_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The beginning of every transcript turn as a quotation, checked against the transcripts: every status occurs."""
    said = stored(_transcripts(spark, folder))
    start = F.regexp_replace(F.regexp_replace(F.substring("text", 1, 90), '["\n`“”\\[]', " "), r"\s+$", "")
    notes = said.select(F.format_string("note-%d-%d.md", "conv_no", "pos").alias("file"), F.concat(F.lit('> "'), start, F.lit('"')).alias("content"))
    return verify.check(notes, said).select("file", "status", "labeled")


def quote_summary(spark: SparkSession, folder: str) -> DataFrame:
    return verify.summary(quote_checks(spark, folder))


def _shortlists(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("lower(trim(source)) = 'shortlist'").select("doc_id", "text")


def shortlist_marks(spark: SparkSession, folder: str) -> DataFrame:
    return review.shortlist_rows(_shortlists(spark, folder)).select("doc_id", "line", "ticked", F.array_join("stems", " ").alias("stems"))


def shortlist_sync(spark: SparkSession, folder: str) -> DataFrame:
    """Names that shortlists tick, and names that wait for a tick."""
    return review.sync(_shortlists(spark, folder), table(spark, folder, "conv_index"))


def unknown_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticked rows that name no conversation of the index."""
    return review.unknown_rows(_shortlists(spark, folder), table(spark, folder, "conv_index"))


def _ticked(spark: SparkSession, folder: str) -> DataFrame:
    return review.shortlist_rows(_shortlists(spark, folder)).where("ticked").select(F.explode("stems").alias("stem"))


def marked_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger after every name that a ticked row links to is recorded as reviewed."""
    return review.mark_stems(_ledger(spark, folder), table(spark, folder, "conv_index"), _ticked(spark, folder), "reviewed", AS_OF)[0]


def ledger_counts(spark: SparkSession, folder: str) -> DataFrame:
    return review.state_counts(_index(spark, folder), _ledger(spark, folder))


def note_problems(spark: SparkSession, folder: str) -> DataFrame:
    """What stands against each staged note: its form, its sources, its quotations, and a finished note of its name."""
    notes = _notes(spark, folder)
    final = table(spark, folder, "documents").where("lower(trim(source)) = 'note_final'").select(F.format_string("note-%d.md", "doc_id").alias("file"))
    rows = review.note_problems(notes, table(spark, folder, "conv_index"), verify.check(notes, _turns(spark, folder)), final)
    return rows.select("file", F.array_join("problems", "; ").alias("problems"), F.size("cited").alias("cited"))


def promoted_pending(spark: SparkSession, folder: str) -> DataFrame:
    """What the promotion of all notes without a fault of form or source leaves pending, by key."""
    notes = _notes(spark, folder)
    index = table(spark, folder, "conv_index")
    none = spark.createDataFrame([], sinks.PENDING_SCHEMA)
    waiting = review.promote(notes, review.note_problems(notes, index), none, index)[1]
    return waiting.select("rec_key", "file", "user_turns", F.array_join("notes", " ").alias("notes"))


QUERIES = {
    f.__name__: f
    for f in (
        authorship_shortlist, linearized_turns, turn_labels, document_labels, voice_scores, label_calibration, voice_histogram, voice_near_floor, echo_shares, normalised_documents, document_terms, conv_metrics, span_hours,
        file_names, intake_account, archive_totals, year_rollup, chunk_pack, chunk_manifest, word_reconciliation, branch_duplicates, index_scores, topic_routes, delta_candidates, review_states, ledger_records,
        review_shortlist, delta_shortlist, format_profile, format_verdict, note_quotes, quote_checks, excerpt_checks, quote_summary, shortlist_marks, note_problems,
        unreviewed_chunks, first_conversations, transcript_turns, transcript_echoes, message_echoes, rescanned_scores, shortlist_sync, unknown_marks, marked_ledger, ledger_counts, promoted_pending,
    )
}

# -- SQL --------------------------------------------------------------------------

_DOCS = f"""WITH d AS (SELECT doc_id AS conv_no, text, {S.prose('text')} AS prose FROM documents WHERE text IS NOT NULL),
folded AS (SELECT *, {S.fold('prose')} AS f, {S.fold('text')} AS fa FROM d),
counted AS (SELECT *, {S.n('f', P.WORD)} AS n_prose, {S.n('fa', P.WORD)} AS n_all FROM folded),
labelled AS (SELECT *, {S.label('f', 'n_prose')} AS label FROM counted)"""
_T = f"WITH RECURSIVE {S.TURNS}"
_C = f"{_T}, {S.CREDITED}"
_M = f"{_C}, {S.metrics()}"
_TITLES = f"""titled AS (
  SELECT conv_no, coalesce(nullif(title, ''), 'Untitled') AS title, coalesce(strftime(make_timestamp((nullif(create_time, 0) * 1000000)::BIGINT), '%Y-%m-%d'), '0000-00-00') AS conv_date,
    coalesce(nullif(regexp_replace(substring(regexp_replace({S.strip("regexp_replace(lower(coalesce(nullif(title, ''), 'untitled')), '[^\\p{L}\\p{N}_\\s-]', '', 'g')")}, '[\\s_]+', '-', 'g'), 1, 60), '-+$', ''), ''), 'untitled') AS slug
  FROM latest)"""
_KEPT = f"""{_M}, {_TITLES},
kept AS (
  SELECT *, base || CASE WHEN k > 1 THEN '-' || k ELSE '' END || '.md' AS file FROM (
    SELECT m.*, t.title, t.conv_date, t.conv_date || '-' || t.slug AS base, row_number() OVER (PARTITION BY t.conv_date || '-' || t.slug ORDER BY m.conv_no) AS k
    FROM metrics m JOIN titled t USING (conv_no) WHERE m.user_words >= {FLOOR}))"""
_BLOCKS = f"""{_KEPT},
spoken AS (SELECT conv_no, string_agg(text, chr(10) || '---' || chr(10) ORDER BY pos) AS said FROM turns WHERE role = 'user' GROUP BY 1),
blocks AS (
  SELECT *, length(text) // 4 AS tokens FROM (
    SELECT k.conv_no, k.file, k.conv_date, chr(10) || chr(10) || '## [[' || regexp_replace(k.file, '\\.md$', '') || ']] - ' || k.title || chr(10) || '*' || k.conv_date || ' · ' || k.user_words || 'w · ' || k.user_turns || ' turns · ' || k.days_touched || ' days*' || chr(10) || s.said AS text
    FROM kept k JOIN spoken s USING (conv_no)))"""
_FOLD = f"""placed AS (SELECT *, row_number() OVER (ORDER BY conv_date, file) AS i FROM blocks),
packed(i, chunk, held) AS (
  SELECT i, 1::BIGINT, tokens FROM placed WHERE i = 1
  UNION ALL
  SELECT p.i, CASE WHEN c.held + p.tokens > {BUDGET} THEN c.chunk + 1 ELSE c.chunk END, CASE WHEN c.held + p.tokens > {BUDGET} THEN p.tokens ELSE c.held + p.tokens END
  FROM packed c JOIN placed p ON p.i = c.i + 1)"""
_PACK = f"{_BLOCKS}, {_FOLD}"
_INDEX = """idx AS (SELECT * FROM conv_index QUALIFY row_number() OVER (PARTITION BY file ORDER BY exported_at DESC NULLS LAST, user_turns DESC NULLS LAST) = 1)"""
_BRANCH = f"""{_INDEX},
tt AS (SELECT *, lower({S.strip("coalesce(title, '')")}) AS t FROM idx),
par AS (SELECT t AS pt, file AS p_file, user_words AS p_words FROM tt),
forks AS (SELECT file AS fork, user_words AS words, lower({S.strip(f"regexp_replace(t, {S.q('(?i)' + P.BRANCH_TITLE)}, '')")}) AS pt FROM tt WHERE {S.has('t', P.BRANCH_TITLE)}),
pairs AS (SELECT * FROM forks JOIN par USING (pt) WHERE p_file <> fork QUALIFY row_number() OVER (PARTITION BY fork ORDER BY p_file) = 1),
fates AS (SELECT fork, CASE WHEN words >= p_words THEN p_file ELSE fork END AS loser, CASE WHEN words >= p_words THEN fork ELSE p_file END AS keeper FROM pairs),
lost AS (SELECT loser AS file, max_by(keeper, fork) AS kept_file FROM fates GROUP BY 1),
marked AS (
  SELECT i.* EXCLUDE (branch_dup, branch_of), l.file IS NOT NULL AS branch_dup, coalesce(l.kept_file, f.keeper) AS branch_of
  FROM idx i LEFT JOIN lost l ON l.file = i.file LEFT JOIN fates f ON f.fork = i.file)"""
_DATED = " OR ".join(f"(list_contains(topics, {S.q(c['topic'])}) AND coalesce(conv_date, '0000-00-00') < {S.q(c['date'])})" for c in CONFIG.position_changes)
_LOOSE = [t for t in CONFIG.volatile if t not in {c["topic"] for c in CONFIG.position_changes}]
_SCORED = f"""WITH {_BRANCH},
routed AS (SELECT *, {S.topics(CONFIG)} AS topics, round_even({S.score(CONFIG)}, 2) AS score,
  coalesce(date_diff('day', try_strptime(conv_date, '%Y-%m-%d')::DATE, DATE '{AS_OF}'), 0)::INTEGER AS age_days FROM marked),
scored AS (SELECT *, ({_DATED}) OR (list_has_any(topics, [{', '.join(map(S.q, _LOOSE))}]) AND age_days > {CONFIG.stale_after_days}) AS delta_candidate FROM routed)"""
_LEDGER = """rec AS (
  SELECT coalesce(nullif(conversation_id, ''), file) AS rec_key, CASE WHEN max(CASE lower(trim(status)) WHEN 'promoted' THEN 2 ELSE 1 END) = 2 THEN 'promoted' ELSE 'reviewed' END AS status,
         max(marked_on) AS marked_on, max(user_turns) AS seen_turns
  FROM ledger WHERE lower(trim(status)) IN ('reviewed', 'promoted') AND coalesce(nullif(conversation_id, ''), file) IS NOT NULL GROUP BY 1)"""
_UNREVIEWED = f"""{_BLOCKS.replace("blocks AS (", "all_blocks AS (", 1)}, {_LEDGER},
ids AS (SELECT conv_no, coalesce(nullif(conversation_id, ''), id) AS conversation_id FROM latest),
blocks AS (
  SELECT b.* FROM all_blocks b JOIN kept k USING (conv_no) JOIN ids USING (conv_no) LEFT JOIN rec r ON r.rec_key = coalesce(nullif(ids.conversation_id, ''), b.file)
  WHERE r.rec_key IS NULL OR coalesce(k.user_turns > r.seen_turns, false)),
{_FOLD}"""
_SPEAKER = r"(?m)^(?:## Me|### ChatGPT)$"
_FILES = f"""spoken_parts AS (
  SELECT doc_id, regexp_extract_all(body, {S.q('(?m)^(## Me|### ChatGPT)$')}) AS who, string_split_regex(body, {S.q(_SPEAKER)}) AS said FROM (
    SELECT doc_id, regexp_replace(text, {S.q(markdown.FRONTMATTER)}, '') AS body FROM documents WHERE lower(trim(source)) = 'transcript' AND text IS NOT NULL)),
turns AS (
  SELECT * FROM (
    SELECT doc_id AS conv_no, (i - 1)::INTEGER AS pos, CASE WHEN who[i] = '## Me' THEN 'user' ELSE 'assistant' END AS role, {S.strip('said[i + 1]')} AS text, NULL::DOUBLE AS ts
    FROM (SELECT *, unnest(range(1, len(who) + 1)) AS i FROM spoken_parts)) WHERE text <> '')"""
_MESSAGES = f"""once AS (SELECT * FROM messages WHERE conversation_id IS NOT NULL AND node_id IS NOT NULL AND node_pos IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conversation_id, node_id ORDER BY ingested_at DESC NULLS LAST, msg_id DESC) = 1),
turns AS (
  SELECT * FROM (
    SELECT conversation_id AS conv_no, node_pos AS pos, lower(role) AS role, nullif(create_time, 0) AS ts,
      {S.strip(f"array_to_string(list_filter(list_transform(parts, lambda p: {S.part_text('p')}), lambda t: t <> ''), chr(10))")} AS text
    FROM once WHERE lower(role) IN ('user', 'assistant') AND content_type IN ('text', 'multimodal_text') AND NOT coalesce(hidden, false)) WHERE text <> '')"""
_NOTES = """notes AS (SELECT 'note-' || doc_id || '.md' AS file, text AS content FROM documents WHERE lower(trim(source)) IN ('note_staged', 'note_final'))"""
_ROWS = """marks AS (
  SELECT doc_id, line, ticked, stems FROM (
    SELECT doc_id, line::INTEGER AS line, regexp_matches(row, '^\\|\\s*\\[[xX]\\]') AS ticked,
      list_filter(list_transform(regexp_extract_all(row, '\\[\\[[^\\]|\\\\]+|\\]\\([^)]+?\\.md\\)'), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '^\\[\\[|^\\]\\(', ''), '\\.md\\)$', ''), CASE WHEN x LIKE '[[%' THEN '^$' ELSE '.*/' END, ''))), lambda x: x <> '') AS stems
    FROM (SELECT doc_id, i AS line, lines[i] AS row FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE lower(trim(source)) = 'shortlist')))
    WHERE row LIKE '|%') WHERE len(stems) > 0),
known AS (SELECT regexp_replace(file, '\\.md$', '') AS stem, file, max(user_turns) AS user_turns, arg_max(conversation_id, (coalesce(user_turns, -1), coalesce(conversation_id, ''))) AS conversation_id FROM conv_index WHERE file IS NOT NULL GROUP BY 1, 2),
named AS (SELECT m.doc_id, m.line, m.ticked, m.k, m.stems[m.k] AS stem FROM (SELECT *, unnest(range(1, len(stems) + 1)) AS k FROM marks) m WHERE m.stems[m.k] IN (SELECT stem FROM known))"""
_STATE = "CASE WHEN r.rec_key IS NULL THEN NULL WHEN i.user_turns > r.seen_turns THEN 'continued' ELSE 'reviewed' END"
_PROFILE = f"""WITH m AS (SELECT unnest(map_values(mapping)).message AS m FROM conversations WHERE mapping IS NOT NULL),
k AS (
  SELECT coalesce(nullif(lower(m.author.role), ''), '(none)') AS role, CASE WHEN m.content IS NULL THEN '(no content)' ELSE coalesce(nullif(m.content.content_type, ''), '(none)') END AS content_type,
    coalesce(len(list_filter(string_split_regex(array_to_string(list_transform(m.content.parts, lambda p: {S.part_text('p')}), ' '), {S.q(S._BLANK + '+')}), lambda w: w <> '')), 0) AS w
  FROM m WHERE m IS NOT NULL),
kinds AS (
  SELECT role, content_type, count(*) AS messages, sum(w)::BIGINT AS words, count(*) FILTER (w > 0) AS with_text,
    CASE WHEN role NOT IN ('user', 'assistant', 'system', 'tool') THEN 'unknown role' WHEN role NOT IN ('user', 'assistant') THEN 'dropped role' WHEN content_type = '(no content)' THEN 'no content'
         WHEN content_type IN ('text', 'multimodal_text') THEN 'kept' WHEN content_type IN ({', '.join(map(S.q, P.EXPECTED_DROPS))}) THEN 'dropped type' ELSE 'unknown type' END AS handled
  FROM k GROUP BY 1, 2)"""

SQL = {
    "authorship_shortlist": f"""{_M}, {_TITLES} SELECT conv_no, title, round_even({S.score()}, 2) AS score, authored_words, own_voice_words, max_user_turn_words, authored_turns, days_touched
FROM metrics JOIN titled USING (conv_no) ORDER BY score DESC, conv_no LIMIT {TOP}""",
    "linearized_turns": f"{_T} SELECT conv_no, conversation_id, pos, role, text, ts FROM turns",
    "turn_labels": f"{_C} SELECT conv_no, pos, label, n_all, n_prose FROM labelled",
    "document_labels": f"{_DOCS} SELECT conv_no AS doc_id, label, n_all, n_prose FROM labelled",
    "voice_scores": f"{_DOCS} SELECT conv_no AS doc_id, round({S.voice('f', 'n_prose')}, 4) AS voice_score FROM labelled",
    "label_calibration": f"""{_DOCS}, x AS (SELECT label, 1 AS t, n_prose AS w FROM labelled UNION ALL SELECT 'pasted', 0, n_all - n_prose FROM labelled),
b AS (SELECT label, sum(t)::BIGINT AS turns, sum(w)::BIGINT AS words FROM x GROUP BY 1)
SELECT label, turns, words, round(coalesce(words::DOUBLE / nullif(sum(words) OVER (), 0), 0), 6) AS share FROM b WHERE turns > 0 OR words > 0""",
    "voice_histogram": f"""{_DOCS}, b AS (SELECT (floor({S.voice('f', 'n_prose')} / 4) * 4)::BIGINT AS bucket FROM labelled WHERE n_prose >= {P.LONG_TURN_WORDS})
SELECT bucket, count(*) AS turns, bucket <= {P.AUTHORED_FLOOR} AND bucket + 4 > {P.AUTHORED_FLOOR} AS at_floor FROM b GROUP BY 1""",
    "voice_near_floor": f"""{_DOCS}, s AS (SELECT conv_no, label, {S.voice('f', 'n_prose')} AS score FROM labelled WHERE n_prose >= {P.LONG_TURN_WORDS} AND label <> 'own_voice')
SELECT conv_no, 0::INTEGER AS pos, label, round(score, 4) AS score FROM s WHERE abs(score - {P.AUTHORED_FLOOR}) < 6 ORDER BY md5('0-' || conv_no || '-0'), conv_no LIMIT 10""",
    "echo_shares": f"{_C} SELECT conv_no, pos, round(echo_share, 6) AS echo_share, echoed FROM credited WHERE echo_share > 0",
    "normalised_documents": f"SELECT doc_id, md5({S.norm('text')}) AS norm_md5 FROM documents WHERE text IS NOT NULL",
    "document_terms": f"{_DOCS}, {S.term_bags('labelled')} SELECT conv_no AS doc_id, array_to_string(terms, ' ') AS terms FROM bags",
    "conv_metrics": f"{_M} SELECT conv_no, {', '.join(METRICS)}, array_to_string(terms, ' ') AS terms FROM metrics",
    "span_hours": f"{_M} SELECT conv_no, round(span_hours, 4) AS span_hours FROM metrics",
    "file_names": f"{_KEPT} SELECT conv_no, file FROM kept",
    "intake_account": f"""{_C}, w AS (SELECT conv_no, sum(n_all) AS w FROM labelled GROUP BY 1), present AS (SELECT DISTINCT conv_no FROM turns)
SELECT CASE WHEN s.conv_no IS NULL THEN 'empty' WHEN coalesce(w.w, 0) < {FLOOR} THEN 'short' ELSE 'kept' END AS fate, count(*) AS conversations
FROM latest l LEFT JOIN present s ON s.conv_no = l.conv_no LEFT JOIN w ON w.conv_no = l.conv_no GROUP BY 1""",
    "archive_totals": f"""{_M} SELECT count(*) AS conversations, coalesce(sum(user_words), 0)::BIGINT AS user_words, coalesce(sum(authored_words), 0)::BIGINT AS authored_words, coalesce(sum(pasted_words), 0)::BIGINT AS pasted_words,
  coalesce(sum(echoed_words), 0)::BIGINT AS echoed_words, count(*) FILTER (coursework) AS coursework, count(*) FILTER (own_voice_words > 0) AS with_memos FROM metrics WHERE user_words >= {FLOOR}""",
    "year_rollup": f"{_BLOCKS} SELECT substring(conv_date, 1, 4) AS year, count(*) AS conversations, sum(length(text))::BIGINT AS chars, (sum(length(text)) // 4)::BIGINT AS tokens FROM blocks GROUP BY 1",
    "chunk_pack": f"{_PACK} SELECT p.conv_no, p.tokens::BIGINT AS tokens, c.chunk FROM packed c JOIN placed p USING (i)",
    "chunk_manifest": f"""{_PACK} SELECT c.chunk, min(p.conv_date) AS from_date, max(p.conv_date) AS to_date, count(*) AS conversations, (sum(length(p.text)) // 4)::BIGINT AS tokens,
  sum(length(p.text)) // 4 > {BUDGET} AS oversized FROM packed c JOIN placed p USING (i) GROUP BY 1""",
    "word_reconciliation": f"""{_KEPT}, o AS (SELECT sum(n_all)::BIGINT AS words_out FROM credited WHERE conv_no IN (SELECT conv_no FROM kept)), i AS (SELECT sum(user_words)::BIGINT AS words_in FROM kept)
SELECT words_in, words_out, words_out >= words_in * 0.98 AS reconciled FROM i, o""",
    "branch_duplicates": f"WITH {_BRANCH} SELECT file, branch_dup, branch_of FROM marked WHERE branch_dup OR branch_of IS NOT NULL",
    "index_scores": f"WITH {_INDEX} SELECT file, round_even({S.score()}, 2) AS score FROM idx",
    "topic_routes": f"WITH {_INDEX}, t AS (SELECT file, array_to_string({S.topics(CONFIG)}, ' ') AS topics FROM idx) SELECT * FROM t WHERE topics <> ''",
    "delta_candidates": f"{_SCORED} SELECT file, age_days, array_to_string(topics, ' ') AS topics FROM scored WHERE delta_candidate",
    "review_states": f"""WITH {_INDEX}, {_LEDGER} SELECT i.file, coalesce({_STATE}, 'unreviewed') AS review_state FROM idx i LEFT JOIN rec r ON r.rec_key = coalesce(nullif(i.conversation_id, ''), i.file)""",
    "ledger_records": f"WITH {_LEDGER} SELECT * FROM rec",
    "review_shortlist": f"""{_SCORED}, {_LEDGER}, s AS (SELECT i.*, {_STATE} AS review_state FROM scored i LEFT JOIN rec r ON r.rec_key = coalesce(nullif(i.conversation_id, ''), i.file))
SELECT file, score, delta_candidate, coalesce(review_state, 'new') AS review_state FROM s WHERE NOT branch_dup AND coalesce(review_state, '') <> 'reviewed' ORDER BY score DESC, file LIMIT {TOP}""",
    "delta_shortlist": f"""{_SCORED}, top AS (SELECT file FROM scored WHERE NOT branch_dup ORDER BY score DESC, file LIMIT {TOP})
SELECT file, score, file IN (SELECT file FROM top) AS in_top FROM scored WHERE NOT branch_dup AND delta_candidate ORDER BY score DESC, file LIMIT {max(TOP // 2, 20)}""",
    "format_profile": f"{_PROFILE} SELECT * FROM kinds",
    "format_verdict": f"""{_PROFILE},
o AS (SELECT count(*) AS conversations, count(*) FILTER (mapping IS NULL) AS no_mapping, count(*) FILTER (coalesce(create_time, 0) = 0) AS no_create_time,
  count(*) FILTER (mapping IS NOT NULL AND (current_node IS NULL OR NOT list_contains(map_keys(mapping), current_node))) AS no_current_node FROM conversations),
t AS (SELECT coalesce(sum(with_text) FILTER (role = 'user' AND handled = 'kept'), 0)::BIGINT AS user_with_text, coalesce(sum(messages) FILTER (handled IN ('unknown type', 'unknown role')), 0)::BIGINT AS unknown FROM kinds)
SELECT o.*, t.*, CASE WHEN conversations = 0 THEN 'no conversations' WHEN no_mapping > greatest(1, conversations * {profile.MAX_BAD_SHARE}) THEN 'mapping is missing' WHEN user_with_text = 0 THEN 'no user text' ELSE '' END AS error FROM o, t""",
    **S.quotation_queries(_T, _NOTES, "turns"),
    "excerpt_checks": f"""WITH {_FILES}, notes AS (SELECT 'note-' || conv_no || '-' || pos || '.md' AS file, '> "' || regexp_replace(regexp_replace(substring(text, 1, 90), '["\n`“”\\[]', ' ', 'g'), '\\s+$', '') || '"' AS content FROM turns),
{S.quoted()}, {S.checked()} SELECT file, status, labeled FROM checks""",
    "unreviewed_chunks": f"{_UNREVIEWED} SELECT p.conv_no, p.tokens::BIGINT AS tokens, c.chunk FROM packed c JOIN placed p USING (i)",
    "first_conversations": "SELECT DISTINCT conv_no FROM conversations WHERE conv_no IS NOT NULL ORDER BY conv_no LIMIT 25",
    "transcript_turns": f"WITH {_FILES} SELECT conv_no AS doc_id, pos, role, text FROM turns",
    "transcript_echoes": f"WITH {_FILES}, {S.CREDITED} SELECT conv_no AS doc_id, pos, round(echo_share, 6) AS echo_share, echoed FROM credited WHERE echo_share > 0",
    "message_echoes": f"WITH {_MESSAGES}, {S.CREDITED} SELECT conv_no AS conversation_id, count(*) AS turns, sum(echoed)::BIGINT AS echoed FROM credited WHERE echoed > 0 GROUP BY 1",
    "rescanned_scores": f"""WITH {_FILES}, {S.CREDITED}, {S.metrics()}
SELECT conv_no AS doc_id, {', '.join(catalog.RESCANNED[:8])}, round_even({S.score().replace("content_days", "NULL::BIGINT")}, 2) AS score FROM metrics""",
    "shortlist_sync": f"""WITH {_ROWS}, s AS (SELECT min_by(stem, k) AS stem, true AS ticked FROM named WHERE ticked GROUP BY doc_id, line UNION ALL SELECT stem, false FROM named WHERE NOT ticked)
SELECT stem, bool_or(ticked) AS ticked FROM s GROUP BY 1""",
    "unknown_marks": f"WITH {_ROWS} SELECT doc_id, line FROM marks m WHERE ticked AND NOT EXISTS (SELECT 1 FROM named n WHERE n.doc_id = m.doc_id AND n.line = m.line)",
    "marked_ledger": f"""WITH {_LEDGER}, {_ROWS}, t AS (SELECT DISTINCT unnest(stems) AS stem FROM marks WHERE ticked),
new AS (SELECT coalesce(nullif(k.conversation_id, ''), k.file) AS rec_key, max(k.user_turns) AS turns FROM known k JOIN t USING (stem) GROUP BY 1)
SELECT coalesce(r.rec_key, n.rec_key) AS rec_key, CASE WHEN n.rec_key IS NULL OR r.status = 'promoted' THEN r.status ELSE 'reviewed' END AS status,
  CASE WHEN n.rec_key IS NULL THEN r.marked_on ELSE '{AS_OF}' END AS marked_on, CASE WHEN n.rec_key IS NULL THEN r.seen_turns ELSE n.turns END AS seen_turns
FROM rec r FULL JOIN new n ON n.rec_key = r.rec_key""",
    "ledger_counts": f"""WITH {_INDEX}, {_LEDGER} SELECT coalesce({_STATE}, 'unreviewed') AS state, count(*) AS conversations FROM idx i LEFT JOIN rec r ON r.rec_key = coalesce(nullif(i.conversation_id, ''), i.file) GROUP BY 1
UNION ALL SELECT 'recorded as ' || status, count(*) FROM rec GROUP BY 1""",
    "shortlist_marks": """WITH r AS (
  SELECT doc_id, i AS line, lines[i] AS row FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE lower(trim(source)) = 'shortlist'))),
s AS (SELECT doc_id, line::INTEGER AS line, regexp_matches(row, '^\\|\\s*\\[[xX]\\]') AS ticked,
  list_filter(list_transform(regexp_extract_all(row, '\\[\\[[^\\]|\\\\]+|\\]\\([^)]+?\\.md\\)'), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '^\\[\\[|^\\]\\(', ''), '\\.md\\)$', ''), CASE WHEN x LIKE '[[%' THEN '^$' ELSE '.*/' END, ''))), lambda x: x <> '') AS stems FROM r WHERE row LIKE '|%')
SELECT doc_id, line, ticked, array_to_string(stems, ' ') AS stems FROM s WHERE len(stems) > 0""",
}
