"""Queries of the language-model problems, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm import encode, mixing, pii, ranking, rebuild, spans, splitting, sql
from threadmill.session import spread, table


def _spread(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table; its rows are spread over all cores if its files are too few for them."""
    return spread(table(spark, folder, name).select(*columns))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found(_spread(spark, folder, "messages", "msg_id", "parts"))


def p2_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Every message's parts with typed placeholders."""
    return pii.redacted(_spread(spark, folder, "messages", "msg_id", "parts"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.Shared(table(spark, folder, "messages")).pairs()


def p4_shares(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each message stands elsewhere, beside what the index counts as echoed in its conversation."""
    messages = table(spark, folder, "messages")
    echoed = table(spark, folder, "conv_index").groupBy("conversation_id").agg(F.max("echoed_words").alias("echoed_words"))
    home = messages.groupBy("msg_id").agg(F.min("conversation_id").alias("conversation_id"))
    return spans.Shared(messages).shares().join(home, "msg_id", "left").join(echoed, "conversation_id", "left")


def p4_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The long parts without the passages an earlier message holds."""
    return spans.Shared(table(spark, folder, "messages")).cleaned().select("msg_id", "kept")


def p5_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its median and mean rank."""
    return ranking.aggregate(table(spark, folder, "conv_index"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top(table(spark, folder, "conv_index"), 10).select("rec_key")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return rebuild.dropped(table(spark, folder, "messages"), table(spark, folder, "conv_heads"))


def p6_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The kept conversations as ordered turns."""
    return rebuild.Rebuilt(table(spark, folder, "messages"), table(spark, folder, "conv_heads")).turns()


def p6_identified(spark: SparkSession, folder: str) -> DataFrame:
    """Every message row with the conversation that reply and quote links alone give it, as if none had an identifier.

    A quote link leads to the first message (least node_id) that holds a long part word for word.
    """
    return rebuild.identified(table(spark, folder, "messages"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode(_spread(spark, folder, "documents", "doc_id", "text"))


def p8_digest(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of p8_ids as a count and a digest, to be compared where lists can't."""
    return p8_ids(spark, folder).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", " ")).alias("ids_md5"))


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """Each source's target, capacity and planned tokens in the mix of p9_shares, and what all its documents hold."""
    return mixing.plan(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """The sources whose fitted weight stays below their target."""
    return p9_report(spark, folder).where("short").select("source")


def p9_margins(spark: SparkSession, folder: str) -> DataFrame:
    """Goal and fit of every source, language and topic of the mix, with the rounds of raking and whether it converged."""
    return mixing.plan(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[2]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The actual shares of the drawn mix, every target listed."""
    targets = table(spark, folder, "mix_targets")
    return mixing.shares(mixing.mix(table(spark, folder, "documents"), targets), targets)


def p10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split(_spread(spark, folder, "documents", "doc_id", "text"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents the splitter had to cut: those with a second piece."""
    return p10_pieces(spark, folder).where("piece_no = 1").select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_redacted, p4_found, p4_shares, p4_cleaned, p5_found, p5_ranking, p6_found, p6_turns, p6_identified, p8_ids, p8_digest, p9_found, p9_report, p9_margins, p9_shares, p10_found, p10_pieces)}

_RANKED = """
WITH newest AS (
  SELECT coalesce(nullif(conversation_id, ''), file) AS rec_key,
         row_number() OVER (PARTITION BY coalesce(nullif(conversation_id, ''), file)
           ORDER BY user_turns DESC NULLS LAST, exported_at DESC NULLS LAST, authored_words DESC NULLS LAST, own_voice_words DESC NULLS LAST,
                    max_user_turn_words DESC NULLS LAST, code_ratio DESC NULLS LAST) AS k,
         authored_words, own_voice_words, max_user_turn_words, code_ratio
  FROM conv_index WHERE coalesce(nullif(conversation_id, ''), file) IS NOT NULL),
ranked AS (
  SELECT rec_key,
         [rank() OVER (ORDER BY authored_words DESC NULLS LAST), rank() OVER (ORDER BY own_voice_words DESC NULLS LAST),
          rank() OVER (ORDER BY max_user_turn_words DESC NULLS LAST), rank() OVER (ORDER BY code_ratio ASC NULLS LAST)] AS r
  FROM newest WHERE k = 1)
SELECT rec_key, (list_sort(r)[2] + list_sort(r)[3]) / 2.0::DOUBLE AS median_rank, list_sum(r)::DOUBLE / 4 AS mean_rank FROM ranked"""

_DROPPED = r"""
WITH RECURSIVE
node AS (
  SELECT conversation_id, node_id, node_pos, parent, lower(trim(role)) AS role,
         lower(trim(role)) IN ('user', 'assistant') AND NOT coalesce(hidden, false) AND content_type IN ('text', 'multimodal_text')
           AND len(list_filter(parts, lambda p: regexp_matches(
             CASE WHEN regexp_matches(p, '^\s*\{') AND json_valid(p) THEN coalesce(json_extract_string(p, '$.text'), '') ELSE p END, '\S'))) > 0 AS turn
  FROM messages WHERE conversation_id IS NOT NULL AND node_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conversation_id, node_id ORDER BY ingested_at DESC) = 1),
head AS (
  SELECT conversation_id, current_node FROM conv_heads WHERE conversation_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY exported_at DESC) = 1),
named AS (SELECT DISTINCT conversation_id, parent FROM node WHERE parent IS NOT NULL),
leaf AS (
  SELECT n.conversation_id, max_by(n.node_id, n.node_pos) AS node_id FROM node n
  ANTI JOIN named p ON p.conversation_id = n.conversation_id AND p.parent = n.node_id GROUP BY 1),
start AS (
  SELECT h.conversation_id, coalesce(n.node_id, l.node_id) AS node_id FROM head h
  LEFT JOIN node n ON n.conversation_id = h.conversation_id AND n.node_id = h.current_node
  LEFT JOIN leaf l ON l.conversation_id = h.conversation_id),
path(conversation_id, node_id, far) AS (
  SELECT conversation_id, node_id, 0 FROM start WHERE node_id IS NOT NULL
  UNION ALL
  SELECT p.conversation_id, n.parent, p.far + 1 FROM path p JOIN node n ON n.conversation_id = p.conversation_id AND n.node_id = p.node_id
  WHERE n.parent IS NOT NULL AND p.far <= (SELECT count(*) FROM node x WHERE x.conversation_id = p.conversation_id)),
walked AS (
  SELECT p.conversation_id, bool_or(n.parent IS NULL AND n.node_id IS NOT NULL) AS ok, min_by(n.role, p.far) FILTER (n.turn) AS last_turn
  FROM path p LEFT JOIN node n ON n.conversation_id = p.conversation_id AND n.node_id = p.node_id GROUP BY 1),
verdict AS (
  SELECT h.conversation_id,
         CASE WHEN h.conversation_id NOT IN (SELECT conversation_id FROM node) THEN 'empty'
              WHEN NOT coalesce(w.ok, false) THEN 'broken' WHEN w.last_turn IS NULL THEN 'empty' WHEN w.last_turn = 'user' THEN 'no_reply' END AS reason
  FROM head h LEFT JOIN walked w USING (conversation_id))
SELECT conversation_id, reason FROM verdict WHERE reason IS NOT NULL"""

_SHARED = r"""
WITH part AS (SELECT DISTINCT msg_id, unnest(parts) AS p FROM messages),
txt AS (SELECT DISTINCT msg_id, CASE WHEN regexp_matches(p, '^\s*\{') AND json_valid(p) THEN coalesce(json_extract_string(p, '$.text'), '') ELSE p END AS t FROM part),
gram AS (SELECT DISTINCT msg_id, t[i:i + 239] AS g FROM (SELECT msg_id, t, unnest(range(1, length(t) - 238)) AS i FROM txt WHERE length(t) >= 240)),
often AS (SELECT g FROM gram GROUP BY g HAVING count(*) > 1),
kept AS (SELECT msg_id, g FROM gram SEMI JOIN often USING (g))
SELECT DISTINCT a.msg_id AS msg_a, b.msg_id AS msg_b FROM kept a JOIN kept b ON a.g = b.g AND a.msg_id < b.msg_id"""

_IDENTIFIED = r"""
WITH RECURSIVE
rw AS (SELECT DISTINCT node_id, parent, parts FROM messages WHERE node_id IS NOT NULL),
part AS (SELECT node_id, CASE WHEN regexp_matches(p, '^\s*\{') AND json_valid(p) THEN coalesce(json_extract_string(p, '$.text'), '') ELSE p END AS t FROM (SELECT node_id, unnest(parts) AS p FROM rw)),
quote AS (SELECT node_id, min(node_id) OVER (PARTITION BY t) AS first FROM part WHERE length(t) >= 240),
link AS (SELECT node_id AS u, parent AS v FROM rw WHERE parent IS NOT NULL UNION SELECT node_id, first FROM quote),
edge AS (SELECT u, v FROM link WHERE u <> v UNION SELECT v, u FROM link WHERE u <> v),
cc(node, label) USING KEY (node) AS (
  SELECT node, min(node) AS label FROM (SELECT DISTINCT node_id AS node FROM rw UNION SELECT v FROM link) GROUP BY node
  UNION
  SELECT b.u, min(c.label) FROM cc c JOIN edge b ON b.v = c.node JOIN recurring.cc r ON r.node = b.u WHERE c.label < r.label GROUP BY b.u)
SELECT r.node_id, c.label AS conversation FROM (SELECT DISTINCT node_id FROM rw) r JOIN cc c ON c.node = r.node_id"""

_TURNS6 = _DROPPED[:_DROPPED.rindex("SELECT conversation_id, reason FROM verdict")] + r"""
SELECT conversation_id, (row_number() OVER (PARTITION BY conversation_id ORDER BY far DESC) - 1)::BIGINT AS turn_no, node_id, role, text FROM (
  SELECT p.conversation_id, p.far, n.node_id, n.role, array_to_string(list_filter(list_transform(m.parts, lambda p:
      CASE WHEN regexp_matches(p, '^\s*\{') AND json_valid(p) THEN coalesce(json_extract_string(p, '$.text'), '') ELSE p END), lambda t: regexp_matches(t, '\S')), chr(10)) AS text
  FROM path p JOIN node n USING (conversation_id, node_id) JOIN verdict v ON v.conversation_id = p.conversation_id AND v.reason IS NULL
  JOIN (SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY conversation_id, node_id ORDER BY ingested_at DESC) = 1) m ON m.conversation_id = p.conversation_id AND m.node_id = p.node_id
  WHERE n.turn)"""

_SHARES = _SHARED[:_SHARED.index("often AS")].replace("gram AS (SELECT DISTINCT msg_id, t[i:i + 239] AS g FROM", "gram AS (SELECT msg_id, t, i, t[i:i + 239] AS g FROM") + r"""
often AS (SELECT g FROM gram GROUP BY g HAVING count(DISTINCT msg_id) > 1),
place AS (SELECT DISTINCT msg_id, t, i FROM gram SEMI JOIN often USING (g)),
cover AS (SELECT msg_id, t, sum(least(240, coalesce(following - i, 240))) AS n FROM (SELECT *, lead(i) OVER (PARTITION BY msg_id, t ORDER BY i) AS following FROM place) GROUP BY 1, 2),
piece AS (SELECT DISTINCT msg_id, k, CASE WHEN regexp_matches(p, '^\s*\{') AND json_valid(p) THEN coalesce(json_extract_string(p, '$.text'), '') ELSE coalesce(p, '') END AS t
  FROM (SELECT msg_id, k, parts[k] AS p FROM (SELECT msg_id, parts, unnest(range(1, len(parts) + 1)) AS k FROM messages))),
total AS (SELECT m.msg_id, coalesce(sum(length(p.t)), 0)::BIGINT AS chars, coalesce(sum(c.n), 0)::BIGINT AS shared_chars
  FROM (SELECT DISTINCT msg_id FROM messages) m LEFT JOIN piece p USING (msg_id) LEFT JOIN cover c ON c.msg_id = p.msg_id AND c.t = p.t GROUP BY 1),
home AS (SELECT msg_id, min(conversation_id) AS conversation_id FROM messages GROUP BY 1),
echo AS (SELECT conversation_id, max(echoed_words) AS echoed_words FROM conv_index GROUP BY 1)
SELECT t.msg_id, chars, shared_chars, CASE WHEN chars > 0 THEN shared_chars::DOUBLE / chars ELSE 0.0 END AS share, h.conversation_id, e.echoed_words
FROM total t LEFT JOIN home h USING (msg_id) LEFT JOIN echo e USING (conversation_id)"""

SQL = {
    "p8_digest": f"SELECT doc_id, len(ids)::BIGINT AS n_tokens, md5(array_to_string(ids, ' ')) AS ids_md5 FROM ({sql.ids()})",
    "p9_found": sql.short_sources(),
    "p10_found": sql.oversized(),
    "p4_found": _SHARED,
    "p5_ranking": _RANKED,
    "p5_found": f"SELECT rec_key FROM ({_RANKED}) ORDER BY median_rank, mean_rank, rec_key LIMIT 10",
    "p6_found": _DROPPED,
    "p6_turns": _TURNS6,
    "p6_identified": _IDENTIFIED,
    "p4_shares": _SHARES,
}
