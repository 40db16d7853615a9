"""Queries of the general training-data problems, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.operators import drift, incremental, nested
from threadmill.session import table


def p1_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every work item as the ledger holds it after the recorded runs were replayed through it."""
    return incremental.replay(table(spark, folder, "conv_index"), table(spark, folder, "ledger"), table(spark, folder, "ledger_runs")).read().drop("lease_until", "lease_id")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The pending items of the ledger: new or grown since the last successful review."""
    return p1_items(spark, folder).where("state = 'pending'").select("rec_key")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.drift(table(spark, folder, "raw_shards"))


def p3_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All readable records as one consistent message table."""
    return drift.unify(table(spark, folder, "raw_shards"))


def p3_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The history of schema versions: what changed from one to the next, and the steps from each to the reference shape."""
    found = drift.history(table(spark, folder, "raw_shards"))
    return found.select("version_no", F.md5("version").alias("version"), "first_shard", "shards", "records", "changes", "steps")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested.links(nested.nodes(table(spark, folder, "conversations"))).select("conv_no", "parent_id", "child_id").distinct()


def p7_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Every node with its labels and the version of the record it comes from."""
    rows = table(spark, folder, "conversations")
    version = nested.versions(rows).select(F.col("conv_no").alias("_c"), F.col("rec").alias("_r"), "version")
    return nested.nodes(rows).join(version, F.col("conv_no").eqNullSafe(F.col("_c")) & (F.col("rec") == F.col("_r"))).drop("_c", "_r", "cross_parents")


def p7_records(spark: SparkSession, folder: str) -> DataFrame:
    return nested.records(table(spark, folder, "conversations")).drop("rec")


def _p7_messages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "conversations")
    labels = nested.nodes(rows)
    return nested.messages(rows, labels), labels


def p7_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with the node whose interval holds theirs."""
    said, labels = _p7_messages(spark, folder)
    return nested.within(said, labels, ["node_id"]).select("conv_no", "version", "node_id", "message_id", "role", "create_time", "content_type", "hidden", "n_parts")


def p7_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with the message, and the node of that, whose intervals hold theirs."""
    said, labels = _p7_messages(spark, folder)
    return nested.within(nested.parts(said), nested.within(said, labels, ["node_id"]), ["node_id"]).select("conv_no", "version", "node_id", "part_no", "part")


def p7_attachments(spark: SparkSession, folder: str) -> DataFrame:
    said, labels = _p7_messages(spark, folder)
    return nested.within(nested.attachments(said), nested.within(said, labels, ["node_id"]), ["node_id"]).select("conv_no", "version", "node_id", "attachment_no", "attachment_id", "mime", "size")


QUERIES = {f.__name__: f for f in (p1_found, p1_items, p3_found, p3_messages, p3_versions, p7_found, p7_nodes, p7_records, p7_messages, p7_parts, p7_attachments)}

_P1 = """
WITH items AS (
  SELECT coalesce(nullif(conversation_id, ''), file) AS rec_key, max(user_turns) AS size
  FROM conv_index GROUP BY 1 HAVING coalesce(nullif(conversation_id, ''), file) IS NOT NULL),
lr AS (
  SELECT coalesce(nullif(l.conversation_id, ''), l.file) AS rec_key, l.user_turns, lower(trim(l.status)) IN ('reviewed', 'promoted') AS fin,
         EXISTS (SELECT 1 FROM ledger_runs r WHERE r.run_id = l.run_id AND r.outcome = 'success') AS ok
  FROM ledger l),
done AS (SELECT rec_key, max(CASE WHEN ok AND fin THEN user_turns END) AS done_size, max(ok::INT) + max((NOT ok)::INT) AS token FROM lr WHERE rec_key IS NOT NULL GROUP BY 1)
SELECT i.rec_key, i.size, d.done_size,
       CASE WHEN d.done_size >= i.size OR (i.size IS NULL AND d.done_size IS NOT NULL) THEN 'done' ELSE 'pending' END AS state,
       coalesce(d.token, 0)::BIGINT AS token
FROM items i LEFT JOIN done d USING (rec_key)"""

_NODES = """
WITH v AS (SELECT conv_no, mapping, min(exported_at) AS version FROM conversations WHERE mapping IS NOT NULL GROUP BY 1, 2),
m AS (SELECT conv_no, version, unnest(map_entries(mapping)) AS e FROM v),
n AS (SELECT conv_no, version, e.key AS node_id, e.value AS node FROM m)"""

SQL = {
    "p1_items": _P1,
    "p1_found": f"SELECT rec_key FROM ({_P1}) WHERE state = 'pending'",
    "p7_found": f"""{_NODES},
named AS (SELECT DISTINCT conv_no, node_id FROM n),
stated AS (
  SELECT conv_no, node.parent AS parent_id, node_id AS child_id FROM n
  UNION SELECT conv_no, node_id, unnest(node.children) FROM n)
SELECT s.conv_no, s.parent_id, s.child_id FROM stated s
WHERE s.parent_id <> s.child_id
  AND EXISTS (SELECT 1 FROM named x WHERE x.conv_no = s.conv_no AND x.node_id = s.parent_id)
  AND EXISTS (SELECT 1 FROM named x WHERE x.conv_no = s.conv_no AND x.node_id = s.child_id)""",
    "p7_records": """SELECT DISTINCT conv_no, coalesce(nullif(conversation_id, ''), id) AS conversation_id, title, create_time, current_node,
  coalesce(cardinality(mapping), 0)::INTEGER AS n_nodes, exported_at FROM conversations""",
    "p7_messages": f"""{_NODES}
SELECT conv_no, version, node_id, node.message.id AS message_id, node.message.author.role AS role, node.message.create_time AS create_time,
  node.message.content.content_type AS content_type, node.message.metadata.is_visually_hidden_from_conversation AS hidden,
  len(node.message.content.parts)::INTEGER AS n_parts FROM n WHERE node.message IS NOT NULL""",
    "p7_parts": f"""{_NODES}
SELECT conv_no, version, node_id, (i - 1)::INTEGER AS part_no, node.message.content.parts[i] AS part
FROM (SELECT *, unnest(range(1, len(node.message.content.parts) + 1)) AS i FROM n WHERE node.message IS NOT NULL)""",
    "p7_attachments": f"""{_NODES}
SELECT conv_no, version, node_id, (i - 1)::INTEGER AS attachment_no, a.id AS attachment_id, a.mime AS mime, a.size AS size
FROM (SELECT *, node.message.metadata.attachments[i] AS a FROM
  (SELECT *, unnest(range(1, len(node.message.metadata.attachments) + 1)) AS i FROM n WHERE node.message IS NOT NULL))""",
}
