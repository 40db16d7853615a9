"""Nested conversations to turns: the active branch, filtered and in order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions import patterns as P
from threadmill.functions import text as X


def active_path(names: list[str], parents: list[str | None], current: str | None) -> list[str]:
    """Names from the root to ``current``, or to the last node nobody names as parent. Ends at unknown parents and before a node comes again."""
    at = dict(zip(names, parents))
    node = current
    if not node or node not in at:
        named = set(parents)
        node = next((n for n in reversed(names) if n not in named), None)
    path: dict[str, None] = {}
    while node and node in at and node not in path:
        path[node] = None
        node = at[node]
    return list(path)[::-1]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
        keys, paths = [], []
        for key, names, parents, current in rows:
            keys.append(key)
            paths.append(active_path(names or [], parents or [], current))
        yield pa.record_batch({"rec_id": pa.array(keys, pa.int64()), "path": pa.array(paths, pa.list_(pa.string()))})


def latest(conversations: DataFrame) -> DataFrame:
    """One row per conv_no: the latest export; of equal ones any, as they are the same record. A row without conv_no is no conversation."""
    newest = conversations.groupBy("conv_no").agg(F.max("exported_at").alias("exported_at"))
    return conversations.join(newest, ["conv_no", "exported_at"], "left_semi").dropDuplicates(["conv_no"])


def is_hidden(message: Column) -> Column:
    return F.coalesce(message["metadata"]["is_visually_hidden_from_conversation"], F.lit(False))


def linearized(conversations: DataFrame) -> DataFrame:
    """(conv_no, conversation_id, title, create_time, pos, role, text, ts) of every kept message of the active branch.

    Only node names travel to Python. Roles in any case; types other than text
    and multimodal_text, hidden and empty messages give no rows; a time of 0 is
    missing. A null or empty mapping gives none.
    """
    slim = latest(conversations.select("conv_no", "conversation_id", "id", "title", "create_time", "current_node", "mapping", "exported_at"))
    entries = F.map_entries("mapping")
    paths = slim.select(F.col("conv_no").alias("rec_id"), F.transform(entries, lambda e: e["key"]).alias("names"), F.transform(entries, lambda e: e["value"]["parent"]).alias("parents"), "current_node").mapInArrow(_paths, "rec_id long, path array<string>")
    on_path = slim.join(paths, slim.conv_no == paths.rec_id).select("conv_no", F.coalesce(F.nullif("conversation_id", F.lit("")), "id").alias("conversation_id"), "title", "create_time", F.posexplode(F.transform("path", lambda k: F.col("mapping")[k]["message"])).alias("pos", "message"))
    m = F.col("message")
    role = F.lower(m["author"]["role"])
    kept = on_path.where(m.isNotNull() & ~is_hidden(m) & role.isin("user", "assistant") & m["content"]["content_type"].isin(*P.TEXT_TYPES))
    # out of a generator, so that the condition on the text isn't pushed below, where the parts would be read a second time
    text = F.explode(F.array(X.message_text(m["content"]["parts"])))
    return kept.select("conv_no", "conversation_id", "title", "create_time", "pos", role.alias("role"), text.alias("text"), F.nullif(m["create_time"], F.lit(0.0)).alias("ts")).where("text <> ''")


def from_documents(documents: DataFrame) -> DataFrame:
    """Every document as the only user turn of a conversation of its own. Null texts give no turn."""
    return documents.where("text is not null").select(F.col("doc_id").alias("conv_no"), F.lit(0).alias("pos"), F.lit("user").alias("role"), "text", F.lit(None).cast("double").alias("ts"))
