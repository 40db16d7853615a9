"""Scans of exports: one JSON file, a folder of shards, a zip, or a table."""

from __future__ import annotations

import io
import json
import os
import re
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.session import hadoop_path

#: The nested conversation as it is exported; every field may be missing.
NODE = "struct<id: string, parent: string, children: array<string>, message: struct<id: string, author: struct<role: string>, create_time: double, content: struct<content_type: string, parts: array<string>>, metadata: struct<is_visually_hidden_from_conversation: boolean, attachments: array<struct<id: string, mime: string, size: long>>>>>"
CONVERSATION = f"struct<conversation_id: string, id: string, title: string, create_time: double, current_node: string, mapping: map<string, {NODE}>>"
SINGLE = "conversations.json"
SHARD = re.compile(r"conversations-(\d+)\.json$")


def _shard_paths(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    if SINGLE in names:
        return [f"{folder}/{SINGLE}"]
    shards = sorted((n for n in names if SHARD.search(n)), key=lambda n: int(SHARD.search(n).group(1)))
    if not shards:
        raise FileNotFoundError(f"neither {SINGLE} nor conversations-<n>.json in {folder}")
    return [f"{folder}/{n}" for n in shards]


def _last_wins(mapping: Column) -> Column:
    """The mapping with every key once: at its first place, with its last value. Whatever the session does with duplicate keys."""
    entries = F.map_entries(mapping)
    keys = F.map_keys(mapping)
    once = F.transform(F.array_distinct(keys), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(once)).otherwise(mapping)


def _shape(texts: DataFrame) -> DataFrame:
    """(source, value) of whole files to conversations; a shard that is no list is an error, of a single file the format check says so."""
    kind = F.schema_of_variant(F.try_parse_json("value"))
    is_list = F.coalesce(kind.startswith("ARRAY"), F.lit(False)) | ~F.col("source").rlike(SHARD.pattern)
    checked = texts.withColumn("value", F.when(is_list, F.col("value")).otherwise(F.raise_error(F.concat(F.col("source"), F.lit(": expected a list of conversations")))))
    listed = checked.select("source", F.posexplode(F.from_json("value", f"array<{CONVERSATION}>")).alias("at", "c"))
    return listed.select("source", "at", "c.*").withColumn("mapping", _last_wins(F.col("mapping")))


def _unzip(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        out = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = [n for n in z.namelist() if os.path.basename(n) == SINGLE]
                names = names[:1] or sorted((n for n in z.namelist() if SHARD.search(n)), key=lambda n: int(SHARD.search(n).group(1)))
                if not names:
                    raise FileNotFoundError(f"no conversations in {path}")
                out += [(f"{path}!{n}", z.read(n).decode("utf-8")) for n in names]
        yield pa.record_batch({"source": pa.array([r[0] for r in out], pa.string()), "value": pa.array([r[1] for r in out], pa.string())})


def read(spark: SparkSession, path: str) -> DataFrame:
    """Conversations of an export with conv_no in file order: by shard number, then by place in the shard.

    A folder prefers one conversations.json over shards; shards must hold lists.
    Duplicate keys of a mapping keep the last value. Object parts keep their JSON.
    """
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".zip"):
        texts = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_unzip, "source string, value string")
        rows = _shape(texts)
    elif path.endswith(".json"):
        rows = _shape(spark.read.text(path, wholetext=True).select(F.lit("").alias("source"), "value"))
    else:
        paths = _shard_paths(spark, path)
        rows = _shape(spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("source"), "value"))
    number = F.coalesce(F.regexp_extract("source", r"(\d+)\.json$", 1).try_cast("long"), F.lit(0))
    return rows.withColumn("conv_no", number * F.lit(1 << 32) + F.col("at")).withColumn("exported_at", F.current_timestamp()).drop("source", "at")


LEDGER_ENTRY = "struct<file: string, title: string, status: string, date: string, user_turns: long>"
PENDING_ENTRY = "struct<conversation_id: string, file: string, title: string, user_turns: long, notes: array<string>>"


def read_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ledger, pending) of a personal JSON ledger; empty tables where the file is missing.

    ledger: rec_key, status, marked_on, seen_turns; pending: rec_key, file, user_turns, notes.
    """
    fs, place = hadoop_path(spark, path)
    if not fs.exists(place):
        return spark.createDataFrame([], LEDGER_SCHEMA), spark.createDataFrame([], PENDING_SCHEMA)
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<conversations: map<string, {LEDGER_ENTRY}>, pending: map<string, {PENDING_ENTRY}>>").alias("x"))
    ledger = whole.select(F.explode("x.conversations").alias("rec_key", "e")).select("rec_key", "e.status", F.col("e.date").alias("marked_on"), F.col("e.user_turns").alias("seen_turns"))
    pending = whole.select(F.explode("x.pending").alias("rec_key", "e")).select("rec_key", "e.file", "e.user_turns", F.coalesce("e.notes", F.array().cast("array<string>")).alias("notes"))
    return ledger, pending


LEDGER_SCHEMA = "rec_key string, status string, marked_on string, seen_turns long"
PENDING_SCHEMA = "rec_key string, file string, user_turns long, notes array<string>"


def ledger_json(ledger: DataFrame, pending: DataFrame) -> str:
    """A personal ledger as JSON, keys sorted. It holds what one person has reviewed; larger ones belong into sinks.write_ledger."""
    data = {"version": 1, "conversations": {r["rec_key"]: {"status": r["status"], "date": r["marked_on"], "user_turns": r["seen_turns"]} for r in ledger.collect()}}
    waiting = {r["rec_key"]: {"file": r["file"], "user_turns": r["user_turns"], "notes": list(r["notes"])} for r in pending.collect()}
    return json.dumps(data | ({"pending": waiting} if waiting else {}), indent=1, sort_keys=True)
