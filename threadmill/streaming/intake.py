"""New conversations as a stream: each micro-batch becomes metrics and work items, exactly once.

Exports are batches, so this extends them: a folder that new files land in is
read as a stream, and a batch that is repeated after a failure overwrites its
own output and changes nothing in the ledger, as both go by batch number and key.
The ledger's key is that of batch runs: conversation_id, or the file name without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadmill.config import Config
from threadmill.operators import authorship, catalog, turns
from threadmill.operators.incremental import WorkLedger, record_key
from threadmill.session import scratch
from threadmill.sources.versioned import Moved

#: How often a batch tries again when another writer published to the ledger first.
RETRIES = 20


def run(spark: SparkSession, folder: str, out: str, ledger_root: str, cfg: Config | None = None, read: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start (and, with availableNow, finish) the intake of parquet conversations in ``folder``."""
    schema = spark.read.parquet(folder).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(folder)
    ledger = WorkLedger(spark, ledger_root)

    def batch(df: DataFrame, number: int) -> None:
        with scratch(spark):
            conversations = read(df) if read else df
            rows = catalog.named(authorship.metrics(turns.linearized(conversations), cfg).join(catalog.heads(conversations), "conv_no"))
            rows.write.mode("overwrite").parquet(f"{out}/batch={number}")
        written = df.sparkSession.read.parquet(f"{out}/batch={number}")
        for _ in range(RETRIES):
            try:
                ledger.enqueue(written.select(record_key().alias("rec_key"), F.col("user_turns").alias("size")))
                return
            except Moved:
                continue
        raise Moved(f"other writers were faster {RETRIES} times")

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()


def daily_activity(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Turns by day and role of a stream of messages (ingested_at, role), late ones within the watermark counted."""
    return events.withWatermark("ingested_at", late).groupBy(F.window("ingested_at", "1 day"), F.lower("role").alias("role")).agg(F.count("*").alias("turns"))
