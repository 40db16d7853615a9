"""Processing only new or changed records: a work-item ledger.

Every key is a work item with a ``size`` (here: user turns). It is pending
until some successful run has covered its current size, leased while a worker
holds it, and done afterwards. A lease that expires puts the item back to
pending; the fencing token, which rises with every lease, makes the ledger
reject what a worker whose lease was taken over writes later.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.session import scratch_path, stored
from threadmill.sources.versioned import Versions

ITEM_SCHEMA = "rec_key string, size long, done_size long, state string, token long, lease_until double, lease_id string"


def record_key(conversation_id: str | Column = "conversation_id", file: str | Column = "file") -> Column:
    """conversation_id, or the file where that is null or empty."""
    return F.coalesce(F.nullif(F.col(conversation_id) if isinstance(conversation_id, str) else conversation_id, F.lit("")), F.col(file) if isinstance(file, str) else file)


def current_sizes(index: DataFrame) -> DataFrame:
    """(rec_key, size): the largest user_turns of every key. Keys that are null are no items.

    A key whose rows all lack user_turns keeps a null size: it is pending until
    any successful run has recorded it.
    """
    return index.select(record_key().alias("rec_key"), F.col("user_turns").cast("long").alias("user_turns")).where("rec_key is not null").groupBy("rec_key").agg(F.max("user_turns").alias("size"))


class WorkLedger(Versions):
    """The state machine as a table that outlives runs. Of two writers that began from one version one wins, the other raises ``Moved``.

    ``output_path`` is a function of key and token only, so a retried worker
    overwrites its own output and never adds a second one.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, ITEM_SCHEMA)

    def enqueue(self, sizes: DataFrame) -> int:
        """Add new keys and reopen grown ones; sizes has (rec_key, size), any number of rows a key."""
        base = self.version()
        new = sizes.where("rec_key is not null").groupBy("rec_key").agg(F.max("size").alias("new_size"))
        grown = F.greatest("size", "new_size")
        reopened = (F.col("state") == "done") & (grown > F.coalesce("done_size", F.lit(-1)))
        state = F.when(F.col("state").isNull() | reopened, "pending").otherwise(F.col("state"))
        both = self.read(base).join(new, "rec_key", "full")
        return self.publish(both.select("rec_key", grown.alias("size"), "done_size", state.alias("state"), F.coalesce("token", F.lit(0)).cast("long").alias("token"), "lease_until", "lease_id"), base)

    def lease(self, now: float, ttl: float, where: Column | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Lease pending items, and those whose lease ran out by ``now``; returns exactly these, with their tokens.

        ``where`` or ``keys`` (rec_key) narrows what is asked for. The lease has an
        identifier of its own, so two calls at one time never return each other's items.
        """
        base = self.version()
        rows = self.read(base)
        free = (F.col("state") == "pending") | ((F.col("state") == "leased") & (F.col("lease_until") <= now))
        free = free if where is None else free & where
        if keys is not None:
            rows = rows.join(keys.select("rec_key").distinct().withColumn("_asked", F.lit(True)), "rec_key", "left")
            free = free & F.col("_asked").isNotNull()
        mine = uuid.uuid4().hex
        taken = rows.withColumn("_taken", F.coalesce(free, F.lit(False)))
        pick = lambda new, c: F.when(F.col("_taken"), new).otherwise(F.col(c)).alias(c)
        n = self.publish(taken.select("rec_key", "size", "done_size", pick(F.lit("leased"), "state"), pick(F.col("token") + 1, "token"), pick(F.lit(float(now + ttl)), "lease_until"), pick(F.lit(mine), "lease_id")), base)
        return self.read(n).where(F.col("lease_id") == mine)

    def expire(self, now: float) -> int:
        """Put items whose lease ran out back to pending."""
        base = self.version()
        over = (F.col("state") == "leased") & (F.col("lease_until") <= now)
        clear = lambda c, kind: F.when(over, F.lit(None).cast(kind)).otherwise(F.col(c)).alias(c)
        return self.publish(self.read(base).select("rec_key", "size", "done_size", F.when(over, "pending").otherwise(F.col("state")).alias("state"), "token", clear("lease_until", "double"), clear("lease_id", "string")), base)

    def complete(self, done: DataFrame) -> DataFrame:
        """Finish items; done has (rec_key, size, token). Returns the rows that were rejected.

        A row is accepted only while its item is leased under that very token. A
        row without a size completes nothing. A repeated row changes nothing the
        second time; it counts as rejected.
        """
        base = self.version()
        done = done.where("size is not null").select("rec_key", F.col("size").alias("got"), F.col("token").alias("fence")).distinct()
        best = done.groupBy("rec_key", "fence").agg(F.max("got").alias("got"))
        old = self.read(base)
        joined = old.join(best, (old.rec_key == best.rec_key) & (old.token == best.fence) & (old.state == "leased"), "left").drop(best.rec_key)
        took = F.col("fence").isNotNull()
        reached = F.greatest("done_size", "got")
        state = F.when(took, F.when(F.coalesce(reached >= F.col("size"), F.lit(True)), "done").otherwise("pending")).otherwise(F.col("state"))
        held = old.where("state = 'leased'").select("rec_key", F.col("token").alias("fence"))
        rejected = stored(done.join(held, ["rec_key", "fence"], "left_anti"))
        clear = lambda c, kind: F.when(took, F.lit(None).cast(kind)).otherwise(F.col(c)).alias(c)
        self.publish(joined.select("rec_key", "size", F.when(took, reached).otherwise(F.col("done_size")).alias("done_size"), state.alias("state"), "token", clear("lease_until", "double"), clear("lease_id", "string")), base)
        return rejected

    def output_path(self, key: str, token: int) -> str:
        return f"{self.root}/out/{uuid.uuid5(uuid.NAMESPACE_OID, key).hex}-{token}"


def replay(index: DataFrame, ledger: DataFrame, runs: DataFrame, root: str | None = None, done_states: tuple[str, ...] = ("reviewed", "promoted")) -> WorkLedger:
    """A WorkLedger that has lived through the recorded runs: its pending items are what is new or has grown.

    The keys of the index are enqueued. What runs without success (failed,
    aborted, unfinished, unknown) had taken is leased and left to expire, so it
    is pending again with a raised token. What successful runs had taken is
    leased and completed with the largest size they recorded; rows of another
    status or without a count complete nothing and their leases expire too. Runs
    of one kind are replayed together, as the outcome of a key depends on the
    largest completed size only; so the steps do not grow with the runs. Rows
    whose key is no item of the index touch nothing. Repeated rows change nothing.
    """
    spark = index.sparkSession
    items = WorkLedger(spark, root or scratch_path(spark, "ledgers"))
    items.enqueue(current_sizes(index))
    good = runs.where("outcome = 'success'").select(F.col("run_id").alias("good_run")).distinct()
    finished = F.coalesce(F.lower(F.trim("status")).isin(*done_states), F.lit(False))
    rows = ledger.select(record_key().alias("rec_key"), F.when(finished, F.col("user_turns").cast("long")).alias("reached"), "run_id").where("rec_key is not null")
    ended = rows.join(good, rows.run_id == good.good_run, "left").groupBy("rec_key", F.col("good_run").isNotNull().alias("good")).agg(F.max("reached").alias("reached"))
    taken = stored(ended)
    items.lease(0.0, 1.0, keys=taken.where("not good"))
    items.expire(1.0)
    leased = items.lease(1.0, 1.0, keys=taken.where("good"))
    items.complete(leased.select("rec_key", "token").join(taken.where("good"), "rec_key").select("rec_key", F.col("reached").alias("size"), "token"))
    items.expire(2.0)
    return items
