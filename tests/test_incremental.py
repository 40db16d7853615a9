import pytest
from pyspark.sql import functions as F

from threadmill.operators import incremental as I
from threadmill.sources.versioned import Moved

INDEX = "file string, conversation_id string, user_turns long"
LEDGER = "conversation_id string, file string, status string, user_turns long, run_id long"


def states(spark, index, ledger, runs):
    led = I.replay(spark.createDataFrame(index, INDEX), spark.createDataFrame(ledger, LEDGER), spark.createDataFrame(runs, "run_id long, outcome string"))
    return {r["rec_key"]: r["state"] for r in led.read().collect()}


CASES = [("f1", "new", 3), ("f2", "grown", 5), ("f2", "grown", 4), ("f3", "done", 5), ("f4", "failed", 2), ("f5", None, 2), ("f6", "", 1), ("f7", "odd", None), (None, None, 9), ("f8", "case", 2), ("f9", "nocount", 2), ("f10", "sizeless", None)]
ROWS = [("grown", "f2", "reviewed", 4, 1), ("done", "f3", "promoted", 5, 1), ("done", "f3", "promoted", 5, 1), ("failed", "f4", "reviewed", 2, 2), ("failed", "f4", "reviewed", 2, 3), ("failed", "f4", "reviewed", 2, 77), (None, "f5", "Reviewed", 2, 1), ("", "f6", "pending", 1, 1), ("case", "f8", " PROMOTED ", 2, 1), ("nocount", "f9", "reviewed", None, 1), ("gone", "f", "reviewed", 2, None), (None, None, "reviewed", 2, 1), ("done", "f3", None, 9, 2), ("sizeless", "f10", "reviewed", 4, 1)]
RUNS = [(1, "success"), (1, "success"), (2, "failed"), (3, None)]


def test_states(spark):
    got = states(spark, CASES, ROWS, RUNS)
    assert got == {"new": "pending", "grown": "pending", "done": "done", "failed": "pending", "f5": "done", "f6": "pending", "odd": "pending", "case": "done", "nocount": "pending", "sizeless": "done"}
    assert states(spark, [], [], []) == {}
    assert states(spark, CASES, [], [])["done"] == "pending"


def test_replay_equals_run_after_run(spark, tmp_path):
    """What the two leases of a replay leave behind is what leasing, completing and expiring one run after another leaves."""
    index, ledger = spark.createDataFrame(CASES, INDEX), spark.createDataFrame(ROWS, LEDGER)
    led = I.WorkLedger(spark, str(tmp_path / "led"))
    led.enqueue(I.current_sizes(index))
    for now, (run, good) in enumerate([(2, False), (3, False), (77, False), (1, True)]):
        rows = ledger.where(f"run_id = {run}").withColumn("rec_key", I.record_key()).where("rec_key is not null")
        leased = led.lease(now, 1, keys=rows)
        if good:
            led.complete(leased.select("rec_key", "token").join(rows.where("lower(trim(status)) in ('reviewed', 'promoted')"), "rec_key").selectExpr("rec_key", "user_turns as size", "token"))
        led.expire(now + 1)
    assert {r["rec_key"]: (r["state"], r["done_size"]) for r in led.read().collect()} == {r["rec_key"]: (r["state"], r["done_size"]) for r in I.replay(index, ledger, spark.createDataFrame(RUNS, "run_id long, outcome string")).read().collect()}


def sizes(spark, rows):
    return spark.createDataFrame(rows, "rec_key string, size long")


def done(spark, rows):
    return spark.createDataFrame(rows, "rec_key string, size long, token long")


def states_of(ledger):
    return {r["rec_key"]: (r["state"], r["token"], r["done_size"]) for r in ledger.read().collect()}


def test_lease_expire_and_fence(spark, tmp_path):
    led = I.WorkLedger(spark, str(tmp_path / "led"))
    assert led.read().collect() == []
    led.enqueue(sizes(spark, [("a", 3), ("a", 4), ("b", 1), (None, 9)]))
    first = {r["rec_key"]: r["token"] for r in led.lease(now=0, ttl=10).collect()}
    assert first == {"a": 1, "b": 1}
    assert led.lease(now=5, ttl=10).collect() == []
    assert led.complete(done(spark, [("a", 4, 1), ("a", 4, 1)])).collect() == []
    assert states_of(led) == {"a": ("done", 1, 4), "b": ("leased", 1, None)}
    # the worker of b is lost; another takes over; the first writes late
    second = {r["rec_key"]: r["token"] for r in led.lease(now=11, ttl=10).collect()}
    assert second == {"b": 2}
    late = led.complete(done(spark, [("b", 1, 1)])).collect()
    assert [(r["rec_key"], r["fence"]) for r in late] == [("b", 1)]
    assert states_of(led)["b"] == ("leased", 2, None)
    led.complete(done(spark, [("b", 1, 2)]))
    # repeated completion is rejected and changes nothing
    assert len(led.complete(done(spark, [("b", 1, 2)])).collect()) == 1
    assert states_of(led)["b"] == ("done", 2, 1)
    # only what has grown comes back
    led.enqueue(sizes(spark, [("a", 4), ("b", 7), ("c", 1)]))
    assert {r["rec_key"] for r in led.lease(now=20, ttl=1).collect()} == {"b", "c"}
    led.expire(now=30)
    assert {k for k, v in states_of(led).items() if v[0] == "pending"} == {"b", "c"}
    assert led.output_path("a", 1) == led.output_path("a", 1) != led.output_path("a", 2)


def test_grown_while_leased_goes_back_to_pending(spark, tmp_path):
    led = I.WorkLedger(spark, str(tmp_path / "led"))
    led.enqueue(sizes(spark, [("a", 1)]))
    led.lease(now=0, ttl=100)
    led.enqueue(sizes(spark, [("a", 5)]))
    led.complete(done(spark, [("a", 1, 1)]))
    assert states_of(led)["a"][0] == "pending"


def test_two_leases_at_one_time_share_nothing(spark, tmp_path):
    led = I.WorkLedger(spark, str(tmp_path / "led"))
    led.enqueue(sizes(spark, [("a", 1), ("b", 1), ("c", 1)]))
    first = led.lease(now=0, ttl=10, where=F.col("rec_key") == "a")
    second = led.lease(now=0, ttl=10, where=F.col("rec_key") != "c")
    assert [r["rec_key"] for r in first.collect()] == ["a"] and [r["rec_key"] for r in second.collect()] == ["b"]
    # what a lease returned stays what it was
    led.complete(done(spark, [("a", 1, 1)]))
    assert [r["rec_key"] for r in first.collect()] == ["a"]


class Slow(I.WorkLedger):
    """A writer that another one overtakes between its reading and its publishing."""

    overtaken_by = None

    def publish(self, df, base):
        other, self.overtaken_by = self.overtaken_by, None
        if other:
            other()
        return super().publish(df, base)


def test_of_two_interleaved_writers_one_wins(spark, tmp_path):
    root = str(tmp_path / "led")
    led, slow = I.WorkLedger(spark, root), Slow(spark, root)
    led.enqueue(sizes(spark, [("a", 1), ("b", 1)]))
    slow.overtaken_by = lambda: led.enqueue(sizes(spark, [("c", 1)]))
    with pytest.raises(Moved):
        slow.lease(now=0, ttl=10)
    assert states_of(led) == {k: ("pending", 0, None) for k in "abc"}
    assert {r["rec_key"] for r in slow.lease(now=0, ttl=10).collect()} == {"a", "b", "c"}
    slow.overtaken_by = lambda: led.complete(done(spark, [("a", 1, 1)]))
    with pytest.raises(Moved):
        slow.complete(done(spark, [("b", 1, 1)]))
    assert states_of(led)["a"][0] == "done" and states_of(led)["b"][0] == "leased"
    states_left = [p.name for p in (tmp_path / "led").iterdir() if p.name.startswith("state-")]
    assert len(states_left) == led.version() + 1


def test_many_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "led")
    base = I.WorkLedger(spark, root).enqueue(sizes(spark, [("a", 1)]))

    def write(i):
        try:
            return I.WorkLedger(spark, root).publish(spark.createDataFrame([(f"k{i}", 1, None, "pending", 0, None, None)], I.ITEM_SCHEMA), base)
        except Moved:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [x for x in pool.map(write, range(4)) if x is not None]
    assert won == [base + 1] and I.WorkLedger(spark, root).read().count() == 1


def test_a_publication_under_way_is_not_read(spark, tmp_path):
    led = I.WorkLedger(spark, str(tmp_path / "led"))
    led.enqueue(sizes(spark, [("a", 1)]))
    (tmp_path / "led" / "v1").write_text("")
    with pytest.raises(Moved, match="being published"):
        led.read()
    (tmp_path / "led" / "v1").unlink()
    for size in (2, 3, 4):
        led.enqueue(sizes(spark, [("a", size)]))
    led.vacuum(keep=1)
    assert led.read().first()["size"] == 4 and led.version() == 3
