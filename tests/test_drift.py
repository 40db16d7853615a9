import json

from pyspark.sql import functions as F

from threadmill.operators import drift as D

REF = {"id": "i", "conversation_id": "c", "parent": None, "author": {"role": "user"}, "create_time": 1650000000.5, "content": {"content_type": "text", "parts": ["a", {"text": "b"}]}, "metadata": {"x": {"y": 1}}}


def rec(**changes):
    out = json.loads(json.dumps(REF))
    for path, value in changes.items():
        *way, leaf = path.split("__")
        at = out
        for w in way:
            at = at.setdefault(w, {})
        if value == "DROP":
            at.pop(leaf, None)
        else:
            at[leaf] = value
    return out


def steps(record):
    return set(D.migration(D.fingerprint(record))[1])


def test_steps():
    assert steps(REF) == set()
    assert steps(rec(parent="DROP", parent_id="0290f7c0-1111-5222-8333-444455556666", author__role="DROP", author__speaker="assistant")) == {("parent", "renamed"), ("author.role", "renamed")}
    assert ("author.role", "renamed") in steps(rec(author__role="DROP", sender="Assistant"))
    assert steps(rec(author__role=1)) == {("author.role", "retyped")}
    assert steps(rec(author__role={"name": "user"})) == {("author.role", "retyped")}
    assert steps(rec(author__role=None, create_time=None, content__parts=None)) == set()
    assert steps(rec(author__role="DROP", author__kind=["user"])) == {("author.role", "renamed"), ("author.role", "retyped")}
    assert steps(rec(create_time="DROP", timestamp="2024-05-01T10:00:00Z")) == {("create_time", "renamed"), ("create_time", "retyped")}
    assert steps(rec(content__content_type="DROP", content__kind="text", content__language="de")) == {("content.content_type", "renamed"), ("content.language", "added")}
    assert steps(rec(content__parts={"0": "a"})) == {("content.parts", "retyped")}
    assert steps(rec(weight=0.5, end_turn=True, voice_mode=None, author__nick="b2")) == {("weight", "added"), ("end_turn", "added"), ("voice_mode", "added"), ("author.nick", "added")}
    assert steps(rec(metadata="DROP")) == set()
    # a key left behind with null while its value stands under another name
    assert steps(rec(create_time=None, timestamp=1650000001.0)) == {("create_time", "renamed")}
    assert steps(rec(author__role=None, author__speaker="user")) == {("author.role", "renamed")}
    assert steps(rec(create_time=None, timestamp=None)) == {("timestamp", "added")}
    assert ("timestamp", "added") in steps(rec(timestamp=1650000001.0))


def test_migrated_values():
    fields, extra, changes = D.migrate(rec(author__role="DROP", from_role=2, create_time="1650000000.5", content__parts="DROP", blocks={"1": "b", "0": {"text": "a"}}, status="z"))
    assert fields["author.role"] == "assistant" and fields["create_time"] == 1650000000.5 and fields["content.parts"] == ['{"text": "a"}', "b"]
    assert extra == {"status": "z"} and "renamed author.role" in changes
    assert D.migrate(rec(create_time="2024-05-01T00:00:00Z"))[0]["create_time"] == 1714521600.0
    assert D.migrate(rec(create_time="never"))[0]["create_time"] is None


def test_drift_of_shards(spark):
    rows = [(1, "s1", 0, json.dumps(REF)), (1, "s1", 0, json.dumps(REF)), (1, "s1", 1, "{broken"), (1, "s1", 2, None), (1, "s1", 3, "[1]"), (2, "s2", 0, json.dumps(rec(metadata="DROP", author__role="DROP"))), (2, "s2", 1, json.dumps(rec(metadata="DROP", author__role="DROP", sender="user"))), (3, "s3", 0, json.dumps(rec(metadata="DROP"))), (3, "s3", 1, json.dumps(REF)), (4, "s4", 0, "nope")]
    df = spark.createDataFrame(rows, "shard_no long, shard_file string, rec_no int, payload string").withColumn("exported_at", F.lit("2024-01-01").cast("timestamp"))
    got = {tuple(r) for r in D.drift(df).collect()}
    assert got == {(2, "metadata", "removed"), (2, "author.role", "renamed")}
    unified = D.unify(df).collect()
    assert len(unified) == 5 and {r["role"] for r in unified} == {"user", None}
    assert D.versions(df).groupBy("shard_no").count().count() == 3
    empty = spark.createDataFrame([], df.schema)
    assert D.drift(empty).collect() == [] and D.unify(empty).collect() == []


SHARDS = "shard_no long, shard_file string, rec_no int, payload string, exported_at timestamp"


def test_latest_delivery_is_kept(spark):
    import datetime as dt

    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [(1, "s", 0, json.dumps(rec(content__parts=["old"])), t[0]), (1, "s", 0, json.dumps(rec(content__parts=["new"])), t[2]), (1, "s", 0, json.dumps(rec(content__parts=["mid"])), t[1])]
    for part in (1, 3):
        assert [r["parts"] for r in D.unify(spark.createDataFrame(rows, SHARDS).repartition(part)).collect()] == [["new"]]


def test_defaults_are_recorded():
    fields, _, changes = D.migrate(rec(metadata="DROP", content__parts="DROP"))
    assert fields["content.parts"] == [] and fields["metadata"] == "{}" and changes == ["defaulted content.parts", "defaulted metadata"]
    assert D.migrate(rec(content__parts=None))[0]["content.parts"] is None


def test_history_is_a_chain(spark):
    shapes = [REF, rec(author__role="DROP", sender="user"), rec(author__role="DROP", sender="user", create_time="2024-05-01T00:00:00Z", weight=1.5)]
    rows = [(n, "s", i, json.dumps(shapes[n // 2]), None) for n in range(6) for i in range(2)]
    got = D.history(spark.createDataFrame(rows, SHARDS)).orderBy("version_no").collect()
    assert [(r["first_shard"], r["shards"], r["records"]) for r in got] == [(0, 2, 4), (2, 2, 4), (4, 2, 4)]
    assert got[1]["changes"] == ["- author.role", "+ sender: string"] and got[1]["steps"] == ["renamed author.role"]
    assert got[2]["changes"] == ["+ weight: number", "create_time: number -> string"] and set(got[2]["steps"]) == {"renamed author.role", "retyped create_time", "added weight"}
    assert D.history(spark.createDataFrame([], SHARDS)).collect() == []
