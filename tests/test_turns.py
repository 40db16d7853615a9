from threadmill.operators import nested, turns
from threadmill.operators.turns import active_path
from threadmill.sources import exports


def test_active_path():
    assert active_path(["r", "a", "b"], [None, "r", "a"], "b") == ["r", "a", "b"]
    assert active_path(["r", "a", "b"], [None, "r", "r"], None) == ["r", "b"]
    assert active_path(["a", "b"], ["b", "a"], "a") == ["b", "a"]
    assert active_path(["a"], ["nowhere"], "a") == ["a"]
    assert active_path([], [], "x") == []
    deep = [str(i) for i in range(5000)]
    assert active_path(deep, [None, *deep[:-1]], "4999") == deep


def conversation(spark, rows):
    return spark.createDataFrame(rows, f"conv_no long, conversation_id string, id string, title string, create_time double, current_node string, mapping map<string, {exports.NODE}>, exported_at timestamp")


def node(role, text, parent, kind="text", hidden=None, ts=1.0, children=None, parts=None):
    return {"id": None, "parent": parent, "children": children, "message": {"id": "m", "author": {"role": role}, "create_time": ts, "content": {"content_type": kind, "parts": parts or [text]}, "metadata": {"is_visually_hidden_from_conversation": hidden, "attachments": None}}}


def test_linearized(spark):
    import datetime as dt

    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    mapping = {"r": {"id": "r", "parent": None, "children": ["a"], "message": None}, "a": node("USER", " hi ", "r"), "b": node("assistant", "yo", "a"), "x": node("assistant", "left", "a"), "h": node("user", "secret", "b", hidden=True), "s": node("system", "sys", "h"), "t": node("assistant", "think", "s", kind="thoughts"), "c": node("user", "", "t", parts=['{"text": "obj"}', None, ""], ts=0.0)}
    rows = [(1, None, "i1", "T", 1.0, "c", mapping, t1), (1, None, "i1", "T", 1.0, "b", mapping, t0), (2, "c2", None, None, None, None, None, t0), (3, "c3", None, None, None, "gone", {}, t0)]
    got = [(r["conv_no"], r["conversation_id"], r["role"], r["text"], r["ts"]) for r in turns.linearized(conversation(spark, rows)).orderBy("pos").collect()]
    assert got == [(1, "i1", "user", "hi", 1.0), (1, "i1", "assistant", "yo", 1.0), (1, "i1", "user", "obj", None)]


def test_interval_labels_of_damaged_links():
    rows = {r[0]: r for r in nested.interval_labels(["a", "b", "c", "d", "e"], [None, "a", "a", "gone", "e"], [["b", "c", "c"], ["c"], None, None, ["e"]])}
    assert rows["a"][1] < rows["b"][1] < rows["b"][2] < rows["a"][2]
    assert rows["c"][4] == rows["b"][1] and rows["c"][5] == [rows["a"][1]]
    assert rows["d"][4] is None and rows["e"][5] == []
    loop = {r[0]: r for r in nested.interval_labels(["x", "y"], ["y", "x"], [None, None])}
    assert loop["y"][4] == loop["x"][1] and loop["x"][5] == [loop["y"][1]]
    deep = [str(i) for i in range(3000)]
    assert len(nested.interval_labels(deep, [None, *deep[:-1]], [None] * 3000)) == 3000


def test_links_and_tables(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    mapping = {"r": node("user", "q", None, children=["a", "zz"]), "a": node("assistant", "w", None), "b": node("user", "v", "a", children=["r"])}
    rows = [(1, "c", None, "T", 1.0, "b", mapping, t0), (1, "c", None, "T", 1.0, "b", mapping, dt.datetime(2024, 1, 2)), (2, None, None, None, None, None, None, t0), (None, None, None, None, None, None, {"only": None}, t0)]
    df = conversation(spark, rows).withColumnRenamed("title", "title")
    table = nested.nodes(df)
    assert table.where("conv_no = 1").count() == 3 and table.where("conv_no is null").count() == 1
    got = {(r["parent_id"], r["child_id"]) for r in nested.links(table).collect()}
    assert got == {("r", "a"), ("a", "b"), ("b", "r")}
    said = nested.messages(df)
    assert said.count() == 3 and nested.parts(said).count() == 3 and nested.attachments(said).count() == 0
    assert nested.records(df).count() == 4
    assert nested.links(nested.nodes(conversation(spark, []))).collect() == []


def test_everything_lies_inside_what_holds_it(spark):
    import datetime as dt

    from threadmill.sources.exports import NODE

    schema = f"conv_no long, mapping map<string, {NODE}>, exported_at timestamp"
    att = lambda *ids: [(i, "image/png", 1) for i in ids]
    node = lambda n, parent, parts, atts: (n, parent, [], None if parts is None else (f"m{n}", ("user",), None, ("text", parts), (None, atts)))
    one = {"a": node("a", None, None, None), "b": node("b", "a", ["x", None, "y"], att("p", "q")), "c": node("c", "b", [], None), "d": node("d", "b", None, None), "e": node("e", "d", ["z"], att("r"))}
    two = one | {"e": node("e", "d", ["changed"], att("r"))}
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(1, one, day[1]), (1, one, day[0]), (1, two, day[2]), (2, None, day[0]), (3, {}, day[0])], schema)
    labels = nested.nodes(df)
    said = nested.messages(df, labels)
    parts, atts = nested.parts(said), nested.attachments(said)
    rows = [(t, r["rec"], r["pre"], r["post"], name(r)) for t, d, name in (("node", labels, lambda r: r["node_id"]), ("message", said, lambda r: r["message_id"]), ("part", parts, lambda r: r["part"]), ("attachment", atts, lambda r: r["attachment_id"])) for r in d.collect()]
    assert len({r[1] for r in rows}) == 2 and {r["version"] for r in said.collect()} == {day[0], day[2]}
    for rec in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == rec]
        numbers = [n for r in mine for n in r[2:4]]
        assert sorted(numbers) == list(range(len(numbers)))

        def holder(x):
            return max((r for r in mine if r[2] < x[2] and x[3] < r[3]), key=lambda r: r[2], default=(None,) * 5)[4]

        found = {(r[0], r[4]): holder(r) for r in mine}
        assert found[("message", "mb")] == "b" and found[("part", "x")] == found[("part", None)] == found[("attachment", "q")] == "mb" and found[("attachment", "r")] == "me"
        assert found[("node", "b")] == "a" and found[("node", "e")] == "d" and found[("node", "a")] is None
    held = nested.within(atts, nested.within(said, labels, ["node_id"]), ["node_id"]).select("version", "node_id", "attachment_id").collect()
    assert {(r["version"], r["node_id"], r["attachment_id"]) for r in held} == {(d, n, a) for d in (day[0], day[2]) for n, a in (("b", "p"), ("b", "q"), ("e", "r"))}
