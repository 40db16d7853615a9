import datetime as dt
import random

import pytest

from threadmill.llm import ranking, rebuild

INDEX = "file string, conversation_id string, user_turns long, authored_words long, own_voice_words long, max_user_turn_words long, code_ratio double, exported_at timestamp"
T0 = dt.datetime(2024, 1, 1)


def brute(rows):
    best = {}
    for f, c, turns, a, o, m, r, t in rows:
        key = c or f
        if key is None:
            continue
        values = tuple(float("-inf") if v is None else v for v in (a, o, m)) + (float("-inf") if r is None or r != r else -r,)
        order = (-1 if turns is None else turns, t, tuple(-1 if v is None else v for v in (a, o, m)))
        if key not in best or order > best[key][0]:
            best[key] = (order, values)
    out = {}
    for k, (_, v) in best.items():
        rs = sorted(1 + sum(w[1][i] > v[i] for w in best.values()) for i in range(4))
        out[k] = ((rs[1] + rs[2]) / 2, sum(rs) / 4)
    return out


def test_ranking_equals_brute_force(spark):
    rnd = random.Random(9)
    pick = lambda *x: rnd.choice([None, 0, 0, 0, *x])
    rows = [(f"f{i}", rnd.choice([None, "", f"c{i % 90}"]), rnd.choice([None, 1, 2, 3]), pick(5, 100, 10**9), pick(7), pick(3, 4), rnd.choice([None, 0.0, 0.5, 0.941, float("nan")]), T0 + dt.timedelta(seconds=i)) for i in range(300)]
    rows += [(None, None, 1, 1, 1, 1, 0.1, T0)]
    df = spark.createDataFrame(rows, INDEX).withColumnRenamed("x", "x")
    got = {r["rec_key"]: (r["median_rank"], r["mean_rank"]) for r in ranking.aggregate(df).collect()}
    assert got == brute(rows)
    top = [r["rec_key"] for r in ranking.top(df, 10).collect()]
    assert top == sorted(got, key=lambda k: (*got[k], k))[:10]
    assert ranking.top(df.limit(0)).collect() == []


def test_better_somewhere_and_worse_nowhere_stands_higher(spark):
    rows = [("a", "", 1, 10, 10, 10, 0.1, T0), ("b", "", 1, 10, 10, 10, 0.0, T0), ("c", "", 1, 10, 10, 11, 0.0, T0), ("d", "", 1, 10**12, 0, 0, 0.9, T0)]
    assert [r["rec_key"] for r in ranking.top(spark.createDataFrame(rows, INDEX)).collect()][:3] == ["c", "b", "a"]


MESSAGES = "msg_id long, conversation_id string, node_id string, parent string, node_pos int, role string, create_time double, content_type string, parts array<string>, hidden boolean, ingested_at timestamp"
HEADS = "conv_no long, conversation_id string, title string, create_time double, current_node string, exported_at timestamp"


def msg(i, conv, node, parent, pos, role="user", text="t", kind="text", hidden=None, at=0):
    return (i, conv, node, parent, pos, role, None, kind, None if text is None else [text], hidden, T0 + dt.timedelta(seconds=at))


def expected(rows, heads):
    conv = {}
    for r in sorted(rows, key=lambda r: r[10]):
        if r[2] is not None:
            conv.setdefault(r[1], {})[r[2]] = r
    out, turns = {}, {}
    for c, cur in heads.items():
        nodes = conv.get(c)
        if not nodes:
            out[c] = "empty"
            continue
        if cur not in nodes:
            named = {r[3] for r in nodes.values()}
            leaves = [r for r in nodes.values() if r[2] not in named]
            cur = max(leaves, key=lambda r: r[4])[2] if leaves else None
        path, broken = [], cur is None
        while cur is not None:
            if cur not in nodes or cur in {p[2] for p in path}:
                broken = True
                break
            path.append(nodes[cur])
            cur = nodes[cur][3]
        said = [(r[2], r[5].lower()) for r in path if r[5] and r[5].lower() in ("user", "assistant") and not r[9] and r[7] in rebuild.TURN_TYPES and r[8] and r[8][0] and r[8][0].strip()]
        out[c] = "broken" if broken else "empty" if not said else "no_reply" if said[0][1] == "user" else None
        if out[c] is None:
            turns[c] = said[::-1]
    return out, turns


def random_archive(seed):
    rnd = random.Random(seed)
    rows, heads, i = [], {}, 0
    for c in range(60):
        conv, n = f"c{c}", rnd.choice([0, 1, 3, 8, 60 if c % 20 == 0 else 5])
        for k in range(n):
            parent = None if k == 0 else f"n{rnd.choice([k - 1, k - 1, k - 1, rnd.randrange(k)])}"
            if rnd.random() < 0.04:
                parent = rnd.choice([f"n{k}", "gone", f"n{n - 1}"])
            rows.append(msg(i, conv, f"n{k}", parent, k, rnd.choice(["user", "Assistant", "assistant", "tool", None]), rnd.choice(["hi", "hi", " ", None, '{"text": ""}', "x"]) if rnd.random() < 0.5 else "yes", rnd.choice(["text", "text", "multimodal_text", "code"]), rnd.choice([None, False, False, True])))
            if rnd.random() < 0.1:
                rows.append(rows[-1][:10] + (T0 + dt.timedelta(seconds=9),))
            i += 1
        heads[conv] = rnd.choice([None, f"n{n - 1}", f"n{n - 1}", "missing"])
    rows = [r if r[8] != ['{"text": ""}'] else (*r[:8], [""], *r[9:]) for r in rows]
    rnd.shuffle(rows)
    return rows, heads


@pytest.mark.parametrize("block", [3, 2048])
def test_rebuild_equals_walking(spark, block):
    rows, heads = random_archive(11)
    df = spark.createDataFrame(rows, MESSAGES)
    hd = spark.createDataFrame([(n, c, None, None, cur, T0) for n, (c, cur) in enumerate(heads.items())] + [(99, None, None, None, None, T0), (0, "c0", None, None, heads["c0"], T0)], HEADS)
    r = rebuild.Rebuilt(df, hd, block)
    want, turns = expected(rows, heads)
    assert {x["conversation_id"]: x["reason"] for x in r.verdicts().collect()} == want
    got = {}
    for x in r.turns().orderBy("conversation_id", "turn_no").collect():
        got.setdefault(x["conversation_id"], []).append((x["turn_no"], x["node_id"], x["role"]))
    assert {c: [(n, role) for _, n, role in v] for c, v in got.items()} == turns
    assert all([k for k, *_ in v] == list(range(len(v))) for v in got.values())
    empty = rebuild.Rebuilt(df.limit(0), hd, block)
    assert {x["reason"] for x in empty.verdicts().collect()} == {"empty"} and empty.turns().collect() == []
    assert rebuild.dropped(df, hd.limit(0), block).collect() == []


def test_components_by_stars(spark):
    rnd = random.Random(3)
    edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(0, 300) if i % 37] + [("h", f"s{i}") for i in range(100)] + [("a", "a"), ("b", None), ("0001", "0002")]
    rnd.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if v is not None and u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in rebuild.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {x: find(x) for x in parent}
    assert rebuild.components(spark.createDataFrame([], "u string, v string")).collect() == []


def test_rows_without_identifier_get_their_component(spark):
    rows = [msg(1, None, "a", None, 0), msg(2, "", "b", "a", 1), msg(3, "known", "k", None, 0), msg(4, None, "m", "k", 1), msg(5, None, "z", None, 0)]
    got = {r["node_id"]: r["conversation_id"] for r in rebuild.identify(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {"a": "a", "b": "a", "k": "known", "m": "known", "z": "z"}


def test_long_ways_need_many_rounds_and_get_them(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(700)], "u long, v long")
    assert {r["component"] for r in rebuild.components(path).collect()} == {0}


def test_identified_by_replies_and_quotations(spark):
    long = "a passage that is quoted word for word by another message, and long enough to count as a quotation. " * 3
    rows = [msg(1, "x", "a", None, 0, text=long), msg(2, "x", "b", "a", 1), msg(3, "y", "c", None, 0), msg(4, "y", "d", "c", 1, text=long), msg(5, "y", "e", "gone", 2), msg(6, "z", "f", None, 0, text="short"), msg(7, "z", "g", None, 1, text="short"), msg(8, "z", None, "a", 2)]
    got = {r["node_id"]: r["conversation"] for r in rebuild.identified(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "f", "g": "g"}
    assert rebuild.identified(spark.createDataFrame([], MESSAGES)).collect() == []


def test_quote_links_join_rows_without_identifier(spark):
    rows = [(*msg(1, "known", "k", None, 0), None), (*msg(2, None, "m", None, 1), "k"), (*msg(3, None, "n", "m", 2), None), (*msg(4, None, "o", None, 3), None)]
    df = spark.createDataFrame(rows, MESSAGES + ", quoted string")
    got = {r["node_id"]: r["conversation_id"] for r in rebuild.identify(df, quotes="quoted").collect()}
    assert got == {"k": "known", "m": "known", "n": "known", "o": "o"}
