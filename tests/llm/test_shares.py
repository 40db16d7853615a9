import random

from threadmill.llm.spans import LEAST, Shared

SCHEMA = "msg_id long, parts array<string>, ingested_at long"


def text(rnd, n):
    return "".join(rnd.choice("abcdefghijklmnop .") for _ in range(n))


def covered(part, others):
    """Characters of part inside a window of LEAST characters that one of the other texts holds."""
    grams = {o[i:i + LEAST] for o in others for i in range(len(o) - LEAST + 1)}
    inside = {j for i in range(len(part) - LEAST + 1) if part[i:i + LEAST] in grams for j in range(i, i + LEAST)}
    return len(inside)


def test_shares_are_of_whole_messages(spark):
    rnd = random.Random(3)
    p, q, r = text(rnd, 300), text(rnd, 400), text(rnd, 500)
    rows = [
        (1, [p, text(rnd, 200)], 1),  # a shared part and a short part of its own: 300 of 500
        (2, [p], 1), (2, [p], 2),  # delivered twice
        (3, [q + text(rnd, 50), text(rnd, 60) + q], 1),  # shared by its own two parts only
        (4, [text(rnd, 20)], 1), (5, None, 1), (6, [], 1), (7, [None, ""], 1), (8, ['{"asset": 1}'], 1),
        (9, [r, r, None, text(rnd, 30)], 1),  # one text in two parts, held elsewhere inside a longer one
        (10, [text(rnd, 100) + r + text(rnd, 100)], 1),
        (11, [text(rnd, 239)], 1),
        (12, ['{"text": "' + q[:260] + '"}', q[:250]], 1),  # q again, in another message
    ]
    by = {m: [t for t in ps or [] if t] for m, ps, _ in rows}
    by[8], by[12] = [], [q[:260], q[:250]]
    want = {}
    for m, parts in by.items():
        others = [t for o, ts in by.items() if o != m for t in ts]
        chars, shared = sum(map(len, parts)), sum(covered(t, others) for t in parts)
        want[m] = (chars, shared, shared / chars if chars else 0.0)
    got = {x["msg_id"]: (x["chars"], x["shared_chars"], x["share"]) for x in Shared(spark.createDataFrame(rows, SCHEMA)).shares().collect()}
    assert got == want
    assert got[1] == (500, 300, 0.6) and got[5] == got[6] == got[7] == (0, 0, 0.0)


def test_windows_of_one_message_alone_are_not_shared(spark):
    rnd = random.Random(4)
    q = text(rnd, 400)
    rows = [(1, [q + text(rnd, 50), text(rnd, 60) + q], 1), (2, [text(rnd, 700)], 1)]
    got = {x["msg_id"]: (x["chars"], x["shared_chars"]) for x in Shared(spark.createDataFrame(rows, SCHEMA)).shares().collect()}
    assert got == {1: (910, 0), 2: (700, 0)}
