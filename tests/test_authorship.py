import re

import pytest
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import text as X
from threadmill.functions.classify import turn_label
from threadmill.operators import authorship as A

MEMO = "Here is my transcript of a voice note.\n" + "I mean I was so tired and I just kept going. " * 40
DOCUMENT = "The committee reviewed the annual budget and approved the revised schedule. " * 40
OWN = "I think I want my own garden and I know my reasons. " * 40
CASES = [
    (MEMO, "own_voice"), ("Here is my transcript, short.", "authored"), (DOCUMENT, "pasted"), (OWN, "authored"), ("Skip to main content please", "pasted"), ("0:01:02 a 0:02:03 b 0:03:04 c", "pasted"), ("0:01:02 a 0:02:03 b", "authored"),
    ("see https://example.org/a/very/long/path/that/goes/on", "pasted"), ("I read https://example.org and wrote a good deal about what it said to me yesterday", "authored"), ("B", "quiz"), (" a and c. ", "quiz"), ("true", "quiz"), ("12, 13", "quiz"),
    ("Which?\na) one\nb) two\nc) three", "quiz"), ("a) one\nb) two", "authored"), ("Map the second idea", "suggestion"), ("- Explore how that works", "suggestion"), ("Map my idea", "authored"), ("Name your goals\nKeep them", "suggestion"), ("Name your goals\nWhy keep them?", "authored"),
    ("• what you want", "suggestion"), ("", "authored"), (None, None), ("Bitte prüfe das für mich", "authored"), ("Question 4 (Mandatory)", "pasted"),
]


@pytest.mark.parametrize("cfg", [Config()])
def test_labels(spark, cfg):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string").withColumn("f", X.fold(F.col("t"))).withColumn("n", X.words(F.col("f")))
    got = {r["i"]: r["l"] for r in df.select("i", turn_label(F.col("f"), F.col("n"), cfg).alias("l")).collect()}
    assert {i: got[i] for i in got} == {i: label for i, (_, label) in enumerate(CASES)}


def test_extra_markers(spark):
    cfg = Config(extra_paste_markers=("intranet home", ""), extra_own_voice_preambles=("dictated:",))
    df = spark.createDataFrame([("see Intranet Home now",), ("plain words",), ("dictated: " + "so we went there and back again " * 60,)], "t string").withColumn("f", X.fold(F.col("t"))).withColumn("n", X.words(F.col("f")))
    assert [r["l"] for r in df.select(turn_label(F.col("f"), F.col("n"), cfg).alias("l")).collect()] == ["pasted", "authored", "own_voice"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_no long, pos int, role string, text string, ts double")


COINED = "this sounds like an ambition that was lent to you by someone else rather than chosen"
FIRST = "what I keep saying is that I would rather be trusted with hard work than own it"


def test_echo_of_the_turn_before(spark):
    rows = [(1, 0, "user", "I can't say why the plan feels heavy", 1.0), (1, 1, "assistant", COINED, 2.0), (1, 2, "user", "Yes, an ambition that was lent to you by someone else rather than chosen. I see it", 3.0)]
    got = {r["pos"]: r for r in A.credited(turns(spark, rows)).collect()}
    assert got[0]["echoed"] == 0
    assert got[2]["echoed"] == 13 and got[2]["credited"] == got[2]["n_prose"] - 13


def test_own_words_quoted_back_are_no_echo(spark):
    rows = [(1, 0, "user", FIRST, 1.0), (1, 1, "assistant", "You wrote: " + FIRST, 2.0), (1, 2, "user", FIRST + " and I mean it", 3.0)]
    assert all(r["echoed"] == 0 for r in A.credited(turns(spark, rows)).collect())


def test_echo_needs_the_turn_directly_before(spark):
    rows = [(1, 0, "assistant", COINED, 1.0), (1, 1, "user", "I will think about this for a while", 2.0), (1, 2, "user", COINED, 3.0)]
    assert all(r["echoed"] == 0 for r in A.credited(turns(spark, rows)).collect())


def test_metrics_conserve_words(spark):
    code = "why does this fail for me?\n```py\nfor x in y:\n    print(x)\n```\nI want it to stop"
    rows = [(1, 0, "user", FIRST, 86400.0), (1, 1, "assistant", COINED, 86500.0), (1, 2, "user", "Yes, " + COINED, 90000.0), (1, 3, "user", code, 180000.0), (1, 4, "user", "B", None), (2, 0, "assistant", "only me", None), (3, 0, "user", OWN, 5.0)]
    got = {r["conv_no"]: r.asDict() for r in A.metrics(turns(spark, rows)).collect()}
    for m in got.values():
        assert m["user_words"] == m["authored_words"] + m["pasted_words"] + m["echoed_words"]
    assert got[1]["echoed_words"] > 0 and got[1]["code_ratio"] > 0 and got[1]["days_touched"] == 2
    assert got[2]["user_turns"] == 0 and got[2]["terms"] == [] and got[2]["authored_words"] == 0
    assert got[3]["content_days"] == 1 and got[3]["terms"][:2] == ["garden", "reasons"]
    assert got[1]["span_hours"] == 26.0


def test_code_across_turns_counts_on_joined_text(spark):
    rows = [(1, 0, "user", "open ``` here", None), (1, 1, "assistant", "close ``` there", None)]
    m = A.metrics(turns(spark, rows)).first()
    joined = "open ``` here\nclose ``` there"
    assert m["chars"] == len(joined) and m["code_ratio"] == round(len("``` here\nclose ```") / len(joined), 3)


def test_code_ratio_equals_that_of_the_joined_text(spark):
    import random

    rnd = random.Random(2)
    rows, want = [], {}
    for c in range(40):
        texts = ["".join(rnd.choice(["```", "`", "ab", "\n", "x y", "``"]) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 7))]
        rows += [(c, 3 * i, rnd.choice(["user", "assistant"]), t, None) for i, t in enumerate(texts)]
        want[c] = sum(map(len, re.findall(r"(?s)```.*?```", "\n".join(texts))))
    got = {r["conv_no"]: r["fences"] for r in A.fence_chars(turns(spark, rows)).collect()}
    assert {c: got.get(c, 0) for c in want} == want


def test_long_conversations_are_read_in_stretches(spark):
    rows = [(1, 7 * i, "user" if i % 2 else "assistant", f"t{i}", None) for i in range(60)] + [(2, 3, "user", "only", None)]
    whole = {(r["conv_no"], r["pos"]): r["before"] for r in A.with_before(turns(spark, rows)).collect()}
    assert whole == {(r["conv_no"], r["pos"]): r["before"] for r in A.with_before(turns(spark, rows), 20).collect()}
    assert whole[(1, 7)] == "t0" and whole[(1, 14)] is None and whole[(2, 3)] is None and len(whole) == 61
    signs = [(1, i, "user", t, None) for i, t in enumerate(["x"] * 5 + ["question", "3", "(mandatory)"] + ["y"] * 5 + ["a) one", "b)", "two", "c) three"] + ["z"] * 9)]
    for joined in (256, 9, 10):
        r = A.school_signs(turns(spark, signs), joined=joined).first()
        assert (r["third"], r["school"], r["marker"], r["block"]) == (True, False, True, True)


def test_no_text_is_normalised_inside_a_lambda(spark):
    """A plan that puts the normal form into the function over token places is quadratic in the length of a turn."""
    rows = A.labelled(A.with_before(turns(spark, [(1, 0, "assistant", COINED, 1.0), (1, 1, "user", COINED, 2.0)])))
    plan = A.echoes(rows)._jdf.queryExecution().optimizedPlan().toString()
    sliced = re.findall(r"slice\(([^,]+),", plan)
    assert len(sliced) >= 2 and all(re.fullmatch(r"(toks|theirs)#\d+", x) for x in sliced)


def test_coursework(spark):
    drill = [(1, 2 * i, "user", t, None) for i, t in enumerate(["B", "another one", "solve this: the mean", "C", "for my midterm"])]
    plain = [(2, i, "user", t, None) for i, t in enumerate(["B", "another one", "solve this", "C"])]
    chrome = [(3, 0, "user", "brightspace page", None)]
    got = {r["conv_no"]: r["coursework"] for r in A.metrics(turns(spark, drill + plain + chrome)).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_empty_turns(spark):
    assert A.metrics(turns(spark, [])).collect() == []
    assert A.calibration(A.labelled(turns(spark, []))).collect() == []


def test_calibration_and_histogram(spark):
    rows = A.labelled(turns(spark, [(1, 0, "user", OWN, None), (2, 0, "user", DOCUMENT, None), (3, 0, "user", "B", None)]))
    shares = {r["label"]: r["share"] for r in A.calibration(rows).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and set(shares) == {"authored", "pasted", "quiz"}
    assert sum(r["turns"] for r in A.voice_histogram(rows).collect()) == 2
