import pytest
from pyspark.sql import functions as F

from threadmill import config
from threadmill.config import Config
from threadmill.operators import shortlist as L

COLUMNS = "file string, title string, authored_words long, own_voice_words long, max_user_turn_words long, authored_turns long, avg_authored_turn_words double, content_days long, days_touched long, code_ratio double, assistant_words long, coursework boolean"
# Figures of a published run: index fields and the score they give.
GOLDEN = [
    ("a", "t", 175, 0, 74, 3, 58.3, 0, 3, 0.0, 17, False, 11.47), ("b", "t", 378, 368, 368, 2, 189.0, 1, 1, 0.0, 6, False, 20.19), ("c", "t", 0, 0, 0, 0, 0.0, 0, 1, 0.0, 240, False, 0.0), ("d", "t", 18, 0, 16, 2, 9.0, 0, 1, 0.0, 10, True, 1.21),
    ("e", "t", 98, 0, 14, 7, 14.0, 0, 7, 0.0, 35, False, 7.95), ("f", "t", 60, 0, 39, 2, 30.0, 0, 1, 0.0, 28, False, 10.81), ("g", "t", 26, 0, 26, 1, 26.0, 0, 1, 0.806, 8, False, 7.7), ("h", "t", 63, 0, 63, 1, 63.0, 0, 1, 0.0, 11, False, 11.64), ("i", "t", 61, 0, 39, 2, 30.5, 0, 1, 0.0, 25, False, 10.84),
]


def test_score_matches_published_figures(spark):
    df = spark.createDataFrame([g[:-1] for g in GOLDEN], COLUMNS)
    got = {r["file"]: r["s"] for r in df.select("file", L.score().alias("s")).collect()}
    assert got == {g[0]: g[-1] for g in GOLDEN}


def test_score_without_content_days_and_with_nulls(spark):
    df = spark.createDataFrame([("a", "t", 400, 0, 50, 5, 80.0, None, 4, 0.0, 10, None), ("b", "t", None, None, None, None, None, None, None, None, None, None), ("c", "t", 10, 0, 5, 2, 5.0, 1, 1, 0.0, 900, False)], COLUMNS)
    got = {r["file"]: r["s"] for r in df.select("file", L.score().alias("s")).collect()}
    assert got["b"] == 0.0 and got["a"] > 10 and got["c"] < 3


def test_topics_need_distinct_hits_and_replace(spark):
    cfg = Config(topics={"garden": {"pattern": r"\b(hedge|lawn\w*)\b"}, "craft": {"all_of": [r"\b(lathe|kiln)\b", r"\b(draft|diary)\b"], "replaces": ["garden"]}, "plain": r"\b(one|two)\b"})
    rows = [("a", "hedge hedge", ["lawn"]), ("b", "hedge hedge", []), ("c", "Lathe and kiln", ["draft", "diary", "hedge", "lawns"]), ("d", None, None), ("e", "one two", ["three"])]
    df = spark.createDataFrame(rows, "file string, title string, terms array<string>")
    assert {r["file"]: r["t"] for r in df.select("file", L.topics(cfg).alias("t")).collect()} == {"a": ["garden"], "b": [], "c": ["craft"], "d": [], "e": ["plain"]}


def test_delta_candidates(spark):
    cfg = Config(volatile=("tech", "self"), position_changes=({"date": "2025-01-01", "topic": "tech", "what": ""},))
    rows = [("old", ["tech"], "2024-12-31", 0), ("new", ["tech"], "2025-01-01", 900), ("undated", ["tech"], "0000-00-00", 0), ("stale", ["self"], "2024-01-01", 121), ("fresh", ["self"], "2024-01-01", 120), ("none", [], "2020-01-01", 999)]
    df = spark.createDataFrame(rows, "file string, topics array<string>, conv_date string, age_days int").withColumn("d", L.delta_candidate(cfg, F.col("conv_date")))
    assert {r["file"] for r in df.where("d").collect()} == {"old", "undated", "stale"}


def test_branches(spark):
    rows = [("1", "Founder plan", 100), ("2", "Branch · founder plan ", 40), ("3", "Walk", 10), ("4", "branch - Walk", 10), ("5", "Branch of nothing", 5), ("6", None, 5), ("7", "Branch", 1)]
    df = spark.createDataFrame(rows, "file string, title string, user_words long")
    got = {r["file"]: (r["branch_dup"], r["branch_of"]) for r in L.mark_branches(df).collect()}
    assert got["2"] == (True, "1") and got["1"][0] is False
    assert got["3"] == (True, "4") and got["4"][0] is False
    assert not got["5"][0] and not got["6"][0]


def test_age_and_review_state(spark):
    df = spark.createDataFrame([("2026-01-01",), ("0000-00-00",), (None,), ("junk",)], "d string")
    assert [r["a"] for r in df.select(L.age_days(F.col("d"), "2026-01-31").alias("a")).collect()] == [30, 0, 0, 0]
    index = spark.createDataFrame([("f1", "k1", 5), ("f2", "", 5), ("f3", None, 9)], "file string, conversation_id string, user_turns long")
    ledger = spark.createDataFrame([("k1", 5), ("f2", 4)], "rec_key string, seen_turns long")
    assert {r["file"]: r["review_state"] for r in L.review_state(index, ledger).collect()} == {"f1": "reviewed", "f2": "continued", "f3": None}


def test_config(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text('owner = "Ann"\n[parse]\nmin_user_words = 9\nowner = "x"\n[rank]\ntop = 3\n[rank.weights]\nown_voice = 2.0\n[topics.only]\npattern = "x"\n[paths]\nnotes = "n"\n')
    with pytest.warns(UserWarning, match="parse.owner"):
        cfg = config.load(str(f))
    assert cfg.owner == "Ann" and cfg.min_user_words == 9 and cfg.top == 3 and cfg.weights["own_voice"] == 2.0 and cfg.weights["turn_depth"] == 0.6
    assert list(cfg.topics) == ["only"] and cfg.paths["notes"] == str(tmp_path / "n")
