from pathlib import Path

import pytest

from threadmill.llm import encode, mixing

pytestmark = pytest.mark.skipif(not Path(encode.VOCABULARY).exists(), reason="no vocabulary files")


def test_plan_and_shares_are_of_one_mix(spark):
    docs = [(i, "the same garden text again and again", "en", "copies") for i in range(200)]
    docs += [(1000 + i, f"a text of its own number {i}", "en", "own") for i in range(200)]
    docs += [(2000, "a text both hold", "en", "own"), (2001, "a text both hold", "en", "copies")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    targets = spark.createDataFrame([("copies", 0.5, 2), ("own", 0.5, 2), ("none", 0.0, 1)], "source string, target_weight double, max_repeats int")
    report = {r["source"]: r for r in mixing.plan(df, targets)[1].collect()}
    mixed = mixing.mix(df, targets)
    shares = {r["source"]: r for r in mixing.shares(mixed, targets).collect()}
    assert set(shares) == set(report) == {"copies", "own", "none"}
    assert (shares["none"]["documents"], shares["none"]["tokens"], shares["none"]["actual_share"]) == (0, 0, 0.0)
    # the 200 copies are one text, drawn twice at most
    assert report["copies"]["planned_tokens"] == report["copies"]["capacity"] == shares["copies"]["tokens"]
    assert report["copies"]["capacity"] * 50 < report["copies"]["listed_capacity"] and not report["copies"]["short"]
    # a text of both sources is drawn for one of them only
    assert len([r for r in mixed.collect() if r["doc_id"] in (2000, 2001)]) <= 1
    assert all(r["actual_share"] == 0 for r in mixing.shares(mixing.mix(df.limit(0), targets), targets).collect())
