import random
import re
import unicodedata

from pyspark.sql import functions as F

from threadmill.functions import patterns as P
from threadmill.functions import text as X

ODD = ["", " ", "it's", "-a- b_c 'x'", "naïve café Ünïcödé", "e\u0301te\u0301 cafe\u0301", "日本語 テキスト 12", "ﬁne ½ cup ™ ①②", "Ｆｕｌｌ ｗｉｄｔｈ", "a\u00a0b\u2003c\x1cd\x0be", "x\u200by", "١٢ ٣", "K ſ", "don't—stop", "I’m \u2018quoted\u2019", "\x00\x07", "𝓵𝓲𝓽", "—", "a" * 5000]


def randoms(n=300):
    rnd = random.Random(7)
    return ["".join(rnd.choice("ab I'm-_.é ñ日½ﬁ\u0301\u00a0\n1٣•?") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def python_norm(s):
    return re.sub(r"\s+", " ", re.sub("[^a-z0-9 ]+", " ", unicodedata.normalize("NFKC", s).lower())).strip()


def test_word_counts_and_norm_agree_with_python(spark):
    texts = ODD + randoms()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", X.words(X.fold(F.col("t"))).alias("n"), X.norm(F.col("t")).alias("norm"), F.length(X.fold(F.col("t"))).alias("len"), X.count(X.fold(F.col("t")), P.FIRST_PERSON).alias("fp")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["n"] == len(re.findall(r"\b[\w'-]+\b", t)), repr(t)
        assert r["fp"] == len(re.findall(P.FIRST_PERSON, t, re.I)), repr(t)
        assert r["len"] == len(t)
        assert r["norm"] == python_norm(t), repr(t)


def test_null_text_gives_null(spark):
    r = spark.sql("select cast(null as string) t").select(X.words(X.fold(F.col("t"))).alias("n"), X.norm(F.col("t")).alias("m")).first()
    assert r["n"] is None and r["m"] is None


def test_covered_counts_each_place_once(spark):
    cases = [([], 0), ([0], 8), ([0, 1], 9), ([0, 8], 16), ([0, 3, 20], 19)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "h array<int>").select(X.covered(F.col("h"), 8).alias("n"))
    assert [r["n"] for r in df.collect()] == [n for _, n in cases]


def test_slug_and_day(spark):
    df = spark.createDataFrame([("Why the Café: a_b?", 0.0), (None, 86400.0), ("!!!", None), ("x" * 59 + " y", 1.0)], "t string, s double")
    rows = df.select(X.slug(F.col("t")).alias("s"), X.day(F.col("s")).alias("d")).collect()
    assert [r["s"] for r in rows] == ["why-the-café-a-b", "untitled", "untitled", "x" * 59]
    assert [r["d"] for r in rows] == [None, "1970-01-02", None, "1970-01-01"]


def test_part_text(spark):
    parts = ["plain", '{"text": "inner"}', '{"asset": "x"}', '{"text": 5}', "{broken", None, "", "[1]", ' {"text": "led"}']
    df = spark.createDataFrame([(p,) for p in parts], "p string").select(X.part_text_column(F.col("p")).alias("t"))
    got = [r["t"] for r in df.collect()]
    want = [X.part_text(p) for p in parts]
    assert [g for g, p in zip(got, parts) if p != '{"text": 5}'] == [w for w, p in zip(want, parts) if p != '{"text": 5}']


def test_rounding_to_even(spark):
    df = spark.createDataFrame([(9, 4), (1, 8), (5, 0), (27, 4)], "a int, b int").select(X.rounded(F.col("a"), F.col("b"), 1).alias("r"))
    assert [r["r"] for r in df.collect()] == [2.2, 0.1, 0.0, 6.8]


def test_links(spark):
    df = spark.createDataFrame([("2024-01-01-a", "One | two")], "s string, t string")
    got = df.select(X.link(F.col("s"), F.col("t")).alias("w"), X.link(F.col("s"), F.col("t"), "c/", "markdown").alias("m")).first()
    assert got["w"] == "[[2024-01-01-a\\|One \\| two]]" and got["m"] == "[One \\| two](c/2024-01-01-a.md)"
