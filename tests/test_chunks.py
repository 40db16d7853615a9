import random

from threadmill.operators import chunks


def greedy(sizes, budget):
    out, held, chunk = [], 0, 1
    for i, n in enumerate(sizes):
        if i and held + n > budget:
            chunk, held = chunk + 1, 0
        out.append(chunk)
        held += n
    return out


def test_pack_is_the_sequential_fold(spark):
    rnd = random.Random(3)
    for budget, top in ((50, 30), (10, 60), (1000, 30)):
        sizes = [rnd.choice([0, rnd.randint(0, top)]) for _ in range(400)]
        rows = [(f"{i:05d}", "f", n) for i, n in enumerate(sizes)]
        got = chunks.pack(spark.createDataFrame(rows, "conv_date string, file string, tokens long").repartition(7), budget).orderBy("conv_date").collect()
        assert [r["chunk"] for r in got] == greedy(sizes, budget)


def test_published_packing(spark):
    df = spark.createDataFrame([("1", "a", 300), ("2", "b", 300), ("3", "c", 247), ("4", "d", 400), ("5", "e", 300), ("6", "f", 200), ("7", "g", 503)], "conv_date string, file string, tokens long")
    assert [r["chunk"] for r in chunks.pack(df, 1000).orderBy("conv_date").collect()] == [1, 1, 1, 2, 2, 2, 3]


def test_empty_and_oversized(spark):
    empty = spark.createDataFrame([], "conv_date string, file string, tokens long")
    assert chunks.pack(empty, 10).collect() == []
    one = spark.createDataFrame([("1", "a", 99, 400)], "conv_date string, file string, tokens long, chars long")
    assert chunks.manifest(chunks.pack(one, 10), 10).first()["oversized"]


def test_many_ranges_are_composed_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(chunks, "GROUP", 2)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rnd = random.Random(5)
        for budget, size in ((90, lambda: rnd.randint(0, 40)), (60, lambda: 7), (5, lambda: rnd.choice([0, 9]))):
            sizes = [size() for _ in range(300)]
            rows = [(f"{i:05d}", "f", n) for i, n in enumerate(sizes)]
            got = chunks.pack(spark.createDataFrame(rows, "conv_date string, file string, tokens long"), budget).orderBy("conv_date").collect()
            assert [r["chunk"] for r in got] == greedy(sizes, budget)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_steps_that_change_nothing_are_dropped():
    assert chunks._thinned([(1, 2, 3), (4, 2, 3), (5, 3, 3)]) == [(1, 2, 3), (5, 3, 3)]
    a, b = ([(5, 1, 2)], 4), ([(0, 1, 7), (6, 2, 1)], 9)
    for open_ in (0, 3, 5, 6, 7, 20):
        began, held = chunks._after(*a, open_)
        more, held = chunks._after(*b, held)
        assert chunks._after(*chunks._composed(a, b), open_) == (began + more, held)
