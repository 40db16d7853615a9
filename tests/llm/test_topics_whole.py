import math
import random

import numpy as np
from pyspark.sql import functions as F

from threadmill.llm import topics

COLUMNS = "doc_id long, text string, lang string"


def test_model_counts_and_fits_all_texts(spark):
    ids = [r["id"] for r in spark.range(2400).orderBy(F.xxhash64("id"), "id").collect()]
    # the words of the last 300 by hash stand in no other text
    rnd = random.Random(3)
    words = {i: ["loan", "budget", "salary"] if n < 700 else ["garden", "hedge", "compost"] if n < 1400 else ["flour", "yeast", "oven"] if n < 2100 else ["harbour", "anchor", "mast"] for n, i in enumerate(ids)}
    rows = [(i, " ".join(rnd.choice(words[i]) for _ in range(12)), "en") for i in ids]
    model = topics.fit_topics(spark.createDataFrame(rows, COLUMNS), F.col("lang"), k=4)
    found = {tuple(w): {model.topic([" " + x for x in w], "en")} for w in words.values()}
    assert len(set.union(*found.values())) == 4 and "other" not in set.union(*found.values())
    for w in ("loan", "garden", "anchor"):
        held = sum(w in text.split() for _, text, _ in rows)
        assert math.isclose(model.idf[w], math.log(len(rows) / held) + 1e-3)


def dense(texts: dict[int, tuple[list[str], str]], names: list[str], idf: np.ndarray, k: int) -> np.ndarray:
    """The centres by plain arrays of all texts."""
    x = np.array([[idf[j] * (w in words) for j, w in enumerate(names)] for _, (words, _) in sorted(texts.items())])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lang = np.array([g for _, (_, g) in sorted(texts.items())])
    y = x - np.stack([x[lang == g].mean(axis=0) for g in lang])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = y[:1]
    while len(c) < k:
        c = np.vstack([c, y[np.argmin((y @ c.T).max(axis=1))]])
    for _ in range(topics.ROUNDS):
        of = np.argmax(y @ c.T, axis=1)
        c = np.stack([y[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(k)])
        c /= np.linalg.norm(c, axis=1, keepdims=True)
    return c


def test_centres_equal_those_of_plain_arrays(spark):
    rnd = random.Random(11)
    some = [a + b for a in ("lor", "mip", "tas", "qued") for b in ("ana", "emo", "iri", "usk", "oba", "yve")]
    texts = {i: (rnd.sample(some[(i % 4) * 6 : (i % 4) * 6 + 6], 3) + rnd.sample(some, 5), rnd.choice(["en", "de"])) for i in range(2500)}
    rows = [(i, " ".join(w), g) for i, (w, g) in texts.items()]
    # rows that are repeated, null or without words change nothing
    df = spark.createDataFrame(rows + rows[:700] + [(9000, None, "en"), (9001, "", "en"), (9002, "12 a", "fr"), (None, None, None)], COLUMNS)
    model = topics.fit_topics(df, F.col("lang"), k=4)
    names = sorted(model.idf)
    idf = np.array([model.idf[w] for w in names])
    assert names == sorted(some) and all(math.isclose(model.idf[w], math.log(2500 / sum(w in ws for ws, _ in texts.values())) + 1e-3) for w in names)
    assert np.allclose(np.stack([model.weights[w] for w in names]).T / idf, dense(texts, names, idf, 4), atol=1e-5)
    again = topics.fit_topics(df.repartition(7), F.col("lang"), k=4)
    assert all((again.weights[w] == model.weights[w]).all() for w in names)


def test_texts_that_are_all_alike_and_languages_of_one_text(spark):
    alike = spark.createDataFrame([(i, "anchor mast sail", "en") for i in range(5)], COLUMNS)
    assert topics.fit_topics(alike, F.col("lang")).topic([" mast"], "en") == "topic-0"
    rows = [(i, "anchor mast" if i % 2 else "garden hedge", "en") for i in range(40)] + [(90, "anchor garden", "fr")]
    model = topics.fit_topics(spark.createDataFrame(rows, COLUMNS), F.col("lang"), k=2)
    # more than 0.4 of the texts hold each word
    assert model.topic([" anchor"], "en") == "other"
    rows += [(100 + i, "sail rudder", "en") for i in range(20)]
    model = topics.fit_topics(spark.createDataFrame(rows, COLUMNS), F.col("lang"), k=3)
    assert len({model.topic([w], "en") for w in (" anchor", " garden", " sail")}) == 3
