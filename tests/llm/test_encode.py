import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadmill.llm import encode, mixing, splitting, topics

pytestmark = pytest.mark.skipif(not Path(encode.VOCABULARY).exists(), reason="no vocabulary files")
ODD = ["", " ", "<|endoftext|>", "a" * 5000, "ab" * 400, " " * 300, "日本語のテキスト" * 30, "𒍲𒀽𒋊" * 40, "naïvé    x", "it's we'll I'M", "\x00\x1c\x85\r\n\t", "😀👩‍👩‍👧", "x\n\n\ny   z", "12345 ٣٤"]


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_ids_equal_the_public_tokenizer(spark, public):
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice("ab aA'é日 \n\t1٣.-😀") for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)] + [(-1, None, None)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode.encode(df).collect()}
    assert got[-1] == []
    for i, t in enumerate(texts):
        assert got[i] == public(t), repr(t[:40])
        assert encode.decode_bytes(got[i]).decode() == t or len(t) > 1000
    assert encode.encode(df.limit(0)).collect() == []


def test_forgetting_words_changes_nothing(public, monkeypatch):
    enc = encode.Encoder(encode.VOCABULARY)
    monkeypatch.setattr(encode, "KEPT_WORDS", 3)
    for t in ["one two three four five six", "seven eight one", "six"]:
        assert enc.ids([t]).to_pylist() == [public(t)]


@pytest.mark.parametrize(("alphabet", "size"), [("abcdefghij", 17_000), ("a", 20_000), ("ab", 9_000), ("etaoin shrdlu", 3_000), ("日本語é", 2_000), ("th ein", 40_000)])
def test_words_of_any_length_go_one_way(public, alphabet, size, monkeypatch):
    rnd = random.Random(1)
    word = "".join(rnd.choice(alphabet) for _ in range(size))
    assert encode.encoder(encode.VOCABULARY).ids([word]).to_pylist() == [public(word)]
    # a query that may take few steps goes on where it stopped
    monkeypatch.setattr(encode, "CHUNK_ROWS", 2 * size)
    assert encode.Encoder(encode.VOCABULARY).ids([word, "and short ones"]).to_pylist() == [public(word), public("and short ones")]


def test_neighbours_of_one_rank_and_of_rising_and_falling_ranks(public):
    rnd = random.Random(3)
    words = ["".join(rnd.choice(["a", "aa", "in", "ing", "er", "th", "e", " "]) for _ in range(rnd.randint(1, 30))) for _ in range(400)]
    assert encode.Encoder(encode.VOCABULARY).ids(words).to_pylist() == [public(w) for w in words]


def pieces_hold(text, pieces, public, limit, overlap):
    assert all(len(public(p["piece"])) == p["n_tokens"] <= limit for p in pieces)
    assert pieces[0]["start_char"] == 0 and pieces[-1]["end_char"] == len(text)
    for a, b in zip(pieces, pieces[1:]):
        assert b["new_from"] == a["end_char"] and b["start_char"] <= b["new_from"]
        assert len(public(text[b["start_char"]:b["new_from"]])) <= overlap
    assert "".join(text[p["new_from"]:p["end_char"]] for p in pieces) == text


def test_split_pieces(public):
    enc = encode.encoder(encode.VOCABULARY)
    rnd = random.Random(2)
    prose = "".join(rnd.choice(["A sentence ends here. ", "Another one, with a clause, follows! ", "New line\n", "Paragraph.\n\n"]) for _ in range(900))
    for text in (prose, "word " * 3000, "a" * 9000, "日本語。" * 1500, "\n" * 40 + "x. " * 3000, "no-boundaries" * 900):
        pieces = splitting.split_text(text, enc, 512, 64)
        assert len(pieces) >= 2
        pieces_hold(text, pieces, public, 512, 64)
    assert [p["boundary"] for p in splitting.split_text(prose, enc, 512, 64)][1:].count("paragraph") > 5
    assert splitting.split_text("short text", enc, 512, 64) == []
    exact = "word " * 511 + "word"
    assert len(public(exact)) == 512 and splitting.split_text(exact, enc, 512, 64) == [] and len(splitting.split_text(exact + " more", enc, 512, 64)) == 2


def test_a_limit_that_nothing_keeps_is_an_error():
    enc = encode.encoder(encode.VOCABULARY)
    with pytest.raises(ValueError, match="no pieces"):
        splitting.split_text("𒍲𒀽𒋊", enc, 1, 0)
    assert "".join(p["piece"] for p in splitting.split_text("𒍲𒀽𒋊 abc", enc, 4, 0)) == "𒍲𒀽𒋊 abc"


def test_split_query(spark):
    rows = [(1, "w " * 3000), (1, "w " * 3000), (2, "short"), (3, None), (4, ""), (5, "  "), (6, "日本" * 1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = splitting.split(df, 512, 64)
    assert {r["doc_id"] for r in got.collect()} == {1, 6}
    assert splitting.split(df.limit(0)).collect() == []


TARGETS = "source string, target_weight double, max_repeats int"
DOCS = "doc_id long, text string, lang string, source string"


def test_mix(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "garden", "salary"]) for _ in range(rnd.randint(5, 60))) + f" {i}", rnd.choice(["en", "de", None, "EN "]), rnd.choice(["Big ", "big", "SMALL"] if i % 10 == 0 else ["big"])) for i in range(1500)]
    docs += [(9001, None, "en", "big"), (9002, "", "en", "small"), (9003, "unlabelled text", "en", None), (9004, docs[0][1], "en", "big")]
    df = spark.createDataFrame(docs, DOCS)
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.5, 3), ("none", 0.0, 1), (None, 0.5, 1)], TARGETS)
    report = {r["source"]: r for r in mixing.plan(df, targets)[1].collect()}
    assert report["small"]["short"] and not report["big"]["short"] and not report["none"]["short"]
    assert abs(report["big"]["planned_tokens"] - report["big"]["target_tokens"]) < 1e-3 * report["big"]["target_tokens"]
    assert abs(report["small"]["planned_tokens"] - report["small"]["capacity"]) < 1
    mixed = mixing.mix(df, targets)
    taken = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    assert taken == {r["doc_id"]: r["copies"] for r in mixing.mix(df.repartition(5), targets).collect()}
    assert 9004 not in taken and 9001 not in taken and max(taken.values()) <= 3
    shares = {r["source"]: r["tokens"] for r in mixing.shares(mixed).collect()}
    assert abs(shares["big"] - report["big"]["target_tokens"]) < 0.06 * report["big"]["target_tokens"]
    assert shares["small"] == report["small"]["capacity"]
    assert mixing.mix(df.limit(0), targets).collect() == [] and not any(r["short"] for r in mixing.plan(df.limit(0), targets)[1].collect())
    assert mixing.plan(df, targets.limit(0))[1].collect() == []


CELLS = [("a", "en", "x", 100), ("a", "de", "x", 50), ("a", "en", "y", 30), ("b", "en", "x", 60), ("b", "de", "y", 160)]


def raked(targets, total=500.0):
    return mixing.fit([{"source": s, "lang": g, "topic": t, "tokens": n} for s, g, t, n in CELLS], [{"source": s, "weight": w, "max_repeats": m} for s, w, m in targets], total)


def test_raking_meets_all_margins_where_it_can():
    f = raked([("a", 0.3, 9), ("b", 0.7, 9)])
    assert f.converged and abs(f.of("a") - 150) < 1e-6 and abs(f.of("b") - 350) < 1e-6
    assert all(abs(m["fitted_tokens"] - m["goal_tokens"]) < 1e-6 * m["goal_tokens"] for m in f.margins) and len(f.margins) == 6
    assert {(m["margin"], m["key"]): round(m["goal_tokens"], 6) for m in f.margins}[("lang", "en")] == 237.5


def test_full_cells_leave_their_source_short():
    f = raked([("a", 0.9, 2), ("b", 0.1, 9)])
    assert f.of("a") == 360 and abs(f.of("b") - 50) < 1e-6
    # exactly enough is not short; what full cells cannot take goes to others of the source
    assert abs(raked([("a", 0.72, 2), ("b", 0.1, 9)]).of("a") - 360) < 1e-6
    g = raked([("a", 0.6, 2), ("b", 0.4, 9)])
    assert abs(g.of("a") - 300) < 1e-6 and all(w <= 2 * n + 1e-9 for w, n, c in zip(g.weights, g.tokens, g.cells) if c[0] == "a")
    assert mixing.fit([], [{"source": "a", "weight": 1.0, "max_repeats": 1}], 0.0).of("a") == 0


def test_topics_follow_words_and_not_languages(spark):
    rnd = random.Random(7)
    fields = {"en": (["the", "and", "with", "from"], ["garden", "seed", "hedge", "compost"], ["loan", "budget", "salary", "rent"]), "de": (["und", "der", "mit", "aus"], ["garten", "samen", "hecke", "kompost"], ["kredit", "konto", "gehalt", "miete"])}
    rows, want = [], []
    for i in range(400):
        lang = rnd.choice(["en", "de"])
        of = rnd.randint(1, 2)
        rows.append((i, " ".join(rnd.choice(fields[lang][0]) + " " + rnd.choice(fields[lang][of]) for _ in range(30)), lang))
        want.append((lang, of))
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "", "en")], "doc_id long, text string, lang string")
    model = topics.fit_topics(df, F.col("lang"), 300, 4)
    found = {}
    for (_, text, lang), key in zip(rows, want):
        found.setdefault(key, []).append(model.topic([" " + w for w in text.split()], lang))
    purest = {k: max(set(v), key=v.count) for k, v in found.items()}
    assert all(v.count(purest[k]) > 0.9 * len(v) for k, v in found.items())
    assert purest[("en", 1)] != purest[("en", 2)] and purest[("de", 1)] != purest[("de", 2)]
    assert model.topic([" unheard", " of"], "en") == "other"
    again = topics.fit_topics(df.repartition(3), F.col("lang"), 300, 4)
    assert all((again.weights[w] == model.weights[w]).all() for w in model.weights)
    assert topics.fit_topics(df.limit(0), F.col("lang")).topic([" garden"], "en") == "other"
