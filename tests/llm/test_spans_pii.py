import random

import pytest

from threadmill.llm import pii, spans
from threadmill.llm.spans import LEAST, Shared, Texts, keep_units

MESSAGES = "msg_id long, parts array<string>, pairs string"


def common(a, b, least=LEAST):
    grams = {a[i:i + least] for i in range(len(a) - least + 1)}
    return any(b[i:i + least] in grams for i in range(len(b) - least + 1))


def corpus(seed):
    rnd = random.Random(seed)
    words = ["lamp", "river", "a", "stone.", "wind,", "é", "日本", "\n", "blue!", "seven"]
    prose = lambda n: " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) for _ in range(n))
    blob = lambda n: "".join(rnd.choice("abcdefXYZ0189/_") for _ in range(n))
    passages = [prose(60)[:k] for k in (239, 240, 241, 300)] + [blob(239), blob(240), blob(400), "=" * 300, "ab" * 150, "boiler plate text. " * 4]
    texts = []
    for i in range(120):
        p = rnd.choice(passages)
        texts.append(rnd.choice(["", prose(rnd.randint(0, 40))]) + p + rnd.choice(["", prose(rnd.randint(0, 40))]))
    texts += [texts[0], texts[0], "x" * 239, "", " ", "y" * 3000, "z" + "y" * 3000]
    return texts


def test_pairs_equal_brute_force(spark):
    texts = corpus(1)
    rows = [(i, [t], "x") for i, t in enumerate(texts)] + [(0, [texts[0]], None), (500, None, None), (501, [], None), (502, [None], None), (503, [texts[5], texts[9]], None), (504, ['{"text": "' + "q" * 260 + '"}'], None), (505, ["q" * 300], None)]
    df = spark.createDataFrame(rows, MESSAGES)
    by = {}
    for m, parts, _ in rows:
        by.setdefault(m, set()).update("q" * 260 if p and p[0] == "{" else p for p in parts or [] if p)
    ids = sorted(by)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if any(common(x, y) for x in by[a] for y in by[b])}
    shared = Shared(df)
    assert {tuple(r) for r in shared.pairs().collect()} == want
    shares = {r["msg_id"]: r["share"] for r in shared.shares().collect()}
    linked = {x for p in want for x in p}
    assert {m for m, s in shares.items() if s > 0} == linked and max(shares.values()) <= 1
    cleaned = {r["msg_id"]: r["kept"] for r in shared.cleaned().collect() if r["msg_id"] < 120}
    assert all(len(k) <= len(texts[m]) for m, k in cleaned.items()) and sum(map(len, cleaned.values())) < sum(map(len, texts)) * 0.9
    assert Shared(df.limit(0)).pairs().collect() == [] and Shared(df.limit(0)).shares().collect() == []


def test_every_long_span_holds_a_common_run():
    rnd = random.Random(8)
    for _ in range(60):
        alphabet = rnd.choice(["ab", "abcdefgh ", "ab. cd! ", "日本語。 ", "a"])
        span = "".join(rnd.choice(alphabet) for _ in range(LEAST))
        noise = lambda: "".join(rnd.choice("mnopq. ") for _ in range(rnd.randint(0, 300)))
        runs = []
        for text in (noise() + span + noise(), noise() + span + noise()):
            runs.append(set(Texts([text]).runs()[2].tolist()))
        assert runs[0] & runs[1]


def test_hashes_do_not_depend_on_place():
    t = Texts(["abc" * 100, "zz" + "abc" * 100])
    import numpy as np

    a = t.hashes(np.array([0]), np.array([250]))
    b = t.hashes(np.array([t.starts[1] + 2]), np.array([t.starts[1] + 252]))
    assert a[0] == b[0]


def test_keep_units():
    text = "First sentence here. " + "The repeated passage goes on and on. " * 9 + "Last one."
    kept = keep_units(text, [21 + i for i in range(0, 90)])
    assert kept.startswith("First sentence here. ") and kept.endswith("Last one.") and len(kept) < len(text)
    assert keep_units(text, []) == text and keep_units(text, [-1]) == ""


KINDS = [
    ("write to ann.lee+x@mail.example.org now", {"email"}), ("ann (at) mail.example.org", {"email"}), ("ann[at]mail[dot]example[dot]org", {"email"}), ("mailto:ANN@EXAMPLE.COM", {"email"}), ("ann@​mail.example.org", {"email"}), ("ann_lee at mail dot example dot org", {"email"}), ("ann @ example.org", {"email"}),
    ("meet me @ the old mill", set()), ("so at example dot com they say", set()), ("pin toolkit@1.2.3 now", set()), ("the @cached property", set()),
    ("call 212-555-0123", {"phone"}), ("(212) 555‑0123 ext. 9", {"phone"}), ("+49 (0)30 23125 000", {"phone"}), ("0049-30-23125-000", {"phone"}), ("my number is 2125550123", {"phone"}), ("Tel. two one two five five five oh one two three", {"phone"}), ("01632 960123", {"phone"}), ("text 212.555.0123", {"phone"}),
    ("row 402232816 of it", set()), ("order 2964-37451-28", set()), ("ISBN 978-0-2251-2650-0", set()), ("ticket #49-372-350", set()), ("build 10.8.30.21", set()), ("at 11:19:33 on 2024-05-17", set()), ("came to 515,107.55", set()),
    ("SSN 979110597", {"national_id"}), ("My SSN is 937-36-7603.", {"national_id"}), ("938-40-2470", {"national_id"}), ("NI no: QQ 24 70 82 C", {"national_id"}), ("my NINO is qq315121c ok", {"national_id"}), ("Passport X71363690", {"national_id"}), ("driver's licence Q362-2769-9646", {"national_id"}), ("Meine Steuer-ID ist 01 501 814 566.", {"national_id"}), ("mon NIR est 1 57 87 99 932 488 68", {"national_id"}), ("DNI: 34161250-W", {"national_id"}), ("social, digit by digit: 9 6 0 2 8 7 9 3 4", {"national_id"}),
    ("I lost my passport. I wrote 74 pages", set()), ("passport in 31 days", set()),
    ("at 31 Copperfield Drive", {"street_address"}), ("home is 317 stonecrop lane, calderby", {"street_address"}), ("Flat 5, 154 Candlewick Court", {"street_address"}), ("Mühlbachstraße 7, 47688 Ebbsmouth", {"street_address"}), ("Ulmenstr. 66", {"street_address"}), ("202 avenue du Vieux-Phare", {"street_address"}), ("129 bis impasse des Grives", {"street_address"}), ("Avda. del Faro Gris 348, 2º B", {"street_address"}), ("Plaza de la Noria 12", {"street_address"}),
    ("chapter 14 lane markings", set()), ("the 9 steps road map", set()), ("Main Street is busy", set()), ("street-test the idea, 3 weeks", set()),
    ("was signed by Anna Lind and stamped", {"person_name"}), ("hi ANNA LIND, sorry", {"person_name"}), ("Met anna lind again", {"person_name"}), ("according to Lind, Anna, the lease", {"person_name"}), ("Ask Mr. Lind about it", {"person_name"}), ("Mme Lind came", {"person_name"}), ("I owe A. Lind a reply", {"person_name"}), ("Thanks, Anna-Mia O'Lind", {"person_name"}), ("(written for Dr. Anna Lind)", {"person_name"}), ("That was Anna R. Lind's idea", {"person_name"}),
    ("met the manager again", set()), ("according to the plan, it rains", set()), ("Ask the neighbour about it", set()), ("lunch at the Blue Harbour", set()), ("", set()),
]


@pytest.mark.parametrize(("text", "kinds"), KINDS)
def test_kinds(text, kinds):
    assert {k for _, _, k in pii.spans(text)} == kinds


def test_redaction_keeps_the_rest():
    text = "Hi Anna Lind, write to ann@​mail.example.org or call 212‑555‑0123. It took 31 days — fine."
    assert pii.redact(text) == "Hi [PERSON_NAME], write to [EMAIL] or call [PHONE]. It took 31 days — fine."
    assert pii.redact("nothing here, 31 pages") == "nothing here, 31 pages"
    assert pii.redact(pii.redact(text)) == pii.redact(text)


def test_long_and_odd_texts_are_read_whole():
    text = "word " * 40000 + "ann@mail.example.org" + " İ" * 2000 + " 212-555-0123"
    assert [k for _, _, k in pii.spans(text)] == ["email", "phone"]


def test_found(spark):
    rows = [(1, ["a@b.example.org", '{"text": "call 212-555-0123"}']), (1, ["a@b.example.org"]), (2, None), (3, [None, ""]), (4, ['{"asset": "a@b.example.org"}'])]
    df = spark.createDataFrame(rows, "msg_id long, parts array<string>")
    assert {tuple(r) for r in pii.found(df).collect()} == {(1, "email"), (1, "phone")}
    assert {r["msg_id"]: r["texts"] for r in pii.redacted(df).collect()}[3] == [None, ""]
    assert pii.found(df.limit(0)).collect() == []
    assert spans
