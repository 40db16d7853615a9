import json
import zipfile

import pytest

from threadmill import cli
from threadmill.operators import catalog, profile, shortlist, turns
from threadmill.sources import exports, markdown, sinks
from threadmill.streaming import intake


def convo(title, said, cid="c"):
    mapping, parent = {"root": {"id": "root", "message": None, "parent": None, "children": []}}, "root"
    for i, (role, text) in enumerate(said):
        mapping[f"n{i}"] = {"id": f"n{i}", "parent": parent, "children": [], "message": {"id": f"n{i}", "author": {"role": role}, "create_time": 1700000000.0 + i, "content": {"content_type": "text", "parts": [text]}, "metadata": {}}}
        parent = f"n{i}"
    return {"title": title, "create_time": 1700000000.0, "conversation_id": cid, "current_node": parent, "mapping": mapping}


LONG = "I keep thinking about what I want my own year to look like and I write it down for me. " * 4
A = convo("First thing", [("user", LONG), ("assistant", "ok"), ("user", '{"text": "object"}')], "a")
B = convo("Second | thing", [("user", LONG + "Again.\n\n---\n\nA rule above."), ("assistant", "sure")], "b")
C = convo("Short", [("user", "hi"), ("assistant", "hello")], "c")


def ids(df):
    return [r["conversation_id"] for r in df.orderBy("conv_no").collect()]


def test_exports(spark, tmp_path):
    single = tmp_path / "one.json"
    single.write_text(json.dumps([A, B]))
    assert ids(exports.read(spark, str(single))) == ["a", "b"]
    folder = tmp_path / "shards"
    folder.mkdir()
    for n, c in ((10, C), (2, B), (0, A)):
        (folder / f"conversations-{n:03d}.json").write_text(json.dumps([c]))
    assert ids(exports.read(spark, str(folder))) == ["a", "b", "c"]
    (folder / "conversations.json").write_text(json.dumps([C]))
    assert ids(exports.read(spark, str(folder))) == ["c"]
    z = tmp_path / "export.zip"
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("x/conversations-001.json", json.dumps([B]))
        f.writestr("x/conversations-000.json", json.dumps([A]))
    assert ids(exports.read(spark, str(z))) == ["a", "b"]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "conversations-000.json").write_text(json.dumps({"a": 1}))
    with pytest.raises(Exception, match="expected a list"):
        exports.read(spark, str(bad)).collect()
    # only shards are guarded; of a single file the format check says what is wrong
    with zipfile.ZipFile(tmp_path / "odd.zip", "w") as f:
        f.writestr("conversations.json", json.dumps({"a": 1}))
    assert profile.verdict(exports.read(spark, str(tmp_path / "odd.zip"))).first()["error"] != ""
    with pytest.raises(FileNotFoundError):
        exports.read(spark, str(tmp_path))
    said = turns.linearized(exports.read(spark, str(single))).orderBy("conv_no", "pos").collect()
    assert [r["role"] for r in said] == ["user", "assistant", "user", "user", "assistant"]


def test_format_check(spark, tmp_path):
    def verdict(data):
        f = tmp_path / "v.json"
        f.write_text(json.dumps(data))
        df = exports.read(spark, str(f))
        return profile.verdict(df).first(), {(r["role"], r["content_type"]): r["handled"] for r in profile.messages(df).collect()}

    assert verdict([A, B])[0]["error"] == ""
    odd = convo("t", [("user", "text here")])
    odd["mapping"]["n0"]["message"]["content"]["content_type"] = "new_kind"
    v, kinds = verdict([A, odd])
    assert v["error"] == "" and kinds[("user", "new_kind")] == "unknown type" and v["unknown"] == 1
    assert verdict([odd])[0]["error"] == "no user text"
    assert verdict([{"title": "x"}, {"title": "y"}, A])[0]["error"] == "mapping is missing"
    assert verdict([])[0]["error"] == "no conversations"


def test_parse_rank_and_read_back(spark, tmp_path):
    src = tmp_path / "one.json"
    src.write_text(json.dumps([A, B, C]))
    assert cli.main(["parse", str(src), "--out", str(tmp_path / "w")]) == 0
    files = markdown.read(spark, str(tmp_path / "w/conversations"))
    assert {r["file"] for r in files.collect()} == {"2023-11-14-first-thing.md", "2023-11-14-second-thing.md"}
    back = markdown.dialogue(files)
    sent = turns.linearized(exports.read(spark, str(src))).where("conv_no < 2")
    assert [r["text"] for r in back.orderBy("file", "pos").collect()] == [r["text"] for r in sent.orderBy("conv_no", "pos").collect()]
    assert cli.main(["rank", str(src), "--out", str(tmp_path / "w"), "--as-of", "2024-01-01"]) == 0
    text = (tmp_path / "w/SHORTLIST.md").read_text()
    assert "second-thing\\|Second \\| thing" in text and text.count("| [ ] |") == 2
    with pytest.raises(FileExistsError):
        cli.main(["rank", str(src), "--out", str(tmp_path / "w")])
    (tmp_path / "w/chunks").mkdir()
    (tmp_path / "w/chunks/chunk-99.md").write_text("of an earlier packing")
    assert cli.main(["voice", str(src), "--out", str(tmp_path / "w")]) == 0
    assert not (tmp_path / "w/chunks/chunk-99.md").exists()
    years = spark.read.text(str(tmp_path / "w/years"))
    assert [r["year"] for r in years.select("year").distinct().collect()] == [2023] and years.where("value like '## %'").count() == 2
    assert (tmp_path / "w/chunks/chunk-01.md").read_text().startswith("# Your turns - chunk 1")
    idx = spark.createDataFrame([("2023-11-14-first-thing.md", None), ("nope.md", "k")], "file string, conversation_id string")
    assert {r["conversation_id"] for r in markdown.backfill_ids(idx, files).collect()} == {"a", "k"}
    assert cli.main(["check", str(src)]) == 0


def test_ledger_files(spark, tmp_path):
    led, waiting = exports.read_ledger(spark, str(tmp_path / "none.json"))
    assert led.collect() == waiting.collect() == []
    f = tmp_path / "ledger.json"
    led = spark.createDataFrame([("k", "reviewed", "2024-01-01", 3)], sinks.LEDGER_SCHEMA)
    waiting = spark.createDataFrame([("p", "f.md", 2, ["n.md"])], sinks.PENDING_SCHEMA)
    f.write_text(exports.ledger_json(led, waiting))
    back = exports.read_ledger(spark, str(f))
    assert [tuple(r) for r in back[0].collect()] == [("k", "reviewed", "2024-01-01", 3)] and [tuple(r) for r in back[1].collect()] == [("p", "f.md", 2, ["n.md"])]
    for n in range(2):
        assert sinks.write_ledger(led, str(tmp_path / "led")) == n
    assert sinks.read_ledger(spark, str(tmp_path / "led")).count() == 1


def test_duplicate_keys_keep_the_last_value(spark, tmp_path):
    node = lambda n, text: json.dumps({"id": n, "parent": None, "children": [], "message": {"author": {"role": "user"}, "content": {"content_type": "text", "parts": [text]}}})
    (tmp_path / "d.json").write_text(f'[{{"conversation_id": "a", "mapping": {{"x": {node("x", "old")}, "y": {node("y", "y")}, "x": {node("x", "new")}}}}}]')
    mapping = exports.read(spark, str(tmp_path / "d.json")).first()["mapping"]
    assert {k: v["message"]["content"]["parts"] for k, v in mapping.items()} == {"x": ["new"], "y": ["y"]}


def test_review_round(spark, tmp_path):
    """parse, rank, tick, sync, promote, rank again: what was read is not offered again, what a note cites waits for its tick."""
    src, w = tmp_path / "one.json", tmp_path / "w"
    src.write_text(json.dumps([A, B, C]))
    led = str(tmp_path / "ledger.json")
    assert cli.main(["run", str(src), "--out", str(w), "--ledger", led, "--as-of", "2024-01-01"]) == 0
    text = (w / "SHORTLIST.md").read_text()
    ticked = "\n".join(line.replace("| [ ] |", "| [x] |") if "first-thing" in line else line for line in text.split("\n"))
    (w / "SHORTLIST.md").write_text(ticked)
    staged, notes = tmp_path / "staged", tmp_path / "notes"
    staged.mkdir()
    (staged / "good.md").write_text('---\nsource: me\n---\n# t\n\n> "I keep thinking about what I want my own year to look like"\n\n*Sources:* [[2023-11-14-second-thing]]')
    (staged / "bad.md").write_text("# no head")
    promote = ["promote", str(staged), "--export", str(src), "--notes", str(notes), "--ledger", led]
    assert cli.main([*promote, "--check"]) == 1 and not notes.exists()
    assert cli.main(promote) == 1
    assert [p.name for p in notes.glob("*.md")] == ["good.md"]
    assert [r["rec_key"] for r in exports.read_ledger(spark, led)[1].collect()] == ["b"]
    # the note is there now, so it is refused without --replace
    (staged / "bad.md").unlink()
    assert cli.main([*promote, "--check"]) == 1 and cli.main([*promote, "--check", "--replace"]) == 0
    assert cli.main(["ledger", "sync", "--index", str(w / "index"), "--shortlist", str(w / "SHORTLIST.md"), "--ledger", led, "--as-of", "2024-01-02"]) == 0
    done, waiting = exports.read_ledger(spark, led)
    assert {r["rec_key"]: r["status"] for r in done.collect()} == {"a": "reviewed"} and [r["rec_key"] for r in waiting.collect()] == ["b"]
    assert cli.main(["verify", str(notes), "--transcripts", str(w / "conversations")]) == cli.main(["verify", str(notes), "--export", str(src)]) == 0
    assert [r["text"] for r in markdown.user_turns(markdown.read(spark, str(w / "conversations"))).where("file like '%second%'").collect()] == [LONG + "Again.\n\n---\n\nA rule above."]
    assert {r["conversation_id"] for r in markdown.read_index(spark, str(w / "index"), str(w / "conversations")).collect()} == {"a", "b"}
    assert cli.main(["rank", str(src), "--out", str(w), "--ledger", led, "--force", "--top", "5"]) == 0
    again = (w / "SHORTLIST.md").read_text()
    assert "second-thing" in again and "first-thing" not in again
    assert cli.main(["voice", str(src), "--out", str(w), "--ledger", led]) == 0
    assert [p.name for p in (w / "chunks").glob("*.md")] == ["chunk-01.md"] and "first-thing" not in (w / "chunks/chunk-01.md").read_text()
    assert cli.main(["ledger", "mark", "2023-11-14-second-thing", "nope", "--index", str(w / "index"), "--ledger", led, "--status", "promoted"]) == 0
    assert cli.main(["ledger", "show", "--index", str(w / "index"), "--ledger", led]) == 0
    assert {r["rec_key"]: r["status"] for r in exports.read_ledger(spark, led)[0].collect()} == {"a": "reviewed", "b": "promoted"}
    assert cli.main(["paths"]) == 0


def test_rescan_and_stale_index(spark, tmp_path):
    src = tmp_path / "one.json"
    src.write_text(json.dumps([A, B, C]))
    rows, said = catalog.index(exports.read(spark, str(src)))
    assert catalog.stale_fields(rows) == []
    old = rows.drop("authored_words", "terms")
    assert catalog.stale_fields(old) == ["authored_words", "terms"]
    fresh = catalog.rescan(old, markdown.dialogue(markdown.render(rows, said)))
    assert "content_days" not in fresh.columns
    want = {r["file"]: (r["authored_words"], r["terms"]) for r in rows.collect()}
    assert {r["file"]: (r["authored_words"], r["terms"]) for r in fresh.collect()} == want
    assert catalog.rescan(old, markdown.dialogue(markdown.render(rows, said)).limit(0)).first()["authored_words"] is None
    assert [r["conv_no"] for r in catalog.first(exports.read(spark, str(src)), 2).collect()] == [0, 1]


def test_shared_folder_is_never_one_machines_own(spark, tmp_path, monkeypatch):
    from threadmill import session

    class Cluster:
        conf = type("Unset", (), {"get": lambda self, key, default=None: default})()
        sparkContext = type("C", (), {"master": "yarn", "applicationId": "x"})

    monkeypatch.delenv("THREADMILL_CHECKPOINTS", raising=False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)
    named = tmp_path / "named"
    monkeypatch.setenv("THREADMILL_CHECKPOINTS", str(named))
    assert session.shared_dir(Cluster) == str(named) and str(named) not in session._OWN.values()
    monkeypatch.setattr(session, "shared_dir", lambda _: str(named))
    with session.scratch(spark):
        kept = session.stored(spark.range(3))
        assert kept.count() == 3 and len(list(named.glob("threadmill-*/tables/*"))) == 1
    assert list(named.glob("threadmill-*/tables/*")) == []


def test_stream_intake_is_exactly_once(spark, tmp_path):
    src = tmp_path / "one.json"
    src.write_text(json.dumps([A, B]))
    exports.read(spark, str(src)).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        intake.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "led")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    from threadmill.operators.incremental import WorkLedger

    # the keys are those of batch runs
    assert {r["rec_key"]: r["state"] for r in WorkLedger(spark, str(tmp_path / "led")).read().collect()} == {"a": "pending", "b": "pending"}


def test_shortlist_lists_all_deltas(spark):
    rows = spark.createDataFrame([(f"f{i:02d}.md", "t", float(i), False, i % 2 == 0) for i in range(80)], "file string, title string, score double, branch_dup boolean, delta_candidate boolean")
    got = shortlist.delta_list(rows, 10).collect()
    assert len(got) == 20 and sum(r["in_top"] for r in got) == 5
