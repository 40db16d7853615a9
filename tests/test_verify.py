from threadmill.operators import review, verify

OWN = "The line I return to is that being trusted with hard problems matters more to me than owning them, and I wrote it down."
THEIRS = "It sounds as though you describe an ambition that was borrowed from somebody else rather than chosen by you."
TURNS = [
    (1, 0, "user", OWN), (1, 1, "assistant", "You said being trusted with hard problems matters more to me than owning them. Why?"), (1, 2, "user", "Because being trusted with hard problems matters more to me than owning them, and ownership is mostly paper to me."),
    (2, 0, "assistant", THEIRS), (2, 1, "user", "Yes exactly, you describe an ambition that was borrowed from somebody else rather than chosen by you. I see it everywhere now."), (2, 2, "user", "Map which of your goals are chosen and which of your goals are inherited from others\n• then name your strongest one"),
    (3, 0, "user", "Skip to main content. The committee approved a revised capital framework through the end of the year."),
]
NOTES = {
    "ok.md": f'> "{OWN[:69]}"', "para.md": '> "being trusted with difficult questions matters far more than ownership ever did"', "theirs.md": '> "It sounds as though you describe an ambition that was borrowed"',
    "echo.md": '**assistant-coined** below\n\n> "you describe an ambition that was borrowed from somebody else rather than chosen"', "plain.md": 'none cleaned here\n> "a line that nobody ever wrote in any turn of this small archive"', "between.md": '**Trap:** he pasted it, see **Why**\n> "The committee approved a revised capital framework through the end"',
    "chip.md": '> “Map which of your goals are chosen and which of your goals are inherited”', "elided.md": '> "The line I return to is that ... matters more to me than owning them"', "short.md": 'he said "yes" and then "no, not today" to it', "_skip.md": '> "The committee approved a revised capital framework through the end"', "first.md": '> "Because being trusted with hard problems matters more to me than owning them"', "lab.md": '> "a line that nobody ever wrote in any turn of this small archive" **unverifiable**',
}
WANT = {"ok.md": ("ok", False), "para.md": ("unsourced", False), "theirs.md": ("unsourced", False), "echo.md": ("echoed", True), "plain.md": ("unsourced", False), "between.md": ("not_authored", False), "chip.md": ("not_authored", False), "elided.md": ("ok", False), "first.md": ("ok", False), "lab.md": ("unsourced", True)}


def test_quotes_and_statuses(spark):
    turns = spark.createDataFrame(TURNS, "conv_no long, pos int, role string, text string")
    notes = spark.createDataFrame(list(NOTES.items()), "file string, content string")
    got = {r["file"]: (r["status"], r["labeled"]) for r in verify.check(notes, turns).collect()}
    assert got == WANT
    fails = {r["file"] for r in verify.failures(verify.check(notes, turns)).collect()}
    assert fails == {f for f, (s, lab) in WANT.items() if s != "ok" and not lab}


def test_nothing_to_check(spark):
    turns = spark.createDataFrame([], "conv_no long, pos int, role string, text string")
    notes = spark.createDataFrame([("a.md", None), ("b.md", ""), ("c.md", "no quotation")], "file string, content string")
    assert verify.check(notes, turns).collect() == []


def test_review_tables(spark):
    ledger = spark.createDataFrame([("c1", "f1", "Reviewed ", "2024-01-01", 3, 1), ("c1", "f1", "promoted", "2023-01-01", 5, 1), (None, "f2", "queued", "2024-01-01", 3, 1), (None, None, "reviewed", "2024-01-01", 3, 1), ("", "f3", "REVIEWED", None, None, 1)], "conversation_id string, file string, status string, marked_on string, user_turns long, run_id long")
    got = {r["rec_key"]: (r["status"], r["marked_on"], r["seen_turns"]) for r in review.recorded(ledger).collect()}
    assert got == {"c1": ("promoted", "2024-01-01", 5), "f3": ("reviewed", None, None)}
    rows = spark.createDataFrame([("c1", "f1", 9), (None, "f9", 2)], "conversation_id string, file string, user_turns long")
    after = {r["rec_key"]: (r["status"], r["marked_on"], r["seen_turns"]) for r in review.mark(review.recorded(ledger), rows, "reviewed", "2025-05-05").collect()}
    assert after["c1"] == ("promoted", "2025-05-05", 9) and after["f9"] == ("reviewed", "2025-05-05", 2) and after["f3"][0] == "reviewed"
    pending = review.pend(spark.createDataFrame([], "rec_key string, file string, user_turns long, notes array<string>"), rows, "n1.md")
    pending = review.pend(review.pend(pending, rows.withColumn("user_turns", rows.user_turns + 1), "n2.md"), rows, "n1.md")
    assert {r["rec_key"]: (r["user_turns"], r["notes"]) for r in pending.collect()} == {"c1": (9, ["n1.md", "n2.md"]), "f9": (2, ["n1.md", "n2.md"])}
    done, held = review.finalize(review.recorded(ledger), pending, spark.createDataFrame([("f9",)], "stem string"), "2025-06-06")
    assert {r["rec_key"] for r in held.collect()} == {"f9"} and {r["rec_key"]: r["status"] for r in done.collect()}["c1"] == "promoted"


def test_sync_and_note_problems(spark):
    text = "| OK | T |\n|---|---|\n| [x] | [[nope]] [[2024-01-01-a\\|t]] |\n| [ ] | [b](../x/2024-01-02-b.md) |\nno row [[2024-01-01-a]]"
    lists = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    index = spark.createDataFrame([("2024-01-01-a.md",), ("2024-01-02-b.md",)], "file string")
    assert {r["stem"]: r["ticked"] for r in review.sync(lists, index).collect()} == {"2024-01-01-a": True, "2024-01-02-b": False}
    notes = spark.createDataFrame([("good", "---\nsource: x\n---\n# t\n*Sources:* [[2024-01-01-a]]"), ("bad", "# t\n*Sources:* [[2024-09-09-gone]]"), ("none", "---\nsource:\n---\n"), ("null", None)], "file string, content string")
    got = {r["file"]: (r["problems"], r["cited"]) for r in review.note_problems(notes, index).collect()}
    assert got["good"] == ([], ["2024-01-01-a"])
    assert got["bad"][0] == ["no frontmatter block", "cites an unknown conversation"] and "frontmatter has no source" in got["none"][0] and got["null"][0]
