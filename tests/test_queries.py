"""Every registered query runs on the smallest tables, and equals its SQL where it has one."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))
DATA = "/root/testdata/sf0.001"
from compare import compare  # noqa: E402

from threadmill.plans import analytics, preparation  # noqa: E402

NAMES = [*analytics.QUERIES, *preparation.QUERIES]


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    said = compare(spark, DATA, name)
    assert said.startswith(("equal", "rows only")), said


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_empty_tables_nulls_and_repeated_rows(spark, odd_tables, kind):
    for name in [*preparation.QUERIES, "intake_account", "message_echoes", "quote_checks", "chunk_pack", "marked_ledger", "note_problems"]:
        said = compare(spark, str(odd_tables / kind), name)
        assert said.startswith(("equal", "rows only")), (name, said)


def test_core_does_without_llm():
    for f in (ROOT / "threadmill").rglob("*.py"):
        if "llm" not in f.parts:
            assert "threadmill.llm" not in f.read_text(), f
