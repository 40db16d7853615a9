import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
DATA = "/root/testdata/sf0.001"
from compare import compare  # noqa: E402

from threadmill.llm import queries  # noqa: E402


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    said = compare(spark, DATA, name)
    assert said.startswith(("equal", "rows only")), said


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_empty_tables_nulls_and_repeated_rows(spark, odd_tables, kind):
    for name in queries.QUERIES:
        said = compare(spark, str(odd_tables / kind), name)
        assert said.startswith(("equal", "rows only")), (name, said)
