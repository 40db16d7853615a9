from pathlib import Path

import pyarrow as pa
import pytest

from threadmill.llm import encode, splitting

pytestmark = pytest.mark.skipif(not Path(encode.VOCABULARY).exists(), reason="no vocabulary files")
TEXTS = ["first words of a text,\n\n  and more of them.   \n\n" * 60, "other words, seen nowhere else!  \n\n" * 90, "a" * 3000 + "日本" * 700, "short", None, "", "last ones stand here.\n\n\n" * 120]


def pieces(rows):
    batch = pa.record_batch({"doc_id": pa.array(range(len(rows)), pa.int64()), "text": pa.array(rows, pa.string())})
    return [r for b in splitting._splitting(encode.VOCABULARY, 128, 16)(iter([batch])) for r in b.to_pylist()]


def test_words_forgotten_inside_a_slice_change_nothing(monkeypatch):
    monkeypatch.setattr(encode, "_ENCODERS", {})
    want = pieces(TEXTS)
    assert {r["doc_id"] for r in want} == {0, 1, 2, 6}
    for kept in (0, 3, 20):
        monkeypatch.setattr(encode, "_ENCODERS", {})
        monkeypatch.setattr(encode, "KEPT_WORDS", kept)
        assert pieces(TEXTS) == want
        assert [p for t in TEXTS[:2] for p in splitting.split_text(t, encode.encoder(encode.VOCABULARY), 128, 16)] == [{k: v for k, v in r.items() if k != "doc_id"} for r in want if r["doc_id"] < 2]
