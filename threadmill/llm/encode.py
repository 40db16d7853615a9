"""Encoding a corpus with a public byte-level BPE vocabulary.

A text is split into words by the vocabulary's published pattern; merges never
cross words. The distinct words of a partition that have no ids yet go to
DuckDB as token-position rows. A recursive query joins neighbouring tokens with
the merge table and contracts, word by word, the pairs of least rank from the
left, until no pair is left; an ordered aggregation reads the ids off. Words of
any length go the same way. Texts are
then put together from the ids of their words, so a word costs merges once per
worker and not once per occurrence.

Cases: null and empty texts have an empty list of ids. A special token spelt out
in a text is ordinary text. Repeated rows repeat their ids. Texts of any length
are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern the vocabulary's publisher splits text with before merging. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = os.environ.get("THREADMILL_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"
#: Words whose ids a worker keeps at most before it forgets them all; it bounds memory, not the result.
KEPT_WORDS = 400_000
#: Characters of texts that are joined and converted at once.
SLICE_CHARS = 4_000_000

#: One step contracts every pair that the contraction from the least rank up would contract anyway before anything could
#: change it. A token made by rank r takes part in pairs of rank ``next_use`` of r or more only; so below the least next_use
#: of a word's pairs no new pair can come up (``bound``). There, a pair whose neighbours have larger ranks is contracted for
#: certain; of neighbours of one rank, as in a run of one letter, every second from the left, once what stands left of the
#: run is settled. The least pair of a word always qualifies, so every step contracts something until no pair is left.
MERGE = """
WITH RECURSIVE step(w, i, tok, n) AS (
  SELECT w, p, tok, 0 FROM symbols
  UNION ALL
  SELECT w, i, CASE WHEN taken THEN made ELSE tok END, n + 1
  FROM (
    SELECT w, i, tok, n, made, taken, lag(taken, 1, false) OVER word AS absorbed
    FROM (
      SELECT *, made IS NOT NULL AND (place - (run >> 1)) % 2 = 0 AND run & 1 = 1 AND coalesce(after >= made, true) AS taken
      FROM (
        SELECT *, max(CASE WHEN made IS DISTINCT FROM before THEN (place << 1) | (CASE WHEN coalesce(before > made, true) THEN 1 ELSE 0 END) END) OVER word AS run
        FROM (
          SELECT w, i, tok, n, made, lag(made) OVER word AS before, lead(made) OVER word AS after, row_number() OVER word AS place
          FROM (
            SELECT w, i, tok, n, CASE WHEN made < bound THEN made END AS made
            FROM (
              SELECT s.w, s.i, s.tok, s.n, m.made, min(m.next_use) OVER (PARTITION BY s.w) AS bound
              FROM (SELECT *, lead(tok) OVER word AS following FROM step WHERE n < $rounds WINDOW word AS (PARTITION BY w ORDER BY i)) s
              LEFT JOIN merges m ON s.tok = m.a AND s.following = m.b)
            WHERE bound IS NOT NULL)
          WINDOW word AS (PARTITION BY w ORDER BY i))
        WINDOW word AS (PARTITION BY w ORDER BY i))
      )
    WINDOW word AS (PARTITION BY w ORDER BY i))
  WHERE NOT absorbed
)
SELECT w, list(tok ORDER BY i) AS ids, any_value(n) AS n
FROM step SEMI JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n) GROUP BY w
"""
#: Bytes of words that go to DuckDB at once; a longer word goes alone. Rows of one query, which bound its steps; words that
#: need more steps go on from where they are.
CHUNK_BYTES, CHUNK_ROWS = 200_000, 3_000_000


def byte_names() -> dict[int, str]:
    """The published naming of bytes by printable characters: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Word to ids by the merge table; one per Python worker."""

    def __init__(self, vocabulary: str):
        import duckdb
        import regex

        with open(vocabulary, encoding="utf-8") as fh:
            model = json.load(fh)["model"]
        ids = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.byte_ids = [ids[c] for _, c in sorted(byte_names().items())]
        made = [ids[a + b] for a, b in merges]
        assert made == sorted(made), "ids must rise with the rank of the merge"
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        table = pa.table({"a": pa.array([ids[a] for a, _ in merges], pa.int32()), "b": pa.array([ids[b] for _, b in merges], pa.int32()), "made": pa.array(made, pa.int32())})
        self.con.register("merge_rows", table)
        uses = "SELECT part, min(made) AS next_use FROM (SELECT a AS part, made FROM merge_rows UNION ALL SELECT b, made FROM merge_rows) GROUP BY part"
        self.con.execute(f"CREATE TABLE merges AS SELECT a, b, made, coalesce(next_use, 2147483647)::INT AS next_use FROM merge_rows LEFT JOIN ({uses}) ON part = made")
        self.con.unregister("merge_rows")

    def learn(self, words: list[str]) -> None:
        """Find the ids of words, in chunks of bounded size; a very long word is a chunk of its own."""
        import numpy as np

        table = np.asarray(self.byte_ids, np.int32)
        group: list[tuple[str, np.ndarray]] = []
        size = 0
        for w in sorted(words, key=len):
            ids = table[np.frombuffer(w.encode("utf-8", "surrogatepass"), np.uint8)]
            if size and size + len(ids) > CHUNK_BYTES:
                self._contract(group)
                group, size = [], 0
            group.append((w, ids))
            size += len(ids)
        if group:
            self._contract(group)

    def _contract(self, group: list[tuple[str, object]]) -> None:
        import numpy as np

        while group:
            names, tokens = zip(*group)
            lengths = np.fromiter(map(len, tokens), np.int32, len(tokens))
            flat = np.concatenate(tokens)
            ends = np.cumsum(lengths)
            rounds = max(1, CHUNK_ROWS // len(flat))
            self.con.register("symbols", pa.table({
                "w": np.repeat(np.arange(len(tokens), dtype=np.int32), lengths),
                "p": (np.arange(len(flat)) - np.repeat(ends - lengths, lengths)).astype(np.int32),
                "tok": flat,
            }))
            found = self.con.sql(MERGE, params={"rounds": rounds}).to_arrow_table()
            self.con.unregister("symbols")
            values = found.column("ids").combine_chunks()
            offsets, ids = values.offsets.to_numpy(), values.values.to_numpy()
            group = []
            for w, n, start, end in zip(found.column("w").to_pylist(), found.column("n").to_pylist(), offsets[:-1], offsets[1:]):
                if n < rounds:
                    self.known[names[w]] = ids[start:end].tobytes()
                else:
                    group.append((names[w], ids[start:end]))

    def words(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them known until the next call, which may forget them."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = set().union(*split).difference(self.known) if split else set()
        if new:
            self.learn(sorted(new))
        return split

    def sized(self, texts: list[str | None]) -> list[tuple[list[str], list[int]]]:
        """The words of each text and their token counts, which hold whatever is forgotten later."""
        return [(ws, [len(b) // 4 for b in map(self.known.__getitem__, ws)]) for ws in self.words(texts)]

    def ids(self, texts: list[str | None]) -> pa.ListArray:
        import numpy as np

        rows = [b"".join(map(self.known.__getitem__, ws)) for ws in self.words(texts)]
        offsets = np.zeros(len(rows) + 1, np.int32)
        np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    def counts(self, texts: list[str | None]) -> list[int]:
        return [sum(map(len, map(self.known.__getitem__, ws))) // 4 for ws in self.words(texts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of bounded text size, at least one row each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encoding(vocabulary: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for start, end in slices(batch.column(1).to_pylist()):
                part = batch.slice(start, end - start)
                yield pa.record_batch({"doc_id": part.column(0), "ids": enc.ids(part.column(1).to_pylist())})

    return run


def encode(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): one scan, no shuffle."""
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encoding(vocabulary), "doc_id long, ids array<int>")


def decode_bytes(ids: list[int], vocabulary: str = VOCABULARY) -> bytes:
    """The bytes a list of ids stands for, for round trips in tests and reports."""
    with open(vocabulary, encoding="utf-8") as fh:
        names = {i: t for t, i in json.load(fh)["model"]["vocab"].items()}
    value = {c: b for b, c in byte_names().items()}
    return bytes(value[c] for i in ids for c in names[i])
