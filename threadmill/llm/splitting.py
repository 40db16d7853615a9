"""Splitting oversized texts at natural boundaries, into balanced pieces.

The least number of pieces follows from the size; cut targets at equal distances
are each moved to the strongest boundary near them: blank line, line, sentence,
clause, word. If a piece breaks the limit, one more piece is tried. Each piece
after the first repeats whole words of the one before, up to the overlap.

Cases: null, empty and blank texts and texts within the limit have no pieces
here. A single word beyond an eighth of the limit is cut between characters, as
it has no boundary. A limit that not even single characters keep is an error. Pieces cover the text: without the repeated characters they
join to exactly the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.encode import VOCABULARY, Encoder, encoder, slices

LIMIT = 2048
OVERLAP = 128
STRENGTHS = ("none", "word", "clause", "sentence", "line", "paragraph")


def strengths(words: list[str]) -> list[int]:
    """The strength of the boundary before each word, as a position in STRENGTHS."""
    out = []
    lines, ended = 0, 0
    for w in words:
        blank = not w.strip()
        if lines >= 2 and not blank:
            out.append(5)
        elif lines and not blank:
            out.append(4)
        elif ended and (w[0].isspace() or ended == 4) and not blank:
            out.append(3 if ended >= 3 else 2)
        else:
            out.append(1 if w[0].isspace() else 0)
        if blank:
            lines += w.count("\n") + w.count("\r") - w.count("\r\n")
        else:
            last = w.rstrip("\"')]}»”’")[-1:] or w[-1]
            lines, ended = 0, 4 if last in "。！？" else 3 if last in ".?!…" else 2 if last in ",;:、，；：—–" else 0
    return out


def _units(words: list[str], sizes: list[int], most: int) -> tuple[list[str], list[int], list[bool]]:
    """Words with their token counts; words of more than ``most`` tokens are cut into runs of few bytes."""
    units, counts, hard = [], [], []
    for w, n in zip(words, sizes):
        if n <= most:
            units.append(w)
            counts.append(n)
            hard.append(False)
            continue
        run, size, first = "", 0, True
        for c in w:
            b = len(c.encode("utf-8", "surrogatepass"))
            if size and size + b > most:
                units.append(run)
                counts.append(size)
                hard.append(not first)
                run, size, first = "", 0, False
            run, size = run + c, size + b
        units.append(run)
        counts.append(size)
        hard.append(not first)
    return units, counts, hard


def _count(units: list[str], tokens: list[int], hard: list[int], a: int, b: int, enc: Encoder) -> int:
    """Tokens of the text of units a to b, standing alone.

    Words are found from left to right by what follows only, so a piece that
    begins with a word has the words of the whole text, but for the white space
    at its end, which is one word there. Pieces with parts of cut words are encoded anew.
    """
    if bisect_left(hard, a) != bisect_right(hard, b):
        return enc.counts(["".join(units[a:b])])[0]
    tail = b
    while tail > a and units[tail - 1].isspace():
        tail -= 1
    return tokens[tail] - tokens[a] + (enc.counts(["".join(units[tail:b])])[0] if tail < b else 0)


def split_text(text: str, enc: Encoder, limit: int = LIMIT, overlap: int = OVERLAP, sized: tuple[list[str], list[int]] | None = None) -> list[dict]:
    """Pieces of one text; [] if it holds no more than ``limit`` tokens. ``sized``: its words and their token counts, if they are known already."""
    words, sizes = sized or enc.sized([text])[0]
    if sum(sizes) <= limit:
        return []
    units, counts, hard = _units(words, sizes, max(1, limit // 8))
    strong = [0 if h else s for s, h in zip(strengths(units), hard)]
    parted = [i for i, h in enumerate(hard) if h]
    tokens = [0, *accumulate(counts)]
    chars = [0, *accumulate(map(len, units))]
    n = tokens[-1]
    pieces = max(2, -(-(n - overlap) // max(1, limit - overlap)))
    while True:
        cuts = _cuts(tokens, strong, pieces, limit)
        found = _pieces(text, units, strong, tokens, chars, parted, cuts, limit, overlap, enc)
        if found is not None:
            return found
        if pieces > len(units):
            # each unit is a piece of its own then; only a limit below the tokens of one character can get here
            raise ValueError(f"no pieces of at most {limit} tokens with an overlap of {overlap}")
        pieces += 1


def _cuts(tokens: list[int], strong: list[int], pieces: int, limit: int) -> list[int]:
    """Unit numbers to cut before: each target moved to the strongest, then nearest boundary within reach."""
    n, cuts, low = tokens[-1], [], 0
    reach = max(1, min(limit // 8, n // pieces // 4))
    for j in range(1, pieces):
        target = n * j / pieces
        a, b = bisect_left(tokens, target - reach), bisect_right(tokens, target + reach)
        near = [i for i in range(max(a, low + 1), min(b, len(strong)))] or [min(max(low + 1, bisect_left(tokens, target)), len(strong) - 1)]
        low = max(near, key=lambda i: (strong[i], -abs(tokens[i] - target), -i))
        cuts.append(low)
    return cuts


def _pieces(text: str, units: list[str], strong: list[int], tokens: list[int], chars: list[int], parted: list[int], cuts: list[int], limit: int, overlap: int, enc: Encoder) -> list[dict] | None:
    out = []
    bounds = [0, *cuts, len(units)]
    if any(a >= b for a, b in zip(bounds, bounds[1:])):
        return None
    for j, (a, b) in enumerate(zip(bounds, bounds[1:])):
        room = min(overlap, limit - (tokens[b] - tokens[a]))
        if room < 0:
            return None
        start = a
        if j and room:
            low = max(bisect_left(tokens, tokens[a] - room), bounds[j - 1])
            inside = [i for i in range(low, a) if strong[i] >= 3]
            start = inside[0] if inside else next((i for i in range(low, a) if strong[i] >= 1), low)
        while True:
            count = _count(units, tokens, parted, start, b, enc)
            shared = _count(units, tokens, parted, start, a, enc) if start < a else 0
            if count <= limit and shared <= overlap:
                break
            if start >= a:
                return None
            start += 1
        out.append({"piece_no": j, "start_char": chars[start], "new_from": chars[a], "end_char": chars[b], "n_tokens": count, "overlap_tokens": shared, "boundary": STRENGTHS[strong[a]] if a else "start", "piece": text[chars[start]:chars[b]]})
    return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("start_char", pa.int64()), ("new_from", pa.int64()), ("end_char", pa.int64()), ("n_tokens", pa.int32()), ("overlap_tokens", pa.int32()), ("boundary", pa.string()), ("piece", pa.string())])
DDL = "doc_id long, piece_no int, start_char long, new_from long, end_char long, n_tokens int, overlap_tokens int, boundary string, piece string"


def _splitting(vocabulary: str, limit: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in slices(texts):
                part = texts[start:end]
                out = [{"doc_id": i, **p} for i, t, sized in zip(ids[start:end], part, enc.sized(part)) for p in split_text(t, enc, limit, overlap, sized)]
                yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return run


def split(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of every text of more than ``limit`` tokens. One scan, no shuffle.

    A token covers at least one byte, so texts of at most ``limit`` bytes need no encoding.
    """
    large = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.octet_length("text") > limit)
    return large.mapInArrow(_splitting(vocabulary, limit, overlap), DDL)
