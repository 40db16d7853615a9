"""Long exact spans shared between records, by sliding runs of sentences.

A text is cut into sentences; stretches without a sentence end are cut further
at places their own characters choose, so no unit is long and equal text is cut
equally wherever it stands. Every run of RUN consecutive units is hashed, and
runs that occur in more than one text are found by one global aggregation. Any
span of LEAST characters holds at least one such run, so texts without a
repeated run need no further look.

Around repeated runs longer windows are hashed: first windows of LEAST - GRID
characters on a coarse grid, then, where those repeat too, every window of LEAST
characters. A hot phrase that is short stays one row per text in the first step
and falls away in the second. Two texts share a span exactly if they share a
window of LEAST characters (compared by 128 bits).

Cases: null, empty and short texts share nothing. Equal texts form one class and
are compared once; a message shares nothing with itself. Repeated rows of one
message count once. Whole texts are read, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.functions.text import part_text_column
from threadmill.session import cut, stored

LEAST = 240
#: Consecutive units in a run, and the longest stretch without a cut. Any span of LEAST characters then holds a whole run:
#: cuts are settled CONTEXT characters inside the span, the first and last within one stretch of there, and what lies
#: between them, LEAST - 2 * (CONTEXT + STRETCH) = 104 characters, has at least RUN units of at most STRETCH.
RUN = 2
STRETCH = 60
CONTEXT = 8
GRID = 48
SLICE = 1_000_000
_ENDS = np.array([ord(c) for c in ".?!…。！？\n\r"], np.uint32)
_WIDE_ENDS = np.array([ord(c) for c in "。！？\n"], np.uint32)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


class Texts:
    """Several texts as one array of code points, with prefix hashes for windows of any size."""

    def __init__(self, texts: list[str]):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1]
        raw = "\x00".join(texts) + "\x00"
        self.codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.owner = np.repeat(np.arange(len(texts)), self.lengths + 1)
        self._prefix: dict[int, tuple] = {}

    def _tables(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in self._prefix:
            base, n = _BASES[which], len(self.codes)
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            powers = np.full(n + 1, base, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            back = np.full(n + 1, inverse, np.uint64)
            back[0] = 1
            prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * powers[:n], out=prefix[1:])
            self._prefix[which] = (prefix, np.cumprod(back, dtype=np.uint64))
        return self._prefix[which]

    def hashes(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of windows, the same for the same characters wherever they stand."""
        prefix, back = self._tables(which)
        h = (prefix[end] - prefix[start]) * back[start]
        h ^= (end - start).astype(np.uint64) << np.uint64(48)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    def cuts(self) -> np.ndarray:
        """Positions before which a unit begins: after sentence ends, and in every stretch of STRETCH places at its least hash."""
        c, n = self.codes, len(self.codes)
        if n <= STRETCH + CONTEXT:
            return np.zeros(0, np.int64)
        ended = np.zeros(n, bool)
        space = (c == 32) | (c == 10) | (c == 13) | (c == 9)
        ended[2:] = (space[1:-1] & np.isin(c[:-2], _ENDS) & ~space[2:]) | (np.isin(c[1:-1], _WIDE_ENDS) & ~space[2:])
        h = np.zeros(n, np.uint32)
        for j in range(CONTEXT):
            shift = j - CONTEXT // 2
            lo, hi = max(0, -shift), min(n, n - shift)
            h[lo:hi] += (c[lo + shift:hi + shift] + np.uint32(1)) * np.uint32(0x85EBCA6B * (2 * j + 1) ** 3 & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        h[ended] = 0
        # of equal hashes the rightmost
        key = (h.astype(np.uint64) << np.uint64(32)) | (np.uint64(n) - np.arange(n, dtype=np.uint64))
        size = 1
        while size * 2 <= STRETCH:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < STRETCH:
            key = np.minimum(key[:-(STRETCH - size)], key[STRETCH - size:])
        chosen = ended
        chosen[n - (key & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
        return np.flatnonzero(chosen)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash) of every run of RUN units that lies in one text."""
        at = self.cuts()
        if len(at) <= RUN:
            none = np.zeros(0, np.int64)
            return none, none, none
        start, end = at[:-RUN], at[RUN:]
        one = self.owner[start] == self.owner[end]
        start, end = start[one], end[one]
        return start, end, self.hashes(start, end)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for a, b in _slices(texts):
            t = Texts(texts[a:b])
            start, _, h = t.runs()
            # a run that stands in one text several times counts once
            owner, h = np.unique(np.stack([t.owner[start], h]), axis=1)
            yield pa.record_batch({"run": pa.array(h), "tid": pa.array(tids[a:b][owner])})


def _grid_windows(t: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Starts of windows of LEAST - GRID characters that hold these runs, on a grid relative to the run."""
    low = t.starts[t.owner[start]]
    high = low + t.lengths[t.owner[start]]
    found = []
    for back in range(0, LEAST, GRID):
        w = start - back
        found.append(w[(w >= low) & (w + LEAST - GRID <= high) & (back <= LEAST - (end - start))])
    return np.unique(np.concatenate(found)) if found else start


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Texts with the hashes that repeat in them, in slices: (tid, t2, Texts, marks of each text)."""
    for batch in batches:
        tids, t2s, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
        marks = batch.column(3)
        offsets, values = marks.offsets.to_numpy(), marks.values.to_numpy()
        for a, b in _slices(texts):
            t = Texts(texts[a:b])
            own = np.unique(np.stack([np.repeat(np.arange(b - a), np.diff(offsets[a:b + 1])), values[offsets[a]:offsets[b]]]), axis=1)
            yield tids[a:b], t2s[a:b], t, own


def _is_marked(t: Texts, start: np.ndarray, h: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether hash h at start is among the marks of its own text."""
    a = np.stack([t.owner[start], h]).T.copy().view([("o", np.int64), ("h", np.int64)]).ravel()
    b = own.T.astype(np.int64).copy().view([("o", np.int64), ("h", np.int64)]).ravel()
    return np.isin(a, b)


def _grids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tids, t2s, t, own in _within(batches):
        start, end, h = t.runs()
        keep = _is_marked(t, start, h, own)
        w = _grid_windows(t, start[keep], end[keep])
        owner = t.owner[w]
        yield pa.record_batch({"window": pa.array(t.hashes(w, w + LEAST - GRID)), "tid": pa.array(tids[owner]), "t2": pa.array(t2s[owner])})


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tids, t2s, t, own in _within(batches):
        start, end, _ = t.runs()
        w = _grid_windows(t, start, end)
        w = w[_is_marked(t, w, t.hashes(w, w + LEAST - GRID), own)]
        s = np.unique((w[:, None] - np.arange(GRID + 1)[None, :]).ravel())
        s = s[s >= 0]
        owner = t.owner[s]
        s = s[(s + LEAST <= t.starts[owner] + t.lengths[owner])]
        owner = t.owner[s]
        yield pa.record_batch({"g1": pa.array(t.hashes(s, s + LEAST)), "g2": pa.array(t.hashes(s, s + LEAST, 1)), "tid": pa.array(tids[owner]), "t2": pa.array(t2s[owner]), "at": pa.array((s - t.starts[owner]).astype(np.int32))})


class Shared:
    """The steps of the search, each a DataFrame."""

    def __init__(self, messages: DataFrame):
        self.messages = messages
        # texts come out of a generator, so that the condition on them isn't pushed below, where parts would be parsed a second time
        text = messages.select(F.col("msg_id").cast("long"), F.explode_outer(F.transform("parts", part_text_column)).alias("text")).where(F.length("text") >= LEAST)
        # parts are read and parsed once; everything below reads this table, most of it only its numbers
        self.parts = stored(text.select("msg_id", F.xxhash64("text").alias("tid"), F.xxhash64(F.lit("2"), "text").alias("t2"), "text"))
        self.members = self.parts.select("msg_id", "tid", "t2").distinct()

    def _texts(self, marks: DataFrame) -> DataFrame:
        """(tid, t2, text, marks) of one text of each marked class: its first message's."""
        first = self.members.groupBy("tid", "t2").agg(F.min("msg_id").alias("msg_id")).join(marks, "tid")
        return self.parts.join(first, ["msg_id", "tid", "t2"]).dropDuplicates(["tid", "t2"]).select("tid", "t2", "text", "marks")

    def repeated_runs(self) -> DataFrame:
        """(run, tid) of runs that stand in more than one text."""
        runs = stored(self.parts.select("tid", "text").mapInArrow(_runs, "run long, tid long"))
        often = runs.groupBy("run").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select("run")
        return runs.join(often, "run", "left_semi")

    def windows(self) -> DataFrame:
        """(g1, g2, tid, t2, at): every window of LEAST characters around repeated grid windows."""
        marks = self.repeated_runs().groupBy("tid").agg(F.collect_set("run").alias("marks"))
        grids = stored(self._texts(marks).mapInArrow(_grids, "window long, tid long, t2 long").distinct())
        often = grids.groupBy("window").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select("window")
        marks = grids.join(often, "window", "left_semi").groupBy("tid").agg(F.collect_set("window").alias("marks"))
        return self._texts(marks).mapInArrow(_spans, "g1 long, g2 long, tid long, t2 long, at int")

    def shared_windows(self) -> DataFrame:
        """(g1, g2, tid, t2, at): the windows that stand in more than one text."""
        windows = stored(self.windows())
        often = windows.groupBy("g1", "g2").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select("g1", "g2")
        return windows.join(often, ["g1", "g2"], "left_semi")

    def classes(self) -> DataFrame:
        """(tid_a, t2_a, tid_b, t2_b): pairs of different texts that share a span, once each. ``members`` says which messages hold a text.

        This is the form for libraries: copies of a text are not expanded into pairs.
        Windows that stand in the very same set of texts give the same pairs, so
        one of them stands for all; neighbouring windows of one passage nearly
        always do. What is joined then is close to what comes out.
        """
        shared = self.shared_windows().select("g1", "g2", "tid", "t2").distinct()
        sets = shared.groupBy("g1", "g2").agg(F.count("*").alias("n"), F.sum(F.xxhash64("tid", "t2") % F.lit(1 << 40)).alias("s"), F.bit_xor(F.xxhash64("t2", "tid")).alias("x"))
        chosen = sets.groupBy("n", "s", "x").agg(F.min(F.struct("g1", "g2")).alias("g")).select("g.g1", "g.g2")
        groups = cut(shared.join(chosen, ["g1", "g2"], "left_semi"))
        a = groups.select("g1", "g2", F.col("tid").alias("tid_a"), F.col("t2").alias("t2_a"))
        b = groups.select("g1", "g2", F.col("tid").alias("tid_b"), F.col("t2").alias("t2_b"))
        ordered = (F.col("tid_a") < F.col("tid_b")) | ((F.col("tid_a") == F.col("tid_b")) & (F.col("t2_a") < F.col("t2_b")))
        return a.join(b, ["g1", "g2"]).where(ordered).select("tid_a", "t2_a", "tid_b", "t2_b").distinct()

    def pairs(self) -> DataFrame:
        """(msg_a, msg_b) of different messages that share a span, all of them, copies too, as the result's form asks for it."""
        classes = self.classes()
        ma = self.members.select(F.col("msg_id").alias("x"), F.col("tid").alias("tid_a"), F.col("t2").alias("t2_a"))
        mb = self.members.select(F.col("msg_id").alias("y"), F.col("tid").alias("tid_b"), F.col("t2").alias("t2_b"))
        across = classes.join(ma, ["tid_a", "t2_a"]).join(mb, ["tid_b", "t2_b"]).select("x", "y")
        copies = self.members.groupBy("tid", "t2").agg(F.count("*").alias("n")).where("n > 1").select("tid", "t2")
        same = self.members.join(copies, ["tid", "t2"], "left_semi")
        equal = same.select(F.col("msg_id").alias("x"), "tid", "t2").join(same.select(F.col("msg_id").alias("y"), "tid", "t2"), ["tid", "t2"]).where("x < y").select("x", "y")
        return across.unionByName(equal).where("x <> y").select(F.least("x", "y").alias("msg_a"), F.greatest("x", "y").alias("msg_b")).distinct()

    def windows_elsewhere(self) -> DataFrame:
        """(g1, g2, tid, t2, at): the shared windows that two different messages hold, not only two parts of one."""
        windows = stored(self.windows())
        holders = self.members.groupBy("tid", "t2").agg(F.min("msg_id").alias("low"), F.max("msg_id").alias("high"))
        often = windows.join(holders, ["tid", "t2"]).groupBy("g1", "g2").agg(F.min("tid").alias("a"), F.max("tid").alias("b"), F.min("low").alias("low"), F.max("high").alias("high")).where("a <> b and low <> high").select("g1", "g2")
        return windows.join(often, ["g1", "g2"], "left_semi")

    def shares(self) -> DataFrame:
        """(msg_id, chars, shared_chars, share) of every message; chars are those of all its parts, however short.

        A part that other messages hold whole is shared whole; of other parts the
        union of the windows that other messages hold counts. A message without
        text has share 0. A part that is delivered again as it was counts once.
        """
        place = Window.partitionBy("tid", "t2").orderBy("at")
        at = self.windows_elsewhere().select("tid", "t2", "at").distinct()
        covered = at.withColumn("next", F.lead("at").over(place)).groupBy("tid", "t2").agg(F.sum(F.least(F.lit(LEAST), F.coalesce(F.col("next") - F.col("at"), F.lit(LEAST)))).alias("covered"))
        held = self.members.groupBy("tid", "t2").agg((F.count("*") > 1).alias("whole"))
        text = self.messages.select(F.col("msg_id").cast("long"), F.posexplode_outer("parts").alias("pos", "part")).select("msg_id", "pos", part_text_column(F.col("part")).alias("text"))
        parts = text.select("msg_id", "pos", F.xxhash64("text").alias("tid"), F.xxhash64(F.lit("2"), "text").alias("t2"), F.length("text").cast("long").alias("chars")).distinct()
        shared = F.when(F.col("whole"), F.col("chars")).otherwise(F.coalesce("covered", F.lit(0)))
        long = parts.where(F.col("chars") >= LEAST).join(held, ["tid", "t2"]).join(covered, ["tid", "t2"], "left").groupBy("msg_id").agg(F.sum(shared).cast("long").alias("shared_chars"))
        by = parts.groupBy("msg_id").agg(F.sum("chars").alias("chars")).join(long, "msg_id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0).cast("long")))
        return by.withColumn("share", F.when(F.col("chars") > 0, F.col("shared_chars") / F.col("chars")).otherwise(0.0))

    def cleaned(self) -> DataFrame:
        """(msg_id, text, kept): the long parts with every passage removed that an earlier message (smaller msg_id) holds.

        The first holder of a passage keeps it. What is removed are whole units
        inside the covered stretch, so sentences that reach beyond it stay.
        """
        first = self.members.groupBy("tid", "t2").agg(F.min("msg_id").alias("first"))
        windows = self.shared_windows().join(first, ["tid", "t2"])
        owner = windows.groupBy("g1", "g2").agg(F.min("first").alias("owner"))
        later = windows.join(owner, ["g1", "g2"]).where("first > owner").groupBy("tid", "t2").agg(F.collect_set("at").alias("marks"))
        rows = self.parts.distinct().join(first, ["tid", "t2"]).join(later, ["tid", "t2"], "left")
        slim = rows.select("msg_id", "text", F.when(F.col("msg_id") > F.col("first"), F.array(F.lit(-1))).otherwise(F.coalesce("marks", F.array().cast("array<int>"))).alias("marks"))
        return slim.mapInArrow(_clean, "msg_id long, text string, kept string")


def keep_units(text: str, marks: list[int]) -> str:
    """The text without the units that lie inside the windows at ``marks``; -1 marks it whole."""
    if -1 in marks:
        return ""
    if not marks:
        return text
    inside = np.zeros(len(text) + 1, np.int32)
    np.add.at(inside, np.asarray(marks), 1)
    np.add.at(inside, np.asarray(marks) + LEAST, -1)
    covered = np.cumsum(inside)[:len(text)] > 0
    bounds = [0, *Texts([text]).cuts().tolist(), len(text)]
    return "".join(text[a:b] for a, b in zip(bounds, bounds[1:]) if a < b and not covered[a:b].all())


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        kept = [keep_units(t, m) for t, m in zip(texts, batch.column(2).to_pylist())]
        yield pa.record_batch({"msg_id": batch.column(0), "text": batch.column(1), "kept": pa.array(kept, pa.string())})
