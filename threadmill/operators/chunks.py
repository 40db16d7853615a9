"""Voice blocks and their greedy packing into reading chunks."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.operators.shortlist import review_state
from threadmill.session import stored


def tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def head() -> Column:
    """The head line of a block, of columns file, title, conv_date, user_words, user_turns and days_touched."""
    return F.format_string("\n\n## [[%s]] - %s\n*%s · %dw · %d turns · %d days*\n", F.regexp_replace("file", r"\.md$", ""), F.coalesce("title", F.lit("Untitled")), "conv_date", "user_words", "user_turns", "days_touched")


SEPARATOR = "\n---\n"


def block_sizes(rows: DataFrame) -> DataFrame:
    """rows with ``chars`` and ``tokens`` of their blocks, without building the text. rows: those of ``blocks``, and said_chars."""
    chars = F.length(head()) + F.col("said_chars") + len(SEPARATOR) * (F.col("user_turns") - 1)
    return rows.where("user_turns > 0").withColumn("chars", chars).withColumn("tokens", F.floor(F.col("chars") / 4))


def blocks(rows: DataFrame, turns: DataFrame, floor: int = 50) -> DataFrame:
    """(conv_no, file, conv_date, user_words, text) of rows with at least ``floor`` user words: a head line, then the user turns.

    rows: conv_no, file, title, conv_date, user_words, user_turns, days_touched.
    For the files that people read: a block is one text, as it is never cut.
    """
    said = turns.where("role = 'user'").groupBy("conv_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), SEPARATOR).alias("said"))
    return rows.where(F.col("user_words") >= floor).join(said, "conv_no").select("conv_no", "file", "conv_date", "user_words", F.concat(head(), "said").alias("text"))


def unreviewed(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows that were never reviewed or have gone on since; only these are packed for reading. ledger: (rec_key, seen_turns)."""
    return review_state(rows, ledger).where("review_state is null or review_state <> 'reviewed'")


def _starts(sizes: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a chunk that begins at each place: where the next begins, how many begin from there on, and what the last holds."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    n = len(sizes)
    after = np.maximum(np.searchsorted(total, total[:-1] + budget, side="right") - 1, np.arange(n) + 1)
    count, carry = np.ones(n, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        if after[i] >= n:
            carry[i] = total[n] - total[i]
        else:
            count[i], carry[i] = 1 + count[after[i]], carry[after[i]]
    return after, count, carry


def _thinned(rows: list[tuple]) -> list[tuple]:
    """A step function without the steps that change nothing. rows: (more_than, count, carry), ascending; the step below decides up to the next."""
    out: list[tuple] = []
    for r in rows:
        if not out or out[-1][1:] != r[1:]:
            out.append(r)
    return out


def _after(steps: list[tuple], total: int, open_: float) -> tuple[int, float]:
    """(chunks begun, tokens in the open chunk) after a range, if ``open_`` tokens were in the open chunk before it."""
    at = bisect_left(steps, (open_,)) - 1
    return (0, open_ + total) if at < 0 else (steps[at][1], steps[at][2])


def _composed(a: tuple[list, int], b: tuple[list, int]) -> tuple[list, int]:
    """The steps and the total of two ranges after one another."""
    (first, held), (second, more) = a, b
    low = first[0][0] if first else float("inf")
    shifted = [(m - held, n, c) for m, n, c in second if m - held < low]
    return _thinned([*shifted, *((m, n + k, c2) for m, n, c in first for k, c2 in [_after(second, more, c)])]), held + more


def pack(items: DataFrame, budget: int, order: tuple[str, ...] = ("conv_date", "file")) -> DataFrame:
    """items with ``chunk``, from 1: items in order, a new chunk where the next one would break the budget; items are never cut.

    Packing is a fold over the whole order, yet a range of it depends on what
    went before only through the tokens in the open chunk: its result is a step
    function of them, and most steps fall together, as packings that begin at
    different items soon meet. Ranges work out their functions, tasks compose
    those of GROUP neighbours, and again, until GROUP or fewer are left for the
    driver; what goes into each range then comes down the same tree. The driver
    holds at most GROUP functions and one number for a range.
    """
    spark = items.sparkSession
    ranged = stored(items.select(*order, F.col("tokens").cast("long")).repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long")))

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        sizes = pdf["tokens"].to_numpy()
        sums = np.cumsum(sizes)
        _, count, carry = _starts(sizes, budget)
        # the first cut falls before item i if what is open and the items up to i exceed the budget; of equal sums the first decides
        keep = np.flatnonzero(np.concatenate([[True], np.diff(sums) > 0]) & (sums - sizes <= budget))
        return _rows(int(pdf["part"].iloc[0]), _thinned(sorted((int(budget - sums[i]), int(count[i]), int(carry[i])) for i in keep)), int(sums[-1]))

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, f in _functions(pdf):
            whole = f if whole is None else _composed(whole, f)
        return _rows(int(pdf["part"].iloc[0]) // GROUP, *whole)

    levels = [stored(ranged.groupBy("part").applyInPandas(steps, STEPS))]
    parts = ranged.select("part").distinct().count()
    while parts > GROUP:
        levels.append(stored(levels[-1].groupBy(F.floor(F.col("part") / GROUP)).applyInPandas(compose, STEPS)))
        parts = -(-parts // GROUP)
    open_, number, entries = float("inf"), 0, []
    for part, f in _functions(levels[-1].toPandas()):
        entries.append((part, open_, number))
        began, open_ = _after(*f, open_)
        number += began
    into = spark.createDataFrame(entries, ENTRIES)

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        held, at, out = float(pdf["open"].iloc[0]), int(pdf["number"].iloc[0]), []
        for part, f in _functions(pdf):
            out.append((part, held, at))
            began, held = _after(*f, held)
            at += began
        return pd.DataFrame(out, columns=["part", "open", "number"])

    for level in levels[-2::-1]:
        up = into.select(F.col("part").alias("group"), "open", "number")
        into = level.withColumn("group", F.floor(F.col("part") / GROUP)).join(up, "group").groupBy("group").applyInPandas(enter, ENTRIES)

    def number_items(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable").reset_index(drop=True)
        sizes, held, chunk = pdf["tokens"].to_numpy(), float(pdf["open"].iloc[0]), int(pdf["number"].iloc[0])
        after, _, _ = _starts(sizes, budget)
        out = np.empty(len(pdf), np.int64)
        over = held + np.cumsum(sizes) > budget
        i = int(np.argmax(over)) if over.any() else len(pdf)
        out[:i] = chunk
        while i < len(pdf):
            chunk += 1
            out[i:after[i]] = chunk
            i = int(after[i])
        return pdf.assign(chunk=out)[[*order, "chunk"]]

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.select(*order).schema)
    numbered = ranged.join(into, "part").groupBy("part").applyInPandas(number_items, f"{fields}, chunk long")
    return items.join(numbered, list(order))


#: Ranges whose step functions one task composes.
GROUP = 64
STEPS = "part long, more_than double, count long, carry double, total long"
ENTRIES = "part long, open double, number long"


def _rows(part: int, steps: list[tuple], total: int) -> pd.DataFrame:
    return pd.DataFrame([(part, float(m), n, float(c), total) for m, n, c in steps], columns=["part", "more_than", "count", "carry", "total"])


def _functions(pdf: pd.DataFrame) -> list[tuple[int, tuple[list, int]]]:
    """(part, (steps, total)) of each part, in order."""
    pdf = pdf.sort_values(["part", "more_than"])
    return [(int(p), (list(zip(g["more_than"], g["count"], g["carry"])), int(g["total"].iloc[0]))) for p, g in pdf.groupby("part")]


def manifest(packed: DataFrame, budget: int) -> DataFrame:
    """One row per chunk; its tokens are those of all its characters together, so rounding may flag one whose parts fit. packed: conv_date, chars, chunk."""
    by = packed.groupBy("chunk").agg(F.min("conv_date").alias("from_date"), F.max("conv_date").alias("to_date"), F.count("*").alias("conversations"), F.floor(F.sum("chars") / 4).alias("tokens"))
    return by.withColumn("oversized", F.col("tokens") > budget)
