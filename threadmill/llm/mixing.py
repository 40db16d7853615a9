"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The token weights of the
cells are raked to three marginals: the target weights of the sources, and the
shares that languages and topics have in the corpus. No cell can weigh more than
its documents taken max_repeats times. The fitted weight of a cell over its
tokens is the expected number of copies of each of its documents; documents are
drawn with that calibrated probability by a hash of their key, so a retry draws
the same ones. Sources come last in every round, so their shares are met exactly
where their texts suffice; a source whose fitted weight stays below its target
is short.

One table of cells, from one encoding of the corpus, serves both questions that
are asked: what all documents hold (a source is short by these), and what may be
drawn. A repeated text is drawn only as its first document among those of the
targets, also where several sources hold it, so no text is taken more than
max_repeats times.

Only the cell totals reach the driver: sources of the targets and one for all
others, two-letter languages and one for all others, and the topics of the model,
so at most (targets + 1) * 677 * (topics + 1) rows however large the corpus.

Cases: a document belongs to the source its label names, any case, outer spaces
ignored; null, empty and unknown labels belong to no target but count in the
total. Null and empty texts hold no tokens and are never drawn. Targets that
repeat a source add up their weights and keep the largest max_repeats. With no
documents nothing is short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.encode import VOCABULARY, encoder, slices
from threadmill.llm.topics import TopicModel, fit_topics
from threadmill.session import spread, stored

#: Rounds of raking after which it is reported as not converged.
ROUNDS = 2000
#: Weights that change by less than this share in a round have converged; a source is short by more than this share of its target.
EXACT = 1e-9


def label(source: str | Column) -> Column:
    return F.lower(F.trim(F.col(source) if isinstance(source, str) else source))


def language(lang: str) -> Column:
    tidy = F.lower(F.trim(lang))
    return F.when(tidy.rlike(r"\A[a-z][a-z]\z"), tidy).otherwise("other")


def _measuring(vocabulary: str, at: int, model: TopicModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces column ``at``, the text, by topic and n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for start, end in slices(batch.column(at).to_pylist()):
                part = batch.slice(start, end - start)
                words = enc.words(part.column(at).to_pylist())
                known = enc.known
                columns = {n: part.column(n) for i, n in enumerate(batch.schema.names) if i != at}
                columns["topic"] = pa.array(model.topics(words, part.column("lang").to_pylist()), pa.string())
                columns["n_tokens"] = pa.array([sum(map(len, map(known.__getitem__, w))) // 4 for w in words], pa.int64())
                yield pa.record_batch(columns)

    return run


def targets_table(targets: DataFrame) -> DataFrame:
    """(source, weight, max_repeats), one row a source; bounded by the mixing plan, not by the corpus."""
    return targets.select(label("source").alias("source"), F.coalesce("target_weight", F.lit(0.0)).alias("weight"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).where("source is not null").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))


def measured(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, lang, topic, text_key, n_tokens) of every document."""
    model = fit_topics(documents, language("lang"))
    slim = documents.select(F.col("doc_id").cast("long"), label("source").alias("source"), language("lang").alias("lang"), F.md5("text").alias("text_key"), "text")
    return spread(slim).mapInArrow(_measuring(vocabulary, 4, model), "doc_id long, source string, lang string, text_key string, topic string, n_tokens long")


def by_text(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, text_key, lang, topic, d, listed): each text's first document and all its tokens by target and cell; target is null for what no target names."""
    named = sizes.where("n_tokens > 0").join(F.broadcast(targets.select(F.col("source").alias("target"))), F.col("source") == F.col("target"), "left")
    return named.groupBy("target", "text_key", "lang", "topic").agg(F.min(F.struct("doc_id", "source", "lang", "topic", "n_tokens")).alias("d"), F.sum("n_tokens").alias("listed"))


@dataclass
class Fitted:
    """Raked cells: weights and capacities by cell, the rounds it took, and goal and fit of every margin."""

    cells: list[tuple]
    tokens: np.ndarray
    weights: np.ndarray
    rounds: int
    converged: bool
    margins: list[dict]

    def of(self, source: str) -> float:
        """The fitted tokens of a source."""
        return float(sum(w for c, w in zip(self.cells, self.weights) if c[0] == source))


def fit(rows: list[dict], targets: list[dict], total: float) -> Fitted:
    """Rake cells (source, lang, topic, tokens) of target sources to the margins, within their capacities. total: the tokens of the whole corpus."""
    plan = {t["source"]: t for t in targets}
    own = [r for r in rows if r["source"] in plan and r["tokens"] > 0]
    cells = [(r["source"], r["lang"], r["topic"]) for r in own]
    tokens = np.array([r["tokens"] for r in own], float)
    cap = np.array([plan[r["source"]]["max_repeats"] for r in own], float) * tokens
    weights = np.minimum(tokens, cap)
    margins = []
    for i, name in enumerate(("lang", "topic", "source")):
        keys = sorted({r[name] for r in own})
        at = {k: j for j, k in enumerate(keys)}
        member = np.array([at[r[name]] for r in own], int)
        share = np.bincount(member, tokens, len(keys)) / tokens.sum() if own else np.zeros(0)
        goal = np.array([plan[k]["weight"] * total for k in keys]) if name == "source" else share
        margins.append((name, keys, member, goal))
    rounds, converged = 0, not own
    while own and not converged and rounds < ROUNDS:
        before, rounds = weights, rounds + 1
        for name, keys, member, goal in margins:
            weights = _scaled(weights, cap, member, goal if name == "source" else goal * weights.sum())
        converged = np.allclose(before, weights, rtol=EXACT)
    found = []
    for name, keys, member, goal in margins:
        now = np.bincount(member, weights, len(keys)) if own else np.zeros(0)
        want = goal if name == "source" else goal * weights.sum()
        found += [{"margin": name, "key": k, "goal_tokens": float(g), "fitted_tokens": float(w)} for k, g, w in zip(keys, want, now)]
    return Fitted(cells, tokens, weights, rounds, converged, found)


def _scaled(weights: np.ndarray, cap: np.ndarray, member: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Weights scaled to what each group wants, as far as capacities let: what full cells cannot take goes to the others of their group."""
    most = np.minimum(want, np.bincount(member, cap, len(want)))
    free = np.ones(len(weights), bool)
    for _ in range(len(weights) + 1):
        fixed = np.bincount(member, np.where(free, 0.0, cap), len(want))
        moving = np.bincount(member, np.where(free, weights, 0.0), len(want))
        scale = np.divide(np.maximum(most - fixed, 0.0), moving, out=np.zeros(len(want)), where=moving > 0)
        new = np.where(free, weights * scale[member], cap)
        over = free & (new >= cap)
        if not over.any():
            return new
        free &= ~over
    return np.where(free, weights, cap)


CELL_DDL = "source string, lang string, topic string, copies double"
REPORT_DDL = "source string, target_weight double, max_repeats int, target_tokens double, listed_tokens long, listed_capacity long, listed_fitted double, short boolean, tokens long, capacity long, planned_tokens double"
MARGIN_DDL = "margin string, key string, goal_tokens double, fitted_tokens double, residual double, rounds int, converged boolean"


@dataclass
class Plan:
    """The mix: texts that may be drawn, and the two fits of the one table of cells."""

    drawable: DataFrame
    targets: list[dict]
    total: float
    listed: Fitted
    drawn: Fitted

    def report(self) -> list[dict]:
        """A row a target. It is short if even all its documents, fitted, stay below its share of all tokens."""
        out = []
        held = lambda f, s: int(round(sum(n for c, n in zip(f.cells, f.tokens) if c[0] == s)))
        for t in sorted(self.targets, key=lambda t: t["source"]):
            s, goal = t["source"], t["weight"] * self.total
            row = {"source": s, "target_weight": float(t["weight"]), "max_repeats": int(t["max_repeats"]), "target_tokens": goal}
            row |= {"listed_tokens": held(self.listed, s), "listed_capacity": held(self.listed, s) * t["max_repeats"], "listed_fitted": self.listed.of(s), "short": self.listed.of(s) < goal * (1 - EXACT)}
            out.append(row | {"tokens": held(self.drawn, s), "capacity": held(self.drawn, s) * t["max_repeats"], "planned_tokens": self.drawn.of(s)})
        return out


def planned(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = VOCABULARY) -> Plan:
    """Measures the corpus once, into a table of texts by cell, and fits its totals.

    Hot texts are pre-aggregated by key before they are shuffled; ties go to the smallest doc_id.
    """
    targets = targets_table(mix_targets)
    plan = [r.asDict() for r in targets.collect()]
    texts = stored(by_text(measured(documents, vocabulary), targets))
    listed = [{"source": r["target"], "lang": r["lang"], "topic": r["topic"], "tokens": r["n"]} for r in texts.groupBy("target", "lang", "topic").agg(F.sum("listed").alias("n")).collect()]
    first = texts.where("target is not null").groupBy("text_key").agg(F.min("d").alias("d")).select("d.*").withColumn("source", label("source"))
    rows = [r.asDict() for r in first.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).collect()]
    total = float(sum(r["tokens"] for r in listed))
    return Plan(first, plan, total, fit(listed, plan, total), fit(rows, plan, total))


def plan(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with expected copies, report by source, margins) of the mix that ``mix`` draws.

    tokens, capacity and planned_tokens are of the texts that may be drawn;
    listed_tokens, listed_capacity and listed_fitted, by which a source is short,
    of all documents. margins compare goal and fit of each source, language and topic.
    """
    spark = documents.sparkSession
    p = planned(documents, mix_targets, vocabulary)
    margins = [m | {"residual": (m["fitted_tokens"] - m["goal_tokens"]) / m["goal_tokens"] if m["goal_tokens"] else 0.0, "rounds": p.drawn.rounds, "converged": bool(p.drawn.converged)} for m in p.drawn.margins]
    return spark.createDataFrame(_copies(p.drawn), CELL_DDL), spark.createDataFrame(p.report(), REPORT_DDL), spark.createDataFrame(margins, MARGIN_DDL)


def _copies(f: Fitted) -> list[dict]:
    return [{"source": c[0], "lang": c[1], "topic": c[2], "copies": float(w / n)} for c, w, n in zip(f.cells, f.weights, f.tokens)]


def mix(documents: DataFrame, mix_targets: DataFrame, vocabulary: str = VOCABULARY, seed: int = 17) -> DataFrame:
    """(doc_id, source, n_tokens, copies): the documents of the mix and how often each is taken."""
    p = planned(documents, mix_targets, vocabulary)
    odds = F.broadcast(documents.sparkSession.createDataFrame(_copies(p.drawn), CELL_DDL))
    draw = (F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    drawn = p.drawable.join(odds, ["source", "lang", "topic"]).withColumn("taken", (F.floor("copies") + (draw < F.col("copies") - F.floor("copies")).cast("int")).cast("int"))
    return drawn.where("taken > 0").select("doc_id", "source", "n_tokens", F.col("taken").alias("copies"))


def shares(mixed: DataFrame, mix_targets: DataFrame | None = None) -> DataFrame:
    """The actual share of each source in a mix; with ``mix_targets`` also of the targets of which nothing is drawn."""
    by = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"))
    if mix_targets is not None:
        zero = F.lit(0).cast("long")
        by = targets_table(mix_targets).select("source").join(by, "source", "left").select("source", *[F.coalesce(c, zero).alias(c) for c in ("documents", "copies", "tokens")])
    # one row a source of the targets: a window over all of them is bounded
    return by.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy()), F.lit(0)), F.lit(0.0)))
