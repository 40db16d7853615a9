"""Topics of texts by a model that is fitted on the whole corpus.

No column names a topic, so topics are clusters of word use: spherical k-means
on the words of all texts. What a language shares as a whole is taken out first,
so clusters are not just the languages. The fitted model is a table of word
weights; every text of the corpus gets the topic whose weights its words fit best.

Texts are read once; every round is one pass over their word numbers, and only
sums by topic and word reach the driver. Sums are of whole numbers (multiples of
1 / UNIT), so no order of rows or tasks changes them: a retry finds the same topics.

Cases: a text counts once per doc_id, however often its row is repeated. Texts
without a word of the model take no part in the fit. A text whose words are just
what its language shares has no direction, so it moves no topic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bound of the model's words, the most frequent ones, and the number of topics. Parameters of the model; statistics of the corpus use all texts.
WORDS, TOPICS = 2000, 8
#: A word of the model is in at least this many and at most this share of the texts.
LEAST_TEXTS, MOST_SHARE = 5, 0.4
#: Rounds of clustering at most.
ROUNDS = 30
#: What is summed is rounded to multiples of 1 / UNIT. A text that differs by LEAST_LEAN or less (squared) from its language's
#: usual words has no direction. Both keep the sums of AT_ONCE texts below 2 ** 53, where doubles are exact.
UNIT, LEAST_LEAN, AT_ONCE = 1 << 27, 1e-9, 1024
#: Bytes of a block of texts, so that a batch of blocks stays small in a worker's memory.
BLOCK_BYTES = 8192


@dataclass
class TopicModel:
    """Word weights of the topics. A text without any word of the model is of topic 'other'."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    idf: dict[str, float] = field(default_factory=dict)
    #: How well the words that a language shares fit each topic anyway.
    usual: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        names = sorted(self.weights)
        # the forms in which words stand in texts, with the blank before them
        self.form = {f: i for i, w in enumerate(names) for f in (w, " " + w, w.capitalize(), " " + w.capitalize(), w.upper(), " " + w.upper())}
        self.table = np.stack([self.weights[w] for w in names]) if names else np.zeros((0, 1))
        self.squares = np.array([self.idf[w] ** 2 for w in names])

    def topics(self, texts: list[list[str]], langs: list[str]) -> list[str]:
        """The topic of each text, given as its words. Sums are over all texts at once."""
        forms = self.form.keys()
        found = [sorted({self.form[f] for f in forms & set(words)}) for words in texts]
        sizes = np.array([len(x) for x in found], np.int64)
        out = np.full(len(texts), -1)
        if sizes.any():
            some = np.flatnonzero(sizes)
            flat = np.fromiter((i for x in found for i in x), np.int64, int(sizes.sum()))
            at = np.concatenate([[0], np.cumsum(sizes[some])])[:-1]
            fit = np.add.reduceat(self.table[flat], at, axis=0) / np.sqrt(np.add.reduceat(self.squares[flat], at))[:, None]
            none = np.zeros(self.table.shape[1])
            fit -= np.stack([self.usual.get(langs[i], none) for i in some])
            out[some] = np.argmax(fit, axis=1)
        return ["other" if t < 0 else f"topic-{t}" for t in out]

    def topic(self, words: list[str], lang: str) -> str:
        return self.topics([words], [lang])[0]


def fit_topics(documents: DataFrame, lang: Column, words: int = WORDS, k: int = TOPICS) -> TopicModel:
    """The model of all texts of a corpus with doc_id, text and the language column.

    The driver gets the counts of at most ``words`` words (up to 65,536), sums by language and word, and in each round sums by topic and word.
    """
    if words > 1 << 16:
        raise ValueError(f"a model has at most 65,536 words, not {words}")
    from threadmill.session import stored

    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), 0))
    each = documents.where("text is not null").select("doc_id", F.md5("text").alias("text_key"), lang.alias("lang"), found.alias("words"))
    texts = stored(each.groupBy("doc_id", "text_key").agg(F.min("lang").alias("lang"), F.first("words").alias("words")).where("size(words) > 0").drop("text_key"))
    n = texts.count()
    often = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_TEXTS) & (F.col("n") <= max(LEAST_TEXTS, MOST_SHARE * n)))
    counts = {r["word"]: r["n"] for r in often.orderBy(F.desc("n"), "word").limit(words).collect()}
    if not counts:
        return TopicModel()
    idf = np.log(n / np.array(list(counts.values()), float)) + 1e-3
    key = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}"
    numbered = stored(texts.mapInArrow(_numbered(list(counts), idf), f"{key}, lang string, words array<int>, norm double"))
    sizes = {r["lang"]: r["n"] for r in numbered.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    usual = idf * _sums(numbered, len(langs) * len(idf), _language_sums(langs, len(idf))).reshape(len(langs), len(idf)) / np.array([[sizes[g]] for g in langs], float)
    leaning = _leaning(langs, idf, usual)
    first = numbered.orderBy("doc_id", "lang", "words").withColumn("g", F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1).first().asDict()
    if np.square(_difference(first, idf, usual)).sum() <= LEAST_LEAN:
        first = numbered.mapInArrow(leaning, f"{key}, g int, words array<int>, norm double, lean double").orderBy("doc_id", "g", "words").first()
    blocks = stored(numbered.mapInArrow(lambda batches: _blocked(leaning(batches)), BLOCK_DDL))
    c = _clusters(blocks, first, idf, usual, k)
    return TopicModel({w: c[:, i] * idf[i] for i, w in enumerate(counts)}, {w: float(x) for w, x in zip(counts, idf)}, {g: c @ u for g, u in zip(langs, usual)})


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _flat(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word numbers of all rows one after another, the row of each, and where each row begins. No row is empty."""
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return words.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes


def _numbered(names: list[str], idf: np.ndarray) -> Batches:
    """Words by their rising numbers in the model, and the norm of their weights. Rows without any go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.string())
        for batch in batches:
            words, of, _ = _flat(batch.column("words"))
            at = pc.index_in(pa.array(words, pa.string()), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
            of, at = np.divmod(np.sort((of * len(names) + at)[at >= 0]), len(names))
            some, starts, sizes = np.unique(of, return_index=True, return_counts=True)
            if len(some):
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(at)), pa.int32()), pa.array(at, pa.int32()))
                kept = batch.take(pa.array(some))
                yield pa.record_batch({"doc_id": kept.column("doc_id"), "lang": kept.column("lang"), "words": lists, "norm": np.sqrt(np.add.reduceat(idf[at] ** 2, starts))})

    return run


def _sums(rows: DataFrame, slots: int, terms: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, ...]]]) -> np.ndarray:
    """Exact sums over all rows of values at slots. Batches give them in pieces of at most AT_ONCE texts: slots, values, and for how many slots each value holds; none twice for a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in batches:
            for at, values, size in terms(batch):
                total += np.bincount(at, np.repeat(np.rint(values * UNIT), size), slots).astype(np.int64)
                if total.max() >= 1 << 62:  # before it overflows
                    yield pa.record_batch({"slot": pa.array([np.arange(slots).tobytes()]), "total": pa.array([total.tobytes()])})
                    total[:] = 0
        some = np.flatnonzero(total)
        yield pa.record_batch({"slot": pa.array([some.astype(np.int64).tobytes()]), "total": pa.array([total[some].tobytes()])})

    # as many tasks as cores, so the driver gets a row a core
    found = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "slot binary, total binary").collect()
    out = np.zeros(slots, object)
    for r in found:
        out[np.frombuffer(r["slot"], np.int64)] += np.frombuffer(r["total"], np.int64).astype(object)
    return (out / UNIT).astype(float)


def _language_sums(langs: list[str], size: int) -> Callable:
    def terms(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            at, of, _ = _flat(part.column("words"))
            g = pc.index_in(part.column("lang"), value_set=pa.array(langs, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
            yield g[of] * size + at, 1 / part.column("norm").to_numpy(), np.bincount(of)

    return terms


def _leaning(langs: list[str], idf: np.ndarray, usual: np.ndarray) -> Batches:
    """Language by number, and lean: what scales the difference from its usual words to length 1. Rows without a difference go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (usual**2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            at, of, starts = _flat(batch.column("words"))
            g = pc.index_in(batch.column("lang"), value_set=pa.array(langs, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
            norm = batch.column("norm").to_numpy()
            differs = 1 - 2 * np.add.reduceat(idf[at] * usual[g[of], at], starts) / norm + squares[g]
            lean = 1 / np.sqrt(np.maximum(differs, LEAST_LEAN))
            out = pa.record_batch({"doc_id": batch.column("doc_id"), "g": pa.array(g, pa.int32()), "words": batch.column("words"), "norm": norm, "lean": lean})
            yield out.filter(pa.array(differs > LEAST_LEAN))

    return run


#: Arrays of a block of texts as bytes: the word numbers one after another, and for each text how many, language, norm and lean.
BLOCK = {"words": np.uint16, "size": np.int32, "g": np.int32, "norm": np.float64, "lean": np.float64}
BLOCK_DDL = ", ".join(f"{c} binary" for c in BLOCK)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in blocks of about BLOCK_BYTES, so that rounds read few rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, of, _ = _flat(batch.column("words"))
        columns = {c: batch.column(c).to_numpy() for c in ("g", "norm", "lean")} | {"size": np.bincount(of, minlength=batch.num_rows)}
        ends = np.cumsum(columns["size"])
        cuts = np.flatnonzero(np.diff((2 * ends + 24 * np.arange(1, batch.num_rows + 1)) // BLOCK_BYTES)) + 1
        split = {c: np.split(x.astype(BLOCK[c]), cuts) for c, x in columns.items()} | {"words": np.split(at.astype(np.uint16), ends[cuts - 1])}
        yield pa.record_batch({c: pa.array([x.tobytes() for x in split[c]], pa.binary()) for c in BLOCK})


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Word numbers, how many, language, norm and lean of at most AT_ONCE texts of blocks."""
    words, size, g, norm, lean = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t) for c, t in BLOCK.items())
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    for start in range(0, len(size), AT_ONCE):
        end = min(start + AT_ONCE, len(size))
        yield words[ends[start] : ends[end]].astype(np.int64), size[start:end], g[start:end].astype(np.int64), norm[start:end], lean[start:end]


def _fits(at: np.ndarray, size: np.ndarray, g: np.ndarray, norm: np.ndarray, table: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """How well texts fit each centre. table: centres times idf; shared: what each language's usual words fit each centre."""
    starts = np.cumsum(size, dtype=np.int64) - size
    return np.stack([np.add.reduceat(t.take(at), starts) / norm - u[g] for t, u in zip(table, shared)])


def _farthest(blocks: DataFrame, table: np.ndarray, shared: np.ndarray) -> dict:
    """The text that fits all centres worst; of equals the one of least language and words. The driver gets a row a core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for at, size, g, norm, lean in _pieces(batch):
                fit = _fits(at, size, g, norm, table, shared).max(axis=0) * lean
                ends = np.cumsum(size, dtype=np.int64)
                for i in np.flatnonzero(fit == fit.min()):
                    row = (float(fit[i]), int(g[i]), at[ends[i] - size[i] : ends[i]].tolist(), float(norm[i]))
                    best = min(best or row, row)
        if best:
            yield pa.record_batch({"fit": pa.array([best[0]]), "g": pa.array([best[1]], pa.int32()), "words": pa.array([best[2]], pa.list_(pa.int32())), "norm": pa.array([best[3]])})

    found = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "fit double, g int, words array<int>, norm double").collect()
    return min((r.asDict() for r in found), key=lambda r: (r["fit"], r["g"], r["words"]))


def _difference(text, idf: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """The weights of a text's words less those that are usual in its language."""
    y = -usual[text["g"]]
    y[text["words"]] += idf[text["words"]] / text["norm"]
    return y


def _clusters(blocks: DataFrame, first, idf: np.ndarray, usual: np.ndarray, k: int) -> np.ndarray:
    """The centres, by word, of the texts of blocks, all of which lean somewhere."""
    size, langs = len(idf), len(usual)

    def centre(text) -> np.ndarray:
        y = _difference(text, idf, usual)
        return y / np.linalg.norm(y)

    # the first text, then always the one that fits those chosen worst
    if first is None:
        return np.zeros((1, size))
    texts = blocks.agg(F.sum(F.octet_length("g") / 4)).first()[0]
    c = centre(first)[None]
    for _ in range(min(k, int(texts)) - 1):
        c = np.vstack([c, centre(_farthest(blocks, c * idf, c @ usual.T))])
    for _ in range(ROUNDS):
        table, shared = c * idf, c @ usual.T

        def terms(batch: pa.RecordBatch, table=table, shared=shared) -> Iterator[tuple[np.ndarray, ...]]:
            for at, n, g, norm, lean in _pieces(batch):
                topic = np.argmax(_fits(at, n, g, norm, table, shared), axis=0)
                slots = np.concatenate([np.repeat(topic * size, n) + at, len(table) * size + topic * langs + g])
                yield slots, np.concatenate([lean / norm, lean]), np.concatenate([n, np.ones_like(n)])

        sums = _sums(blocks, len(c) * (size + langs), terms)
        own, leans = sums[: len(c) * size].reshape(len(c), size) * idf, sums[len(c) * size :].reshape(len(c), langs)
        new = np.where(leans.any(axis=1)[:, None], own - leans @ usual, c)
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-9):
            break
        c = new
    return c
