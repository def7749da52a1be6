"""Toxicity: a convolutional text classifier in numpy.

A word is the sum of hashed embeddings: two of the whole word (under independent
hashes, so that words sharing a row of one table differ in the other) and one for each of the
beginnings ``HEADS``, which rare inflected and compound words share.  Filters of widths 1, 2 and 3 slide
over the whole text; of each filter the greatest and the third greatest response are
kept (k-max pooling: one hostile word may be chance, several are not),
and a logistic unit turns these into a score.  Training is Adagrad on a bounded sample of
labelled rows (``Settings.rows`` of each class, ``Settings.words`` words in all; whole
texts), with the class shares put back into the bias afterwards.  Scoring is
one pass over the table; the model (about 4 MB) is broadcast.

Scores use the text only.  ``thresholds`` holds, for each language with enough labelled rows
of both classes, the cut of best F1 over all its labelled rows: after training, one more pass scores the table
and counts labelled rows by language, label and score.  Where a language has enough rows of both classes outside
the training sample, its scores come from these alone, weighted up to the full count of each class.
Other languages use ``DEFAULT_CUT``.

Edge cases: null and empty texts are scored as texts without words; ids with
contradicting labels, null labels and labels without a document are left out of
training; without both classes every score is the share of toxic labels (0.5 with none);
repeated rows are scored one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import ALNUM_WORDS, Words, pieces

DEFAULT_CUT = 0.7
#: cuts that a language may have
CUTS = np.arange(300, 951) / 1000
#: bytes of a word's beginnings that have embeddings of their own
HEADS = (5, 7)
TABLES = 2 + len(HEADS)
#: ranks of the responses that pooling keeps
RANKS = (1, 3)


@dataclass(frozen=True)
class Settings:
    """Sizes of the model (``buckets``: a power of two) and bounds of its training sample."""

    buckets: int = 1 << 16
    width: int = 8
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    rows: int = 3000
    words: int = 8_000_000
    smooth: float = 20.0
    epochs: int = 10
    batch: int = 64
    rate: float = 0.05
    seed: int = 7
    per_language: int = 20


@dataclass
class Model:
    tables: list[np.ndarray]
    filters: list[np.ndarray]  # of each span: (span, width, filters)
    bias: np.ndarray
    out: np.ndarray
    base: float
    thresholds: dict[str, float] = field(default_factory=dict)


def word_rows(words: Words, buckets: int) -> np.ndarray:
    """The table rows of each word, ``buckets`` standing for padding."""
    h, *heads = words.hashes(*HEADS)
    low = np.uint64(buckets - 1)
    return np.stack([(x & low).astype(np.int32) for x in (h, h >> np.uint64(32), *heads)], axis=1)


def padded(rows: np.ndarray, counts: np.ndarray, pad: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, each followed by ``pad`` padding rows (one more for a text
    without words); the first and the end of the positions where filters start in each."""
    size = np.maximum(counts, 1)
    first = np.concatenate([[0], np.cumsum(size + pad)])
    out = np.full((first[-1], TABLES), buckets, np.int32)
    out[np.arange(len(rows)) + np.repeat(first[:-1] - np.cumsum(counts) + counts, counts)] = rows
    return out, first[:-1], first[:-1] + size


def _responses(model: Model, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded words and, at each position, all filters' responses."""
    x = model.tables[0][rows[:, 0]]
    for k in range(1, TABLES):
        x += model.tables[k][rows[:, k]]
    n = len(x) - max(len(f) for f in model.filters) + 1
    parts = []
    for f in model.filters:
        r = x[:n] @ f[0]
        for j in range(1, len(f)):
            r += x[j:j + n] @ f[j]
        parts.append(r)
    return x, np.concatenate(parts, axis=1)


def _pooled_at(r: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Positions of each text's kept responses: text x (rank, filter)."""
    most = max(RANKS)
    out = np.empty((len(first), len(RANKS), r.shape[1]), np.int64)
    for i, (a, b) in enumerate(zip(first, last)):
        k = min(most, b - a)
        part = r[a:b]
        top = np.argpartition(part, b - a - k, axis=0)[b - a - k:] if b - a > k else np.arange(b - a)[:, None] + np.zeros(r.shape[1], np.int64)
        order = np.take_along_axis(top, np.argsort(-np.take_along_axis(part, top, axis=0), axis=0, kind="stable"), axis=0)
        for j, rank in enumerate(RANKS):
            out[i, j] = a + order[min(rank, k) - 1]
    return out.reshape(len(first), -1)


def scores(model: Model, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(counts):
        return np.zeros(0)
    if not model.tables:
        return np.full(len(counts), 1 / (1 + np.exp(-model.base)))
    pad = max(len(f) for f in model.filters) - 1
    seq, first, last = padded(rows, counts, pad, len(model.tables[0]) - 1)
    _, r = _responses(model, seq)
    cols = np.tile(np.arange(r.shape[1]), len(RANKS))
    top = np.maximum(r[_pooled_at(r, first, last), cols] + model.bias, 0)
    return 1 / (1 + np.exp(-(top.astype(np.float64) @ model.out + model.base)))


def train(texts: list[np.ndarray], labels: np.ndarray, share: float, s: Settings = Settings()) -> Model:
    """Fit on the word rows of labelled texts; ``share`` is the part of label 1 among all labelled rows."""
    rng = np.random.default_rng(s.seed)
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if not len(labels) or labels.min() == labels.max():
        return Model([], [], np.zeros(0), np.zeros(0), float(odds))
    pos = float(labels.mean())
    tables = []
    for k in range(TABLES):
        # start: one coordinate holds the row's log odds over the sample's texts, smoothed towards none
        on, off = np.full(s.buckets + 1, s.smooth * pos), np.full(s.buckets + 1, s.smooth * (1 - pos))
        for rows, y in zip(texts, labels):
            (on if y else off)[np.unique(rows[:, k])] += 1
        t = rng.normal(0, 0.05, (s.buckets + 1, s.width)).astype(np.float32)
        t[:, 0] = np.log(on / off) - np.log(pos / (1 - pos))
        t[s.buckets] = 0
        tables.append(t)
    filters = []
    for span in s.spans:
        f = rng.normal(0, 0.3, (span, s.width, s.filters)).astype(np.float32)
        f[:, 0, 0] = 0.5
        filters.append(f)
    n = s.filters * len(s.spans) * len(RANKS)
    m = Model(tables, filters, np.zeros(n, np.float32), rng.normal(0, 0.1, n), 0.0)
    m.out[::s.filters] = 0.5
    grown = {"f": [np.full(f.shape, 1e-4, np.float32) for f in filters], "b": np.full(n, 1e-4), "o": np.full(n, 1e-4), "c": 1e-4,
             "t": [np.full(t.shape, 1e-4, np.float32) for t in tables]}
    pad = max(s.spans) - 1
    counts = np.array([len(t) for t in texts])
    for _ in range(s.epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), s.batch):
            pick = order[a:a + s.batch]
            seq, first, last = padded(np.concatenate([texts[i] for i in pick]), counts[pick], pad, s.buckets)
            _step(m, grown, seq, first, last, labels[pick], s)
    m.base += float(odds - np.log(pos / (1 - pos)))
    return m


def _step(m: Model, grown, seq: np.ndarray, first: np.ndarray, last: np.ndarray, y: np.ndarray, s: Settings) -> None:
    x, r = _responses(m, seq)
    n = r.shape[1]
    best = _pooled_at(r, first, last)  # text x (rank, filter)
    top = r[best, np.tile(np.arange(n), len(RANKS))] + m.bias
    pooled = np.maximum(top, 0)
    p = 1 / (1 + np.exp(-(pooled @ m.out + m.base)))
    err = (p - y) / len(y)

    def adapt(value, total, grad):
        total += grad * grad
        value -= s.rate * grad / np.sqrt(total)

    back = (err[:, None] * m.out[None, :]) * (top > 0)
    adapt(m.out, grown["o"], pooled.T @ err)
    grown["c"] += float(err.sum()) ** 2
    m.base -= s.rate * float(err.sum()) / np.sqrt(grown["c"])
    adapt(m.bias, grown["b"], back.sum(axis=0))
    at, grads = [], []
    for k, f in enumerate(m.filters):
        df = np.zeros_like(f)
        for rank in range(len(RANKS)):
            cols = slice(rank * n + k * s.filters, rank * n + (k + 1) * s.filters)
            g, where = back[:, cols].astype(np.float32), best[:, cols]
            for j in range(len(f)):
                xs = x[where + j]  # text x filter x width
                df[j] += np.einsum("tfw,tf->wf", xs, g)
                at.append((where + j).ravel())
                grads.append((g[:, :, None] * f[j].T[None]).reshape(-1, s.width))
        adapt(f, grown["f"][k], df)
    at, grads = np.concatenate(at), np.concatenate(grads)
    for k, t in enumerate(m.tables):
        rows, inverse = np.unique(seq[at, k], return_inverse=True)
        g = np.zeros((len(rows), s.width), np.float32)
        np.add.at(g, inverse, grads)
        g[rows == s.buckets] = 0
        grown["t"][k][rows] += g * g
        t[rows] -= s.rate * g / np.sqrt(grown["t"][k][rows])


def cut(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut of best F1, the nearest to the default among equals; entry k of either
    class holds the weight of the scores that reach exactly the first k of ``CUTS``."""
    hit, wrong = (np.cumsum(x[::-1])[::-1][1:] for x in (toxic, clean))
    f1 = 2 * hit / np.maximum(hit + wrong + toxic.sum(), 1e-9)
    near = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(CUTS[near[np.argmin(np.abs(CUTS[near] - DEFAULT_CUT))]])


def judged(labels: DataFrame, train_if, id_col: str, label_col: str) -> DataFrame:
    """id and label (y) of the ids whose labels agree and for which ``train_if(id)`` holds."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where("y = z").select("id", "y"))
    return known.where(train_if(F.col("id")))


def sample(docs: DataFrame, known: DataFrame, s: Settings, id_col: str, text_col: str):
    """Labelled texts for training: word rows, labels, hashes of the ids, share of label 1."""
    by = {int(r.y): r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("id")
    few = [known.where(F.col("y") == c).orderBy(order, "id").limit(s.rows) for c in (0, 1)]
    ids = F.broadcast(few[0].unionByName(few[1]))  # at most 2 * rows ids
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id")

    def rows(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                w = Words(data, offsets, ALNUM_WORDS)
                r = word_rows(w, s.buckets)
                part = [r[w.first[i]:w.first[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(part, pa.binary())],
                                                 names=["id", "y", "rows"])

    kind = kept.schema["id"].dataType.simpleString()
    coded = kept.select("id", "text", F.col("y").cast("int")).mapInArrow(rows, f"id {kind}, y int, rows binary").withColumn("h", F.xxhash64("id"))
    texts, ys, used, size = [], [], [], 0
    for r in coded.orderBy("h", "id").toLocalIterator():
        if size + len(r.rows) // (4 * TABLES) > s.words:
            continue
        size += len(r.rows) // (4 * TABLES)
        texts.append(np.frombuffer(r.rows, np.int32).reshape(-1, TABLES))
        ys.append(r.y)
        used.append(r.h)
    total = sum(by.values())
    return texts, np.array(ys, np.float64), np.array(used, np.int64), (by.get(1, 0) / total if total else 0.5)


def everything(_) -> F.Column:
    return F.lit(True)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), train_if=everything, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> tuple[Model, np.ndarray]:
    """A model without cuts, trained on the labelled rows for which ``train_if(id)`` holds, and the hashes of the ids of its sample."""
    texts, y, used, share = sample(docs, judged(labels, train_if, id_col, label_col), settings, id_col, text_col)
    return train(texts, y, share, settings), used


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), train_if=everything, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> Model:
    """Train on the labelled rows for which ``train_if(id)`` holds, and set each language's cut by all of them."""
    model, used = learn(docs, labels, settings, train_if, id_col, text_col, label_col)
    if model.tables:
        model.thresholds = cuts(docs, judged(labels, train_if, id_col, label_col), model, used, settings, id_col, text_col, lang_col)
    return model


def cuts(docs: DataFrame, known: DataFrame, model: Model, used: np.ndarray, s: Settings, id_col: str, text_col: str, lang_col: str) -> dict[str, float]:
    """Each language's cut, from the scores of all rows with a label in ``known`` (id, y).

    Texts are scored where they lie; only id, language and score meet the labels."""
    shared = docs.sparkSession.sparkContext.broadcast((model, np.sort(used)))
    kept = docs.select(F.col(id_col).alias("id"), F.coalesce(lang_col, F.lit("")).alias("lang"), F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))

    def run(batches):
        m, seen = shared.value
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(3)):
                level = np.searchsorted(CUTS, _scored(data, offsets, m), side="right").astype(np.int32)
                fresh = ~np.isin(np.asarray(batch.column(2).slice(a, b - a)), seen)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(level), pa.array(fresh)],
                                                 names=["id", "lang", "level", "fresh"])

    levels = kept.where("id IS NOT NULL").mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, lang string, level int, fresh boolean")
    by: dict[str, np.ndarray] = {}  # language -> fresh x label x level
    for r in levels.join(known.where("y IN (0, 1)"), "id").groupBy("lang", "level", "fresh", F.col("y").cast("int").alias("y")).agg(F.count("*").alias("n")).collect():
        by.setdefault(r.lang, np.zeros((2, 2, len(CUTS) + 1)))[int(r.fresh), r.y, r.level] += r.n
    out = {}
    for lang, n in sorted(by.items()):
        full, fresh = n.sum(axis=(0, 2)), n[1].sum(axis=1)
        if full.min() >= s.per_language:
            weights = n[1] * (full / fresh)[:, None] if fresh.min() >= s.per_language else n.sum(axis=0)
            out[lang] = cut(*weights)
    return out


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(_scored(data, offsets, shared.value))],
                                                 names=[id_col, "score"])

    return kept.mapInArrow(run, f"{id_col} {kept.schema[id_col].dataType.simpleString()}, score double")


def _scored(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    w = Words(data, offsets, ALNUM_WORDS)
    rows = word_rows(w, len(model.tables[0]) - 1) if model.tables else np.zeros((0, TABLES), np.int32)
    return scores(model, rows, w.counts)


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose score is below their language's cut, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(text_at)):
                part = batch.slice(a, b - a)
                cuts = np.array([shared.value.thresholds.get(x or "", DEFAULT_CUT) for x in part.column(lang_at).to_pylist()])
                yield part.filter(pa.array(_scored(data, offsets, shared.value) < cuts))

    return docs.mapInArrow(run, docs.schema)
