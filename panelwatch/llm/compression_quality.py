"""Quality by compression: zstandard dictionaries of good and bad labelled text.

A text is compressed whole with a dictionary of good text and with one of bad text.  The difference of the compressed
sizes, bad less good, divided by the text's bytes says which kind of text the dictionary knows better.  This is
done in two views: the bytes as they are, and their shape (every lower-case or non-ASCII letter byte an ``a``, every capital an ``A``,
every digit a ``0``), in which wording vanishes and layout remains.  A logistic curve turns the two differences into the
probability of label 1.

Half of the labelled rows (by a checksum of the id) build the dictionaries, from a bounded sample: whole texts in checksum order, up to
``Settings.sample_bytes`` of each class.  The curve is fitted on all rows of the other half, by Newton steps over sums that Spark
computes, so it never sees texts that are in a dictionary.  Scores use the text only.

Edge cases: null and empty texts have no difference and get the curve's value there; ids with contradicting labels, null labels and
labels without a document are not learnt from; with one class only (or none) among the rows of either half every
score is the share of label 1 (0.5 without labels); a class with too little text for training a dictionary has that text itself as dictionary;
repeated rows are scored one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import pieces, stage
from panelwatch.llm.toxicity import everything, judged

#: the shape of each byte
SHAPE = bytes(97 if 97 <= b < 123 or b >= 128 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b for b in range(256))


@dataclass(frozen=True)
class Settings:
    """Sizes of the dictionaries and bounds of the sample that they are built from."""

    dictionary_bytes: int = 16 << 10
    sample_bytes: int = 400_000
    sample_rows: int = 2_000
    level: int = 3
    #: added to a text's bytes, so that a few bytes of difference mean little in a short text
    smooth: int = 64
    ridge: float = 0.1
    steps: int = 25


@dataclass
class Model:
    """Dictionaries (view x class, bad first) and the curve; without dictionaries ``base`` is every score."""

    dictionaries: list[tuple[bytes, bytes]]
    kinds: list[tuple[int, int]]
    weights: np.ndarray
    base: float
    settings: Settings


def dictionary(texts: list[bytes], size: int) -> tuple[bytes, int]:
    """A dictionary of at most ``size`` bytes and its kind: trained, or the texts' own beginnings where they are too few."""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes(), zstandard.DICT_TYPE_FULLDICT
    except zstandard.ZstdError:
        each = max(size // max(len(texts), 1), 1)
        return b"".join(t[:each] for t in texts)[:size], zstandard.DICT_TYPE_RAWCONTENT


class Compressors:
    """Sizes of texts under a model's dictionaries."""

    def __init__(self, model: Model):
        self.smooth = model.settings.smooth
        self.views = []
        for pair, kinds in zip(model.dictionaries, model.kinds):
            both = []
            for data, kind in zip(pair, kinds):
                d = zstandard.ZstdCompressionDict(data, dict_type=kind)
                if data:
                    d.precompute_compress(level=model.settings.level)
                both.append(zstandard.ZstdCompressor(level=model.settings.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
            self.views.append(both)

    def differences(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Normalised size difference of each text in each view."""
        raw, at = data.tobytes(), offsets.tolist()
        out = np.empty((len(at) - 1, len(self.views)))
        for v, (bad, good) in enumerate(self.views):
            view = memoryview(raw if v == 0 else raw.translate(SHAPE))
            out[:, v] = [len(bad.compress(view[a:b])) - len(good.compress(view[a:b])) if b > a else 0 for a, b in zip(at, at[1:])]
        return out / (np.diff(offsets) + self.smooth)[:, None]


def _sample(docs: DataFrame, known: DataFrame, label: int, s: Settings) -> list[bytes]:
    """Whole texts of one class in checksum order, while they fit into the bound (the first one at least)."""
    few = known.where(F.col("y") == label).orderBy(F.xxhash64("id"), "id").limit(s.sample_rows)
    texts = docs.join(F.broadcast(few), "id").orderBy(F.xxhash64("id"), "id", "text").select("text")  # at most sample_rows ids
    out, size = [], 0
    for r in texts.toLocalIterator():
        t = (r.text or "").encode()
        if t and (not out or size + len(t) <= s.sample_bytes):
            out.append(t)
            size += len(t)
        if size >= s.sample_bytes:
            break
    return out


def _curve(rows: DataFrame, s: Settings) -> np.ndarray | None:
    """Weights of the differences and the constant, by Newton steps on the ridge-penalised likelihood; None without both classes."""
    t = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *[F.avg(c).alias(f"m_{c}") for c in "ab"], *[F.stddev_pop(c).alias(f"s_{c}") for c in "ab"]).first()
    if not t.n or t.ones in (0, t.n):
        return None
    mean, sd = np.array([t.m_a, t.m_b]), np.array([t.s_a or 1.0, t.s_b or 1.0])
    x = [(F.col("a") - float(mean[0])) / float(sd[0]), (F.col("b") - float(mean[1])) / float(sd[1]), F.lit(1.0)]
    w = np.array([0.0, 0.0, np.log(t.ones / (t.n - t.ones))])
    penalty = np.array([s.ridge, s.ridge, 0.0])
    for _ in range(s.steps):
        p = F.lit(1.0) / (1 + F.exp(-sum((F.lit(float(k)) * c for k, c in zip(w[:2], x)), F.lit(float(w[2])))))
        z = rows.select(F.col("y").alias("y"), p.alias("p"), *[c.alias(f"x{i}") for i, c in enumerate(x)])
        g = [F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")) for i in range(3)]
        h = [F.sum(F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}")) for i in range(3) for j in range(3)]
        r = list(z.agg(*g, *h).first())
        step = np.linalg.solve(np.array(r[3:]).reshape(3, 3) + np.diag(penalty) + 1e-9 * np.eye(3), np.array(r[:3]) - penalty * w)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    slope = w[:2] / sd
    return np.array([slope[0], slope[1], w[2] - slope @ mean])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), train_if=everything, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> tuple[Model, DataFrame]:
    """Dictionaries and curve from the labelled rows for which ``train_if(id)`` holds, and the staged differences (id, a, b)
    of all rows of ``docs``: texts are compressed once, where they lie, and only numbers meet the labels."""
    known = judged(labels, train_if, id_col, label_col).where("y IN (0, 1)")
    by = {int(r.y): r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(by.values())
    model = Model([], [], np.zeros(3), by.get(1, 0) / total if total else 0.5, settings)
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    half = F.pmod(F.xxhash64(F.lit("dictionary"), F.col("id")), F.lit(2)) == 0
    bad, good = (_sample(texts.where("id IS NOT NULL"), known.where(half), label, settings) for label in (0, 1))
    if not bad or not good:
        return model, texts.select("id", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    made = [[dictionary([t.translate(SHAPE) if v else t for t in part], settings.dictionary_bytes) for part in (bad, good)] for v in (0, 1)]
    model.dictionaries, model.kinds = [(x[0][0], x[1][0]) for x in made], [(x[0][1], x[1][1]) for x in made]
    rows = stage(differences(docs, model, id_col, text_col), "quality-differences")
    weights = _curve(stage(rows.join(known.where(~half), "id").select("a", "b", F.col("y").cast("double").alias("y")), "quality-curve"), settings)
    if weights is None:
        model.dictionaries = []
    else:
        model.weights = weights
    return model, rows


def differences(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and differences (a, b) of every row."""
    kept = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sizes = Compressors(shared.value)
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(0)):
                d = sizes.differences(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array(d[:, 0]), pa.array(d[:, 1])], names=["id", "a", "b"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, a double, b double")


def scored(rows: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id and score (0 to 1) from differences."""
    a, b, c = (float(x) for x in model.weights)
    curve = F.lit(1.0) / (1 + F.exp(-(F.col("a") * a + F.col("b") * b + c)))
    return rows.select(F.col("id").alias(id_col), (curve if model.dictionaries else F.lit(float(model.base))).alias("score"))


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and score (0 to 1)."""
    rows = differences(docs, model, id_col, text_col) if model.dictionaries else docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    return scored(rows, model, id_col)
