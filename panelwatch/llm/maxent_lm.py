"""Language-model scores from a hashed maximum-entropy model.

P(word | text before it) = P(class | features) * P(word | class).  The features
are hashed: the word before, the pair before (n-gram), and the words two and three back
alone (skips).  Classes: each of the most frequent words is one; the others share classes by their
last bytes.  P(class | features) is a softmax over the sum of the features' weight rows; P(word |
class) is the add-one share of the word's count in its class.

Jobs, none of which collects more than the model (``Settings.buckets`` x classes):

* encode: tasks turn runs of texts into blocks (local dictionary, numbers of the tokens, training
  counts), staged;
* count: the dictionaries are dealt by bins of the word hash; a bin adds up its words over
  all blocks and returns to each block its words' counts.  No vocabulary is broadcast or collected;
* train: ``Settings.updates`` distributed updates, each over its own share of the training texts (together
  all of them).  Tasks sum observed and expected class counts of every feature; the sums are added by
  bucket, and the weights move by the logarithm of their smoothed ratio, whose sign is the gradient's
  (a step of iterative scaling);
* score: blocks meet their counts and are scored in sparse batches.

Word identity is a 64-bit hash.  Edge cases: a null or empty text has the end token only; repeated rows count and
are scored one by one; with no training text every token has count 0 and classes are equally likely; an empty table gives an empty
table; columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import SPACE_WORDS, Words, mixed, pieces, stage

END, BEGIN = np.uint64(0x5E5E5E5E5E5E5E5E), np.uint64(0x0B0B0B0B0B0B0B0B)
#: bytes of text in one block, and text bytes for each bin of the word hash
BLOCK_BYTES, BIN_BYTES = 4 << 20, 4 << 20
_CHUNK = 1 << 14
#: blocks that a training task takes at least where there are many, buckets summed as one value, and the share of held-out texts
TASK_BLOCKS, ROWS_EACH, HELD = 32, 128, 255
_SALTS = np.array([0x1111111111111111, 0x2222222222222222, 0x3333333333333333], np.uint64)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    singles: int = 32
    tails: int = 16
    updates: int = 3
    smooth: float = 30.0
    rate: float = 0.5

    @property
    def classes(self) -> int:
        return self.singles + self.tails


@dataclass
class Model:
    singles: np.ndarray  # hashes of the words that are classes of their own
    single_counts: np.ndarray
    tail_words: np.ndarray  # of each shared class: training tokens and distinct words
    tail_kinds: np.ndarray
    tokens: int
    kinds: int
    bias: np.ndarray
    weights: np.ndarray


def _tails(words: Words, tails: int) -> np.ndarray:
    """Shared class of each word, by its last two bytes."""
    last = words.data[words.ends - 1].astype(np.uint64)
    back = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mixed(last * np.uint64(257) + back) % np.uint64(tails)).astype(np.uint8)


def _buffers(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def encode(docs: DataFrame, held: F.Column, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """Blocks: ids, sizes, shares (the update that learns from a text, by its id; ``HELD``: none), local dictionary and token numbers."""
    share = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(s.updates))
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.when(held, F.lit(HELD)).otherwise(share).cast("int").alias("held"))

    def run(batches):
        made = 0
        for batch in batches:
            shares = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            for a, b, data, offsets in pieces(batch.column(1), BLOCK_BYTES):
                w = Words(data, offsets, SPACE_WORDS)
                n = w.counts + 1
                h = np.full(len(w) + len(n), END, np.uint64)
                tail = np.zeros(len(h), np.uint8)
                at = np.arange(len(w)) + w.owner()
                if len(w):
                    h[at], tail[at] = w.hashes(), _tails(w, s.tails)
                known, lead, number = np.unique(h, return_index=True, return_inverse=True)
                train = np.bincount(number[np.repeat(shares[a:b] != HELD, n)], minlength=len(known))
                number = number.astype(np.uint32)
                block = (TaskContext.get().partitionId() << 32) + made
                made += 1
                row = _buffers(n.astype(np.int32), shares[a:b], known, tail[lead], train.astype(np.uint32), number)
                ids = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids), *[pa.array([x], pa.binary()) for x in row]],
                    names=["block", "ids", "sizes", "held", "known", "tail", "train", "number"])

    kind = kept.schema["id"].dataType.simpleString()
    return stage(kept.mapInArrow(run, f"block long, ids array<{kind}>, sizes binary, held binary, known binary, tail binary, train binary, number binary"), "lm-blocks", compression="zstd")


def _each(batches):
    """Rows one by one: they are large, so no batch is turned into objects whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _rows(batches):
    """Rows of sorted batches in runs of equal first column."""
    now, run = None, []
    for r in _each(batches):
        k = next(iter(r.values()))
        if run and k != now:
            yield now, run
            run = []
        now = k
        run.append(r)
    if run:
        yield now, run


def count(blocks: DataFrame, bins: int, s: Settings) -> DataFrame:
    """Each block's training counts by bin, and (``block`` null) the bin's totals; staged."""

    def deal(batches):
        for r in _each(batches):
            known, train, tail = (np.frombuffer(r[c], t) for c, t in (("known", np.uint64), ("train", np.uint32), ("tail", np.uint8)))
            bin_ = ((known >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # known ascends, so bins do
            cut = np.flatnonzero(np.concatenate([[True], bin_[1:] != bin_[:-1], [True]])) if len(known) else np.zeros(1, np.int64)
            cols = [[], [], [], [], []]
            for x, y in zip(cut[:-1], cut[1:]):
                for c, v in zip(cols, (int(bin_[x]), r["block"], *_buffers(known[x:y], train[x:y], tail[x:y]))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[2:]]],
                                             names=["bin", "block", "known", "train", "tail"])

    def add(batches):
        for bin_, rows in _rows(batches):
            known = [np.frombuffer(r["known"], np.uint64) for r in rows]
            train = np.concatenate([np.frombuffer(r["train"], np.uint32) for r in rows])
            tail = np.concatenate([np.frombuffer(r["tail"], np.uint8) for r in rows])
            words, lead, which = np.unique(np.concatenate(known), return_index=True, return_inverse=True)
            total = np.bincount(which, weights=train, minlength=len(words)).astype(np.int64)
            back = np.split(total[which], np.cumsum([len(k) for k in known])[:-1])
            seen = total > 0
            top = np.lexsort((words, -total))[:s.singles]
            top = top[total[top] > 0]
            t = tail[lead]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["block"] for r in rows] + [None], pa.int64()), pa.array([bin_] * (len(rows) + 1), pa.int64()),
                 pa.array([x.tobytes() for x in back] + [None], pa.binary()),
                 pa.array([None] * len(rows) + [np.bincount(t[seen], weights=total[seen], minlength=s.tails).astype(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([None] * len(rows) + [np.bincount(t[seen], minlength=s.tails).tolist()], pa.list_(pa.int64())),
                 pa.array([None] * len(rows) + [[{"h": int(w.view(np.int64)), "c": int(c), "t": int(x)} for w, c, x in zip(words[top], total[top], t[top])]],
                          pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64()), ("t", pa.int32())])))],
                names=["block", "bin", "counts", "tail_words", "tail_kinds", "top"])

    dealt = blocks.select("block", "known", "train", "tail").mapInArrow(deal, "bin long, block long, known binary, train binary, tail binary")
    dealt = dealt.repartition("bin").sortWithinPartitions("bin", "block")
    return stage(dealt.mapInArrow(add, "block long, bin long, counts binary, tail_words array<long>, tail_kinds array<long>, "
                                       "top array<struct<h: long, c: long, t: int>>"), "lm-counts", compression="zstd")


def _start(counts: DataFrame, s: Settings) -> Model:
    """The untrained model: classes, their sizes, and weights of nothing."""
    totals = counts.where("block IS NULL")
    per = totals.select(F.explode(F.arrays_zip("tail_words", "tail_kinds", F.sequence(F.lit(0), F.lit(s.tails - 1)).alias("t"))).alias("x")).groupBy("x.t").agg(
        F.sum("x.tail_words").alias("w"), F.sum("x.tail_kinds").alias("k")).collect()
    words, kinds = np.zeros(s.tails, np.int64), np.zeros(s.tails, np.int64)
    for r in per:
        words[r.t], kinds[r.t] = r.w, r.k
    tokens, distinct = int(words.sum()), int(kinds.sum())
    top = totals.select(F.explode("top").alias("x")).select("x.*").orderBy(F.desc("c"), "h").limit(s.singles).collect()
    for r in top:
        words[r.t] -= r.c
        kinds[r.t] -= 1
    single = np.array([r.h for r in top], np.int64).view(np.uint64)
    order = np.argsort(single)
    single, c = single[order], np.array([r.c for r in top], np.int64)[order] if top else np.zeros(0, np.int64)
    mass = np.concatenate([c, np.zeros(s.singles - len(c)), words]) + 1.0
    return Model(single, c, words, kinds, tokens, distinct, np.log(mass / mass.sum()).astype(np.float32),
                 np.zeros((s.buckets, s.classes), np.float32))


def _class_of(m: Model, known: np.ndarray, tail: np.ndarray, s: Settings) -> np.ndarray:
    out = s.singles + tail.astype(np.int64)
    if len(m.singles):
        at = np.minimum(np.searchsorted(m.singles, known), len(m.singles) - 1)
        out = np.where(m.singles[at] == known, at, out)
    return out


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(x) & np.uint64(buckets - 1)).astype(np.int32)


def features(known: np.ndarray, number: np.ndarray, sizes: np.ndarray, buckets: int) -> np.ndarray:
    """The feature buckets (a power of two) of each token (feature x token).

    Single-word features are hashed once for each word of the dictionary."""
    words = np.append(known, BEGIN)
    one = [_bucket(words ^ salt, buckets) for salt in _SALTS]
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    back = []
    for k in (1, 2, 3):
        x = np.full(len(number), len(known), np.int64)
        x[k:] = number[:max(len(number) - k, 0)]
        for j in range(k):
            x[(start + j)[sizes > j]] = len(known)
        back.append(x)
    pair = _bucket(words[back[0]] * np.uint64(3) + words[back[1]], buckets)
    return np.stack([one[0][back[0]], pair, one[1][back[1]], one[2][back[2]]])


def _class_odds(m: Model, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weights of the classes at some tokens (their greatest is 0), and exponentials."""
    z = m.weights.take(f[0], axis=0)
    more = np.empty_like(z)
    for x in f[1:]:
        z += m.weights.take(x, axis=0, out=more, mode="clip")  # buckets are in range; other modes copy once more
    z += m.bias
    z -= z.max(axis=1, keepdims=True)
    return z, np.exp(z)


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each of the rows to the total's row ``at`` it; equal ``at`` are summed first, in their order."""
    at = at.astype(np.min_scalar_type(len(total) - 1))  # two bytes are sorted in one pass
    order = np.argsort(at, kind="stable")
    a = at[order]
    cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    n = np.diff(np.append(cut, len(a)))
    alone = n == 1  # most buckets; a sum of one row is that row
    total[a[cut[alone]]] += rows.take(order[cut[alone]], axis=0)
    if not alone.all():
        n = n[~alone]
        kept = rows.take(order[np.repeat(~alone, np.diff(np.append(cut, len(a))))], axis=0)
        total[a[cut[~alone]]] += np.add.reduceat(kept, np.cumsum(n) - n, axis=0)


def _update(blocks: DataFrame, m: Model, number: int, s: Settings) -> np.ndarray:
    """One distributed update of the weights from a share of the training texts."""
    sc = blocks.sparkSession.sparkContext
    shared = sc.broadcast(m)

    def gather(rows):
        m = shared.value
        seen, due = np.zeros((s.buckets * s.classes), np.float32), np.zeros((s.buckets, s.classes), np.float32)
        for r in rows:
            sizes = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
            use = np.frombuffer(r["held"], np.uint8) == number
            known = np.frombuffer(r["known"], np.uint64)
            picked = np.frombuffer(r["number"], np.uint32)[np.repeat(use, sizes)]
            if not len(picked):
                continue
            k = _class_of(m, known, np.frombuffer(r["tail"], np.uint8), s)[picked]
            f = features(known, picked, sizes[use], s.buckets)
            for a in range(0, len(picked), _CHUNK):
                part = f[:, a:a + _CHUNK]
                cells, often = np.unique(part.astype(np.int64) * s.classes + k[a:a + _CHUNK], return_counts=True)
                seen[cells] += often
                _, p = _class_odds(m, part)
                p /= p.sum(axis=1, keepdims=True)
                for x in part:
                    _add_rows(due, x, p)
        seen = seen.reshape(s.buckets, s.classes)
        for a in range(0, s.buckets, ROWS_EACH):
            if seen[a:a + ROWS_EACH].any():  # buckets without a token have no expectation either
                yield a, np.stack([seen[a:a + ROWS_EACH], due[a:a + ROWS_EACH]])

    # a task sends the whole gradient, so tasks take many blocks each; an RDD, as an Arrow batch would hold all of a task's blocks
    tasks = max(sc.defaultParallelism, -(-blocks.count() // TASK_BLOCKS))
    few = blocks.select("sizes", "held", "known", "tail", "number").coalesce(tasks).rdd
    sums = few.mapPartitions(gather).reduceByKey(lambda a, b: a.astype(np.float64) + b, sc.defaultParallelism)
    seen, due = np.zeros_like(m.weights), np.zeros_like(m.weights)
    for at, both in sums.collect():
        seen[at:at + ROWS_EACH], due[at:at + ROWS_EACH] = both
    shared.destroy()
    prior = s.smooth * np.exp(m.bias)
    return m.weights + np.float32(s.rate) * np.log((seen + prior) / (due + prior))


def train(blocks: DataFrame, counts: DataFrame, s: Settings = Settings()) -> Model:
    m = _start(counts, s)
    for number in range(s.updates):
        m.weights = _update(blocks, m, number, s)
    return m


def _score_block(m: Model, s: Settings, sizes, known, tail, number, counts):
    """Tokens, known tokens, base and model log10 score of each text of a block."""
    k = _class_of(m, known, tail, s)
    base = np.log10((counts + 1.0) / (m.tokens + m.kinds + 1.0))
    t = tail.astype(np.int64)
    inner = np.where(k < s.singles, 0.0, np.log((counts + 1.0) / (m.tail_words[t] + m.tail_kinds[t] + 1.0)))
    f = features(known, number, sizes, s.buckets)
    score = inner[number]
    cls = k[number]
    for a in range(0, len(number), _CHUNK):
        z, e = _class_odds(m, f[:, a:a + _CHUNK])
        score[a:a + _CHUNK] += z[np.arange(len(z)), cls[a:a + _CHUNK]] - np.log(e.sum(axis=1))
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    add = lambda v: np.add.reduceat(v, start)
    return sizes.astype(np.int64), add((counts > 0).astype(np.int64)[number]), add(base[number]), add(score) / np.log(10)


def score(blocks: DataFrame, counts: DataFrame, model: Model, id_col: str, s: Settings) -> DataFrame:
    """One row per input row of the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    parts = counts.where("block IS NOT NULL").select("block", "bin", "counts")
    nothing = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ("ids", "sizes", "held", "known", "tail", "number")]
    both = parts.select("block", "bin", "counts", *nothing).unionByName(
        blocks.select("block", F.lit(1 << 62).alias("bin"), F.lit(None).cast("binary").alias("counts"), "ids", "sizes", "held", "known", "tail", "number"))
    dealt = both.repartition("block").sortWithinPartitions("block", "bin")

    def run(batches):
        for _, rows in _rows(batches):
            r = rows[-1]
            got = np.concatenate([np.frombuffer(x["counts"], np.int64) for x in rows[:-1]])
            sizes = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
            n, known, base, model = _score_block(shared.value, s, sizes, np.frombuffer(r["known"], np.uint64), np.frombuffer(r["tail"], np.uint8),
                                                 np.frombuffer(r["number"], np.uint32), got)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["ids"], id_type), pa.array(np.frombuffer(r["held"], np.uint8) == HELD), pa.array(n), pa.array(known), pa.array(np.full(len(n), shared.value.tokens)),
                 pa.array(base), pa.array(model)], names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(blocks.schema["ids"].dataType.elementType)
    return dealt.mapInArrow(run, f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame, held: F.Column, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Scores of all rows by a model that learns from the rows where ``held`` is false."""
    blocks = encode(docs, held, id_col, text_col, settings)
    size = blocks.agg(F.sum(F.octet_length("number"))).first()[0] or 0  # 4 bytes a token
    counts = count(blocks, max(1, int(size * 3 // 2 // BIN_BYTES)), settings)
    return score(blocks, counts, train(blocks, counts, settings), id_col, settings)
