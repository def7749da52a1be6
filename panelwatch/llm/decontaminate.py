"""Benchmark decontamination with suffix arrays over the training shards.

Each task turns its shard of training text into word hashes and builds a suffix
array of it.  Every suffix of the test texts is binary-searched in that array;
the range found holds all places where the suffix's window (13 words, or the
whole item if shorter) occurs verbatim.  The longest verbatim match at such a place is
found the other way round, by a search of the place's suffix in the block's own suffix array.  Affected documents are then judged and can be removed.

The array is sparse: it leaves out training suffixes whose first words (as many
as the shortest window has, three at most) start no test window.  Such a suffix
can hold no window, so nothing is lost.

No training text leaves its task, so there is no shuffle.  The test side is sent
to the executors in blocks of at most ``BLOCK_WORDS`` words, each searched in
turn, so any number of test items can be used.

Edge cases: a null or empty document has no words and no hit; a null or empty
item, or one with a null id, has no window.  Repeated documents are judged one by
one; repeated item ids count once.  Empty tables give an empty result or no
hits.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import ALNUM_WORDS, Words, by_text, mixed, pieces

WINDOW = 13
#: words of test text in one block (about 150 bytes of driver memory each while it is built,
#: 8 on every executor)
BLOCK_WORDS = 400_000
_LEAD = 3
_BITS = 20


@dataclass
class TestBlock:
    """Word hashes of some test items and their distinct windows.

    ``words`` ends with a 0 after each item, so that no comparison runs on into
    the next one; ``order`` is the suffix array of all its words.  Window ``k`` is ``words[at[k]:at[k] + length[k]]``; the
    items holding it are ``items[first[k]:first[k + 1]]``."""

    words: np.ndarray
    order: np.ndarray
    at: np.ndarray
    length: np.ndarray
    items: np.ndarray
    first: np.ndarray
    names: np.ndarray


def _rows(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The next ``depth`` words of each suffix, one suffix per row."""
    padded = np.concatenate([words, np.zeros(depth, np.uint64)])
    return padded[at[:, None] + np.arange(depth)]


def _suffix_order(words: np.ndarray) -> np.ndarray:
    """Suffix array of ``words`` by prefix doubling, without the suffixes that begin with an
    end mark (0).  End marks come before all words and differ from each other, so an
    item's suffix never runs on into the next item."""
    mark = words == 0
    rank = np.unique(words, return_inverse=True)[1].ravel() + mark.sum()
    rank[mark] = np.arange(mark.sum())
    k = 1
    while True:
        after = np.full(len(words), -1)
        after[:-k] = rank[k:]
        order = np.lexsort((after, rank))
        step = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
        rank = np.empty(len(words), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(step)])
        if step.all() or k >= len(words):
            return order[~mark[order]]
        k *= 2


def build_block(names: list, texts: list[str], window: int = WINDOW) -> TestBlock:
    parts, at, length, item = [], [], [], []
    base = 0
    column = pa.array(texts, pa.large_string())
    for a, _, data, offsets in pieces(column):
        w = Words(data, offsets, ALNUM_WORDS)
        h = w.hashes()
        h[h == 0] = 1
        for i, n in enumerate(w.counts):
            if n == 0:
                continue
            size = min(int(n), window)
            starts = base + np.arange(n - size + 1)
            parts += [h[w.first[i]:w.first[i] + n], np.zeros(1, np.uint64)]
            at.append(starts)
            length.append(np.full(len(starts), size))
            item.append(np.full(len(starts), a + i))
            base += int(n) + 1
    if not parts:
        z = np.zeros(0, np.int64)
        return TestBlock(np.zeros(0, np.uint64), z, z, z, z, np.zeros(1, np.int64), np.array(names, dtype=object))
    words, at, length, item = np.concatenate(parts), np.concatenate(at), np.concatenate(length), np.concatenate(item)
    rows = _rows(words, at, window)
    rows[np.arange(window) >= length[:, None]] = 0
    _, lead, which = np.unique(np.column_stack([rows, length.astype(np.uint64)]), axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.column_stack([which.ravel(), item]), axis=0)
    return TestBlock(words, _suffix_order(words), at[lead], length[lead], pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(lead) + 1)),
                     np.array(names, dtype=object))


def test_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int = BLOCK_WORDS, window: int = WINDOW):
    """Blocks of the test items, made one after the other on the driver."""
    names, texts, size = [], [], 0
    rows = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    for r in rows.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        names.append(r.i)
        texts.append(r.t)
        size += len(r.t) // 2 + 1
        if size >= block_words:
            yield build_block(names, texts, window)
            names, texts, size = [], [], 0
    if names:
        yield build_block(names, texts, window)


def _key(rows: np.ndarray, lead: int) -> np.ndarray:
    k = np.zeros(len(rows), np.uint64)
    for j in range(lead):
        k = mixed(k * np.uint64(31) + rows[:, j])
    return k


class SuffixArray:
    """Suffixes of a shard's words in order, compared on ``depth`` words.

    ``ends[p]`` is where the text of word ``p`` ends; a suffix ends there."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, at: np.ndarray, depth: int):
        rows = _rows(words, at, depth)
        rows[np.arange(depth) >= (ends[at] - at)[:, None]] = 0
        order = np.lexsort(rows.T[::-1])
        self.words, self.ends, self.at, self.rows = words, ends, at[order], rows[order]

    def _bound(self, keys: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
        """Binary search of each key, compared on its first ``length`` words."""
        lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), len(self.at), np.int64)
        col = np.arange(keys.shape[1])
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            a, b = self.rows[mid], keys[open_]
            differ = (a != b) & (col < length[open_, None])
            at = differ.argmax(axis=1)
            some = differ[np.arange(len(at)), at]
            x, y = a[np.arange(len(at)), at], b[np.arange(len(at)), at]
            up = np.where(some, x < y, right)
            lo[open_] = np.where(up, mid + 1, lo[open_])
            hi[open_] = np.where(up, hi[open_], mid)

    def find(self, keys: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (key, position) pairs where the key's first words occur."""
        lo, hi = self._bound(keys, length, False), self._bound(keys, length, True)
        n = hi - lo
        which = np.repeat(np.arange(len(keys)), n)
        return which, self.at[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]


def _common(words: np.ndarray, ends: np.ndarray, test: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Words that the training suffixes ``p`` and the test suffixes ``q`` have in common."""
    n, live = np.zeros(len(p), np.int64), np.arange(len(p))
    while len(live):
        x, y = p[live] + n[live], q[live] + n[live]
        on = x < ends[p[live]]
        live, x, y = live[on], x[on], y[on]
        live = live[words[x] == test[y]]  # an end mark equals no word
        n[live] += 1
    return n


def _longest(words: np.ndarray, ends: np.ndarray, block: TestBlock, p: np.ndarray) -> np.ndarray:
    """Longest verbatim match of each training place with any test text: binary search
    in the test suffix array, and the better of the two neighbours."""
    lo, hi = np.zeros(len(p), np.int64), np.full(len(p), len(block.order))
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            break
        mid = (lo[live] + hi[live]) // 2
        q = block.order[mid]
        n = _common(words, ends, block.words, p[live], q)
        x, y = p[live] + n, q + n
        over = x < ends[p[live]]
        up = over & (words[np.minimum(x, len(words) - 1)] > block.words[y])
        lo[live] = np.where(up, mid + 1, lo[live])
        hi[live] = np.where(up, hi[live], mid)
    sides = [_common(words, ends, block.words, p, block.order[np.clip(lo + d, 0, len(block.order) - 1)]) for d in (-1, 0)]
    return np.maximum(*sides)


def _leads(block: TestBlock, window: int):
    """What a training suffix must start with to hold a window: a bit table
    over the hash of its first words, and how many words that hash takes."""
    lead = int(min(_LEAD, block.length.min()))
    keys = np.unique(_key(_rows(block.words, block.at, lead), lead))
    bits = np.zeros(1 << _BITS, bool)
    bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return lead, keys, bits


def search(words: Words, block: TestBlock, window: int = WINDOW, leads=None):
    """Matches of a block in a shard: (window, training word, words of the
    longest verbatim match from there)."""
    none = np.zeros(0, np.int64)
    h = words.hashes()
    if not len(h) or not len(block.at):
        return none, none, none
    ends = np.repeat(words.first[1:], words.counts)
    h[h == 0] = 1
    lead, keys, bits = leads or _leads(block, window)
    padded = np.concatenate([h, np.zeros(lead, np.uint64)])
    k = np.zeros(len(h), np.uint64)
    for j in range(lead):
        k = mixed(k * np.uint64(31) + padded[j:j + len(h)])
    at = np.flatnonzero(bits[(k >> np.uint64(64 - _BITS)).astype(np.int64)])
    at = at[np.isin(k[at], keys)]
    if not len(at):
        return none, none, none
    array = SuffixArray(h, ends, at, window)
    tests = _rows(block.words, block.at, window)
    which, place = array.find(tests, block.length)
    places, back = np.unique(place, return_inverse=True)
    return which, place, _longest(h, ends, block, places)[back]


def decontamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                           block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: words, hit words, items with a window in it,
    whether it is contaminated (at least a twentieth of its words hit), the
    longest verbatim match in words and the word where it starts (-1: none)."""
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in test_blocks(benchmark, item_id, item_text, block_words, window)]
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = kept.schema["id"].dataType.simpleString()
    schema = f"{id_col} {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, longest_match long, longest_at long"

    def judge(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                yield _judged(batch.column(0).slice(a, b - a), Words(data, offsets, ALNUM_WORDS), blocks, window, id_col)

    out = kept.mapInArrow(judge, schema)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _judged(ids: pa.Array, words: Words, blocks, window: int, id_col: str) -> pa.RecordBatch:
    n, owner = len(words.counts), words.owner()
    step = np.zeros(len(words) + 1, np.int64)
    names: dict[int, set[str]] = {}
    best, best_at = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for shared in blocks:
        block = shared.value
        if not len(block.at):
            continue
        which, place, longest = search(words, block, window, _cached_leads(block, window))
        if not len(which):
            continue
        np.add.at(step, place, 1)
        np.add.at(step, place + block.length[which], -1)
        doc = owner[place]
        order = np.lexsort((place, -longest, doc))
        d, at = np.unique(doc[order], return_index=True)
        better = longest[order[at]] > best[d]
        best[d[better]] = longest[order[at]][better]
        best_at[d[better]] = (place[order[at]] - words.first[d])[better]
        for x, w in np.unique(np.column_stack([doc, which]), axis=0):
            names.setdefault(int(x), set()).update(block.names[block.items[block.first[w]:block.first[w + 1]]])
    hit = by_text(np.cumsum(step[:-1]) > 0, words.first)
    nothing = hashlib.sha256(b"").hexdigest()
    digest = [hashlib.sha256(",".join(sorted(names[i])).encode()).hexdigest() if i in names else nothing for i in range(n)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(words.counts.astype(np.int64)), pa.array(hit.astype(np.int64)),
         pa.array([len(names.get(i, ())) for i in range(n)], pa.int64()), pa.array(digest), pa.array(best), pa.array(best_at)],
        names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "longest_match", "longest_at"])


_lead_cache: dict[int, tuple] = {}


def _cached_leads(block: TestBlock, window: int):
    """The lead table of a block, made once in a worker (the latest block only)."""
    if id(block) not in _lead_cache:
        _lead_cache.clear()
        _lead_cache[id(block)] = (block, _leads(block, window))
    return _lead_cache[id(block)][1]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept.

    The verdict is a function of a row's text alone, so it is computed beside the
    row (no join back by id, which need not be unique)."""
    sc = docs.sparkSession.sparkContext
    window = options.get("window", WINDOW)
    blocks = [sc.broadcast(b) for b in test_blocks(benchmark, options.get("item_id", "item_id"), options.get("item_text", "text"),
                                                   options.get("block_words", BLOCK_WORDS), window)]
    column = docs.columns.index(text_col)

    def clean(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(column)):
                words = Words(data, offsets, ALNUM_WORDS)
                judged = _judged(pa.nulls(b - a), words, blocks, window, id_col)
                hit, n = np.asarray(judged.column(2)), np.asarray(judged.column(1))
                yield batch.slice(a, b - a).filter(pa.array(~((hit > 0) & (20 * hit >= n))))

    return docs.mapInArrow(clean, docs.schema)
