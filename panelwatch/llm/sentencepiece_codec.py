"""SentencePiece encoding and decoding of whole texts.

An Aho-Corasick automaton over the pieces passes once over a text.  At each
position its output links give every piece that ends there, and each relaxes
the position's best state, so one left-to-right pass and a walk back give the
pieces.  What "best" means is the model's kind:

* unigram: the highest sum of piece scores (Viterbi);
* BPE: the piece that byte-pair merging leaves last when it stops at this
  position.  A piece qualifies if it merges to itself and if merging it
  with the best piece before it leaves just these two; exactly one does.  The
  sum of scores would give other ids than the model's own library.

Pieces with equal BPE scores break the "exactly one" (here only runs of the
space mark); text runs holding them are merged by the plain merge loop.

A text is cut before each space mark that follows another character, if no piece
crosses such a place, and the parts are encoded once per worker (a bounded
cache).  The model file's vocabulary, scores and normaliser are read with the public
library; the model is a parameter and travels to the executors through Spark.

Edge cases: null and empty texts have no ids and decode to ``""``; characters
outside the vocabulary become byte pieces (or one unknown id where the model has no byte
pieces); U+2581 in a text decodes to a space, as in the library; repeated rows are encoded
one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import pieces as runs

SPACE = "▁"
#: encoded parts, and judged pairs of pieces, kept in a worker
CACHE = 600_000
_UNKNOWN_PENALTY = 10.0

_codecs: dict[str, "Codec"] = {}


class Codec:
    """Encoder and decoder over one SentencePiece model file."""

    def __init__(self, path: str | None = None, proto: bytes | None = None, kind: str = "bpe"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(**({"model_proto": proto} if proto else {"model_file": path}))
        self.kind, self.normalize, n = kind, sp.normalize, sp.vocab_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.id = {self.piece[i]: i for i in plain}
        self.cost = {p: -self.score[i] for p, i in self.id.items()}
        self.low = min((self.score[i] for i in plain), default=0.0) - _UNKNOWN_PENALTY
        self.prefix = self.normalize("a").startswith(SPACE)
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.ties = re.compile("$^")
        usable = plain
        if kind == "bpe":
            count: dict[float, int] = {}
            for i in plain:
                count[self.score[i]] = count.get(self.score[i], 0) + (len(self.piece[i]) > 1)
            tied = sorted((self.piece[i] for i in plain if len(self.piece[i]) > 1 and count[self.score[i]] > 1), key=len)
            short = [p for k, p in enumerate(tied) if not any(q in p for q in tied[:k])]
            if short:
                self.ties = re.compile("|".join(map(re.escape, short)))
            usable = [i for i in plain if self.merge(self.piece[i]) == [i]]
        self.automaton = ahocorasick.Automaton()
        for i in usable:
            self.automaton.add_word(self.piece[i], (i, len(self.piece[i])))
        self.automaton.make_automaton()

    def merge(self, text: str) -> list[int]:
        """BPE by its definition: merge the best-scored pair, leftmost first, until none is left."""
        return self._merge_short(text) if len(text) <= 64 else self._merge_long(text)

    def _merge_short(self, text: str) -> list[int]:
        part, cost, never = list(text), self.cost.get, float("inf")
        costs = [cost(a + b, never) for a, b in zip(part, part[1:])]
        while costs:
            least = min(costs)
            if least == never:
                break
            k = costs.index(least)
            joined = part[k] + part[k + 1]
            part[k:k + 2] = [joined]
            del costs[k]
            if k:
                costs[k - 1] = cost(part[k - 1] + joined, never)
            if k < len(costs):
                costs[k] = cost(joined + part[k + 1], never)
        return [i for p in part for i in self._ids(p)]

    def _merge_long(self, text: str) -> list[int]:
        part: list[str | None] = list(text)
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if 0 <= a and b < len(part):
                joined = part[a] + part[b]
                if (i := self.id.get(joined)) is not None:
                    heapq.heappush(heap, (-self.score[i], a, b, joined))

        for k in range(len(part) - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if part[a] is None or part[b] is None or right[a] != b or part[a] + part[b] != joined:
                continue
            part[a], part[b] = joined, None
            right[a] = right[b]
            if right[b] < len(part):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [i for p in part if p is not None for i in self._ids(p)]

    def _ids(self, p: str) -> list[int]:
        i = self.id.get(p)
        return self._outside(p) if i is None else [i]

    def _outside(self, p: str) -> list[int]:
        return [self.byte[b] for b in p.encode("utf-8", "replace")] if self.byte else [self.unknown]

    def _pair(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(self.piece[a] + self.piece[b]) == [a, b]
        return got

    def _walk(self, part: str, last: list[int], size: list[int]) -> list[int]:
        out: list[list[int]] = []
        k = len(part)
        while k:
            n = size[k]
            if last[k] >= 0:
                out.append([last[k]])
            elif self.byte or not (k - n and last[k - n] < 0):
                out.append(self._outside(part[k - n:k]))
            k -= n
        return [i for ids in reversed(out) for i in ids]

    def _bpe(self, part: str) -> list[int]:
        """One pass; ``last[k]`` is the last piece of the first ``k`` characters (-1: a character that is no piece)."""
        if self.ties.search(part):
            return self.merge(part)
        n = len(part)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        pair = self._pair
        for end, (i, m) in self.automaton.iter(part):
            k = end + 1
            if size[k]:
                continue
            a = k - m
            if a and not size[a]:
                size[a] = 1
            if a == 0 or last[a] < 0 or pair(last[a], i):
                last[k], size[k] = i, m
        for k in range(1, n + 1):
            size[k] = size[k] or 1
        return self._walk(part, last, size)

    def _unigram(self, part: str) -> list[int]:
        """One pass; ``best[k]`` is the highest score of the first ``k`` characters."""
        n = len(part)
        best, last, size = [0.0] + [float("-inf")] * n, [-1] * (n + 1), [0] * (n + 1)
        at = 0

        def close(upto: int) -> None:
            nonlocal at
            while at < upto:
                at += 1
                if not single[at]:
                    score = best[at - 1] + self.low
                    if score > best[at]:
                        best[at], last[at], size[at] = score, -1, 1

        single = [False] * (n + 1)
        for k, c in enumerate(part):
            single[k + 1] = c in self.id
        for end, (i, m) in self.automaton.iter(part):
            k = end + 1
            close(end)
            score = best[k - m] + self.score[i]
            # equal sums: the longer first piece wins, as it is found first from the left
            if score > best[k]:
                best[k], last[k], size[k] = score, i, m
        close(n)
        return self._walk(part, last, size)

    def _part(self, part: str) -> tuple[int, ...]:
        if len(self.known) >= CACHE:
            self.known.clear()
        got = tuple(self._bpe(part) if self.kind == "bpe" else self._unigram(part))
        if len(part) <= 64:
            self.known[part] = got
        return got

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = self.normalize(text)
        if not self.cuts:
            return list(self._part(text))
        if SPACE * 2 in text or not text.startswith(SPACE):
            parts = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)
        else:
            parts = [SPACE + w for w in text.split(SPACE)[1:]]
        out: list[int] = []
        known = self.known
        for p in parts:
            ids = known.get(p)
            out += self._part(p) if ids is None else ids
        return out

    def decode(self, ids) -> str:
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.piece[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def codec(name: str, kind: str) -> Codec:
    """The codec of a file that Spark has sent here, made once in a worker."""
    if (name, kind) not in _codecs:
        _codecs[name, kind] = Codec(SparkFiles.get(name), kind=kind)
    return _codecs[name, kind]


def _named(spark, model: str) -> str:
    spark.sparkContext.addFile(model)
    return model.rsplit("/", 1)[-1]


def _encoded(key: pa.Array, ids: list[list[int]], id_col: str, exact: list[bool] | None = None) -> pa.RecordBatch:
    n = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate([np.array(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
    columns = [key, pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(n)]
    names = [id_col, "ids", "n_pieces"]
    if exact is not None:
        columns, names = [*columns, pa.array(exact, pa.bool_())], [*names, "exact"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def encode(docs: DataFrame, model: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids`` (array of int) and ``n_pieces``."""
    name = _named(docs.sparkSession, model)
    kept = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))

    def run(batches):
        c = codec(name, kind)
        for batch in batches:
            for a, b, _, _ in runs(batch.column(1)):
                ids = [c.encode(t or "") for t in batch.column(1).slice(a, b - a).to_pylist()]
                yield _encoded(batch.column(0).slice(a, b - a), ids, id_col)

    return kept.mapInArrow(run, f"{id_col} {kept.schema[id_col].dataType.simpleString()}, ids array<int>, n_pieces long")


def decode(encoded: DataFrame, model: str, kind: str = "bpe", ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the decoded text of its ids (null ids: ``""``) as ``text_col``."""
    from pyspark.sql.types import StringType, StructType

    name = _named(encoded.sparkSession, model)
    encoded = encoded.select(*[c for c in encoded.columns if c != text_col])
    schema = StructType(list(encoded.schema.fields)).add(text_col, StringType())
    at = encoded.columns.index(ids_col)

    def run(batches):
        c = codec(name, kind)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                ids = part.column(at)
                offsets, flat = np.asarray(ids.offsets), ids.values.to_numpy(zero_copy_only=False)
                text = [c.decode(flat[x:y].tolist()) for x, y in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids``, ``n_pieces``, and ``exact``: whether the ids decode to the
    text (with U+2581 read as a space).  The text is compared where it is encoded, so it is not joined back."""
    name = _named(docs.sparkSession, model)
    kept = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))

    def run(batches):
        c = codec(name, kind)
        for batch in batches:
            for a, b, _, _ in runs(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                ids = [c.encode(t) for t in texts]
                exact = [c.decode(i) == t.replace(SPACE, " ") for t, i in zip(texts, ids)]
                yield _encoded(batch.column(0).slice(a, b - a), ids, id_col, exact)

    return kept.mapInArrow(run, f"{id_col} {kept.schema[id_col].dataType.simpleString()}, ids array<int>, n_pieces long, exact boolean")
