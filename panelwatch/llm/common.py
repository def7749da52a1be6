"""Shared helpers: staged tables in the shared folder, and vectorised word
handling of Arrow text batches (no per-row Python).

Words are found on the UTF-8 bytes.  Both word definitions used by the
operators only exclude ASCII characters, and every byte of a non-ASCII
character is >= 0x80, so the byte view gives exactly the same words as the
character view.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from panelwatch.session import scratch_path

#: bytes of text handled at once inside a task; one longer text is a piece alone
PIECE_BYTES = 2 << 20

#: bytes hashed at once
STEP_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: words `[^\x20\x09-\x0D]+`
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
ALNUM_WORDS = np.ones(256, dtype=bool)
ALNUM_WORDS[0x00:0x30] = False
ALNUM_WORDS[0x3A:0x61] = False
ALNUM_WORDS[0x7B:0x80] = False

_rng = np.random.default_rng(20240613)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 - 2  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
_staged: list[tuple[SparkSession, str]] = []


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) below the shared checkpoint folder and read it
    back.  This cuts the lineage, and survives the loss of executors.  The files go with :func:`drop_stages`."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    if not _staged:
        atexit.register(drop_stages)
    _staged.append((spark, path))
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages() -> None:
    """Delete all tables staged so far; called when the driver's process ends, and by a long-lived driver once
    the results that read them are written."""
    while _staged:
        spark, path = _staged.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except (Py4JError, AttributeError, OSError):  # the session ended before: nothing can be deleted through it
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < max(n, 1):
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column at text ends into runs of at most ``most`` bytes (a
    longer text is a run alone).  Yields (first row, end row, bytes, offsets
    of the rows in these bytes).  Null counts as empty."""
    if len(column) == 0:
        return
    column = pc.fill_null(column, "")
    if column.offset:
        column = pa.concat_arrays([column])
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Words:
    """The words of a run of texts: byte spans and 64-bit hashes.

    ``first[i]:first[i+1]`` are the words of text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        inside = is_word[self.data]
        n = len(inside)
        before, after = np.empty(n, bool), np.empty(n, bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            before[offsets[:-1][offsets[:-1] < n]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, *heads: int):
        """A 64-bit polynomial hash of each word's bytes, mixed; with ``heads``
        a list: that, and the hashes of the words' first so many bytes.

        Works through the bytes in steps, so the working memory does not
        grow with the run (a longer word is a step alone)."""
        out = [np.empty(len(self.starts), np.uint64) for _ in range(1 + len(heads))]
        a = 0
        while a < len(self.starts):
            lo = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, lo + STEP_BYTES, side="right")))
            starts, ends = self.starts[a:b] - lo, self.ends[a:b] - lo
            n = int(ends[-1])
            up, down = powers(n)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data[lo:lo + n]] * up[:n], out=total[1:])
            for made, end in zip(out, (ends, *[np.minimum(ends, starts + k) for k in heads])):
                made[a:b] = mixed((total[end] - total[starts]) * down[starts])
            a = b
        return out if heads else out[0]

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def text(self, k: int) -> str:
        return self.data[self.starts[k]:self.ends[k]].tobytes().decode("utf-8", "replace")


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of ``size`` consecutive words of a text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h += hashes[j:j + n] * _MIX[j]
    at = np.flatnonzero(owner[:n] == owner[size - 1:])
    return at, mixed(h[at])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their offsets by
    text.  A text of fewer words has its whole sequence as one shingle; one
    without words has none."""
    hashes, owner = words.hashes(), words.owner()
    at, h = windows(hashes, owner, size)
    who = owner[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = words.counts[short] > j
            extra[has] += hashes[words.first[short[has]] + j] * _MIX[j]
        extra = mixed(extra ^ mixed(words.counts[short].astype(np.uint64)))
        who, h = np.concatenate([who, short]), np.concatenate([h, extra])
    order = np.lexsort((h, who))
    who, h = who[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    who, h = who[keep], h[keep]
    return h, np.searchsorted(who, np.arange(len(words.counts) + 1))


def by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over ``first[i]:first[i+1]`` (0 where empty)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
