"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count).  A
run digests every text, keeps one text for each digest, leaves out those that the
cache has for this tokenizer version, encodes the rest, appends their
counts, and joins the counts back on the digest.  The normal form of a content
is its text with null as empty; nothing else may be normalised without changing counts.

One text for each digest is kept by an aggregate that works before the shuffle
too, so a large group of copies sends at most one text per task.  The join back has a row per
document, without text; Spark's skew handling splits a hot digest there once its partition exceeds the session's threshold.

Edge cases: null and empty texts have no tokens; repeated rows each get their
count; an empty table gives an empty table and appends nothing; columns
other than id and text are ignored.  Special strings inside a text are
handled as the tokenizer library does by default.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm.common import by_text, pieces
from panelwatch.session import scratch_path

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
#: counts of distinct parts kept in a worker
WORD_CACHE = 800_000
#: bytes of text whose parts are looked up together
LOOKUP_BYTES = 4 << 20
#: ASCII white space in the widest sense, and lead bytes of characters that may be white space beyond ASCII (fixed values)
WHITE = np.zeros(256, dtype=bool)
WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
WIDE_WHITE = np.zeros(256, dtype=bool)
WIDE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_loaded: dict[str, tuple] = {}


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _tokenizer(name: str):
    if name not in _loaded:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(SparkFiles.get(name))
        t.no_truncation()
        t.no_padding()
        _loaded[name] = (t, {}, _is_cuttable(t))
    return _loaded[name]


def _is_cuttable(t) -> bool:
    """Whether the tokenizer splits at the places of ``cuts`` (a byte-level
    one with its regular expression and no normaliser)."""
    import json

    d = json.loads(t.to_str())
    p = d.get("pre_tokenizer") or {}
    return not d.get("normalizer") and p.get("type") == "ByteLevel" and p.get("use_regex", True) and not p.get("add_prefix_space") \
        and not any(" " in a["content"] or a["lstrip"] or a["rstrip"] for a in d.get("added_tokens", []))


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of single spaces between two characters that are surely no white space.

    Such a space always starts a new pre-token (pre-tokens hold white space at their start or alone), so a text
    may be cut there and its parts encoded one by one.  Next to a character that may be white space
    beyond ASCII (by its lead byte) no cut is made; the part is longer then, the count the same."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[1:-1] == 0x20) + 1
    before, after = data[at - 1], data[at + 1]
    fine = ~WHITE[before] & ~WHITE[after] & ~WIDE_WHITE[after]
    wide = before >= 0x80  # the lead byte is one or two (or three) bytes further back
    fine &= ~(wide & (WIDE_WHITE[data[np.maximum(at - 2, 0)]] | WIDE_WHITE[data[np.maximum(at - 3, 0)]]))
    return at[fine]


def _known_counts(parts: list[bytes], t, known: dict[bytes, int]) -> np.ndarray:
    """Tokens of distinct parts; those not met before are encoded."""
    if len(known) > WORD_CACHE:
        known.clear()
    new = [p for p in parts if p not in known]
    for a in range(0, len(new), 10_000):
        some = new[a:a + 10_000]
        known.update(zip(some, [len(e.ids) for e in t.encode_batch([p.decode() for p in some], add_special_tokens=False)]))
    return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))


def count_column(column: pa.Array, name: str) -> np.ndarray:
    """Tokens of each whole text of a column, without special tokens added.

    The parts of all texts of a run are one Arrow column over the text bytes; equal parts are found there,
    byte for byte, and only distinct ones are looked up or encoded."""
    t, known, cuttable = _tokenizer(name)
    if not cuttable:
        texts = pc.fill_null(column, "").to_pylist()
        return np.array([len(e.ids) for a in range(0, len(texts), 256) for e in t.encode_batch(texts[a:a + 256], add_special_tokens=False)], np.int64)
    out = np.zeros(len(column), np.int64)
    for a, b, data, offsets in pieces(column, LOOKUP_BYTES):
        inside = cuts(data)
        inside = inside[~np.isin(inside, offsets) & ~np.isin(inside + 1, offsets)]  # a text's first or last character is no cut
        starts = np.union1d(inside, offsets)
        first = np.searchsorted(starts, offsets)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        counts = _known_counts(parts.dictionary.to_pylist(), t, known)
        out[a:b] = by_text(counts[np.asarray(parts.indices)], first)
    return out


def count_tokens(texts: list[str], name: str) -> list[int]:
    """Tokens of each whole text, without special tokens added."""
    return count_column(pa.array(texts, pa.string()), name).tolist()


def cache_path(spark: SparkSession, name: str = "token-counts") -> str:
    """Default place of the cache, in the shared folder."""
    return scratch_path(spark, f"llm-cache-{name}")


def _read_cache(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version).select("digest", "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: UTF-8 bytes, tokens, and whether they exceed ``limit``."""
    spark = docs.sparkSession
    name = tokenizer.rsplit("/", 1)[-1]
    spark.sparkContext.addFile(tokenizer)
    version = tokenizer_digest(tokenizer)
    keyed = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("text", 256)))
    found = _read_cache(spark, cache, version)
    texts = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    if found is not None:
        # a concurrent or repeated append may have stored a digest twice
        found = found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        texts = texts.join(found.select("digest"), "digest", "left_anti")

    def encode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count_column(batch.column(1), name), pa.int64())], names=["digest", "n_tokens"])

    new = texts.mapInArrow(encode, "digest binary, n_tokens long")
    new.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = _read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = keyed.select(id_col, "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
