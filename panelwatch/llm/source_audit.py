"""Source divergence audit over the terms that enough documents of a language share.

The kept terms come from an iceberg refinement of byte prefixes.  One pass over the texts writes an
index: for each block of texts and language one row, which packs the terms, the documents of the block that hold each
(two bytes a document), and its occurrences by source.  Then prefixes grow level by level (6, 12, 24, ... bytes).  A level counts the distinct
documents of each prefix, block by block (a document with several terms of one prefix counts once), sums
the blocks, and discards prefixes below the threshold.  The next level extends only prefixes that
survived.  A term no longer than the level is complete: its count is its own and it is kept or
dropped there.  The levels end when no incomplete prefix is left.

Blocks learn the survivors from a bitmap of their hashes, at most ``MOST_BITS`` bits however many there are.  A
clash lets through a prefix that the next level counts and discards, so the bitmap changes the work but not the result.

The audit compares the smoothed term shares of each (language, source) group with those of every other source of the language
(part ``pair``) and of the language itself (part ``term``), in whole numbers only.  A pair's sum runs over all
kept terms, so terms are dealt into buckets and sources into tiles; a task holds the dense
shares of two tiles in one bucket, and adds terms that neither tile has as a product.

Sizes: a block is one run of texts of ``BLOCK_BYTES`` (a longer text alone), whatever its language or source, so no group
grows with a hot one.  Only ranks read one group's rows in order: its other sources, or the best ten terms that each task sends.

Edge cases: every row is a document (repeated rows and rows with null or equal ids count each); null text, language
and source read as ''; a language without kept terms has pairs of value 0 and no terms; a source alone in its language has
no pairs; ties are ranked by item in UTF-8 order; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.llm.common import Words, mixed, pieces, stage

#: words `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`
LETTER_WORDS = np.ones(256, dtype=bool)
LETTER_WORDS[0x00:0x41] = False
LETTER_WORDS[0x5B:0x61] = False
LETTER_WORDS[0x7B:0x80] = False

#: bytes of the first level's prefixes; each further level has twice as many
FIRST_LEVEL = 6
BLOCK_BYTES = 1 << 20
#: bytes of index rows sent to a worker at once, and rows of its results that it sums before sending them
BATCH_BYTES = 8 << 20
MERGED = 2_000_000
#: texts of a block, so that two bytes number them
BLOCK_TEXTS = 50_000
#: leading bytes that a term's or prefix's hash reads (with its length)
HASHED = 64
#: bounds of the bitmap of survivors
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: kept terms in a bucket and sources in a tile, about
BUCKET_TERMS = 2048
TILE_SOURCES = 256
SCALE = 1_000_000_000

#: per term: bytes, documents, sources (u4); concatenated: letters, documents (u2), sources (u2), occurrences (u4)
INDEX = "lang string, letters binary, sizes binary, n_docs binary, docs binary, names array<string>, n_found binary, sources binary, found binary"
LEVEL = "lang string, prefix binary, done boolean, n long"
COUNTS = "lang string, source string, term binary, n long"


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of bytes as an Arrow column."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(runs: pa.Array) -> np.ndarray:
    """All bytes of a large binary column, one run after the other."""
    _, offs, data = runs.buffers()
    ends = np.frombuffer(offs, np.int64)[runs.offset:runs.offset + len(runs) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)


def _block_terms(langs: pa.Array, sources: pa.Array, data: np.ndarray, offsets: np.ndarray):
    """The index rows of one block of texts, one for each language."""
    words = Words(data, offsets, LETTER_WORDS)
    if not len(words):
        return
    coded = _binaries(words.data[LETTER_WORDS[words.data]], words.ends - words.starts).dictionary_encode()
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    names, n_names, n_texts = sources.dictionary, len(sources.dictionary), len(langs)
    owner, terms = words.owner(), np.asarray(coded.indices, np.int64)
    lang, source = np.asarray(langs.indices)[owner], np.asarray(sources.indices, np.int64)[owner]
    for code, name in enumerate(langs.dictionary.to_pylist()):
        mine = np.flatnonzero(lang == code)
        if not len(mine):
            continue
        held = np.unique(terms[mine] * n_texts + owner[mine])
        ids, n_docs = np.unique(held // n_texts, return_counts=True)
        by, n = np.unique(terms[mine] * n_names + source[mine], return_counts=True)
        own = coded.dictionary.take(pa.array(ids))
        yield {
            "lang": name, "letters": _bytes(own).tobytes(), "sizes": np.asarray(pc.binary_length(own)).astype("<u4").tobytes(),
            "n_docs": n_docs.astype("<u4").tobytes(), "docs": (held % n_texts).astype("<u2").tobytes(), "names": names.to_pylist(),
            "n_found": np.unique(by // n_names, return_counts=True)[1].astype("<u4").tobytes(), "sources": (by % n_names).astype("<u2").tobytes(),
            "found": n.astype("<u4").tobytes()}


def term_index(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """For each block and language: its terms, the documents holding each, and its occurrences by source."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
                        F.col(text_col).alias("text"))
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith(" string") else pa.list_(pa.string()) if "array" in x else pa.binary())
                        for x in INDEX.split(", ")])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TEXTS):
                part = batch.slice(at, BLOCK_TEXTS)
                for a, b, data, offsets in pieces(part.column(2), BLOCK_BYTES):
                    for row in _block_terms(part.column(0).slice(a, b - a), part.column(1).slice(a, b - a), data, offsets):
                        yield pa.RecordBatch.from_pylist([row], schema=schema)

    # zstd: the default codec keeps buffers of the size of the largest values outside the heap
    return stage(texts.mapInArrow(run, INDEX), "audit-index", compression="zstd")


class Block:
    """The unpacked terms of one index row."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.batch, self.row = batch, row
        self.lang = batch.column("lang")[row].as_py()
        self.letters, self.sizes = self.numbers("letters", "u1"), self.numbers("sizes", "<u4").astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def numbers(self, name: str, kind: str) -> np.ndarray:
        return np.frombuffer(self.batch.column(name)[self.row].as_buffer(), kind)

    def terms(self, pick: np.ndarray) -> pa.Array:
        """The picked terms (a mask) as an Arrow column."""
        return _binaries(self.letters[np.repeat(pick, self.sizes)], self.sizes[pick]).cast(pa.binary())


def _hashes(lang: str, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs (the first ``HASHED`` bytes and the length) of one language."""
    h = np.full(len(starts), zlib.crc32(lang.encode()), np.uint64)
    data = np.concatenate([letters, np.zeros(8, np.uint8)])
    for at in range(0, min(HASHED, int(sizes.max(initial=0))), 8):
        on = np.flatnonzero(sizes > at)
        part = data[(starts[on] + at)[:, None] + np.arange(8)]
        part[np.arange(8) >= (sizes[on] - at)[:, None]] = 0
        h[on] = mixed(h[on] ^ part.view("<u8").ravel())
    return mixed(h + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _run_hashes(lang: pa.Array, runs: pa.Array) -> np.ndarray:
    """The same hashes of a column of byte runs beside a column of languages."""
    out = np.zeros(len(runs), np.uint64)
    lang = lang.dictionary_encode()
    codes, runs = np.asarray(lang.indices), runs.cast(pa.large_binary())
    for code, name in enumerate(lang.dictionary.to_pylist()):
        pick = codes == code
        mine = runs.filter(pa.array(pick))
        sizes = np.asarray(pc.binary_length(mine))
        out[pick] = _hashes(name, _bytes(mine), np.cumsum(sizes) - sizes, sizes)
    return out


def _bitmap(survivors: DataFrame, n: int) -> np.ndarray:
    """A bitmap of the hashes of ``survivors`` (lang, bytes), a power of two of bits."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))

    def places(batches):
        for batch in batches:
            at = _run_hashes(batch.column(0), batch.column(1)) & np.uint64(size - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + 1)], names=["at"])

    rows = survivors.mapInArrow(places, "at long").groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in rows.toLocalIterator():  # at most MOST_BITS bits in all
        bits = np.frombuffer(r.bits, np.uint8)
        out[(r.part - 1) * len(bits):r.part * len(bits)] = bits
    return out


def _in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _prefix_documents(block: Block, size: int, bits: np.ndarray | None) -> pa.Table:
    """Documents of one block by prefix of ``size`` bytes, and by term where the term is no longer.
    ``bits``: the surviving prefixes of half the size."""
    pick = np.ones(len(block.sizes), bool)
    if bits is not None:
        long = np.flatnonzero(block.sizes > size // 2)
        pick[:] = False
        pick[long[_in_bitmap(bits, _hashes(block.lang, block.letters, block.starts[long], np.full(len(long), size // 2)))]] = True
    counts = block.numbers("n_docs", "<u4").astype(np.int64)
    done, open_ = pick & (block.sizes <= size), pick & (block.sizes > size)
    cut = pc.binary_slice(block.terms(open_), 0, size).dictionary_encode()
    key, n = np.asarray(cut.indices, np.int64), counts[open_]
    docs = np.bincount(key, n, len(cut.dictionary)).astype(np.int64)
    shared = np.bincount(key, minlength=len(cut.dictionary)) > 1
    # a document may hold several terms of a prefix that several terms have
    some = shared[key]
    at = np.flatnonzero(open_)[some]
    held = np.unique((np.repeat(key[some], n[some]) << 16) + block.numbers("docs", "<u2")[_spans(np.cumsum(counts)[at] - counts[at], counts[at])])
    docs[shared] = np.bincount(held >> 16, minlength=len(docs))[shared]
    whole = block.terms(done)
    return pa.table({"lang": pa.array([block.lang] * (len(whole) + len(docs)), pa.string()), "prefix": pa.concat_arrays([whole, cut.dictionary.cast(pa.binary())]),
                     "done": pa.array(np.arange(len(whole) + len(docs)) < len(whole)), "n": pa.array(np.concatenate([counts[done], docs]))})


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of all runs of ``counts`` places from ``starts``."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


@contextmanager
def _small_batches(spark: SparkSession):
    """Index rows are large: send workers a few MB of them at a time."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _documents(batches, size: int, bits: np.ndarray | None):
    """Documents by prefix or complete term, summed over up to about ``MERGED`` rows."""
    keys, tables = ["lang", "prefix", "done"], []

    def summed():
        t = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])
        tables.clear()
        return t.combine_chunks().to_batches(max_chunksize=100_000)

    for batch in batches:
        tables += [_prefix_documents(Block(batch, row), size, bits) for row in range(batch.num_rows)]
        if sum(t.num_rows for t in tables) > MERGED:
            yield from summed()
    if tables:
        yield from summed()


def kept_terms(index: DataFrame, least: int, first_level: int = FIRST_LEVEL) -> DataFrame:
    """The terms (lang, term, n_docs) that at least ``least`` documents of their language hold, refined prefix by prefix."""
    kept, size, shared = [], first_level, None
    while True:
        def run(batches, size=size, shared=shared):
            yield from _documents(batches, size, shared and shared.value)

        counted = index.select("lang", "letters", "sizes", "n_docs", "docs").mapInArrow(run, LEVEL)
        # batches are summed already, so the rows are dealt before the sum and not summed twice
        with _small_batches(index.sparkSession):
            level = stage(counted.repartition("lang", "prefix", "done").groupBy("lang", "prefix", "done").agg(F.sum("n").alias("n_docs"))
                          .where(F.col("n_docs") >= least), f"audit-level-{size}")
        kept.append(level.where("done").select("lang", F.col("prefix").alias("term"), "n_docs"))
        survivors = level.where("NOT done").select("lang", "prefix")
        n = survivors.count()
        if not n:
            break
        shared = index.sparkSession.sparkContext.broadcast(_bitmap(survivors, n))
        size *= 2
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Found:
    """The occurrences by source of one block's terms in a bitmap."""

    terms: pa.Array
    names: pa.Array
    n: np.ndarray
    sources: np.ndarray
    found: np.ndarray

    @classmethod
    def of(cls, block: Block, bits: np.ndarray) -> Found:
        pick = _in_bitmap(bits, _hashes(block.lang, block.letters, block.starts, block.sizes))
        n = block.numbers("n_found", "<u4").astype(np.int64)
        at = _spans(np.cumsum(n)[pick] - n[pick], n[pick])
        names = pa.array(block.batch.column("names")[block.row].as_py(), pa.string())
        return cls(block.terms(pick), names, n[pick], block.numbers("sources", "<u2")[at], block.numbers("found", "<u4")[at])


def _summed(lang: str, parts: list[Found]):
    """Occurrences by term and source, summed over blocks of one language."""
    terms = pa.chunked_array([x.terms for x in parts], pa.binary()).combine_chunks().dictionary_encode()
    names = pa.chunked_array([x.names for x in parts], pa.string()).combine_chunks().dictionary_encode()
    each = np.concatenate([x.n for x in parts])
    first_name = np.cumsum([0, *[len(x.names) for x in parts]])
    source = np.concatenate([x.sources.astype(np.int64) + a for x, a in zip(parts, first_name)])
    keys = np.repeat(np.asarray(terms.indices, np.int64), each) * len(names.dictionary) + np.asarray(names.indices, np.int64)[source]
    order = np.argsort(keys, kind="stable")
    keys, starts = np.unique(keys[order], return_index=True)
    found = np.concatenate([x.found for x in parts]).astype(np.int64)[order]
    sums = np.add.reduceat(found, starts) if len(keys) else found
    for a in range(0, len(keys), 100_000):
        k = keys[a:a + 100_000]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(k), pa.string()), names.dictionary.take(pa.array(k % len(names.dictionary))),
            terms.dictionary.take(pa.array(k // len(names.dictionary))), pa.array(sums[a:a + 100_000])], names=["lang", "source", "term", "n"])


def _occurrences(batches, bits: np.ndarray):
    """Occurrences by language, source and term, summed over up to about ``MERGED`` entries."""
    by: dict[str, list[Found]] = {}
    held = 0
    for batch in batches:
        for row in range(batch.num_rows):
            block = Block(batch, row)
            by.setdefault(block.lang, []).append(Found.of(block, bits))
            held += len(by[block.lang][-1].found)
        if held > MERGED:
            for lang, parts in by.items():
                yield from _summed(lang, parts)
            by, held = {}, 0
    for lang, parts in by.items():
        yield from _summed(lang, parts)


def term_counts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences (lang, source, term, n) of the terms (lang, term)."""
    terms = terms.select("lang", "term")
    shared = index.sparkSession.sparkContext.broadcast(_bitmap(terms, terms.count()))

    def run(batches):
        yield from _occurrences(batches, shared.value)

    rows = index.select("lang", "letters", "sizes", "names", "n_found", "sources", "found").mapInArrow(run, COUNTS)
    counts = rows.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    with _small_batches(index.sparkSession):
        return stage(counts.join(terms, ["lang", "term"], "left_semi"), "audit-counts")


def _share(count, total, terms):
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact at any size; without terms nothing is summed."""
    big = "decimal(19,0)"
    return F.expr(f"1L + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as {big})) div cast(greatest({total} + 2 * {terms}, 1L) as {big})")


def _pair_sums(rows: pa.Table) -> pa.Table:
    """Partial sums of all ordered pairs of sources of two tiles, over the kept terms of one bucket.

    Rows without a term carry a source's share for terms that it lacks, and the bucket's number of terms."""
    rows = rows.combine_chunks()
    lang, i, j = (rows[c][0].as_py() for c in ("lang", "i", "j"))
    marks = np.asarray(pc.is_null(rows["term"]))
    sources, tiles = rows["source"].filter(pa.array(marks)).to_pylist(), np.asarray(rows["tile"])[marks]
    place = {s: k for k, s in enumerate(sources)}
    zero = np.asarray(rows["p"])[marks]
    few = rows.filter(pa.array(~marks))
    terms = few["term"].combine_chunks().dictionary_encode()
    n = len(terms.dictionary)
    shares = np.repeat(zero[:, None], n + 1, axis=1)  # the last column stands for terms that no source here has
    shares[[place[s] for s in few["source"].to_pylist()], np.asarray(terms.indices)] = np.asarray(few["p"])
    weight = np.ones(n + 1, np.int64)
    weight[n] = rows["terms"].filter(pa.array(marks))[0].as_py() - n
    left, right = np.flatnonzero(tiles == i), np.flatnonzero(tiles == j)
    made = {"lang": [], "source": [], "item": [], "value": []}
    for k, a in enumerate(left):
        others = right[k + 1:] if i == j else right
        gap = shares[others] - shares[a]
        value = ((gap * gap) // (shares[others] + shares[a])) @ weight
        for b, v in zip(others, value.tolist()):
            made["source"] += [sources[a], sources[b]]
            made["item"] += [sources[b], sources[a]]
            made["value"] += [v, v]
    made["lang"] = [lang] * len(made["value"])
    return pa.table(made, schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def _pairs(groups: DataFrame, terms: DataFrame, shares: DataFrame, bucket_terms: int, tile_sources: int) -> DataFrame:
    """Value of every ordered pair of sources of a language.  ``groups``: lang, source, total, v, n_sources; ``shares``: lang, source, term, p."""
    tiles = F.ceil(F.col("n_sources") / tile_sources).cast("int")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") / bucket_terms).cast("int"))
    tile = F.pmod(F.xxhash64("source"), tiles).cast("int")
    bucket = F.pmod(F.xxhash64("term"), buckets).cast("int")
    other = F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    sizes = groups.select("lang", "v", "n_sources").distinct()
    in_bucket = terms.join(sizes, "lang").groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("terms"))
    marks = (groups.select("lang", "source", F.lit(None).cast("binary").alias("term"), _share("0", "total", "v").alias("p"), "v", "n_sources",
                           F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"))
             .join(in_bucket, ["lang", "bucket"], "left").withColumn("terms", F.coalesce("terms", F.lit(0))))
    entries = shares.join(sizes, "lang").select("lang", "source", "term", "p", "v", "n_sources", bucket.alias("bucket")).withColumn("terms", F.lit(0).cast("long"))
    placed = marks.unionByName(entries).select("lang", "bucket", "source", "term", "p", "terms", tile.alias("tile"), other)
    placed = placed.select("lang", "bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "source", "term", "p", "terms")
    sums = placed.groupBy("lang", "bucket", "i", "j").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, least: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      first_level: int = FIRST_LEVEL, bucket_terms: int = BUCKET_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): all other sources of the language, and the ``top`` terms that the source has more of."""
    index = term_index(docs, text_col, lang_col, source_col)
    terms = stage(kept_terms(index, least, first_level), "audit-terms")
    counts = term_counts(index, terms)

    groups = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("v"))
    groups = groups.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_sources"), F.sum("total").alias("lang_total"))
    groups = stage(groups.join(sizes, "lang"), "audit-groups")

    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", _share("n", "total", "v").alias("p"))
    pairs = _pairs(groups, terms, shares.drop("n"), bucket_terms, tile_sources).withColumn("part", F.lit("pair"))

    langs = groups.select("lang", "v", "lang_total").distinct()
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(langs, "lang").select("lang", "term", _share("n", "lang_total", "v").alias("q"))
    more = shares.join(whole, ["lang", "term"]).where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"), F.lit("term").alias("part"))

    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs, more = pairs.withColumn("rank", rank), more.withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(more).select("lang", "source", "part", "item", "value", "rank")
