"""Sharding by Hilbert-curve order, in DataFrame and SQL functions only.

Each row's metadata dimensions are quantised to ``BITS`` bits, the cell's
index on the Hilbert curve is computed by an unrolled bit expression, the rows
are put in the order of that index and the order is cut into ``shards`` runs of
(to one row) equal length.  Rows close in all dimensions lie close on the curve, so a
shard covers a small box of the cells and a reader can skip shards by the
minimum and maximum of any quantised dimension.

The rank of a row is exact: the narrow rows (no text) are range-partitioned on
(index, tie-breaks), sorted inside their partition and written to the shared folder
with their place in it; the partitions' counts, a row for each partition, give the
offsets.  Tie-breaks include the id and the text's checksum, so a hot cell or
a large group of equal texts is split over partitions like any other run.

Law ``rows``: counts differ by one at most.  Edge cases: null dimensions fall in cell 0, a
null text has size 1 and checksum 0, repeated rows each get a slot of
their own, an empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwatch.llm.common import stage

BITS = 4


def quantised(kind: str, name: str, bits: int = BITS) -> Column:
    """Cell of a column: ``size`` by the power of two of its number, ``key`` by checksum."""
    top = (1 << bits) - 1
    if kind == "size":
        return F.least(F.length(F.bin(F.coalesce(F.col(name).cast("long"), F.lit(0)))) - 1, F.lit(top)).cast("long")
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % (top + 1), F.lit(0)).cast("long")


def hilbert_index(df: DataFrame, dims: list[str], out: str, bits: int = BITS) -> DataFrame:
    """Add the Hilbert index of the cell given by the long columns ``dims``.

    The well-known transform works from the highest bit down: it undoes the curve's
    rotations (flip the low bits of the first dimension, or swap them with its own),
    Gray-decodes, and interleaves the bits.  Each step is one projection, so that no
    expression is written out twice."""
    keep, n = df.columns, len(dims)
    x = [f"__x{i}" for i in range(n)]
    df = df.select(*keep, *[F.col(d).cast("long").alias(x[i]) for i, d in enumerate(dims)])
    for b in range(bits - 1, 0, -1):
        low = F.lit((1 << b) - 1).cast("long")
        for i in range(n):
            bit = F.shiftright(F.col(x[i]), b).bitwiseAND(F.lit(1)) == 1
            swap = F.col(x[0]).bitwiseXOR(F.col(x[i])).bitwiseAND(low)
            first = F.when(bit, F.col(x[0]).bitwiseXOR(low)).otherwise(F.col(x[0]).bitwiseXOR(swap))
            new = {x[0]: first}
            if i:
                new[x[i]] = F.when(bit, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swap))
            df = df.withColumns(new)
    for i in range(1, n):
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    turn = F.lit(0).cast("long")
    for b in range(bits - 1, 0, -1):
        turn = F.when(F.shiftright(F.col(x[n - 1]), b).bitwiseAND(F.lit(1)) == 1, turn.bitwiseXOR(F.lit((1 << b) - 1).cast("long"))).otherwise(turn)
    df = df.withColumn("__t", turn).withColumns({c: F.col(c).bitwiseXOR(F.col("__t")) for c in x})
    index = F.lit(0).cast("long")
    for b in range(bits):
        for i in range(n):
            index = index.bitwiseOR(F.shiftleft(F.shiftright(F.col(x[i]), b).bitwiseAND(F.lit(1)), b * n + (n - 1 - i)))
    return df.select(*keep, index.alias(out))


def ranked(df: DataFrame, order: list[str], out: str, name: str) -> DataFrame:
    """Add the exact global rank (from 0) of each row in ``order``, and ``n``, the row count.

    No row is collected and nothing runs in one task but the sum over the
    partitions' counts (one row for each)."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__r"))
    placed = stage(placed, name)
    counts = placed.groupBy("__p").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__o"),
                            F.sum("__n").over(Window.partitionBy()).alias("n"))
    return placed.join(F.broadcast(offsets), "__p").withColumn(out, F.col("__o") + F.col("__r")).drop("__p", "__r", "__o")


def hilbert_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   dims: tuple = (("key", "lang"), ("key", "source"), ("size", "size"))) -> DataFrame:
    """One row per input row: size, checksum, law, shard, slot in the shard, Hilbert index and cells."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    names = [c for k, c in dims if c != "size"]
    base = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text"), *[F.col(c).alias(f"__d_{c}") for c in names])
    base = base.select(id_col, *[f"__d_{c}" for c in names], (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    cells = [quantised(k, "size" if c == "size" else f"__d_{c}").alias(f"cell_{c}") for k, c in dims]
    base = base.select(id_col, "size", "text_crc32", *cells)
    base = hilbert_index(base, [f"cell_{c}" for _, c in dims], "hilbert")
    out = ranked(base, ["hilbert", id_col, "text_crc32", "size"], "__rank", "hilbert")
    shard = F.expr(f"cast(__rank * {shards} div n as int)")
    start = F.expr(f"(shard * n + {shards - 1}) div {shards}")
    return (out.withColumn("shard", shard).withColumn("slot", F.col("__rank") - start)
            .select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "hilbert", *[f"cell_{c}" for _, c in dims]))
