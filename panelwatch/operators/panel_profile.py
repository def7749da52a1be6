"""Packed profiles of a panel: the counts of ``drift.panel_counts`` with the values of a column kept as arrays.

A cell table has a row for each (period, column, value), which is about one row for each row and column of the panel
where values seldom repeat.  A profile holds the same counts in few rows: a task takes :data:`CHUNK_ROWS` rows at a
time, sorts each column inside each period and writes one row per (period, role, column, label), with the distinct values
and their counts as arrays of bytes.  Rows of different chunks add up, so a value may occur in several rows of a key.

``n`` counts the rows, ``known`` those with a value and ``points`` the distinct values.  ``marks`` holds every
:data:`MARK_STEP`-th value of a task's points of a column; quantiles of the marks cut the values into ranges of about equal size.
:func:`place` sends each range of each column to one task, which adds up equal points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: what a cell tells about: a numeric or categorical column, or the row itself (its score and label)
NUMERIC, CATEGORICAL, ROWS = "numeric", "categorical", "rows"

#: rows that a task counts at a time, and points that it holds at a time
CHUNK_ROWS = 1 << 21
#: bytes of rows that a task holds at most before it counts them
CHUNK_BYTES = 1 << 28
#: points that a mark stands for
MARK_STEP = 1 << 10

_BODY = ("role string, column string, label int, n long, known long, points long, marks array<double>, values binary, counts binary, "
         "texts array<string>, text_counts array<long>")
_KINDS = {"role": pa.string(), "column": pa.string(), "label": pa.int32(), "n": pa.int64(), "known": pa.int64(), "points": pa.int64(),
          "marks": pa.list_(pa.float64()), "values": pa.binary(), "counts": pa.binary(), "texts": pa.list_(pa.string()),
          "text_counts": pa.list_(pa.int64())}


def is_profile(cells: DataFrame) -> bool:
    """Whether ``cells`` are packed (:func:`panel_profile`) or one row per value (``drift.panel_counts``)."""
    return "text_counts" in cells.columns


def profile_type(name: str, kind: T.DataType) -> T.StructType:
    """Columns of a profile whose periods are in ``name``, of type ``kind``."""
    return T.StructType([T.StructField(name, kind), *T.StructType.fromDDL(_BODY).fields])


def _gathered(batches):
    """The rows of a task in tables of about ``CHUNK_ROWS`` rows."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Whole numbers of the values of a column (a null is a value) and the values."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.unify_dictionaries()
        return np.concatenate([c.indices.to_numpy() for c in coded.chunks]).astype(np.int64), coded.chunk(0).dictionary
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _distinct(value: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and the sums of their counts (default: one each)."""
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    if n is None:
        return value[first], np.diff(first, append=len(value))
    return value[first], np.add.reduceat(n, first) if len(first) else n[:0]


class _Marks:
    """Every ``step``-th point of each column, over all rows that a task writes."""

    def __init__(self, step: int):
        self.step, self.seen = step, {}

    def of(self, column, value: np.ndarray) -> np.ndarray:
        before = self.seen.get(column, 0)
        self.seen[column] = before + len(value)
        return value[-before % self.step::self.step]


def _rows(period: str, periods: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([periods, *[pa.array([r.get(c) for r in rows], t) for c, t in _KINDS.items()]], names=[period, *_KINDS])


def _points(value: np.ndarray, n: np.ndarray, marks: np.ndarray) -> dict:
    return {"points": len(value), "marks": marks, "values": value.astype(np.float64).tobytes(), "counts": n.astype(np.int64).tobytes()}


def _profiler(period: str, numeric: Sequence[str], categorical: Sequence[str], step: int):
    def run(batches):
        marks = _Marks(step)
        for table in _gathered(batches):
            of, names = _codes(table.column("p"))
            label, labels = _codes(table.column("y"))
            of = of * len(labels) + label
            order = np.argsort(of.astype(np.min_scalar_type(len(names) * len(labels))), kind="stable")  # two bytes are sorted in one pass
            ends = np.bincount(of, minlength=len(names) * len(labels)).cumsum()
            starts = np.concatenate([[0], ends[:-1]])
            months = list(zip(starts[::len(labels)], ends[len(labels) - 1::len(labels)]))
            per_label = [(k // len(labels), labels[k % len(labels)].as_py(), a, b) for k, (a, b) in enumerate(zip(starts, ends)) if b > a]
            per_month = [(t, None, a, b) for t, (a, b) in enumerate(months)]
            wanted = [(NUMERIC, c, f"v{i}", per_month) for i, c in enumerate(numeric)] + [(ROWS, "", "z", per_label)]
            for role, column, source, parts in wanted:
                value = table.column(source).to_numpy()[order] + 0.0  # no negative zero; nulls are NaN
                rows = []
                for _, name, a, b in parts:
                    part = np.sort(value[a:b])  # NaN comes last
                    part = part[:len(part) - int(np.isnan(part).sum())]
                    v, n = _distinct(part)
                    rows.append({"role": role, "column": column, "label": name, "n": b - a, "known": len(part), **_points(v, n, marks.of((role, column), v))})
                yield _rows(period, names.take(pa.array([p[0] for p in parts])), rows)
            for i, column in enumerate(categorical):
                code, texts = _codes(table.column(f"t{i}"))
                code = (of // len(labels)) * len(texts) + code
                kinds, n = np.unique(code, return_counts=True)
                missing = np.array([x is None for x in texts.to_pylist()])[kinds % len(texts)]
                kinds, n = kinds[~missing], n[~missing]
                cut = np.searchsorted(kinds // len(texts), np.arange(len(names) + 1))
                rows = [{"role": CATEGORICAL, "column": column, "n": b - a, "known": int(n[x:y].sum()), "points": y - x,
                         "texts": texts.take(pa.array(kinds[x:y] % len(texts))).to_pylist(), "text_counts": n[x:y]}
                        for (a, b), x, y in zip(months, cut[:-1], cut[1:])]
                yield _rows(period, names, rows)

    return run


def panel_profile(df: DataFrame, period: str, numeric: Sequence[str], categorical: Sequence[str],
                  rank: str | None = None, target: str | None = None) -> DataFrame:
    """The counts of ``drift.panel_counts`` as packed rows ``(period, role, column, label, n, known, points, ...)``,
    from one pass over the rows."""
    def number(c):
        return F.lit(None).cast("double") if c is None else F.col(c).cast("double")

    sent = [F.col(period).alias("p"), *[number(c).alias(f"v{i}") for i, c in enumerate(numeric)],
            *[F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(categorical)], number(rank).alias("z"),
            (F.lit(None) if target is None else F.col(target)).cast("int").alias("y")]
    return df.select(*sent).mapInArrow(_profiler(period, list(numeric), list(categorical), MARK_STEP), profile_type(period, df.schema[period].dataType))


def merge_rows(profile: DataFrame, period: str) -> DataFrame:
    """Profile rows of one key in one task added up, as far as :data:`CHUNK_ROWS` points at a time allow."""
    kind, step = profile.schema[period].dataType, MARK_STEP

    def run(batches):
        marks, held, size, arrow = _Marks(step), {}, 0, None

        def flush():
            rows = []
            for (_, role, column, label), parts in held.items():
                row = {"role": role, "column": column, "label": label, "n": sum(p["n"] for p in parts), "known": sum(p["known"] for p in parts)}
                if role == CATEGORICAL:
                    counts: dict = {}
                    for p in parts:
                        for text, n in zip(p["texts"], p["text_counts"]):
                            counts[text] = counts.get(text, 0) + n
                    row |= {"points": len(counts), "texts": list(counts), "text_counts": list(counts.values())}
                else:
                    value, n = (np.concatenate([np.frombuffer(p[c], t) for p in parts]) for c, t in (("values", np.float64), ("counts", np.int64)))
                    order = np.argsort(value, kind="stable")
                    value, n = _distinct(value[order], n[order])
                    row |= _points(value, n, marks.of((role, column), value))
                rows.append(row)
            return _rows(period, pa.array([k[0] for k in held], arrow), rows)

        for batch in batches:
            arrow = batch.schema.field(period).type
            for p in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                held.setdefault((p[period], p["role"], p["column"], p["label"]), []).append(p)
                size += p["points"]
                if size >= CHUNK_ROWS:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return profile.mapInArrow(run, profile_type(period, kind))


def text_counts(profile: DataFrame, period: str) -> DataFrame:
    """``(period, column, value, n)`` of the categorical columns of a profile, one row per value."""
    pairs = F.explode(F.arrays_zip("texts", "text_counts")).alias("p")
    return (profile.where(F.col("role") == CATEGORICAL).select(period, "column", pairs)
            .groupBy(period, "column", F.col("p.texts").alias("value")).agg(F.sum("p.text_counts").alias("n")))


#: a run of one column: its points by (period, value) as arrays of bytes, and what is summed of each of its periods
RUNS = ("run int, column int, times array<int>, stops array<long>, n array<long>, sums array<double>, low array<double>, high array<double>, "
        "values binary, counts binary")


def pack_runs(run: int, column: np.ndarray, time: np.ndarray, value: np.ndarray, n: np.ndarray):
    """Points of one range as one row for each column; equal points are added up."""
    if not len(value):
        return
    order = np.argsort(value)
    owner = column[order].astype(np.int64) * (int(time.max()) + 1) + time[order]
    owner = owner.astype(np.min_scalar_type(int(owner.max())))  # two bytes are sorted in one pass
    order = order[np.argsort(owner, kind="stable")]
    column, time, value, n = column[order], time[order], value[order], n[order]
    new = np.concatenate([[True], (column[1:] != column[:-1]) | (time[1:] != time[:-1])])
    point = np.flatnonzero(new | np.concatenate([[True], value[1:] != value[:-1]]))
    if len(point) < len(value):
        column, time, value, n, new = column[point], time[point], value[point], np.add.reduceat(n, point), new[point]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(value))
    totals, sums = np.add.reduceat(n, first), np.add.reduceat(n * value, first)
    of = column[first]
    for c in np.unique(of):
        k = np.flatnonzero(of == c)
        x, y = first[k[0]], last[k[-1]]
        row = [[run], [int(c)], [time[first[k]]], [last[k] - x], [totals[k]], [sums[k]], [value[first[k]]], [value[last[k] - 1]],
               [value[x:y].tobytes()], [n[x:y].tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 3, pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)],
                                         names=["run", "column", "times", "stops", "n", "sums", "low", "high", "values", "counts"])


def _cutter(cuts: dict, offset: dict):
    """Points of profile rows as one row for each range of each column, numbered over all columns."""
    def flush(held):
        for c, parts in held.items():
            time = np.repeat(np.array([t for t, _, _ in parts], np.int32), [len(v) for _, v, _ in parts])
            value, n = np.concatenate([v for _, v, _ in parts]), np.concatenate([n for _, _, n in parts])
            at = np.searchsorted(cuts[c], value, side="right")
            order = np.argsort(at.astype(np.min_scalar_type(len(cuts[c]))), kind="stable")
            time, value, n = time[order], value[order], n[order]
            ends = np.bincount(at, minlength=len(cuts[c]) + 1).cumsum()
            used = [(k, a, b) for k, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([offset[c] + k for k, _, _ in used], pa.int32()), pa.array([c] * len(used), pa.int32()),
                 *[pa.array([x[a:b].tobytes() for _, a, b in used], pa.binary()) for x in (time, value, n)]],
                names=["range", "column", "times", "values", "counts"])

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            columns, times, values, counts = (batch.column(c) for c in ("__column", "__time", "values", "counts"))
            for c, t, v, n in zip(columns.to_pylist(), times.to_pylist(), values, counts):
                v = np.frombuffer(v.as_buffer(), np.float64)
                held.setdefault(c, []).append((t, v, np.frombuffer(n.as_buffer(), np.int64)))
                size += len(v)
                if size >= CHUNK_ROWS:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return run


def _joiner(batches):
    """The points of one range, from all tasks."""
    got = [(r.column("column")[i].as_py(), *[np.frombuffer(r.column(c)[i].as_buffer(), t) for c, t in (("times", np.int32), ("values", np.float64), ("counts", np.int64))])
           for r in batches for i in range(r.num_rows)]
    if got:
        column = np.repeat(np.array([c for c, *_ in got], np.int32), [len(v) for _, _, v, _ in got])
        time, value, n = (np.concatenate([g[k] for g in got]) for k in (1, 2, 3))
        yield from pack_runs(TaskContext.get().partitionId(), column, time, value, n)


def place(rows: DataFrame, points: dict[int, int], range_points: int) -> DataFrame:
    """The points of profile rows ``(__column, __time, marks, values, counts)`` by ranges of each column's values, packed as :data:`RUNS`.

    ``points`` holds the number of points of each column; a range holds about ``range_points``.  A value lies in one range."""
    ranges = {c: -(-k // range_points) for c, k in points.items()}
    most = max(ranges.values(), default=1)
    cuts = {c: np.zeros(0) for c in points}
    if most > 1:
        at = [float(x) for x in np.arange(1, most) / most]
        many = [c for c, k in ranges.items() if k > 1]
        # one row per column
        for r in rows.where(F.col("__column").isin(many)).select("__column", F.explode("marks").alias("mark")).groupBy("__column").agg(
                F.percentile_approx("mark", at, max(10000, 20 * most)).alias("cuts")).collect():
            k = ranges[r["__column"]]
            cuts[r["__column"]] = np.unique(np.array(r["cuts"])[np.unique(np.arange(1, k) * most // k - 1)])
    sizes = [len(cuts[c]) + 1 for c in cuts]
    offset = dict(zip(cuts, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int).tolist())) if cuts else {}
    cut = rows.select("__column", "__time", "values", "counts").mapInArrow(_cutter(cuts, offset), "range int, column int, times binary, values binary, counts binary")
    return cut.repartitionById(max(1, sum(sizes)), "range").mapInArrow(_joiner, RUNS)
