"""MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles.  Documents of equal
sets form one node (identified by a 128-bit digest, kept as a 64-bit key), so copies are never
expanded.  Then:

1. Every node has a minhash signature.  In each of ``TREES`` independent trees it goes down the branches
   of the minhash tokens that the tree chose there; 1 / 0.75 tokens are chosen on average, so
   a linked pair stays together on a path about once.  Spark deals the first branching, and that of
   nodes of over ``NODE`` rows, by key; inside a task the rest is branched on until it is small, and small
   branches are compared exhaustively on signatures.  A similarity over ``ZONE`` (four
   standard deviations below 0.75) makes a candidate link; of these only a spanning forest is
   passed on, so the output is linear in any group's size.
2. The connected parts of the candidate links are blocks; every true link lies within
   one.  A block's whole texts come together once, and its components under the exact rule
   (intersection and union of the full shingle sets) are found with an inverted index: a
   document is compared with all others unless it already lies in the largest
   component.  A block of more than ``BLOCK`` shingles is dealt into groups, ``ROUNDS`` times
   anew; then every document outside the block's largest component so far is compared with all of
   the block, in pairs of groups.  A link that is still missing has an end outside that component, so
   none is lost; tasks are bounded, and a block of near copies costs in proportion to its size.
3. The components of the links give each document the smallest id it reaches.

Components come from alternating star steps over staged edge tables; nothing is collected.

Recall: a pair at exactly 0.75 is missed by all trees with probability below 1e-3 (far below, where
the first branching is already small); links above, or through further documents, less often.

Edge cases: documents without words (null, empty, blank) have an empty set, are linked with nothing and kept;
repeated rows are exact copies (all rows with the smallest id are marked kept; :func:`deduplicate` keeps one);
rows that share an id but not the text, or have no id, are judged by their text: rows are told apart by id and a
digest of the text, and a null id counts as greater than any other; an empty table gives an empty table; columns
other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import SPACE_WORDS, Words, mixed, pieces, shingles, stage

SHINGLE = 5
SIGNATURE = 128
TREES = 8
#: candidate links: this many equal minhashes of ``SIGNATURE``
ZONE = 77
#: rows of a branch that one task takes, and of one that is compared exhaustively
NODE, LEAF = 4096, 64
#: further branchings dealt by Spark, and within a task
DEPTH, INNER_DEPTH = 4, 12
#: shingles of the documents compared in one task
BLOCK = 3_000_000
#: times that a larger block is dealt anew
ROUNDS = 3

_rng = np.random.default_rng(99)
_A = _rng.integers(1, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FIRST = [int(c) for t in range(TREES) for c in _rng.choice(SIGNATURE, 2 if t % 3 == 2 else 1, replace=False)]
_TREE = [t for t in range(TREES) for _ in range(2 if t % 3 == 2 else 1)]


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return shingles(Words(data, offsets, SPACE_WORDS), SHINGLE)


def _keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set, from two independent sums over it and its size."""
    n = len(first) - 1
    size = np.diff(first)
    some = np.flatnonzero(size)
    key = np.zeros(n, np.uint64)
    if len(some):
        one = np.add.reduceat(mixed(h), first[some])
        two = np.add.reduceat(mixed(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[some])
        key[some] = mixed(one ^ mixed(two + size[some].astype(np.uint64)))
    return key


def _signatures(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits of each minhash, and the keys of the first branches (full width)."""
    n = len(first) - 1
    some = np.flatnonzero(np.diff(first))
    sig, branch = np.zeros((n, SIGNATURE), np.uint16), np.zeros((n, len(_FIRST)), np.uint64)
    if not len(some):
        return sig, branch
    least = np.empty((SIGNATURE, len(some)), np.uint64)
    for k in range(SIGNATURE):
        least[k] = np.minimum.reduceat(h * _A[k], first[some])
    sig[some] = (mixed(least) >> np.uint64(48)).astype(np.uint16).T
    for k, (c, t) in enumerate(zip(_FIRST, _TREE)):
        branch[some, k] = mixed(least[c] ^ mixed(np.array([1000 * t + c + 1], np.uint64)))
    return sig, branch


def _fixed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * size), pa.py_buffer(rows)])


def _lists(rows: np.ndarray) -> pa.Array:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(rows.view(np.int64).ravel()))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest of the text, set size, key of the set, signature and first branches of every row."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest"))

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1), 1 << 20):
                h, first = _sets(data, offsets)
                sig, branch = _signatures(h, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(first).astype(np.int64)),
                     pa.array(_keys(h, first).view(np.int64)), _fixed(sig), _lists(branch)], names=["id", "digest", "n", "key", "sig", "branch"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, digest long, n long, key long, sig binary, branch array<long>")


def _choices(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a node list go on by a second token, and the chosen tokens of both rounds."""
    c = np.stack([mixed(node + np.uint64(1)) % np.uint64(SIGNATURE), mixed(node + np.uint64(2)) % np.uint64(SIGNATURE)]).astype(np.int64)
    return mixed(node + np.uint64(3)) % np.uint64(3) == 0, c


def _next(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of the branches that rows (each in ``node``) go down."""
    twice, c = _choices(node)
    rows = np.arange(len(node))
    second = np.flatnonzero(twice & (c[0] != c[1]))
    at = np.concatenate([rows, second])
    token = np.concatenate([c[0], c[1][second]])
    value = sig[at, token].astype(np.uint64)
    return at, mixed(node[at] ^ mixed(token.astype(np.uint64) * np.uint64(65536) + value + np.uint64(1)))


def _forest(near, n: int) -> list[tuple[int, int]]:
    """Edges that connect what ``near(i)`` (row numbers close to ``i``) connects.

    Rows of the largest part so far are not looked at: a link between two
    of them adds nothing, and one to another row is found from there."""
    label, size = np.arange(n), np.ones(n, np.int64)
    todo = np.ones(n, bool)
    edges = []
    while True:
        big = int(size.argmax())
        rest = np.flatnonzero(todo & (label != big))
        if not len(rest):
            return edges
        i = int(rest[0])
        todo[i] = False
        close = near(i)
        for other, at in zip(*np.unique(label[close], return_index=True)):
            mine = label[i]
            if other != mine:
                edges.append((i, int(close[at])))
                keep, gone = (mine, other) if size[mine] >= size[other] else (other, mine)
                label[label == gone] = keep
                size[keep] += size[gone]
                size[gone] = 0


def _candidates(sig: np.ndarray, node: int, depth: int) -> list[tuple[int, int]]:
    """Candidate links among the rows of a branch: branched on, then compared."""
    n = len(sig)
    if n <= LEAF or depth >= INNER_DEPTH:
        return _forest(lambda i: np.flatnonzero((sig == sig[i]).sum(axis=1) >= ZONE), n)
    at, keys = _next(np.full(n, node, np.uint64), sig)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    edges = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a > 1:
            edges += [(int(at[a + x]), int(at[a + y])) for x, y in _candidates(sig[at[a:b]], int(keys[a]), depth + 1)]
    return edges


def _grouped(batches, by: int):
    """Rows of sorted batches, as lists of whole groups (equal in column ``by``)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        v = np.asarray(batch.column(by))
        if held and np.asarray(held[-1].column(by))[-1] != v[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.flatnonzero(v != v[-1])[-1]) + 1 if v[0] != v[-1] else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column) -> np.ndarray:
    one = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return np.array([np.frombuffer(x, np.uint16) for x in one.to_pylist()], np.uint16).reshape(len(one), SIGNATURE)


def _branch_rows(batches):
    for batch in batches:
        if batch.num_rows:
            at, keys = _next(np.asarray(batch.column(0)).view(np.uint64), _matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.asarray(batch.column(1))[at])], names=["node", "key"])


def _compare_rows(batches):
    for t in _grouped(batches, 0):
        node, key, sig = np.asarray(t.column(0)), np.asarray(t.column(1)), _matrix(t.column(2))
        cuts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
        size = np.diff(cuts)
        pairs = cuts[:-1][size == 2]
        close = pairs[(sig[pairs] == sig[pairs + 1]).sum(axis=1) >= ZONE] if len(pairs) else pairs
        a, b = [close], [close + 1]
        for x in np.flatnonzero(size > 2):
            lo = cuts[x]
            e = np.array(_candidates(sig[lo:cuts[x + 1]], int(node[lo].view(np.uint64)), 0), np.int64).reshape(-1, 2)
            a.append(lo + e[:, 0])
            b.append(lo + e[:, 1])
        a, b = key[np.concatenate(a)], key[np.concatenate(b)]
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """A spanning forest of the candidate links between nodes (key, sig, branch), staged."""
    sig = nodes.select("key", "sig")
    rows = nodes.select(F.explode("branch").alias("node"), "key")
    small, wide = [], []
    for depth in range(DEPTH + 1):
        sizes = stage(rows.groupBy("node").agg(F.count("*").alias("rows"), F.min("key").alias("least")).where("rows > 1"), "branch-sizes")
        rows = rows.join(sizes, "node")
        small.append(rows.where(F.col("rows") <= NODE).select("node", "key"))
        if sizes.where(F.col("rows") > NODE).isEmpty():
            break
        large = rows.where(F.col("rows") > NODE)
        if depth == DEPTH:
            # rows that the tokens of all levels leave together: one candidate part, compared exactly later
            wide.append(large.where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")))
            break
        rows = stage(large.select("node", "key").join(sig, "key").select("node", "key", "sig").mapInArrow(_branch_rows, "node long, key long").distinct(), "branches")
    out = small[0]
    for s in small[1:]:
        out = out.unionByName(s)
    dealt = out.join(sig, "key").select("node", "key", "sig").repartition("node").sortWithinPartitions("node")
    edges = dealt.mapInArrow(_compare_rows, "a long, b long")
    for w in wide:
        edges = edges.unionByName(w)
    return stage(edges.distinct(), "candidates")


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of every key in the edges (a, b): ``root`` is the least key it reaches.

    Alternates the large-star and small-star steps until the edges no longer change."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        edges = stage(near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(near.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.groupBy("a").agg(F.min("b").alias("root"))
    return stars.select(F.col("a").alias("key"), "root").unionByName(stars.select(F.col("root").alias("key"), "root").distinct())


def _linked(h: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the exact rule connects among sets."""
    n, size = len(first) - 1, np.diff(first)
    who = np.repeat(np.arange(n), size)
    order = np.argsort(h, kind="stable")
    s = h[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    many = np.diff(np.append(start, len(s)))
    term = np.empty(len(h), np.int64)
    term[order] = np.repeat(np.arange(len(start)), many)
    owners = who[order]

    def near(i: int) -> np.ndarray:
        t = term[first[i]:first[i + 1]]
        t = t[many[t] > 1]
        k = many[t]
        at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(start[t], k)
        both = np.bincount(owners[at], minlength=n)
        both[i] = size[i]
        return np.flatnonzero((100 * both >= 75 * (size[i] + size - both)) & (size > 0))

    return _forest(near, n)


def _confirm(batches):
    for t in _grouped(batches, 0):
        task, key = np.asarray(t.column(0)), np.asarray(t.column(1))
        text = pa.concat_arrays(t.column(2).chunks)
        cuts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            parts, sizes, own = [], [], []
            for a, b, data, offsets in pieces(text.slice(lo, hi - lo)):
                h, first = _sets(data, offsets)
                same = _keys(h, first) == key[lo + a:lo + b].view(np.uint64)  # digests may clash
                size = np.diff(first)
                parts.append(h[np.repeat(same, size)])
                sizes.append(size[same])
                own.append(key[lo + a:lo + b][same])
            h, first, own = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(own)
            e = np.array(_linked(h, first), np.int64).reshape(-1, 2)
            a, b = own[e[:, 0]], own[e[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def confirmed_edges(docs: DataFrame, nodes: DataFrame, blocks: DataFrame, id_col: str, text_col: str, repeated: bool = False) -> DataFrame:
    """Links of the exact rule that connect each block's components; ``repeated``: some rows have the same id and text."""
    inside = nodes.select("key", "id", "digest", "n").join(blocks.select("key", F.col("root").alias("block")), "key")
    groups = F.ceil(2 * F.col("total") / BLOCK).cast("int")
    weight = inside.groupBy("block").agg(F.sum("n").alias("total")).select(
        "block", F.when(F.col("total") <= BLOCK, F.lit(1)).otherwise(groups).alias("groups"))
    inside = stage(inside.join(weight, "block"), "members")
    texts = docs.select(F.col(id_col).alias("text_id"), F.xxhash64(text_col).alias("text_digest"), F.col(text_col).alias("text"))
    if repeated:  # one text of each id and digest, reduced before the shuffle too: repeated rows send one text a task
        texts = texts.groupBy("text_id", "text_digest").agg(F.first("text").alias("text"))
    own = F.col("id").eqNullSafe(F.col("text_id")) & (F.col("digest") == F.col("text_digest"))

    def compared(tasks: DataFrame, name: str) -> DataFrame:
        dealt = tasks.join(texts, own).select("task", "key", "text").repartition("task").sortWithinPartitions("task")
        return stage(dealt.mapInArrow(_confirm, "a long, b long").distinct(), name)

    def group(salt: int, count: str):
        return F.pmod(F.xxhash64("key", F.lit(salt)), F.col(count)).cast("int")

    large = inside.where("groups > 1")
    tasks = inside.where("groups = 1").select(F.xxhash64("block").alias("task"), "key", "id", "digest")
    for salt in range(ROUNDS):
        tasks = tasks.unionByName(large.select(F.xxhash64("block", F.lit(salt), group(salt, "groups")).alias("task"), "key", "id", "digest"))
    links = compared(tasks, "links")
    if large.isEmpty():
        return links
    placed = large.join(components(links), "key", "left").withColumn("root", F.coalesce("root", "key"))
    main = placed.groupBy("block", "root").agg(F.sum("n").alias("size")).groupBy("block").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"))
    strays = placed.join(main, "block").where("root <> main").drop("main")
    some = strays.groupBy("block").agg(F.ceil(2 * F.sum("n") / BLOCK).cast("int").alias("sets"))
    strays, members = strays.join(some, "block"), large.join(some, "block")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    pairs = strays.withColumn("i", group(ROUNDS, "sets")).withColumn("j", every("groups")).select("block", "i", "j", "key", "id", "digest").unionByName(
        members.withColumn("j", group(ROUNDS, "groups")).withColumn("i", every("sets")).select("block", "i", "j", "key", "id", "digest"))
    return links.unionByName(compared(pairs.select(F.xxhash64("block", "i", "j").alias("task"), "key", "id", "digest").distinct(), "stray-links"))


def _judged(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' signatures, the nodes (key; id and digest of one row with the node's smallest id), and the root of each linked node."""
    rows = stage(signatures(docs, id_col, text_col), "signatures")
    full = rows.where("n > 0")
    least = stage(full.groupBy("key").agg(F.min("id").alias("least")), "sets")
    first = full.join(least.withColumnRenamed("key", "of"), (F.col("key") == F.col("of")) & F.col("id").eqNullSafe(F.col("least")))
    nodes = stage(first.select("key", "id", "digest", "n", "sig", "branch").dropDuplicates(["key"]), "nodes")
    blocks = stage(components(candidate_edges(nodes)), "blocks")
    repeated = not rows.groupBy("id", "digest").count().where("count > 1").isEmpty()
    return rows, nodes, stage(components(confirmed_edges(docs, nodes, blocks, id_col, text_col, repeated)), "parts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, set size, ``component_id`` and ``kept``."""
    rows, nodes, parts = _judged(docs, id_col, text_col)
    least = parts.join(nodes.select("key", "id"), "key").groupBy("root").agg(F.min("id").alias("component"))
    named = nodes.select("key", F.col("id").alias("own")).join(parts.join(least, "root").select("key", "component"), "key", "left").select(
        "key", F.coalesce("component", "own").alias("component"))
    out = rows.select("id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (that with the smallest id), and of each id and text without words; all columns kept."""
    rows, nodes, parts = _judged(docs, id_col, text_col)
    placed = nodes.select("key", "id", "digest").join(parts, "key", "left")
    first = placed.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("x"))
    kept = first.select("x.id", "x.digest").unionByName(rows.where("n = 0").select("id", "digest").distinct())
    kept = kept.select(F.col("id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    digest = "_digest"
    while digest in docs.columns or digest in ("_kept_id", "_kept_digest"):
        digest += "_"
    own = F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.col(digest) == F.col("_kept_digest"))
    return docs.withColumn(digest, F.xxhash64(text_col)).join(kept, own, "left_semi").dropDuplicates([id_col, digest]).select(*docs.columns)
