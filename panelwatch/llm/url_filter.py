"""URL filter over a memory-mapped, sorted array of 64-bit xxhash digests.

A list of rules (``host/path``) becomes files of at most ``FILE_ENTRIES`` entries:
the sorted digests of the rules, the places of their strings, and the
strings.  The files lie in the shared folder; Spark hands each executor a copy, and
a task maps it into memory, so a list takes no heap and its pages are shared by an
executor's workers.  All candidate rules of a batch of urls are probed with one
vectorised binary search, and every hit is confirmed on the stored string, so
a digest collision cannot change a verdict (equal digests are all looked at).

A rule fits its host and all its subdomains where the url's path starts with the
rule's path.  Candidates are therefore the url's host suffixes times the prefixes of
its path, in the lengths that occur among the rules of that host; hosts are probed
first.  The longest rule wins, at equal length the one with the longer host.

Edge cases: a null url, or one without ``://``, has empty host and path and fits
no rule; repeated rows are judged one by one; an empty table gives an empty
table; an empty list fits nothing; columns other than id and url are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: entries of one file; longer lists take several files, probed in turn
FILE_ENTRIES = 20_000_000

_maps: dict[str, tuple] = {}


def digests(strings: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) for s in strings), dtype=np.uint64, count=len(strings))


def pack(strings: list[str], values: list[int]) -> bytes:
    """The file of a digest array: count, digests in order, values, string ends, strings."""
    keys = digests(strings)
    order = np.argsort(keys, kind="stable")
    raw = [strings[i].encode() for i in order]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    return (np.array([len(raw)], np.int64).tobytes() + keys[order].tobytes() + np.array([values[i] for i in order], np.int64).tobytes()
            + ends.tobytes() + b"".join(raw))


class DigestArray:
    """A mapped file; ``find`` gives the stored value of each string, or -1."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n = int(raw[:8].view(np.int64)[0])
        self.keys = raw[8:8 + 8 * n].view(np.uint64)
        self.values = raw[8 + 8 * n:8 + 16 * n].view(np.int64)
        self.ends = raw[8 + 16 * n:8 + 24 * n].view(np.int64)
        self.strings = raw[8 + 24 * n:]

    def find(self, strings: list[str]) -> np.ndarray:
        out = np.full(len(strings), -1, np.int64)
        if not len(self.keys) or not strings:
            return out
        keys = digests(strings)
        at, end = np.searchsorted(self.keys, keys, side="left"), np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(at < end):
            want = strings[i].encode()
            for k in range(at[i], end[i]):
                start = self.ends[k - 1] if k else 0
                if self.strings[start:self.ends[k]].tobytes() == want:
                    out[i] = self.values[k]
                    break
        return out


def _mapped(name: str) -> DigestArray:
    if name not in _maps:
        _maps[name] = DigestArray(SparkFiles.get(name))
    return _maps[name]


def publish(spark: SparkSession, blob: bytes) -> str:
    """Write bytes to the shared folder and let Spark copy them to executors; their file name."""
    name = f"digests-{hashlib.sha256(blob).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    for a in range(0, len(blob), 1 << 20):
        out.write(bytearray(blob[a:a + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return name


class RuleSet:
    """Published rules: digest arrays of the rules and of their hosts.

    ``rules``: (host, path, verdict) with any iterable; it is read once, in runs
    of ``file_entries``."""

    def __init__(self, spark: SparkSession, rules, file_entries: int = FILE_ENTRIES):
        self.parts: list[tuple[str, str, list[tuple[int, ...]]]] = []
        run: list[tuple[str, str, str]] = []
        for r in rules:
            run.append(r)
            if len(run) >= file_entries:
                self._add(spark, run)
                run = []
        if run:
            self._add(spark, run)

    def _add(self, spark, run) -> None:
        lengths: dict[str, set[int]] = {}
        for host, path, _ in run:
            lengths.setdefault(host, set()).add(len(path))
        kinds = sorted({tuple(sorted(v)) for v in lengths.values()})
        number = {k: i for i, k in enumerate(kinds)}
        hosts = list(lengths)
        host_file = publish(spark, pack(hosts, [number[tuple(sorted(lengths[h]))] for h in hosts]))
        rule_file = publish(spark, pack([h + p for h, p, _ in run], [int(v == "block") for _, _, v in run]))
        self.parts.append((host_file, rule_file, kinds))


def _suffixes(host: str) -> list[str]:
    out = [host]
    while (dot := host.find(".")) >= 0:
        host = host[dot + 1:]
        out.append(host)
    return out


def match(hosts: list[str], paths: list[str], parts) -> tuple[list[str | None], list[int]]:
    """For each url the winning rule (None: none fits) and whether it blocks."""
    best: list[tuple[int, int, str | None, int]] = [(-1, -1, None, 0)] * len(hosts)
    for host_file, rule_file, kinds in parts:
        suffixes = {h: _suffixes(h) for h in set(hosts)}
        every = sorted({s for v in suffixes.values() for s in v if s})
        known = {s: kinds[k] for s, k in zip(every, _mapped(host_file).find(every)) if k >= 0}
        owner, wanted = [], []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            for s in suffixes[h]:
                for n in known.get(s, ()):
                    if n <= len(p):
                        owner.append((i, len(s)))
                        wanted.append(s + p[:n])
        distinct = list(dict.fromkeys(wanted))
        hit = dict(zip(distinct, _mapped(rule_file).find(distinct).tolist()))
        for (i, size), w in zip(owner, wanted):
            if hit[w] >= 0 and (len(w), size) > best[i][:2]:
                best[i] = (len(w), size, w, hit[w])
    return [b[2] for b in best], [b[3] for b in best]


def url_verdicts(pages: DataFrame, rules, blocked=(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: host, path, winning rule and verdict.

    ``rules``: (host, path, 'allow' or 'block').  Where none fits, the url is blocked
    if a (host, path) of ``blocked`` fits, and else allowed."""
    spark = pages.sparkSession
    own = RuleSet(spark, rules).parts
    listed = RuleSet(spark, ((h, p, "block") for h, p in blocked)).parts
    url = F.col(url_col)
    parsed = pages.select(
        F.col(id_col).alias(id_col),
        F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"))

    def judge(batches):
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rule, blocks = match(hosts, paths, own)
            _, other = match(hosts, paths, listed)
            verdict = ["block" if (b if r is not None else o) else "allow" for r, b, o in zip(rule, blocks, other)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=[id_col, "host", "path", "rule", "verdict"])

    kind = parsed.schema[id_col].dataType.simpleString()
    return parsed.mapInArrow(judge, f"{id_col} {kind}, host string, path string, rule string, verdict string")
