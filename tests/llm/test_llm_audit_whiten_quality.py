"""Source audit, embedding whitening and compression classifier against plain versions."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import llm_brute as brute
from panelwatch.llm import compression_quality as quality
from panelwatch.llm import queries, source_audit, whitening

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def plain_audit(rows, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = collections.Counter(t for g, _, w in docs if g == lang for t in set(w))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = {s: collections.Counter() for g, s, _ in docs if g == lang}
        for g, s, w in docs:
            if g == lang:
                counts[s].update(t for t in w if held[t] >= least)
        whole = sum(counts.values(), collections.Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + (10**9 * (c[t] + 2)) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def audit_rows():
    rng = random.Random(3)
    stock = ["an", "ant", "anthem", "anthems", "antler", "über", "überall", "z" * 300, "z" * 299 + "y", "Z" * 300 + "q", "q" * 5000]
    rows = []
    for i in range(120):
        words = [rng.choice(stock).title() if rng.random() < .3 else rng.choice(stock) for _ in range(rng.randrange(12))]
        rows.append((i % 90, " ".join(words) + rng.choice(["", "-x1", "\n#tag"]), rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "a", "b", "c", None])))
    rows += [(None, None, "en", "silent"), (7, "", "xx", "alone"), (7, "123 !!", "yy", "b"), (8, None, "yy", "a")]
    return rows + rows[:30]


@pytest.mark.parametrize("first, bucket, tile", [(1, 1, 1), (2, 3, 2), (6, 2048, 256)])
def test_audit_equals_plain_version(spark, first, bucket, tile):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("block", F.lit(0))
    got = source_audit.source_divergence(docs, first_level=first, bucket_terms=bucket, tile_sources=tile)
    want = plain_audit(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(len(r[3]) == 300 for r in want) and any(r[2] == "pair" and r[4] == 0 for r in want)


def test_audit_levels_discard_prefixes(spark):
    """A level keeps exactly the prefixes that enough documents hold, and the next one reads no others."""
    rows = [(i, f"common{i % 3} rare{i}x{'y' * i} aa{i}" if i else "aa", "en", "s") for i in range(20)]
    index = source_audit.term_index(spark.createDataFrame(rows, DOCS).coalesce(1))
    terms = {r.term.decode(): r.n_docs for r in source_audit.kept_terms(index, 10, first_level=3).collect()}
    assert terms == {"aa": 20, "common": 19, "rare": 19}
    block = index.collect()[0]
    batch = index.toArrow().to_batches()[0]
    one = source_audit.Block(batch, 0)
    assert block.lang == "en" and len(one.sizes) == len(one.starts)
    level = source_audit._prefix_documents(one, 3, None).to_pylist()
    assert {"lang": "en", "prefix": b"com", "done": False, "n": 19} in level
    assert {"lang": "en", "prefix": b"aa", "done": True, "n": 20} in level
    none = source_audit._prefix_documents(one, 6, np.zeros(1 << 13, np.uint8)).to_pylist()
    assert none == []


def test_audit_bitmap_changes_no_result(spark, monkeypatch):
    rows = audit_rows()
    monkeypatch.setattr(source_audit, "_bitmap", lambda survivors, n: np.full(1 << 13, 255, np.uint8))
    got = source_audit.source_divergence(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, got.collect())) == plain_audit(rows)


def test_audit_shares_stay_exact(spark):
    row = spark.range(1).select(source_audit._share("9000000000000000L", "9100000000000001L", "7L").alias("p")).first()
    assert row.p == 1 + 10**9 * (9 * 10**15 + 2) // (91 * 10**14 + 1 + 14)


def test_audit_of_an_empty_table(spark):
    assert source_audit.source_divergence(spark.createDataFrame([], DOCS)).count() == 0


# 12 -----------------------------------------------------------------------------------------

def plain_whitening(vectors, components=16):
    x = np.array([[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors], dtype=object)
    fit = sorted({tuple(r) for r in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    return n, dev, ((x.astype(float) - mean) @ w) / np.sqrt(e), e / np.trace(v)


def check_whitening(rows, vectors, dim):
    n, dev, white, share = plain_whitening(vectors)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert all(sorted(v) == list(range(1, min(dim, 16) + 1)) for v in by.values()) and len(by) == len(vectors)
    got = np.array([[by[k][c].whitened for c in sorted(by[k])] for k in sorted(by)])
    assert np.abs(np.abs(got) - np.abs(white)).max() < 1e-8
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-8
    assert all(by[k][1].n == n and by[k][1].deviation == d for k, d in zip(sorted(by), dev))
    assert all(abs(by[0][c].explained - share[c - 1]) < 1e-10 for c in by[0])
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_whitening_equals_plain_version(spark):
    got = queries.op12_embedding_whitening(spark, SF).collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    check_whitening(got, vectors, 64)


@pytest.mark.parametrize("parts", [1, 7])
def test_whitening_cases(spark, parts):
    rng = np.random.default_rng(5)
    good = [list(map(float, v)) for v in rng.normal(0, 1, (60, 5)) * [3, 1, .5, 100, .2]]
    good += good[:20]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    rows = [(k, v, "clash", 3) for k, v in enumerate(good)] + [(1000 + k, v, None, None) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, dim int").repartition(parts)
    got = whitening.whiten(df).collect()
    check_whitening(got, good, 5)


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    rows = [(1, [float(i), 2.0 * i, 7.0]) for i in range(5)] + [(None, [0.0, 0.0, 7.0])]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 18 and all((r.whitened is None) == (r.component > 1) for r in got)
    assert sum(r.vec_id is None for r in got) == 3 and got[0].identity_error < 1e-9
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 2, schema)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 for r in one)


def test_rank_one_updates_follow_the_scatter():
    rng = np.random.default_rng(2)
    for dim, n in ((1, 4), (4, 3), (7, 50), (16, 90)):
        x = np.floor(rng.normal(0, 9, (n, dim)))
        if dim == 7:
            x[:, 3], x[:, 5] = x[:, 2], 4  # equal and constant dimensions are deflated
        s = whitening.spectrum_of(x, streams=3)
        scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
        scale = max(np.abs(scatter).max(), 1)
        assert np.abs(s.vectors[0] * s.values[0] @ s.vectors[0].T - scatter).max() < 1e-11 * scale
        assert np.abs(s.vectors[0].T @ s.vectors[0] - np.eye(dim)).max() < 1e-12
        assert s.n[0] == n and np.allclose(s.mean[0], x.mean(axis=0))


def test_secular_roots_with_deflated_poles():
    values = np.array([[0.0, 1.0, 1.5, 4.0], [1.0, 2.0, 3.0, 1e6]])
    b = np.array([[.3, 0.0, 1e-9, 2.0], [0.0, 5.0, 1e-3, 1e-7]])
    roots, away = whitening.secular_roots(values, b)
    for k in range(2):
        dense = np.diag(values[k]) + np.outer(np.sqrt(b[k]), np.sqrt(b[k]))
        assert np.allclose(np.sort(roots[k]), np.linalg.eigvalsh(dense), rtol=1e-12)
        assert np.allclose(away[k], values[k][:, None] - roots[k][None, :], atol=1e-9)


def test_deviations_are_exact_or_null():
    x = np.array([[2**40, -5], [3, 4]], np.int64)
    assert whitening.deviations(x, 1000, (10, 20)) == [None, (3000 - 10) ** 2 + (4000 - 20) ** 2]
    near = np.array([[3037000499]], np.int64)
    assert whitening.deviations(near, 1, (0,)) == [3037000499**2]


def test_rows_keep_their_numbers_in_few_bytes():
    x = np.array([[1, -128], [128, 0], [-40000, 2], [2**40, -1], [127, -127]], np.int64)
    coded = whitening.encode(x)
    assert [len(c) for c in coded] == [3, 5, 9, 17, 3]
    import pyarrow as pa
    assert (whitening.decode(pa.array(coded, pa.binary()), 2) == x).all()


# 13 -----------------------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op13_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= .3) for k, r in got.items())
    held = [(got[k].score, got[k].predicted, y) for k, y in labels.items() if k in got and got[k].held_out]
    good, bad = [h for h in held if h[2] == 1], [h for h in held if h[2] == 0]
    auc = sum((a[0] > b[0]) + .5 * (a[0] == b[0]) for a in good for b in bad) / (len(good) * len(bad))
    assert auc > .95 and sum(h[1] for h in good) >= .97 * len(good) and sum(h[1] for h in bad) <= .5 * len(bad)


def texts(rng, n):
    rows, marks = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(5, 60))]
        rows.append((i, " | ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + ".", "en"))
        marks.append((i, int(not bad)))
    return rows, marks


def test_quality_cases(spark):
    rng = random.Random(4)
    rows, marks = texts(rng, 300)
    rows += [(900, None, "en"), (901, "", None), (None, "plain words here", "en"), (902, "x" * 300_000, "en"), (5, rows[5][1], "en")]
    marks += [(5, 0), (6, None), (None, 1), (5000, 1), (900, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model, kept = quality.fit(docs, labels)
    got = quality.scored(kept, model).collect()
    again = {(r.doc_id, round(r.score, 12)) for r in quality.quality_scores(docs, model).collect()}
    assert len(got) == len(rows) and {(r.doc_id, round(r.score, 12)) for r in got} == again
    by = {r.doc_id: r.score for r in got}
    assert by[900] == by[901] and all(0 <= s <= 1 for s in by.values())
    assert np.mean([(by[k] >= .5) == (k % 3 != 0) for k in range(300)]) > .97
    # the differences are those of the library's own compressor
    text = rows[1][1].encode()
    sizes = []
    for data, kind in zip(model.dictionaries[0], model.kinds[0]):
        d = zstandard.ZstdCompressionDict(data, dict_type=kind)
        c = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(len(c.compress(text)))
    found = {r.id: r.a for r in kept.collect()}
    assert found[1] == pytest.approx((sizes[0] - sizes[1]) / (len(text) + model.settings.smooth))


def test_quality_without_both_classes(spark):
    rows, marks = texts(random.Random(1), 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for some, want in (([], .5), ([m for m in marks if m[1] == 1], 1.0)):
        model, kept = quality.fit(docs, spark.createDataFrame(some, "doc_id long, quality int"))
        assert {r.score for r in quality.scored(kept, model).collect()} == {want}
    empty = docs.where("false")
    model, kept = quality.fit(empty, spark.createDataFrame(marks, "doc_id long, quality int"))
    assert quality.scored(kept, model).count() == 0


# 10 -----------------------------------------------------------------------------------------

def test_token_counts_of_odd_texts_equal_the_library():
    """Cutting at single spaces changes no count, whatever white space or marks stand around them."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from panelwatch.llm import token_cache

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    token_cache._loaded["odd"] = (t, {}, token_cache._is_cuttable(t))
    rng = random.Random(0)
    chars = ["a", "b", "\u00e9", "\u00df", " ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u3000", "\u1680", "\x85", "\x1c", "1", "!", "'s", "<|endoftext|>",
             "\u4e2d", "\U0001f600", "\u00f1", "\u0301", "\x00", "\u200b", "\ufeff"]
    texts = ["", " ", "a b"] + ["".join(rng.choice(chars) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["word " * 50_000]
    assert token_cache.count_tokens(texts, "odd") == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_cache.count_tokens([], "odd") == []


# 6 and shared helpers -----------------------------------------------------------------------

def test_repeated_rows_send_one_text_to_a_comparison(spark, monkeypatch):
    """Fifty copies of one row and a near copy: two texts are compared, and a column named like the digest survives."""
    from panelwatch.llm import near_dedup

    words = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(words), "mine")] * 50 + [(2, " ".join([*words[:-1], "other"]), "mine"), (None, " ".join(words), "mine"), (3, None, "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string").repartition(4)
    seen = spark.sparkContext.accumulator(0)
    confirm = near_dedup._confirm

    def counted(batches):
        def each():
            for b in batches:
                seen.add(b.num_rows)
                yield b
        yield from confirm(each())

    monkeypatch.setattr(near_dedup, "_confirm", counted)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and {r.component_id for r in got if r.doc_id != 3} == {1}
    assert seen.value <= 2
    left = near_dedup.deduplicate(docs).collect()
    assert sorted(r.doc_id for r in left) == [1, 3] and {r._digest for r in left} == {"mine"}


def test_staged_tables_are_deleted(spark):
    import os

    from panelwatch.llm import common

    df = common.stage(spark.range(3), "gone")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 3 and os.path.isdir(path)
    common.drop_stages()
    assert not os.path.exists(path)
