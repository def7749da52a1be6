"""The dealt operators against brute force, public libraries and each other."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from panelwatch.llm import (decontaminate, hilbert, html_extract, maxent_lm, near_dedup, quality, queries, sentencepiece_codec,
                            token_cache, toxicity, url_filter)

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def edited(rng, words, part):
    return [f"x{rng.randrange(999)}" if rng.random() < part else w for w in words]


# 1 -----------------------------------------------------------------------------------------

def test_decontamination_matches_brute_force(spark):
    got = queries.op1_decontamination(spark, SF).collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(brute.contamination(documents(spark), items))
    assert any(r.contaminated for r in got)


def test_decontamination_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    items = [(1, long), (2, "Short Item"), (3, None), (4, ""), (None, "lost words here"), (2, "short item"), (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")]
    rows = [(1, "a " + long.upper() + " b"), (2, None), (3, ""), (4, "x SHORT-item y"), (5, "short"), (6, " ".join(f"w{i}" for i in range(12))),
            (7, long), (7, long), (8, "lost words here"), (9, "short item " + "z " * 50_000), (10, "w13 " + " ".join(f"w{i}" for i in range(13)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (4_000_000, 1):
        got = decontaminate.decontamination_report(frame(spark, rows), bench, block_words=block_words)
        want = brute.contamination(rows, [x for x in items if x[0] is not None])
        mine = sorted(map(tuple, got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()))
        assert mine == sorted(want)
        longest = {r.doc_id: (r.longest_match, r.longest_at) for r in got.collect()}
        assert longest[1] == (60, 1) and longest[7] == (60, 0) and longest[2] == (0, -1) and longest[4] == (2, 1)
    clean = decontaminate.decontaminate(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(w[0] for w in want if not w[5])


def test_longest_match_over_items_that_share_windows(spark):
    rng = random.Random(1)
    shared = [f"s{i}" for i in range(15)]
    items = [(i, " ".join(shared + [f"t{i}x{j}" for j in range(i)])) for i in range(12)] + [(50, " ".join(["a"] * 40))]
    rows = [(0, " ".join(["x", *shared, *[f"t9x{j}" for j in range(9)], "y"])), (1, " ".join(shared + ["z"])), (2, " ".join(["a"] * 30 + ["b"] + ["a"] * 100))]
    rows += [(3 + k, " ".join(rng.choice(items)[1].split()[rng.randrange(8):] + ["q"] + rng.choice(items)[1].split())) for k in range(20)]

    def longest(text):
        w = text.split()
        best = (0, -1)
        for _, t in items:
            v = t.split()
            for i in range(len(w)):
                for j in range(len(v)):
                    n = 0
                    while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                        n += 1
                    if n >= 13 and (n > best[0] or n == best[0] and i < best[1]):
                        best = (n, i)
        return best

    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.longest_match, r.longest_at) for r in decontaminate.decontamination_report(frame(spark, rows), bench).collect()}
    assert got == {d: longest(t) for d, t in rows}


# 2 -----------------------------------------------------------------------------------------

ODD = ["Hello  world", " a b", "a\n\nb\t c", "  ", "", "▁x ▁", "é½ ﬁ", "<s> x </s>", "日本語😀 a\x00b", "<0x41>", "a" * 3000, "   x     y" + " " * 99, "x　y"]


def test_sentencepiece_equals_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ODD + [t for _, t in documents(spark)]
    docs = frame(spark, list(enumerate(texts)) + [(-1, None)])
    got = {r.doc_id: r.ids for r in sentencepiece_codec.encode(docs, MODEL).collect()}
    assert got[-1] == [] and all(got[i] == sp.encode(t) for i, t in enumerate(texts))
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(sentencepiece_codec.encode(docs, MODEL), MODEL).collect()}
    assert back[-1] == "" and all(back[i] == sp.decode(sp.encode(t)) for i, t in enumerate(texts))
    trip = queries.op2_sentencepiece(spark, SF)
    assert trip.where("exact").count() == trip.count() == len(documents(spark))


def _as_unigram(path):
    """The model file with the unigram kind in its trainer part (field 2, there field 3)."""
    raw = open(path, "rb").read()

    def varint(b, i):
        n = s = 0
        while True:
            n |= (b[i] & 127) << s
            s += 7
            i += 1
            if not b[i - 1] & 128:
                return n, i

    def write(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
        return bytes(out)

    out, i = bytearray(), 0
    while i < len(raw):
        tag, j = varint(raw, i)
        n, k = varint(raw, j)
        body = raw[k:k + n]
        if tag == 0x12:
            made, a = bytearray(), 0
            while a < len(body):
                t, b = varint(body, a)
                if t & 7 == 0:
                    v, e = varint(body, b)
                    made += write(t) + (write(1) if t >> 3 == 3 else write(v))
                elif t & 7 == 2:
                    v, e = varint(body, b)
                    e += v
                    made += body[a:e]
                else:
                    e = b + {1: 8, 5: 4}[t & 7]
                    made += body[a:e]
                a = e
            body = bytes(made)
        out += write(tag) + write(len(body)) + body
        i = k + n
    return bytes(out)


def test_unigram_viterbi_equals_library(spark):
    import sentencepiece

    proto = _as_unigram(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    c = sentencepiece_codec.Codec(proto=proto, kind="unigram")
    texts = [t for _, t in documents(spark)][:60] + ["é½ ﬁ", "<s> x </s>", "日本語😀 a", "<0x41>"]
    for word in sorted({w for t in texts for w in t.split()}):
        # two best of the library's lattice: its default short cut does not always find the highest sum
        mine, theirs = c.encode(word), sp.nbest_encode(word, nbest_size=2)[0]
        total = lambda ids: sum(c.low if i in c.byte_of else c.score[i] for i in ids)
        assert total(mine) == pytest.approx(total(theirs)) and c.decode(mine) == word
    for t in texts:
        assert c.decode(c.encode(t)) == t


# 3 -----------------------------------------------------------------------------------------

def test_url_filter(spark):
    urls = ["http://a.example.com/en/1", "http://WWW.example.com/en/1", "http://x.www.example.com/en/", "http://example.com", "http://example.com/",
            "ftp://b.net/es/q", "b.net/es/q", None, "", "http://net/fr/?x", "http://b.net/frx", "http://spam-farm.example.org/x", "http://myspam-farm.example.org/x",
            "http://xcom/en/", "x://y://com/", "http://example.com?en/", "http://a.example.com/en#x", "http://a.example.com/en/#x/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[:2])], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages, queries.URL_RULES, queries.URL_BLOCKED).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("example.com", "", None, "allow") and got[4][2:] == ("com/", "allow")
    assert got[5][2:] == ("net/es/", "block") and got[6] == got[7] == got[8] == ("", "", None, "allow")
    assert got[9][2:] == ("net/fr/", "block") and got[10][2] is None
    assert got[11][2:] == (None, "block") and got[12][2:] == (None, "allow") and got[13][2:] == (None, "allow")
    assert got[14] == ("y:", "//com/", None, "allow") and got[16][2:] == ("com/", "allow") and got[17][2:] == ("example.com/en/", "block")
    assert got[18] == got[0] and got[19] == got[1]
    assert url_filter.url_verdicts(pages.limit(0), (), ()).count() == 0


def test_digest_array_confirms_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digests", lambda s: np.array([hash(x[:1]) % 3 for x in s], np.uint64))  # nearly all collide
    words = [f"{a}{i}" for a in "abc" for i in range(5)]
    (tmp_path / "f").write_bytes(url_filter.pack(words, list(range(len(words)))))
    found = url_filter.DigestArray(str(tmp_path / "f")).find(words + ["a9", "zz", ""])
    assert found.tolist() == [*range(len(words)), -1, -1, -1]


def test_url_rules_in_several_files(spark):
    rules = [(f"h{i}.org", "/", "block") for i in range(10)]
    parts = url_filter.RuleSet(spark, rules, file_entries=3).parts
    pages = spark.createDataFrame([(i, f"http://q.h{i}.org/z") for i in range(12)], "page_id long, url string")
    assert len(parts) == 4
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(pages, rules).collect()}
    assert got == {i: "block" if i < 10 else "allow" for i in range(12)}


# 4 -----------------------------------------------------------------------------------------

def test_quality_figures_match_brute_force(spark):
    w = "a b c d e f g h".split()
    texts = [" ".join(w + ["x"] + w), " ".join("a" * 9), " ".join(w), None, "", "a b c\n\nq\na b c\n a b c\n", "a " * 30, "é#x\u00a0y\x0bz\n \n#", "q " * 9000]
    rows = list(enumerate(texts)) + [(i + 100, t) for i, (_, t) in enumerate(documents(spark))]
    got = quality.quality_rules(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {
        d: brute.quality(t) for d, t in rows}
    clash = frame(spark, rows).withColumn("n_words", F.lit(1)).withColumn("words", F.lit(2)).withColumn("row", F.lit(3))
    kept = quality.keep_good(clash)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


# 5 -----------------------------------------------------------------------------------------

def test_lm_base_matches_brute_force_and_model_is_better(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op5_lm_scoring(spark, sf).collect()
    want = brute.base_scores(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_scores_do_not_depend_on_the_layout(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(5 + i % 40))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    s = maxent_lm.Settings(buckets=256, singles=6, tails=4)
    scores = [{r.doc_id: r.score for r in maxent_lm.lm_scores(docs.repartition(n, "doc_id"), F.col("doc_id") % 5 == 0, settings=s).collect()} for n in (1, 7)]
    assert len(scores[0]) == 120 and scores[1] == pytest.approx(scores[0], abs=1e-3)
    assert maxent_lm.Settings().singles >= 32 and maxent_lm.Settings().buckets >= 1 << 16


def test_lm_probabilities_sum_to_one(spark):
    s = maxent_lm.Settings(buckets=64, singles=3, tails=2, updates=2)
    rows = [(i, t) for i, t in enumerate(["a b c a b", "b c", "a a d", None, ""])]
    docs = frame(spark, rows)
    blocks = maxent_lm.encode(docs, F.lit(False), "doc_id", "text", s)
    counts = maxent_lm.count(blocks, 3, s)
    m = maxent_lm.train(blocks, counts, s)
    assert m.tokens == 15 and m.kinds == 5
    known, sizes = np.array([7, 8, 9], np.uint64), np.array([2, 1])
    f = maxent_lm.features(known, np.array([0, 2, 2]), sizes, 64)
    assert (f[:, 0] == f[:, 2]).all() and (f[:, 0] != f[:, 1]).any()  # both begin a text
    z, e = maxent_lm._class_odds(m, f)
    assert (e / e.sum(axis=1, keepdims=True)).sum(axis=1) == pytest.approx(1)
    # a second text after the first sees the start again, not the first's words
    one = {r.doc_id: r.score for r in maxent_lm.score(blocks, counts, m, "doc_id", s).collect()}
    assert one[3] == one[4]
    held = {r.doc_id: r for r in maxent_lm.lm_scores(docs, F.lit(True), settings=s).collect()}
    assert held[0].train_tokens == 0 and held[0].n_known == 0 and held[0].base_score == 0.0


# 6 -----------------------------------------------------------------------------------------

def test_near_duplicates_match_brute_force(spark):
    rows = documents(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_duplicates(rows)


@pytest.mark.parametrize("settings", [{}, {"NODE": 8, "LEAF": 4}, {"BLOCK": 2000}, {"NODE": 2, "DEPTH": 1, "BLOCK": 500, "ROUNDS": 1}])
def test_near_duplicates_of_hard_groups(spark, monkeypatch, settings):
    """A star of copies around one text, chains, shared passages, and each way through the operator."""
    for k, v in settings.items():
        monkeypatch.setattr(near_dedup, k, v)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(120)]
    texts = [" ".join(edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05]))) for _ in range(70)]
    chain = [word() for _ in range(100)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[6:] + [word() for _ in range(6)]
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(60)] + passage) for _ in range(25)]
    texts += [None, "", "  \n", "one two", "One  TWO", "a b c d", "a b c d e", "a b c d e f"] + [texts[0]] * 5
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = frame(spark, rows).withColumn("key", F.lit("x")).withColumn("n", F.lit("y"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    want = brute.near_duplicates(rows)
    assert got == want
    if not settings:
        left = near_dedup.deduplicate(docs.unionByName(docs.where("doc_id = 3")))
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted({v[1] for v in want.values()})


def test_deduplicate_with_null_and_repeated_ids(spark):
    rng = random.Random(6)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    near = lambda t: t + " more"
    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [(1, a), (2, near(a)), (2, b), (3, c), (3, d), (3, near(d)), (None, e), (None, near(e)), (None, f), (4, near(f)), (None, g), (None, g),
            (5, ""), (5, ""), (5, None), (None, None), (6, b.upper())]
    docs = frame(spark, rows)
    got = [tuple(r) for r in near_dedup.deduplicate(docs).collect()]
    for x in [(1, a), (2, b), (3, c), (4, near(f)), (None, g), (5, ""), (5, None), (None, None)]:
        assert got.count(x) == 1
    assert len(got) == 10 and len({(3, d), (3, near(d))} & set(got)) == 1 and len({(None, e), (None, near(e))} & set(got)) == 1
    marks = near_dedup.near_duplicates(docs)
    assert marks.count() == len(rows) and marks.where("doc_id IS NULL AND component_id = 4 AND NOT kept").count() == 1
    assert marks.where("doc_id IS NULL AND kept").count() == 5


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    got = near_dedup.near_duplicates(frame(spark, [(1, None), (2, ""), (3, " ")])).collect()
    assert all(r.kept and r.component_id == r.doc_id and r.n_shingles == 0 for r in got) and len(got) == 3


def test_components(spark):
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 30)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = {r.key: r.root for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(30)} | {2000: 2000, 2001: 2000}
    assert got == want


# 7 -----------------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op7_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.75 and np.mean([r.predicted for r in clean]) < 0.01
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in got)


def test_toxicity_cases(spark):
    rng = random.Random(3)
    text = lambda bad: " ".join(rng.choice(["sun", "tree", "house", "river"]) for _ in range(30)) + (" you idiot fool" if bad else "")
    rows = [(i, text(i % 4 == 0), "en") for i in range(200)] + [(900, None, "en"), (901, "", None), (902, "idiot fool " + "sun " * 60_000, "xx")] + [(0, text(True), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (5, None), (7, 1), (7, 0), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in range(200)) and got[902] >= 0.7 and got[900] == got[901] < 0.7
    assert model.thresholds and set(model.thresholds) == {"en"}
    left = toxicity.remove_toxic(docs, model)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted([i for i in range(200) if i % 4] + [900, 901])
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {round(r.score, 3) for r in toxicity.toxicity_scores(docs, none).collect()} == {0.0}
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0


def test_toxicity_cuts_cover_all_labelled_rows(spark):
    """Cuts follow the counts of the whole table, not the shares of the training sample."""
    rng = random.Random(4)
    mild, hard = ["sun", "tree", "house", "river", "stone"], ["idiot", "fool", "hate"]
    text = lambda bad: " ".join(rng.choices(mild + hard, [8] * 5 + [rng.choice([1, 2, 3]) if bad else rng.choice([0, 0, 1])] * 3, k=25))
    rows = [(i, text(i % 10 == 0), "xx" if i < 600 else "yy" if i < 630 else "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(3000)], "doc_id long, toxic int")
    s = toxicity.Settings(rows=40, per_language=20)
    _, used = toxicity.learn(docs, labels, s)
    model = toxicity.fit(docs, labels, s)
    assert len(used) == 80 and set(model.thresholds) == {"en", "xx"}  # 60 toxic rows of xx, at most a few in the sample
    inside = {r.doc_id for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect() if r.h in set(used.tolist())}
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    for lang, mine in model.thresholds.items():
        ids = [i for i, _, x in rows if x == lang]
        out = [i for i in ids if i not in inside]
        weight = {c: sum((i % 10 == 0) == c for i in ids) / sum((i % 10 == 0) == c for i in out) for c in (True, False)}

        def f1(t):
            hit, wrong = (sum(weight[c] for i in out if (i % 10 == 0) == c and got[i] >= t) for c in (True, False))
            return 2 * hit / (hit + wrong + weight[True] * sum(i % 10 == 0 for i in out))

        assert f1(mine) == pytest.approx(max(map(f1, toxicity.CUTS)))


# 8 -----------------------------------------------------------------------------------------

def test_hilbert_neighbours_and_law(spark):
    cells = spark.range(16**3).selectExpr("id div 256 AS a", "(id div 16) % 16 AS b", "id % 16 AS c")
    x = hilbert.hilbert_index(cells, ["a", "b", "c"], "h").toPandas().sort_values("h")
    assert x.h.tolist() == list(range(16**3)) and (x[["a", "b", "c"]].diff().abs().sum(axis=1)[1:] == 1).all()


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(7000, None, None, None), (7000, None, None, None), (None, "", "en", "s")], "doc_id long, text string, lang string, source string")
    both = docs.select("doc_id", "text", "lang", "source").unionByName(extra).withColumn("shard", F.lit(1)).withColumn("n", F.lit(2))
    got = hilbert.hilbert_shards(both, 8).toPandas()
    n = both.count()
    assert len(got) == n and (got.law == "rows").all() and got.grown_shard.isna().all()
    sizes = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    text = dict(documents(spark)) | {7000: ""}
    for r in got.itertuples():
        if r.doc_id == r.doc_id:
            raw = (text[int(r.doc_id)] or "").encode()
            assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    runs = got.groupby("shard").hilbert.agg(["min", "max"])
    assert (runs["max"].values[:-1] <= runs["min"].values[1:]).all()
    assert hilbert.hilbert_shards(both.limit(0), 8).count() == 0
    few = hilbert.hilbert_shards(both.limit(3), 8).toPandas()
    assert len(few) == 3 and few.shard.nunique() == 3


# 9 -----------------------------------------------------------------------------------------

CASES = {
    "<div class=content><p>Hello <b>big</b> world, this is a long text of the article for all.</p><div class='comments'><p>me too</p></div><aside>x</aside></div><footer>f</footer>":
        "Hello big world, this is a long text of the article for all.",
    "plain &amp; simple": "plain & simple",
    "<body><nav><a href=x>Home</a></nav><p>para one & two &lt;3</p><ul><li>a<li>b</ul><form><p>no</p></form>": "para one & two <3\na\nb",
    "<p>a<br>b": "a b",
    "<a title='x>y' href=\"q\">t</a><script>var a='<p>';</script>z": "tz",
    "<div id='cookie-notice'>We use</div><main><header><h1>T</h1></header><p>some body\n text here which  is long enough</p></main>": "T\nsome body text here which is long enough",
    "<style>p{}</style><!-- <p>no</p> --><p>yes": "yes",
    "": "",
}


@pytest.mark.parametrize("source", CASES)
def test_html_cases(source):
    assert html_extract.page_text(source, None) == CASES[source]


def test_html_consensus(spark):
    body = lambda i: f"<div class='post-{i}'><p>{'Words of the article number %d. ' % i * 4}</p></div>"
    wrong = "<div class='teaser'><p>" + "A long teaser text that is repeated on this page. " * 6 + "</p></div>"
    rows = [(i, f"http://h.org/{i}", f"<body>{body(i)}<footer>f</footer></body>") for i in range(9)]
    rows += [(9, "http://h.org/9", f"<body>{body(9)}{wrong}</body>"), (10, None, None), (11, "nohost", "<p>x"), (0, "http://h.org/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("path", F.lit("clash"))
    won = {r.host: (r.path, r.votes) for r in html_extract.winning_paths(pages).collect()}
    assert won["h.org"] == ("/body/div.post", 10)
    got = {r.page_id: r for r in html_extract.main_text(pages).collect()}
    assert got[3].text == ("Words of the article number 3. " * 4).strip() and got[3].n_chars == len(got[3].text)
    assert html_extract.Page(rows[9][2]).best() == "/body/div.teaser"  # alone, the page would choose the teaser
    assert got[9].text in ("Words of the article number 9. " * 4).strip() or "teaser" in got[9].text
    assert got[10].text == "" and got[11].text == "x" and html_extract.main_text(pages).count() == 13


def test_html_pages_give_their_articles(spark):
    import html
    import re

    for r in queries.op9_html_extraction(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# 10 ----------------------------------------------------------------------------------------

def test_token_counts_equal_library_and_fill_the_cache(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    odd = ["", None, " ", "a  b", "<|endoftext|>", "x <|endoftext|> y", "x<|endoftext|>", "it's 'S n't", "a\u00a0b \u3000c", "tab\t x \n y", "a\x1cb c\x85 d", "é è 12 3!! ..",
           "q" * 20_000, "n " * 20_000, "👍 👍🏽 x"]
    rows = list(enumerate(odd + [d[1] for d in documents(spark)]))
    docs = frame(spark, rows + rows[:20]).withColumn("digest", F.lit("clash"))
    cache = str(tmp_path / "cache")
    got = token_cache.token_counts(docs, TOKENIZER, cache).collect()
    assert len(got) == len(rows) + 20
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in rows}
    assert all((r.n_tokens, r.n_bytes, r.over_limit) == (want[r.doc_id], len((rows[r.doc_id][1] or "").encode()), want[r.doc_id] > 512) for r in got)
    stored = spark.read.parquet(cache)
    distinct = len({x or "" for _, x in rows})
    assert stored.count() == distinct
    token_cache.token_counts(docs, TOKENIZER, cache).count()
    more = frame(spark, [(1, "a new text"), (2, odd[3])])
    assert {r.doc_id: r.n_tokens for r in token_cache.token_counts(more, TOKENIZER, cache).collect()}[2] == want[3]
    assert spark.read.parquet(cache).count() == distinct + 1  # only the miss was encoded
    assert token_cache.token_counts(docs.limit(0), TOKENIZER, cache).count() == 0


def test_lm_gradient_sums_sort_two_byte_buckets(monkeypatch):
    rng = np.random.default_rng(3)
    at = np.concatenate([rng.integers(0, 1 << 16, 500), np.full(300, 7), [0, (1 << 16) - 1]]).astype(np.int32)
    rows = rng.random((len(at), 5)).astype(np.float32)
    want = np.ones((1 << 16, 5))
    np.add.at(want, at, rows)
    kinds, sort = [], np.argsort
    monkeypatch.setattr(maxent_lm.np, "argsort", lambda x, **how: kinds.append(x.dtype.itemsize) or sort(x, **how))
    got = np.ones((1 << 16, 5), np.float32)
    maxent_lm._add_rows(got, at, rows)
    assert kinds == [2] and np.allclose(got, want, rtol=1e-5)
    for few in ([3, 1, 2], [5, 5, 5]):
        got = np.zeros((8, 5), np.float32)
        maxent_lm._add_rows(got, np.array(few), rows[:3])
        assert np.allclose(got.sum(axis=0), rows[:3].sum(axis=0)) and set(np.flatnonzero(got.any(axis=1))) == set(few)
