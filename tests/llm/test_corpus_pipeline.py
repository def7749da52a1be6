"""The corpus pipeline against the plain versions of its stages."""

import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
import llm_brute as brute


def test_pipeline_matches_brute_force(spark, tmp_path):
    rng = random.Random(8)
    body = lambda n=50: " ".join(rng.choice(["the", "of", "and", *[f"word{rng.randrange(3000)}"] * 4]) for _ in range(n))
    passage = body(30)
    good = [body() for _ in range(120)]
    toxic = [body() + " you idiot fool idiot fool idiot fool" for _ in range(40)]
    other = [good[0], good[1] + " more", body(8), None, "", "the same words again and " * 20, passage + " " + body(20), body(10) + " " + passage]
    texts = good + toxic + other
    docs = [(i, t, "en") for i, t in enumerate(texts)]
    items = [(1, passage), (2, "never found in any of the documents here at all by any means")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(120 <= i < 160)) for i in range(160)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t, _ in docs if not 120 <= i < 160]
    left = [(i, t) for i, t in left if (q := brute.quality(t))[0] >= 20 and 100 * q[4] <= 30 * q[0]]
    first = brute.near_duplicates(left)
    left = [(i, t) for i, t in left if first[i][1] == i]
    bad = {r[0] for r in brute.contamination(left, items) if r[5]}
    left = [(i, t) for i, t in left if i not in bad]
    assert bad == {166, 167} and {i for i, _ in left} == set(range(120))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r[0], list(r[1])) for r in got) == [(i, library.encode(t)) for i, t in left]
