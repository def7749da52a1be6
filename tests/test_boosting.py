"""Boosted trees against hand computation, a plain version, and themselves under another layout."""

import math
import pickle
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from panelwatch.operators import boosting
from panelwatch.operators.boosting import BoostedTrees, Tree, best_splits, binned


def frame(spark, rows):
    return spark.createDataFrame([(Vectors.dense(x), y, w) for x, y, w in rows], ["features", "y", "w"])


def booster(**kw):
    return BoostedTrees(labelCol="y", weightCol="w", **{"subsamplingRate": 1.0, "colSample": 1.0, "minChildWeight": 0.0, **kw})


def margins(model, df):
    return [r["rawPrediction"][1] for r in model.transform(df).collect()]


def test_stump_by_hand(spark):
    # base log(2/2) = 0, so p = 1/2, g = 1/2 or -1/2 and h = 1/4 in every row
    rows = [((1.0,), 0, 1.0), ((2.0,), 0, 1.0), ((3.0,), 1, 1.0), ((4.0,), 1, 1.0)]
    model = booster(maxIter=1, maxDepth=1, stepSize=0.5, l2=1.0).fit(frame(spark, rows))
    edges, base, (tree,) = model.trees()
    assert edges == [[1.0, 2.0, 3.0, 4.0]] and base == 0.0
    assert tree.feature[1] == 0 and tree.cut[1] == 1  # values up to 2.0 go left
    # left G = 1, H = 1/2: leaf -0.5 * 1 / 1.5; gain 2 * 1 / 1.5 - 0
    assert tree.value[2] == pytest.approx(-1 / 3) and tree.value[3] == pytest.approx(1 / 3)
    assert tree.gain[1] == pytest.approx(4 / 3)
    assert margins(model, frame(spark, rows)) == pytest.approx([-1 / 3, -1 / 3, 1 / 3, 1 / 3])


def test_two_levels_by_hand(spark):
    # exclusive or with an uneven corner: the root has no gain from the second feature alone
    rows = [((0.0, 0.0), 0, 1.0), ((0.0, 1.0), 1, 1.0), ((1.0, 0.0), 1, 1.0), ((1.0, 1.0), 0, 1.0), ((1.0, 0.0), 1, 1.0), ((0.0, 0.0), 0, 1.0)]
    model = booster(maxIter=1, maxDepth=2, stepSize=1.0, l2=0.5).fit(frame(spark, rows))
    _, base, (tree,) = model.trees()
    assert base == 0.0
    # per corner: (0,0) two rows g=.5; (0,1) g=-.5; (1,0) two rows g=-.5; (1,1) g=.5; h = 1/4 each
    # root on feature 0: left G=.5, H=.75 and right G=-.5, H=.75: 2 * .25 / 1.25; feature 1: left H=1, G=0
    assert tree.feature[1] == 0 and tree.gain[1] == pytest.approx(0.4)
    assert tree.feature[2] == 1 and tree.feature[3] == 1
    leaves = [-1 / (0.5 + 0.5), 0.5 / (0.25 + 0.5), 1 / (0.5 + 0.5), -0.5 / (0.25 + 0.5)]
    assert list(tree.value[4:8]) == pytest.approx(leaves)
    assert margins(model, frame(spark, rows))[:4] == pytest.approx([leaves[0], leaves[1], leaves[2], leaves[3]])


def plain(x, y, w, depth, trees, rate, l2, min_child, edges):
    """The same boosting, node by node over whole arrays."""
    bins = binned(x, edges)
    f = np.full(len(y), math.log(w[y == 1].sum() / w[y == 0].sum()))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = w * (p - y), w * p * (1 - p)
        todo, out = [(np.arange(len(y)), 0)], np.zeros(len(y))
        while todo:
            at, level = todo.pop()
            best = (1e-12, None)
            score = g[at].sum() ** 2 / (h[at].sum() + l2)
            for c in range(len(edges)) if level < depth else ():
                for b in range(len(edges[c]) - 1):
                    left = bins[c, at] <= b
                    hl, hr = h[at][left].sum(), h[at][~left].sum()
                    if left.any() and (~left).any() and hl >= min_child and hr >= min_child:
                        gain = g[at][left].sum() ** 2 / (hl + l2) + g[at][~left].sum() ** 2 / (hr + l2) - score
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (c, b))
            if best[1] is None:
                out[at] = -rate * g[at].sum() / (h[at].sum() + l2)
            else:
                c, b = best[1]
                left = bins[c, at] <= b
                todo += [(at[left], level + 1), (at[~left], level + 1)]
        f = f + out
    return f


def noisy(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = (rng.gauss(0, 1), float(rng.randrange(4)), rng.random())
        rows.append((x, int(x[0] + (x[1] == 2) + rng.gauss(0, .7) > .5), rng.choice([1.0, 2.5])))
    return rows


def test_trees_equal_the_plain_version(spark):
    rows = noisy(300)
    df = frame(spark, rows)
    model = booster(maxIter=6, maxDepth=3, stepSize=0.3, maxBins=16, minChildWeight=1.0).fit(df)
    edges, _, trees = model.trees()
    assert [len(e) for e in edges] == [16, 4, 16] and len(trees) == 6
    x, y, w = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    want = plain(x, y, w, 3, 6, 0.3, 1.0, 1.0, edges)
    assert margins(model, df) == pytest.approx(list(want), abs=1e-6)


def test_layout_and_company_do_not_change_trees(spark, monkeypatch):
    df = frame(spark, noisy(500, 3))
    kw = {"maxIter": 30, "maxDepth": 3, "subsamplingRate": .7, "colSample": .67}
    alone = booster(**kw).fit(df.coalesce(1)).getOrDefault("ensemble")
    assert booster(**kw).fit(df.repartition(6)).getOrDefault("ensemble") == alone
    first, second = boosting.fit_together(df, [booster(**kw), booster(**{**kw, "maxDepth": 2, "maxIter": 5})])
    assert first.getOrDefault("ensemble") == alone and len(second.trees()[2]) == 5
    # many small partitions, merged in rounds, and workers without cached margins
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 60)
    monkeypatch.setattr(boosting, "MERGE", 2)
    short = {**kw, "maxIter": 3}
    few = booster(**short).fit(df.repartition(7)).trees()[2]
    full = booster(**kw).fit(df.coalesce(1)).trees()[2][:3]
    assert all((a.feature == b.feature).all() and (a.value == b.value).all() for a, b in zip(few, full))


def test_driver_reads_splits_not_histograms(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 60)
    over_all, sizes = boosting._over_all, []

    def measured(*args):
        found = over_all(*args)
        sizes.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(boosting, "_over_all", measured)
    booster(maxIter=1, maxDepth=4).fit(frame(spark, noisy(500, 3)).repartition(7))
    # a level of 8 nodes: 2 x 8 x 3 x 64 whole numbers in its histogram, 7 in the split of a node
    assert len(sizes) == 4 and max(sizes) < 8 * 7 * 16


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = frame(spark, noisy(200, 5))
    model = PipelineModel([booster(maxIter=4, maxDepth=2).fit(df)])
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert margins(again, df) == margins(model, df)
    out = again.transform(df).first()
    assert out["probability"][1] == pytest.approx(1 / (1 + math.exp(-out["rawPrediction"][1])))
    assert sum(again.stages[0].featureImportances) == pytest.approx(1) and again.stages[0].description()["maxDepth"] == 2


def test_degenerate_inputs(spark):
    one = booster(maxIter=3).fit(frame(spark, [((1.0,), 1, 1.0), ((2.0,), 1, 1.0)]))
    assert one.trees()[1] == 30.0 and one.trees()[2] == []
    same = booster(maxIter=2).fit(frame(spark, [((1.0,), 1, 1.0), ((1.0,), 0, 1.0)]))
    assert all((t.feature == -1).all() for t in same.trees()[2])
    df = frame(spark, [((1.0,), 1, 1.0), ((2.0,), 0, 1.0)]).unionByName(frame(spark, [((9.0,), 0, 1.0)]).selectExpr("features", "cast(null as bigint) y", "w"))
    assert booster(maxIter=1).fit(df).trees()[1] == 0.0
    assert margins(one, frame(spark, [((5.0,), 0, 1.0)]).where("false")) == []


def test_splits_prefer_the_first_of_equals():
    hist = np.zeros((2, 1, 2, 3), np.int64)
    hist[0, 0] = [[-4, 4, 0], [-4, 4, 0]]
    hist[1, 0] = [[4, 4, 0], [4, 4, 0]]
    (gain, c, b, gl, hl, G, H), = best_splits(hist, 0.5, 1.0, 1.0)
    assert (c, b, gl, hl, G, H) == (0, 0, -2.0, 2.0, 0.0, 4.0) and gain == pytest.approx(8 / 3)
    assert Tree.empty(3).depth == 3


def test_equal_rows_are_kept_once(spark, monkeypatch):
    rows, held = noisy(60, 7), []
    grow = boosting._grow

    def seen(blocks, *args):
        held.extend(blocks.collect())
        return grow(blocks, *args)

    monkeypatch.setattr(boosting, "_grow", seen)
    kw = {"maxIter": 3, "maxDepth": 2, "subsamplingRate": .8}
    many = booster(**kw).fit(frame(spark, rows * 40))
    assert sum(b[0] for b in held) <= 60 and sum(int(np.frombuffer(b[6], np.int64).sum()) for b in held) == 60 * 40
    # a row forty times is a row of forty times the weight (the whole numbers' step is another)
    heavy = booster(**kw).fit(frame(spark, [(x, y, 40 * w) for x, y, w in rows]))
    for a, b in zip(many.trees()[2], heavy.trees()[2], strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and list(a.value) == pytest.approx(list(b.value))


def test_margins_follow_from_chunk_to_chunk(spark, monkeypatch):
    df = frame(spark, noisy(300, 9))
    kw = {"maxIter": 5, "maxDepth": 3, "subsamplingRate": .7, "colSample": .67}
    alone = booster(**kw).fit(df).getOrDefault("ensemble")
    monkeypatch.setattr(boosting, "CHUNK", 2)
    assert booster(**kw).fit(df).getOrDefault("ensemble") == alone
    monkeypatch.setattr(boosting, "CHUNK_SPREAD", 2)
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 60)
    assert booster(**kw).fit(df).getOrDefault("ensemble") == alone


def test_lookup_finds_the_leaf_that_a_walk_finds():
    rng = np.random.default_rng(4)
    shape = boosting.Shape.of([list(range(k)) for k in (50, 64, 3, 256, 1)])
    bins = np.stack([rng.integers(0, k, 400) for k in shape.kinds]).astype(np.uint8)
    assert shape.groups == [[0, 1], [2, 3, 4]]
    for depth in (0, 1, 4, 6, 7):
        tree = Tree.empty(depth)
        tree.value[:] = rng.random(len(tree.value))
        for node in range(1, 1 << depth):
            if node == 1 or (tree.feature[node // 2] != -1 and (depth > 6 or rng.random() < .8)):
                f = rng.integers(0, 4)
                tree.feature[node], tree.cut[node] = f, rng.integers(0, shape.kinds[f] - 1)
        lookup = tree.lookup(shape)
        if depth > 6:
            assert lookup is None  # 128 leaves
        got = boosting._advanced(np.zeros(400), [tree], shape, shape.codes(bins), bins)
        assert (got == tree.margins(bins)).all()
    assert not hasattr(pickle.loads(pickle.dumps(tree)), "found")
