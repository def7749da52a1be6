"""Training on a temporal split: how often the panel is read."""

import random

from panelwatch.operators.models import Candidate
from panelwatch.plans.training import train_candidates
from panelwatch.spec import PanelSpec

SPEC = PanelSpec(period="m", id="id", target="y", numeric=("a", "b"), categorical=("k",), train_periods=("2024-01", "2024-02"), validation_periods=("2024-03",))


def test_panel_is_read_once(spark):
    rng, read = random.Random(5), spark.sparkContext.accumulator(0)
    rows = [(i, f"2024-0{1 + i % 4}", rng.gauss(0, 1), None if i % 9 == 0 else rng.random(), rng.choice("uv"), rng.randrange(2)) for i in range(80)]

    def counted(r):
        read.add(1)
        return r

    panel = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), "id long, m string, a double, b double, k string, y int")
    _, metrics = train_candidates(panel, SPEC, [Candidate("logistic", "logistic"), Candidate("trees", "gbt", max_iter=2, depth=2)])
    got = {(r["model"], r["split"]): r["n"] for r in metrics.collect()}
    assert got == {(m, s): n for m in ("logistic", "trees") for s, n in (("train", 40), ("validation", 20))}
    assert read.value == len(rows)
