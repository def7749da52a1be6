"""Panel I/O, request batches, registry versions/aliases, stream = batch."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelwatch.operators import models as MD
from panelwatch.operators import scoring as S
from panelwatch.plans import training as TR
from panelwatch.sources import panel_io as IO
from panelwatch.sources.registry import Registry
from panelwatch.sources.tables import LINEITEM_SPEC, lineitem_panel
from panelwatch.spec import PanelSpec
from panelwatch.streaming.score_stream import read_quarantine, read_scored, score_stream

SF = "/root/testdata/sf0.001"


def test_write_load_panel_partition_pruning(spark):
    spec = PanelSpec(period="m", id="i", target="y", numeric=("x",), categorical=())
    df = spark.createDataFrame([("a", "2024-01", 1.0, 0), ("b", "2024-02", 2.0, 1),
                                ("c", "2024-03", 3.0, 0)], "i string, m string, x double, y int")
    path = os.path.join(tempfile.mkdtemp(prefix="pw-io-"), "panel")
    IO.write_panel(df, path, spec)
    back = IO.load_panel(spark, path, spec, ["2024-01", "2024-03"])
    assert sorted(r.i for r in back.collect()) == ["a", "c"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01" in plan
    with pytest.raises(IO.MissingPeriodsError) as e:
        IO.load_panel(spark, path, spec, ["2024-05", "2024-01", "2023-12"])
    assert e.value.missing == ["2023-12", "2024-05"]


def test_request_batch_and_single(spark):
    d = tempfile.mkdtemp(prefix="pw-req-")
    one = {"age": 42, "gender": "F", "region": "Centro", "senior_citizen": "No",
           "contract_type": "Month-to-month", "tenure_months": 3, "monthly_charges": 94.5,
           "payment_method": "Electronic check", "paperless_billing": "Yes",
           "monthly_usage_gb": 8.2, "support_tickets_30d": 3, "avg_session_minutes": 18.4,
           "num_services": 2, "late_payments_3m": 2}
    bad = dict(one, age="cuarenta y dos")
    with open(os.path.join(d, "batch.json"), "w") as f:
        json.dump({"customers": [one, bad]}, f)
    with open(os.path.join(d, "single.json"), "w") as f:
        json.dump(one, f)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(r.name, T.StringType()) for r in S.CHURN_RULES])
    rows = IO.read_request_batch(spark, d, schema)
    v = S.validate_rows(rows, S.CHURN_RULES).collect()
    assert len(v) == 3
    assert sorted(len(r.errors) for r in v) == [0, 0, 1]
    assert any(e.startswith("age:") for r in v for e in r.errors)


def test_registry_versions_and_alias(spark):
    reg = Registry(spark, tempfile.mkdtemp(prefix="pw-reg-"))
    r1 = reg.log_run("logistic", {"validation_roc_auc": 0.8, "train_roc_auc": 0.9}, {"C": 1})
    r2 = reg.log_run("gbt", {"validation_roc_auc": 0.85})
    assert reg.register("m", r1, "logistic") == 1
    assert reg.register("m", r2, "gbt") == 2
    reg.promote("m", 1)
    assert reg.resolve("m").first().version == 1
    reg.promote("m", 2)
    info = reg.model_info("m").first()
    assert (info.version, info.algorithm) == ("2", "gbt")
    assert info.metrics == {"validation_roc_auc": 0.85}
    reg1 = reg.model_info("m").first()
    assert "train_roc_auc" not in reg1.metrics


def test_train_register_score_single_equals_batch(spark):
    panel = lineitem_panel(spark, "/root/testdata/sf0.01")
    reg = Registry(spark, tempfile.mkdtemp(prefix="pw-reg-"))
    cands = [MD.Candidate("logistic_regression", "logistic")]
    metrics, best = TR.train_and_register(panel, LINEITEM_SPEC, reg, "li", cands)
    assert best["model"] == "logistic_regression"
    model, info = reg.load_champion("li")
    batch = panel.limit(5).collect()
    many = S.score_batch(spark.createDataFrame(batch, panel.schema), model, model_version="1",
                         keep=["l_orderkey", "l_linenumber"]).collect()
    one = S.score_batch(spark.createDataFrame(batch[:1], panel.schema), model,
                        model_version="1", keep=["l_orderkey", "l_linenumber"]).collect()
    assert one[0] == [r for r in many if (r.l_orderkey, r.l_linenumber) ==
                      (one[0].l_orderkey, one[0].l_linenumber)][0]
    assert set(r.risk_band for r in many) <= {"bajo", "medio", "alto"}


def test_stream_equals_batch_and_quarantine(spark):
    src = tempfile.mkdtemp(prefix="pw-src-")
    df = spark.createDataFrame([(1.0, "O"), (2.0, "F"), (-5.0, "O"), (3.0, "X")],
                               "x double, s string")
    df.write.mode("overwrite").parquet(src)
    rules = (S.FieldRule("x", "double", ge=0), S.FieldRule("s", "string", allowed=("O", "F")))
    out = tempfile.mkdtemp(prefix="pw-out-")

    def scorer(b):
        return b.withColumn("p", F.col("x") / 10)

    score_stream(spark, src, df.schema, rules, scorer, out)
    got = sorted((r.x, r.p) for r in read_scored(spark, out).collect())
    assert got == [(1.0, 0.1), (2.0, 0.2)]
    q = sorted(r.errors[0] for r in read_quarantine(spark, out).collect())
    assert q == ["s: value not allowed", "x: must be >= 0"]


def test_load_csv_months_period_from_file_name(spark):
    from pyspark.sql import types as T
    d = tempfile.mkdtemp(prefix="pw-csv-")
    for m, rows in (("2024-01", ["a,1.5,0", "b,2.5,1"]), ("2024-02", ["a,3.0,0"])):
        with open(os.path.join(d, f"{m}.csv"), "w") as f:
            f.write("customer_id,x,churn\n" + "\n".join(rows) + "\n")
    schema = T.StructType([T.StructField("customer_id", T.StringType()),
                           T.StructField("x", T.DoubleType()),
                           T.StructField("churn", T.IntegerType())])
    spec = PanelSpec(period="snapshot_month", id="customer_id", target="churn", numeric=("x",),
                     categorical=())
    df = IO.load_csv_months(spark, d, schema, spec, ["2024-02"])
    assert [(r.customer_id, r.snapshot_month) for r in df.collect()] == [("a", "2024-02")]
    with pytest.raises(IO.MissingPeriodsError):
        IO.load_csv_months(spark, d, schema, spec, ["2024-03"])
    assert IO.load_csv_months(spark, d, schema, spec).count() == 3


def test_load_csv_months_goes_by_header_names(spark, tmp_path):
    from pyspark.sql import types as T
    (tmp_path / "2024-01.csv").write_text("b,a\n1,2\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    spec = PanelSpec(period="month", id="a", target="b", numeric=(), categorical=())
    r = IO.load_csv_months(spark, str(tmp_path), schema, spec).first()
    assert (r.a, r.b, r.month) == (2, 1, "2024-01")
