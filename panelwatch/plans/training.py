"""Train candidates on a temporal split, compare, register the champion
(M9-M13, M20-M22, A8-A11), and monitor a panel end to end (K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.operators import drift as D
from panelwatch.operators.features import split_features_target
from panelwatch.operators.models import (
    Candidate, choose_champion, default_candidates, evaluate_candidates, fit_candidates, metrics_long, temporal_split,
)
from panelwatch.operators.profile import split_summary
from panelwatch.operators.scoring import probability_column
from panelwatch.session import materialize
from panelwatch.sources.registry import Registry
from panelwatch.spec import PanelSpec, RegimeSpec


def train_candidates(panel: DataFrame, spec: PanelSpec,
                     candidates: Sequence[Candidate] | None = None):
    """Fit every candidate on the train periods and evaluate all of them on train and
    validation rows in one pass.  Returns ``(models, metrics)``
    where ``metrics`` has one row per (model, split).  The panel is read once: the rows of
    both splits are kept by the executors meanwhile."""
    kept = panel.where(F.col(spec.period).isin([*spec.train_periods, *spec.validation_periods])).select(
        *dict.fromkeys([spec.period, *spec.features, spec.target])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, valid = (split_features_target(part, spec) for part in temporal_split(kept, spec))
        models = fit_candidates(train, spec, list(candidates or default_candidates()))
        return models, materialize(evaluate_candidates(train, valid, spec, models))  # one row per (model, split)
    finally:
        kept.unpersist()


def train_and_register(panel: DataFrame, spec: PanelSpec, registry: Registry, name: str,
                       candidates: Sequence[Candidate] | None = None, register: bool = True):
    """Log every run, pick the best validation AUC (ties by name),
    register it as a new version and move the ``champion`` alias to it
    (``register=False`` stops before registering)."""
    models, metrics = train_candidates(panel, spec, candidates)
    long = metrics_long(metrics)
    split = {r["split"]: r for r in split_summary(panel, spec).collect()}  # two rows
    params = {"train_periods": ",".join(spec.train_periods),
              "validation_periods": ",".join(spec.validation_periods),
              "n_train": split["train"]["n_rows"] if "train" in split else 0,
              "n_validation": split["validation"]["n_rows"] if "validation" in split else 0,
              "train_target_rate": round(split["train"]["target_rate"], 4) if "train" in split else None,
              "split_strategy": "temporal"}
    runs = {}
    for cand_name, model in models.items():
        est = model.stages[-1]
        own = {f"model__{k}": v for k, v in est.description().items()}
        runs[cand_name] = registry.log_run(cand_name, long.where(F.col("model") == cand_name),
                                           params={"algorithm": cand_name, **params, **own}, model=model)
    best = choose_champion(metrics).first()
    if register and best is not None:
        text = (f"{best['model']} trained on {spec.train_periods[0]}..{spec.train_periods[-1]}, "
                f"validated on {spec.validation_periods[0]}..{spec.validation_periods[-1]}, "
                f"validation AUC {best['roc_auc']:.4f}")
        version = registry.register(name, runs[best["model"]], best["model"], best["roc_auc"], text)
        registry.promote(name, version)
    return metrics, best


def score_panel(panel: DataFrame, model, out: str = "prediction") -> DataFrame:
    """Score every row once with the fitted pipeline."""
    scored = probability_column(model.transform(panel), out=out)
    return scored.drop("features", "rawPrediction", "probability")


def monitor_panel(panel: DataFrame, spec: PanelSpec, model, regimes: RegimeSpec,
                  reference: Sequence[str] | None = None, periods: Sequence[str] | None = None,
                  cfg: D.MonitorConfig = D.MonitorConfig()) -> DataFrame:
    """K6: score all rows (R1), take the train periods as reference (R2,
    T2), and compute the monthly drift records (R3-R10).  The scored rows feed one
    aggregate, so the panel is scanned and the model applied once."""
    reference = list(reference or spec.train_periods)
    cols = list(spec.features) + [spec.target, spec.period]
    scored = score_panel(panel.select(*cols), model, cfg.prediction).select(*cols, cfg.prediction)
    return D.monthly_drift(scored, spec, reference, regimes, periods, cfg)
