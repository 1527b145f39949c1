"""Training, replay and scoring jobs over a feature table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sunledger.operators import boosting, folds
from sunledger.operators.boosting import BoostParams, FoldModels
from sunledger.operators.features import LABEL, ONE_HOT_PREFIX, add_calendar, feature_names, training_matrix
from sunledger.operators.quality import null_counts
from sunledger.operators.statistics import category_correlations, correlation_matrix
from sunledger.plans.feedback import pseudo_label
from sunledger.session import materialise
from sunledger.sources.sinks import write_table

KEYS = ("LocationCode", "DateTime")
SITE = "LocationCode"


@dataclass
class TrainingRun:
    """A run's models and tables; a run that was loaded has no matrix."""

    models: FoldModels
    matrix: DataFrame | None
    out_of_fold: DataFrame
    fold_metrics: DataFrame
    cv_metrics: DataFrame


def prepare_matrix(
    table: DataFrame,
    variant: str,
    null_policy: str = "drop",
    fold_count: int = folds.DEFAULT_FOLDS,
    balanced: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Model matrix with folds, written once because training reads it many times.

    The site stays one column, ``SITE``; each of its values counts as a 0/1 feature.
    """
    matrix = training_matrix(table, variant, (), KEYS, null_policy)
    assign = folds.assign_balanced_folds if balanced else folds.assign_folds
    return materialise(assign(matrix, KEYS, fold_count), "matrix"), feature_names(variant, ())


def train(
    matrix: DataFrame, features: Sequence[str], params: BoostParams, fold_ids: Iterable[int] = range(10)
) -> TrainingRun:
    models = boosting.fit_folds(matrix, features, params, fold_ids, KEYS, SITE)
    return _evaluated(models, matrix)


def _evaluated(models: FoldModels, matrix: DataFrame) -> TrainingRun:
    oof = materialise(boosting.out_of_fold(matrix, models, KEYS), "oof")
    return TrainingRun(models, matrix, oof, boosting.fold_metrics(oof), boosting.cv_metrics(oof))


def save_run(run: TrainingRun, path: str) -> None:
    """Models and the tables that describe the run."""
    run.models.save(f"{path}/models")
    features = run.models.features
    numeric = [*features, LABEL]
    correlations = correlation_matrix(run.matrix, numeric).unionByName(
        category_correlations(run.matrix, numeric, SITE, ONE_HOT_PREFIX)
    )
    write_table(correlations, f"{path}/feature_correlations")
    write_table(null_counts(run.matrix, features), f"{path}/null_counts")
    write_table(run.fold_metrics, f"{path}/fold_metrics")
    write_table(run.cv_metrics, f"{path}/cv_metrics")
    write_table(run.out_of_fold, f"{path}/oof_predictions")
    write_table(folds.fold_table(run.matrix, KEYS), f"{path}/fold_assignment")


def load_run(spark: SparkSession, path: str) -> TrainingRun:
    """A saved run, read from its own tables alone."""
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("oof_predictions", "fold_metrics", "cv_metrics")]
    return TrainingRun(FoldModels.load(f"{path}/models"), None, *tables)


def replay_matrix(table: DataFrame, variant: str, path: str, null_policy: str = "drop") -> DataFrame:
    """Model matrix with the folds of a saved run, written once for all its replays."""
    stored = table.sparkSession.read.parquet(f"{path}/fold_assignment")
    folded = folds.replay_folds(table, stored, KEYS)
    return materialise(training_matrix(folded, variant, (), [*KEYS, "fold"], null_policy), "replay")


def replay(
    table: DataFrame,
    variant: str,
    path: str,
    mode: str = "retrain",
    null_policy: str = "drop",
    matrix: DataFrame | None = None,
) -> TrainingRun:
    """Repeat a saved run on its saved folds and parameters.

    ``mode="retrain"`` fits new models, ``mode="rescore"`` evaluates the saved ones.
    Both give the same metrics: sums over rows are of whole numbers, so a model does not
    depend on the order or partitioning of its rows. ``matrix`` is that of ``replay_matrix``,
    if several replays share it.
    """
    saved = FoldModels.load(f"{path}/models")
    matrix = matrix if matrix is not None else replay_matrix(table, variant, path, null_policy)
    if mode == "rescore":
        return _evaluated(saved, matrix)
    if mode == "retrain":
        data = boosting.prepare(matrix, saved.features, SITE, KEYS, saved.params.max_bins, saved.index)
        return _evaluated(boosting.fit_prepared(data, saved.params, saved.models), matrix)
    raise ValueError(f"unknown mode {mode!r}")


def score_table(table: DataFrame, models: FoldModels) -> DataFrame:
    """Ensemble predictions for serving rows; absent or null features count as 0."""
    return boosting.score(add_calendar(table), models, KEYS)


def save_scores(table: DataFrame, models: FoldModels, path: str) -> DataFrame:
    """Store the scored features and the predictions; returns the predictions."""
    write_table(add_calendar(table), f"{path}/scored_features")
    stored = table.sparkSession.read.parquet(f"{path}/scored_features")
    write_table(score_table(stored, models), f"{path}/predictions")
    return table.sparkSession.read.parquet(f"{path}/predictions")


def pseudo_label_round(
    training: DataFrame, serving: DataFrame, models: FoldModels
) -> DataFrame:
    """Training rows plus the serving rows labelled with the ensemble's predictions."""
    return pseudo_label(training, serving, score_table(serving, models))
