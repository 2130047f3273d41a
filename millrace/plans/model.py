"""Training, selection, promotion and scoring of the classifier on Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from millrace.functions.columns import feature_columns
from millrace.functions.joins import anti_join
from millrace.functions.times import processing_time
from millrace.operators.metrics import classification_metrics, prediction_summary, promotion_decisions, ranking_metrics
from millrace.operators.preprocessing import impute, modes, scale_values
from millrace.operators.quantiles import exact_medians
from millrace.operators.training_set import SPLITS, cutoff_dates, label_coverage, labeled_only, split_column
from millrace.plans import clinical as c
from millrace.plans.registry import CHALLENGER, CHAMPION, REJECTED, RETIRED, Registry
from millrace.plans.silver import SKIPPED, WRITTEN
from millrace.plans.store import Store
from millrace.session import written
from millrace.sources.tables import TableMissing

INPUTS = "features"
WEIGHT = "class_weight"
SPLIT = "split"

# Hyper-parameter grid in search order, promotion gates, split percentiles, retrain trigger.
GRID = tuple((strength, penalty) for strength in (0.01, 0.1, 1.0, 10.0) for penalty in ("l2", "l1"))
MIN_AUC_PR = 0.35
MIN_AUC_ROC = 0.65
SPLIT_FRACTIONS = (0.70, 0.90)
RETRAIN_AFTER = 5_000
MAX_ITER = 1_000
SCORING_THRESHOLD = 0.5

# Grid points fitted side by side, so that the short jobs of one fit fill the gaps of another.
FITS_AT_ONCE = 4


@dataclass(frozen=True)
class ModelTask:
    """Roles of the columns of a training table."""

    entity: Sequence[str] = (c.ENTITY,)
    date: str = c.OBSERVED
    label: str = c.LABEL
    hidden: Iterable[str] = c.NOT_FEATURES
    forbidden: Iterable[str] = c.FORBIDDEN
    # Output columns of the predictions.
    prob: str = c.PROBABILITY
    pred: str = c.PREDICTION

    def features(self, df: DataFrame) -> list[str]:
        return feature_columns(df, self.hidden, self.forbidden)


@dataclass
class GridPoint:
    index: int
    strength: float
    penalty: str
    model: LogisticRegressionModel
    threshold: float | None = None
    metrics: dict[str, dict[str, float | None]] = field(default_factory=dict)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preparation(train: DataFrame, features: Sequence[str]) -> list[Transformer]:
    """Median or mode imputation and scaling as one SQL projection, ordinal codes by an indexer, then the feature vector.

    All fitted state is constants of the model or its dictionaries, so scoring is a projection and needs no join.
    """
    text = [f for f in features if isinstance(train.schema[f].dataType, StringType)]
    numeric = [f for f in features if f not in text]
    medians = exact_medians(train, numeric)
    scales = scale_values(impute(train.select(*numeric), medians), numeric)
    fills = modes(train, text)
    inputs = []
    for f in numeric:
        mean, deviation = scales[f]
        fill = mean if medians[f] is None else medians[f]
        inputs.append(f"(coalesce(CAST(`{f}` AS DOUBLE), {fill!r}D) - ({mean!r}D)) / {deviation!r}D AS `in_{f}`")
    # A column without any value gets one, so that it has a dictionary.
    filled = {f: "''" if fills[f] is None else _literal(fills[f]) for f in text}
    inputs += [f"coalesce(CAST(`{f}` AS STRING), {filled[f]}) AS `text_{f}`" for f in text]
    stages: list[Transformer] = [SQLTransformer(statement=f"SELECT *, {', '.join(inputs)} FROM __THIS__")]
    if text:
        indexer = StringIndexer(
            inputCols=[f"text_{f}" for f in text], outputCols=[f"index_{f}" for f in text],
            stringOrderType="alphabetAsc", handleInvalid="keep",
        )
        model = indexer.fit(stages[0].transform(train.select(*features)))
        # The indexer gives unseen values the number after the last.
        sizes = {f: len(labels) for f, labels in zip(text, model.labelsArray, strict=True)}
        codes = ", ".join(f"CASE WHEN `index_{f}` = {sizes[f]} THEN -1D ELSE `index_{f}` END AS `in_{f}`" for f in text)
        stages += [model, SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")]
    return [*stages, VectorAssembler(inputCols=[f"in_{f}" for f in features], outputCol=INPUTS)]


def apply_stages(df: DataFrame, stages: Sequence[Transformer]) -> DataFrame:
    return reduce(lambda rows, stage: stage.transform(rows), stages, df)


def balanced_weight(df: DataFrame, label: str) -> Column:
    """n / (2 * n_class) of the rows at hand."""
    row = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    if not row["pos"] or not row["neg"]:
        raise ValueError(f"training rows must contain both classes, got {row['pos']} positive, {row['neg']} negative")
    total = row["pos"] + row["neg"]
    return F.when(F.col(label) == 1, total / (2 * row["pos"])).otherwise(total / (2 * row["neg"]))


def logistic(strength: float, penalty: str, n: int, label: str) -> LogisticRegression:
    """Logistic regression with inverse regularisation strength ``strength`` over ``n`` rows.

    Spark divides the loss by the sum of weights, and balanced weights sum to ``n``; hence 1 / (strength * n).
    """
    return LogisticRegression(
        featuresCol=INPUTS,
        labelCol=label,
        weightCol=WEIGHT,
        maxIter=MAX_ITER,
        regParam=1.0 / (strength * n),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
    )


def with_probability(df: DataFrame, model: LogisticRegressionModel, name: str) -> DataFrame:
    """Add the probability of class 1."""
    named = model.copy().setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    return named.transform(df).withColumn(name, vector_to_array("_p")[1]).drop("_p")


def probabilities(models: Sequence[LogisticRegressionModel], array: str) -> list[Column]:
    """The probability of class 1 by each of the models, as arithmetic over an array column of the features.

    The vector is taken apart once for all models; the sums run in the order of the features, as the models' own.
    """

    def probability(model: LogisticRegressionModel) -> Column:
        terms = [F.get(F.col(array), F.lit(k)) * F.lit(float(w)) for k, w in enumerate(model.coefficients) if w]
        margin = reduce(lambda a, b: a + b, terms, F.lit(0.0)) + F.lit(float(model.intercept))
        return F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(margin))

    return [probability(model) for model in models]


def prepared(df: DataFrame, stages: Sequence[Transformer], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label as the classifier takes them, and the columns to keep."""
    return apply_stages(df, stages).select(INPUTS, F.col(label).cast("double").alias(label), *keep)


def grid_search(frame: DataFrame, label: str, grid: Sequence[tuple[float, str]] = GRID) -> list[GridPoint]:
    """One fit per grid point on split 'train', judged on 'train' and 'val'.

    ``frame`` has feature vector, label and split, and is scanned several times. All models are evaluated together: the
    rows are scored by every model in one pass and the metrics of all points come from one curve per model and split.
    """
    train = frame.filter(F.col(SPLIT) == "train")
    weighted = train.withColumn(WEIGHT, balanced_weight(train, label)).select(INPUTS, label, WEIGHT)

    @inheritable_thread_target(frame.sparkSession)
    def fit(point: tuple[int, tuple[float, str]]) -> GridPoint:
        index, (strength, penalty) = point
        return GridPoint(index, strength, penalty, logistic(strength, penalty, n, label).fit(weighted))

    # Every fit scans the rows twice before it keeps blocks of its own; what is cached can be read again from the table.
    weighted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = weighted.count()
        with ThreadPool(min(FITS_AT_ONCE, len(grid))) as pool:
            points = pool.map(fit, list(enumerate(grid)), chunksize=1)
    finally:
        weighted.unpersist()

    # A point on a split has one number: rows are wide here, so they carry nothing else.
    splits = ("train", "val")
    judged = frame.filter(F.col(SPLIT).isin(*splits))
    judged = judged.select(label, (F.col(SPLIT) == "val").cast("int").alias("split"), vector_to_array(INPUTS).alias("x"))
    scores = F.posexplode(F.array(*probabilities([p.model for p in points], "x")))
    scored = judged.select(label, "split", scores.alias("point", "prob"))
    slot = (F.col("point") * len(splits) + F.col("split")).alias("slot")
    with written(scored.select(label, slot, "prob"), "grid") as rows:
        slots = {p.index * len(splits) + k: (p, split) for p in points for k, split in enumerate(splits)}
        ranked = {r["slot"]: r for r in ranking_metrics(rows, "prob", label, ["slot"]).collect()}
        for p in points:
            val = ranked.get(p.index * len(splits) + 1)
            p.threshold = val["threshold"] if val else SCORING_THRESHOLD
        cut = F.get(F.array(*[F.lit(p.threshold) for p, _ in slots.values()]), F.col("slot"))
        at_cut = classification_metrics(rows.withColumn("cut", cut), "prob", label, "cut", ["slot"]).collect()
    for row in at_cut:
        point, split = slots[row["slot"]]
        point.metrics[split] = _metrics(ranked[row["slot"]], row, point.threshold)
    return points


def _metrics(ranked, at_cut, threshold: float) -> dict[str, float | None]:
    return {
        "auc_pr": ranked["auc_pr"],
        "auc_roc": ranked["auc_roc"],
        **{m: at_cut[m] for m in ("f1", "precision", "recall", "n", "prevalence")},
        "threshold": threshold,
    }


def best_point(points: Sequence[GridPoint]) -> GridPoint:
    """Highest AUC-PR on 'val'; the first in grid order on ties."""
    return max(points, key=lambda p: (p.metrics.get("val", {}).get("auc_pr") or -1.0, -p.index))


def evaluate(df: DataFrame, prob: str, label: str, threshold: float) -> dict[str, float | None]:
    """All metrics of scored rows at a given threshold."""
    ranked = ranking_metrics(df, prob, label).first()
    at_cut = classification_metrics(df, prob, label, threshold).first()
    return _metrics(ranked, at_cut, threshold)


@dataclass
class TrainingResult:
    status: str
    decision: str | None = None
    champion: int | None = None
    challenger: int | None = None
    test_metrics: dict = field(default_factory=dict)
    points: list[GridPoint] = field(default_factory=list)


def train(
    store: Store,
    task: ModelTask | None = None,
    grid: Sequence[tuple[float, str]] = GRID,
    gates: tuple[float, float] = (MIN_AUC_PR, MIN_AUC_ROC),
    now: datetime | None = None,
) -> TrainingResult:
    """Split, search the grid, and let the best point challenge the champion on the test split.

    The challenger is registered before the test split is looked at, with the threshold fixed on 'val'. Below the gates,
    or without strictly more AUC-PR than the champion, it becomes 'rejected'. Otherwise its hyper-parameters are fitted
    again on all labelled rows, that model becomes 'champion' and the previous one 'retired'. The metrics logged for a
    champion are those of the challenger it came from (``metrics_of``).
    """
    task = task or ModelTask()
    table, registry = store.gold("training"), Registry(store, now)
    try:
        rows = table.read()
    except TableMissing:
        return TrainingResult(SKIPPED)
    label = task.label
    features = task.features(rows)
    coverage = label_coverage(rows, label).first()
    labeled = labeled_only(rows, label)
    train_end, val_end = cutoff_dates(labeled, task.date, SPLIT_FRACTIONS)
    if train_end is None:
        return TrainingResult(SKIPPED)
    splits = labeled.select(*features, label, split_column(task.date, train_end, val_end).alias(SPLIT))
    splits = splits.filter(F.col(SPLIT).isNotNull())
    sizes = {r[SPLIT]: r["count"] for r in splits.groupBy(SPLIT).count().collect()}
    lineage = {
        **{f"n_{name}": sizes.get(name, 0) for name in SPLITS},
        "selection_metric": "val_auc_pr",
        "train_end": train_end,
        "val_end": val_end,
        "table_version": table.modified(),
        "n_labeled": coverage["n_labeled"],
        "n_unlabeled": coverage["n_excluded"],
        "n_features": len(features),
    }

    stages = fit_preparation(splits.filter(F.col(SPLIT) == "train"), features)
    with written(prepared(splits, stages, label, [SPLIT]), "prepared") as frame:
        points = grid_search(frame, label, grid)
        best = best_point(points)
        (search_id,) = registry.log_runs([{"kind": "grid_search", "params": {**lineage, "grid_size": len(points)}}])
        ids = registry.log_runs(
            [
                {
                    "kind": "grid_point",
                    "parent_id": search_id,
                    "params": {**lineage, "C": p.strength, "penalty": p.penalty},
                    "metrics": {f"{s}_{k}": v for s, m in p.metrics.items() for k, v in m.items()},
                }
                for p in points
            ]
        )
        chosen = {**lineage, "C": best.strength, "penalty": best.penalty, "best_run": ids[best.index]}
        challenger = registry.register(
            PipelineModel([*stages, best.model]), ids[best.index], {**chosen, "threshold": best.threshold}, CHALLENGER
        )
        test = with_probability(frame.filter(F.col(SPLIT) == "test"), best.model, "prob")
        metrics = evaluate(test, "prob", label, best.threshold)

    def finish(decision: str, champion: int | None) -> TrainingResult:
        registry.drop_alias(CHALLENGER)
        logged = {**chosen, "decision": decision, "metrics_of": f"version {challenger}"}
        registry.log_runs(
            [
                {
                    "kind": "training",
                    "parent_id": search_id,
                    "params": logged,
                    "metrics": {f"test_{k}": v for k, v in metrics.items()},
                }
            ]
        )
        return TrainingResult(WRITTEN, decision, champion, challenger, metrics, points)

    current = registry.version_of(CHAMPION)
    in_office = None
    if current is not None:
        held_out = registry.load(current).transform(splits.filter(F.col(SPLIT) == "test"))
        in_office = ranking_metrics(held_out.select(label, vector_to_array("probability")[1].alias("prob")), "prob", label)
    measured = store.spark.createDataFrame([(metrics["auc_pr"], metrics["auc_roc"])], "auc_pr DOUBLE, auc_roc DOUBLE")
    decision = promotion_decisions(measured, in_office, *gates).first()["decision"]
    if decision != "champion":
        registry.set_alias(REJECTED, challenger)
        return finish(decision, current)

    model = fit_final(splits, features, label, best.strength, best.penalty)
    champion = registry.register(model, ids[best.index], {**chosen, "threshold": best.threshold}, CHAMPION)
    if current is not None:
        registry.set_alias(RETIRED, current)
    return finish("champion", champion)


def fit_final(df: DataFrame, features: Sequence[str], label: str, strength: float, penalty: str) -> PipelineModel:
    """Preparation and classifier fitted on all rows given."""
    stages = fit_preparation(df, features)
    with written(prepared(df, stages, label), "refit") as frame:
        weighted = frame.withColumn(WEIGHT, balanced_weight(frame, label))
        return PipelineModel([*stages, logistic(strength, penalty, frame.count(), label).fit(weighted)])


def train_if_due(store: Store, threshold: int = RETRAIN_AFTER, task: ModelTask | None = None, **options) -> TrainingResult:
    """Train when at least ``threshold`` labels are new since the last completed training."""
    task = task or ModelTask()
    try:
        rows = store.gold("training").read()
    except TableMissing:
        return TrainingResult(SKIPPED)
    labeled = label_coverage(rows, task.label).first()["n_labeled"]
    if labeled - Registry(store).last_trained_count() < threshold:
        return TrainingResult(SKIPPED)
    return train(store, task, **options)


def predictions(
    scored: DataFrame,
    entity: Sequence[str],
    prob: Column,
    threshold: float,
    version: int,
    now: datetime | None = None,
    names: tuple[str, str] = (c.PROBABILITY, c.PREDICTION),
) -> DataFrame:
    """Prediction rows; the class is decided on the unrounded probability."""
    return scored.select(
        *entity,
        F.round(prob, 4).alias(names[0]),
        (prob >= F.lit(threshold)).cast("int").alias(names[1]),
        F.lit(threshold).cast("double").alias("threshold"),
        F.lit(version).alias("champion_version"),
        processing_time(now).alias("scored_at"),
    )


def score_new(
    store: Store, task: ModelTask | None = None, threshold: float = SCORING_THRESHOLD, now: datetime | None = None
) -> tuple[str, dict]:
    """Score assembled entities that have no prediction yet with the champion and append the result.

    (status, summary of the new predictions). Without a champion or assembled rows nothing happens.
    """
    task = task or ModelTask()
    registry = Registry(store, now)
    version = registry.version_of(CHAMPION)
    target = store.gold("predictions")
    if version is None:
        return SKIPPED, {}
    try:
        rows = store.gold("assembled").read()
    except TableMissing:
        return SKIPPED, {}
    features = task.features(rows)
    if target.exists():
        rows = anti_join(rows, target.read(), list(task.entity), unique=True)
    scored = registry.load(version).transform(rows.select(*task.entity, *features))
    prob = vector_to_array("probability")[1]
    names = (task.prob, task.pred)
    with written(predictions(scored, task.entity, prob, threshold, version, now, names), "predictions") as new:
        summary = prediction_summary(new, *names).first().asDict()
        if summary["n"] == 0:
            return SKIPPED, summary
        target.append(new)
    return WRITTEN, summary
