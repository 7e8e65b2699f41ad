"""Feature selection, the six classifiers, tuning, evaluation and comparison."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col
from riskloom.functions.ordering import group_sizes
from riskloom.operators import correlation, scoring
from riskloom.operators.cleaning import median_fill
from riskloom.operators.encoding import margin_to_probability
from riskloom.operators.information import nearest_mutual_information
from riskloom.operators.joins import feature_score_join, models_vs_baseline
from riskloom.operators.sampling import with_folds
from riskloom.plans.baseline import MajorityClass
from riskloom.plans.ensembles import BaggedTrees, BoostedStumps, GradientBoosting, impurity_importances
from riskloom.plans.linear import LinearClassifier, linear_model, search
from riskloom.session import materialize, ship_package

LABEL, FEATURES, WEIGHT, FOLD = "label", "features", "weight", "fold"

# Features kept, folds, seeds and the tuning grids.
FEATURES_KEPT = 30
FOLDS = 5
SEED = 39
ROWS_PER_TASK = 50_000
GRIDS = {
    "ZeroR Baseline": {"strategy": ["most_frequent", "prior", "stratified", "uniform"]},
    "Logistic Regression": {"C": [0.001, 0.01, 0.1, 1.0, 10.0], "maxIter": [200, 300, 500, 1000]},
    "LinearSVC": {
        "C": [0.01, 0.1, 1.0, 10.0], "tol": [1e-4, 1e-3, 1e-2], "maxIter": [1000, 2000, 5000],
    },
    "AdaBoost": {
        "numRounds": [100, 200, 300, 400], "stepSize": [0.01, 0.05, 0.1, 0.3, 0.5, 1.0],
        "maxDepth": [1, 2, 3], "minInstancesPerNode": [1, 5, 10, 20],
    },
    "Gradient Boosting": {
        "numTrees": [100, 200, 300, 400], "maxDepth": [3, 4, 6, 8],
        "stepSize": [0.01, 0.03, 0.05, 0.1], "subsample": [0.6, 0.8, 1.0],
        "columnSample": [0.6, 0.8, 1.0], "minChildWeight": [1.0, 3.0, 5.0],
        "gamma": [0.0, 0.1, 0.3], "positiveWeight": [1.0, 0.5, 1.5], "balance": [True],
    },
    "Bagging": {
        "numTrees": [100, 200, 300], "rowSample": [0.6, 0.8, 1.0],
        "columnSample": [0.6, 0.8, 1.0], "bootstrapFeatures": [False, True],
    },
}


def select_features(
    train: DataFrame, label: str = "loan_status", k: int = FEATURES_KEPT, key: str | None = "id"
) -> list[str]:
    """The `k` features with the highest ANOVA F score, in table order."""
    names = feature_names(train, label, key)
    scores = correlation.anova_f_scores(train, label, names)
    best = scores.orderBy(F.desc_nulls_last("f_score"), "feature").limit(k).collect()
    chosen = {r["feature"] for r in best}
    return [c for c in names if c in chosen]


def feature_names(df: DataFrame, label: str, key: str | None = "id") -> list[str]:
    """All columns but label and key; text columns cannot be features and are named."""
    names = [c for c in df.columns if c not in (label, key)]
    text = [c for c in names if c in S.text_columns(df)]
    if text:
        raise ValueError(f"text columns are not features, encode or drop them first: {text}")
    return names


def assembled(
    df: DataFrame, features: Sequence[str], label: str = "loan_status", keep: Sequence[str] = ()
) -> DataFrame:
    """Features as columns and as one vector, with the label as a double."""
    rows = df.select(
        *[col(c) for c in keep],
        col(label).cast("double").alias(LABEL),
        *[col(c).cast("double").alias(c) for c in features],
    )
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(rows)


def with_weights(df: DataFrame, sizes: dict) -> DataFrame:
    """Balanced class weights."""
    n, k = sum(sizes.values()), len(sizes)
    balanced = reduce(
        lambda w, c: F.when(F.col(LABEL) == F.lit(c), n / (k * sizes[c])).otherwise(w),
        sizes,
        F.lit(1.0),
    )
    return df.withColumn(WEIGHT, balanced)


def training_matrix(
    train: DataFrame,
    features: Sequence[str],
    label: str = "loan_status",
    key: str = "id",
    folds: int = FOLDS,
) -> DataFrame:
    """The staged table every fit reads: label, features, weights and fold number."""
    rows = assembled(train, features, label, keep=[key])
    sizes = group_sizes(rows, LABEL)
    rows = with_folds(with_weights(rows, sizes), LABEL, key, folds, SEED, FOLD)
    # Iterative fits pay for every task in every round: no more tasks than the rows fill.
    tasks = max(1, -(-sum(sizes.values()) // ROWS_PER_TASK))
    return materialize(rows.coalesce(tasks), "matrix")


@dataclass(frozen=True)
class ModelSpec:
    """A classifier: how to build it for given settings, and where its score is found."""

    name: str
    build: Callable[[dict, Sequence[str], int], Estimator]
    defaults: dict
    score: str  # "vector" probability, "margin" of rawPrediction, or plain "column"
    loss: str | None = None  # of a linear model, whose whole search shares its passes


def _zero_r(settings, features, n):
    return MajorityClass(**settings, seed=SEED)


def _logistic(settings, features, n):
    return LinearClassifier(inputNames=list(features), weightCol=WEIGHT, loss="logistic", **settings)


def _linear_svc(settings, features, n):
    return LinearClassifier(inputNames=list(features), weightCol=WEIGHT, loss="squared hinge", **settings)


def _boosted_stumps(settings, features, n):
    return BoostedStumps(inputNames=list(features), weightCol=WEIGHT, seed=SEED, **settings)


def _gradient_boosting(settings, features, n):
    return GradientBoosting(inputNames=list(features), seed=SEED, **settings)


def _bagged_trees(settings, features, n):
    return BaggedTrees(inputNames=list(features), weightCol=WEIGHT, seed=SEED, **settings)


MODEL_SPECS = [
    ModelSpec(S.BASELINE_MODEL, _zero_r, {"strategy": "most_frequent"}, "column"),
    ModelSpec("Logistic Regression", _logistic, {"C": 1.0, "maxIter": 500}, "column", "logistic"),
    ModelSpec("LinearSVC", _linear_svc, {"C": 1.0, "maxIter": 2000, "tol": 1e-4}, "column", "squared hinge"),
    ModelSpec(
        "AdaBoost", _boosted_stumps,
        {"numRounds": 300, "stepSize": 0.5, "maxDepth": 2, "minInstancesPerNode": 10}, "column",
    ),
    ModelSpec(
        "Gradient Boosting", _gradient_boosting,
        {"numTrees": 300, "maxDepth": 6, "stepSize": 0.05, "subsample": 0.8, "columnSample": 0.8}, "column",
    ),
    ModelSpec("Bagging", _bagged_trees, {"numTrees": 200, "rowSample": 0.8, "columnSample": 0.8}, "column"),
]


def spec(name: str, **settings) -> ModelSpec:
    """The named classifier, with some default settings replaced."""
    found = next(s for s in MODEL_SPECS if s.name == name)
    return replace(found, defaults={**found.defaults, **settings})


@dataclass(frozen=True)
class Fitted:
    """A fitted model whose scores come out as `prediction` and `probability` columns."""

    name: str
    model: Model
    score: str
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add `prediction` and the `probability` of class 1 to rows with the features."""
        if self.score == "column":
            return self.model.transform(df)
        if FEATURES not in df.columns:
            df = VectorAssembler(inputCols=self.features, outputCol=FEATURES).transform(df)
        scored = self.model.transform(df)
        if self.score == "margin":
            chance = margin_to_probability(vector_to_array(F.col("rawPrediction"))[1])
        else:
            chance = vector_to_array(F.col("probability"))[1]
        return scored.withColumn("probability", chance).drop("rawPrediction")


def fit(model: ModelSpec, matrix: DataFrame, features: Sequence[str], n: int) -> Fitted:
    estimator = model.build(model.defaults, features, n)
    return Fitted(model.name, estimator.fit(matrix), model.score, list(features))


def sampled_settings(grid: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """`n_iter` different points of the grid, or all of a smaller grid."""
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    return random.Random(seed).sample(points, min(n_iter, len(points)))


def random_search_tune(
    model: ModelSpec,
    matrix: DataFrame,
    features: Sequence[str],
    n: int,
    n_iter: int = 1,
    grid: dict | None = None,
    folds: int = FOLDS,
    parallelism: int = 2,
) -> tuple[Fitted, dict, float | None]:
    """Random grid points, stratified folds, F2 of class 1; refit on all rows.

    All points and folds of a linear model, and its refits, are fitted in the same passes
    over the matrix. A model without a grid is fitted as it is.
    """
    points = GRIDS.get(model.name) if grid is None else grid
    if not points:
        return fit(model, matrix, features, n), {}, None
    sampled = sampled_settings(points, n_iter)
    if model.loss:
        settings = [{**model.defaults, **s} for s in sampled]
        found = search(matrix, features, model.loss, settings, folds, FOLD, LABEL, WEIGHT)
        best = max(range(len(sampled)), key=lambda i: found.scores[i])
        fitted = Fitted(model.name, linear_model(features, found.coefficients[best]), model.score, list(features))
        return fitted, sampled[best], found.scores[best]
    judge = MulticlassClassificationEvaluator(
        metricName="fMeasureByLabel", metricLabel=1.0, beta=2.0, labelCol=LABEL,
        probabilityCol="not_used",  # the baseline's and the stumps' is a plain number
    )
    stage = Pipeline(stages=[])
    candidates = [
        {stage.stages: [model.build({**model.defaults, **settings}, features, n)]}
        for settings in sampled
    ]
    validator = CrossValidator(
        estimator=stage, estimatorParamMaps=candidates, evaluator=judge, numFolds=folds,
        foldCol=FOLD, parallelism=parallelism, seed=SEED,
    )
    found = validator.fit(matrix)
    best = max(range(len(sampled)), key=lambda i: found.avgMetrics[i])
    fitted = Fitted(model.name, found.bestModel, model.score, list(features))
    return fitted, sampled[best], float(found.avgMetrics[best])


def evaluate(fitted: Fitted, rows: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """The model's score row for one stage, and the staged counts behind it."""
    scored = fitted.predict(rows).select(LABEL, "prediction", "probability")
    counts = scoring.score_counts(scored, LABEL)
    return scoring.score_row(counts, fitted.name, stage), counts


def evaluate_all(models: Sequence[Fitted], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The score table of all models on all tables, from one pass over the rows of each.

    Every row is scored by every model, and the counts per model, table, score and
    prediction are staged; all scores follow from them.
    """
    told = []
    for stage, rows in tables.items():
        own = []
        for i, fitted in enumerate(models):
            rows = fitted.predict(rows).withColumnsRenamed({"probability": f"_p{i}", "prediction": f"_s{i}"})
            own.append(
                F.struct(
                    F.lit(fitted.name).alias("Model"), F.col(f"_p{i}").cast("double").alias("threshold"),
                    (F.col(f"_s{i}") == 1).alias("said"),
                )
            )
        told.append(rows.select(F.lit(stage).alias("Stage"), LABEL, F.inline(F.array(*own))))
    counts = reduce(DataFrame.unionByName, told).groupBy("Model", "Stage", "threshold", "said")
    counts = materialize(
        counts.agg(F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg")), "score-counts"
    )
    rows = [
        scoring.score_row(counts.where((F.col("Model") == m.name) & (F.col("Stage") == stage)), m.name, stage)
        for m in models
        for stage in tables
    ]
    return materialize(scoring.score_table(rows), "scores")


def train_and_compare(
    train: DataFrame,
    test: DataFrame,
    specs: Sequence[ModelSpec] = tuple(MODEL_SPECS),
    label: str = "loan_status",
    key: str = "id",
    k: int = FEATURES_KEPT,
    n_iter: int = 0,
    folds: int = FOLDS,
    ready: Mapping[str, Fitted] | None = None,
    parallelism: int = 3,
) -> dict:
    """Fit (or tune, with `n_iter`) every model and score it on train and test.

    `ready` holds models that are already fitted on this training table, by name. The
    rounds of one fit wait for each other, so `parallelism` models are fitted at a time.

    The score table has one row per model and stage; the deltas compare each model
    with the baseline; `best` is the fitted model with the highest test F2.
    """
    features = select_features(train, label, k, key)
    matrix = training_matrix(train, features, label, key, folds)
    n = matrix.count()
    rows = {"train": matrix, "test": materialize(assembled(test, features, label), "matrix")}

    def fitted_one(s: ModelSpec) -> Fitted:
        if ready and s.name in ready:
            return ready[s.name]
        if n_iter:
            return random_search_tune(s, matrix, features, n, n_iter, folds=folds)[0]
        return fit(s, matrix, features, n)

    ship_package(train.sparkSession)
    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(inheritable_thread_target(train.sparkSession)(fitted_one), specs))
    scores = evaluate_all(models, rows)
    top = scoring.best_model(scores, "test").first()
    fitted = {m.name: m for m in models}
    return {
        "scores": scores,
        "deltas": {s: models_vs_baseline(scores, s) for s in rows},
        "best": fitted[top["Model"]] if top else None,
        "features": features,
        "models": fitted,
    }


def forest_importance(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    trees: int = 100,
    depth: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Importance of each feature in a balanced random forest; gaps take the median."""
    rows = median_fill(df.where(col(label).isNotNull()), columns)
    filled = [c for c in columns if c in S.numeric_columns(rows)]
    matrix = assembled(rows.na.fill(0.0, subset=filled), filled, label)
    matrix = materialize(with_weights(matrix, group_sizes(matrix, LABEL)), "forest")
    each = max(1, round(len(filled) ** 0.5))
    forest = BaggedTrees(
        inputNames=filled, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, rowSample=1.0, columnSample=1.0,
        nodeColumns=each, seed=seed,
    )
    found = impurity_importances(forest.grown(matrix)[2], len(filled))
    rows = [(c, float(v)) for c, v in zip(filled, found, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, random_forest double")


def feature_importance(
    df: DataFrame, label: str, columns: Sequence[str], trees: int = 100, depth: int = 8, nearest: bool = False
) -> DataFrame:
    """Pearson, mutual information and forest scores side by side, to 4 places.

    Gaps take the median ahead of mutual information and the forest. `nearest` takes the
    estimate from nearest neighbours instead of the binned one.
    """
    pearson = correlation.label_correlation(df, label, columns)
    filled = median_fill(df.where(col(label).isNotNull()), columns)
    others = [
        (nearest_mutual_information if nearest else correlation.mutual_information)(filled, label, columns),
        forest_importance(df, label, columns, trees, depth),
    ]
    joined = feature_score_join(pearson, others)
    measures = ("pearson_abs", "mutual_info", "random_forest")
    return joined.select("feature", *[F.round(m, 4).alias(m) for m in measures]).orderBy(
        F.desc("random_forest"), "feature"
    )


def normalised_top(summary: DataFrame, k: int = 15) -> DataFrame:
    """The first `k` features, each score stretched to [0, 1]."""
    top = summary.orderBy(F.desc("random_forest"), "feature").limit(k)
    measures = ("pearson_abs", "mutual_info", "random_forest")
    extent = top.agg(
        *[F.min(m).alias(f"lo_{m}") for m in measures],
        *[F.max(m).alias(f"hi_{m}") for m in measures],
    ).select(F.struct("*")).scalar()
    sized = top.withColumn("_e", extent)
    return sized.select(
        "feature",
        *[
            F.try_divide(
                F.col(m) - F.col("_e").getField(f"lo_{m}"),
                F.col("_e").getField(f"hi_{m}") - F.col("_e").getField(f"lo_{m}"),
            ).alias(m)
            for m in measures
        ],
    )
