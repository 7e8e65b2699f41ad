"""The inference bundle: a fitted model with everything needed to score raw features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, not_nan
from riskloom.operators.encoding import code_to_label, feature_extent
from riskloom.plans.ensembles import TreeModel
from riskloom.plans.modelling import Fitted

META_SCHEMA = (
    "model_name string, score string, model_class string, feature_order array<string>, "
    "selected array<string>, feature_min map<string,double>, feature_max map<string,double>"
)
MODEL_CLASSES = {
    c.__name__: c
    for c in (PipelineModel, TreeModel)
}


@dataclass(frozen=True)
class Bundle:
    fitted: Fitted
    feature_order: list[str]
    feature_min: dict[str, float]
    feature_max: dict[str, float]


def make_bundle(
    fitted: Fitted,
    raw_train: DataFrame,
    label: str = "loan_status",
    key: str = "id",
    scaled: Sequence[str] = S.MINMAX_COLUMNS,
) -> Bundle:
    """Take the extents from the training table before scaling.

    Only the columns that training scaled get an extent; the others enter the model
    as they come, at scoring as at training.
    """
    order = [c for c in raw_train.columns if c not in (label, key)]
    names = [c for c in order if c in set(scaled)]
    extent = feature_extent(raw_train, names).first() if names else {}
    return Bundle(
        fitted,
        order,
        {c: extent[f"min_{c}"] for c in names if extent[f"min_{c}"] is not None},
        {c: extent[f"max_{c}"] for c in names if extent[f"max_{c}"] is not None},
    )


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    model = bundle.fitted.model
    model.write().overwrite().save(f"{path}/model")
    meta = [
        (
            bundle.fitted.name, bundle.fitted.score, type(model).__name__, bundle.feature_order,
            bundle.fitted.features, bundle.feature_min, bundle.feature_max,
        )
    ]
    spark.createDataFrame(meta, META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    meta = spark.read.schema(META_SCHEMA).json(f"{path}/meta").first()
    model = MODEL_CLASSES[meta["model_class"]].load(f"{path}/model")
    fitted = Fitted(meta["model_name"], model, meta["score"], list(meta["selected"]))
    return Bundle(
        fitted, list(meta["feature_order"]), dict(meta["feature_min"]), dict(meta["feature_max"])
    )


def model_inputs(df: DataFrame, bundle: Bundle, keep: Sequence[str] = ()) -> DataFrame:
    """`keep` and the selected features as the model takes them: scaled, nulls as 0.

    A missing column is an error, others are ignored.
    """
    missing = [c for c in bundle.feature_order if c not in df.columns]
    if missing:
        raise ValueError(f"missing required features: {missing}")

    def scaled(c: str):
        v = not_nan(col(c).cast("double"))
        if c in bundle.feature_min:
            lo, hi = bundle.feature_min[c], bundle.feature_max[c]
            v = (v - lo) / ((hi - lo) or 1.0)
        return F.coalesce(v, F.lit(0.0)).alias(c)

    return df.select(*[col(c) for c in keep], *[scaled(c) for c in bundle.fitted.features])


def score_batch(df: DataFrame, bundle: Bundle, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Prediction, its text, and the probability of the predicted class for raw features.

    Other columns are ignored, missing ones are an error, nulls count as 0 after
    scaling. Works on batch and streaming tables alike.
    """
    kept = [c for c in keep if c in df.columns and c not in bundle.fitted.features]
    inputs = model_inputs(df, bundle, kept)
    scored = bundle.fitted.predict(inputs)
    predicted = F.col("prediction").cast("int")
    own = F.when(predicted == 1, F.col("probability")).otherwise(1 - F.col("probability"))
    rows = scored.select(
        *[col(c) for c in kept], predicted.alias("prediction"), own.alias("probability")
    )
    return code_to_label(rows, "prediction", out="prediction_label")
