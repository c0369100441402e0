"""Daily action predictions from saved model bundles.

A bundle is a folder with ``model`` (a Spark ML pipeline) and ``features`` (its exact feature list). A manifest names, for
each device type, the folders to look in, in order. The job is one plan: the latest row of each device is shuffled once,
each type's rows go through that type's pipeline, and all branches meet in one gate (confidence), one override (age) and
one label map.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import labels as L
from .models import align_features, predict

MANIFEST = "device_type string, priority int, folder string"


@dataclass(frozen=True)
class Bundle:
    device_type: str
    folder: str
    model: PipelineModel
    features: tuple[str, ...]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_manifest(spark: SparkSession, folders: dict[str, Sequence[str]], path: str) -> None:
    rows = [(t, i, f) for t, some in folders.items() for i, f in enumerate(some)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Folders by type, preferred first (a row for each type and folder)."""
    out: dict[str, list[str]] = {}
    for r in spark.read.schema(MANIFEST).json(path).orderBy("device_type", "priority").collect():
        out.setdefault(r.device_type, []).append(r.folder)
    return out


def find_bundles(spark: SparkSession, folders: dict[str, Sequence[str]]) -> dict[str, Bundle]:
    """The first folder of each type that holds a bundle. A folder that is not there is passed over; one that holds a
    model without its features, or one that cannot be read, is an error, never a reason to take an older model."""
    out = {}
    for kind, some in folders.items():
        folder = next((f for f in some if exists(spark, f"{f}/model")), None)
        if folder is None:
            continue
        if not exists(spark, f"{folder}/features"):
            raise ValueError(f"bundle without a feature list: {folder}")
        features = json.loads(spark.read.json(f"{folder}/features").first()["features"])
        out[kind] = Bundle(kind, folder, PipelineModel.load(f"{folder}/model"), tuple(features))
    return out


def score_by_type(latest: DataFrame, bundles: dict[str, Bundle], type_col: str = "device_type",
                  missing: str = "skip") -> DataFrame:
    """M8 + M9: the rows of every type with a bundle, as they came, with PredictedActionLabel, PredictedActionName,
    Confidence and UsedRuleFallback. Rows of the other active types go ("skip"), or stay with confidence 0 ("rules")."""
    raw = F.struct(*latest.columns).alias("_raw")
    none = {"PredictedActionLabel": "int", "PredictedActionName": "string", "Confidence": "double"}
    branches = []
    for kind in config.ACTIVE_ML_TYPES:
        rows = latest.where(F.col(type_col) == kind)
        if kind in bundles:
            b = bundles[kind]
            held = rows.select(raw, *[c for c in latest.columns if c in b.features])
            p = predict(b.model, align_features(held, b.features))
            name = F.create_map(*[F.lit(x) for k, v in config.ACTION_LABELS.items() for x in (k, v)])[F.col("prediction")]
            branches.append(p.select("_raw", F.col("prediction").alias("PredictedActionLabel"),
                                     F.coalesce(name, F.lit(L.NO)).alias("PredictedActionName"), "Confidence"))
        elif missing == "rules":
            branches.append(rows.select(raw, *[F.lit(0.0 if c == "Confidence" else None).cast(t).alias(c) for c, t in none.items()]))
    if not branches:
        branches = [latest.limit(0).select(raw, *[F.lit(None).cast(t).alias(c) for c, t in none.items()])]
    whole = branches[0]
    for other in branches[1:]:
        whole = whole.unionByName(other)
    kept = [c for c in latest.columns if c not in (*none, "UsedRuleFallback")]
    return whole.select(*[F.col(f"_raw.{c}").alias(c) for c in kept], *none, F.lit(False).alias("UsedRuleFallback"))


def decide(scored: DataFrame, threshold: float = config.CONFIDENCE_THRESHOLD, type_col: str = "device_type") -> DataFrame:
    """D15 + D16: below the threshold, or without a confidence, the rules decide; past 90 % of life a device is replaced;
    the label follows the name."""
    known = scored.withColumn("Confidence", F.coalesce("Confidence", F.lit(0.0)))
    return L.apply_age_override(L.apply_confidence(known, threshold, type_col))


def latest_features(history: DataFrame, install: DataFrame | None, as_of: str, order_cols: Sequence[str] = ()) -> DataFrame:
    """The latest row of each device with a known type, with refreshed features."""
    known = L.canonical_type(history).where(F.col("device_type").isNotNull())
    latest = L.latest_per_device(known, "BatteryLatestReport", order_cols=order_cols)
    return L.recompute_features(L.with_install_lookup(latest, install, as_of), as_of)


def predict_daily_actions(history: DataFrame, install: DataFrame | None, bundles: dict[str, Bundle], as_of: str,
                          order_cols: Sequence[str] = (), threshold: float = config.CONFIDENCE_THRESHOLD,
                          missing: str = "skip") -> DataFrame:
    """The whole job: one row for each device of an active type with its action, confidence, fallback and override."""
    latest = latest_features(history, install, as_of, order_cols)
    return decide(score_by_type(latest, bundles, missing=missing), threshold)


def summary(predicted: DataFrame, threshold: float = config.CONFIDENCE_THRESHOLD) -> DataFrame:
    """A12 with totals: devices, each action, confident rows, fallbacks and overrides by type and overall."""
    name, count = F.col("PredictedActionName"), lambda c, n: F.count_if(c).cast("long").alias(n)
    return predicted.rollup("device_type").agg(
        F.count(F.lit(1)).cast("long").alias("devices"), *[count(name == a, a) for a in (L.NO, L.RECONF, L.REPLACE)],
        count(F.col("Confidence") >= threshold, "confident"), count(F.col("UsedRuleFallback"), "rule_fallback"),
        count(F.col("AgeOverride"), "age_override"))
