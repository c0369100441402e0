"""Spark ML models and evaluation tables.

Training uses ``pyspark.ml`` (distributed tree induction); every evaluation
table is a DataFrame aggregate, so reports are computed where the
predictions live.  Reference hyper-parameters are the defaults of
``ActionParams``/``FailureParams``.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Sequence

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from ..operators.common import reliable_checkpoint
from ..operators.ranks import cumulative, exact_quantiles, first_rows
from . import forest
from .rules import tree_rules

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")
DEFAULT_DROP = config.MODEL_DROP_COLUMNS
ALWAYS_DROP = ["action_label", "action_name", "Serial", "_source_file", "BatteryLatestReport"]


@dataclass
class ActionParams:
    num_trees: int = 500
    max_depth: int = 30          # "unlimited" in the reference; Spark's limit is 30
    min_instances_per_node: int = 2
    test_size: float = 0.2
    seed: int = 42


@dataclass
class FailureParams:
    num_trees: int = 100
    max_depth: int = 10
    min_instances_per_node: int = 2
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5


# ---------------------------------------------------------------- features --

def feature_cols(df: DataFrame, drop: Sequence[str] = DEFAULT_DROP) -> list[str]:
    """M1: numeric (and boolean) columns minus the drop list and label / id columns."""
    gone = set(drop) | set(ALWAYS_DROP)
    return [c for c, t in df.dtypes if c not in gone and not c.startswith("_") and t in NUMERIC]


def align_features(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    """M8: missing features -> 0, coerce numeric, +-inf / missing -> 0."""
    cols = [F.coalesce(X.finite(X.to_num(F.col(f))), F.lit(0.0)).alias(f) if f in df.columns
            else F.lit(0.0).alias(f) for f in feats]
    keep = [c for c in df.columns if c not in feats]
    return df.select(*keep, *cols)


def with_class_weight(df: DataFrame, label: str, out: str = "class_weight", train: Column | None = None) -> DataFrame:
    """M4: balanced weights n / (k * n_c), counted over the rows where ``train`` holds (all by default)."""
    counts = (df if train is None else df.where(train)).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")


def split_order(key: Sequence[str], seed: int) -> Column:
    """A number that orders rows at random by their ``key`` and the seed: 60 bits of an MD5 of both."""
    text = F.concat_ws("-", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42, key: Sequence[str] = ()
                     ) -> DataFrame:
    """M3: ``is_test`` with ceil(test_frac * n_c) rows per class in a seeded
    hash order; unstratified when any class has fewer than 2 rows.

    ``key`` should tell rows apart (default: all columns); rows that agree in it
    stay on one side. A missing label is a class. Only keys are sorted out; no
    row is shuffled for its rank.
    """
    small = df.groupBy(label).count().where("count < 2").limit(1).count() > 0  # a row a class
    order = [split_order(key or df.columns, seed), F.xxhash64(*(key or df.columns), F.lit(seed))]
    return first_rows(df, F.ceil(F.col("_n") * test_frac), order, "is_test", [] if small else [label])


# ------------------------------------------------------------------ models --

#: Rows times trees of one task: a forest keeps a number a tree for each row, so that a task holds 100 MB of them.
ROWS_TREES = 25_000_000
#: MB of node statistics of one pass of a forest (Spark's default is 256): deep forests take fewer passes.
NODE_MB = 768
#: Up to so many rows times trees Spark's own forest takes about half a minute; it stays, seed by seed, what it was.
FEW_ROWS_TREES = 2_500_000


def training_rows(df: DataFrame, trees: int) -> DataFrame:
    """``df`` with its lineage cut, in as many even tasks as its rows need for a forest of so many trees."""
    frozen = reliable_checkpoint(df)
    parts = -(-frozen.count() * trees // ROWS_TREES)
    return frozen if parts <= frozen.rdd.getNumPartitions() else reliable_checkpoint(frozen.repartition(parts))


def _assembler(feats: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feats), outputCol="features", handleInvalid="keep")


def action_forest(train: DataFrame, feats: Sequence[str], label: str, params: ActionParams) -> PipelineModel:
    """The balanced forest of one type. Rows that fit a task once they are binned grow their trees side by side
    (:mod:`.forest`); few rows and more rows than that are for Spark's level-wise training, with the same parameters."""
    rows = train.count()
    if rows * params.num_trees > FEW_ROWS_TREES and forest.fits(rows, len(feats)):
        return PipelineModel([_assembler(feats), forest.fit_forest(
            train, feats, label, "class_weight", params.num_trees, params.max_depth, params.min_instances_per_node, params.seed)])
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="class_weight",
                                numTrees=params.num_trees, maxDepth=params.max_depth,
                                minInstancesPerNode=params.min_instances_per_node, seed=params.seed,
                                maxMemoryInMB=NODE_MB)
    return Pipeline(stages=[_assembler(feats), rf]).fit(train)


def train_action_models(df: DataFrame, params: ActionParams = ActionParams(), type_col: str = "device_type_display",
                        label: str = "action_label", types: Sequence[str] = config.ACTIVE_ML_TYPES,
                        feats: Sequence[str] | None = None) -> dict:
    """M2: one balanced random forest per active type; single-class types are skipped.
    Returns {type: {"model", "features", "test"}} where ``test`` holds test predictions."""
    feats = list(feats or feature_cols(df))
    df = reliable_checkpoint(df)  # read by every type, a few times each
    classes = {r[0]: r[1] for r in df.groupBy(type_col).agg(F.count_distinct(label)).collect()}  # <= #types rows

    def trained(t: str) -> dict:
        sub = align_features(df.where((F.col(type_col) == t) & F.col(label).isNotNull()), feats)
        sub = with_class_weight(stratified_split(sub, label, params.test_size, params.seed), label, train=~F.col("is_test"))
        # tree induction makes one pass per level: cut the lineage once (reliable checkpoint)
        sub = training_rows(sub.select(label, "class_weight", "is_test", *feats), params.num_trees)
        train, test = sub.where(~F.col("is_test")), sub.where("is_test")
        model = action_forest(train, feats, label, params)
        with forest.room(df.sparkSession):  # a forest is sent out whole
            return {"model": model, "features": feats, "test": predict(model, test).transform(reliable_checkpoint)}

    wanted = [t for t in types if classes.get(t, 0) >= 2]
    # a deep forest is hundreds of short passes that leave most cores idle: the types' passes run side by side
    with ThreadPoolExecutor(max(1, len(wanted))) as pool:
        return dict(zip(wanted, pool.map(inheritable_thread_target(df.sparkSession)(trained), wanted)))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M9 + M14: prediction, confidence = max class probability, positive-class probability."""
    p = model.transform(df)
    arr = vector_to_array("probability")
    return p.select(*df.columns, F.col("prediction").cast("int").alias("prediction"),
                    F.array_max(arr).alias("Confidence"),
                    F.when(F.size(arr) > 1, arr[1]).otherwise(F.lit(0.0)).alias("positive_prob"))


def save_bundle(model: PipelineModel, feats: Sequence[str], path: str) -> None:
    """M7: Spark ML persistence plus the exact feature list."""
    model.write().overwrite().save(f"{path}/model")
    from pyspark.sql import SparkSession
    SparkSession.getActiveSession().createDataFrame([(json.dumps(list(feats)),)], "features string") \
        .write.mode("overwrite").json(f"{path}/features")


def load_bundle(paths: Sequence[str]):
    """M7: first folder that holds a bundle wins; (None, None) when none does. An unreadable bundle is an error."""
    from pyspark.sql import SparkSession

    from .bundles import find_bundles
    found = find_bundles(SparkSession.getActiveSession(), {"": paths}).get("")
    return (found.model, list(found.features)) if found else (None, None)


def train_failure_model(ds: DataFrame, feats: Sequence[str], params: FailureParams = FailureParams(),
                        label: str = "failure_next_7d", cv: bool = True, min_rows: int = 100) -> dict:
    """At least ``min_rows`` rows and both classes; scaler + balanced RF; optional k-fold ROC-AUC on the train part."""
    sizes = [r["count"] for r in ds.groupBy(label).count().collect()]  # a row a class
    if sum(sizes) < min_rows:
        raise ValueError(f"failure model needs {min_rows} complete rows, got {sum(sizes)}")
    if len(sizes) < 2:
        raise ValueError("failure model needs both classes in the data")
    d = with_class_weight(stratified_split(ds, label, params.test_size, params.seed, key=["Serial", "date"]), label,
                          train=~F.col("is_test"))
    d = training_rows(d, params.num_trees)
    train, test = d.where(~F.col("is_test")), d.where("is_test")
    rf = RandomForestClassifier(labelCol=label, featuresCol="scaled", weightCol="class_weight",
                                numTrees=params.num_trees, maxDepth=params.max_depth,
                                minInstancesPerNode=params.min_instances_per_node, seed=params.seed)
    pipe = Pipeline(stages=[_assembler(feats), StandardScaler(inputCol="features", outputCol="scaled"), rf])
    res = {}
    if cv:
        ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
        cvm = CrossValidator(estimator=pipe, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                             numFolds=params.folds, seed=params.seed, parallelism=params.folds).fit(train)
        res["cv_auc_mean"] = float(cvm.avgMetrics[0])
        res["cv_auc_2std"] = float(2 * (cvm.stdMetrics[0] if cvm.stdMetrics else 0.0))
    model = pipe.fit(train)
    res.update(model=model, test=predict(model, test).transform(reliable_checkpoint), features=list(feats))
    return res


def importance_table(model: PipelineModel, feats: Sequence[str]) -> DataFrame:
    """Features ranked by importance, with share of the top 3 (k rows, from the model)."""
    from pyspark.sql import SparkSession
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(feats, imp), key=lambda r: -r[1])
    total = sum(imp) or 1.0
    top3 = sum(v for _, v in rows[:3]) / total * 100.0
    data = [(i + 1, f, float(v), float(top3)) for i, (f, v) in enumerate(rows)]
    return SparkSession.getActiveSession().createDataFrame(
        data, "rank int, feature string, importance double, top3_share_pct double")


# fixed values: deployment recommendation per feature
RECOMMENDATIONS = [
    ("maintenance_urgency_score", "Prioritize devices with score >50 for immediate inspection"),
    ("battery_level", "Schedule battery replacement at 30% threshold (not 20%)"),
    ("LineTemperature_val", "Implement temperature alerts at 70°C (current likely 75°C)"),
    ("device_age_months", "Plan replacements at 36-month intervals"),
    ("comm_age_days", "Investigate devices offline >3 days immediately"),
]


def recommendations(importances: DataFrame) -> DataFrame:
    """Recommendation texts joined to ranked importances."""
    spark = importances.sparkSession
    rec = spark.createDataFrame(RECOMMENDATIONS, "feature string, recommendation string")
    return rec.join(importances, "feature").select("rank", "feature", "importance", "recommendation")


# ---------------------------------------------------------- evaluation -----

def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M5: per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages (0 on division by zero); pure aggregates."""
    # the confusion matrix has #classes^2 rows: evaluate the predictions once
    cm = reliable_checkpoint(df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p"))
                           .agg(F.count(F.lit(1)).alias("n")))
    classes = cm.select(F.col("y").alias("c")).union(cm.select(F.col("p").alias("c"))).distinct()
    per = (classes.join(cm, (cm.y == classes.c) | (cm.p == classes.c), "left")
           .groupBy("c").agg(F.sum(F.when((F.col("y") == F.col("c")) & (F.col("p") == F.col("c")), F.col("n"))
                                   .otherwise(0)).alias("tp"),
                             F.sum(F.when(F.col("p") == F.col("c"), F.col("n")).otherwise(0)).alias("pp"),
                             F.sum(F.when(F.col("y") == F.col("c"), F.col("n")).otherwise(0)).alias("support")))
    prec = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select(F.col("c").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("long").alias("support"), F.col("tp"))
    per = per.select("*", F.when((F.col("precision") + F.col("recall")) > 0,
                                 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0).alias("f1"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    rows = per.select("class", "precision", "recall", "f1", "support")
    acc = tot.select(F.lit("accuracy").alias("class"), (F.col("tp") / F.col("n")).alias("precision"),
                     (F.col("tp") / F.col("n")).alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg"), "mp", "mr", "mf", F.col("n").cast("long"))
    weighted = tot.select(F.lit("weighted avg"), "wp", "wr", "wf", F.col("n").cast("long"))
    return rows.unionByName(acc).union(macro).union(weighted)


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).cast("long").alias("count"))


def score_histogram(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives / negatives per distinct score, ranked descending (input of AUC and ROC); the running sums go over
    range partitions of the histogram, however many distinct scores there are."""
    h = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    return reliable_checkpoint(cumulative(h, F.col("s").desc(), {"pos": "cum_pos", "neg": "cum_neg"}))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, FPR, TPR) per distinct score, descending."""
    h = score_histogram(df, label, score)
    tot = h.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = h.crossJoin(F.broadcast(tot))
    return j.select(F.col("s").alias("threshold"),
                    F.when(F.col("N") > 0, F.col("cum_neg") / F.col("N")).alias("fpr"),
                    F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("tpr"))


def binary_metrics(df: DataFrame, label: str, pred: str, score: str) -> DataFrame:
    """Accuracy, precision, recall, F1 and rank-based ROC-AUC (ties count
    half; null with one class)."""
    # one pass: a small table of (label, prediction) counts, and the score histogram
    yp = reliable_checkpoint(df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p"))
                           .agg(F.count(F.lit(1)).alias("c")))
    y, p, c = F.col("y"), F.col("p"), F.col("c")
    base = yp.agg(F.sum(c).alias("n"), F.sum(F.when((y == 1) & (p == 1), c).otherwise(0)).alias("tp"),
                  F.sum(F.when((y == 0) & (p == 1), c).otherwise(0)).alias("fp"),
                  F.sum(F.when((y == 1) & (p == 0), c).otherwise(0)).alias("fn"),
                  F.sum(F.when(y == p, c).otherwise(0)).alias("ok"), F.sum(F.when(y == 1, c).otherwise(0)).alias("P"))
    h = score_histogram(df, label, score)
    # pairs (positive, negative) ranked correctly, ties count half
    auc_num = h.agg(F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") * 0.5)).alias("num"))
    j = base.crossJoin(auc_num)
    prec = F.when((F.col("tp") + F.col("fp")) > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when((F.col("tp") + F.col("fn")) > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    neg = F.col("n") - F.col("P")
    return j.select((F.col("ok") / F.col("n")).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    F.when((prec + rec) > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
                    F.when((F.col("P") > 0) & (neg > 0), F.col("num") / (F.col("P") * neg)).alias("roc_auc"))


def median_impute(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill missing values in both frames with the exact train medians (one row)."""
    med = exact_quantiles(train, {c: (0.5,) for c in cols}).first().asDict()
    fill = {k: v[0] for k, v in med.items() if v}
    return train.na.fill(fill), test.na.fill(fill)


def explain_rows(df: DataFrame, feats: Sequence[str], importances: Sequence[float], k: int = 3) -> Column:
    """M18: "Top signals: f=v, ..." from the k globally most important features."""
    top = [f for f, _ in sorted(zip(feats, importances), key=lambda r: -r[1])[:k]]
    parts = [F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("nan"))) for f in top]
    return F.concat(F.lit("Top signals: "), F.concat_ws(", ", *parts))


TRUST_FEATURES = ("BatteryLevel", "days_since_last_heard", "LineCurrent", "LineTemperature", "rule_risk_score")


def trust_split(df: DataFrame, label_col: str | None = None, date_col: str = "Last_Heard", train_frac: float = 0.8,
                features: Sequence[str] = TRUST_FEATURES, trees: int = 250) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test rows of the trust stack with the label as ``_y``, and the features there are.

    ``label_col`` None takes the rules' own label. Rows without a date or a label are left out; the earliest
    ``train_frac`` rows train; missing values take the train rows' medians."""
    from ..operators.failure import chrono_split
    types = dict(df.dtypes)
    feats = [c for c in features if c in types]
    typed = [(X.sanitize_num(c) if types[c] == "string" else X.to_num(F.col(c))).alias(c) for c in feats]
    d = df.where(F.col(date_col).isNotNull()).select(
        *[c for c in df.columns if c not in feats], *typed, F.col(label_col or "rule_label").cast("int").alias("_y"))
    d = d.where(F.col("_y").isNotNull())  # a row without a supplied label teaches and tests nothing
    split = chrono_split(d, date_col, train_frac, tiebreak=[c for c in ("reading_id",) if c in d.columns])
    split = training_rows(split, trees)
    return (*median_impute(split.where("is_train"), split.where("not is_train"), feats), feats)


def trust_tree(train: DataFrame, feats: Sequence[str], seed: int = 42) -> PipelineModel:
    """The depth-3 tree whose rules people read."""
    return Pipeline(stages=[_assembler(feats), DecisionTreeClassifier(labelCol="_y", maxDepth=3, seed=seed)]).fit(train)


def trust_stack(df: DataFrame, label_col: str | None = None, date_col: str = "Last_Heard", train_frac: float = 0.8,
                rf_trees: int = 250, seed: int = 42, features: Sequence[str] = TRUST_FEATURES) -> dict:
    """Rule labels (or a given label), chronological split,
    median impute, depth-3 tree and 250-tree forest, agreement and explanations.
    ``tree_rules`` has the tree's leaves as rows of SQL conditions."""
    train, test, feats = trust_split(df, label_col, date_col, train_frac, features, rf_trees)
    dt = trust_tree(train, feats, seed)
    rf = Pipeline(stages=[_assembler(feats), RandomForestClassifier(
        labelCol="_y", numTrees=rf_trees, maxDepth=8, minInstancesPerNode=10, seed=seed)]).fit(train)
    tp = predict(dt, test).select(*test.columns, F.col("prediction").alias("dt_pred"),
                                  F.col("positive_prob").alias("dt_prob"))
    both = predict(rf, tp).select(*tp.columns, F.col("prediction").alias("rf_pred"),
                                  F.col("positive_prob").alias("rf_prob"))
    imp = rf.stages[-1].featureImportances.toArray().tolist()
    out = both.select("*", (F.col("rule_label") == F.col("dt_pred")).cast("int").alias("rule_vs_tree_agree"),
                      (F.col("rule_label") == F.col("rf_pred")).cast("int").alias("rule_vs_forest_agree"),
                      explain_rows(both, feats, imp).alias("rf_explanation"))
    return {"tree": dt, "forest": rf, "test": out, "features": feats,
            "tree_rules": tree_rules(df.sparkSession, dt.stages[-1], feats)}


def trust_report(result: dict) -> DataFrame:
    """The reports of the rules, the tree and the forest on the test rows of :func:`trust_stack`, under each other:
    ``model`` and the columns of :func:`classification_report`, with the models' ROC-AUC (null for the rules, which give
    no score, and where the test rows have one class)."""
    out, test = None, reliable_checkpoint(result["test"].select("_y", "rule_label", "dt_pred", "dt_prob", "rf_pred", "rf_prob"))
    for model, pred, score in (("rules", "rule_label", None), ("tree", "dt_pred", "dt_prob"), ("forest", "rf_pred", "rf_prob")):
        auc = binary_metrics(test, "_y", pred, score).select("roc_auc") if score else \
            result["test"].sparkSession.createDataFrame([(None,)], "roc_auc double")
        part = classification_report(test, "_y", pred).select(F.lit(model).alias("model"), "*").crossJoin(F.broadcast(auc))
        out = part if out is None else out.unionByName(part)
    return out
