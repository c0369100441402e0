"""Findings of round 4: trees of a forest that grow side by side, each in one task."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from voltwatch.ml import forest as FO
from voltwatch.ml import models as M

FEATS = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = [(float(a), float(b), float(c), 3.0) for a, b, c in zip(rng.normal(size=900), rng.integers(0, 9, 900), rng.exponential(size=900))]
    y = [int(a > 0.3) + int(b > 4 and c > 0.5 or rng.random() < 0.1) for a, b, c, _ in x]
    weight = [3.0, 1.0, 0.7]
    df = spark.createDataFrame([(*r, k, weight[k], i, "ZM1") for i, (r, k) in enumerate(zip(x, y))],
                               "a double, b double, c double, same double, y int, class_weight double, Serial int, device_type_display string")
    return df.repartition(3).transform(M.reliable_checkpoint)


@pytest.mark.parametrize(("depth", "least", "nodes"), [(4, 2, 512), (30, 2, 3), (30, 9, 512)])
def test_a_tree_over_all_features_is_sparks_tree(spark, rows, monkeypatch, depth, least, nodes):
    """The same splits, thresholds, statistics and merged leaves, also where a level's nodes are looked at by parts."""
    monkeypatch.setattr(FO, "NODES", nodes)
    got = rows.select(*FEATS, "y", "class_weight").collect()
    seen = np.array([[float(x) for x in r] for r in got])
    splits = [FO.split_points(seen[:, i], seen[:, -1], 31) for i in range(4)]
    bins = np.stack([np.searchsorted(s, seen[:, i]) for i, s in enumerate(splits)], 1).astype(np.uint8)
    nodes = FO.grow(bins, seen[:, 4].astype(np.uint8), np.ones(len(bins), int), np.array([3.0, 1.0, 0.7]), 4, depth, least, np.random.default_rng(1))
    table = spark.createDataFrame(FO.tree_rows(0, nodes, splits).to_pylist(), FO.NODE_SQL)
    tree = FO.as_model(spark, table, 1, 4, 3, {"featuresCol": "features", "labelCol": "y"}).trees[0]
    data = VectorAssembler(inputCols=FEATS, outputCol="features").transform(rows)
    spark_tree = DecisionTreeClassifier(labelCol="y", weightCol="class_weight", maxDepth=depth, minInstancesPerNode=least).fit(data)
    text = lambda m: m.toDebugString.split("\n", 1)[1]
    assert text(tree) == text(spark_tree) and tree.numNodes > 8
    answer = lambda m: [r.probability.toArray().round(9).tolist() for r in m.transform(data).orderBy("Serial").collect()]
    assert answer(tree) == answer(spark_tree)
    assert tree.featureImportances.toArray() == pytest.approx(spark_tree.featureImportances.toArray())


@pytest.mark.parametrize("heavy", [1.0, 900.0, 9000.0])
def test_split_points_are_sparks(spark, heavy):
    """Also where they come from a sample of the rows, and where few values are not 0."""
    df = spark.range(0, 24_000, 1, 3).select(
        "id", F.randn(1).alias("a"), F.when(F.rand(2) < 0.3, F.rand(3)).otherwise(0.0).alias("b"), (F.col("id") % 3).cast("int").alias("y"))
    df = M.reliable_checkpoint(df.select("*", F.when(F.col("id") % 6000 < 4, heavy).otherwise(1.0 + F.col("y")).alias("class_weight")))
    total = df.agg(F.sum("class_weight")).first()[0]
    model = RandomForestClassifier(labelCol="y", weightCol="class_weight", numTrees=40, maxDepth=9, seed=42).fit(
        VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    used = {(int(f), float(x)) for f, x in re.findall(r"feature (\d) <= ([-.\dE]+)", model.toDebugString)}
    for f, s in enumerate(FO.splits_of(df, ["a", "b"], "class_weight", 24_000, total, 42)):
        assert {x for g, x in used if g == f} <= set(s) and len(s) > 8
        assert heavy > 1 or len(s) == len({x for g, x in used if g == f})


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_a_deep_forest_takes_no_more_jobs_than_a_flat_one(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "FEW_ROWS_TREES", 0, raising=False)
    took = []
    for depth in (3, 20):
        before = jobs(spark)
        got = M.train_action_models(rows.drop("class_weight"), M.ActionParams(num_trees=9, max_depth=depth), label="y", types=["ZM1"], feats=FEATS)["ZM1"]
        took.append(jobs(spark) - before)
    assert abs(took[0] - took[1]) <= 2
    forest = got["model"].stages[-1]
    assert forest.getNumTrees == 9 and max(t.depth for t in forest.trees) > 9
    assert forest.getOrDefault("maxDepth") == 20 and forest.getOrDefault("seed") == 42
    assert got["test"].columns == ["y", "class_weight", "is_test", *FEATS, "prediction", "Confidence", "positive_prob"]


def test_forests_are_as_good_as_sparks(spark, rows, monkeypatch, tmp_path):
    """The same rows of test, about as many right answers, and a bundle that is read back; too many rows for a task are
    for Spark's own forest, seed by seed."""
    params = M.ActionParams(num_trees=40, max_depth=30)

    def trained(few, room):
        monkeypatch.setattr(M, "FEW_ROWS_TREES", few)
        monkeypatch.setattr(FO, "TASK_BYTES", room)
        return M.train_action_models(rows.drop("class_weight"), params, label="y", types=["ZM1"], feats=FEATS)["ZM1"]

    own, few, large = trained(0, 1 << 27), trained(10**9, 1 << 27), trained(0, 0)
    right = [m["test"].where("prediction = y").count() / m["test"].count() for m in (own, few, large)]
    assert right[1] == right[2] and abs(right[0] - right[1]) < 0.04
    assert own["test"].select("a", "b").exceptAll(few["test"].select("a", "b")).count() == 0
    answers = [[r[:] for r in m["test"].orderBy("a", "b", "c").select("prediction", F.round("Confidence", 9)).collect()] for m in (few, large)]
    assert answers[0] == answers[1]
    nodes = [m["model"].stages[-1].totalNumNodes for m in (own, few)]
    assert abs(nodes[0] / nodes[1] - 1) < 0.15
    M.save_bundle(own["model"], FEATS, f"{tmp_path}/ZM1")
    model, feats = M.load_bundle([f"{tmp_path}/ZM1"])
    again = [[r[:] for r in M.predict(m, own["test"].select("a", "b", "c", "same")).orderBy("a", "b", "c").collect()] for m in (model, own["model"])]
    assert feats == FEATS and again[0] == again[1]


def test_trees_do_not_depend_on_tasks_or_their_number(spark, rows):
    splits = FO.splits_of(rows, FEATS, "class_weight", 900, rows.agg(F.sum("class_weight")).first()[0], 42)
    blocks = FO.binned(rows, FEATS, "y", splits)
    some = [sorted(map(str, FO.grown(blocks, tasks, 5, splits, [3.0, 1.0, 0.7], 30, 2, 42).collect())) for tasks in (1, 2, 5)]
    assert some[0] == some[1] == some[2] and len({r[:20] for r in some[0]}) >= 5
    assert FO.kind([np.arange(255.0)]) is np.uint8 and FO.kind([np.arange(256.0)]) is np.uint16
