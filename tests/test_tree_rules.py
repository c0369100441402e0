"""Tree rules as rows, and the trust stack's reports and options."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from voltwatch.ml import models as M
from voltwatch.ml.rules import apply_rules, tree_rules


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = []
    for k in range(600):
        a = rnd.choice([None, float("nan"), rnd.gauss(0, 3), float(rnd.randrange(4))])
        b = rnd.choice([None, rnd.random() / 3])
        data.append((k, a, b, int(((a or 0) > 1) != ((b or 0) > 0.2))))
    return spark.createDataFrame(data, "reading_id long, `a b` double, `c d` double, _y int").repartition(3)


def test_rules_give_the_models_predictions(spark, rows):
    feats = ["a b", "c d"]
    tree = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"),
                            DecisionTreeClassifier(labelCol="_y", maxDepth=5, seed=1)]).fit(rows.na.fill(0.0))  # no tree is fitted on NaN
    rules = tree_rules(spark, tree.stages[-1], feats).collect()
    assert len(rules) >= 4 and sum(r.support for r in rules) == 600
    both = apply_rules(tree.transform(rows), rules)
    assert both.where("rules_met <> 1 OR rule_prediction <> prediction").count() == 0
    filled = apply_rules(rows.na.fill(0.0), rules)
    share = {r.rule_leaf: (r.n, r.p) for r in filled.groupBy("rule_leaf").agg(F.count("*").alias("n"), F.avg("_y").alias("p")).collect()}
    assert {r.leaf: (r.support, pytest.approx(r.positive_share)) for r in rules} == share


def test_a_tree_of_one_leaf(spark, rows):
    one = rows.select("*").withColumn("_y", F.lit(0)).withColumnsRenamed({"a b": "a", "c d": "c"})
    tree = M.trust_tree(one.na.fill(0.0), ["a", "c"])
    rules = tree_rules(spark, tree.stages[-1], ["a", "c"]).collect()
    assert [(r.rule, r.prediction, r.support) for r in rules] == [("TRUE", 0.0, 600.0)]
    assert apply_rules(one, rules).where("rules_met <> 1 OR rule_prediction <> 0").count() == 0


def test_trust_stack_options_and_report(spark):
    rnd = random.Random(5)
    data = [(k, f"2024-01-{1 + k // 20:02d} 00:00:00", rnd.random() * 100, rnd.choice([None, "1%", "7"]), rnd.randrange(2)) for k in range(400)]
    df = spark.createDataFrame([(*r, None if r[0] % 11 == 0 else int(r[2] < 30)) for r in data],
                               "reading_id long, seen string, level double, days string, rule_label int, broken int")
    df = df.withColumn("seen", F.col("seen").cast("timestamp"))
    res = M.trust_stack(df, "broken", "seen", 0.5, rf_trees=5, features=["level", "days", "absent"])
    assert res["features"] == ["level", "days"]
    known = sum(r[0] % 11 != 0 for r in data)
    assert res["test"].count() == known - known // 2
    rep = {(r.model, r["class"]): r for r in M.trust_report(res).collect()}
    assert {m for m, _ in rep} == {"rules", "tree", "forest"}
    assert rep["tree", "accuracy"].precision > 0.9 and rep["tree", "0"].roc_auc > 0.9 and rep["rules", "0"].roc_auc is None
    assert rep["rules", "accuracy"].support == known - known // 2
