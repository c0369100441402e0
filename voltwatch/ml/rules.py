"""Decision trees as rows: a leaf's path as a condition in SQL, its prediction and its support."""

from __future__ import annotations

from typing import Iterator, Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

RULE_ROW = "leaf int, rule string, prediction double, support double, positive_share double"


def _number(x: float) -> str:
    """A double literal that keeps every bit."""
    text = repr(float(x))
    return text if "e" in text else f"{text}E0"


def _leaves(node, feats: Sequence[str], path: tuple[str, ...]) -> Iterator[tuple]:
    if node.subtreeDepth() == 0:
        counts = list(node.impurityStats().stats())
        total = sum(counts)
        yield " AND ".join(path) or "TRUE", float(node.prediction()), total, (counts[1] / total if len(counts) > 1 and total else 0.0)
        return
    split = node.split()
    name, at = "`" + feats[split.featureIndex()].replace("`", "``") + "`", _number(split.threshold())
    yield from _leaves(node.leftChild(), feats, (*path, f"{name} <= {at}"))
    # missing values go right, as the assembler's NaN does
    yield from _leaves(node.rightChild(), feats, (*path, f"({name} > {at} OR {name} IS NULL)"))


def tree_rules(spark: SparkSession, tree: DecisionTreeClassificationModel, feats: Sequence[str]) -> DataFrame:
    """One row a leaf, left to right: its condition over ``feats`` (continuous ones, in the assembler's order), the
    class it predicts, how many training rows (by weight) it held and the share of class 1 among them."""
    rows = [(k, *leaf) for k, leaf in enumerate(_leaves(tree._call_java("rootNode"), feats, ()))]
    return spark.createDataFrame(rows, RULE_ROW)


def apply_rules(df: DataFrame, rules: Sequence[Row]) -> DataFrame:
    """``rule_leaf`` and ``rule_prediction`` by the rules of :func:`tree_rules`, without the model, and ``rules_met``: how
    many rules hold for the row (1, as the leaves of a tree part its input)."""
    leaf, prediction, met = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(0)
    for r in rules:
        holds = F.expr(r.rule)
        leaf = F.when(holds, F.lit(r.leaf)).otherwise(leaf)
        prediction = F.when(holds, F.lit(r.prediction)).otherwise(prediction)
        met = met + F.when(holds, 1).otherwise(0)
    return df.select("*", leaf.alias("rule_leaf"), prediction.alias("rule_prediction"), met.alias("rules_met"))
