"""Random forests whose trees grow side by side, each in one task, as Spark ML models (M2).

Spark's own forest goes over all rows once a level, for all trees at once: a deep forest of 500 trees is dozens of passes
in which nearly every node is done, and it keeps a number for each row and tree. Here the rows are binned once (a byte a
value, in the bins that Spark makes), every task gets them all and grows its share of the trees to the end. The trees are
Spark's: Poisson bootstrap, a fresh choice of ceil(sqrt(features)) features a node, weighted Gini gain, least instances
of a child, sibling leaves with one answer merged. They are written in the format of Spark ML and read back as its model.

The rows of a forest have to fit a task (``fits``); what doesn't is for Spark's level-wise training.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from contextlib import contextmanager
from threading import Lock
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAX_BINS = 32
#: Rows from which split points are found, as in Spark.
SPLIT_ROWS = 10_000
#: Bytes of binned rows that a task holds.
TASK_BYTES = 128 << 20
#: Bytes of a block of binned rows on its way to the tasks.
BLOCK_BYTES = 1 << 20
#: Nodes of a level whose histograms are held at a time.
NODES = 4096
#: Trees that the driver gets at a time.
PART_TREES = 5
_one = Lock()
NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
NODE_SQL = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
            "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


@contextmanager
def room(spark: SparkSession) -> Iterator[None]:
    """The driver takes in or sends out one forest at a time, which is a few times its size there meanwhile; its heap gives
    back what earlier plans have left, else it grows to its limit."""
    with _one:
        spark._jvm.System.gc()
        yield


def fits(rows: int, feats: int) -> bool:
    """Whether so many binned rows fit a task."""
    return rows * (feats + 1) <= TASK_BYTES


def split_points(values: np.ndarray, weights: np.ndarray, most: int, expected: float | None = None) -> np.ndarray:
    """At most ``most`` thresholds between distinct values, at even steps of weight. As Spark does it: the sample is taken
    to weigh ``expected``, and zeros have what the other values lack of that."""
    some = values != 0.0
    if not some.any():
        return np.empty(0)
    distinct, at = np.unique(values[some], return_inverse=True)
    share = np.bincount(at, weights[some])
    expected = weights.sum() if expected is None else expected
    if expected - share.sum() > 2.0**-52 * some.sum() * 100:
        i = np.searchsorted(distinct, 0.0)
        distinct, share = np.insert(distinct, i, 0.0), np.insert(share, i, expected - share.sum())
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= most:
        return between
    stride = expected / (most + 1)
    out, seen, target = [], share[0], stride
    for i in range(1, len(distinct)):
        before, seen = seen, seen + share[i]
        if abs(before - target) < abs(seen - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def sampled(train: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows from which Spark's forest of that seed finds its split points."""
    spark = train.sparkSession
    at = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    return DataFrame(spark._jsparkSession.createDataFrame(train._jdf.rdd().sample(False, share, at), train._jdf.schema()), spark)


def splits_of(train: DataFrame, feats: Sequence[str], weight: str, n: int, total: float, seed: int) -> list[np.ndarray]:
    """Thresholds of each feature over ``n`` rows that weigh ``total``."""
    share = min(1.0, SPLIT_ROWS / n)
    some = sampled(train, share, seed) if share < 1.0 else train
    seen = np.array([[float(x) for x in r] for r in some.select(*feats, weight).collect()]).reshape(-1, len(feats) + 1)  # SPLIT_ROWS rows
    return [split_points(seen[:, i], seen[:, -1], min(MAX_BINS, n) - 1, share * total) for i in range(len(feats))]


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity of each column of weighted class counts (class x node)."""
    total = stats.sum(0)
    share = stats / np.where(total > 0, total, 1.0)
    return np.where(total > 0, 1.0 - (share * share).sum(0), 0.0)


def best_splits(key: np.ndarray, bins: np.ndarray, rows: np.ndarray, counts: np.ndarray, sizes: np.ndarray, own: np.ndarray,
                chosen: np.ndarray, class_weight: np.ndarray, least: int, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best of the ``chosen`` features of each node (rows lie by node): feature (-1: none is valid), last bin on the
    left, and the class counts on the left. ``own`` are the nodes' class counts, ``key`` the class of each row, ``steps``
    the number of bins."""
    classes, nodes = own.shape
    width = bins.shape[1]
    flat = bins.reshape(-1)
    base = (key * nodes + np.repeat(np.arange(nodes), sizes)) * steps
    place = rows * width
    weighted, n = own * class_weight[:, None], own.sum(0)
    total = weighted.sum(0)
    top = np.full(nodes, -np.inf)
    feature, cut, left = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros((classes, nodes))
    every = np.arange(nodes)
    for f in chosen.T:
        bin_of = flat[place + np.repeat(f, sizes)]
        h = np.bincount(base + bin_of, counts, classes * nodes * steps).reshape(classes, nodes, steps)
        lefts = np.cumsum(h, 2)[:, :, :-1]
        wl = np.zeros(lefts.shape[1:])
        nl, sl, sr = np.zeros_like(wl), np.zeros_like(wl), np.zeros_like(wl)
        for c in range(classes):
            w = lefts[c] * class_weight[c]
            nl += lefts[c]
            wl += w
            sl += w * w
            w = weighted[c][:, None] - w
            sr += w * w
        with np.errstate(divide="ignore", invalid="ignore"):
            score = sl / wl + sr / (total[:, None] - wl)
        score[(nl < least) | (n[:, None] - nl < least)] = -np.inf
        at = score.argmax(1)
        got = score[every, at]
        better = got > top
        top[better], feature[better], cut[better] = got[better], f[better], at[better]
        left[:, better] = lefts[:, every[better], at[better]]
    return feature, cut, left


def grow(bins: np.ndarray, labels: np.ndarray, counts: np.ndarray, class_weight: np.ndarray, per_node: int, max_depth: int,
         least: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree over rows that count ``counts`` times each: its nodes, level after level, merged where sibling leaves agree."""
    width, classes, steps = bins.shape[1], len(class_weight), int(bins.max(initial=0)) + 1
    rows = np.flatnonzero(counts)
    key, counts = labels[rows].astype(np.int64), counts[rows].astype(np.float64)
    own = np.bincount(key, counts, classes)[:, None]
    sizes = np.array([len(rows)])
    parts: list[dict[str, np.ndarray]] = []
    ids = np.zeros(1, np.int64)  # of the nodes that may be split
    stats, made = own, 1  # of all nodes of the level
    for depth in range(max_depth + 1):
        weighted = stats * class_weight[:, None]
        impurity = gini(weighted)
        k = stats.shape[1]
        level = {"impurity": impurity, "prediction": weighted.argmax(0), "stats": weighted.T, "raw": stats.sum(0).astype(np.int64),
                 "gain": np.full(k, -1.0), "left": np.full(k, -1), "right": np.full(k, -1), "feature": np.full(k, -1), "cut": np.zeros(k, np.int64)}
        parts.append(level)
        # pure nodes and those too small for two children are leaves
        active = (impurity >= 2.0**-52) & (level["raw"] >= 2 * least) & (depth < max_depth)
        inside = np.repeat(active[ids], sizes)
        rows, key, counts, sizes, ids = rows[inside], key[inside], counts[inside], sizes[active[ids]], ids[active[ids]]
        if not len(ids):
            break
        chosen = np.tile(np.arange(width), (len(ids), 1)) if per_node >= width else \
            rng.random((len(ids), width)).argpartition(per_node - 1, 1)[:, :per_node]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        found = []
        for a in range(0, len(ids), NODES):
            b = min(a + NODES, len(ids))
            s = slice(ends[a], ends[b])
            found.append(best_splits(key[s], bins, rows[s], counts[s], sizes[a:b], stats[:, ids[a:b]], chosen[a:b], class_weight, least, steps))
        feature, cut = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        left = np.concatenate([x[2] for x in found], 1)
        right = stats[:, ids] - left
        wl, wr = left * class_weight[:, None], right * class_weight[:, None]
        total = wl.sum(0) + wr.sum(0)
        gain = impurity[ids] - wl.sum(0) / total * gini(wl) - wr.sum(0) / total * gini(wr)
        split = (feature >= 0) & (gain > 0)
        inside = np.repeat(split, sizes)
        rows, key, counts, sizes = rows[inside], key[inside], counts[inside], sizes[split]
        at, feature, cut = ids[split], feature[split], cut[split]
        k = len(at)
        if not k:
            break
        level["gain"][at], level["feature"][at], level["cut"][at] = gain[split], feature, cut
        level["left"][at], level["right"][at] = made + 2 * np.arange(k), made + 2 * np.arange(k) + 1
        made += 2 * k
        # each node's rows: those that go left first, in the order they had
        node = np.repeat(np.arange(k), sizes)
        goes = bins[rows, feature[node]] <= cut[node]
        lefts = np.bincount(node[goes], minlength=k)
        order = np.argsort(2 * node + ~goes, kind="stable")
        rows, key, counts = rows[order], key[order], counts[order]
        sizes = np.stack([lefts, sizes - lefts], 1).reshape(-1)
        stats = np.stack([left[:, split], right[:, split]], 2).reshape(classes, -1)
        ids = np.arange(2 * k)
    return merged(parts)


def merged(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The levels' nodes as one table; two leaves of one node that give the same answer are merged into it."""
    sizes = [len(p["gain"]) for p in parts]
    nodes = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    left, right, answer = nodes["left"], nodes["right"], nodes["prediction"]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in reversed([*zip(starts[:-1], starts[1:])]):
        i = np.arange(a, b)[left[a:b] >= 0]
        i = i[(left[left[i]] < 0) & (left[right[i]] < 0) & (answer[left[i]] == answer[right[i]])]
        left[i], right[i], nodes["feature"][i], nodes["gain"][i] = -1, -1, -1, -1.0
    kept = np.zeros(starts[-1], bool)
    kept[0] = True
    for a, b in zip(starts[:-1], starts[1:]):
        i = np.arange(a, b)[kept[a:b] & (left[a:b] >= 0)]
        kept[left[i]] = kept[right[i]] = True
    new = np.cumsum(kept) - 1
    out = {k: v[kept] for k, v in nodes.items()}
    for side in ("left", "right"):
        out[side] = np.where(out[side] >= 0, new[out[side]], -1)
    return out


def tree_rows(tree: int, nodes: dict[str, np.ndarray], splits: Sequence[np.ndarray]) -> pa.RecordBatch:
    """A tree's nodes as Spark ML stores them."""
    n, classes = nodes["stats"].shape
    inner = nodes["left"] >= 0
    thresholds = np.array([splits[f][c] for f, c in zip(nodes["feature"][inner], nodes["cut"][inner])], float)
    offsets = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(nodes["feature"].astype(np.int32)), pa.ListArray.from_arrays(offsets, thresholds), pa.array(np.full(n, -1, np.int32))],
        fields=list(NODE.field("split").type))
    stats = pa.ListArray.from_arrays(np.arange(0, n * classes + 1, classes, dtype=np.int32), nodes["stats"].reshape(-1))
    cols = [np.arange(n, dtype=np.int32), nodes["prediction"].astype(float), nodes["impurity"], stats, nodes["raw"], nodes["gain"],
            nodes["left"].astype(np.int32), nodes["right"].astype(np.int32), split]
    data = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], fields=list(NODE))
    return pa.record_batch([pa.array(np.full(n, tree, np.int32)), data], names=["treeID", "nodeData"])


def kind(splits: Sequence[np.ndarray]) -> type:
    """Of the numbers of bins; a sample of rows that weigh more than expected has more than MAX_BINS."""
    return np.uint8 if max(map(len, splits)) < 256 else np.uint16


def binned(df: DataFrame, feats: Sequence[str], label: str, splits: Sequence[np.ndarray]) -> DataFrame:
    """Blocks of rows, a number a feature and one for the label, numbered by partition and place in it."""
    step = max(1, BLOCK_BYTES // (len(feats) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                some = batch.slice(begin, step)
                out = np.empty((some.num_rows, len(feats) + 1), kind(splits))
                for i, s in enumerate(splits):
                    out[:, i] = np.searchsorted(s, some.column(i).to_numpy(zero_copy_only=False))
                out[:, -1] = some.column(len(feats)).to_numpy(zero_copy_only=False)
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([out.tobytes()], pa.binary())],
                                      names=["part", "at", "rows"])
                at += 1

    return df.select(*[F.col(f).cast("double") for f in feats], F.col(label).cast("int")).mapInArrow(run, "part int, at int, rows binary")


def grown(blocks: DataFrame, tasks: int, trees: int, splits: Sequence[np.ndarray], class_weight: Sequence[float], max_depth: int,
          least: int, seed: int) -> DataFrame:
    """The nodes of all trees; each of ``tasks`` tasks gets all blocks and grows every ``tasks``-th tree."""
    width, weight = len(splits), np.array(class_weight)
    per_node = math.ceil(math.sqrt(width)) if trees > 1 else width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(((p, a, t, r) for b in batches for t, p, a, r in zip(*(b.column(c).to_pylist() for c in ("task", "part", "at", "rows")))), key=lambda x: x[:2])
        if not got:
            return
        first = got[0][2]
        rows = np.frombuffer(b"".join(x[3] for x in got), kind(splits)).reshape(-1, width + 1)
        got.clear()
        bins, labels = np.ascontiguousarray(rows[:, :-1]), rows[:, -1].copy()
        del rows
        for tree in range(first, trees, tasks):
            rng = np.random.default_rng([seed, tree])
            yield tree_rows(tree, grow(bins, labels, rng.poisson(1.0, len(bins)), weight, per_node, max_depth, least, rng), splits)

    every = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "part", "at", "rows")
    return every.repartitionById(tasks, F.col("task")).mapInArrow(run, NODE_SQL)


def as_model(spark: SparkSession, nodes: DataFrame, trees: int, feats: int, classes: int, params: dict) -> RandomForestClassificationModel:
    """Spark's model of a table of nodes, by way of its format in the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    where = f"{spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4().hex}"

    def described(name: str, uid: str, own: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.classification.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": {"impurity": "gini", "maxBins": MAX_BINS, **own}, "defaultParamMap": {}, **more})

    own = {k: v for k, v in params.items() if k != "numTrees"}
    uid = uuid.uuid4().hex[:12]
    nodes.write.parquet(f"{where}/data")
    spark.createDataFrame([(k, described("DecisionTreeClassificationModel", f"dtc_{uid}_{k}", own), 1.0) for k in range(trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{where}/treesMetadata")
    top = described("RandomForestClassificationModel", f"RandomForestClassifier_{uid}", params, numFeatures=feats, numClasses=classes, numTrees=trees)
    spark.createDataFrame([(top,)], "value string").coalesce(1).write.text(f"{where}/metadata")
    parts = spark.newSession()  # the driver gets the trees in small parts
    parts.conf.set("spark.sql.files.openCostInBytes", "0")
    parts.conf.set("spark.sql.files.minPartitionNum", str(max(1, trees // PART_TREES)))
    with room(spark):
        model = RandomForestClassificationModel.read().session(parts).load(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # the model is in memory
    return model


def fit_forest(train: DataFrame, feats: Sequence[str], label: str, weight: str, num_trees: int, max_depth: int, least: int,
               seed: int) -> RandomForestClassificationModel:
    """A forest over the rows of ``train`` (read a few times: freeze them), whose ``weight`` is one number a class."""
    spark, feats = train.sparkSession, list(feats)
    known = {r[0]: (r[1], r[2]) for r in train.groupBy(F.col(label).cast("int")).agg(F.count(F.lit(1)), F.max(weight)).collect()}  # a row a class
    n, classes = sum(c for c, _ in known.values()), max(known) + 1
    splits = splits_of(train, feats, weight, n, sum(c * w for c, w in known.values()), seed)
    tasks = min(num_trees, 2 * spark.sparkContext.defaultParallelism)
    nodes = grown(binned(train, feats, label, splits), tasks, num_trees, splits, [known.get(c, (0, 0.0))[1] for c in range(classes)], max_depth, least, seed)
    return as_model(spark, nodes, num_trees, len(feats), classes, {
        "featuresCol": "features", "labelCol": label, "weightCol": weight, "numTrees": num_trees, "maxDepth": max_depth,
        "minInstancesPerNode": least, "seed": seed})
