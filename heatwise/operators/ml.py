"""Models (``pyspark.ml``) and their metrics.

Fitting is distributed by Spark ML.  Metrics are ordinary aggregates over the
prediction table, so they scale with it and can be checked against SQL: the
evaluators of ``pyspark.ml.evaluation`` give the same numbers (see the tests).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import QuantileDiscretizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heatwise.operators.clean import present_features
from heatwise.schema import FS12
from heatwise.session import shared_dir

SEED = 42


# ---- M1-M4: features, labels, split --------------------------------------------------

def assemble(df: DataFrame, features: list[str] = FS12, out: str = "features") -> DataFrame:
    """M1 (+P10): the present feature columns as one vector column."""
    have, _ = present_features(df, features)
    return VectorAssembler(inputCols=have, outputCol=out).transform(df)


def index_labels(df: DataFrame, label: str, out: str | None = None, skip_invalid: bool = False) -> DataFrame:
    """M2: label index by falling frequency, ties by label text."""
    out = out or f"{label}_idx"
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="frequencyDesc",
                          handleInvalid="skip" if skip_invalid else "error").fit(df)
    return model.transform(df)


def scale(df: DataFrame, inp: str = "features", out: str = "scaled") -> DataFrame:
    """M3: standardise (mean 0, sample sd 1; a constant column becomes 0)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True).fit(df).transform(df)


def split_flag(key: str = "sl_no", train_pct: int = 80) -> Column:
    """M4: reproducible 80/20 assignment from a hash of the key.

    ``randomSplit`` depends on the partitioning of its input; a hash of the row
    key does not, and equal keys always land on the same side.
    """
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("int")
    return (h % 100) < train_pct


def hash_split(df: DataFrame, key: str = "sl_no", train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(key, train_pct)
    return df.filter(flag), df.filter(~flag)


# ---- M10-M12: metrics as aggregates ----------------------------------------------------

def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row (n, rmse, mae, r2)."""
    e = F.col(label) - F.col(prediction)
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(F.lit(1)))).alias("r2"))


def regression_metrics_long(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M10 in long form: (metric, value)."""
    m = regression_metrics(pred, label, prediction)
    return m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value"))
                                         for k in ("rmse", "mae", "r2")])).alias("m")).select("m.*")


def regression_metrics_many(df: DataFrame, specs: list[tuple[dict, Column, Column]]) -> DataFrame:
    """M10 for several (tags, label, prediction) triples in one pass over ``df``.

    Returns long rows (tag columns…, metric, value): every triple's sums are
    computed in the same aggregate, then the single result row is exploded.
    """
    aggs, rows = [], []
    for i, (tags, y, yhat) in enumerate(specs):
        e = y - yhat
        aggs += [F.count(e).alias(f"n{i}"), F.sum(e * e).alias(f"sse{i}"), F.sum(F.abs(e)).alias(f"sae{i}"),
                 F.var_pop(y).alias(f"var{i}")]
        n = F.col(f"n{i}")
        values = {
            "rmse": F.sqrt(F.col(f"sse{i}") / n),
            "mae": F.col(f"sae{i}") / n,
            "r2": 1 - F.try_divide(F.col(f"sse{i}"), F.col(f"var{i}") * n),
        }
        for metric, v in values.items():
            rows.append(F.struct(*[F.lit(val).alias(k) for k, val in tags.items()],
                                 F.lit(metric).alias("metric"), v.alias("value")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def classification_metrics(pred: DataFrame, label: str, prediction: str = "prediction", keys: list[str] = []) -> DataFrame:
    """Accuracy, f1, weighted precision and recall from the confusion counts, per ``keys``.

    The confusion table has one row per (label, prediction) pair, so everything
    after the first aggregate works on a handful of rows.
    """
    pairs = pred.select(*keys, F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p"))
    cnt = pairs.where("l IS NOT NULL AND p IS NOT NULL").groupBy(*keys, "l", "p").agg(F.count(F.lit(1)).alias("n"))
    # each pair counts once for its label and once for its prediction: one scan, one more small aggregate
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("l").alias("l"), F.col("n").alias("n_l"), zero.alias("n_p"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("p").alias("l"), zero.alias("n_l"), F.col("n").alias("n_p"), zero.alias("tp")))
    per = cnt.select(*keys, F.explode(sides).alias("s")).groupBy(*keys, "s.l").agg(
        F.sum("s.n_l").alias("n_l"), F.sum("s.n_p").alias("n_p"), F.sum("s.tp").alias("tp")).where("n_l > 0")
    prec = F.when(F.coalesce(F.col("n_p"), F.lit(0)) > 0, F.col("tp") / F.col("n_p")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_l")
    per = per.withColumns({"prec": prec, "rec": rec})
    f1 = F.when(F.col("prec") + F.col("rec") > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(0.0)
    total = F.sum("n_l")
    return per.withColumn("f1", f1).groupBy(*keys).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("n_l")) / total).alias("f1"),
        (F.sum(F.col("prec") * F.col("n_l")) / total).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_l")) / total).alias("weighted_recall"))


def auc(df: DataFrame, label: str, score: str, buckets: int | None = None, keys: list[str] = []) -> DataFrame:
    """Exact area under the ROC curve (ties count one half), per ``keys`` (few, such as models).

    AUC = Σ over positives of (negatives scored lower + ½ negatives tied) / (P·N).
    Scores are first collapsed to (score → positives, negatives), so a score shared
    by many rows is one row; that table is checkpointed, so the input is scanned
    once.  The running count of negatives is split into score ranges holding about
    equal numbers of distinct scores (approximate quantiles; only the split points
    reach the driver; no rows give no area): a window per range for the within-range part, and offsets
    from the range totals (at most ``buckets`` rows a key, broadcast).  Keys share the
    ranges, so no range of a key has more scores than the range has in all.
    """
    g = (df.groupBy(*keys, F.col(score).cast("double").alias("s"))
         .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n"))
         .withColumn("neg", F.col("n") - F.col("pos")))
    # one scan of the input: the collapsed (score → counts) table is written to the
    # shared checkpoint folder and the ranges, offsets and running sums read it
    shared_dir(df.sparkSession)
    g = g.checkpoint(eager=True)
    # a range per 100,000 distinct scores, with borders exact to a tenth of a range
    scores = g.count()
    if not scores:
        return g.groupBy(*keys).agg(F.max(F.lit(None).cast("double")).alias("auc"))
    buckets = max(2, buckets or -(-scores // 100_000))
    ranges = QuantileDiscretizer(inputCol="s", outputCol="b", numBuckets=buckets, relativeError=0.1 / buckets,
                                 handleInvalid="keep").fit(g)
    g = ranges.transform(g).withColumn("b", F.col("b").cast("int"))
    before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (g.groupBy(*keys, "b").agg(F.sum("neg").alias("bneg"))
               .select(*keys, "b", F.coalesce(F.sum("bneg").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy(*keys, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("below", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    j = g.join(F.broadcast(offsets), [*keys, "b"])
    u = F.sum(F.col("pos") * (F.col("offset") + F.col("below") + 0.5 * F.col("neg")))
    return j.groupBy(*keys).agg(F.try_divide(u, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


# ---- M5: exact least squares -----------------------------------------------------------

@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariance matrix of some columns."""

    names: tuple[str, ...]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def of(self, names: list[str]) -> np.ndarray:
        return np.array([self.names.index(c) for c in names], dtype=int)


def moments(df: DataFrame, columns: dict[str, Column]) -> Moments | None:
    """Means and covariances of ``columns`` (name to expression) in one pass; None without rows.

    Every partition adds up its rows' products (one matrix product per Arrow batch) around
    a common origin, a value of each column, so that sums of squares do not cancel; Spark sums the
    partial matrices by element and only their (k + 1)(k + 2) / 2 elements reach the
    driver.  Rows with a null, NaN or infinite value in any column are left out.
    """
    names = list(columns)
    rows = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())])
    few = np.array([[np.nan if v is None else v for v in r] for r in rows.limit(100).collect()]).reshape(-1, len(names))
    few[~np.isfinite(few)] = np.nan
    origin = np.array([next((v for v in c if np.isfinite(v)), 0.0) for c in few.T])
    upper = np.triu_indices(len(names) + 1)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names) + 1,) * 2)
        for batch in batches:
            x = np.ones((batch.num_rows, len(names) + 1))
            for i in range(len(names)):
                x[:, i] = batch.column(i).to_numpy(zero_copy_only=False) - origin[i]  # null is NaN
            x = x[np.isfinite(x).all(axis=1)]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total[upper]], pa.list_(pa.float64()))], names=["m"])

    parts = rows.mapInArrow(products, "m array<double>").select(F.posexplode("m").alias("at", "value"))
    total = np.zeros((len(names) + 1,) * 2)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        total[i, j] = total[j, i] = r["value"]
    n = total[-1, -1]
    if not n:
        return None
    off = total[:-1, -1] / n
    return Moments(tuple(names), int(n), origin + off, total[:-1, :-1] / n - np.outer(off, off))


@dataclass(frozen=True)
class LinearFit:
    """Least-squares coefficients of one label: intercept, then one per feature; ``n`` rows used."""

    label: str
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    rank: int
    n: int
    r2: float

    def predict(self) -> Column:
        """The prediction as an expression over the feature columns (null where one is null)."""
        out = F.lit(self.intercept)
        for name, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * F.col(f"`{name}`").cast("double")
        return out


def solve(m: Moments, features: list[str], label: str, cutoff: float = 1e-10) -> LinearFit:
    """The normal equations of the standardised columns, by eigenvalues.

    Directions below ``cutoff`` of the largest are left out: the solution of minimum norm
    over standardised columns where columns depend on each other, zero for a constant one.
    """
    at, y = m.of(features), m.of([label])[0]
    cov, mean = m.cov[np.ix_(at, at)], m.mean[at]
    spread = np.sqrt(np.clip(np.diag(cov), 0, None))
    scale = np.where(spread > 1e-12 * np.abs(mean), spread, np.inf)
    values, vectors = np.linalg.eigh(cov / np.outer(scale, scale))
    use = values > cutoff * max(values.max(initial=0.0), 1e-300)
    inverse = (vectors[:, use] / values[use]) @ vectors[:, use].T
    beta = inverse @ (m.cov[at, y] / scale) / scale
    r2 = float(beta @ m.cov[at, y] / m.cov[y, y]) if m.cov[y, y] > 0 else 0.0
    return LinearFit(label, tuple(features), float(m.mean[y] - beta @ mean), tuple(float(b) for b in beta),
                     int(use.sum()), m.n, r2)


def least_squares(df: DataFrame, features: list[str], labels: list[str]) -> dict[str, LinearFit]:
    """M5: exact linear regression of several labels from one pass over ``df``.

    Nothing depends on the partitions but the last digits of the moments.  Rows with a
    null or non-finite feature or label are left out; no rows give no fit.
    """
    m = moments(df, {c: F.col(f"`{c}`") for c in [*features, *labels]})
    return {y: solve(m, features, y) for y in labels} if m else {}


def normal_equations(df: DataFrame, fits: dict[str, LinearFit]) -> DataFrame:
    """(label, term, rows, correlation): how far each fit is from its normal equations, in one pass.

    The residual of a least-squares fit has mean zero and no covariance with a feature.
    ``correlation`` is that covariance (for the term ``intercept`` the mean) over the
    spreads of label and feature, zero for a constant one.
    """
    features = sorted({f for fit in fits.values() for f in fit.features})
    columns = {f: F.col(f"`{f}`") for f in features}
    for y, fit in fits.items():
        columns |= {("label", y): F.col(f"`{y}`"), ("residual", y): F.col(f"`{y}`").cast("double") - fit.predict()}
    m = moments(df, columns)
    rows = []
    for y, fit in fits.items() if m else ():
        e, = m.of([("residual", y)])
        own, = m.of([("label", y)])
        spread = float(np.sqrt(max(m.cov[own, own], 0.0)))
        rows.append((y, "intercept", m.n, float(m.mean[e]) / spread if spread else 0.0))
        for f in fit.features:
            x, = m.of([f])
            size = spread * float(np.sqrt(max(m.cov[x, x], 0.0)))
            rows.append((y, f, m.n, float(m.cov[e, x]) / size if size else 0.0))
    return df.sparkSession.createDataFrame(rows, "label string, term string, rows long, correlation double")


# ---- M5-M9, M13: fitted models ---------------------------------------------------------

# Split statistics per running task of a tree learner.  The value decides how many nodes
# are split in one pass and with it which feature subsets are drawn, so it is fixed: the
# same data give the same trees on every cluster.  Size executors to it (slots x 32 MB).
TREE_MEMORY_MB = 32


def _trees(est):
    return est.setMaxMemoryInMB(TREE_MEMORY_MB)


# Depth from which a forest keeps the node that each row has reached in each tree, so that a pass
# need not walk from the roots.  The trees are the same; the ids take 4 bytes a row and tree, some
# generations of them at once (memory, then local disk).  Shorter paths aren't worth that.
NODE_ID_DEPTH = 8


# Rows times trees of a deep forest that are grown in one fit.  Beyond it the trees are grown in
# groups, one fit after another: the ids and the bagging counts of a hundred trees would take some
# 1.6 KB a row.  It depends on the rows alone, so the trees don't depend on the cluster.
FOREST_AT_ONCE = 600_000_000


def _forest(est: RandomForestClassifier) -> RandomForestClassifier:
    """``est`` with the settings that change how its trees are grown, but not the trees."""
    deep = est.getMaxDepth() >= NODE_ID_DEPTH
    return _trees(est.setCacheNodeIds(True).setCheckpointInterval(-1) if deep else est)


def _groups(num_trees: int, max_depth: int, rows: int) -> list[int]:
    """Trees of each fit of a forest over ``rows`` training rows, as even as can be."""
    if max_depth < NODE_ID_DEPTH or rows * num_trees <= FOREST_AT_ONCE:
        return [num_trees]
    n = -(-num_trees // max(1, FOREST_AT_ONCE // rows))
    return [num_trees // n + (k < num_trees % n) for k in range(n)]


def _fit_forest(train: DataFrame, label: str, num_trees: int, max_depth: int, groups: list[int]) -> list:
    """The models of a forest on ``features``: one, or one for each group of its trees.

    A group has a seed of its own, keeps no node ids (few trees are walked as fast as ids are read
    and written) and gives raw predictions only; their sum is that of the whole forest.
    """
    if len(groups) == 1:
        return [_forest(RandomForestClassifier(labelCol=label, featuresCol="features", seed=SEED,
                                               numTrees=num_trees, maxDepth=max_depth)).fit(train)]
    return [_trees(RandomForestClassifier(labelCol=label, featuresCol="features", seed=SEED + 1_000_003 * k,
                                          numTrees=n, maxDepth=max_depth, rawPredictionCol=f"_raw{k}",
                                          probabilityCol="", predictionCol="")).fit(train) for k, n in enumerate(groups)]


def _predicted(models: list, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``, the class with most of all trees' votes, the first of equals."""
    out = PipelineModel(models).transform(df)
    if len(models) == 1:
        return out
    votes = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [vector_to_array(f"_raw{k}") for k in range(len(models))])
    return (out.withColumn("_votes", votes)
            .withColumn("prediction", (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")))


REGRESSORS = {
    "LinearRegression": lambda label: LinearRegression(labelCol=label, featuresCol="features"),
    "DecisionTree": lambda label: _trees(
        DecisionTreeRegressor(labelCol=label, featuresCol="features", seed=SEED)),
    "GBTRegressor": lambda label: _trees(
        GBTRegressor(labelCol=label, featuresCol="features", seed=SEED)),
}
CLASSIFIERS = {
    "GBTClassifier": lambda label: _trees(
        GBTClassifier(labelCol=label, featuresCol="features", seed=SEED)),
    "LogisticRegression": lambda label: LogisticRegression(labelCol=label, featuresCol="features"),
    "RandomForest": lambda label: _trees(
        RandomForestClassifier(labelCol=label, featuresCol="features", seed=SEED)),
}


def _empty_like(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).limit(0)


# File bytes of a part of a training side.  A learner keeps some 230 bytes for a row of 12
# features and 20 trees, about five times what the row takes in a landed trace, and a task
# reads one part of that in every pass; the scan's own cap (128 MB) makes such parts too large.
TRAIN_PART_BYTES = 32 << 20


@contextmanager
def _small_parts(spark: SparkSession) -> Iterator[None]:
    """File scans whose partitions are made inside read at most ``TRAIN_PART_BYTES`` a task."""
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(was) > TRAIN_PART_BYTES:
        spark.conf.set(key, str(TRAIN_PART_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _kept(train: DataFrame) -> DataFrame:
    """The training side persisted in small parts; tables below their size keep the parts they had."""
    with _small_parts(train.sparkSession):
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        train.isEmpty()  # makes the partitions
    return train


def _prepared(df: DataFrame, features: list[str], labels: list[str]):
    """Persisted training side (features and labels only) and test side."""
    train, test = hash_split(assemble(df, features))
    return _kept(train.select("features", *labels)), test


def predict_regression(df: DataFrame, label: str, algo: str = "LinearRegression",
                       features: list[str] = FS12) -> DataFrame:
    """M5: fit on the 80 % side, predict the 20 % side: (sl_no, machine_id, label, prediction).

    The linear regression is the exact one (``least_squares``): one aggregate over the
    training side, and an expression over the test side.
    """
    out = ["sl_no", "machine_id", label, "prediction"]
    if label not in df.columns:
        return _empty_like(df.withColumn("prediction", F.lit(0.0)), [c for c in out if c in df.columns])
    if algo == "LinearRegression":
        train, test = hash_split(df)
        fits = least_squares(train, present_features(df, features)[0], [label])
        if not fits:
            return _empty_like(df.withColumn("prediction", F.lit(0.0)), out)
        return test.withColumn("prediction", fits[label].predict()).select(*out)
    train, test = _prepared(df, features, [label])
    try:
        if train.isEmpty() or test.isEmpty():
            return _empty_like(df.withColumn("prediction", F.lit(0.0)), out)
        model = REGRESSORS[algo](label).fit(train)
    finally:
        train.unpersist()
    return model.transform(test).select(*out)


def predict_failure(df: DataFrame, algo: str = "RandomForest", features: list[str] = FS12) -> DataFrame:
    """M6: failure classifier: (sl_no, machine_id, failed, prediction, score)."""
    out = ["sl_no", "machine_id", "failed", "prediction", "score"]
    data = df.withColumn("failed", F.col("failed").cast("double"))
    train, test = _prepared(data, features, ["failed"])
    try:
        if train.isEmpty() or test.isEmpty():
            return _empty_like(data.withColumns({"prediction": F.lit(0.0), "score": F.lit(0.0)}), out)
        model = CLASSIFIERS[algo]("failed").fit(train)
    finally:
        train.unpersist()
    return model.transform(test).withColumn("score", vector_to_array("probability")[1]).select(*out)


def predict_label(df: DataFrame, label: str, features: list[str] = FS12, scaled: bool = False,
                  num_trees: int = 20, max_depth: int = 5) -> DataFrame:
    """Index the label, optionally scale, random forest.

    The label index is fitted on the whole table, so a label that only the test side has
    is predicted like any other; rows without a label are left out.  Returns (sl_no,
    label, label_idx, prediction) on the 20 % side; empty when the label column is
    missing or a side of the split is empty.
    """
    idx = f"{label}_idx"
    if label not in df.columns:
        return df.sparkSession.createDataFrame([], f"sl_no long, {label} string, {idx} double, prediction double")
    raw = "raw_features" if scaled else "features"
    data = assemble(df, features, raw).filter(F.col(label).isNotNull())
    train, test = hash_split(data)
    out = ["sl_no", label, idx, "prediction"]
    if train.isEmpty() or test.isEmpty():
        return _empty_like(data.withColumns({idx: F.lit(0.0), "prediction": F.lit(0.0)}), out)
    indexer = StringIndexer(inputCol=label, outputCol=idx, stringOrderType="frequencyDesc").fit(data.select(label))
    stages = [StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True)] if scaled else []
    train = _kept(indexer.transform(train.select(raw, label)).select(raw, idx))
    try:
        ready = Pipeline(stages=stages).fit(train)
        groups = _groups(num_trees, max_depth, train.count() if max_depth >= NODE_ID_DEPTH else 0)
        models = _fit_forest(ready.transform(train), idx, num_trees, max_depth, groups)
    finally:
        train.unpersist()
    return _predicted(models, ready.transform(indexer.transform(test))).select(*out)


MODEL_ROW = "array<struct<task: string, model: string, label: double, prediction: double, score: double>>"


def predict_models(df: DataFrame, features: list[str] = FS12, regressors=REGRESSORS, classifiers=CLASSIFIERS) -> DataFrame:
    """M8 / M9: (sl_no, machine_id, models) of the test side, the predictions of all models as one array.

    Every element is (task, model, label, prediction, score); score, the probability of a
    failure, is null for a regression.  The test side is read and transformed once, for all
    models in one projection, and written; whatever is asked about the models reads that.
    A side without rows gives no rows.
    """
    labels = ["heat", "energy", "duration", "failed"]
    train, test = _prepared(df.withColumn("failed", F.col("failed").cast("double")), features, labels)
    out, stages = [], []
    try:
        if train.isEmpty() or test.isEmpty():
            return _empty_like(df.withColumn("models", F.array().cast(MODEL_ROW)), ["sl_no", "machine_id", "models"])
        for task in labels:
            for name, make in (classifiers if task == "failed" else regressors).items():
                at, score = f"_p{len(stages)}", F.lit(None).cast("double")
                est = make(task).setPredictionCol(at)
                if task == "failed":
                    est = est.setRawPredictionCol(f"{at}r").setProbabilityCol(f"{at}s")
                    score = vector_to_array(f"{at}s")[1]
                stages.append(est.fit(train))
                shown = "failure" if task == "failed" else task
                out.append(F.struct(F.lit(f"{shown}_prediction").alias("task"), F.lit(name).alias("model"),
                                    F.col(task).cast("double").alias("label"), F.col(at).alias("prediction"), score.alias("score")))
    finally:
        train.unpersist()
    shared_dir(df.sparkSession)
    return PipelineModel(stages).transform(test).select(
        "sl_no", "machine_id", F.array(*out).cast(MODEL_ROW).alias("models")).checkpoint(eager=True)


def _long(wide: DataFrame, metrics: list[str]) -> DataFrame:
    return wide.select("task", "model", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])).alias("m")).select("task", "model", "m.*")


def metrics_of_models(pred: DataFrame) -> DataFrame:
    """(task, model, metric, value) of a ``models`` array: rmse, mae and r2 of regressions; accuracy,
    f1, weighted precision and recall and the exact auc of classifiers; all models in each aggregate."""
    rows = pred.select(F.explode("models").alias("m")).select("m.*")
    keys, e = ["task", "model"], F.col("label") - F.col("prediction")
    fits = rows.where("score IS NULL").groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop("label") * F.count(F.lit(1)))).alias("r2"))
    judged = rows.where("score IS NOT NULL")
    classes = ["accuracy", "f1", "weighted_precision", "weighted_recall"]
    return (_long(fits, ["rmse", "mae", "r2"])
            .unionByName(_long(classification_metrics(judged, "label", keys=keys), classes))
            .unionByName(_long(auc(judged, "label", "score", keys=keys), ["auc"])))


def confusion_of_models(pred: DataFrame) -> DataFrame:
    """(task, model, label, prediction, count) of the classifiers of a ``models`` array, in one aggregate."""
    rows = pred.select(F.explode("models").alias("m")).select("m.*").where("score IS NOT NULL")
    return rows.groupBy("task", "model", "label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def sample_of_models(pred: DataFrame, n: int = 10) -> DataFrame:
    """(sl_no, task, model, actual, prediction, residual) of the ``n`` test rows of least sl_no."""
    few = pred.orderBy("sl_no", "machine_id").limit(n).select("sl_no", F.explode("models").alias("m"))
    return few.select("sl_no", "m.task", "m.model", F.col("m.label").alias("actual"), "m.prediction",
                      (F.col("m.label") - F.col("m.prediction")).alias("residual"))


def model_scores(df: DataFrame, features: list[str] = FS12) -> DataFrame:
    """M9: every regressor on heat, energy and duration (rmse, mae, r2) and every
    classifier on failure (auc), as a long (task, model, metric, value) table."""
    scores = metrics_of_models(predict_models(df, features))
    return scores.where(F.col("metric").isin("rmse", "mae", "r2", "auc"))


# ---- M14 / W1: comparison ---------------------------------------------------------------

LOWER_IS_BETTER = ("rmse", "mae")


def best_models(metrics: DataFrame) -> DataFrame:
    """The best model(s) per (task, metric); ties are all kept, a null or NaN value is never best."""
    metrics = metrics.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    signed = F.when(F.col("metric").isin(*LOWER_IS_BETTER), F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("task", "metric").orderBy(signed)
    return metrics.withColumn("rank", F.rank().over(w)).filter(F.col("rank") == 1).drop("rank")


def compare_models(metrics: DataFrame, metric_names: list[str]) -> DataFrame:
    """Models down, metrics across."""
    return metrics.groupBy("task", "model").pivot("metric", metric_names).agg(F.first("value"))
