"""Model training and selection on the feature table.

* gradient boosting -> ``operators.boosting``: histogram trees as Spark jobs,
  with the reference's parameters as they mean there (columns per tree, least
  hessian of a child, nulls sent where they gain most);
* L1 / L2 logistic regression -> Spark ML and, for whole grids at once,
  ``operators.logistic``;
* random forest -> ``operators.forest``, one growth for a grid of depths;
* early stopping on the validation fold -> the AUC after every tree, 50 rounds
  of patience; the ensemble is then cut to its best number of trees (no refit);
* K-fold by user -> the fold column of ``sampling.with_folds``; boosted folds and
  grid points grow together, other folds are fitted by a few threads at a time;
  every fold's scores are unioned so all folds are evaluated in one pass.

Fits are Spark jobs; the only driver-side loop is over folds and grid points, as
in any CV.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.functions.columns import FINAL_THRESHOLD, feature_type
from rebuy.operators import binning as bn
from rebuy.operators import boosting as bo
from rebuy.operators import evaluate as ev
from rebuy.operators import forest as fo
from rebuy.operators import logistic as lo

KEYS = ["user_id", "product_id"]
LABEL = "reordered"
# Columns that can be NULL in a feature table: a user whose only prior order
# has no gap, and categories unseen when the bins were fitted.
NULLABLE = ["user_days_since_last_order_mean", "product_dept_bin", "product_aisle_bin",
            "current_order_hod"]

# Fixed values of the reference's final model.
FINAL_GBT = dict(n_estimators=843, max_depth=6, learning_rate=0.01, subsample=0.3,
                 min_child_weight=1, colsample_bytree=0.7)
EARLY_STOP_ROUNDS = 50
EARLY_STOP_CAP = 30000
RF_GRID_DEPTHS = list(range(30, 51, 5))
SPARK_MAX_DEPTH = 30
FOLD_THREADS = 4            # folds fitted at a time
RF_TREES, RF_MIN_LEAF = 500, 75
LR_C_GRID = [1, 10, 100, 10000]


def feature_columns(df: DataFrame) -> list[str]:
    """M1: everything except the keys and the label."""
    return [c for c in df.columns if c not in KEYS + [LABEL, "fold", "split"]]


def prepare(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """NULL handling for Spark ML (its vectors carry no missing values):
    nullable features get a 0/1 missing indicator and a 0 fill."""
    cols, inputs = [], []
    for c in features:
        if c in NULLABLE:
            cols.append(F.col(c).isNull().cast("double").alias(f"{c}_missing"))
            inputs.append(f"{c}_missing")
        cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
        inputs.append(c)
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, *cols, F.col(LABEL).cast("double").alias("label")), inputs


def spec(params: dict, features: list[str] = (), held_out: int | None = None, seed: int = 42) -> bo.Spec:
    """XGBClassifier parameters (its defaults, as far as the reference leaves them) of one ensemble."""
    base = dict(n_estimators=100, max_depth=3, learning_rate=0.1, subsample=1.0, min_child_weight=1, colsample_bytree=1.0)
    return bo.Spec(**{**base, **params}, seed=seed, held_out=held_out, allowed=tuple(features))


def logistic(C: float, n: int, l1: bool = False) -> LogisticRegression:
    """sklearn ``LogisticRegression(C, penalty)`` defaults: 100 iterations,
    tolerance 1e-4."""
    return LogisticRegression(regParam=1.0 / (C * n), elasticNetParam=1.0 if l1 else 0.0,
                              standardization=False, maxIter=100, tol=1e-4)


def random_forest(max_depth: int, n_trees: int = RF_TREES, min_leaf: int = RF_MIN_LEAF,
                  seed: int = 42) -> RandomForestClassifier:
    if max_depth > SPARK_MAX_DEPTH:
        raise ValueError(f"Spark's forests take depths up to {SPARK_MAX_DEPTH}, not {max_depth}")
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth,
                                  minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
                                  seed=seed)


class PopulationScaler(Estimator):
    """M2: centre and divide by the population standard deviation (ddof 0,
    the reference's scaler; Spark's StandardScaler divides by the sample
    one).  A zero spread leaves the centred column unscaled.  Fitting is one
    aggregate row (two numbers per column)."""

    def __init__(self, inputCols: list[str]):
        super().__init__()
        self.inputCols = list(inputCols)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        aggs = []
        for i, c in enumerate(self.inputCols):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
        row = dataset.agg(*aggs).first()
        stats = [(float(row[f"m{i}"] or 0.0), float(row[f"s{i}"] or 0.0))
                 for i in range(len(self.inputCols))]
        return PopulationScalerModel(self.inputCols, stats)


class PopulationScalerModel(Model):
    def __init__(self, inputCols: list[str], stats: list[tuple[float, float]]):
        super().__init__()
        self.inputCols, self.stats = inputCols, stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            c: (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0)
            for c, (m, s) in zip(self.inputCols, self.stats)})


def make_pipeline(estimator, inputs: list[str], scale: bool = False) -> Pipeline:
    # M2: the scaler is fitted on the training rows only (inside the pipeline).
    stages = [PopulationScaler(inputs)] if scale else []
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages + [estimator])


def score(model: PipelineModel, df: DataFrame, t: float = 0.5) -> DataFrame:
    """Probability of class 1 and the class at cut t (strict)."""
    out = model.transform(df).withColumn("probability_1", vector_to_array("probability")[1])
    return ev.predict(out, "probability_1", t).drop("rawPrediction", "probability", "features", "raw")


@contextmanager
def fitting_rows(df: DataFrame):
    """Training rows held for the many passes of an iterative fit, in at least
    as many parts as there are cores, and released afterwards."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def fit_final(train: DataFrame, features: list[str] | None = None, seed: int = 42,
              **overrides) -> tuple[bo.Ensemble, list[str]]:
    """M3: the final boosted-tree model on the whole training table."""
    features = features or feature_columns(train)
    grown = bo.Boosting(train, features, LABEL, KEYS, [spec({**FINAL_GBT, **overrides}, seed=seed)])
    grown.grow(grown.specs[0].n_estimators)
    grown.close()
    return grown.ensemble(0), features


def holdout_scores(model: bo.Ensemble, features: list[str], test: DataFrame,
                   t: float = FINAL_THRESHOLD) -> DataFrame:
    """M4 + P8: (user_id, product_id, reordered, probability_1, prediction)."""
    scored = model.probabilities(test.select(*KEYS, F.col(LABEL), *features))
    return ev.predict(scored, "probability_1", t).select(*KEYS, LABEL, "probability_1", "prediction")


def staged_scores(model: bo.Ensemble, test: DataFrame, counts: list[int]) -> DataFrame:
    """M4 at several tree limits: a row per candidate and number of trees."""
    inputs = [f for f in model.features if f not in KEYS]
    scored = model.probabilities(test.select(*KEYS, *inputs), counts, "staged").select(*KEYS, F.posexplode("staged").alias("i", "probability_1"))
    return scored.select(*KEYS, F.element_at(F.array(*[F.lit(c) for c in counts]), F.col("i") + 1).alias("n_trees"), "probability_1")


def save_model(spark: SparkSession, model: bo.Ensemble, path: str) -> None:
    """The split table and the bins' cuts, as Parquet."""
    model.save(spark, path)


def load_model(spark: SparkSession, path: str) -> bo.Ensemble:
    return bo.Ensemble.load(spark, path)


def fit_early_stopped(df: DataFrame, features: list[str], specs: list[bo.Spec],
                      patience: int = EARLY_STOP_ROUNDS) -> tuple[list[bo.Ensemble], list[int], list[list[float]]]:
    """M5: ensembles that grow together until the AUC on the fold that each
    holds out has not improved for ``patience`` rounds, cut to their best number
    of trees.  Returns (models, best numbers, AUC per round)."""
    grown = bo.Boosting(df, features, LABEL, KEYS, specs, "fold")
    best, scores = bo.grow_until_best(grown, patience)
    grown.close()
    return [grown.ensemble(i, n) for i, n in enumerate(best)], best, scores


@dataclass
class CVResult:
    fold_metrics: DataFrame
    summary: DataFrame
    best_rounds: list[int] = field(default_factory=list)
    models: list = field(default_factory=list)
    features: list[str] = field(default_factory=list)


def cross_validate(df: DataFrame, make_estimator, features: list[str] | None = None,
                   k: int = 5, scale: bool = False, early_stop: dict | None = None,
                   cut: float = 0.5, patience: int = EARLY_STOP_ROUNDS) -> CVResult:
    """User-grouped K-fold.  ``df`` carries a ``fold`` column.  With
    ``early_stop`` (boosting parameters) all folds grow together, else
    ``FOLD_THREADS`` folds are fitted at a time.  Validation scores of all folds
    are unioned and evaluated together (V1-V7 in one pass); train F1 uses each
    model's own training rows.  The scores are stored, so nothing stays cached."""
    from rebuy.plans.stash import stash
    features = features or feature_columns(df)
    if early_stop is not None:
        models, rounds, _ = fit_early_stopped(df, features, [spec(early_stop, features, f) for f in range(k)], patience)
        return boosted_result(df, models, rounds, features, cut)
    d, inputs = prepare(df, features)
    with fitting_rows(d) as rows:
        def one(f: int):
            tr = rows.filter(F.col("fold") != f)
            model = make_pipeline(make_estimator(tr), inputs, scale).fit(tr)
            return model, score(model, rows, cut).select(F.lit(f).alias("model"), "fold", "label", "probability_1", "prediction")
        with ThreadPoolExecutor(FOLD_THREADS) as pool:
            fitted = list(pool.map(inheritable_thread_target(d.sparkSession)(one), range(k)))
        scores = fitted[0][1]
        for _, s in fitted[1:]:
            scores = scores.unionByName(s)
        scores = stash(scores)
    return cv_result(scores, [m for m, _ in fitted], [], features)


def cross_validate_fold_bins(df: DataFrame, features: list[str], bins: dict[str, tuple[str, str]], early_stop: dict,
                             k: int = 5, patience: int = EARLY_STOP_ROUNDS) -> CVResult:
    """M10 with bins fitted per fold: ``bins`` names, for each binned column, its
    category column in ``df`` and its rule.  The model of fold f sees the bins
    that the other folds' labels give; all folds still grow together."""
    from rebuy.plans.stash import stash
    for out_col, (key, rule) in bins.items():
        maps = stash(bn.fold_bin_maps(df, key, rule, out_col, k, LABEL))
        df = bn.with_fold_bins(df.drop(out_col), maps, key, out_col, k)
    df = stash(df)
    plain = [c for c in features if c not in bins]
    every = plain + [f"{c}_f{f}" for c in bins for f in range(k)]
    specs = [spec(early_stop, plain + [f"{c}_f{f}" for c in bins], f) for f in range(k)]
    models, rounds, _ = fit_early_stopped(df, every, specs, patience)
    return boosted_result(df, models, rounds, every)


def cross_validate_logistic(df: DataFrame, features: list[str] | None = None, C: float = 1.0, l1: bool = False,
                            k: int = 5, cut: float = 0.5) -> CVResult:
    """M6 / M9: the folds' regressions by shared passes, scored in one."""
    from rebuy.plans.stash import stash
    features = features or feature_columns(df)
    d, inputs = prepare(df, features)
    models, _ = lo.fit_all(d, [lo.Fit(tuple(inputs), C, l1, f) for f in range(k)], "label")
    scores = ev.predict(lo.probabilities(d, models, ["fold", "label"]), "probability_1", cut)
    return cv_result(stash(scores.select("model", "fold", "label", "probability_1", "prediction")), models, [], features)


def logistic_grid(df: DataFrame, stages: dict[str, list[str]], strengths: list[float], l1: bool = True, k: int = 5) -> DataFrame:
    """M7: stage, C and the CV summary of every (stage, C): all fits share their
    passes over the rows, and all validation scores are evaluated together."""
    d, _ = prepare(df, sorted({c for f in stages.values() for c in f}))
    points = [(stage, float(c)) for stage in stages for c in strengths]
    inputs = {s: tuple(i for c in f for i in ([f"{c}_missing"] if c in NULLABLE else []) + [c]) for s, f in stages.items()}
    fits = [lo.Fit(inputs[stage], c, l1, f) for stage, c in points for f in range(k)]
    models, _ = lo.fit_all(d, fits, "label")
    valid = lo.probabilities(d, models, ["fold", "label"], own_fold_only=True).withColumn("point", F.expr(f"model div {k}"))
    curve = ev.curve_counts(valid, "label", "probability_1", ["point", "fold"])
    each = (ev.best_f1(ev.pr_points(curve, ["point", "fold"]), ["point", "fold"]).select("point", "fold", F.col("f1").alias("best_f1"))
            .join(ev.auc(curve, ["point", "fold"]), ["point", "fold"], "left"))
    named = df.sparkSession.createDataFrame([(i, s, c) for i, (s, c) in enumerate(points)], "point long, stage string, C double")
    return (each.groupBy("point").agg(F.avg("best_f1").alias("mean_best_f1"), F.stddev_pop("best_f1").alias("std_best_f1"),
                                      F.avg("auc").alias("mean_auc"))
            .join(named, "point").select("stage", "C", "mean_best_f1", "std_best_f1", "mean_auc"))


def forest_grid(df: DataFrame, features: list[str], depths: list[int], k: int = 5, n_trees: int = RF_TREES,
                min_leaf: int = RF_MIN_LEAF, cut: float = 0.5, seed: int = 42) -> list[tuple[int, int, CVResult]]:
    """M8: (depth, depth of the deepest tree, CV result) of every depth, from one growth
    of the forests, whatever the table's size.  A depth that no tree goes beyond has the
    very forest of any greater one and shares its result."""
    from rebuy.plans.stash import stash
    d, inputs = prepare(df, features)
    scores, forests = fo.fold_scores(d, inputs, "label", KEYS, "fold", k, n_trees, min_leaf, depths, seed)
    deepest = max(f.depth for f in forests)
    out, fitted = [], {}
    for i, depth in enumerate(sorted(depths)):
        own = min(depth, deepest)
        if own not in fitted:
            s = ev.predict(scores.withColumn("probability_1", F.get("probabilities", F.lit(i))), "probability_1", cut)
            fitted[own] = cv_result(stash(s.select("model", "fold", "label", "probability_1", "prediction")), forests, [], features)
        out.append((depth, own, fitted[own]))
    return out


def boosted_result(df: DataFrame, models: list[bo.Ensemble], rounds: list[int], features: list[str], cut: float = 0.5) -> CVResult:
    """The metrics of one early-stopped model per fold, model f for fold f."""
    from rebuy.plans.stash import stash
    rows = df.select("fold", F.col(LABEL).cast("double").alias("label"), *features)
    scores = None
    for f, m in enumerate(models):
        s = ev.predict(m.probabilities(rows), "probability_1", cut).select(
            F.lit(f).alias("model"), "fold", "label", "probability_1", "prediction")
        scores = s if scores is None else scores.unionByName(s)
    return cv_result(stash(scores), models, rounds, features)


def cv_result(scores: DataFrame, models: list, rounds: list[int], features: list[str]) -> CVResult:
    from rebuy.plans.stash import stash
    valid = scores.filter("model = fold").drop("model")
    train = scores.filter("model <> fold").select(F.col("model").alias("fold"), "label", "prediction")
    metrics = stash(cv_fold_metrics(valid, train))
    return CVResult(metrics, ev.fold_summary(metrics), rounds, models, features)


def cv_fold_metrics(valid: DataFrame, train: DataFrame) -> DataFrame:
    """Per fold: accuracy / recall / precision / F1 at the cut, AUC, best F1
    over thresholds (validation rows) and F1 on the training rows."""
    conf = ev.confusion_metrics(valid, "label", "prediction", ["fold"]).select(
        "fold", "accuracy", "recall", "precision", "f1")
    tr = ev.confusion_metrics(train, "label", "prediction", ["fold"]).select(
        "fold", F.col("f1").alias("train_f1"))
    curve = ev.curve_counts(valid, "label", "probability_1", ["fold"])
    a = ev.auc(curve, ["fold"])
    b = ev.best_f1(ev.pr_points(curve, ["fold"]), ["fold"]).select("fold", F.col("f1").alias("best_f1"))
    return conf.join(tr, "fold", "left").join(a, "fold", "left").join(b, "fold", "left")


def point_f1(df: DataFrame, models: list[bo.Ensemble], k: int) -> DataFrame:
    """(point, mean_best_f1, std_best_f1) of ``k`` models a point, model f of a point on
    the rows of fold f; all points are evaluated together."""
    from rebuy.plans.stash import stash
    scores = stash(bo.own_fold_probabilities(df, models, k, LABEL))
    scores = scores.withColumn("point", F.expr(f"model div {k}"))
    keys = ["point", "fold"]
    curve = ev.curve_counts(scores, "label", "probability_1", keys)
    best = ev.best_f1(ev.pr_points(curve, keys), keys)
    return best.groupBy("point").agg(F.avg("f1").alias("mean_best_f1"), F.stddev_pop("f1").alias("std_best_f1"))


GRID_COLUMNS = ("param_id int, params string, mean_best_f1 double, std_best_f1 double, mean_best_rounds int")


def grid_search(df: DataFrame, grid: list[dict], base: dict, k: int = 5, features: list[str] | None = None,
                patience: int = EARLY_STOP_ROUNDS, journal: str | None = None, at_once: int = 6) -> DataFrame:
    """CV with early stopping at each grid point -> (param_id, params,
    mean_best_f1, std_best_f1, mean_best_rounds, rank).  The folds of ``at_once``
    points grow together.  With ``journal``, a folder, the results of finished
    points are stored there and a search that was broken off goes on after them.
    Equal scores go to the larger parameter values in grid order, as a maximum
    over (score, parameters) tuples does."""
    spark = df.sparkSession
    features = features or feature_columns(df)
    rows = {r["param_id"]: tuple(r) for r in _journal(spark, journal)}
    for i, r in rows.items():
        if i >= len(grid) or r[1] != str(sorted(grid[i].items())):
            raise ValueError(f"{journal} holds another search: point {i} was {r[1]}")
    todo = [i for i in range(len(grid)) if i not in rows]
    for a in range(0, len(todo), at_once):
        points = todo[a:a + at_once]
        specs = [spec({**base, **grid[i]}, features, f) for i in points for f in range(k)]
        models, rounds, _ = fit_early_stopped(df, features, specs, patience)
        found = {r["point"]: r for r in point_f1(df, models, k).collect()}       # a row per point
        done = []
        for j, i in enumerate(points):
            mean, std = (found[j]["mean_best_f1"], found[j]["std_best_f1"]) if j in found else (0.0, 0.0)
            done.append((i, str(sorted(grid[i].items())), float(mean or 0.0), float(std or 0.0),
                         int(sum(rounds[j * k:(j + 1) * k]) / k)))
        if journal:
            spark.createDataFrame(done, GRID_COLUMNS).coalesce(1).write.mode("append").parquet(journal)
        rows.update({r[0]: r for r in done})
    order = sorted(rows.values(), key=lambda r: (r[2], sorted(grid[r[0]].items())), reverse=True)
    rank = {r[0]: i + 1 for i, r in enumerate(order)}
    return spark.createDataFrame([(*rows[i], rank[i]) for i in sorted(rows)], GRID_COLUMNS + ", rank int")


def _journal(spark: SparkSession, path: str | None) -> list:
    if path is None:
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return []
    return spark.read.schema(GRID_COLUMNS).parquet(path).collect()       # a row per finished point


def feature_importance(nodes: DataFrame) -> DataFrame:
    """M14 + C5, from a split table: per feature that splits anywhere its mean gain a split (the
    reference's ``gain``), its total gain, its splits and its type by name prefix,
    sorted by gain."""
    return (nodes.filter(F.col("feature").isNotNull()).groupBy(F.col("feature").alias("feature_names"))
            .agg(F.avg("gain").alias("gain"), F.sum("gain").alias("total_gain"), F.count(F.lit(1)).alias("splits"))
            .withColumn("feature_type", feature_type("feature_names")).orderBy(F.desc("gain"), "feature_names"))
