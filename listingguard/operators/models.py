"""Grouped cross-validation, stacking, calibration, search and batch scoring with Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import report_round
from listingguard.operators import features as fe
from listingguard.operators import text as tx
from listingguard.operators.bundle import Bundle
from listingguard.operators.estimators import ListingVectorModel, PlaceFeaturesModel
from listingguard.operators.ledger import FitLedger, content_key
from listingguard.operators.metrics import _curve_metrics, curve, evaluate, long_scores
from listingguard.operators.predlog import tier
from listingguard.operators.splits import with_group_folds
from listingguard.sources.stage import in_parallel, materialize, work_dir


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings (defaults are the fixed baseline values)."""

    trees: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    min_rows: int = 30
    row_share: float = 0.8
    column_share: float = 0.8


# The tuned setting.
TUNED = TreeParams(306, 0.07543753502638627, 5, 22, 0.8359541264922199, 0.7878169701860978)


#: Training rows that one task of a boosting round takes.
ROWS_PER_TASK = 100_000


def probability(model: Model, df: DataFrame, name: str) -> DataFrame:
    return model.transform(df).withColumn(name, vector_to_array("probability")[1])


def _counts(df: DataFrame, label: str) -> tuple[float, float]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p")).first()
    return float(row["n"]), float(row["p"] or 0)


def scale_pos_weight(n: float, positives: float) -> float:
    if not 0 < positives < n:
        raise ValueError(f"training needs rows of both labels; {positives:.0f} of {n:.0f} are positive")
    share = positives / n
    return round((1 - share) / share, 2)


def fit_logistic(df: DataFrame, c: float = 1.0, balanced: bool = True, label: str = "label") -> Model:
    """L2 logistic regression with the strength given as C: the penalty is 1/(C·Σ weights)."""
    n, p = _counts(df, label)
    est = LogisticRegression(
        labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=1000
    )
    if not balanced:
        return est.fit(df)
    weight = F.when(F.col(label) == 1, n / (2 * p)).otherwise(n / (2 * (n - p)))
    return est.setWeightCol("_w").fit(df.withColumn("_w", weight))


def fit_trees(
    df: DataFrame,
    params: TreeParams,
    positive_weight: float,
    label: str = "label",
    features: str = "features",
    seed: int = SETTINGS.seed,
) -> Model:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # cuts the lineage that grows with each boosting round
        context.setCheckpointDir(f"{work_dir(df.sparkSession)}/rounds")
    # A round is one short job per level: a small table is kept in few partitions, a large one as it is read.
    df = df.coalesce(max(1, math.ceil(df.count() / ROWS_PER_TASK)))
    est = GBTClassifier(
        labelCol=label,
        featuresCol=features,
        weightCol="_w",
        maxIter=params.trees,
        stepSize=params.learning_rate,
        maxDepth=params.depth,
        minInstancesPerNode=params.min_rows,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        maxMemoryInMB=512,
        seed=seed,
    )
    return est.fit(df.withColumn("_w", F.when(F.col(label) == 1, float(positive_weight)).otherwise(1.0)))


#: What the model matrix is made of, beside id, fold and label.
FOLD_INPUTS = (*fe.NUMERIC, *fe.CATEGORICAL, *[c for c in ("city", "zip_code", "prev_sold_date") if c not in fe.CATEGORICAL])


def fold_matrix(df: DataFrame, folds: int = SETTINGS.cv_folds, label: str = "is_fraud", written: bool = False) -> DataFrame:
    """Model matrix of every fold: (cv_fold, is_train, listing_id, label, features).

    ``df`` has a ``fold`` column. The row-wise features are computed once, and the fitted statistics of all folds come from passes that count
    every row once (``fit_left_out``, ``fit_left_out_preprocessor``). The matrix is a view, one branch per fold over the same rows: a filter
    on ``cv_fold`` leaves one branch, and its rows are not written. ``written`` stores it by fold, for callers that read each fold many times.
    """
    kept = df.select("listing_id", "fold", label, *FOLD_INPUTS)
    rows = materialize(kept, "fold_rows")
    stats, once = in_parallel(
        lambda: fe.fit_left_out(rows, folds, label),
        lambda: materialize(fe.stateless_features(rows).drop("listing_id", "prev_sold_date"), "fold_features"),
    )
    seen = in_parallel(*[lambda k=k: fe.apply_features(_in_fold(once, k), stats.of(k)) for k in range(folds)])
    prep = fe.fit_left_out_preprocessor(once, reduce(DataFrame.unionByName, seen).where("is_train"), folds)
    vector = F.array(*[F.col(c).cast("double") for c in fe.feature_names()])

    def one(k: int) -> DataFrame:
        mine = fe.preprocess(fe.engineered(_in_fold(rows, k), stats.of(k)), prep.of(k))
        return mine.select("cv_fold", "is_train", "listing_id", F.col(label).cast("double").alias("label"), vector.alias("x"))

    out = reduce(DataFrame.unionByName, in_parallel(*[lambda k=k: one(k) for k in range(folds)]))
    return materialize(out, "fold_matrix", ["cv_fold"]) if written else out


def _in_fold(rows: DataFrame, k: int) -> DataFrame:
    return rows.withColumns({"cv_fold": F.lit(k), "is_train": F.col("fold") != k})


def with_vector(matrix: DataFrame, column: str = "x") -> DataFrame:
    return matrix.withColumn("features", array_to_vector(column))


def cross_validate(
    matrix: DataFrame,
    fit: Callable[[DataFrame], Model],
    name: str = "p",
    folds: int = SETTINGS.cv_folds,
    threads: int = 5,
    ledger: FitLedger | None = None,
    settings: object = None,
) -> DataFrame:
    """Out-of-fold scores (listing_id, fold, y_true, name): each fold fitted on its training rows, fits side by side.

    With a ``ledger`` every fitted fold is saved under its rows and ``settings``; a restart fits the folds that are not there.
    """

    def one(k: int) -> DataFrame:
        # Held as vectors: the estimators read the input several times, and making them from arrays costs more than reading them.
        fold = with_vector(matrix.where(F.col("cv_fold") == k)).drop("x").persist()
        train = fold.where("is_train").select("listing_id", "label", "features")

        def fitted() -> Model:  # the estimators cache their own compact form of the input
            return fit(train)

        model = ledger.model(f"{name}-{content_key(train, name, settings)}", fitted) if ledger else fitted()
        scored = probability(model, fold.where(~F.col("is_train")), name)
        scored = scored.select("listing_id", F.lit(k).alias("fold"), F.col("label").cast("int").alias("y_true"), name)
        done = materialize(scored, f"oof_{name}")
        fold.unpersist()
        return done

    return reduce(DataFrame.unionByName, in_parallel(*[lambda k=k: one(k) for k in range(folds)], threads=threads))


def cv_logistic(
    matrix: DataFrame, folds: int = SETTINGS.cv_folds, c: float = 1.0, ledger: FitLedger | None = None
) -> DataFrame:
    return cross_validate(matrix, lambda t: fit_logistic(t, c), "lr", folds, ledger=ledger, settings=c)


def cv_trees(
    matrix: DataFrame,
    params: TreeParams,
    folds: int = SETTINGS.cv_folds,
    name: str = "gbt",
    ledger: FitLedger | None = None,
) -> DataFrame:
    # Every fold holds every row, to train on or to validate with, so these are the counts of the whole input.
    n, p = _counts(matrix.where(F.col("cv_fold") == 0), "label")
    weight = scale_pos_weight(n, p)
    return cross_validate(matrix, lambda t: fit_trees(t, params, weight), name, folds, ledger=ledger, settings=(params, weight))


def add_text(matrix: DataFrame, listings: DataFrame, text: str = "description", folds: int = SETTINGS.cv_folds) -> DataFrame:
    """Matrix with text features appended; vocabulary and basis come from the training rows of each fold.

    ``listings`` has (listing_id, fold, text).
    """

    def one(k: int) -> DataFrame:
        train = listings.where(F.col("fold") != k)
        model = tx.fit_vocabulary(train, "listing_id", text)
        weights = materialize(tx.tfidf(train, "listing_id", text, model), "fold_tfidf")
        model = tx.fit_svd(weights, "listing_id", model)
        return tx.svd_features(listings, "listing_id", text, model).withColumn("cv_fold", F.lit(k))

    parts = in_parallel(*[lambda k=k: one(k) for k in range(folds)], threads=3)
    vectors = parts[0]
    for p in parts[1:]:
        vectors = vectors.unionByName(p)
    joined = matrix.join(vectors, ["cv_fold", "listing_id"]).withColumn("x", F.concat("x", "text_svd"))
    return materialize(joined.select(*matrix.columns), "fold_matrix_text", ["cv_fold"])


def fold_metrics(oof: DataFrame, name: str) -> DataFrame:
    """PR-AUC and recall at 95 % precision of each fold."""
    keyed = oof.select(F.col("y_true").alias("y"), F.col(name).alias("p"), F.col("fold").cast("string").alias("model"))
    return _curve_metrics(curve(keyed)).select(
        F.col("model").cast("int").alias("fold"),
        report_round("pr_auc", 6).alias("pr_auc"),
        report_round("recall_at_95p", 6).alias("recall_at_95p"),
        report_round("roc_auc", 6).alias("roc_auc"),
    )


def oof_table(parts: Sequence[DataFrame]) -> DataFrame:
    """Out-of-fold scores of several models side by side, joined by listing."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p.drop("fold", "y_true"), "listing_id")
    return out


@dataclass(frozen=True)
class Stack:
    """Meta-model over base scores and the Platt model over its output."""

    columns: tuple[str, ...]
    meta: Model
    platt: Model

    def score(self, df: DataFrame) -> DataFrame:
        raw = probability(self.meta, _assemble(df, self.columns, "features"), "p_stacked")
        raw = raw.select(*df.columns, "p_stacked")
        out = probability(self.platt, _assemble(raw, ["p_stacked"], "features"), "p_calibrated")
        return out.select(*df.columns, "p_stacked", "p_calibrated")


def _assemble(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def fit_stack(oof: DataFrame, columns: Sequence[str], label: str = "y_true", meta_c: float = 0.1) -> Stack:
    """Logistic meta-model on out-of-fold scores only, then Platt scaling on its raw probability."""
    rows = oof.withColumn("label", F.col(label).cast("double"))
    meta = fit_logistic(_assemble(rows, columns, "features"), meta_c, balanced=False)
    raw = probability(meta, _assemble(rows, columns, "features"), "p_stacked").select("label", "p_stacked")
    platt = fit_logistic(_assemble(raw, ["p_stacked"], "features"), 1.0, balanced=False)
    return Stack(tuple(columns), meta, platt)


def listing_matrix(listings: DataFrame, stats: fe.FeatureStats, prep: fe.Preprocessor) -> DataFrame:
    """(listing_id, x): the model inputs of listings by fitted statistics and preprocessing."""
    ready = fe.preprocess(fe.engineered(listings, stats), prep)
    vector = F.array(*[F.col(c).cast("double") for c in fe.feature_names()])
    return ready.select("listing_id", vector.alias("x"))


class Scorer(Bundle):
    """Everything needed to score new listings: fitted statistics, preprocessing, both models, the stack and the order of the inputs.

    ``scorer.write().save(path)`` and ``Scorer.load(path)`` keep it on disk; a saved scorer whose inputs have another order than this
    code's is refused.
    """

    def __init__(self, stats: fe.FeatureStats, prep: fe.Preprocessor, lr: Model, gbt: Model, stack: Stack) -> None:
        super().__init__()
        self.stats, self.prep, self.lr, self.gbt, self.stack = stats, prep, lr, gbt, stack

    def _facts(self):
        return {"features": fe.feature_names(), "stack": list(self.stack.columns), "model_version": SETTINGS.model_version}

    def _parts(self):
        fitted = {"places": PlaceFeaturesModel(self.stats), "vector": ListingVectorModel(self.prep)}
        return {**fitted, "lr": self.lr, "gbt": self.gbt, "meta": self.stack.meta, "platt": self.stack.platt}

    @classmethod
    def _restored(cls, facts, tables, parts):
        prep = parts["vector"].prep
        inputs = fe.feature_names()
        if facts["features"] != inputs or [*prep.numeric, *prep.categorical] != inputs:
            raise ValueError(f"the saved model takes {facts['features']}, this code makes {inputs}")
        for name in ("lr", "gbt"):
            if parts[name].numFeatures != len(inputs):
                raise ValueError(f"the saved model {name} takes {parts[name].numFeatures} inputs, not {len(inputs)}")
        stack = Stack(tuple(facts["stack"]), parts["meta"], parts["platt"])
        return cls(parts["places"].stats, prep, parts["lr"], parts["gbt"], stack)

    def matrix(self, listings: DataFrame) -> DataFrame:
        return listing_matrix(listings, self.stats, self.prep)

    def score(self, listings: DataFrame) -> DataFrame:
        """(listing_id, lr, gbt, fraud_score, is_suspicious, risk_tier, model_version)."""
        x = with_vector(self.matrix(listings))
        base = probability(self.lr, x, "lr").select("listing_id", "features", "lr")
        base = probability(self.gbt, base, "gbt").select("listing_id", "lr", "gbt")
        out = self.stack.score(base)
        clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p_calibrated")))
        return out.withColumn("_s", clipped).select(
            "listing_id",
            "lr",
            "gbt",
            report_round("_s", 4).alias("fraud_score"),
            (F.col("_s") >= SETTINGS.suspicious_score).alias("is_suspicious"),
            tier("_s").alias("risk_tier"),
            F.lit(SETTINGS.model_version).alias("model_version"),
        )


def fit_final(
    labeled: DataFrame, params: TreeParams, label: str = "is_fraud", ledger: FitLedger | None = None
) -> tuple[fe.FeatureStats, fe.Preprocessor, Model, Model]:
    """Statistics, preprocessing and both models on all training rows."""
    stats = fe.fit_features(labeled, label)
    eng = materialize(fe.engineered(labeled, stats), "train_features")
    prep = fe.fit_preprocessor(eng)
    vector = F.array(*[F.col(c).cast("double") for c in fe.feature_names()])
    ready = fe.preprocess(eng.withColumn("label", F.col(label).cast("double")), prep)
    train = materialize(ready.select("listing_id", "label", vector.alias("x")), "train_matrix")
    n, p = _counts(train, "label")
    weight = scale_pos_weight(n, p)

    def trees() -> Model:
        return fit_trees(with_vector(train), params, weight)

    def kept() -> Model:
        return ledger.model(f"final-{content_key(train, params, weight)}", trees) if ledger else trees()

    lr, gbt = in_parallel(lambda: fit_logistic(with_vector(train)), kept)
    return stats, prep, lr, gbt


def fit_scorer(labeled: DataFrame, stack: Stack, params: TreeParams, label: str = "is_fraud", ledger: FitLedger | None = None) -> Scorer:
    """Final models on all training rows; the stack comes from the out-of-fold scores."""
    return Scorer(*fit_final(labeled, params, label, ledger), stack)


@dataclass(frozen=True)
class SearchSpace:
    """Ranges of the random search (fixed values); (low, high), learning rate on a log scale."""

    trees: tuple[int, int] = (200, 1000)
    learning_rate: tuple[float, float] = (0.01, 0.2)
    depth: tuple[int, int] = (4, 10)
    min_rows: tuple[int, int] = (10, 100)
    row_share: tuple[float, float] = (0.6, 1.0)
    column_share: tuple[float, float] = (0.5, 1.0)

    def draw(self, rng: random.Random) -> TreeParams:
        lo, hi = self.learning_rate
        return TreeParams(
            rng.randint(*self.trees),
            math.exp(rng.uniform(math.log(lo), math.log(hi))),
            rng.randint(*self.depth),
            rng.randint(*self.min_rows),
            rng.uniform(*self.row_share),
            rng.uniform(*self.column_share),
        )


def _mean_fold_pr_auc(oof: DataFrame, name: str) -> float:
    keyed = oof.select(F.col("y_true").alias("y"), F.col(name).alias("p"), F.col("fold").cast("string").alias("model"))
    return _curve_metrics(curve(keyed)).agg(F.avg("pr_auc")).first()[0]


SEARCH_SCHEMA = (
    "outer_fold int, inner_pr_auc double, outer_pr_auc double, trees int, learning_rate double, depth int, "
    "min_rows int, row_share double, column_share double"
)


def nested_search(
    labeled: DataFrame,
    trials: int = 20,
    outer: int = 5,
    inner: int = 3,
    space: SearchSpace = SearchSpace(),
    checkpoint: str | None = None,
    label: str = "is_fraud",
    seed: int = SETTINGS.seed,
) -> DataFrame:
    """Random search inside grouped outer folds; one row per outer fold with its best setting.

    Each finished outer fold is appended to ``checkpoint``; a restart continues with the folds not yet there.
    """
    spark = labeled.sparkSession
    path = checkpoint or f"{work_dir(spark)}/search-{seed}-{trials}-{outer}-{inner}-{random.SystemRandom().getrandbits(48):x}"
    done = _finished_folds(spark, path)
    rows = materialize(with_group_folds(labeled.select("listing_id", label, *FOLD_INPUTS), folds=outer), "search_rows")
    outer_matrix = fold_matrix(rows, outer, label, written=True)
    n, p = _counts(labeled, label)
    weight = scale_pos_weight(n, p)
    for k in range(outer):
        if k in done:
            continue
        train = rows.where(F.col("fold") != k).drop("fold")
        matrix = fold_matrix(with_group_folds(train, folds=inner), inner, label, written=True)
        rng = random.Random(seed * 1000 + k)
        best: tuple[float, TreeParams] | None = None
        for _ in range(trials):
            params = space.draw(rng)
            oof = cross_validate(matrix, lambda t, q=params: fit_trees(t, q, weight), "p", inner)
            value = _mean_fold_pr_auc(oof, "p")
            if best is None or value > best[0]:
                best = (value, params)
        fold = with_vector(outer_matrix.where(F.col("cv_fold") == k))
        model = fit_trees(fold.where("is_train"), best[1], weight)
        scored = probability(model, fold.where(~F.col("is_train")), "p")
        held = scored.select(F.col("label").cast("int").alias("y_true"), F.lit(k).alias("fold"), "p")
        record = {"outer_fold": k, "inner_pr_auc": best[0], "outer_pr_auc": _mean_fold_pr_auc(held, "p"), **asdict(best[1])}
        spark.createDataFrame([record], SEARCH_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(SEARCH_SCHEMA).parquet(path)


def _finished_folds(spark: SparkSession, path: str) -> set[int]:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp):
        return set()
    return {r["outer_fold"] for r in spark.read.schema(SEARCH_SCHEMA).parquet(path).select("outer_fold").collect()}


def best_of_search(results: DataFrame) -> TreeParams:
    """Setting of the outer fold with the highest held-out PR-AUC."""
    r = results.orderBy(F.desc("outer_pr_auc"), "outer_fold").first()
    return TreeParams(r["trees"], r["learning_rate"], r["depth"], r["min_rows"], r["row_share"], r["column_share"])


def compare(oof: DataFrame, columns: Sequence[str]) -> DataFrame:
    return evaluate(long_scores(oof, columns))
