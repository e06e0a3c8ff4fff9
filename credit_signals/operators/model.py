"""Default model: assemble, split, fit, evaluate, score, band.

Fitting and evaluation use Spark ML (distributed tree-aggregates per L-BFGS
iteration, over the training blocks the fit caches itself).  Scoring with given weights is a plain column expression, so it
stays inside whole-stage codegen.  The grid AUC groups scores on a fixed grid
first - at most ``grid + 1`` rows whatever the data size - and only then runs
the ordered running sum, so no step gathers unbounded data into one task.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals import schemas
from credit_signals.functions import rules as R
from credit_signals.session import scratch_path

SPLIT_BUCKETS = 10
TRAIN_BUCKETS = 8          # buckets 0..7 train, 8..9 test: an 80/20 split
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
MAX_ITER = 10


class OneClassTrainingSet(ValueError):
    pass


# --- preparation ----------------------------------------------------------------

def fill_feature_nulls(df: DataFrame, cols=R.FEATURE_COLS) -> DataFrame:
    """NULL and NaN -> 0 in the feature columns (assembler rejects both)."""
    return df.fillna(0, subset=list(cols))


def prepare_features(df: DataFrame, cols=R.FEATURE_COLS, label: str = R.LABEL_COL) -> DataFrame:
    """Fill, assemble ``features`` and cast the label to double."""
    assembled = VectorAssembler(inputCols=list(cols), outputCol="features").transform(
        fill_feature_nulls(df, cols))
    return assembled.withColumn(label, F.col(label).cast("double"))


def unpack_features(df: DataFrame, cols=R.FEATURE_COLS, key: str = "account_id") -> DataFrame:
    """The assembled vector as one double column per feature."""
    arr = vector_to_array(F.col("features"))
    return df.select(key, *[arr[i].alias(c) for i, c in enumerate(cols)])


# --- split ---------------------------------------------------------------------

def split_label(key: str = "account_id") -> Column:
    """'train' / 'test' from a stable hash of the key: reproducible on any
    partitioning and in any engine, unlike a seeded random split."""
    return F.when(R.hash_bucket(key, SPLIT_BUCKETS) < TRAIN_BUCKETS, "train").otherwise("test")


def hash_split(df: DataFrame, key: str = "account_id") -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``split_label``; a NULL key has no bucket and is a test row."""
    label = split_label(key)
    return df.where(label == "train"), df.where(label == "test")


def random_split_label(key: str = "account_id", weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED) -> Column:
    """'train' / 'test' by a seeded draw per key: no sort, no second pass, the same on any partitioning."""
    draw = F.xxhash64(F.lit(seed), F.col(key)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    return F.when(draw < weights[0] / sum(weights), "train").otherwise("test")


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED, key: str = "account_id"):
    """(train, test) by ``random_split_label``; rows of one key stay together."""
    label = random_split_label(key, weights, seed)
    return df.where(label == "train"), df.where(label == "test")


# --- fit / evaluate --------------------------------------------------------------

def class_counts(df: DataFrame, split: Column | None = None, label: str = R.LABEL_COL) -> dict:
    """{split: (rows, positives, negatives)} in one aggregation pass."""
    key = split if split is not None else F.lit("all")
    rows = (df.groupBy(key.alias("split"))
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) == 0).alias("neg")).collect())      # <= 2 rows
    return {r["split"]: (r["rows"], r["pos"], r["neg"]) for r in rows}


def check_two_classes(counts: tuple[int, int, int]) -> None:
    _, pos, neg = counts
    if not pos or not neg:
        raise OneClassTrainingSet(f"training set needs both classes, got {pos} positive / {neg} negative")


def fit(train: DataFrame, label: str = R.LABEL_COL, max_iter: int = MAX_ITER,
        checked: bool = False) -> LogisticRegressionModel:
    """Logistic regression, library defaults except ``maxIter``."""
    if not checked:
        check_two_classes(class_counts(train, label=label)["all"])
    return LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter).fit(train)


def evaluate_auc(model, test: DataFrame, label: str = R.LABEL_COL, num_bins: int = 1000) -> float:
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=num_bins)
    return float(evaluator.evaluate(model.transform(test)))


# Units in which every feature is a whole number, so that sums of products are exact.
FEATURE_UNITS = {"debt_ratio": 10_000, "revolving_utilization": 10_000}


def moment_sums(df: DataFrame, split: Column | None = None, cols=R.FEATURE_COLS, label: str = R.LABEL_COL,
                units: dict[str, int] | None = None) -> DataFrame:
    """(split, a, b, total): the sum of a * b over the rows of each split, in one aggregation pass.

    ``a`` and ``b`` run over ``one``, the features in whole units, and ``label``;
    each pair once.  These are the sufficient statistics of a first Newton step
    from zero weights: the gradient is sum(x * (label - 1/2)), the Hessian
    sum(x * x') / 4.  Totals are exact decimals whatever the partitioning.
    Features are filled as for the fit; rows without a label take no part.
    """
    units = FEATURE_UNITS if units is None else units
    ready = fill_feature_nulls(df, cols).where(F.col(label).isNotNull())
    terms = {"one": F.lit(1).cast("long"), **{c: F.round(F.col(c) * units.get(c, 1)).cast("long") for c in cols},
             "label": F.col(label).cast("long")}
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    whole = "decimal(38,0)"
    key = split if split is not None else F.lit("all")
    sums = ready.select(key.alias("split"), *[c.alias(n) for n, c in terms.items()]).groupBy("split").agg(
        *[F.sum((F.col(a) * F.col(b)).cast(whole)).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("total"))
                              for a, b in pairs]))
    return sums.select("split", rows)


def newton_step(sums: DataFrame, split: str = "all", cols=R.FEATURE_COLS, units: dict[str, int] | None = None) -> LinearScore:
    """The weights after one Newton step from zero, from ``moment_sums`` (a fixed number of rows)."""
    import numpy as np
    units = FEATURE_UNITS if units is None else units
    total = {(r["a"], r["b"]): float(r["total"]) for r in sums.where(F.col("split") == split).collect()}   # 55 rows
    names = ["one", *cols]
    hessian = np.array([[total.get((a, b), total.get((b, a))) for b in names] for a in names]) / 4
    gradient = np.array([total[a, "label"] - total.get(("one", a), total.get((a, "one"))) / 2 for a in names])
    scale = np.sqrt(np.maximum(np.diag(hessian), 1e-300))
    step = np.linalg.lstsq(hessian / np.outer(scale, scale), gradient / scale, rcond=1e-12)[0] / scale
    return LinearScore(tuple((c, float(w) * units.get(c, 1), None) for c, w in zip(cols, step[1:])), float(step[0]), None)


def log_losses(df: DataFrame, scores: dict[str, LinearScore], label: str = R.LABEL_COL) -> DataFrame:
    """(rows, one mean log loss per score) over the rows with a label, in one pass; probabilities kept off 0 and 1."""
    y = F.col(label).cast("double")
    ready = fill_feature_nulls(df).where(F.col(label).isNotNull())

    def loss(score: LinearScore) -> Column:
        p = F.least(F.greatest(score.probability(), F.lit(1e-15)), F.lit(1 - 1e-15))
        return F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))

    return ready.agg(F.count(F.lit(1)).alias("rows"), *[loss(s).alias(name) for name, s in scores.items()])


@dataclass
class TrainResult:
    model: LogisticRegressionModel
    auc: float
    train_rows: int
    test_rows: int


def train_model(prepared: DataFrame, split: str = "hash", label: str = R.LABEL_COL,
                max_iter: int = MAX_ITER, num_bins: int = 1000, auc: str = "grid") -> TrainResult:
    """Split, fit on the train part, AUC on the test part.

    Nothing is persisted here: the fit caches its own training blocks (label,
    weight, vector) for its iterations, which is all that is reused; split
    sizes and the class check are one column-pruned pass, and the evaluation
    reads the test split once.  Caching the whole prepared frame as well would
    double the cached volume at scale for no saved pass.

    ``auc="grid"`` is the bounded grid form (one partial aggregation, no sort),
    within 1e-3 of the exact value (tested; about 1e-5 on the given tables);
    ``auc="evaluator"`` is Spark ML's evaluator, which sorts the test split.
    """
    train, test = hash_split(prepared) if split == "hash" else random_split(prepared)
    part = split_label() if split == "hash" else random_split_label()
    counts = class_counts(prepared.select("account_id", label), part, label)
    check_two_classes(counts.get("train", (0, 0, 0)))
    model = fit(train, label, max_iter, checked=True)
    if auc == "grid":
        scored = test.withColumn("risk_score", LinearScore.from_model(model).probability())
        value = grid_auc(scored, label=label).first()["auc"]
        value = 0.5 if value is None else float(value)
    else:
        value = evaluate_auc(model, test, label, num_bins)
    return TrainResult(model, value, counts.get("train", (0,))[0], counts.get("test", (0,))[0])


def model_coefficients(spark, model: LogisticRegressionModel, cols=R.FEATURE_COLS) -> DataFrame:
    """(term, weight): intercept first, then one row per feature (9 rows)."""
    rows = [("intercept", float(model.intercept))]
    rows += [(c, float(w)) for c, w in zip(cols, model.coefficients.toArray())]
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def verdict(auc: Column) -> Column:
    return F.when(auc > R.AUC_GOOD, "Good").otherwise("Needs improvement")


# --- scoring ---------------------------------------------------------------------

def _stamp(df: DataFrame, run_ts, version: str) -> DataFrame:
    """``scored_at`` is an instant: now, or the given time (UTC unless it names a zone)."""
    if run_ts is None:
        ts = F.current_timestamp()
    else:
        at = run_ts if isinstance(run_ts, _dt.datetime) else _dt.datetime.fromisoformat(run_ts)
        at = at.replace(tzinfo=_dt.timezone.utc) if at.tzinfo is None else at.astimezone(_dt.timezone.utc)
        ts = F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f") + "Z").cast("timestamp")
    return df.withColumns({"model_version": F.lit(version), "scored_at": ts})


def score_accounts(model, prepared: DataFrame, run_ts=None, version: str = R.MODEL_VERSION,
                   rules: R.RiskRules = R.DEFAULT_RULES) -> DataFrame:
    """Positive-class probability + band + run metadata.

    ``model`` is a fitted model (``transform`` + element 1 of ``probability``)
    or a ``LinearScore`` (given weights, a plain column expression).
    """
    if isinstance(model, LinearScore):
        return score_with_weights(prepared, model, run_ts, version, rules)
    out = model.transform(prepared).withColumn("risk_score", vector_to_array(F.col("probability"))[1])
    return _stamp(out.withColumn("risk_band", R.risk_band("risk_score", rules)), run_ts, version)


@dataclass(frozen=True)
class LinearScore:
    """``1/(1+exp(-z))`` with ``z = intercept + sum(w * (x - center))``."""

    terms: tuple  # (column, weight, center or None)
    intercept: float = 0.0
    digits: int | None = 6

    def z(self) -> Column:
        parts = [F.lit(w) * ((F.col(c) - center) if center is not None else F.col(c))
                 for c, w, center in self.terms]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        return total + F.lit(self.intercept) if self.intercept else total

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.z()))
        return F.round(p, self.digits) if self.digits is not None else p

    @classmethod
    def from_model(cls, model: LogisticRegressionModel, cols=R.FEATURE_COLS, digits=None):
        return cls(tuple((c, float(w), None) for c, w in zip(cols, model.coefficients.toArray())),
                   float(model.intercept), digits)


# Fixed test model (FIXTURES.md section 5): spans all three bands on the fixtures.
PINNED = LinearScore(terms=(("credit_score", -0.006, 600), ("debt_ratio", 3.0, 0.35),
                            ("delinquency_risk_score", 0.15, None), ("debt_stress", 0.5, None)))


def score_with_weights(features: DataFrame, weights: LinearScore = PINNED, run_ts=None,
                       version: str = R.MODEL_VERSION, rules: R.RiskRules = R.DEFAULT_RULES) -> DataFrame:
    scored = features.withColumn("risk_score", weights.probability())
    return _stamp(scored.withColumn("risk_band", R.risk_band("risk_score", rules)), run_ts, version)


def scored_projection(scored: DataFrame) -> DataFrame:
    """The 11 warehouse columns, two renamed; types as produced by the job."""
    return scored.select(*[F.col(schemas.SCORED_SOURCES.get(f.name, f.name)).alias(f.name)
                           for f in schemas.SCORED.fields])


def conform_scored(scored: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Names and types of the warehouse table (DDL types, incl. double score).

    ``names`` renames target columns, for a table that declares other names
    (``schemas.DDL_NAMES`` for the declared warehouse table).
    """
    out = schemas.conform(scored, schemas.SCORED, schemas.SCORED_SOURCES)
    return out.withColumnsRenamed(names) if names else out


# --- AUC on a score grid ---------------------------------------------------------

def grid_auc(scored: DataFrame, score: str = "risk_score", label: str = R.LABEL_COL,
             grid: int = 10_000, digits: int = 6, report_skipped: bool = False) -> DataFrame:
    """Area under ROC over ``floor(score * grid)``, ties at half weight.

    Only rows with a score and a label 0 or 1 count; ``report_skipped`` adds the
    number of others as ``skipped_rows``.  Exact decimal numerator (38 digits:
    10^18 rows of each class); the one ordered window runs over <= grid + 2 rows.
    """
    s, y = F.col(score), F.col(label)
    valid = F.coalesce(s.isNotNull() & ~F.isnan(s) & y.isin(0, 1), F.lit(False))
    cells = (scored.groupBy(F.when(valid, F.floor(s * grid)).alias("cell"))
             .agg(F.count_if(valid & (y == 1)).alias("pos"), F.count_if(valid & (y == 0)).alias("neg"),
                  F.count_if(~valid).alias("skipped")))
    return _auc_of_cells(cells, digits, report_skipped)


def exact_auc(scored: DataFrame, score: str = "risk_score", label: str = R.LABEL_COL, digits: int = 12) -> DataFrame:
    """Area under ROC over the scores themselves, ties at half weight; no step gathers all rows in one task.

    Rows of one score become one cell (map-side combine).  The cells are range
    partitioned by score and written with the number of their range; the totals
    of the ranges, one row each, give every range the negatives below it, and
    ranks are running sums inside a range.  Columns ``auc``, ``pos``, ``neg``.
    Rows without a score or a label 0 or 1 take no part; one class alone gives NULL.
    """
    spark = scored.sparkSession
    s, y = F.col(score).cast("double"), F.col(label)
    valid = F.coalesce(s.isNotNull() & ~F.isnan(s) & y.isin(0, 1), F.lit(False))
    cells = scored.where(valid).groupBy(s.alias("s")).agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    path = scratch_path(spark, "auc-ranges")
    cells.repartitionByRange(F.col("s")).withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema("s double, pos long, neg long, part int").parquet(path)
    below = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)           # one row per range
    parts = ranged.groupBy("part").agg(F.sum("neg").alias("part_neg")) \
        .select("part", F.coalesce(F.sum("part_neg").over(below), F.lit(0)).alias("neg_before"))
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranged.withColumn("neg_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(F.broadcast(parts), "part")
    wide = "decimal(19,0)"
    twice = (F.col("neg_before") + F.col("neg_inside")) * 2 + F.col("neg")
    totals = ranks.agg(F.sum(F.col("pos").cast(wide) * twice.cast(wide)).alias("num2"), F.sum("pos").alias("pos"),
                       F.sum("neg").alias("neg"))
    den = F.lit(2.0) * F.col("pos").cast("double") * F.col("neg").cast("double")
    return totals.select(F.when(den > 0, F.round(F.col("num2").cast("double") / den, digits)).alias("auc"),
                         F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))


def _auc_of_cells(cells: DataFrame, digits: int, report_skipped: bool) -> DataFrame:
    """AUC from (cell, pos, neg, skipped) counts."""
    wide = "decimal(19,0)"
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn("neg_below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    totals = ranked.agg(
        F.sum(F.col("pos").cast(wide) * (F.col("neg_below") * 2 + F.col("neg")).cast(wide)).alias("num2"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum("skipped").alias("skipped_rows"))
    den = F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")
    auc = F.when(den > 0, F.round(F.col("num2").cast("double") / den, digits)).alias("auc")
    return totals.select(auc, F.coalesce("skipped_rows", F.lit(0)).alias("skipped_rows")) if report_skipped \
        else totals.select(auc)
