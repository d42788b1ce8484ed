"""Model evaluation with pyspark.ml: folds by hash, forward holdouts, recalibration, learners.

A fit scans its rows a hundred times. Rows that it can't tell apart are grouped to one with their number as weight first, which
gives the same model: a table whose columns have few values is scanned once, however long it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import ElementwiseProduct, PolynomialExpansion, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.scoring import pair_auc
from cairn.operators.windows import running_sum
from cairn.sources.scratch import cut_lineage

#: Up to so many distinct rows are scored once and broadcast to those they stand for; beyond that every row is scored by itself.
FEW = 100_000


class Deviations(Estimator):
    """Divides features by the deviations of all rows that the weights stand for; constant ones become 0.

    Spark's own weighted deviations, also those within its regression, take weights for reliabilities and not for numbers of rows.
    """

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.columns = {"inputCol": inputCol, "outputCol": outputCol}

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        w = F.col("weight")
        found = dataset.agg(Summarizer.metrics("std").summary(F.col(self.columns["inputCol"]), w).alias("s"), F.sum(w).alias("n"), F.sum(w * w).alias("squares")).first()
        of_rows = ((found.n - found.squares / found.n) / max(found.n - 1, 1)) ** 0.5
        return ElementwiseProduct(scalingVec=Vectors.dense([1 / (v * of_rows) if v > 0 else 0.0 for v in found.s.std]), **self.columns)


def learner(kind: str, columns: list[str], medians: dict[str, float], *, reg: float = 0.01, l1: float = 0.0, degree: int = 1, seed: int = 7) -> Pipeline:
    """M1, M6, M7: median imputation, optional polynomial terms, scaling, and a classifier of rows with a ``weight``.

    The net knows no weights. Trees are the same on any scale.
    """
    cells = {c: f"CAST(`{c}` AS double)" for c in columns} | {c: f"coalesce(nanvl(CAST(`{c}` AS double), NULL), CAST('{v!r}' AS double))" for c, v in medians.items()}
    filled = ", ".join(f"{cell} AS `{c}__f`" for c, cell in cells.items())
    stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"), VectorAssembler(inputCols=[f"{c}__f" for c in columns], outputCol="raw")]
    last = "raw"
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol="raw", outputCol="poly"))
        last = "poly"
    made = {
        "logistic": lambda: [Deviations(last, "features"), LogisticRegression(weightCol="weight", standardization=False, regParam=reg, elasticNetParam=l1, maxIter=50)],
        "boosted": lambda: [GBTClassifier(featuresCol=last, weightCol="weight", maxIter=20, maxDepth=3, seed=seed)],
        "mlp": lambda: [StandardScaler(withMean=True, withStd=True, inputCol=last, outputCol="features"), MultilayerPerceptronClassifier(layers=[len(columns), 8, 2], seed=seed, maxIter=50)],
    }[kind]()
    return Pipeline(stages=[*stages, *made])


def medians(rows: DataFrame, columns: list[str]) -> dict[str, float]:
    """M7: the middle of the values that each column has, counted by ``weight``; of two middle ones the mean, 0 without any."""
    if not columns:
        return {}
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("at"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for k, c in enumerate(columns))))
    counts = rows.select("weight", cells.alias("cell")).where("cell.value IS NOT NULL").groupBy("cell.at", "cell.value").agg(F.sum("weight").cast("long").alias("n"))
    placed = cut_lineage(running_sum(counts, [F.col("at"), F.col("value")], F.col("n")))
    sizes = placed.groupBy(F.col("at").alias("__at")).agg(F.min("__below").alias("first"), F.sum("n").alias("size"))
    # one row per column; two values at most are in the middle
    place = F.col("__below") - F.col("first")
    middle = placed.join(F.broadcast(sizes), F.col("at") == F.col("__at")).where((place * 2 <= F.col("size")) & ((place + F.col("n")) * 2 >= F.col("size")))
    found = {r.at: (r.low + r.high) / 2 for r in middle.groupBy("at").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    return {c: found.get(k, 0.0) for k, c in enumerate(columns)}


def grouped(rows: DataFrame, columns: list[str], part: str) -> DataFrame:
    """Rows with equal columns, label and part as one, with their number as ``weight``; where hardly any are equal, the rows as they are."""
    keys = [*columns, "label", part]
    n, distinct = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*keys))).first()
    if distinct * 2 > n:
        return rows.withColumn("weight", F.lit(1.0))
    return cut_lineage(rows.groupBy(*keys).agg(F.count("*").cast("double").alias("weight")))


def fitted(rows: DataFrame, each: DataFrame, columns: list[str], train: Column, kind: str = "logistic", **options) -> PipelineModel:
    """A learner fitted on the rows of ``train``, as they are grouped in ``each``; the net, which has no weights, reads them one by one."""
    gaps = each.select(*(F.max(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in columns)).first()
    made = learner(kind, columns, medians(each.where(train), [c for c in columns if gaps[c]]), **options)
    return made.fit((rows if kind == "mlp" else each).where(train))


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def predict_parts(rows: DataFrame, each: DataFrame, columns: list[str], part: str, models: dict[int, PipelineModel]) -> DataFrame:
    """``rows`` of the parts that have a model, with p; rows with equal columns have equal ones."""
    keys = [*columns, part]
    if each.count() > FEW:
        return reduce(DataFrame.unionByName, (predict(m, rows.where(F.col(part) == k)).select(*rows.columns, "p") for k, m in models.items()))
    said = reduce(DataFrame.unionByName, (predict(m, each.where(F.col(part) == k).select(*keys).distinct()).select(*(F.col(c).alias(f"__{c}") for c in keys), "p") for k, m in models.items()))
    return rows.join(F.broadcast(cut_lineage(said)), reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys))).select(*rows.columns, "p")


def fold_of(key: Column, folds: int, repeat: int = 0) -> Column:
    """M2: the fold of a row from a hash of its key; grouped folds hash the group (M5)."""
    return F.pmod(F.xxhash64(key, F.lit(repeat)), F.lit(folds))


def folded(df: DataFrame, label: str, key: Column, folds: int) -> DataFrame:
    """``df`` with label and fold, written once: what made it isn't done again for each fit."""
    return cut_lineage(df.withColumn("label", F.col(label).cast("double")).withColumn("fold", fold_of(key, folds)))


def out_of_fold(rows: DataFrame, columns: list[str], folds: int, **options) -> DataFrame:
    """M2: ``folded`` rows with p, each by the model fitted on the other folds."""
    each = grouped(rows, columns, "fold")
    return predict_parts(rows, each, columns, "fold", {k: fitted(rows, each, columns, F.col("fold") != k, **options) for k in range(folds)})


def cross_predict(df: DataFrame, columns: list[str], label: str, key: Column, *, folds: int = 5, kind: str = "logistic", **options) -> DataFrame:
    """M2, M5: out-of-fold predictions p."""
    return out_of_fold(folded(df, label, key, folds), columns, folds, kind=kind, **options).select(*df.columns, "fold", "p")


def forward_holdout(df: DataFrame, columns: list[str], label: str, year: str, cut: int, **options) -> DataFrame:
    """M5: fitted on years before the cut only, predicted for the rest."""
    rows = cut_lineage(df.withColumn("label", F.col(label).cast("double")).withColumn("__later", (F.col(year) >= cut).cast("int")))
    each = grouped(rows, columns, "__later")
    return predict_parts(rows, each, columns, "__later", {1: fitted(rows, each, columns, F.col("__later") == 0, **options)}).select(*df.columns, "p")


def logit(p: Column, clip: float = 1e-6) -> Column:
    """M4."""
    q = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), p))
    return F.ln(q / (1 - q))


def recalibrate(df: DataFrame, p: str, label: str, key: Column, folds: int = 5) -> DataFrame:
    """M4: a logistic fit on the logit, cross-fitted."""
    return cross_predict(df.withColumnRenamed(p, "p_raw").withColumn("z", logit(F.col("p_raw"))), ["z"], label, key, folds=folds, reg=0.0)


def stable_columns(df: DataFrame, columns: list[str], label: str, key: Column, folds: int = 5) -> list[str]:
    """M3: columns whose coefficient keeps its sign in every fold."""
    rows = folded(df, label, key, folds)
    each = grouped(rows, columns, "fold")
    found = [fitted(rows, each, columns, F.col("fold") != k).stages[-1].coefficients.toArray() for k in range(folds)]
    return [c for i, c in enumerate(columns) if len({f[i] > 0 for f in found}) == 1]


def auc(df: DataFrame, label: str) -> float:
    return pair_auc(df.withColumn("__y", F.col(label).cast("int")), "p", "__y").first()[0]
