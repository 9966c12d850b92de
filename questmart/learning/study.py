"""Cross-validated tree models on MLlib, their importances and metrics."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from statistics import fmean, pstdev

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.learning.features import CATEGORIES, NUMERIC
from questmart.operators.ordering import assign_dense_ids
from questmart.session import stage

SEED = 42
FOLDS = 5


@dataclass(frozen=True)
class Sizes:
    """Tree sizes of the three model families."""

    tree_depth: int = 5
    forest_trees: int = 100
    forest_depth: int = 8
    boost_rounds: int = 100
    boost_depth: int = 6
    boost_rate: float = 0.3


@dataclass(frozen=True)
class Target:
    approach: str
    column: str
    classes: int
    reported: str

    @property
    def is_classifier(self) -> bool:
        return self.classes > 0

    @property
    def metric(self) -> str:
        return "accuracy" if self.is_classifier else "r2"


TARGETS = {
    "binary": Target("Binary Classification", "target_binary", 2, "is_attempt_successful"),
    "ordinal": Target("Ordinal Classification", "target_ordinal", 4, "stars_gained"),
    "regression": Target("Raw Regression", "target_score", 0, "total_score"),
    "residual": Target("Residual Regression", "target_residual", 0, "total_score"),
}
FAMILIES = ["Decision Tree", "Random Forest", "Boosted Trees"]
METRICS_SCHEMA = "model STRING, target STRING, metric STRING, mean DOUBLE, std DOUBLE, n_splits INT, n_samples BIGINT"


def estimator(family: str, target: Target, sizes: Sizes):
    common = {"labelCol": target.column, "featuresCol": "features", "seed": SEED}
    if family == "Decision Tree":
        kind = DecisionTreeClassifier if target.is_classifier else DecisionTreeRegressor
        return kind(maxDepth=sizes.tree_depth, **common)
    if family == "Random Forest":
        kind = RandomForestClassifier if target.is_classifier else RandomForestRegressor
        return kind(numTrees=sizes.forest_trees, maxDepth=sizes.forest_depth, **common)
    boost = {"maxIter": sizes.boost_rounds, "maxDepth": sizes.boost_depth, "stepSize": sizes.boost_rate}
    if not target.is_classifier:
        return GBTRegressor(**boost, **common)
    if target.classes == 2:
        return GBTClassifier(**boost, **common)
    return OneVsRest(classifier=GBTClassifier(**boost, **common), labelCol=target.column, featuresCol="features")


@dataclass(frozen=True)
class Encoding:
    """Inputs of a model as one vector: the numbers, then a place per category of each column and one for unseen values.

    ``categories`` is a stored table (column, category, index), numbered in the order of the texts. It is joined to the rows,
    so a column may have any number of categories: only their number per column reaches the driver. NULL is unseen.
    """

    categories: DataFrame
    sizes: dict[str, int]
    numeric: list[str]

    @staticmethod
    def fit(rows: DataFrame, numeric: list[str]) -> "Encoding":
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in CATEGORIES]
        found = rows.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("category").isNotNull()).distinct()
        numbered = assign_dense_ids(found, ["column", "category"], "number", "categories")
        # One row per column.
        firsts = numbered.groupBy("column").agg(F.min("number").alias("first"))
        table = stage(
            numbered.join(F.broadcast(firsts), "column").select("column", "category", (F.col("number") - F.col("first")).alias("index")),
            "category-table",
        )
        counts = {row["column"]: row["count"] for row in table.groupBy("column").count().collect()}
        return Encoding(table, {c: counts.get(c, 0) for c in CATEGORIES}, numeric)

    def indexed(self, rows: DataFrame, prefix: str = "") -> DataFrame:
        """Adds ``<prefix><column>_index`` for the columns ``<prefix><column>``."""
        for column, size in self.sizes.items():
            own = self.categories.where(F.col("column") == column).select(F.col("category").alias("_category"), F.col("index").alias("_index"))
            met = rows.join(own, F.col(prefix + column) == F.col("_category"), "left")
            index = F.coalesce("_index", F.lit(size)).cast("double")
            rows = met.withColumn(f"{prefix}{column}_index", index).drop("_category", "_index")
        return rows

    def assembled(self, rows: DataFrame) -> DataFrame:
        """Adds ``features`` to rows that have their indexes."""
        indexes, vectors = [f"{c}_index" for c in CATEGORIES], [f"{c}_vector" for c in CATEGORIES]
        # The encoder learns the width of each vector from the largest index, which is that of unseen values.
        widest = rows.sparkSession.createDataFrame([tuple(float(self.sizes[c]) for c in CATEGORIES)], indexes)
        one_hot = OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=False).fit(widest)
        assembler = VectorAssembler(inputCols=[*self.numeric, *vectors], outputCol="features")
        return assembler.transform(one_hot.transform(rows)).drop(*vectors)

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.assembled(self.indexed(rows))

    def names(self) -> DataFrame:
        """(place, feature): the name of every place of the vector."""
        start, offset, known = len(self.numeric), F.lit(None), list(enumerate(self.numeric))
        for column, size in self.sizes.items():
            offset = F.when(F.col("column") == column, F.lit(start)).otherwise(offset)
            known.append((start + size, f"{column}_unseen"))
            start += size + 1
        listed = self.categories.select((offset + F.col("index")).cast("bigint").alias("place"), F.concat_ws("_", "column", "category").alias("feature"))
        return listed.unionByName(self.categories.sparkSession.createDataFrame(known, "place BIGINT, feature STRING"))


def importances(model: Model) -> dict[int, float]:
    """Importance by place of the vector; only places that a node of the model splits by."""
    if hasattr(model, "featureImportances"):
        found = model.featureImportances
        return {int(place): float(value) for place, value in zip(found.indices, found.values)}
    return averaged([importances(m) for m in model.models])


def averaged(parts: list[dict[int, float]]) -> dict[int, float]:
    return {place: sum(part.get(place, 0.0) for part in parts) / len(parts) for place in set().union(*parts)}


def score(predicted: DataFrame, target: Target) -> float:
    """Accuracy or R², as one aggregate."""
    y, p = F.col(target.column).cast("double"), F.col("prediction")
    if target.is_classifier:
        value = F.avg((y == p).cast("double"))
    else:
        value = 1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))
    found = predicted.agg(value.alias("value")).first()["value"]
    return float("nan") if found is None else float(found)


def with_folds(table: DataFrame) -> DataFrame:
    """A stored copy with a fold per row. Folds follow a hash of the row, so any partitioning gives the same ones."""
    key = F.xxhash64(F.lit(SEED), *[F.col(c) for c in table.columns])
    return stage(table.withColumn("fold", F.pmod(key, F.lit(FOLDS)).cast("int")), "folds")


@dataclass(frozen=True)
class Run:
    name: str
    target: Target
    scores: list[float]
    importances: dict[str, float]
    n_samples: int
    encoding: Encoding

    @property
    def mean(self) -> float:
        return fmean(self.scores)

    @property
    def std(self) -> float:
        return pstdev(self.scores)

    @property
    def ranked(self) -> list[tuple[str, float]]:
        return sorted(self.importances.items(), key=lambda item: (-item[1], item[0]))


def cross_validate(folded: DataFrame, family: str, target: Target, sizes: Sizes = Sizes()) -> Run:
    """One model per fold; the encoding is fitted once on all rows, as the category set is not learned from targets."""
    numeric = [c for c in NUMERIC if target.column != "target_residual" or c != "success_score_floor"]
    known = folded.where(F.col(target.column).isNotNull())
    encoding = Encoding.fit(known, numeric)
    rows = encoding.transform(known).select("features", target.column, "fold").persist()
    try:
        scores, gains = [], []
        for fold in range(FOLDS):
            test = rows.where(F.col("fold") == fold)
            model = estimator(family, target, sizes).fit(rows.where(F.col("fold") != fold))
            scores.append(score(model.transform(test), target))
            gains.append(importances(model))
        total = rows.count()
    finally:
        rows.unpersist()
    mean = averaged(gains)
    # No more names than the models have nodes.
    used = {row.place: row.feature for row in encoding.names().where(F.col("place").isin(list(mean))).collect()}
    gained = dict.fromkeys(numeric, 0.0) | {used[place]: value for place, value in mean.items()}
    return Run(f"{family} - {target.approach}", target, scores, gained, total, encoding)


def run_suite(table: DataFrame, families: list[str] = FAMILIES, targets: dict[str, Target] = TARGETS, sizes: Sizes = Sizes()) -> list[Run]:
    """All families on all targets. ``table`` holds every target column, see features.with_residual."""
    folded = with_folds(table)
    return [cross_validate(folded, family, target, sizes) for family in families for target in targets.values()]


def metrics_table(spark: SparkSession, runs: list[Run]) -> DataFrame:
    rows = [(r.name, r.target.reported, r.target.metric, r.mean, r.std, len(r.scores), r.n_samples) for r in runs]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def importance_table(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """Every place of every model's vector; zero where no node splits by it."""
    tables = []
    for run in runs:
        gained = spark.createDataFrame(run.ranked, "feature STRING, gained DOUBLE")
        tables.append(
            run.encoding.names().join(gained, "feature", "left").select(
                F.lit(run.name).alias("model"), F.lit(run.target.reported).alias("target"), "feature", F.coalesce("gained", F.lit(0.0)).alias("importance")
            )
        )
    return reduce(DataFrame.unionByName, tables).orderBy("model", "target", F.desc("importance"), "feature")


def summary_row(run: Run) -> dict[str, object]:
    """Metric and top three features of one model."""
    row: dict[str, object] = {
        "metric": run.target.metric, "mean": run.mean, "std": run.std, "n_splits": len(run.scores), "n_samples": run.n_samples
    }
    for place, (feature, value) in enumerate(run.ranked[:3], start=1):
        row[f"top{place}"], row[f"top{place}_imp"] = feature, value
    return row


def summary_text(run: Run, k: int = 3) -> str:
    """One line for the score and one for the k strongest features, each with its share of the k."""
    top = run.ranked[:k]
    whole = sum(value for _, value in top) or 1.0
    metric = "accuracy" if run.target.is_classifier else "R2"
    strongest = ", ".join(f"{name} {value:.4f} ({value / whole:.1%})" for name, value in top)
    return f"{run.name} on {run.target.reported}: {metric} {run.mean:.4f}, deviation {run.std:.4f} over {len(run.scores)} folds\nstrongest: {strongest}\n"


@dataclass(frozen=True)
class Fitted:
    """A model with the encoding of its inputs."""

    model: Model
    encoding: Encoding

    @property
    def inputs(self) -> list[str]:
        return [*self.encoding.numeric, *CATEGORIES]

    def predict(self, rows: DataFrame, name: str) -> DataFrame:
        return self.predict_indexed(self.encoding.indexed(rows), name).select(*rows.columns, name)

    def predict_indexed(self, rows: DataFrame, name: str) -> DataFrame:
        scored = self.model.transform(self.encoding.assembled(rows)).withColumnRenamed("prediction", name)
        return scored.select(*rows.columns, name)


def fit_outside_fold(folded: DataFrame, family: str, target: Target, sizes: Sizes = Sizes(), fold: int = 0) -> Fitted:
    numeric = [c for c in NUMERIC if target.column != "target_residual" or c != "success_score_floor"]
    known = folded.where(F.col(target.column).isNotNull())
    encoding = Encoding.fit(known, numeric)
    model = estimator(family, target, sizes).fit(encoding.transform(known.where(F.col("fold") != fold)))
    return Fitted(model, encoding)


def row_order(columns: list[str], seed: int) -> Column:
    """A pseudo-random order of rows that every engine with MD5 shares; rows alike in all columns are alike in it."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *values).cast("binary"))


def with_donors(rows: DataFrame, columns: list[str], seed: int = SEED) -> DataFrame:
    """``columns`` and, as ``donor_<column>``, those of another row: a permutation of the whole table, whatever its
    partitions and batches.

    Rows are numbered in two hash orders; the n-th row of one order takes the n-th of the other. Numbering goes over range
    partitions, so no task sees the whole table. Rows that are alike are interchangeable in both orders.
    """
    numbered = []
    for place, prefix in enumerate(["", "donor_"]):
        own = rows.select(*[F.col(c).alias(prefix + c) for c in columns])
        names = [prefix + c for c in columns]
        ordered = own.withColumn("_order", row_order(names, seed + place))
        numbered.append(assign_dense_ids(ordered, ["_order", *names], f"_{place}", "donors").drop("_order"))
    left, right = numbered
    return left.join(right.hint("merge"), F.col("_0") == F.col("_1")).drop("_0", "_1")


def permutation_attribution(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """(feature, mean_abs_change): mean absolute change of the prediction when one input takes its donor's value.

    All given rows are read, none sampled. Stands in for additive attributions, which MLlib does not offer; the numbers are
    not comparable with those. Changes are added as decimals, so partitions do not show in the last digits.
    """
    inputs = fitted.inputs
    # Rows and donors meet the category table once; swapping then exchanges indexes.
    both = fitted.encoding.indexed(fitted.encoding.indexed(with_donors(rows, inputs)), "donor_")
    scored = fitted.predict_indexed(stage(both, "donors"), "was")
    for column in inputs:
        kept, fed = scored.columns, f"{column}_index" if column in CATEGORIES else column
        swapped = scored.withColumnRenamed(fed, "_held").withColumn(fed, F.col(f"donor_{fed}"))
        moved = fitted.predict_indexed(swapped, f"becomes_{column}")
        scored = moved.drop(fed).withColumnRenamed("_held", fed).select(*kept, f"becomes_{column}")
    change = {c: F.abs(F.col("was") - F.col(f"becomes_{c}")).cast("decimal(28,12)") for c in inputs}
    means = scored.agg(*[F.avg(column).cast("double").alias(c) for c, column in change.items()])
    return means.unpivot([], inputs, "feature", "mean_abs_change")
