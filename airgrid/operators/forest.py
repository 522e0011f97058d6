"""Cluster-sampled regression forests per year on MLlib (K1-K5, K8, K9).

A forest of a year is several groups of trees. Each group sees only half of the clusters, chosen by
a hash of (cluster, group, seed), so the same rows can be told in-bag from out-of-bag later without
storing anything. Splits, bagging and scoring are MLlib's; every fit is a distributed job.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .quantiles import exact_quantiles

# Stand-in for a missing feature value; far outside every real measure.
FAR = 1e30


def kept_by_group(cluster: Column, group: int, seed: int) -> Column:
    """K1: does a group of trees see this cluster? About half of the clusters do."""
    return F.pmod(F.xxhash64(cluster, F.lit(group), F.lit(seed)), F.lit(2)) == 0


def with_features(df: DataFrame, features: list[str], out: str = "_features") -> DataFrame:
    """K5: every feature twice, missing as far low and as far high, so a split can send missing
    values to either side. NaN counts as missing."""
    made = {}
    for i, name in enumerate(features):
        value = F.col(name).cast("double")
        value = F.when(~F.isnan(value), value)
        made[f"_f{i}_low"] = F.coalesce(value, F.lit(-FAR))
        made[f"_f{i}_high"] = F.coalesce(value, F.lit(FAR))
    assembler = VectorAssembler(inputCols=list(made), outputCol=out)
    return assembler.transform(df.withColumns(made)).drop(*made)


@dataclass
class YearForests:
    """Fitted groups per year, with what is needed to score and to tell out-of-bag rows."""

    features: list[str]
    cluster: str
    seed: int
    by: str
    models: dict[int, list[RandomForestRegressionModel]] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Models by year and group, with the description they must be used with."""
        for year, groups in self.models.items():
            for g, model in enumerate(groups):
                model.write().overwrite().save(f"{path}/year={year}/group={g}")
        told = {
            "features": self.features,
            "cluster": self.cluster,
            "seed": self.seed,
            "by": self.by,
            "groups": {str(year): len(groups) for year, groups in self.models.items()},
        }
        spark = SparkSession.active()
        row = spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1)
        row.write.mode("overwrite").text(f"{path}/description")

    @classmethod
    def load(cls, path: str, years: list[int] | None = None) -> YearForests:
        """What :meth:`save` wrote, or only some years of it. Features, cluster and seed come from
        the saved description, so out-of-bag flags are those of the fit."""
        told = json.loads(SparkSession.active().read.text(f"{path}/description").first()[0])
        groups = {int(year): n for year, n in told["groups"].items()}
        models = {
            y: [
                RandomForestRegressionModel.load(f"{path}/year={y}/group={g}")
                for g in range(groups[y])
            ]
            for y in (sorted(groups) if years is None else years)
        }
        return cls(told["features"], told["cluster"], told["seed"], told["by"], models)

    def score_year(self, df: DataFrame, year: int, oob: bool = False) -> DataFrame:
        """K2-K4: predictions of one year's rows; narrow, no shuffle.

        Adds ``pred`` and ``se`` (all groups) and, with ``oob``, ``pred_oob`` and ``se_oob`` (only
        the groups that did not see the row's cluster; NULL if every group saw it).
        """
        scored = with_features(df, self.features)
        groups = self.models[year]
        for g, model in enumerate(groups):
            scored = (
                model.setFeaturesCol("_features").setPredictionCol(f"_p{g}").transform(scored)
            )
        every = [F.col(f"_p{g}") for g in range(len(groups))]
        scored = scored.withColumns({"pred": _mean(every), "se": _spread(every)})
        if oob:
            unseen = [
                F.when(~kept_by_group(F.col(self.cluster), g, self.seed), F.col(f"_p{g}"))
                for g in range(len(groups))
            ]
            scored = scored.withColumns({"pred_oob": _mean(unseen), "se_oob": _spread(unseen)})
        return scored.drop("_features", *[f"_p{g}" for g in range(len(groups))])

    def score(self, df: DataFrame, oob: bool = False) -> DataFrame:
        """Every row of a table with its year's model; rows of years without one get NULLs."""
        parts = [
            self.score_year(df.where(F.col(self.by) == y), y, oob) for y in sorted(self.models)
        ]
        other = ~F.coalesce(F.col(self.by).isin(list(self.models)), F.lit(False))
        parts.append(df.where(other))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def missing_years(self, df: DataFrame) -> list[int]:
        """Years of the table that have no model. Starts a job."""
        years = df.select(self.by).distinct().where(F.col(self.by).isNotNull()).collect()
        return sorted(r[0] for r in years if r[0] not in self.models)


def _mean(values: list[Column]) -> Column:
    present = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.try_divide(total, present)


def _spread(values: list[Column]) -> Column:
    """K3: standard error from the variance between group means; needs two groups."""
    mean = _mean(values)
    squares = [(v - mean) * (v - mean) for v in values]
    variance = _mean(squares)
    two = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0)) >= 2
    return F.when(two, F.sqrt(F.greatest(variance, F.lit(0.0))))


def tree_estimates(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """K2/K3 from a table of single trees' predictions: ``pred``, ``se`` and their two variances.

    ``between`` is the variance of the groups' means, ``noise`` the part of it that trees within
    groups account for; ``se`` is the root of the difference, floored at 0, NULL for one group.
    Two aggregations that combine before their shuffles.
    """
    per_group = df.where(F.col(value).isNotNull()).groupBy(*by, group).agg(
        F.avg(value).alias("_m"), F.var_pop(value).alias("_w"), F.count(value).alias("_k")
    )
    noise = F.avg(F.col("_w") / F.greatest(F.col("_k") - 1, F.lit(1)))
    out = per_group.groupBy(*by).agg(
        F.avg("_m").alias("pred"),
        F.var_pop("_m").alias("between"),
        noise.alias("noise"),
        F.count(F.lit(1)).alias("_g"),
    )
    spread = F.sqrt(F.greatest(F.col("between") - F.col("noise"), F.lit(0.0)))
    return out.select(*by, "pred", F.when(F.col("_g") >= 2, spread).alias("se"), "between", "noise")


def cluster_forest(
    df: DataFrame,
    features: list[str],
    label: str,
    cluster: str,
    by: str = "year",
    years: list[int] | None = None,
    groups: int = 8,
    trees: int = 25,
    depth: int = 12,
    bins: int = 64,
    seed: int = 224,
    parallelism: int = 4,
) -> YearForests:
    """K1: fit one forest per year. Rows without a label are not used for fitting.

    All features are tried at every split and single-row leaves are allowed. Starts
    ``years x groups`` MLlib jobs, a few at a time. The rows are written once with a folder per year
    and a fit reads its own year only, so all fits together read each row ``groups`` times as often
    as one fit does, however many years there are.
    """
    kept = df.where(F.col(label).isNotNull()).select(
        *dict.fromkeys([*features, label, cluster, by])
    )
    rows = with_features(cut_lineage(kept, by), features).select(
        "_features", F.col(label).cast("double").alias("_label"), cluster, by
    )
    if years is None:
        years = sorted(r[0] for r in rows.select(by).distinct().collect())

    def fit(task: tuple[int, int]) -> RandomForestRegressionModel:
        year, group = task
        learner = RandomForestRegressor(
            featuresCol="_features",
            labelCol="_label",
            featureSubsetStrategy="all",
            minInstancesPerNode=1,
            numTrees=trees,
            maxDepth=depth,
            maxBins=bins,
            subsamplingRate=0.5 if trees > 1 else 1.0,
            seed=seed + group,
        )
        seen = rows.where((F.col(by) == year) & kept_by_group(F.col(cluster), group, seed))
        return learner.fit(seen)

    tasks = [(y, g) for y in years for g in range(groups)]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        fitted = pool.map(fit, tasks, chunksize=1)
    forests = YearForests(features, cluster, seed, by)
    for (year, _), model in zip(tasks, fitted):
        forests.models.setdefault(year, []).append(model)
    return forests


def impurity_importance(forests: YearForests, year: int, spark: SparkSession) -> DataFrame:
    """K8/T5: MLlib's impurity importance, both copies of a feature added up, largest first."""
    groups = forests.models[year]
    totals = dict.fromkeys(forests.features, 0.0)
    for model in groups:
        weights = model.featureImportances.toArray()
        for i, name in enumerate(forests.features):
            totals[name] += float(weights[2 * i] + weights[2 * i + 1]) / len(groups)
    rows = [(name, value) for name, value in totals.items()]
    return spark.createDataFrame(rows, "variable string, var_imp double").orderBy(
        F.desc("var_imp"), "variable"
    )


def split_importance(
    nodes: DataFrame, features: list[str], max_depth: int = 4, decay: float = 2.0
) -> DataFrame:
    """K8: how often a feature is split on, counted per depth and weighted by ``depth**-decay``.

    ``nodes`` is a table of tree nodes ``(tree, node, left, right, feature)`` with ``feature`` the
    index into the doubled feature vector, -1 for leaves; the root of every tree is node 0.
    """
    level = nodes.where("node = 0")
    counted = []
    for depth in range(1, max_depth + 1):
        splits = level.where("feature >= 0")
        counted.append(
            splits.groupBy(F.floor(F.col("feature") / 2).cast("int").alias("i"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("depth", F.lit(depth))
        )
        below = splits.select("tree", F.explode(F.array("left", "right")).alias("node"))
        level = nodes.join(below, ["tree", "node"], "left_semi")
    counts = reduce(lambda a, b: a.unionByName(b), counted)
    totals = counts.groupBy("depth").agg(F.sum("n").alias("total"))
    weight_sum = sum(d**-decay for d in range(1, max_depth + 1))
    share = F.col("n") / F.col("total") * F.pow(F.col("depth"), F.lit(-decay)) / weight_sum
    scores = counts.join(totals, "depth").groupBy("i").agg(F.sum(share).alias("score"))
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(features))
    listed = nodes.sparkSession.sql(f"SELECT * FROM VALUES {names} AS t(i, variable)")
    return listed.join(scores, "i", "left").select(
        "variable", F.coalesce("score", F.lit(0.0)).alias("var_imp")
    )


def saved_nodes(spark: SparkSession, path: str, year: int, groups: int) -> DataFrame:
    """Node table of a saved year of forests, in the shape :func:`split_importance` wants."""
    parts = []
    for g in range(groups):
        data = spark.read.parquet(f"{path}/year={year}/group={g}/data")
        n = F.col("nodeData")
        parts.append(
            data.select(
                F.concat_ws("/", F.lit(g), "treeID").alias("tree"),
                n["id"].alias("node"),
                n["leftChild"].alias("left"),
                n["rightChild"].alias("right"),
                n["split"]["featureIndex"].alias("feature"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def oob_median_error(
    forests: YearForests, df: DataFrame, label: str, by: list[str] | None = None
) -> DataFrame:
    """Median absolute out-of-bag error (and rows with one) per group of rows."""
    scored = forests.score(df, oob=True).withColumn("_ae", F.abs(F.col(label) - F.col("pred_oob")))
    return exact_quantiles(scored, by or [], ["_ae"], [0.5]).select(
        *(by or []), "n", F.col("q0").alias("mae")
    )


def backward_elimination(
    df: DataFrame,
    features: list[str],
    label: str,
    cluster: str,
    year: int,
    sizes: list[int],
    by: str = "year",
    **settings,
) -> DataFrame:
    """K9: refit on ever fewer features, dropping the least important; one row per step.

    The loop is over the short list ``sizes``; each step is a full fit on the year's rows.
    """
    spark = df.sparkSession
    rows = df.where(F.col(by) == year)
    current, steps = list(features), []
    for size in [len(features), *[s for s in sizes if s < len(features)]]:
        current = current[:size]
        forests = cluster_forest(rows, current, label, cluster, by, [year], **settings)
        mae = oob_median_error(forests, rows, label).select("mae").head()
        ranked = [r["variable"] for r in impurity_importance(forests, year, spark).collect()]
        steps.append((len(current), None if mae is None else mae["mae"], ",".join(current)))
        current = ranked
    return spark.createDataFrame(steps, "n_var int, mae double, variables string")
