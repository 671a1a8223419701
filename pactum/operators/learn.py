"""Training and evaluation on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.functions.metrics import confusion, ratio, recall_risky
from pactum.operators.features import assembler
from pactum.operators.pools import stratified_split
from pactum.plans.session import materialize, run_dir
from pactum.policy import FOREST_DEPTH, FOREST_SEED, FOREST_TREES, LOGISTIC_MAX_ITER, Policy


def logistic(params: Mapping[str, Any], n_rows: int) -> LogisticRegression:
    """L2 logistic regression on raw features, unit cost per row.

    Losses are averaged here, so a penalty of 1 on summed losses becomes 1/n; `penalty` 0 turns it off.
    """
    penalty = float(params.get("penalty", 1.0))
    return LogisticRegression(maxIter=int(params.get("max_iter", LOGISTIC_MAX_ITER)), elasticNetParam=0.0,
                              standardization=False, regParam=penalty / max(1, n_rows))


def forest(params: Mapping[str, Any], n_rows: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=int(params.get("n_estimators", FOREST_TREES)), maxDepth=int(params.get("max_depth", FOREST_DEPTH)),
        seed=int(params.get("random_state", FOREST_SEED)), featureSubsetStrategy="sqrt", impurity="gini",
        bootstrap=bool(params.get("bootstrap", True)))


FAMILIES: dict[str, Callable[[Mapping[str, Any], int], Any]] = {"logistic": logistic, "forest": forest}


def build_model(family: str, params: Mapping[str, Any] | None = None, n_rows: int = 1, weight_col: str | None = None):
    """Estimator of a registered family; an unknown name is an error."""
    if family not in FAMILIES:
        raise ValueError(f"no model family is called {family!r}; there are {sorted(FAMILIES)}")
    model = FAMILIES[family](params or {}, n_rows)
    return model.setWeightCol(weight_col) if weight_col else model


@dataclass(frozen=True)
class Candidate:
    family: str
    model: PipelineModel
    validation: DataFrame


def split_once(df: DataFrame, key: str | Sequence[str], features: Sequence[str], policy: Policy = Policy()) -> DataFrame:
    """The columns training needs, with `is_train`, written once for all families and passes.

    The features are written first, since the split reads them more than once. The
    result is a table too: the many small jobs of an iterative fit carry no lineage
    and survive lost executors. Rows are laid out by key, because forests draw
    their samples by row position: the same data then gives the same trees.
    """
    keys = [key] if isinstance(key, str) else list(key)
    slim = materialize(df.select(*keys, *features, "label"), "features")
    split = stratified_split(slim, keys, "label", policy.validation_share, policy.split_seed)
    return materialize(split.repartitionByRange(*keys).sortWithinPartitions(*keys), "split")


def train_candidate(split: DataFrame, family: str, features: Sequence[str], params: Mapping[str, Any] | None = None,
                    weight_col: str | None = None) -> Candidate:
    """Fit on the training part, score the held-out part. The model is not refitted on both."""
    train = split.filter("is_train")
    estimator = build_model(family, params, train.count(), weight_col)
    model = Pipeline(stages=[assembler(features), estimator]).fit(train)
    return Candidate(family, model, predict(model, split.filter("NOT is_train")))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `prediction` (hard class) and `score` (probability of class 1)."""
    out = model.transform(df)
    return (out.withColumn("score", vector_to_array("probability")[1])
            .withColumn("prediction", F.col("prediction").cast("int"))
            .drop("features", "rawPrediction", "probability"))


def forest_nodes(model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, left, right, n_rows, n_safe, n_risky): a fitted forest as a table, for audit.

    A row goes left at `feature` <= `threshold`; leaves have null there. Node 0 is a tree's root. `n_safe` and
    `n_risky` are the weighted training rows of both classes; the weights of a bootstrap sample are in them.
    """
    names, fitted = model.stages[0].getInputCols(), model.stages[-1]
    path = run_dir(SparkSession.active(), "forest-nodes")
    fitted.write().save(path)
    nodes = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return nodes.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.element_at(F.array(*map(F.lit, names)), F.when(inner, F.col("split.featureIndex") + 1))).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.col("rawCount").alias("n_rows"),
        *[F.coalesce(F.get("impurityStats", F.lit(k)), F.lit(0.0)).alias(n) for k, n in enumerate(("n_safe", "n_risky"))])


def walk_forest(nodes: DataFrame, df: DataFrame, keys: Sequence[str], depth: int = FOREST_DEPTH) -> DataFrame:
    """(keys, n_trees, score) of rows with unique `keys`, by the node table alone: the mean risky share of the leaves met.

    Meant for audits: a row walks every tree, one join with the nodes for each level. `depth` is at least the forest's.
    Nodes are bounded by trees and depth, whatever the data. A null feature goes right.
    """
    names = [r[0] for r in nodes.select("feature").filter("feature IS NOT NULL").distinct().orderBy("feature").collect()]
    values = F.create_map(*[part for n in names for part in (F.lit(n), F.col(n).cast("double"))]) if names else F.lit(None).cast("map<string,double>")
    down = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right", "n_safe", "n_risky"))
    trees = nodes.agg(F.max("tree")).first()[0] + 1
    goes_left = F.coalesce(F.try_element_at("_values", "feature") <= F.col("threshold"), F.lit(False))
    step = F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
    at = df.select(*keys, values.alias("_values"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    at = at.join(down, ["tree", "node"])
    for _ in range(depth):
        at = at.select(*keys, "_values", "tree", step.alias("node")).join(down, ["tree", "node"])
    return at.groupBy(*keys).agg(F.count("*").alias("n_trees"), F.avg(F.col("n_risky") / (F.col("n_safe") + F.col("n_risky"))).alias("score"))


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group, one pass."""
    cells = confusion(F.col("label"), F.col("prediction"))
    return predictions.groupBy(*by).agg(*[c.alias(n) for n, c in cells.items()])


def recall_by(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return confusion_counts(predictions, by).withColumn("recall", recall_risky())


def classification_report(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows `0`, `1`, `accuracy`, `macro avg`, `weighted avg` per group.

    Precision, recall and F1 are 0 when undefined. The accuracy row repeats
    accuracy in all three columns.
    """
    counts = confusion_counts(predictions, by)

    def scores(hit: str, over: str, missed: str) -> tuple:
        p = ratio(F.col(hit), F.col(hit) + F.col(over))
        r = ratio(F.col(hit), F.col(hit) + F.col(missed))
        f = ratio(2 * F.col(hit), 2 * F.col(hit) + F.col(over) + F.col(missed))
        return p, r, f

    safe, risky = scores("tn", "fn", "fp"), scores("tp", "fp", "fn")
    names = ("precision", "recall", "f1")
    wide = counts.select(
        *by, *[c.alias(f"{n}_0") for n, c in zip(names, safe, strict=True)],
        *[c.alias(f"{n}_1") for n, c in zip(names, risky, strict=True)],
        (F.col("tn") + F.col("fp")).alias("s0"), (F.col("tp") + F.col("fn")).alias("s1"),
        ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("acc"))
    total = F.col("s0") + F.col("s1")

    def line(name: str, pick, support) -> Column:
        return F.struct(F.lit(name).alias("class"), *[pick(n).alias(n) for n in names], support.alias("support"))

    def weighted(n: str):
        return ratio(F.col(f"{n}_0") * F.col("s0") + F.col(f"{n}_1") * F.col("s1"), total)

    return wide.select(*by, F.inline(F.array(
        line("0", lambda n: F.col(f"{n}_0"), F.col("s0")),
        line("1", lambda n: F.col(f"{n}_1"), F.col("s1")),
        line("accuracy", lambda n: F.col("acc"), total),
        line("macro avg", lambda n: (F.col(f"{n}_0") + F.col(f"{n}_1")) / 2, total),
        line("weighted avg", weighted, total))))
