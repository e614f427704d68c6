"""Gradient boosting that goes on round by round.

A round fits one regression tree to the residuals of the margin so far and is
judged on the validation rows; rounds are added to the last ensemble until the
loss has not fallen for some rounds, and the trees up to the best round are
kept.  So every tree is grown once, and the kept ones are those that a fit of
just so many rounds would grow.

A round reads rows that are held with their margin, and evaluates the trees
since then; the kept trees are scored together, as one ensemble.  No round
writes rows: margins are made again from the rows that were given.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows of a partition in a round: each sends the sums of all its nodes, so a round shuffles in line with the partitions
ROUND_ROWS = 1_000_000
#: rounds after which the margins that later ones are made from are renewed; a margin's lineage grows by one step each time
BASE_ROUNDS = 64


@dataclass
class Boosted:
    trees: list[DecisionTreeRegressionModel]      # those kept
    weights: list[float]
    losses: list[float]                           # validation loss of every round that ran

    def stages(self) -> list:
        """Transformers from the features to ``churn_prob``, the chance of label 1."""
        return [ensemble(self.trees, self.weights, "margin"),
                SQLTransformer(statement="SELECT *, 1.0D / (1.0D + exp(-2.0D * margin)) AS churn_prob FROM __THIS__")]


def ensemble(trees: list[DecisionTreeRegressionModel], weights: list[float], prediction: str) -> GBTRegressionModel:
    """The trees' weighted sum as one transformer: one expression that reads the features once, however many trees there are."""
    gateway = SparkSession.getActiveSession().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    members, shares = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        members[k], shares[k] = tree._java_obj, float(weight)
    # the Python class has no constructor for given trees; the Scala one has
    return GBTRegressionModel(ml.GBTRegressionModel(f"{prediction}_{trees[0].uid}", members, shares)).setPredictionCol(prediction)


def leaf_values(tree: DecisionTreeRegressionModel) -> list[float]:
    """The predictions of a tree's leaves from left to right, as their indices count them."""
    return [float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)]


def add_trees(rows: DataFrame, trees: list[DecisionTreeRegressionModel], weights: list[float]) -> DataFrame:
    """``rows`` with the trees' weighted values added to ``margin``, one after the other.

    An ensemble's own prediction is a dot product, which rounds otherwise; here
    it names each tree's leaf, and a fold adds the leaves' values.
    """
    # as text, which the optimizer turns into one literal
    values = F.from_json(F.lit(json.dumps([[weight * v for v in leaf_values(tree)] for tree, weight in zip(trees, weights)])), "array<array<double>>")
    found = ensemble(trees, weights, "__sum").setLeafCol("__leaves").transform(rows)
    own = F.zip_with(vector_to_array("__leaves"), values, lambda leaf, value: value[leaf.cast("int")])
    total = F.aggregate(own, F.col("margin"), lambda so_far, x: so_far + x)
    return found.select(*[total.alias(c) if c == "margin" else c for c in rows.columns])


def _residual(sign: Column, margin: Column) -> Column:
    """Minus the gradient of the loss 2 log(1 + exp(-2 y F))."""
    return 4.0 * sign / (1.0 + F.exp(2.0 * sign * margin))


def log_loss(sign: Column, margin: Column) -> Column:
    # of the two forms the one whose exponent is not positive
    z = 2.0 * sign * margin
    return F.avg(2.0 * F.when(z >= 0, F.log1p(F.exp(-z))).otherwise(F.log1p(F.exp(z)) - z))


def _free(*groups: list[DataFrame]) -> None:
    for df in [df for group in groups for df in group]:
        df.unpersist()


def boost(train: DataFrame, val: DataFrame, label: str, max_rounds: int, patience: int = 20, depth: int = 6, step: float = 0.05,
          bins: int = 64, seed: int = 42, cut_every: int = 8) -> Boosted:
    """Boost trees on ``train`` (columns ``features`` and ``label`` 0/1) until ``val`` has not improved for ``patience`` rounds.

    Margins are carried in a column; every ``cut_every`` rounds they are held
    anew (in memory, else on local disk), so a round evaluates that many trees
    at most: it reads its rows three times.  They are made from those of up to
    ``BASE_ROUNDS`` rounds before, which are held too.  What is lost is made
    again from ``train`` and ``val``, which should be cheap to read, such as
    checkpoints.  Without validation rows all ``max_rounds`` are kept.
    """
    sign = 2.0 * F.col(label).cast("double") - 1.0
    parts = max(train.sparkSession.sparkContext.defaultParallelism, math.ceil(train.count() / ROUND_ROWS))
    base = held = frames = [df.select("features", sign.alias("sign"), F.lit(0.0).alias("margin")).coalesce(parts).persist() for df in (train, val)]
    trees, weights, losses, best, since = [], [], [], 0, 0
    try:
        while len(trees) < max_rounds:
            m = len(trees)
            target = F.col("sign") if m == 0 else _residual(F.col("sign"), F.col("margin"))
            tree = DecisionTreeRegressor(featuresCol="features", labelCol="target", predictionCol=f"__t{m}", maxDepth=depth, maxBins=bins, seed=seed + m).fit(
                frames[0].withColumn("target", target))
            weight = 1.0 if m == 0 else step
            trees.append(tree)
            weights.append(weight)
            if (m + 1) % cut_every == 0:
                old, held = held, [add_trees(df, trees[since:], weights[since:]).persist() for df in base]
                frames = held
                if m + 1 - since >= BASE_ROUNDS:
                    for df in held:
                        df.count()                # the margins are there before those that they come from go
                    _free(base, old)
                    base, since = held, m + 1
                elif old is not base:
                    _free(old)
            else:
                frames = [tree.transform(df).select("features", "sign", (F.col("margin") + F.lit(weight) * F.col(f"__t{m}")).alias("margin")) for df in frames]
            loss = frames[1].agg(log_loss(F.col("sign"), F.col("margin"))).first()[0]
            losses.append(float("inf") if loss is None else loss)
            if loss is not None and loss < losses[best]:
                best = m
            if loss is not None and m - best >= patience:
                break
    finally:
        _free(base, held)
    kept = len(trees) if losses and losses[best] == float("inf") else best + 1
    return Boosted(trees[:kept], weights[:kept], losses)
