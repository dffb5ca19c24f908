"""A saved forest as a table of nodes, and scores that come from that table alone."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored


def _chance(tests: Column, test: Column, step: Column, roots: Column, chance: Column, x: Column, depth: int) -> Column:
    """Mean over all trees of the leaf's chance that features ``x`` lead to."""
    def holds(t: Column) -> Column:
        value = F.get(x, t["feature"])
        below = F.when(t["categories"] < 0, value <= F.get(t["cuts"], F.lit(0))).otherwise(F.array_contains(t["cuts"], value))
        return F.when(below, 1).otherwise(0)

    def votes(outcome: Column, test: Column, step: Column) -> Column:
        down = lambda at, _: at + F.get(step, at * 2 + F.get(outcome, F.get(test, at)))
        steps = F.sequence(F.lit(1), F.lit(depth))
        return F.transform(roots, lambda root: F.get(chance, F.aggregate(steps, root, down)))

    # A lambda's variable is computed once; a column named inside a lambda could be computed anew at each step.
    once = lambda value, use: F.transform(F.array(value), use)[0]
    each = once(F.transform(tests, holds), lambda outcome: once(test, lambda t: once(step, lambda s: votes(outcome, t, s))))
    return F.aggregate(each, F.lit(0.0), lambda total, v: total + v) / F.size(roots)


def _flat(nodes: DataFrame) -> DataFrame:
    """The forest as one row of plain arrays, in which a node is a place and a step down is a distance.

    ``_tests`` are the different splits, ``_test`` each node's place among them, ``_step`` each node's
    distances to its right and left child (0 in leaves), ``_chance`` each node's share of label 1.
    """
    split = F.struct("feature", "categories", "cuts")
    inner = F.col("left") >= 0
    tests = nodes.agg(F.sort_array(F.collect_set(F.when(inner, split))).alias("_tests"))
    stats = F.col("stats")
    placed = nodes.crossJoin(F.broadcast(tests)).select(
        "tree", "node", F.when(inner, F.array_position("_tests", split) - 1).otherwise(0).cast("int").alias("test"),
        F.when(inner, F.col("right") - F.col("node")).otherwise(0).alias("right"),
        F.when(inner, F.col("left") - F.col("node")).otherwise(0).alias("left"),
        (stats[1] / (stats[0] + stats[1])).alias("chance"))
    every = placed.agg(F.sort_array(F.collect_list(F.struct(*placed.columns))).alias("n"))
    places = F.transform("n", lambda n, i: F.when(n["node"] == 0, i))
    return every.select(
        F.transform("n", lambda n: n["test"]).alias("_test"),
        F.flatten(F.transform("n", lambda n: F.array(n["right"], n["left"]))).alias("_step"),
        F.transform("n", lambda n: n["chance"]).alias("_chance"),
        F.filter(places, lambda i: i.isNotNull()).alias("_roots")).crossJoin(F.broadcast(tests))


def forest_probability(featured: DataFrame, nodes: DataFrame, depth: int = 5, features: str = "features") -> DataFrame:
    """``featured`` with ``probability``, the chance of label 1 as the forest gives it.

    ``nodes`` is what ``sources.models.read_forest`` returns. It goes to all tasks as
    one row: a forest has at most trees x (2^(depth + 1) - 1) nodes, however many rows
    it was fitted on. Each customer's row meets every different split once and then
    walks all trees where it lies, so nothing is shuffled and no row is multiplied by
    the number of trees. ``depth`` must be at least that of the forest.
    """
    forest = stored(_flat(nodes))  # made once, not with each use of the scores
    walked = featured.withColumn("_x", vector_to_array(features)).crossJoin(F.broadcast(forest))
    share = _chance(*map(F.col, ("_tests", "_test", "_step", "_roots", "_chance", "_x")), depth)
    return walked.withColumn("probability", share).drop("_x", *forest.columns)
