"""Saved tree ensembles as data: a node table, and the ensemble as Column expressions.

A saved pipeline (assembler, scaler, forest or boosting) is read from its own Parquet files;
no Spark ML model is loaded.  The nodes - a handful per tree - become one SQL expression per
tree over the scaled features, so scoring is a projection like any other: it is fused into the
scan's stage, and the same nodes can be queried as a table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.errors import CatalogMismatch, ModelUnavailable
from riskloom.sources.registry import current_version

FOREST, BOOSTING = "RandomForestClassificationModel", "GBTClassificationModel"
#: Nodes up to which an ensemble is compiled; what the driver holds of it and the plan's size follow from them.
MOST_NODES = 100_000


@dataclass
class SavedTrees:
    """What a saved pipeline says: features, their means and deviations, the kind of ensemble, and its node table."""

    names: list[str]
    mean: list[float]
    std: list[float]
    kind: str
    nodes: DataFrame  # tree, node, feature, threshold, categories, left, right, value, share, weight


def _metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def read_trees(spark: SparkSession, path: str) -> SavedTrees:
    """The saved pipeline below ``path`` (or its current version) as data; ``ModelUnavailable`` if there is none."""
    path = current_version(spark, path)
    try:
        uids = _metadata(spark, path)["paramMap"]["stageUids"]
        width = len(str(len(uids)))
        stages = [f"{path}/stages/{i:0{width}d}_{uid}" for i, uid in enumerate(uids)]
        about = [_metadata(spark, s) for s in stages]
    except (AnalysisException, KeyError, TypeError, ValueError) as exc:
        raise ModelUnavailable(f"no readable pipeline at {path!r}: {exc}") from exc
    kinds = [a["class"].rpartition(".")[2] for a in about]
    if len(kinds) != 3 or kinds[:2] != ["VectorAssembler", "StandardScalerModel"] or kinds[2] not in (FOREST, BOOSTING):
        raise CatalogMismatch(f"the pipeline at {path!r} is no scaled tree ensemble: {kinds}")
    scale = spark.read.parquet(f"{stages[1]}/data").first()
    node = F.col("nodeData")
    total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{stages[2]}/data").select(
        F.col("treeID").cast("int").alias("tree"), node["id"].alias("node"),
        F.when(node["leftChild"] >= 0, node["split"]["featureIndex"]).alias("feature"),
        F.when((node["leftChild"] >= 0) & (node["split"]["numCategories"] < 0),
               node["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when((node["leftChild"] >= 0) & (node["split"]["numCategories"] >= 0),
               node["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(node["leftChild"] >= 0, node["leftChild"]).alias("left"),
        F.when(node["leftChild"] >= 0, node["rightChild"]).alias("right"),
        node["prediction"].alias("value"),  # what a leaf adds in boosting
        F.when(total > 0, node["impurityStats"][1] / total).alias("share"))  # positives in a leaf's training rows
    metadata = spark.read.parquet(f"{stages[2]}/treesMetadata")  # tree, metadata, weight, under names that differ by version
    weights = metadata.select(F.col(metadata.columns[0]).cast("int").alias("tree"), F.col(metadata.columns[2]).alias("weight"))
    return SavedTrees(list(about[0]["paramMap"]["inputCols"]), scale["mean"].toArray().tolist(), scale["std"].toArray().tolist(),
                      kinds[2], nodes.join(F.broadcast(weights), "tree"))  # one row per tree


def _number(x: float) -> str:
    return f"double('{x!r}')"


def _compiled(nodes: dict[int, dict], at: int, inputs: Sequence[str], leaf: str) -> str:
    """SQL of the subtree below a node."""
    n = nodes[at]
    if n["left"] is None:
        return "double(null)" if n[leaf] is None else _number(n[leaf])
    x = inputs[n["feature"]]
    if n["categories"] is None:
        goes_left = f"{x} <= {_number(n['threshold'])}"
    else:
        goes_left = f"{x} in ({', '.join(map(_number, n['categories'])) or 'null'})"
    return (f"case when {goes_left} then {_compiled(nodes, n['left'], inputs, leaf)} "
            f"else {_compiled(nodes, n['right'], inputs, leaf)} end")


def tree_columns(trees: SavedTrees, inputs: Sequence[str]) -> list[tuple[Column, float]]:
    """One (expression, weight) per tree over the named columns of scaled features.

    A forest's expression is the leaf's share of positives (null for a leaf without training
    rows, which has no vote); a boosted tree's is what the leaf adds to the margin.
    """
    rows = trees.nodes.limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise CatalogMismatch(f"the ensemble has over {MOST_NODES} nodes")
    by_tree: dict[int, dict[int, dict]] = {}
    weights = {}
    for r in rows:
        by_tree.setdefault(r["tree"], {})[r["node"]] = r.asDict()
        weights[r["tree"]] = r["weight"]
    leaf = "share" if trees.kind == FOREST else "value"
    return [(F.expr(_compiled(by_tree[t], 0, inputs, leaf)), weights[t]) for t in sorted(by_tree)]


def score_trees(df: DataFrame, trees: SavedTrees, key_cols: Sequence[str], extra_cols: Sequence[str] = ()) -> DataFrame:
    """keys (+ extra columns), ``prediction`` int, ``probability`` of class 1, ``raw_score``.

    As ``score.score_table`` over the loaded pipeline, for rows whose features are all valid; a
    row with a null or NaN feature is left out, as the pipeline's assembler does.
    """
    missing = [c for c in trees.names if c not in df.columns]
    if missing:
        raise CatalogMismatch(f"missing columns: {', '.join(missing)}")
    inputs = [f"`scaled {i}`" for i in range(len(trees.names))]
    scaled = [((F.col(f"`{c}`").cast("double") - F.lit(m)) * F.lit(1 / s if s else 0.0)).alias(f"scaled {i}")
              for i, (c, m, s) in enumerate(zip(trees.names, trees.mean, trees.std))]
    valid = F.lit(True)
    for c in trees.names:
        valid &= F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    columns = tree_columns(trees, inputs)
    kept = [f"kept {i}" for i in range(len(key_cols) + len(extra_cols))]
    rows = df.filter(valid).select(*[F.col(c).alias(k) for c, k in zip([*key_cols, *extra_cols], kept)], *scaled)
    # a tree's value is a column of its own, so that generated code stays in small methods
    rows = rows.select(*kept, *[c.alias(f"tree {i}") for i, (c, _) in enumerate(columns)])
    votes = [F.col(f"`tree {i}`") for i in range(len(columns))]
    raw, against = F.lit(0.0), F.lit(0.0)
    if trees.kind == FOREST:
        for v in votes:
            raw, against = raw + F.coalesce(v, F.lit(0.0)), against + F.coalesce(1 - v, F.lit(0.0))
        probability = F.when(raw + against > 0, raw / (raw + against)).otherwise(0.0)
        prediction = raw > against
    else:
        for v, (_, weight) in zip(votes, columns):
            raw = raw + v * F.lit(weight)
        probability, prediction = 1 / (1 + F.exp(-2 * raw)), raw > 0
    return rows.select(*[F.col(f"`{k}`").alias(c) for k, c in zip(kept, [*key_cols, *extra_cols])], prediction.cast("int").alias("prediction"),
                       probability.alias("probability"), raw.alias("raw_score"))
