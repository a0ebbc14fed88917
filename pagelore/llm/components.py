"""Connected components of a graph given as a table of links."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.storage import stage, temporaries

_EDGES = "a long, b long"


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes as all given ones, one fewer than nodes for each
    component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[child]], nodes[child]


def thinned(links: DataFrame) -> DataFrame:
    """(a, b) without those that others in the same batch make needless; the components stay.

    A batch needs memory for its own links only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = spanning_links(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, _EDGES)


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) long -> (node, component): the smallest node that links reach, for every node
    that has a link to another one. Null ends and links of a node to itself count for nothing.

    Every round hangs each node below its smallest neighbour, follows the new parents twice
    and contracts the links. The links at least halve in a few rounds whatever the shape of
    the graph. All tables stay distributed and each round starts from written files.
    """
    with temporaries(links.sparkSession):
        return stage(_components(links), "components", keep=True)


def _components(links: DataFrame) -> DataFrame:
    proper = links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = stage(thinned(proper), "links")
    names = None
    while not edges.isEmpty():
        parents = stage(edges.groupBy("b").agg(F.min("a").alias("up")).withColumnRenamed("b", "x"), "parents")
        up = parents.select(F.col("x").alias("up_x"), F.col("up").alias("up_up"))
        jumped = parents.join(up, F.col("up") == F.col("up_x"), "left")
        parents = stage(jumped.select("x", F.coalesce("up_up", "up").alias("up")), "parents")
        if names is None:
            ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            names = ends.select("node", F.col("node").alias("component"))
        names = stage(
            names.join(parents, F.col("component") == F.col("x"), "left").select(
                "node", F.coalesce("up", "component").alias("component")
            ),
            "components",
        )
        left = edges.join(parents, F.col("a") == F.col("x"), "left").select(
            F.coalesce("up", "a").alias("a"), "b"
        )
        both = left.join(parents, F.col("b") == F.col("x")).select("a", F.col("up").alias("b"))
        moved = both.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stage(thinned(moved.distinct()), "links")
    if names is None:
        names = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return names
