"""Connected components of a graph of any size: union-find inside tasks, stars between them.

Each pass first unites what one task's share of the edges connects, by union-find, whatever those edges are; so a node
has at most one edge downwards per task. Tasks get a share worth their while, so few edges need few tasks and passes. Then every edge is lifted to the smallest neighbour of its lower end,
and all lower neighbours of a node go to the smallest of them, until every node has one neighbour below it
and that has none; the number of passes grows with the logarithm of the graph. A node with any number
of neighbours is no group: its smallest neighbour is an aggregate, and its edges meet it in a join of two plain
tables, which Spark splits where it is skewed. No edges or labels reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gradewell.llm.common import staged

#: Edges that one task unites before it hands on what it has; bounds its memory.
UNITED_AT_ONCE = 1_000_000
#: Edges for which a task is worth its while; fewer tasks mean fewer passes.
EDGES_A_TASK = 10_000


def forest(edges: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest node of its tree, for each node that is not its own."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while (up := above.get(x, x)) != top and x != top:
            above[x], x = top, up
        return top

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(above)}


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        trees = forest(edges)
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(trees.keys(), pa.int64()), "b": pa.array(trees.values(), pa.int64())}
        )

    edges: list[tuple[int, int]] = []
    for batch in batches:
        edges += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if len(edges) >= UNITED_AT_ONCE:
            yield out(edges)
            edges = []
    if edges:
        yield out(edges)


def _united(edges: DataFrame, rows: int) -> DataFrame:
    """`edges`, about so many, each task's share united; no more tasks than they are worth."""
    return edges.coalesce(-(-rows // EDGES_A_TASK) or 1).mapInArrow(_unite, "a long, b long")


def _stars(edges: DataFrame, rows: int) -> DataFrame:
    """One pass; `edges` (a, b) with a > b, read from a table of so many rows. The same components, flatter."""
    least = staged(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"), "least")
    lifted = edges.join(least, edges["b"] == least["u"], "left").select("a", F.coalesce("m", "b").alias("b"))
    # As many rows for an `a` as there were tasks, at most.
    lowest = _united(lifted, rows).withColumn("m", F.min("b").over(Window.partitionBy("a")))
    ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return _united(lowest.select(F.explode(ends).alias("e")).select("e.*").where("a <> b"), rows)


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has two neighbours below it, or one that has another below."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("below"), F.lit(0).alias("lower")),
        F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("below"), F.lit(1).alias("lower")),
    )).alias("e")).select("e.*")
    told = ends.groupBy("node").agg(F.min("below").alias("lo"), F.max("below").alias("hi"), F.max("lower").alias("lower"))
    return not told.where("lo <> hi OR lo IS NOT NULL AND lower = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a long, b long): the smallest node it is connected with.

    Loops, repeated and reversed edges and nulls are harmless; an empty table gives an empty one.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    given = staged(clean, "given")
    rows = given.count()
    now = staged(_united(given, rows), "edges")
    while rows > EDGES_A_TASK and _unsettled(now):  # what one task united is settled
        rows = now.count()
        now = staged(_stars(now, rows), "edges")
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), F.struct(F.col("b").alias("node"), F.col("b").alias("root")))
    return now.select(F.explode(ends).alias("e")).select("e.*").distinct()
