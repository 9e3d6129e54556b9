"""DBSCAN as joins over a grid.

Cells are small enough that all points of a cell are neighbours. A cell holding at least
``min_samples`` rows ("dense") therefore consists of core points only and needs no distances
inside; every other cell has fewer than ``min_samples`` rows. Distances are measured only from
the points of such sparse cells. Whether two dense cells touch is decided on bounding boxes of
ever smaller subcells. So no step lists the pairs of a crowded group. Equal points are folded
to one weighted spot first.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.lookup import left_lookup
from shelfwise.functions.ordered import row_numbers
from shelfwise.functions.storage import cut

# Spots of one cell that meet the probes of its neighbourhood in one task.
SPLIT = 5000


def _squared_gap(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)


def _box_gap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """Squared distance between two boxes."""
    apart = F.zip_with(
        F.zip_with(low_a, high_b, lambda x, y: x - y), F.zip_with(low_b, high_a, lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x)


def _around(df: DataFrame, cell: str, target: str, dimensions: int) -> DataFrame:
    """One row per neighbouring cell that can hold a point within eps, the cell itself included."""
    reach = ceil(sqrt(dimensions))
    steps, between = [f"_step{i}" for i in range(dimensions)], F.lit(0.0)
    for step in steps:
        # Filtered step by step, so that only beginnings of cells within reach are expanded further.
        between = between + F.pow(F.greatest(F.abs(step) - 1, F.lit(0)), F.lit(2))
        df = df.withColumn(step, F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).where(between <= dimensions)
    shifted = F.array(*[F.col(cell)[i] + F.col(s) for i, s in enumerate(steps)])
    return df.withColumn(target, shifted).drop(*steps)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node is connected to, from edges (u, v) with u <> v.

    Alternates two contractions, linking every node to the least node of its neighbourhood,
    until nothing changes; each round's edges are written, so the plan stays short.
    """
    def signature(df):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
        )
        edges = cut(small.distinct())
        after = signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _touching_dense_cells(dense: DataFrame, eps2: float, dimensions: int) -> DataFrame:
    """(a, b): pairs of dense cells with two spots within eps, found by refining subcells.

    ``dense`` has (cell, u, x, spot): u is x in units of the cell side.
    """
    def subcells(level: int, undecided: DataFrame) -> DataFrame:
        sub = F.transform("u", lambda v: F.floor(v * 2.0**level))
        active = undecided.select(F.explode(F.array("a", "b")).alias("cell")).distinct()
        return dense.join(active, "cell", "left_semi").withColumn("sub", sub).groupBy("cell", "sub").agg(
            F.array(*[F.min(F.col("x")[i]) for i in range(dimensions)]).alias("low"),
            F.array(*[F.max(F.col("x")[i]) for i in range(dimensions)]).alias("high"),
            F.min(F.struct("spot", "x")).alias("some"),
        ).withColumn("parent", F.transform("sub", lambda v: F.floor(v / 2)))

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(
            F.col("cell").alias(name), F.col("parent").alias(f"{name}_at"), F.col("sub").alias(f"{name}_sub"),
            F.col("low").alias(f"{name}_low"), F.col("high").alias(f"{name}_high"), F.col("some.x").alias(f"{name}_x"),
        )

    cells = dense.select("cell").distinct()
    pairs = _around(cells.withColumnRenamed("cell", "a"), "a", "b", dimensions).where(F.col("a") < F.col("b"))
    start = F.col("a").alias("a"), F.col("a").alias("a_at"), F.col("b").alias("b"), F.col("b").alias("b_at")
    undecided = cut(pairs.join(cells.withColumnRenamed("cell", "b"), "b").select(*start))
    links, level = None, 0
    while True:
        level += 1
        table = cut(subcells(level, undecided))
        tested = undecided.join(side(table, "a"), ["a", "a_at"]).join(side(table, "b"), ["b", "b_at"]).select(
            "a", F.col("a_sub").alias("a_at"), "b", F.col("b_sub").alias("b_at"),
            (_squared_gap(F.col("a_x"), F.col("b_x")) <= eps2).alias("linked"),
            _box_gap(F.col("a_low"), F.col("a_high"), F.col("b_low"), F.col("b_high")).alias("gap"),
        )
        tested = cut(tested.where(F.col("linked") | (F.col("gap") <= eps2)))
        found = tested.where("linked").select("a", "b").distinct()
        links = found if links is None else links.unionByName(found)
        undecided = cut(tested.where(~F.col("linked")).select("a", "a_at", "b", "b_at").join(found, ["a", "b"], "left_anti"))
        if undecided.isEmpty():
            return links


def fit_dbscan(
    df: DataFrame, key: str, features: Sequence[str], eps: float = 0.5, min_samples: int = 5, *, split: int = SPLIT
) -> DataFrame:
    """``df`` with ``cluster``: numbered from 0 by their first core point, -1 for noise.

    A point is core with at least ``min_samples`` rows, itself included, within ``eps``. A border
    point joins the lowest-numbered cluster it touches.
    """
    features, dimensions, eps2 = list(features), len(features), eps * eps
    side = eps / sqrt(dimensions) * (1 - 1e-9)
    spots = (
        df.groupBy(*features)
        .agg(F.count("*").alias("n"), F.min(key).alias("spot"))
        .withColumn("x", F.array(*[F.col(f).cast("double") for f in features]))
        .withColumn("u", F.transform("x", lambda v: v / side))
        .withColumn("cell", F.transform("u", lambda v: F.floor(v)))
    )
    spots = cut(spots)
    cells = cut(spots.groupBy("cell").agg(
        (F.sum("n") >= min_samples).alias("dense"), F.ceil(F.count("*") / split).alias("parts")
    ))
    spots = cut(left_lookup(spots, cells, "cell"))

    # Neighbours of the spots in sparse cells: occupied cells around each such cell first, then its
    # spots. Crowded cells are spread over ``parts`` salts.
    around = _around(cells.where("NOT dense").select(F.col("cell").alias("p_cell")), "p_cell", "cell", dimensions)
    around = around.join(cells.select("cell", "parts"), "cell")
    sparse = spots.where("NOT dense").select(F.col("spot").alias("p"), F.col("x").alias("px"), F.col("cell").alias("p_cell"))
    probes = sparse.join(around, "p_cell").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    near = cut(
        probes.drop("parts")
        .join(spots.withColumn("salt", F.pmod(F.xxhash64("spot"), F.col("parts"))), ["cell", "salt"])
        .where(_squared_gap(F.col("px"), F.col("x")) <= eps2)
        .select("p", "p_cell", F.col("spot").alias("q"), F.col("cell").alias("q_cell"), "n", "dense")
    )
    core = cut(
        near.groupBy("p", "p_cell").agg(F.sum("n").alias("n")).where(F.col("n") >= min_samples)
        .select(F.col("p").alias("spot"), F.col("p_cell").alias("cell"))
    )
    core_spots = spots.where("dense").select("spot", "cell").unionByName(core)
    nodes = cut(core_spots.groupBy("cell").agg(F.min("spot").alias("node")))

    # Cells are linked when they hold core points within eps of each other.
    to_core = near.join(core.select(F.col("spot").alias("q"), F.lit(True).alias("_core")), "q", "left").where(
        F.col("dense") | F.col("_core")
    )
    from_core = to_core.join(core.select(F.col("spot").alias("p")), "p", "left_semi")
    links = (
        from_core.select(F.col("p_cell").alias("a"), F.col("q_cell").alias("b"))
        .unionByName(_touching_dense_cells(spots.where("dense"), eps2, dimensions))
        .where(F.col("a") != F.col("b")).distinct()
    )
    ends = lambda name, node: nodes.select(F.col("cell").alias(name), F.col("node").alias(node))
    edges = links.join(ends("a", "u"), "a").join(ends("b", "v"), "b").select("u", "v")
    roots = nodes.join(connected_components(edges), "node", "left").select("cell", F.coalesce("root", "node").alias("root"))
    roots = cut(roots)
    numbers = row_numbers(roots.select("root").distinct(), [], ["root"], "_number")
    clusters = cut(roots.join(numbers, "root").select("cell", (F.col("_number") - 1).cast("int").alias("cluster")))

    labelled = left_lookup(core_spots, clusters, "cell").select("spot", "cluster")
    border = (
        left_lookup(
            to_core.join(core.select(F.col("spot").alias("p")), "p", "left_anti").select("p", F.col("q_cell").alias("cell")),
            clusters, "cell",
        )
        .groupBy(F.col("p").alias("spot")).agg(F.min("cluster").alias("cluster"))
    )
    by_spot = labelled.unionByName(border)
    placed = spots.select(*features, "spot").join(by_spot, "spot", "left").select(
        *features, F.coalesce("cluster", F.lit(-1)).alias("cluster")
    )
    return df.join(placed, features).select(*df.columns, "cluster")
