"""Nearest points by descending an occupancy pyramid of the right side.

The right side is reduced once to distinct coordinates and built into a pyramid: cells of ``radius`` at
the top, cut into 4 x 4 smaller cells wherever a cell holds more than ``target`` points. Every
occupied cell has the bounding box of its points, and a cell that is not cut further is a leaf.

Each distinct left point starts with the occupied cells of the 3 x 3 block around it and descends level by level.
A cell's box gives a lower and an upper bound of the distance to its nearest point; a cell stays only while its lower
bound does not exceed the smallest upper bound the point has seen (nor the radius). Only the
points of the leaves that are left at the end are read. So a point far from a dense cluster compares a few
boxes a level, not the cluster.

Boxes and points use the same monotone arithmetic, so bounds hold exactly and ties are kept; the smallest right key
wins a tie. Cells and matches are checkpointed tables, so that AQE can split a hot cell or a hot coordinate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.features import degree_distance
from ontime.session import cut_lineage

# Cuts of a cell along each axis, points of a leaf, and the deepest level.
REFINE = 4
LEAF_POINTS = 64
MAX_DEPTH = 16


def cell(col: str, size: float) -> Column:
    return F.floor(F.col(col) / F.lit(float(size)))


@dataclass
class Pyramid:
    """``cells`` per level (cx, cy, px, py, box, leaf) and the ``points`` of all leaves by level and cell."""

    radius: float
    cells: list[DataFrame]
    points: DataFrame


def build(right: DataFrame, xy: tuple[str, str], key: str, radius: float, target: int = LEAF_POINTS) -> Pyramid:
    """Pyramid over the points of ``right`` that have both coordinates; co-located points keep the smallest key."""
    x, y = xy
    open_points = cut_lineage(
        right.select(F.col(x).cast("double").alias("_rx"), F.col(y).cast("double").alias("_ry"), F.col(key).alias("_k"))
        .where("_rx is not null and _ry is not null").groupBy("_rx", "_ry").agg(F.min("_k").alias("_k")))
    levels, leaves = [], []
    for depth in range(MAX_DEPTH + 1):
        size = radius / REFINE ** depth
        dealt = open_points.select("_rx", "_ry", "_k", cell("_rx", size).alias("cx"), cell("_ry", size).alias("cy"))
        cells = dealt.groupBy("cx", "cy").agg(
            F.count("*").alias("_n"), F.min("_rx").alias("x0"), F.max("_rx").alias("x1"),
            F.min("_ry").alias("y0"), F.max("_ry").alias("y1"))
        up = [F.floor(F.col(c) / F.lit(REFINE)).alias(p) for c, p in (("cx", "px"), ("cy", "py"))]
        leaf = (F.col("_n") <= target) | F.lit(depth == MAX_DEPTH)
        cells = cut_lineage(cells.select("cx", "cy", *up, "x0", "x1", "y0", "y1", leaf.alias("leaf")))
        placed = dealt.join(cells.select("cx", "cy", "leaf"), ["cx", "cy"])
        levels.append(cells)
        leaves.append(placed.where("leaf").select(F.lit(depth).alias("level"), "cx", "cy", "_rx", "_ry", "_k"))
        if cells.where("not leaf").isEmpty():
            break
        open_points = cut_lineage(placed.where("not leaf").select("_rx", "_ry", "_k"))
    points = cut_lineage(reduce(DataFrame.unionAll, leaves))
    return Pyramid(radius, levels, points)


def gap(low: str, high: str, at: str) -> Column:
    """Distance along one axis from ``at`` to the nearest place in [low, high]."""
    return F.greatest(F.col(low) - F.col(at), F.col(at) - F.col(high), F.lit(0.0))


def reach(low: str, high: str, at: str) -> Column:
    return F.greatest(F.abs(F.col(low) - F.col(at)), F.abs(F.col(high) - F.col(at)))


def face(low: str, high: str, at: str) -> Column:
    return F.least(F.abs(F.col(low) - F.col(at)), F.abs(F.col(high) - F.col(at)))


def length(dx: Column, dy: Column) -> Column:
    return F.sqrt(dy * dy + dx * dx)


def pruned(met: DataFrame, radius: float) -> DataFrame:
    """Cells that can hold the nearest point; ``best`` is the smallest upper bound of the point so far.

    Every side of a box touches a point, so the nearer side on one axis and the farther on the other bound a cell's
    nearest point from above.
    """
    x, y = ("x0", "x1", "_x"), ("y0", "y1", "_y")
    upper = F.least(length(face(*x), reach(*y)), length(reach(*x), face(*y)))
    near = met.withColumns({"lower": length(gap(*x), gap(*y)), "upper": upper}).where(F.col("lower") < radius)
    own = Window.partitionBy("_x", "_y")
    near = near.withColumn("best", F.least("best", F.min("upper").over(own)))
    return near.where("lower <= best").select("_x", "_y", "level", "cx", "cy", "leaf", "lower", "best")


def candidates(points: DataFrame, pyramid: Pyramid) -> DataFrame:
    """(_x, _y, _k, _d): the right points that each distinct left point (_x, _y) reads after its descent."""
    block = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    start = points.select("_x", "_y", F.inline(block)).select(
        "_x", "_y", (cell("_x", pyramid.radius) + F.col("dx")).alias("cx"), (cell("_y", pyramid.radius) + F.col("dy")).alias("cy"))
    met = start.join(pyramid.cells[0], ["cx", "cy"]).withColumns({"level": F.lit(0), "best": F.lit(float(pyramid.radius))})
    found = cut_lineage(pruned(met, pyramid.radius))
    ready = [found.where("leaf")]
    for depth, cells in enumerate(pyramid.cells[1:], 1):
        above = found.where("not leaf").select("_x", "_y", "best", F.col("cx").alias("px"), F.col("cy").alias("py"))
        met = above.join(cells, ["px", "py"]).withColumn("level", F.lit(depth))
        found = cut_lineage(pruned(met, pyramid.radius))
        ready.append(found.where("leaf"))
    leaves = reduce(DataFrame.unionAll, ready)
    if len(ready) > 1:  # a leaf met early may lie beyond what a deeper cell promised
        leaves = leaves.withColumn("best", F.min("best").over(Window.partitionBy("_x", "_y"))).where("lower <= best")
    return leaves.join(pyramid.points, ["level", "cx", "cy"]).select(
        "_x", "_y", "_k", degree_distance("_y", "_x", "_ry", "_rx").alias("_d"))


def nearest(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: Sequence[str], right_key: str,
            radius: float, target: int = LEAF_POINTS, dist_col: str = "dist") -> DataFrame:
    """Left rows with ``right_key`` and the distance of their nearest right point nearer than ``radius``.

    Left rows with none, or without coordinates, are dropped; equal distances go to the smallest right key.
    """
    lx, ly = left_xy
    points = left.select(F.col(lx).cast("double").alias("_x"), F.col(ly).cast("double").alias("_y"))
    points = points.where("_x is not null and _y is not null").distinct()
    pyramid = build(right, tuple(right_xy), right_key, radius, target)
    read = candidates(points, pyramid).where(F.col("_d") < F.lit(float(radius)))
    best = cut_lineage(read.groupBy("_x", "_y").agg(F.min(F.struct("_d", "_k")).alias("_b")))
    out = left.join(best, (left[lx] == best["_x"]) & (left[ly] == best["_y"]))
    return out.select(*[left[c] for c in left.columns], F.col("_b._k").alias(right_key), F.col("_b._d").alias(dist_col))
