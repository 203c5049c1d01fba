"""Nearest-point matching (airport -> nearest observing station) without a cross join.

``nearest`` descends an occupancy pyramid of the right side (see ``pyramid``) and is what the jobs use. ``nearest_grid``
is a plain grid search with the same results; it suits points without dense clusters, as it reads all points
of a block.

Semantics: for each left row, the right row at the smallest planar distance, kept
only when that distance is below ``radius``; equal distances go to the smallest
right key. This equals "rank every pair by distance, keep rank 1, then keep
dist < radius", computed without materialising all pairs:

1. Both sides are reduced to distinct coordinates first (exact: co-located right
   points are resolved by key, co-located left points share one answer), so a
   location holding a third of the rows costs one row.
2. Search runs over grid levels from fine to coarse. At cell size ``c`` a left
   point looks only at the 3x3 block of cells around it (a generated array, then an
   equi-join on the cell id). If the best candidate there is within ``c`` it is the
   exact nearest - anything closer lies inside the block - and the point is done.
   Points not settled go on to the next, coarser level; the last level uses
   ``c = radius`` and settles everything within the radius. Dense areas settle at
   fine levels where blocks are small; sparse areas at coarse ones.
3. The best candidate per left point is a ``min(struct(dist, key))`` aggregate,
   combined map-side, then joined back to the left rows on the coordinates.
4. With more than two levels the unsettled set is checkpointed between levels
   (reliable checkpoint in ``spark.checkpoint.dir``), so plans stay linear in the
   number of levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.features import degree_distance
from ontime.operators.pyramid import nearest as nearest  # the default search, offered here too
from ontime.session import cut_lineage

# Grid refinement factor per level, target right points per finest cell,
# and the deepest refinement considered (4**12 cells per radius, far below the
# precision of degree coordinates).
REFINE = 4
CELL_TARGET = 64
MAX_DEPTH = 12


def auto_levels(rpts: DataFrame, radius: float, x: str = "_rx", y: str = "_ry",
                target: int = CELL_TARGET) -> list[float]:
    """Grid levels as fractions of the radius, fine to coarse, from the data.

    Progressive: count points per cell at depth 0 (``radius``-sized cells); if no
    cell holds more than ``target`` points, one level is enough (the common, sparse
    case costs one aggregate, combined map-side). Otherwise only the points inside
    crowded cells go on to the next depth (cells ``REFINE`` times smaller per axis),
    until no cell is crowded. Every block a point probes at the finest level is then
    small, however tightly the data clusters. Only an emptiness check per depth
    reaches the driver; the shrinking point set is checkpointed between depths.
    """
    pts = rpts.select(F.col(x).alias("_ax"), F.col(y).alias("_ay"))
    for depth in range(MAX_DEPTH + 1):
        size = radius / REFINE ** depth
        keyed = pts.select("_ax", "_ay", _cell(F.col("_ax"), size).alias("cx"),
                           _cell(F.col("_ay"), size).alias("cy"))
        crowded = (keyed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > F.lit(target)).select("cx", "cy"))
        if crowded.isEmpty():
            return [1.0 / REFINE ** k for k in range(depth, -1, -1)]
        if depth < MAX_DEPTH:
            pts = cut_lineage(keyed.join(crowded, ["cx", "cy"], "left_semi").select("_ax", "_ay"))
    return [1.0 / REFINE ** k for k in range(MAX_DEPTH, -1, -1)]


def _cell(col: Column, size: float) -> Column:
    return F.floor(col / F.lit(float(size)))


def _block(cx: Column, cy: Column) -> Column:
    """The 9 cell ids around (cx, cy) as an array of structs."""
    cells = [F.struct((cx + F.lit(dx)).alias("cx"), (cy + F.lit(dy)).alias("cy"))
             for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    return F.array(*cells)


def nearest_grid(left: DataFrame, right: DataFrame, left_xy: tuple[str, str],
                 right_xy: tuple[str, str], right_key: str, radius: float,
                 levels: Sequence[float] | None = None, dist_col: str = "dist") -> DataFrame:
    """Left rows with ``right_key`` and ``dist`` of their nearest right point within
    ``radius``; left rows with no right point in range are dropped.

    ``levels`` are cell sizes as fractions of the radius; by default they are chosen
    from the right side's density (``auto_levels``)."""
    lx, ly = left_xy
    rx, ry = right_xy
    pts = (left.select(F.col(lx).alias("_x"), F.col(ly).alias("_y"))
           .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull()).distinct())
    rpts = (right.select(F.col(rx).alias("_rx"), F.col(ry).alias("_ry"), F.col(right_key).alias("_k"))
            .filter(F.col("_rx").isNotNull() & F.col("_ry").isNotNull())
            .groupBy("_rx", "_ry").agg(F.min("_k").alias("_k")))

    if levels is None:
        levels = auto_levels(rpts, radius)
    sizes = sorted({float(f) * radius for f in levels if 0 < f <= 1.0} | {float(radius)})
    todo = pts
    settled = []
    for i, size in enumerate(sizes):
        last = i == len(sizes) - 1
        probes = (todo.select("_x", "_y", F.explode(_block(_cell(F.col("_x"), size),
                                                           _cell(F.col("_y"), size))).alias("_c"))
                  .select("_x", "_y", F.col("_c.cx").alias("cx"), F.col("_c.cy").alias("cy")))
        cells = rpts.select("_rx", "_ry", "_k", _cell(F.col("_rx"), size).alias("cx"),
                            _cell(F.col("_ry"), size).alias("cy"))
        cand = (probes.join(cells, ["cx", "cy"])
                .select("_x", "_y", "_k",
                        degree_distance("_y", "_x", "_ry", "_rx").alias("_d"))
                .filter(F.col("_d") < F.lit(float(radius))))
        best = cand.groupBy("_x", "_y").agg(F.min(F.struct("_d", "_k")).alias("_b"))
        deep = len(sizes) > 2 and not last
        if deep:
            # Each level's result feeds both the final union and the next level's
            # unsettled set, so an uncut plan doubles per level. Reliable checkpoints
            # into the shared folder run every level's join once, keep plans small
            # and are the restart points if an executor is lost.
            best = cut_lineage(best)
        done = best if last else best.filter(F.col("_b._d") <= F.lit(size))
        settled.append(done.select("_x", "_y", F.col("_b._k").alias("_k"), F.col("_b._d").alias("_d")))
        if not last:
            todo = todo.join(done.select("_x", "_y"), ["_x", "_y"], "left_anti")
            if deep:
                todo = cut_lineage(todo)

    matches = settled[0]
    for more in settled[1:]:
        matches = matches.unionByName(more)
    out = left.join(matches, (left[lx] == matches["_x"]) & (left[ly] == matches["_y"]))
    return out.drop("_x", "_y").withColumnRenamed("_k", right_key).withColumnRenamed("_d", dist_col)


def with_present(right: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Keep right rows whose key occurs in ``observed`` (a left-semi join, so
    duplicates in ``observed`` never multiply rows)."""
    return right.join(observed.select(key), key, "left_semi")


def verified_stations(stations: DataFrame, weather: DataFrame, key: str = "station_id") -> DataFrame:
    """Stations that have at least one observation."""
    return with_present(stations, weather, key)
