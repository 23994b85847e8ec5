"""The nearest target of each point among those of its partition, exactly, without a table of pairs.

The targets of a partition stand in a pyramid of cells over their own bounding box; a cell with few targets is a leaf, another is
cut into sixteen. Points descend level by level: a cell's first target bounds how far the nearest can be, and cells that lie farther than
the best bound so far are left out. What a point meets in the end are the targets of the few leaves that may hold the nearest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..plans.scratch import Scratch
from .skew import bounded

LEAF = 16  # targets that a leaf holds, if they lie apart
_DEPTH = 20  # bits of a place within the box
_STEP = 2  # bits that a level adds
_EDGES = ["y0", "x0", "h", "w"]  # south and west edge of a partition's box, height and width


def _cell(depth: int) -> list[Column]:
    return [F.shiftright(c, _DEPTH - depth).alias(k) for c, k in (("iy", "cy"), ("ix", "cx"))]


def _placed(targets: DataFrame) -> DataFrame:
    """``targets`` (p, t, lat, lon) with their places iy, ix in the box of their partition, and the box."""
    box = targets.groupBy("p").agg(F.min("lat").alias("y0"), F.min("lon").alias("x0"), F.max("lat").alias("y1"), F.max("lon").alias("x1"))
    box = box.select("p", "y0", "x0", F.greatest(F.col("y1") - F.col("y0"), F.lit(1e-9)).alias("h"), F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-9)).alias("w"))
    side = 1 << _DEPTH
    place = lambda c, low, size: F.least(F.lit(side - 1), F.floor((F.col(c) - F.col(low)) / F.col(size) * side)).cast("long")
    return targets.join(bounded(box), "p").select("*", place("lat", "y0", "h").alias("iy"), place("lon", "x0", "w").alias("ix"))


def _pyramid(placed: DataFrame, leaf: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Per level the cells (p, py, px: the cell above, cy, cx, rlat, rlon: a target in it, end: a leaf), and the targets with their leaf (depth, cy, cx)."""
    levels, ended, rest, n = [], [], placed, placed.count()
    for depth in range(0, _DEPTH + 1, _STEP):
        own = rest.select("*", *_cell(depth))
        cells = own.groupBy("p", "cy", "cx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "lat", "lon")).alias("r"), *[F.first(e).alias(e) for e in _EDGES])
        end = (F.col("n") <= leaf) | F.lit(depth == _DEPTH)
        above = [F.shiftright(c, _STEP if depth else 0).alias(a) for c, a in (("cy", "py"), ("cx", "px"))]
        cells = scratch.put(cells.select("p", *above, "cy", "cx", F.col("r.lat").alias("rlat"), F.col("r.lon").alias("rlon"), end.alias("end"), *_EDGES), n)
        levels.append(cells)
        told = own.join(bounded(cells.select("p", "cy", "cx", "end")), ["p", "cy", "cx"])
        ended.append(told.where("end").select("p", F.lit(depth).alias("depth"), "cy", "cx", "t", F.col("lat").alias("tlat"), F.col("lon").alias("tlon")))
        if not cells.where("not end").limit(1).count():
            break
        rest = scratch.put(told.where("not end").select(placed.columns), n)
    return levels, reduce(DataFrame.unionAll, ended)


def _least(depth: int) -> Column:
    """No target of the cell is nearer than this, in degrees at the target's latitude."""
    side = 1 << depth
    south, west = F.col("y0") + F.col("cy") * F.col("h") / side, F.col("x0") + F.col("cx") * F.col("w") / side
    north, east = south + F.col("h") / side, west + F.col("w") / side
    dy = F.greatest(F.lit(0.0), south - F.col("lat"), F.col("lat") - north)
    dx = F.greatest(F.lit(0.0), west - F.col("lon"), F.col("lon") - east)
    narrow = F.least(F.cos(F.radians(south)), F.cos(F.radians(north)))
    return F.hypot(dy, dx * F.greatest(F.lit(0.0), narrow)) * (1 - 1e-9) - 1e-9


def nearest(points: DataFrame, targets: DataFrame, scratch: Scratch, leaf: int = LEAF) -> DataFrame:
    """(v, p, t, gap): for each of ``points`` (v, p, lat, lon) the nearest of ``targets`` (p, t, lat, lon) of its p, the smaller t among equals.

    ``gap`` is in degrees at the target's latitude. Points whose p has no target get no row. (v, p) and t do not repeat; no column is null.
    """
    levels, leaves = _pyramid(scratch.put(_placed(targets)), leaf, scratch)
    leaves = scratch.put(leaves)
    n = points.count()
    state = points.select("v", "p", "lat", "lon", F.lit(0).cast("long").alias("py"), F.lit(0).cast("long").alias("px"), F.lit(float("inf")).alias("upto"))
    found = []
    for i, cells in enumerate(levels):
        met = state.join(bounded(cells), ["p", "py", "px"])
        gap = geo.degrees_apart(F.col("rlat"), F.col("rlon"), F.col("lat"), F.col("lon"))
        met = scratch.put(met.select("v", "p", "lat", "lon", "cy", "cx", "end", "upto", _least(i * _STEP).alias("least"), gap.alias("gap")).where("least <= upto"))
        best = met.groupBy("v", "p").agg(F.min(F.least("gap", "upto")).alias("best"))
        told = scratch.put(met.join(best, ["v", "p"]).where("least <= best"), 16 * n)
        scratch.drop(met)
        found.append(told.where("end").select("v", "p", "lat", "lon", "cy", "cx", F.lit(i * _STEP).alias("depth"), "least", "best"))
        state = told.where("not end").select("v", "p", "lat", "lon", F.col("cy").alias("py"), F.col("cx").alias("px"), F.col("best").alias("upto"))
    met = reduce(DataFrame.unionAll, found).join(bounded(leaves), ["p", "depth", "cy", "cx"])
    gap = geo.degrees_apart(F.col("tlat"), F.col("tlon"), F.col("lat"), F.col("lon"))
    near = met.select("v", "p", F.struct(gap.alias("gap"), "t").alias("x")).groupBy("v", "p").agg(F.min("x").alias("x"))
    return near.select("v", "p", "x.t", "x.gap")
