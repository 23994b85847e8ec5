"""Joins by distance over cells that follow density, and by names of which the shorter lies within the longer.

Cells are the leaves of a quadtree that is cut from a bounded sample of the points: a city centre is many cells and a desert is one.
The sample decides only where cells end, never what is joined. No cell is narrower than twice the radius, so the square around a
point touches no other cells than those of its four corners: one side goes to its own cell, the other to the cells of its corners, whatever
their sizes, and a pair meets in exactly one cell.

Names meet by four letters in a row. What lies within another name shares all of its own runs of four letters with it, so the shorter asks by the one
that fewest names have, and a cell full of names that begin alike is not compared with itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..plans.scratch import Scratch
from .skew import with_values

SAMPLE = 100_000  # points that the cells are cut from, about
LEAF = 40  # points of the sample that a cell holds, if it may still be cut
_DEPTH = 24
_POLAR = 85.0  # degrees beyond which cells may be narrower than a point's square


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of ``x``, each with a zero before it."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _codes(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Place on the curve that visits all cells of one size, quarter by quarter; what lies outside the map counts as its edge."""
    side = 1 << _DEPTH
    y, x = ((np.nan_to_num(v) + half) / (2 * half) * side for v, half in ((lat, 90.0), (lon, 180.0)))
    y, x = (np.clip(np.floor(v), 0, side - 1).astype(np.int64) for v in (y, x))
    return _spread(y) << np.uint64(1) | _spread(x)


def _reach(lat: np.ndarray, metres: float) -> tuple[float, np.ndarray]:
    """Degrees of latitude and of longitude that cover ``metres`` around points, also as seen from the far side."""
    dy = metres / geo.METRES * (1 + 1e-9) + 1e-12
    cosine = np.cos(np.radians(np.minimum(90.0, np.abs(np.nan_to_num(lat)) + dy)))
    return dy, np.minimum(dy / np.maximum(cosine, 1e-9), 360.0)


@dataclass(frozen=True)
class Cells:
    """Leaves of a quadtree: the first place of each on the curve, and its edges."""

    first: np.ndarray
    south: np.ndarray
    north: np.ndarray
    metres: float

    def home(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, _codes(lat, lon), "right") - 1

    def around(self, lat: np.ndarray, lon: np.ndarray) -> list[list[int]]:
        """All cells that the square around each point touches."""
        dy, dx = _reach(lat, self.metres)
        corners = np.stack([self.home(lat + a * dy, lon + b * dx) for a in (-1, 1) for b in (-1, 1)], 1)
        out = [list(set(c)) for c in corners.tolist()]
        for i in np.flatnonzero(np.abs(np.nan_to_num(lat)) + 2 * dy >= _POLAR):  # every cell of these latitudes
            y = min(90.0, max(-90.0, np.nan_to_num(lat[i])))
            out[i] = np.flatnonzero((self.south <= y + dy) & (self.north >= y - dy)).tolist()
        return out


def cut_cells(lat: np.ndarray, lon: np.ndarray, metres: float, leaf: int = LEAF) -> Cells:
    """Quarters every cell that holds more than ``leaf`` points, as long as the quarters stay twice as wide as the radius."""
    codes = np.sort(_codes(lat, lon))
    dy = _reach(np.zeros(1), metres)[0]
    leaves, todo = [], [(0, 0, -90.0, -180.0)]
    while todo:
        depth, start, south, west = todo.pop()
        height, width = 180.0 / (1 << depth), 360.0 / (1 << depth)
        span = 1 << 2 * (_DEPTH - depth)
        held = np.searchsorted(codes, np.uint64(start + span)) - np.searchsorted(codes, np.uint64(start))
        edge = min(_POLAR, max(abs(south), abs(south + height)) + 2 * dy)  # of points whose squares reach in
        if held > leaf and depth < _DEPTH and height / 2 >= 2 * dy and width / 2 >= 2 * _reach(np.array([edge]), metres)[1][0]:
            todo += [(depth + 1, start + q * (span >> 2), south + (q >> 1) * height / 2, west + (q & 1) * width / 2) for q in (3, 2, 1, 0)]
        else:
            leaves.append((start, south, south + height))
    first, *edges = zip(*leaves, strict=True)
    return Cells(np.array(first, np.uint64), *(np.array(e) for e in edges), metres)


def cells_of(points: DataFrame, metres: float, leaf: int = LEAF) -> Cells:
    """Cells for ``points`` (lat, lon), cut from ``SAMPLE`` of them."""
    n = points.count()
    some = points.select("lat", "lon").sample(min(1.0, SAMPLE / max(1, n)), seed=7).limit(2 * SAMPLE).toPandas()
    return cut_cells(some["lat"].to_numpy(float), some["lon"].to_numpy(float), metres, leaf)


def home_cell(cells: Cells, lat: Column, lon: Column) -> Column:
    @F.pandas_udf("int")
    def home(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series(cells.home(lat.to_numpy(float), lon.to_numpy(float)).astype(np.int32))

    return home(lat, lon)


def cells_around(cells: Cells, lat: Column, lon: Column) -> Column:
    @F.pandas_udf("array<int>")
    def around(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series(cells.around(lat.to_numpy(float), lon.to_numpy(float)), dtype=object)

    return around(lat, lon)


def _runs(fold: Column) -> Column:
    """Distinct runs of four letters of a name of four or more."""
    spots = F.sequence(F.lit(1), F.greatest(F.length(fold) - 3, F.lit(1)))
    return F.array_distinct(F.transform(spots, lambda i: F.substr(fold, i, F.lit(4))))


def rarest_runs(folds: DataFrame, scratch: Scratch) -> DataFrame:
    """(_fold, g): of each name of four letters or more (``folds``, no repeats) the run of four that fewest names have."""
    runs = scratch.put(folds.where(F.length("_fold") >= 4).select("_fold", F.explode(_runs(F.col("_fold"))).alias("g")))
    total = runs.count()
    count = scratch.put(runs.groupBy("g").agg(F.count(F.lit(1)).alias("c")).withColumn("n", F.col("c")), total)
    told = with_values(runs, count, "g", "_fold", total)
    return scratch.put(told.groupBy("_fold").agg(F.min_by("g", F.struct("n", "g")).alias("g")), total)


def named_pairs(rows: DataFrame, metres: float, scratch: Scratch) -> DataFrame:
    """Pairs of ``rows`` (seq and side name a row; lat, lon, _fold, _raw) whose names match, at places whose squares of ``metres`` touch.

    Columns x_* are of the row with the shorter name, y_* of the other one; rows of equal names meet both ways. Sides and exact distances are for
    the caller to compare. Rows without a place are to be left out before.
    """
    cells = cells_of(rows, metres)
    fold = F.col("_fold")
    rare = rarest_runs(rows.select("_fold").distinct(), scratch)
    whole = F.when(F.length(fold) > 0, F.concat(F.lit("="), fold)).when(F.col("_raw") != "", F.concat(F.lit("~"), "_raw"))
    columns = ["seq", "side", "lat", "lon", "_fold", "_raw"]
    tally = scratch.put(rows.where(F.length(fold) >= 4).groupBy("_fold").agg(F.count(F.lit(1)).alias("c")))
    rare = scratch.put(rare.join(tally, "_fold"))
    total = rows.count()
    asks = with_values(rows.select(*columns), rare, "_fold", "seq", total)
    asks = asks.withColumn("g", F.coalesce("g", whole)).where("g is not null")
    asks = asks.withColumn("c", F.explode(cells_around(cells, F.col("lat"), F.col("lon"))))
    has = rows.select(*columns).withColumn("c", home_cell(cells, F.col("lat"), F.col("lon")))
    has = has.withColumn("g", F.explode(F.when(F.length(fold) >= 4, _runs(fold)).otherwise(F.array(whole)))).where("g is not null")
    side = lambda d, p: d.select(*[F.col(k).alias(f"{p}_{k.lstrip('_')}") for k in columns], "c", "g")
    met = side(asks, "x").join(side(has, "y"), ["c", "g"]).where("(x_seq <> y_seq or x_side <> y_side) and length(x_fold) <= length(y_fold)")
    return met.where(text.names_match(F.col("x_fold"), F.col("y_fold"), F.col("x_raw"), F.col("y_raw"))).drop("c", "g")
