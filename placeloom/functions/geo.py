"""Distances and cells on the ground, and polygons."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRES = 111_320.0


def located(lat: Column, lon: Column | None = None) -> Column:
    """A coordinate of exactly 0 counts as missing, as a null does."""
    ok = F.coalesce(lat != 0, F.lit(False))
    return ok if lon is None else ok & F.coalesce(lon != 0, F.lit(False))


def degrees_apart(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Equirectangular, at the latitude of the first point."""
    return F.hypot(lat_a - lat_b, (lon_a - lon_b) * F.cos(F.radians(lat_a)))


def within(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, metres: float) -> Column:
    return degrees_apart(lat_a, lon_a, lat_b, lon_b) * METRES <= metres


def cell(c: Column, per_degree: float) -> Column:
    """Whole cell number; halves go to the even one."""
    return F.rint(c * per_degree).cast("long")


def neighbours(df: DataFrame, y: Column, x: Column, ring: int = 1) -> DataFrame:
    """``df`` once for each cell (cy, cx) around (y, x)."""
    around = F.array(*[F.struct((y + dy).alias("cy"), (x + dx).alias("cx")) for dy in range(-ring, ring + 1) for dx in range(-ring, ring + 1)])
    return df.withColumn("_c", F.explode(around)).select("*", "_c.cy", "_c.cx").drop("_c")


def polygon_rings(wkb: bytes) -> list[np.ndarray]:
    """All rings of a polygon or multipolygon in well-known binary."""

    def read(at: int) -> tuple[list[np.ndarray], int]:
        order = "<" if wkb[at] == 1 else ">"
        kind, n = struct.unpack_from(order + "II", wkb, at + 1)
        at += 9
        rings = []
        for _ in range(n):
            if kind % 1000 == 6:
                more, at = read(at)
                rings += more
            elif kind % 1000 == 3:
                (m,) = struct.unpack_from(order + "I", wkb, at)
                rings.append(np.frombuffer(wkb, order + "f8", 2 * m, at + 4).reshape(m, 2))
                at += 4 + 16 * m
            else:
                raise ValueError(f"no polygon: {kind}")
        return rings, at

    return read(0)[0]


def inside(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points lie inside: the even-odd rule over all rings, so holes are outside; so is the border itself."""
    hit, border = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring[:-1], ring[1:], strict=True):
            on = (x1 - x0) * (y - y0) == (y1 - y0) * (x - x0)
            border |= on & (min(x0, x1) <= x) & (x <= max(x0, x1)) & (min(y0, y1) <= y) & (y <= max(y0, y1))
            if y0 != y1:
                hit ^= ((y0 > y) != (y1 > y)) & (x < x0 + (y - y0) * (x1 - x0) / (y1 - y0))
    return hit & ~border


WORLD = 512.0  # degrees from the middle of the grid to its edges
_LEVELS = range(4, 21, 2)  # depths of covering cells: 64 degrees to a thousandth
EDGES = 24  # of a border cell, unless it is of the last level


def cell_edge(n: np.ndarray | int, depth: int) -> np.ndarray | float:
    """Lower edge of the n-th cell of a level; exact, as cells are powers of two wide."""
    return n * (2 * WORLD / (1 << depth)) - WORLD


def _meets(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which edges cross the height ``y`` (a lower end counts, an upper one does not), and where."""
    with np.errstate(divide="ignore", invalid="ignore"):
        at = x0 + (y - y0) * (x1 - x0) / (y1 - y0)
    return (y0 > y) != (y1 > y), at


def _turns(edges: np.ndarray, right: float, bottom: float, x: float, y: float) -> bool:
    """Whether the path from a point of a cell to its south-eastern corner, by its eastern side, crosses an odd number of edges."""
    x0, y0, x1, y1 = edges.T
    spans, at = _meets(x0, y0, x1, y1, y)
    low, there = _meets(x0, y0, x1, y1, bottom)
    rises, top = (y1 > y0) == (x1 > x0), np.maximum(y0, y1)
    under = np.where(spans, (right < at) == rises, top <= y)
    under_corner = np.where(low, (right < there) == rises, top <= bottom)
    across = spans & (x < at) & ~(right < at)
    down = ((x0 > right) != (x1 > right)) & under & ~under_corner
    return bool((across ^ down).sum() & 1)


def _passes(edges: np.ndarray, x: float, y: float, size: float) -> np.ndarray:
    """Whether the line of each edge touches a cell: its corners do not all lie on one side. Doubtful cases do touch."""
    x0, y0, x1, y1 = edges.T
    terms = [((x1 - x0) * (v - y0), (y1 - y0) * (u - x0)) for u in (x, x + size) for v in (y, y + size)]
    side = np.array([a - b for a, b in terms])
    doubt = 1e-12 * np.max([np.abs(a) + np.abs(b) for a, b in terms], axis=0)
    return (side.min(0) <= doubt) & (side.max(0) >= -doubt)


def cover(rings: list[np.ndarray], edges: int = EDGES) -> list[tuple[int, int, int, bytes | None, bool]]:
    """(depth, cy, cx, edges, corner) of disjoint cells that hold all of a polygon: inner ones without edges, border ones with theirs.

    A border cell has the edges that touch it, and whether its south-eastern corner lies inside. A cell that no edge touches
    is inside or outside as a whole.
    """
    every = np.concatenate([np.column_stack([r[:-1], r[1:]]) for r in rings if len(r) > 1] or [np.zeros((0, 4))])
    west, east = np.minimum(every[:, 0], every[:, 2]), np.maximum(every[:, 0], every[:, 2])
    south, north = np.minimum(every[:, 1], every[:, 3]), np.maximum(every[:, 1], every[:, 3])
    out: list[tuple[int, int, int, bytes | None, bool]] = []
    if not len(every):
        return out
    number = lambda v: int(np.floor((v + WORLD) / (2 * WORLD / (1 << _LEVELS[0]))))
    rows, columns = range(number(south.min()), number(north.max()) + 1), range(number(west.min()), number(east.max()) + 1)
    todo = []
    for cy in rows:
        crosses, at = _meets(*every.T, cell_edge(cy, _LEVELS[0]))
        todo += [(0, cy, cx, np.arange(len(every)), bool((crosses & (cell_edge(cx + 1, _LEVELS[0]) < at)).sum() & 1)) for cx in columns]
    while todo:
        level, cy, cx, own, corner = todo.pop()
        depth = _LEVELS[level]
        y, x, size = cell_edge(cy, depth), cell_edge(cx, depth), 2 * WORLD / (1 << depth)
        own = own[(west[own] <= x + size) & (east[own] >= x) & (south[own] <= y + size) & (north[own] >= y)]
        own = own[_passes(every[own], x, y, size)]
        if not len(own):
            if corner:
                out.append((depth, cy, cx, None, True))
        elif len(own) <= edges or level == len(_LEVELS) - 1:
            out.append((depth, cy, cx, every[own].tobytes(), corner))
        else:
            more, part = 1 << (_LEVELS[level + 1] - depth), size / (1 << (_LEVELS[level + 1] - depth))
            inner = every[own]
            for i in range(more):
                for j in range(more):
                    odd = _turns(inner, x + size, y, x + (j + 1) * part, y + i * part)
                    todo.append((level + 1, cy * more + i, cx * more + j, own, corner ^ odd))
    return out


def inside_cell(edges: np.ndarray, corner: bool, right: float, bottom: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As ``inside``, for points of one border cell: a path leads from the point to the cell's eastern side and down to its corner.

    Each edge that the path crosses changes sides. Both legs ask on which side of an edge their common end lies in the same way,
    so an edge through that end counts for exactly one of them, or for none.
    """
    hit, border = np.full(len(x), corner), np.zeros(len(x), bool)
    for x0, y0, x1, y1 in edges.reshape(-1, 4):
        on = (x1 - x0) * (y - y0) == (y1 - y0) * (x - x0)
        border |= on & (min(x0, x1) <= x) & (x <= max(x0, x1)) & (min(y0, y1) <= y) & (y <= max(y0, y1))
        spans, at = _meets(x0, y0, x1, y1, y) if y0 != y1 else (np.zeros(len(x), bool), y)
        beyond = right < at
        hit ^= spans & (x < at) & ~beyond
        if (x0 > right) != (x1 > right):  # where the edge crosses the eastern side: below the point, and below the corner?
            rises = (y1 > y0) == (x1 > x0)
            under = np.where(spans, beyond == rises, max(y0, y1) <= y)
            low, there = _meets(x0, y0, x1, y1, bottom) if y0 != y1 else (False, 0.0)
            under_corner = ((right < there) == rises) if low else max(y0, y1) <= bottom
            hit ^= under & (not under_corner)
    return hit & ~border


_KINDS = {"depth": T.IntegerType(), "cy": T.LongType(), "cx": T.LongType(), "edges": T.BinaryType(), "corner": T.BooleanType()}
_CELLS = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in _KINDS.items()]))


@F.pandas_udf(_CELLS)
def covering(wkb: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(_KINDS, c, strict=True)) for c in cover(polygon_rings(w))] if w is not None else [] for w in wkb], dtype=object)


@F.pandas_udf(T.BooleanType())
def _held(edges: pd.Series, corner: pd.Series, depth: pd.Series, cy: pd.Series, cx: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    """Whether each border cell's polygon holds its point; a batch's points of one cell are tested together."""
    out, x, y = np.zeros(len(edges), bool), x.to_numpy(), y.to_numpy()
    for (shape, inner, d, i, j), rows in pd.Series(np.arange(len(edges))).groupby([edges, corner, depth, cy, cx]):
        at = rows.to_numpy()
        out[at] = inside_cell(np.frombuffer(shape), inner, cell_edge(j + 1, d), cell_edge(i, d), x[at], y[at])
    return pd.Series(out)


def point_in_polygon(points: DataFrame, areas: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Every (point, area) with the point inside; ``areas`` has geometry (well-known binary), which is dropped as is a bbox.

    Areas are covered by cells of several levels, so the join is an equi-join on cells; a point meets an area once. Inner cells
    decide by themselves; border cells carry the few edges that pass them, never a whole polygon. Borders and holes are outside.
    """
    cells = areas.withColumn("_c", F.explode(covering(F.col("geometry")))).drop("bbox", "geometry")
    cells = cells.select("*", *[F.col(f"_c.{c}").alias(f"_{c}") for c in _KINDS]).drop("_c")
    place = lambda c, d: F.floor((F.col(c) + F.lit(WORLD)) * F.lit((1 << d) / (2 * WORLD)))
    levels = F.array(*[F.struct(F.lit(d).alias("d"), place(lat, d).alias("y"), place(lon, d).alias("x")) for d in _LEVELS])
    at = points.withColumn("_at", F.explode(levels)).select("*", F.col("_at.d").alias("_depth"), F.col("_at.y").alias("_cy"), F.col("_at.x").alias("_cx")).drop("_at")
    near = at.join(cells, ["_depth", "_cy", "_cx"])
    told = [F.col(c) for c in ("_edges", "_corner", "_depth", "_cy", "_cx", lon, lat)]
    both = [*points.columns, *[c for c in areas.columns if c not in ("bbox", "geometry")]]
    inner = near.where(F.col("_edges").isNull()).select(both)
    return inner.unionAll(near.where(F.col("_edges").isNotNull()).where(_held(*told)).select(both))
