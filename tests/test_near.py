"""Cells that follow density, and joins of names and places over them, against plain loops."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeloom.functions import geo
from placeloom.operators import joins, near, nearest
from placeloom.plans.scratch import Scratch
from placeloom.sources.readers import venue_rows


def apart(a, b):
    """Metres, as wide as at the first point."""
    return geo.METRES * math.hypot(a[0] - b[0], (a[1] - b[1]) * math.cos(math.radians(a[0])))


def skewed(rng, n):
    """Points of which most lie in one town, some at the edges of the map."""
    town = [(51.5 + rng.gauss(0, 0.004), -0.1 + rng.gauss(0, 0.004)) for _ in range(n // 2)]
    land = [(51.5 + rng.gauss(0, 0.5), -0.1 + rng.gauss(0, 0.5)) for _ in range(n // 3)]
    edge = [(rng.choice([89.9999, -90.0, 85.0, 84.9995, 0.0, 45.0]) + rng.uniform(0, 0.002), rng.choice([-180.0, 179.9995, 0.0, 90.0]) + rng.uniform(0, 0.01)) for _ in range(n - len(town) - len(land))]
    return town + land + edge


@pytest.mark.parametrize("metres", [20, 150, 5000])
def test_every_pair_within_reach_meets_in_one_cell(metres):
    rng = random.Random(metres)
    points = skewed(rng, 900)
    lat, lon = (np.array(x) for x in zip(*points, strict=True))
    cells = near.cut_cells(lat, lon, metres, leaf=8)
    home, around = cells.home(lat, lon), cells.around(lat, lon)
    assert len(cells.first) > 20 and all(len(set(a)) == len(a) for a in around)
    for i, a in enumerate(points):
        for j, b in enumerate(points):
            if apart(a, b) <= metres or apart(b, a) <= metres:
                assert home[j] in around[i]


def test_cells_of_a_skewed_table_hold_like_numbers():
    rng = random.Random(1)
    lat, lon = (np.array(x) for x in zip(*[(51.5 + rng.gauss(0, s), -0.1 + rng.gauss(0, s)) for s in (0.02, 0.2, 2) for _ in range(30_000)], strict=True))
    cells = near.cut_cells(lat, lon, 20, leaf=400)
    held = np.bincount(cells.home(lat, lon), minlength=len(cells.first))
    assert held.sum() == len(lat) and held.max() <= 400
    # rows dealt to tasks by cell: the largest of 64 within three times the median
    task = np.bincount(np.array([hash(str(c)) % 64 for c in range(len(held))]), held, 64)
    assert task.max() <= 3 * np.median(task)


def agree(a, b):
    (s, t), (p, q) = sorted([a["_fold"], b["_fold"]], key=len), (a["_raw"], b["_raw"])
    return (p == q and p != "") if not s else s == t or (len(s) >= 4 and s in t)


def test_named_pairs_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    names = ["kite", "thekite", "kitehouse", "ox", "oxford", "ab", "abc", "abcd", "restaurant1", "restaurant", "", "restauranta"]
    rows = [{"seq": i, "side": i % 2, "lat": y, "lon": x, "_fold": f, "_raw": rng.choice(["ร้าน", "ครัว", ""]) if not f else f} for i, (y, x) in enumerate(skewed(rng, 260)) for f in [rng.choice(names)]]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "seq long, side int, lat double, lon double, _fold string, _raw string")
    got = near.named_pairs(df.repartition(5), 300, Scratch(spark, "t"))
    met = got.where(geo.within(F.col("x_lat"), F.col("x_lon"), F.col("y_lat"), F.col("y_lon"), 300)).select("x_seq", "y_seq").collect()
    expected = [(a["seq"], b["seq"]) for a in rows for b in rows if a is not b and len(a["_fold"]) <= len(b["_fold"]) and agree(a, b) and apart((a["lat"], a["lon"]), (b["lat"], b["lon"])) <= 300]
    assert sorted(map(tuple, met)) == sorted(expected) and len(expected) > 300


def test_a_dense_cell_of_names_that_begin_alike(spark):
    n = 50_000
    i = F.col("id")
    name = F.concat(F.lit("restaurant"), F.lpad(F.conv((F.floor(i / 2) * 7919 + 13).cast("string"), 10, 36), 6, "q"), F.when(i % 2 == 1, "bar").otherwise(""))
    rows = spark.range(n).select(i.alias("seq"), F.lit(0).alias("side"), (51.5 + (i % 100) * 1e-6).alias("lat"), F.lit(-0.1).alias("lon"), F.lower(name).alias("_fold"), F.lit("x").alias("_raw"))
    began = time.monotonic()
    assert near.named_pairs(rows, 150, Scratch(spark, "t")).count() == n // 2
    assert time.monotonic() - began < 60


@pytest.mark.parametrize("lat", [51.5, 79.7, 89.5])
def test_items_across_any_edge(spark, lat):
    rng = random.Random(int(lat))
    step = 1 / (geo.METRES * math.cos(math.radians(lat)))
    items = [(i, rng.choice(["Kite", "Ox", "Anchor Inn"]), f"https://i{i}.test", lat + rng.uniform(0, 400) / geo.METRES, 10 + rng.uniform(0, 900) * step) for i in range(40)]
    rows = [(i, rng.choice(["The Kite", "Kite House", "Ox", "Inn", "Anchor"]), lat + rng.uniform(0, 400) / geo.METRES, 10 + rng.uniform(0, 900) * step, "") for i in range(60)]
    table = venue_rows(spark.createDataFrame(rows, "seq long, name string, lat double, lon double, website string"))
    got = joins.add_wikidata(table, spark.createDataFrame(items, "seq long, label string, site string, lat double, lon double"))
    fold = lambda s: {"_fold": s.lower().replace(" ", ""), "_raw": s}
    want = {i: next((f"https://i{k}.test" for k, label, _, y, x in items if agree(fold(label), fold(name)) and apart((y, x), (v, u)) <= 200), "") for i, name, v, u, _ in rows}
    assert {r.seq: r.website for r in got.collect()} == want and any(want.values())


def by_rank(point, targets):
    """The nearest target at its own latitude, then the smallest number."""
    return min((math.hypot(y - point[0], (x - point[1]) * math.cos(math.radians(y))), t) for t, y, x in targets)[1]


@pytest.mark.parametrize("leaf", [1, 16])
def test_nearest_is_that_of_all_pairs(spark, leaf):
    rng = random.Random(leaf)
    targets = [(p, t, 51.5 + rng.gauss(0, s) * (p != "same"), -0.1 + rng.gauss(0, s) * (p != "same")) for t, (p, s) in enumerate([("a", 0.3)] * 120 + [("a", 0.001)] * 120 + [("b", 1)] * 3 + [("same", 0)] * 40 + [("pole", 30)] * 60)]
    targets += [("grid", 1000 + 7 * i, float(i % 7), float(i // 7)) for i in range(49)] + [("grid", 2000 + i, float(i % 7), float(i // 7)) for i in range(49)]
    points = [(v, rng.choice(["a", "b", "same", "pole", "none"]), 51.5 + rng.gauss(0, 0.5), -0.1 + rng.gauss(0, 0.5)) for v in range(200)]
    points += [(300 + i, "grid", rng.randrange(13) / 2, rng.randrange(13) / 2) for i in range(60)]  # as near to two or four
    df = lambda rows, names: spark.createDataFrame(rows, names)
    got = nearest.nearest(df(points, "v long, p string, lat double, lon double").repartition(3), df(targets, "p string, t long, lat double, lon double"), Scratch(spark, "t"), leaf)
    want = {v: by_rank((y, x), own) for v, p, y, x in points if (own := [(t, a, b) for q, t, a, b in targets if q == p])}
    assert {r.v: r.t for r in got.collect()} == want


def test_a_hundred_thousand_areas_in_one_borough(spark):
    n = 100_000
    i = F.col("id")
    lat, lon = 51 + (i * 7919 % 100_003) / 100_003, -1 + (i * 104_729 % 99_991) / 99_991
    areas = spark.range(n).select(i.alias("ord"), F.lit("B").alias("borough"), F.concat(F.lit("area "), i.cast("string")).alias("area"), lat.alias("lat"), lon.alias("lon"), F.array(F.lit("E1")).alias("districts"))
    rows = [(k, "B", 51 + (k * 37 % 101) / 101, -1 + (k * 53 % 97) / 97, "") for k in range(300)]
    table = venue_rows(spark.createDataFrame(rows, "seq long, borough string, lat double, lon double, postcode string"))
    got = {r.seq: r.area for r in joins.assign_areas(table, areas).select("seq", "area").collect()}
    y, x = (np.array([f(k) for k in range(n)]) for f in (lambda k: 51 + (k * 7919 % 100_003) / 100_003, lambda k: -1 + (k * 104_729 % 99_991) / 99_991))
    for k, _, v, u, _ in rows:
        assert got[k] == f"area {np.hypot(y - v, (x - u) * np.cos(np.radians(y))).argmin()}"


def test_areas_found_by_search_are_those_found_by_comparison(spark):
    rng = random.Random(21)
    pick = lambda *xs: rng.choice(xs)
    areas = [(i, pick("B", "C"), f"n{rng.randrange(20)}", *pick((None, None), (51 + rng.randrange(9) / 8, rng.randrange(9) / 8), (51.5, 0.5)), rng.sample(["E1", "E2", "E3W", "E3", "E4"], rng.randrange(3))) for i in range(60)]
    rows = [(i, pick("B", "C", "D"), pick(None, 51 + rng.randrange(17) / 16), pick(0.0, rng.randrange(17) / 16), pick("", "E1 1AA", "E3W 2BB", "E9 1AA", "E4")) for i in range(200)]
    table = venue_rows(spark.createDataFrame(rows, "seq long, borough string, lat double, lon double, postcode string"))
    places = spark.createDataFrame(areas, "ord long, borough string, area string, lat double, lon double, districts array<string>")
    one, other = (joins.assign_areas(table, places, few).select("seq", "area").collect() for few in (64, 3))
    assert dict(map(tuple, one)) == dict(map(tuple, other)) and len({r.area for r in one}) > 10
