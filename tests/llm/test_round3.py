"""Centroids, covering SimHash and co-bucketed tables against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from placeloom.llm import centroids, cobucket, quotient, rowbytes, simhash, templates
from placeloom.operators.components import least_roots
from placeloom.plans.scratch import Scratch

SF = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def test_columns_without_a_hash_are_carried(spark):
    from placeloom.llm import rows, shards

    table = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "doc_id long, text string")
    odd = table.withColumns({"m": F.create_map(F.lit("k"), "text"), "ms": F.array(F.create_map(F.lit("k"), "text")), "s": F.struct(F.create_map(F.lit("k"), "text").alias("x"))})
    got, key = rows.numbered(odd, Scratch(spark, "t"), "doc_id")
    assert got.columns == [*odd.columns, key] and got.select(key).distinct().count() == 4
    assert [r.doc_id for r in got.orderBy(key).collect()] == [1, 1, None, None]
    only = odd.select("doc_id", "m")
    assert rows.numbered(only, Scratch(spark, "t"), "doc_id")[0].count() == 4
    placed = shards.curve_order(odd, [F.col("doc_id")], 2, "doc_id").collect()
    assert sorted(r.position for r in placed) == [0, 1, 2, 3] and all(r.ms == [{"k": r.text}] for r in placed)


# --- 11: weighted centroids ---


def lloyd(rows, clusters, rounds, dims, scale=64, seed=1):
    """(row number, cluster, distance) and the centroids, by plain loops over all rows."""
    kept = [(i, k, [math.floor(scale * x) for x in v]) for i, (k, v) in enumerate(rows) if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((r for r in kept if r[1] is not None), key=lambda r: hashlib.sha256(f"{seed}:{r[1]}".encode()).hexdigest())
    centers = [r[2] for r in named[:clusters]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, _, q in kept:
            own[near(q)[1]].append(q)
        centers = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centers)]
    return [(i, *near(q)[::-1]) for i, _, q in kept], centers


def test_centroids_match_plain_rounds(spark):
    rng = random.Random(3)
    base = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(40)]
    rows = [(i, list(rng.choice(base))) for i in range(300)] + [(300 + i, base[0]) for i in range(200)]
    rows += [(900, None), (901, [1.0]), (902, [1.0, None, 0.0, 0.0]), (903, [math.nan, 0.0, 0.0, 0.0]), (904, [math.inf, 0.0, 0.0, 0.0]), (905, []), (906, [-0.0001, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1, "x", b"y") for i, v in rows], "vec_id long, embedding array<float>, n int, k string, q binary")
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected, centers = lloyd(rows32, 5, 3, 4)
    got = {r.vec_id: r for r in centroids.cluster(table.repartition(7), clusters=5, rounds=3, dims=4).collect()}
    assert {i: (r.cluster, r.distance) for i, r in got.items()} == {rows[i][0]: (c, d) for i, c, d in expected}
    total = Counter()
    for _, c, d in expected:
        total[c] += d
    assert all(r.cluster_inertia == total[r.cluster] and r.inertia == sum(total.values()) for r in got.values())
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, centers[r.cluster])).encode()).hexdigest() for r in got.values())


def test_centroids_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema), dims=2).collect() == []
    few = centroids.cluster(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], schema), dims=2).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in few] == [(1, 0, 0), (1, 0, 0), (None, 0, 0)] or sorted((r.vec_id is None, r.distance) for r in few) == [(False, 0), (False, 0), (True, 0)]
    named = centroids.cluster(spark.createDataFrame([("a", [0.0]), ("b", [9.0])], "name string, v array<double>"), clusters=2, dims=1, key="name", vector="v")
    assert sorted((r.name, r.distance) for r in named.collect()) == [("a", 0), ("b", 0)]


# --- 12: covering SimHash ---


def bits_of(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(rows, radius=4):
    """The smallest id that each row reaches, over all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    own = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        own[find(i)].append(k)
    return [min((k for k in own[find(i)] if k is not None), default=None) for i in range(len(rows))]


def test_hashes_are_those_of_the_library():
    rng = random.Random(5)
    raw = bytes(rng.randrange(256) for _ in range(5000))
    spans = [(a, a + n) for n in [*range(0, 140), 255, 256, 257, 900] for a in [rng.randrange(4000)]]
    start, end = (np.array(x) for x in zip(*spans, strict=True))
    got = simhash.xxh64(np.frombuffer(raw, np.uint8), start, end)
    assert got.tolist() == [xxhash.xxh64_intdigest(raw[a:b], seed=42) for a, b in spans]


def test_fingerprints_are_majorities():
    rng = random.Random(6)
    texts = [None, "", " \n\t", "One", "a b c", "A B C D", "é ü  Ö x", "x" * 3000 + " y z w", "q " * 70_000]
    texts += [" ".join(rng.choice(["aa", "Bb", "cccc cc", "d\t\td", "ee\r\n"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    assert simhash.fingerprints_of(pa.array(texts, pa.string())).tolist() == [bits_of(t) for t in texts]


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(7)
    for fixed in (0, 0x00FF00FF0F0F3333, (1 << 54) - 1):
        masks = simhash.covering_masks(fixed, 4)
        assert len(masks) == 31 and all(m & fixed == fixed for m in masks)
        places = [p for p in range(64) if not fixed >> p & 1]
        for _ in range(2000):
            differ = sum(1 << p for p in rng.sample(places, min(4, len(places))))
            assert any(m & differ == 0 for m in masks)


@pytest.mark.parametrize("block", [1024, 8])
def test_near_components_lose_no_link(spark, block):
    rng = random.Random(8)
    centre = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << p for p in rng.sample(range(64), rng.randrange(0, 9))) for c in centre for _ in range(60)} | {rng.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1}
    fps = sorted(fps)
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    links = simhash.near_links(table, 4, Scratch(spark, "t"), block=block).collect()
    a, b = (np.array([r[i] for r in links], np.int64) for i in (0, 1))
    assert (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) > 0).all()
    node, root = least_roots(a, b)
    got = dict(zip(node.tolist(), root.tolist(), strict=True))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert [got.get(f, f) for f in signed] == near_groups([(s, f) for s, f in zip(signed, fps, strict=True)])


def test_simhash_of_odd_tables(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(8)]
    texts = [None, "", "  ", "one", "One", "one two"] + base + [b + " end" for b in base] + [b.upper() for b in base] + base * 3
    ids = list(range(len(texts)))
    ids[3], ids[4], ids[7] = None, None, 6
    extra = "k long, fp string, salt int, root long"
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, " + extra)
    rows = [(i, bits_of(t)) for i, t in zip(ids, texts, strict=True)]
    expected = Counter((i, f"{f:016x}", c) for (i, f), c in zip(rows, near_groups(rows), strict=True))
    got = simhash.near_components(docs.repartition(5))
    assert Counter(map(tuple, got.collect())) == expected and got.columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash.near_components(docs.limit(0)).collect() == []
    one = simhash.near_components(docs.where("doc_id = 9")).collect()
    assert [r.component_id for r in one] == [9]


@driver_tables
def test_op12_over_the_driver_table(spark):
    from placeloom.llm.queries import op12_covering_simhash

    rows = [(r.doc_id, bits_of(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {i: (f"{f:016x}", c) for (i, f), c in zip(rows, near_groups(rows), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op12_covering_simhash(spark, SF).collect()} == expected


# --- 13: co-bucketed tables ---


def rank(v):
    """How a value sorts within its column: nulls, numbers, not-a-number."""
    if v is None:
        return (0,)
    if isinstance(v, float):
        return (2,) if math.isnan(v) else (1, v)
    return (1, v.encode() if isinstance(v, str) else v)


def test_row_bytes_sort_and_return_as_rows_do():
    rng = random.Random(10)
    pick = lambda *x: rng.choice([None, *x])
    rows = [(pick(-5, 0, 3, 1 << 62, -(1 << 63)), pick("", "a", "a\x00", "a\x00b", "\x00\x00", "é", "ab"), pick(-1.5, 0.0, -0.0, math.inf, -math.inf, math.nan, 1e-300), pick(True, False), pick(b"", b"\xff\x00"), pick(1, -1)) for _ in range(400)]
    schema = pa.schema([("a", pa.int64()), ("b", pa.string()), ("c", pa.float64()), ("d", pa.bool_()), ("e", pa.binary()), ("f", pa.timestamp("us"))])
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
    made = rowbytes.encode(columns, np.full((len(rows), 2), 7, np.uint8)).to_pylist()
    order = sorted(range(len(rows)), key=lambda i: made[i])
    plain = sorted(range(len(rows)), key=lambda i: [rank(v) for v in rows[i]])
    assert [[rank(v) for v in rows[i]] for i in order] == [[rank(v) for v in rows[i]] for i in plain]
    back = rowbytes.decode(made, 2, schema)
    for c, own in zip(back.columns, columns, strict=True):
        assert [repr(x) for x in c.to_pylist()] == [repr(x) for x in own.to_pylist()]
    empty = rowbytes.encode([c[:0] for c in columns], np.zeros((0, 2), np.uint8))
    assert len(empty) == 0 and rowbytes.decode([], 2, schema).num_rows == 0
    with pytest.raises(ValueError, match="no order"):
        rowbytes.check(pa.schema([("m", pa.list_(pa.int64()))]))


def crc(i, salt="s"):
    return zlib.crc32(f"{salt}{i}".encode()) % 600


def checked_pair(got, sales, lines, columns):
    """Holds the report and the files against the rows of both tables (tuples, sale_id first; item_id third in lines)."""
    known = {r[0] for r in sales if r[0] is not None}
    count = {"sales": Counter(r[0] for r in sales), "sale_lines": Counter(r[0] for r in lines)}
    bucket = {"sales": lambda r: 601 if r[0] is None else crc(r[0]), "sale_lines": lambda r: 601 if r[0] is None else crc(r[0]) if r[0] in known else 600}
    number = {"sales": lambda r: bucket["sales"](r) - (bucket["sales"](r) % 4 == 1), "sale_lines": lambda r: 0 if r[2] is None else crc(r[2], "")}
    report = {(r.table_name, r.bucket): r for r in got}
    assert len(report) == len(got)
    for name, rows in (("sales", sales), ("sale_lines", lines)):
        own, start = defaultdict(list), Counter()
        for r in rows:
            own[bucket[name](r)].append(r)
            start[number[name](r)] += 1
        assert {b for n, b in report if n == name} == set(own)
        paths = [r.path for r in got if r.table_name == name]
        if paths:
            there = {f"{d}/{f}" for d, _, fs in os.walk(os.path.dirname(paths[0])) for f in fs if not f.endswith(".crc")}
            assert there == set(paths) and set(os.listdir(os.path.dirname(os.path.dirname(paths[0])))) <= {"sales", "sale_lines"}
        for b, rows in own.items():
            r = report[name, b]
            rows.sort(key=lambda x: [rank(v) for v in x])
            table = pq.ParquetFile(r.path).read()
            assert table.column_names == columns[name] and r.columns == ",".join(columns[name])
            assert [[rank(v) for v in x.values()] for x in table.to_pylist()] == [[rank(v) for v in x] for x in rows]
            ids = ",".join("" if x[0] is None else str(x[0]) for x in rows)
            origin = Counter(number[name](x) for x in rows)
            assert r.n_rows == len(rows) and r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
            assert r.lineage_sha256 == hashlib.sha256(",".join(f"{s}:{n}" for s, n in sorted(origin.items())).encode()).hexdigest()
            assert r.n_joined == (sum(count["sales"][i] * count["sale_lines"][i] for i in {x[0] for x in rows} if i is not None) if b < 600 else 0)
            assert r.rewritten == (not (len(origin) == 1 and start[min(origin)] == len(rows)))


def pair_of(spark, sales, lines, kinds):
    a, b = spark.createDataFrame(sales, kinds["sales"]).repartition(3), spark.createDataFrame(lines, kinds["sale_lines"]).repartition(3)
    sale = F.coalesce(cobucket.bucket_of(F.col("sale_id"), 600), F.lit(601))
    item = F.coalesce(cobucket.bucket_of(F.col("item_id"), 600, salt=""), F.lit(0))
    return cobucket.pair(a, b, "sale_id", ("sales", "sale_lines"), (F.when(sale % 4 == 1, sale - 1).otherwise(sale), item)).collect()


def test_pair_with_hot_null_and_odd_rows(spark):
    rng = random.Random(11)
    kinds = {"sales": "sale_id long, status string, _file double, b boolean", "sale_lines": "sale_id long, _bucket string, item_id long, r int, _spread timestamp_ntz"}
    columns = {n: [c.split()[0] for c in k.split(", ")] for n, k in kinds.items()}
    pick = lambda *x: rng.choice([None, *x])
    sales = [(pick(*range(60)), pick("", "a\x00", "é", "z"), pick(0.0, -0.0, math.nan, -1.5), pick(True, False)) for _ in range(150)]
    lines = [(pick(7, 7, 7, *range(90)), pick("x", "y\x00\x00", ""), pick(1, 1, 2, 99), pick(-1, 5), None) for _ in range(400)]
    # one line of an own item and sale: its starting file is its final one
    lines.append((59, "alone", 123456, 1, None))
    lines = [x for x in lines if x[0] != 59 or x[1] == "alone"]
    checked_pair(pair_of(spark, sales, lines, kinds), sales, lines, columns)
    checked_pair(pair_of(spark, [], lines[:20], kinds), [], lines[:20], columns)
    checked_pair(pair_of(spark, sales[:5], [], kinds), sales[:5], [], columns)
    assert pair_of(spark, [], [], kinds) == []


@driver_tables
def test_op13_over_the_driver_tables(spark):
    from placeloom.llm.queries import op13_cobucket

    tables = {n: pq.read_table(f"{SF}/{n}.parquet") for n in ("sales", "sale_lines")}
    rows = {n: [tuple(x.values()) for x in t.to_pylist()] for n, t in tables.items()}
    checked_pair(op13_cobucket(spark, SF).collect(), rows["sales"], rows["sale_lines"], {n: t.column_names for n, t in tables.items()})


# --- 3: merges of a range ---


def test_quotient_ranges_merge_many_pieces(spark, monkeypatch):
    sums = [i % 700 for i in range(1000)]
    rows = spark.createDataFrame([(bytearray(x.to_bytes(2, "big") * 16),) for x in sums], "sha binary").repartition(40)
    got = {r.fp for r in quotient.repeated_fingerprints(rows, 1).collect()}
    assert got == {int.from_bytes(x.to_bytes(2, "big") * 4, "big", signed=True) for x in range(300)}


# --- 4: what items have in common ---

LEAD = "Answer the following question about the story that you have read below this line"


def letters(rng, n):
    return " ".join("".join(rng.choice("bcdfghjklm") + rng.choice("aeiou") for _ in range(4)) for _ in range(n))


def test_templates_ignore_what_many_items_share(spark):
    rng = random.Random(23)
    own = [letters(rng, 12) for _ in range(60)]
    items = spark.createDataFrame([(i, f"{LEAD} {t}") for i, t in enumerate(own)] + [(100, LEAD)], "item_id long, text string")
    docs = [f"{LEAD} {letters(rng, 30)}" for _ in range(60)] + [f"{letters(rng, 9)} {LEAD} {own[i]} {letters(rng, 9)}" for i in range(0, 60, 10)]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in templates.matches(table, items).collect()}
    # the shared opening is an item itself, whole in every document; it tells of no other
    assert got == {(d, 100) for d in range(66)} | {(60 + i, 10 * i) for i in range(6)}
    got = {(r.doc_id, r.item_id) for r in templates.matches(table, items.where("item_id < 100")).collect()}
    assert got == {(60 + i, 10 * i) for i in range(6)}


@pytest.mark.parametrize("last", ["mill", "seventeen apples"])
def test_templates_tell_items_by_one_word_of_their_own(spark, last):
    items = spark.createDataFrame([(i, f"{LEAD} {w}") for i, w in enumerate([*letters(random.Random(3), 20).split(), last])], "item_id long, text string")
    docs = spark.createDataFrame([(0, f"wa wb {LEAD} {last} wc"), (1, f"wa wb {LEAD} house wc")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in templates.matches(docs, items).collect()} == {(0, 20)}


def test_templates_type_words_beyond_lists(spark):
    text = "The farmer keeps {0} cows near the old mill and walks {1} every day while {2} flies over the valley at night"
    items = spark.createDataFrame([(1, text.format("twelve", "60 kilometres", "NASA"))], "item_id long, text string")
    same = [("fifteen", "90 miles", "JAXA"), ("12", "5 km", "ESA"), ("twenty-five", "7 gigametres", "Anna"), ("two", "3 acres", "NASA")]
    docs = [text.format(*x) for x in same] + [letters(random.Random(1), 20), text.format("twelve", "60 kilometres", "NASA").upper()]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert {r.doc_id for r in templates.matches(table, items).collect()} == {0, 1, 2, 3, 5}
