"""What keeps the time of venue queries in line with their rows."""

from pyspark.sql import functions as F

from placeloom.functions import text
from placeloom.operators import joins, resolve, skew
from placeloom.operators.greedy import settle
from placeloom.plans import jobs
from placeloom.plans.scratch import Scratch, measured
from placeloom.sources.readers import venue_rows


def test_code_too_long_for_the_jvm_to_compile_is_cut_up(spark):
    assert measured(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_name_patterns_are_tried_once_a_row(spark):
    tags = F.create_map(F.lit("amenity"), F.col("a"))
    rows = spark.createDataFrame([("pub", "Dim Sum Deli"), ("cafe", "Kite"), (None, None)], "a string, n string").select("n", text.categorize(tags, F.col("n")).alias("c"))
    assert [r.c for r in rows.collect()] == [["Chinese", "Deli", "Pub"], ["Cafe"], ["Restaurant"]]
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("|delicatessen") == 1
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_contacts_are_split_before_later_steps_read_them(spark, monkeypatch):
    v = venue_rows(spark.createDataFrame([(1, "Kite", "A@kite.test; b@kite.test", "kite.test")], "seq long, name string, email string, website string"))
    seen = []
    monkeypatch.setattr(joins, "add_brand_sites", lambda rows: seen.append(rows) or rows)
    got = jobs.enrich_venues(v, None, None, None, None).collect()
    assert [(r.email, r.other_emails, r.website) for r in got] == [("a@kite.test", ["b@kite.test"], "https://kite.test")]
    assert "Python" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_cells_of_three_decimals_are_as_before(spark):
    rows = [(51.5004, -0.1), (0.0625, -0.0625), (-0.0001, 0.0), (None, 1.0), (1.0, None), (float("nan"), 1.0)]
    got = [r.s for r in spark.createDataFrame(rows, "lat double, lon double").select("lat", "lon", resolve._spot(None).alias("s")).collect()]
    assert got == ["51.5:-0.1", "0.062:-0.062", "0.0:0.0", None, None, None]


def test_a_round_in_which_few_rows_stay_is_not_the_last(spark):
    # row 0 alone stays in the first round, all others join it in the second
    keys = spark.range(100).select(F.col("id").alias("seq"), F.lit(0).alias("pos"), F.lit("e:1").alias("k"), F.lit(True).alias("sure"))
    joined, stayed, left = settle(keys, Scratch(spark, "t"))
    assert {r.seq: r.into for r in joined.collect()} == {i: 0 for i in range(1, 100)}
    assert [r.seq for r in stayed.collect()] == [0] and not left.count()
    joined, stayed, left = settle(keys, Scratch(spark, "t"), few=99)  # so many are left to a replay
    assert not joined.count() and stayed.count() == 1 and left.count() == 99


def _with_counts(spark):
    rows = spark.range(6000).select(F.col("id").alias("seq"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50))).alias("k"))
    values = Scratch(spark, "t").put(rows.where("k is not null and k <> 'k3'").groupBy("k").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("c")))
    return rows, values, skew.with_values(rows, values, "k", "seq", 6000)


def test_frequent_keys_are_broadcast_by_number(spark):
    _, _, got = _with_counts(spark)
    modes = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "HashedRelationBroadcastMode" in line]
    assert modes and not any("string" in line for line in modes)  # an empty map of texts takes 64 MB


def test_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    rows, values, plain = _with_counts(spark)
    want = sorted(map(tuple, rows.join(values.select("k", "first"), "k", "left").select("seq", "k", "first").collect()))
    assert sorted(map(tuple, plain.collect())) == want and values.where("c > 1000").count() == 1
    monkeypatch.setattr(skew, "HOT", 6_000_000)
    monkeypatch.setattr(skew, "LEAST", 1)  # every key counts as frequent
    monkeypatch.setattr(skew.F, "xxhash64", lambda *c: F.col("seq" if c == ("seq",) else "k").isNull().cast("long"))
    got = skew.with_values(rows, values, "k", "seq", 6000)
    assert sorted(map(tuple, got.collect())) == want
