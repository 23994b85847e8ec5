"""What the review of round 3 found."""

import collections
import random

from pyspark.sql import functions as F

from placeloom.functions import text
from placeloom.operators import joins, resolve
from placeloom.operators.partners import found
from placeloom.operators.replay import Replay, Rule
from placeloom.operators.skew import dealt
from placeloom.plans.scratch import Scratch, measured
from placeloom.sources import readers
from placeloom.sources.readers import venue_rows


def test_the_meridian_is_a_place_for_areas(spark):
    rows = [(0, "B", 51.6, 0.0), (1, "B", 51.41, -0.3), (2, "B", 0.0, 0.0), (3, "B", 51.6, None)]
    v = readers.venue_rows(spark.createDataFrame(rows, "seq long, borough string, lat double, lon double"))
    areas = spark.createDataFrame([(0, "B", "West", 51.4, -0.3, ["E1"]), (1, "B", "East", 51.6, 0.1, ["E2"])], "ord int, borough string, area string, lat double, lon double, districts array<string>")
    for few in (64, 0):
        assert {r.seq: r.area for r in joins.assign_areas(v, areas, few=few).collect()} == {0: "East", 1: "West", 2: "", 3: ""}


def test_elements_on_the_meridian_keep_their_longitude(spark):
    rows = [(0, 51.6, 0.0, None), (1, 0.0, 0.0, None), (2, 0.0, 0.0, (51.5, 0.2)), (3, None, None, (51.5, 0.0)), (4, None, None, None)]
    e = spark.createDataFrame(rows, "pos long, lat double, lon double, center struct<lat: double, lon: double>")
    e = e.select("*", F.lit("node").alias("type"), F.col("pos").alias("id"), F.lit("B").alias("unit"), F.create_map(F.lit("name"), F.lit("Kite")).alias("tags"))
    assert {r.seq: (r.lat, r.lon) for r in readers.element_venues(e).collect()} == {0: (51.6, 0.0), 1: (None, None), 2: (51.5, 0.2), 3: (51.5, 0.0), 4: (None, None)}


def test_a_table_that_is_small_only_as_a_file_is_not_broadcast(spark):
    scratch = Scratch(measured(spark), "wide")
    wide = scratch.put(spark.range(300_000).select("id", F.lit("x" * 200).alias("x")))
    met = wide.join(spark.range(1_000_000).withColumn("y", F.rand(1)), "id")
    assert met.count() == 300_000 and "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_dealt_out(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 500 == 0, F.col("id").cast("string")).alias("k"))
    values = spark.range(2000).select(F.col("id").cast("string").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = rows.join(values.hint("merge"), dealt("k", "id") == F.col("v"), "left").withColumn("at", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(r.id for r in met if r.v is not None) == [0, 500, 1000, 1500] and all(r.v == r.k for r in met) and len(met) == 2000
    held = [sum(r.at == p for r in met) for p in {r.at for r in met}]
    assert len(held) == 4 and max(held) < 700


def test_partners_join_whom_an_ordered_replay_gives_them(spark):
    rng = random.Random(5)
    pick = lambda *xs: rng.choice(xs)
    names = ["Kite", "The Kite", "Kite House", "Ox", "Oxford", "Anchor Inn", "Anchor", "寿司", "麺", ""]
    fields = ["email", "website", "social_website", "phone", "facebook", "instagram", "source", "partner_notes"]
    rows = []
    for i in range(400):
        mail = pick("", "", f"a{rng.randrange(60)}@k.test", f"A{rng.randrange(60)}@K.test; b{rng.randrange(60)}@k.test, x")
        row = [i, pick(*names) + pick("", f" {rng.randrange(150)}"), mail, pick("", f"https://s{rng.randrange(40)}.test/"), pick("", "x"), pick("", f"020 7{rng.randrange(30):03} 0000"), pick("", f"https://www.facebook.com/f{rng.randrange(60)}"), "", "s" + str(i), pick("", str(i))]
        rows.append(dict(zip(["seq", "name", *fields], row, strict=True)))
    table = venue_rows(spark.createDataFrame(rows, "seq long, name string, " + ", ".join(f"{c} string" for c in fields)))
    partners = table.where("seq >= 150").withColumn("excluded", F.lit(""))
    acts, _ = resolve.merge_partners(table.where("seq < 150"), partners, "44")
    got = {r.seq: r for r in acts.collect()}

    ours = resolve._prepared(table, "44").withColumns({"mails": text.split_emails(F.col("_mail")), "phones": text.phone_key(F.col("phone"), "44"), "own": (F.col("website") != "") & ~text.not_venue_site(F.col("website"))}).orderBy("seq").collect()
    held = collections.Counter(r._fold for r in ours if r.seq < 150)
    cols = {c: [r[c] for r in ours] for c in ["seq", "_fold", "_raw", *fields]}
    cols["_new"] = [r.seq >= 150 for r in ours]
    cols["keys"] = [[f"e:{e}" for e in r.mails if "@" in e] + [f"f:{r.facebook.lower()}"] * bool(r.facebook) + [f"w:{r._site}"] * r.own + [f"p:{r.phones}"] * bool(r.phones) for r in ours]
    cols["_first"] = [min(x.seq for x in ours if x.seq < 150 and x._fold == r._fold) if r.seq >= 150 and len(r._fold) >= 6 and held[r._fold] == 1 else None for r in ours]
    fills = dict.fromkeys(["email", "website", "phone", "facebook", "instagram", "social_website"])
    rule = Rule("keys", "keys", fills, sure="eif", joins="_new", last="_first", adds=("email",), notes={"source": "append", "partner_notes": "replace"})
    want = Replay(rule, cols).run()
    for i in range(400):
        assert got[i].into == want["into"][i], i
        assert [got[i][c] for c in fields] == [want[c][i] for c in fields], i
    assert {"new", "merged", "merged by name"} <= {r.outcome for r in got.values()}
    # chains that the rounds leave open are replayed: none is allowed here
    ready = resolve._prepared(table, "44").join(spark.createDataFrame(list(zip(cols["seq"], cols["_new"], cols["keys"], strict=True)), "seq long, _new boolean, keys array<string>"), "seq")
    last = spark.createDataFrame([(s, f) for s, f in zip(cols["seq"], cols["_first"], strict=True) if f is not None], "seq long, _first long")
    told = {r.seq: r.into for r in found(ready, last, "eif", Scratch(spark, "chains"), rounds=0).collect()}
    assert told == {i: j for i, j in enumerate(want["into"]) if j is not None}
