import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeloom.functions import geo, pages, text


def each(spark, fn, xs, kind="string"):
    rows = spark.createDataFrame(list(enumerate(xs)), f"i long, x {kind}")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_names(spark):
    assert each(spark, text.fold, ["Ann’s BBQ", "Café & Co.", "  A--b ", None, "ร้าน"]) == ["anns bbq", "cafe and co", "a b", "", ""]
    assert each(spark, text.slug, ["Pie & Mash's", "É"]) == ["pieandmashs", "e"]
    assert each(spark, text.usable, ["Mr Smith", "The Cafe Ltd", "Kite & Anchor", ""]) == [False, False, True, False]
    assert each(spark, text.area_names, ["Alderton (also High Alderton, Nether)", "Meadows, The"]) == [["Alderton", "High Alderton", "Nether"], ["The Meadows"]]
    assert each(spark, text.area_norm, ["Saint Ann's", "St. Ann's"]) == ["stanns"] * 2
    pairs = spark.createDataFrame([("kite", "thekitepub", "", ""), ("ab", "abc", "", ""), ("", "", "ก", "ก "), ("", "", "", "")], "a string, b string, c string, d string")
    assert [r.y for r in pairs.select(text.names_match(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("y")).collect()] == [True, False, True, False]


def test_addresses_of_sites(spark):
    assert each(spark, text.normalize_url, [" kite.test ", "//kite.test/a", "HTTP://x", ""]) == ["https://kite.test", "https://kite.test/a", "HTTP://x", ""]
    assert each(spark, text.not_venue_site, ["https://m.facebook.com/x", "kite.test", "https://maps.google.com/?q=1", "a.x.com", "https://order.deliveroo.co.uk/z"]) == [True, False, True, True, True]
    assert each(spark, text.is_aggregator, ["https://www.greeneking.test/pub", "kite.test"]) == [True, False]
    assert each(spark, text.site_root, ["https://www.shop.kite.co.uk/a", "https://a.b.kite.test", "nothing"]) == ["kite.co.uk", "kite.test", ""]
    assert each(spark, text.site_key, ["https://www.Kite.test/Menu/?a=1#b", "kite.test//"]) == ["kite.test/menu", "kite.test"]
    assert each(spark, text.crawl_key, ["www.kite.test:8080/A/?q=1"]) == ["kite.test:8080/a"]


def test_phones_and_postcodes(spark):
    assert each(spark, lambda c: text.phone_key(c, "44"), ["+44 20 7946 0000", "020-7946", None]) == ["02079460000", "", ""]
    assert each(spark, text.districts, ["E1W 6AN", "ec1a1bb", " ", "E16AN"]) == [["E1W", "E1"], ["EC1A", "EC1"], [], ["E1"]]
    assert each(spark, text.register_key, ["The Kite Cafe Ltd"]) == ["kite"]


def test_emails(spark):
    raw = [["mailto%3Ax@kite.test", "INFO@kite.test.", "u003einfo@kite.test", "a@example.com", "privacy@kite.test", "p.png@x.png", "jo.doe@gmail.com", "press@kite.test", "web@agency.test", "plain@kite.test", "a&amp;b@kite.test"]]
    assert each(spark, lambda c: text.valid_emails(c, F.array(F.lit("https://www.kite.test/"))), raw, "array<string>") == [["info@kite.test", "plain@kite.test", "jo.doe@gmail.com", "press@kite.test"]]
    verdicts = spark.createDataFrame([("a@b.test", "ok"), ("a@b.test", None), ("A@gmial.com", "ok"), ("no", "ok"), ("a@b.test", "no_mx")], "e string, s string")
    assert [r.v for r in verdicts.select(text.email_verdict(F.col("e"), F.col("s")).alias("v")).collect()] == ["valid", "valid", "typo_domain", "bad_syntax", "no_mx"]


def test_social(spark):
    assert each(spark, text.canonical_instagram, ["@Kite.Pub", "https://instagram.com/Kite/?hl=en", "instagram.com/p/abc", "no spaces here", ""]) == ["https://www.instagram.com/kite.pub/", "https://www.instagram.com/kite/", "", "", ""]
    fb = ["@The.Kite", "https://fb.com/pages/Kite/123", "facebook.com/profile.php?x=1&id=77", "facebook.com/profile.php?id=a", "facebook.com/events/1", "m.facebook.com/p/Kite-1/", "https://facebook.com/pages/Kite", "facebook.com"]
    base = "https://www.facebook.com/"
    assert each(spark, text.canonical_facebook, fb) == [base + "The.Kite", base + "123", base + "profile.php?id=77", "", "", base + "Kite-1", base + "Kite", ""]


def test_categories_and_score(spark):
    rows = [({"cuisine": "Pizza; italian"}, "x"), ({"shop": "bakery"}, "x"), ({"amenity": "pub"}, "Sushi Bar"), ({"amenity": "cafe"}, "x"), ({}, "x"), ({"diet:halal": "only", "mobile": "yes"}, None)]
    df = spark.createDataFrame(rows, "tags map<string,string>, name string")
    assert [r.c for r in df.select(text.categorize(F.col("tags"), F.col("name")).alias("c")).collect()] == [["Italian", "Pizza"], ["Bakery"], ["Pub", "Sushi"], ["Cafe"], ["Restaurant"], ["Food truck", "Halal"]]
    told = spark.createDataFrame([("English", ["Pub", "Thai"], True), ("Local", ["Thai"], None)], "l string, c array<string>, n boolean").select(*[c.alias(k) for k, c in text.english(F.col("l"), F.col("c"), F.col("n")).items()]).collect()
    assert [tuple(r) for r in told] == [(6, "High", "yes", "website in English; Western food (Pub); English/Latin-script name"), (0, "Low", "no", "")]


def test_domain_candidates(spark):
    df = spark.createDataFrame([("The Kite & Anchor Ltd", "Mile End District", ["Pub"]), ("Mr Brown", "", []), ("Abc", "", [])], "n string, p string, c array<string>")
    got = [r.d for r in df.select(text.domain_candidates(F.col("n"), F.col("p"), F.col("c")).alias("d")).collect()]
    assert got[0][:6] == ["kiteandanchor.co.uk", "kiteandanchor.com", "kiteandanchor.uk", "kiteandanchor.london", "kite-and-anchor.co.uk", "kite-and-anchor.com"]
    assert {"kiteandanchormileend.uk", "kiteandanchorlondon.com", "thekiteandanchor.com", "kiteandanchorpub.com", "kiteandanchorkitchen.co.uk"} <= set(got[0]) and got[1] == got[2] == []


def test_pages(spark):
    key = 0x2A
    hidden = f"{key:02x}" + "".join(f"{ord(c) ^ key:02x}" for c in "hi@kite.test")
    page = f'<a href="mailto:Book@kite.test?x">m</a><i data-cfemail="{hidden}"></i> info [at] kite [dot] test, we are at home, me at kite dot test data:image/png;base64,{"A" * 200}'
    assert each(spark, pages.page_emails, [page, None]) == [["book@kite.test", "hi@kite.test", "info@kite.test", "me@kite.test"], []]
    assert each(spark, pages.decode_cloudflare, [hidden]) == ["hi@kite.test"]
    assert each(spark, pages.visible_text, ["<p>a &amp; b<script>permanently closed</script>"]) == [" a & b "]
    status = lambda c: pages.site_status(pages.visible_text(c))
    assert each(spark, status, ["<p>We have now closed.</p>", "<script>closed down</script>open", "buy this domain", "buy this domain " + "w " * 500, "we are now closed on Mondays", "ปิดกิจการ"]) == ["closed", "ok", "parked", "ok", "ok", "closed"]
    assert each(spark, pages.page_language, ["<html lang='th'>abcd", "<html lang=en>abcกค", "กขค abcd", "กขคง<a href='/en/'>", "กขคง"]) == ["English", "English", "Bilingual", "Bilingual", "Local"]
    assert each(spark, pages.soft_redirect, ["<meta http-equiv='refresh' content='0; url=/home'>", "<script>window.location.href = \"/lander\"</script>", "x" * 4000 + "<meta http-equiv=refresh url=/x>"]) == ["/home", "/lander", None]
    link = '<a href="/contact">x</a><a href="https://other.test/contact">x</a><a href="/menu">Find <b>us</b></a><a href="/menu">about</a><a href="/">about</a>'
    assert each(spark, lambda c: pages.contact_links(c, F.lit("https://www.kite.test/")), [link]) == [["https://www.kite.test/contact", "https://www.kite.test/menu"]]


def test_hostile_page_is_quick(spark):
    page = "<a " * 60_000 + "a@" * 60_000 + "." * 60_000 + " at " * 20_000
    each(spark, pages.page_emails, ["warm"])
    t = time.time()
    each(spark, pages.page_emails, [page])
    assert time.time() - t < 20


def test_evidence(spark):
    def why(page, postcode="E1 6AN", phone="+44 20 7946 0000", name="Kite", **kw):
        df = spark.createDataFrame([(page, postcode, phone, name)], "t string, p string, f string, n string")
        own = pages.name_words(text.slug_words(F.col("n")))
        return df.select(pages.evidence(F.col("t"), text.compact_postcode(F.col("p")), text.digits(F.col("f")), own, text.slug(F.col("n")), text.slug(F.col("t")), **kw)).first()[0]

    assert why("at e1 6an") == "postcode" and why("call 020 7946 0000", "") == "phone" and why("nothing") == ""
    assert why("at E1 6AN", postcode_needs_name=True) == "" and why("Kite at E1 6AN", postcode_needs_name=True) == "postcode"
    assert why("The Kite House, Big City", "", "", "Kite House", city="city") == "name + city"


def test_ground(spark):
    row = spark.sql("select 51.5D a, -0.1D b, 51.5009D c, -0.1D d, 0.0D z")
    got = row.select(geo.within(F.col("a"), F.col("b"), F.col("c"), F.col("d"), 101), geo.within(F.col("a"), F.col("b"), F.col("c"), F.col("d"), 99), geo.located(F.col("a"), F.col("z")), geo.cell(F.lit(0.0125), 200), geo.cell(F.lit(0.0175), 200)).first()
    assert tuple(got) == (True, False, False, 2, 4)


@pytest.mark.parametrize("x,y,want", [(1, 1, True), (5, 5, False), (9, 1, True), (11, 1, False), (0, 5, False), (21, 21, True)])
def test_polygons_with_holes_and_parts(x, y, want):
    import struct

    def ring(a, b):
        return struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in ((a, a), (b, a), (b, b), (a, b), (a, a)))

    one = struct.pack("<BII", 1, 3, 2) + ring(0, 10) + ring(3, 7)
    two = struct.pack("<BII", 1, 3, 1) + ring(20, 22)
    got = geo.inside(geo.polygon_rings(struct.pack("<BII", 1, 6, 2) + one + two), np.array([x, 100.0]), np.array([y, 100.0]))
    assert got.tolist() == [want, False]


def around(rng, cx, cy, radius, corners, step=None):
    """A closed ring of corners around a middle, on a lattice if ``step`` is given."""
    turn = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    at = [(cx + radius * rng.uniform(0.4, 1) * math.cos(t), cy + radius * rng.uniform(0.4, 1) * math.sin(t)) for t in turn]
    at = [(round(x / step) * step, round(y / step) * step) for x, y in at] if step else at
    return np.array([*at, at[0]])


@pytest.mark.parametrize("seed", range(6))
def test_a_covering_decides_as_the_whole_polygon_does(seed):
    rng = random.Random(seed)
    step = rng.choice([None, 0.5, 1 / 16])
    rings = [around(rng, 3, 50, 20, 90, step), around(rng, 3, 50, 4, 30, step), around(rng, 40, 20, 0.7, 12, step)]
    cells = geo.cover(rings, edges=rng.choice([4, 24]))
    level = {d: {(cy, cx): (e, c) for k, cy, cx, e, c in cells if k == d} for d in range(4, 21, 2)}
    grid = step or 0.25
    points = [(rng.uniform(-20, 45), rng.uniform(15, 75)) for _ in range(800)]
    points += [(round(rng.uniform(-20, 45) / grid) * grid, round(rng.uniform(25, 72) / grid) * grid) for _ in range(1500)]
    points += [tuple(p) for r in rings for p in r] + [tuple((p + q) / 2) for r in rings for p, q in zip(r[:-1], r[1:], strict=True)]
    x, y = (np.array(v) for v in zip(*points, strict=True))
    want, got = geo.inside(rings, x, y), []
    for u, v in points:
        met = []
        for d, own in level.items():
            cell = tuple(math.floor((w + geo.WORLD) * (1 << d) / (2 * geo.WORLD)) for w in (v, u))
            if cell in own:
                edges, corner = own[cell]
                met.append(True if edges is None else geo.inside_cell(np.frombuffer(edges), corner, geo.cell_edge(cell[1] + 1, d), geo.cell_edge(cell[0], d), np.array([u]), np.array([v]))[0])
        assert len(met) <= 1
        got.append(bool(met and met[0]))
    assert got == want.tolist() and 200 < sum(got) < len(got) - 200


def test_a_country_is_few_cells_that_carry_few_edges():
    n = 20_000
    turn = np.linspace(0, 2 * np.pi, n + 1)
    far = 8 + 0.2 * np.sin(40 * turn)
    ring = np.column_stack([10 + far * np.cos(turn), 50 + far * np.sin(turn)])
    ring[-1] = ring[0]
    cells = geo.cover([ring])
    sizes = [len(e) // 32 for *_, e, _ in cells if e is not None]
    assert len(cells) < n and max(sizes) <= geo.EDGES and sum(sizes) < 4 * n
    assert geo.cover([]) == [] and geo.cover([np.zeros((0, 2))]) == []


def test_points_meet_areas_of_any_shape(spark):
    import struct

    rng = random.Random(9)
    pack = lambda r: struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r)
    shapes = {n: [around(rng, x, y, r, k)] for n, x, y, r, k in (("a", 0, 51, 5, 300), ("b", 2, 51, 3, 40), ("c", 0.1, 51.5, 0.01, 9))}
    shapes["a"].append(around(rng, 0, 51, 1, 20))
    wkb = {n: struct.pack("<BII", 1, 3, len(rs)) + b"".join(map(pack, rs)) for n, rs in shapes.items()}
    areas = spark.createDataFrame([(n, None, bytearray(w)) for n, w in wkb.items()] + [("none", None, None)], "district string, bbox int, geometry binary")
    points = [(i, rng.uniform(45, 57), rng.uniform(-6, 6), 1) for i in range(500)] + [(500 + i, 51.5 + rng.uniform(-0.01, 0.01), 0.1 + rng.uniform(-0.01, 0.01), 2) for i in range(200)] + [(999, None, 1.0, 3)]
    got = geo.point_in_polygon(spark.createDataFrame(points, "i int, lat double, lon double, depth int").repartition(3), areas)
    want = {(i, n) for n, rs in shapes.items() for (i, y, x, _) in points if y is not None and geo.inside(rs, np.array([x]), np.array([y]))[0]}
    rows = [(r.i, r.district) for r in got.collect()]
    assert got.columns == ["i", "lat", "lon", "depth", "district"] and len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100
