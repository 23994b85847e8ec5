"""Queries over the driver's tables that run sources, sinks, logs and whole jobs; each has an equivalent in SQL but for the followed log.

They are added to ``queries.QUERIES``. Source records (map elements, register entries, catalogue places, ...) are made of the
venue view in the shape that the readers give them.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import text
from .functions import values as V
from .operators import enrich, joins, relations
from .plans import jobs
from .plans.scratch import Scratch, ship
from .queries import _CATS, _DECIMALS, _JUNK, _KEY, _OWN, QUERIES, VENUES, _table, _view, query, venues
from .sources import readers, schemas
from .streaming import logs

__all__ = ["QUERIES"]


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as map elements: nodes and ways, tags under different keys, some that serve no food."""
    s = F.col("seq")
    own = F.create_map(F.lit("name"), "name", F.lit("cuisine"), "cuisine", F.lit("addr:postcode"), "pc", F.lit("addr:street"), F.concat(F.lit("Road "), (s % 9).cast("string")))
    kind = F.when(s % 10 == 9, F.create_map(F.lit("shop"), F.lit("books"))).when(s % 10 == 8, F.create_map(F.lit("shop"), F.lit("deli"))).otherwise(F.create_map(F.lit("amenity"), "amenity"))
    site = F.when(s % 2 == 0, F.create_map(F.lit("website"), "site")).otherwise(F.create_map(F.lit("website"), F.lit(""), F.lit("contact:website"), "site"))
    mail = F.when(s % 3 == 0, F.create_map(F.lit("email"), "mail")).otherwise(F.create_map(F.lit("contact:email"), "mail"))
    at = F.struct("lat", "lon")
    return _view(spark, sf_dir).select(
        F.when(s % 2 == 0, "node").otherwise("way").alias("type"), s.alias("id"), F.when(s % 2 == 0, F.col("lat")).alias("lat"), F.when(s % 2 == 0, F.col("lon")).alias("lon"), F.when(s % 2 == 1, at).alias("center"),
        F.map_concat(own, kind, site, mail, F.create_map(F.lit("phone"), "tel")).alias("tags"), F.col("borough").alias("unit"), s.alias("pos"),
    )


@query(f"""SELECT seq, name, borough, mail AS email, site AS website, 'Road ' || (seq % 9) AS address, pc AS postcode, lat, lon,
  'https://www.openstreetmap.org/' || CASE WHEN seq % 2 = 0 THEN 'node/' ELSE 'way/' END || seq AS osm_url FROM ({VENUES}) v WHERE seq % 10 <> 9""")
def map_element_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.element_venues(readers.food_elements(_elements(spark, sf_dir)))
    return rows.select("seq", "name", "borough", "email", "website", "address", "postcode", "lat", "lon", "osm_url")


_TYPES = [1, 7844, 7843, 7846, 4613]


@query(f"""WITH r AS (SELECT *, CASE seq % 5 WHEN 0 THEN 1 WHEN 1 THEN 7844 WHEN 2 THEN 7843 WHEN 3 THEN 7846 ELSE 4613 END AS t,
  CASE WHEN seq % 5 <> 4 THEN name WHEN seq % 3 = 0 THEN 'Bagel Shop' WHEN seq % 3 = 1 THEN 'Newsagent' ELSE 'Old Bakery' END AS n FROM ({VENUES}) v)
SELECT seq, n AS name, CASE t WHEN 1 THEN 'restaurant' WHEN 7843 THEN 'pub' WHEN 7844 THEN 'fast_food' WHEN 7846 THEN 'fast_food' END AS amenity, CASE WHEN t = 7846 THEN 'yes' END AS vendor,
  CASE WHEN t = 4613 THEN CASE WHEN n = 'Old Bakery' THEN 'bakery' ELSE 'deli' END END AS shop, '1 Road, Town' AS address, CASE WHEN seq % 6 <> 0 THEN lat END AS lat FROM r WHERE n <> 'Newsagent'""")
def register_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    kind = F.element_at(F.array(*[F.lit(t) for t in _TYPES]), (s % 5 + 1).cast("int"))
    name = F.when(s % 5 != 4, F.col("name")).when(s % 3 == 0, " Bagel Shop").when(s % 3 == 1, "Newsagent").otherwise("Old Bakery")
    rows = _view(spark, sf_dir).select(
        s.alias("FHRSID"), name.alias("BusinessName"), kind.alias("BusinessTypeID"), F.lit("1 Road").alias("AddressLine1"), F.lit("").alias("AddressLine2"), F.lit("Town").alias("AddressLine3"),
        F.col("pc").alias("PostCode"), F.col("tel").alias("Phone"), F.struct(F.when(s % 6 != 0, F.col("lat").cast("string")).otherwise("none").alias("latitude"), F.col("lon").cast("string").alias("longitude")).alias("geocode"), s.alias("pos"),
    )
    got = readers.register_venues(rows, F.lit("unit"))
    tag = lambda k: F.col("tags")[k]
    return got.select("seq", "name", tag("amenity").alias("amenity"), tag("street_vendor").alias("vendor"), tag("shop").alias("shop"), "address", "lat")


@F.pandas_udf(T.BinaryType())
def _point(lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pd.Series([struct.pack("<BIdd", 1, 1, x, y) for x, y in zip(lon, lat, strict=True)])


def _square(w: float, s: float, e: float, n: float) -> bytearray:
    ring = [(w, s), (e, s), (e, n), (w, n), (w, s)]
    return bytearray(struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring))


_BOXES = [("West Nine", -0.4, 51.3, 0.0, 51.5), ("East Nine", -0.1, 51.4, 0.2, 51.6)]
_LEAVES = {"ECONOMY": "thai_restaurant", "SMALL": "coffee_shop", "MEDIUM": "bagel_shop", "PROMO": "steakhouse", "LARGE": "food_court"}


@query(f"""WITH v AS ({VENUES}), p AS (SELECT *, CASE kind {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LEAVES.items())} ELSE 'bistro_restaurant' END AS leaf FROM v
  WHERE seq % 10 / 10.0 >= 0.5 AND seq % 7 <> 0 AND seq % 11 <> 0), a(d, w, s, e, n) AS (VALUES {", ".join(map(str, _BOXES))})
SELECT p.seq, d AS district, CASE leaf WHEN 'coffee_shop' THEN 'cafe' WHEN 'food_court' THEN 'cafe' ELSE 'restaurant' END AS amenity,
  CASE leaf WHEN 'thai_restaurant' THEN 'thai' WHEN 'bagel_shop' THEN 'bagel' WHEN 'steakhouse' THEN 'steak_house' WHEN 'bistro_restaurant' THEN 'bistro' END AS cuisine, mail || '; b@k.test' AS email, site AS website, p.lat, p.lon
FROM p, a WHERE lon > w AND lon < e AND lat > s AND lat < n AND NOT (d = 'West Nine' AND lat < 51.35)""")
def catalogue_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's one SQL query: box, taxonomy, confidence, status, polygons and a clip box, then venue rows."""
    s = F.col("seq")
    leaf = F.lit("bistro_restaurant")
    for k, v in _LEAVES.items():
        leaf = F.when(F.col("kind") == k, v).otherwise(leaf)
    path = F.when(leaf == "food_court", F.array(F.lit("food_and_drink"), F.lit("casual_eatery"), leaf)).otherwise(F.array(F.lit("food_and_drink"), F.lit("restaurant"), leaf))
    path = F.when(s % 7 == 0, F.array(F.lit("retail"))).otherwise(path)
    strings = F.array().cast("array<string>")
    rows = _view(spark, sf_dir).select(
        s.cast("string").alias("id"), F.struct(F.col("name").alias("primary"), F.create_map(F.lit("en"), "name").alias("common")).alias("names"), F.struct(path.alias("hierarchy")).alias("taxonomy"), F.array("site").alias("websites"),
        F.array(F.col("mail"), F.lit("b@k.test")).alias("emails"), strings.alias("socials"), F.array("tel").alias("phones"), F.array(F.struct(F.lit("1 Road").alias("freeform"), F.col("pc").alias("postcode"))).alias("addresses"),
        ((s % 10) / 10).alias("confidence"), F.when(s % 11 == 0, "closed").when(s % 2 == 0, "open").alias("operating_status"), F.array(F.struct(F.lit("meta").alias("dataset"))).alias("sources"),
        F.struct(F.col("lon").alias("xmin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymin"), F.col("lat").alias("ymax")).alias("bbox"), _point("lon", "lat").alias("geometry"),
    )
    areas = [((n, {}), "GB", "GB", "county", (w, e, s_, t), _square(w, s_, e, t)) for n, w, s_, e, t in _BOXES] + [(("Elsewhere", {}), "GB", "FR", "county", (-1.0, 1.0, 51.0, 52.0), _square(-1, 51, 1, 52))]
    divisions = [{"subtype": "county", "name": "West Nine", "clip": {"south": 51.35, "north": 52, "west": -1, "east": 1}}, {"subtype": "county", "name": "East Nine"}]
    config = readers.CityConfig(bbox={"west": -1, "east": 1, "south": 51, "north": 52}, overture={"divisions": divisions, "country": "GB"})
    got = readers.catalogue(rows, spark.createDataFrame(areas, schemas.DIVISION), config)
    got = readers.catalogue_venues(got.withColumn("seq", F.col("id").cast("long")))
    return got.select("seq", F.col("borough").alias("district"), F.col("tags")["amenity"].alias("amenity"), F.col("tags")["cuisine"].alias("cuisine"), "email", "website", "lat", "lon")


@query(f"""SELECT seq, name AS label, CAST(printf('%.4f', lat) AS DOUBLE) AS lat, CAST(printf('%.4f', lon) AS DOUBLE) AS lon FROM ({VENUES}) v WHERE seq % 4 <> 3""")
def wikidata_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.format_string("Point(%.4f %.4f)", "lon", "lat")
    value = lambda c: F.struct(c.alias("value"))
    rows = _view(spark, sf_dir).select("seq", value(F.col("name")).alias("itemLabel"), value(F.col("site")).alias("site"), value(F.when(F.col("seq") % 4 == 3, "t123").otherwise(place)).alias("coord"))
    return readers.wikidata_points(rows).select("seq", "label", "lat", "lon")


@query(f"""WITH p AS (SELECT v.*, CASE WHEN seq % 13 = 0 THEN 'NOT A FOOD VENUE' WHEN seq % 17 = 0 THEN 'Permanently closed' WHEN seq % 19 = 0 THEN 'temporarily closed' ELSE '' END AS notes FROM ({VENUES}) v), {_OWN.replace(f"v AS ({VENUES})", "v AS (SELECT * FROM p)")}
SELECT seq, website, CASE WHEN website = '' AND url <> '' THEN url ELSE '' END AS social_website, split_part(tel, ';', 1) AS phone, CASE WHEN notes = 'temporarily closed' THEN 'temporarily closed (per partner); ' ELSE '' END || notes AS partner_notes,
  'list:x.csv#' || (seq + 2) AS osm_url, CASE WHEN borough = 'NATION_1' THEN 'One' ELSE borough END AS borough,
  CASE WHEN notes LIKE 'NOT%' THEN 'not a food venue' WHEN notes LIKE 'Perm%' THEN 'permanently closed' WHEN borough = 'NATION_3' THEN 'outside the area' ELSE '' END AS excluded FROM own""")
def partner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    notes = F.when(s % 13 == 0, "NOT A FOOD VENUE").when(s % 17 == 0, "Permanently closed").when(s % 19 == 0, "temporarily closed").otherwise("")
    blank = [F.lit("").alias(c) for c in ("instagram_handle", "instagram_url", "facebook_page", "facebook_url", "source_method")]
    rows = _view(spark, sf_dir).select(s.alias("line"), "name", F.col("borough").alias("district_label"), F.col("site").alias("website"), F.col("mail").alias("email"), F.concat("tel", F.lit("; 1")).alias("phone"), notes.alias("notes"), *blank)
    got = readers.partner_venues(rows, {"source": "list", "path": "a/x.csv", "exclude_districts": ["NATION_3"], "district_map": {"NATION_1": "One"}})
    return got.select(F.col("line").alias("seq"), "website", "social_website", "phone", "partner_notes", "osm_url", "borough", "excluded")


@query(f"""WITH v AS ({VENUES}), named AS (SELECT name, max(pc) AS pc FROM v WHERE pc <> '' GROUP BY name), w AS (SELECT v.*, replace(v.name, ' ', '') AS stem, list_filter(string_split(v.name, ' '), lambda x: length(x) >= 3 AND NOT list_contains({V.GENERIC}, x)) AS good FROM v WHERE site = '')
SELECT seq, CASE WHEN n.pc = w.pc OR (w.tel <> '' AND w.tel = '020 7100 0000') THEN 'https://' || stem || '.com/' ELSE '' END AS website,
  CASE WHEN n.pc = w.pc THEN 'postcode' WHEN w.tel <> '' AND w.tel = '020 7100 0000' THEN 'phone' ELSE '' END AS evidence FROM w JOIN named n USING (name) WHERE len(good) > 0 AND length(stem) BETWEEN 4 AND 40""")
def discovered_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites found by name: a page for each name shows the postcode of one of its branches, and a phone."""
    v = _view(spark, sf_dir)
    named = v.where("pc <> ''").groupBy("name").agg(F.max("pc").alias("pc"))
    stem = F.replace("name", F.lit(" "), F.lit(""))
    url = F.concat(F.lit("https://"), stem, F.lit(".com/"))
    page = F.concat(F.lit("<html><body><p>We are at "), "pc", F.lit("</p><p>tel 020 7100 0000</p></body></html>"))
    pages = named.select(url.alias("url"), url.alias("final_url"), F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("robots_allowed"), page.alias("html"))
    dns = named.select(F.concat(stem, F.lit(".com")).alias("host"), F.lit("yes").alias("status"))
    todo = venues(spark, sf_dir, kinds=True).join(named.select("name"), "name", "left_semi")
    # the view's e-mails and sites stay out of it
    todo = todo.join(v.where("site = ''").select("seq"), "seq", "left_semi").withColumn("area", F.lit(""))
    return enrich.discover(enrich.queue(todo), pages, dns).select("seq", "website", "evidence")


_TEXT = r"""regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g')"""


@query(rf"""WITH k AS (SELECT regexp_replace(regexp_replace(lower(regexp_extract(url, '^https?://([^?#]*)', 1)), '^www\.', ''), '/+$', '') AS key, min(url) AS url FROM pages GROUP BY 1),
t AS (SELECT key, url, html, {_TEXT} AS t FROM k JOIN (SELECT url, any_value(html) AS html FROM pages GROUP BY url) p USING (url)),
c AS (SELECT *, len(regexp_extract_all(regexp_replace(t, '&[a-z]+;', '', 'g'), '[A-Za-z]')) AS latin, len(regexp_extract_all(t, '[\x{{0E00}}-\x{{0E7F}}]')) AS thai, lower(regexp_extract(html, '(?i)<html[^>]{{0,300}}?\blang=["'']?([a-zA-Z-]{{2,10}})', 1)) AS lang,
  list_distinct(list_filter(list_transform(regexp_extract_all(html, '{V.EMAIL.replace("'", "''")}'), lambda x: lower(trim(x, '.'))), lambda x: NOT ({_JUNK} OR regexp_matches(x, '{V.NOT_FOR_CONTACT}')))) AS found,
  CASE WHEN regexp_matches(t, '{V.PARKED_PAGE}') AND len(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) < 400 THEN 'parked' WHEN regexp_matches(t, '(?i)permanently closed|closed permanently|closed for good|has now closed|have now closed|ceased trading|no longer trading|closed down') THEN 'closed' ELSE 'ok' END AS status FROM t)
SELECT key, CASE WHEN status = 'ok' THEN array_to_string(found, '; ') ELSE '' END AS emails, status, url AS final_url, CASE WHEN status <> 'ok' THEN '' WHEN latin + thai > 0 AND (latin / (latin + thai) >= 0.85 OR (starts_with(lang, 'en') AND latin / (latin + thai) >= 0.6)) THEN 'English'
  WHEN latin + thai > 0 AND latin / (latin + thai) >= 0.3 OR regexp_matches(html, '(?i)hreflang=["'']?en') THEN 'Bilingual' ELSE 'Local' END AS lang FROM c""")
def crawl_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl records over the stored pages."""
    p = _table(spark, sf_dir, "pages")
    stored = p.select("url", F.col("url").alias("final_url"), F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("robots_allowed"), "html")
    got = enrich.crawl(p.select(F.col("url").alias("website")), stored)
    return got.select("key", F.array_join("emails", "; ").alias("emails"), "status", "final_url", "lang")


def _records() -> tuple[Column, Column]:
    """(number, JSON line) of each event as a crawl record."""
    e, k = F.col("event_id"), F.col("user_id")
    record = F.struct(
        F.concat(F.when(k % 3 == 0, "u/").otherwise("u"), k.cast("string")).alias("key"), F.when(e % 2 == 0, F.array(F.lit("a@k.test"))).otherwise(F.array().cast("array<string>")).alias("emails"),
        F.when(e % 5 == 0, "unknown").when(e % 5 == 1, "dead").otherwise("ok").alias("status"), F.lit("").alias("final_url"), F.lit("").alias("lang"), (e % 4 + 1).cast("int").alias("v"), e.alias("pos"),
    )
    return e, F.to_json(record)


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'dead' ELSE 'ok' END AS status, event_id % 4 + 1 AS v FROM events) x
  WHERE event_id % 7 <> 0 AND (v >= 3 OR status = 'dead' OR (status = 'ok' AND event_id % 2 = 0)) AND NOT (status = 'dead' AND user_id % 3 = 0 AND v < 4))
SELECT CASE WHEN user_id % 3 = 0 THEN 'u/' ELSE 'u' END || user_id AS key, event_id AS pos, status FROM e WHERE n = 1""")
def log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl log written as JSON lines, one in seven cut short, and read again: fresh records, the last of each key."""
    ship(spark)
    e, line = _records()
    path = f"{Scratch(spark, 'replay').base}/log"
    _table(spark, sf_dir, "events").select(F.when(e % 7 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    rows = readers.fresh_crawls(readers.read_log(spark, path, schemas.CRAWL_LOG))
    return readers.last_wins(rows, "key").select("key", "pos", "status")


@query()
def log_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log, followed as a stream of files: bases and deltas merged on read, the last record of each key."""
    ship(spark)
    _, line = _records()
    base = Scratch(spark, "follow").base
    files = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    _table(spark, sf_dir, "events").repartition(files, "event_id").select(line.alias("value")).write.text(f"{base}/in")
    logs.follow(spark, f"{base}/in", schemas.CRAWL_LOG, f"{base}/log", f"{base}/state", files=-(-files // 3)).awaitTermination()
    return logs.current(spark, f"{base}/log").select("key", "pos", "status", "v")


@query(f"""WITH v AS ({VENUES}), e AS (SELECT seq, unnest([mail, 'second' || seq % 30 || '@redwidget.test', 'third' || seq % 50 || '@gmail.com']) AS e, unnest([1, 2, 3]) AS i FROM v),
g AS (SELECT seq, list(e ORDER BY i) AS good FROM e WHERE e <> '' AND split_part(e, '@', 2) NOT IN ('brand1.test', 'brand2.test', 'redwidget.test') GROUP BY seq),
n AS (SELECT *, row_number() OVER (PARTITION BY good[1] ORDER BY seq) AS n FROM g) SELECT seq AS pos, good[1] AS email, array_to_string(good[2:], '; ') AS other_emails FROM n WHERE n = 1""")
def revalidated_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written e-mail relation checked again: the first address that is still valid, each once."""
    more = F.concat(F.lit("second"), (F.col("seq") % 30).cast("string"), F.lit("@redwidget.test; third"), (F.col("seq") % 50).cast("string"), F.lit("@gmail.com"))
    rows = _view(spark, sf_dir).select(F.col("seq").alias("pos"), F.col("mail").alias("email"), more.alias("other_emails"))
    mx = spark.createDataFrame([("brand1.test", "no_mx"), ("brand2.test", "null_mx"), ("redwidget.test", "no_domain"), ("gmail.com", "ok")], "domain string, status string")
    return joins.revalidate(rows, mx)


_COLLECTED = f"""WITH RECURSIVE {_OWN}, r AS (SELECT *, lower(name) AS g, row_number() OVER (PARTITION BY lower(name) ORDER BY seq) AS i, 'a' || CASE WHEN pc = '' THEN 'road ' || seq % 9 ELSE lower(pc) END || '|' || lower(site) AS a,
  CASE WHEN lat <> 0 AND lon <> 0 THEN 'b' || {_DECIMALS.format("lat")} || ':' || {_DECIMALS.format("lon")} ELSE 'none' || seq END AS b FROM own WHERE seq % 10 <> 9),
f(g, i, seq, kept, seen) AS (
  SELECT g, i, seq, true, [a, b] FROM r WHERE i = 1
  UNION ALL SELECT r.g, r.i, r.seq, NOT list_has_any(f.seen, [r.a, r.b]), CASE WHEN list_has_any(f.seen, [r.a, r.b]) THEN f.seen ELSE list_concat(f.seen, [r.a, r.b]) END FROM f JOIN r ON r.g = f.g AND r.i = f.i + 1),
open AS (SELECT r.* FROM r JOIN f USING (seq) WHERE kept),
domains AS (SELECT replace(name, ' ', '') AS slug, regexp_replace(regexp_extract(lower(website), '^https?://([^/?#]*)', 1), '^www\\.', '') AS d, count(*) AS n FROM open WHERE website <> '' GROUP BY 1, 2),
chains AS (SELECT slug, arg_max(d, n) AS d FROM domains GROUP BY slug HAVING sum(n) >= 3 AND max(n) / sum(n) >= 0.8),
live AS (SELECT o.* REPLACE (CASE WHEN website = '' AND d IS NOT NULL THEN 'https://' || d || '/' ELSE website END AS website) FROM open o LEFT JOIN chains ON replace(name, ' ', '') = slug)"""


def _borough_job(spark: SparkSession, sf_dir: str) -> jobs.Run:
    elements = Scratch(spark, "elements").put(_elements(spark, sf_dir))  # as a job reads them from files
    got = jobs.collect_boroughs(elements, None, "2024-06-30")
    mx = spark.createDataFrame([("brand1.test", "no_mx"), ("redwidget.test", "null_mx"), ("gmail.com", "ok")], "domain string, status string")
    nation = _table(spark, sf_dir, "nation")
    areas = readers.area_rows(nation.select((F.col("n_nationkey") * 2).cast("long").alias("ord"), F.col("n_name").alias("borough"), F.lit("Alder (also Aldy)").alias("area"), F.lit("").alias("post_town"), F.lit("e1, e2").alias("districts")))
    places = spark.createDataFrame([(0, "Aldy", 51.5, -0.1)], "ord long, name string, lat double, lon double")
    return jobs.borough_run(got, areas, places, mx)


@query(f"""{_COLLECTED}, s AS (SELECT *, row_number() OVER (PARTITION BY {_KEY.format("website")} ORDER BY borough, lower(name), seq) AS n, count(*) OVER (PARTITION BY {_KEY.format("website")}) AS locations FROM live WHERE website <> '')
SELECT seq, website, borough, locations FROM s WHERE n = 1""")
def borough_job_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over boroughs from map elements to one row per site."""
    return _borough_job(spark, sf_dir).sites.select("seq", "website", "borough", "locations")


@query(f"""{_COLLECTED}, s AS (SELECT *, row_number() OVER (PARTITION BY mail ORDER BY borough, lower(name), seq) AS n, count(*) OVER (PARTITION BY mail) AS locations FROM live WHERE mail <> '' AND split_part(mail, '@', 2) NOT IN ('brand1.test', 'redwidget.test'))
SELECT mail AS email, name, borough, 'Alder (also Aldy)' AS area, CASE WHEN website = '' THEN NULL ELSE website END AS website, 'openstreetmap' AS email_source, CAST(locations AS VARCHAR) AS locations FROM s WHERE n = 1""")
def borough_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's e-mail list written as CSV, a folder for each borough, and read again."""
    run = _borough_job(spark, sf_dir)
    path = f"{Scratch(spark, 'files').base}/emails"
    relations.write_csv(relations.layout(run.emails, "borough_emails"), path, by="borough")
    return readers.read_table(spark, path).select("email", "name", "borough", "area", "website", "email_source", "locations")


@query(f"""{_COLLECTED}, m AS (SELECT mail, min_by(borough, struct_pack(b := borough, n := lower(name), s := seq)) AS borough FROM live WHERE mail <> '' AND split_part(mail, '@', 2) NOT IN ('brand1.test', 'redwidget.test') GROUP BY mail),
w AS (SELECT min_by(borough, struct_pack(b := borough, n := lower(name), s := seq)) AS borough FROM live WHERE website <> '' GROUP BY {_KEY.format("website")}),
b AS (SELECT DISTINCT borough FROM live) SELECT borough, 'Alder (also Aldy)' AS area, (SELECT count(*) FROM m WHERE m.borough = b.borough) AS emails, (SELECT count(*) FROM w WHERE w.borough = b.borough) AS websites FROM b""")
def borough_job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _borough_job(spark, sf_dir).summary


@query(f"""{_COLLECTED}, e AS (SELECT CASE WHEN split_part(mail, '@', 2) = 'brand1.test' THEN 'no_mx' ELSE 'null_mx' END AS reason FROM live WHERE split_part(mail, '@', 2) IN ('brand1.test', 'redwidget.test'))
SELECT reason, count(*) AS n FROM e GROUP BY reason""")
def borough_job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.reject_reasons(_borough_job(spark, sf_dir).rejected)


@query(f"""WITH v AS (SELECT *, {_CATS} AS cats FROM ({VENUES}) x), r AS (SELECT *, CASE seq % 4 WHEN 0 THEN 'Sushi House' WHEN 1 THEN 'Old Bakery Diner' WHEN 2 THEN 'Brasserie Élan' ELSE '' END AS n FROM v)
SELECT seq, array_to_string(list_sort(list_distinct(list_concat(list_filter(cats, lambda x: x NOT IN ('Cafe', 'Takeaway', 'Restaurant') OR n = ''), CASE seq % 4 WHEN 0 THEN ['Sushi'] WHEN 1 THEN ['American', 'Bakery'] WHEN 2 THEN ['French'] ELSE [] END))), '; ') AS categories FROM r""")
def categorize_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by cuisine, amenity and name; the default only where nothing else is known."""
    s = F.col("seq") % 4
    name = F.when(s == 0, "Sushi House").when(s == 1, "Old Bakery Diner").when(s == 2, "Brasserie Élan").otherwise("")
    tags = F.create_map(F.lit("cuisine"), "cuisine", F.lit("amenity"), "amenity")
    return _view(spark, sf_dir).select("seq", F.array_join(text.categorize(tags, name), "; ").alias("categories"))


_CITY = f"""{_COLLECTED}, rated AS (SELECT *, CASE WHEN kind IN ('ECONOMY', 'MEDIUM') OR seq % 10 = 8 OR amenity = 'pub' THEN 3 ELSE 1 END AS score FROM live),
mails AS (SELECT *, row_number() OVER (PARTITION BY mail ORDER BY score DESC, borough, lower(name), seq) AS n, count(*) OVER (PARTITION BY mail) AS locations FROM rated WHERE mail <> '' AND split_part(mail, '@', 2) NOT IN ('brand1.test', 'redwidget.test')),
sites AS (SELECT *, row_number() OVER (PARTITION BY {_KEY.format("website")} ORDER BY score DESC, borough, lower(name), seq) AS n, count(*) OVER (PARTITION BY {_KEY.format("website")}) AS locations FROM rated WHERE website <> '')"""


def _city_job(spark: SparkSession, sf_dir: str) -> jobs.Run:
    elements = Scratch(spark, "elements").put(_elements(spark, sf_dir))
    config = readers.CityConfig(slug="town", country_code="44", english_priority=True)
    got, _ = jobs.collect_city(elements, config, "2024-06-30")
    mx = spark.createDataFrame([("brand1.test", "no_mx"), ("redwidget.test", "null_mx"), ("gmail.com", "ok")], "domain string, status string")
    return jobs.city_run(got, config, mx)


@query(f"""{_CITY}
SELECT seq, website, borough AS district, CAST(score AS INTEGER) AS english_score, CASE WHEN score >= 2 THEN 'Medium' ELSE 'Low' END AS english_priority, locations FROM sites WHERE n = 1""")
def city_job_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over a city from map elements to one row per site, the best rated venue of each."""
    return _city_job(spark, sf_dir).sites.select("seq", "website", F.col("borough").alias("district"), "english_score", "english_priority", "locations")


@query(f"""{_CITY} SELECT borough AS district, count(*) AS venues, (SELECT count(*) FROM mails m WHERE n = 1 AND m.borough = r.borough) AS emails, (SELECT count(*) FROM sites s WHERE n = 1 AND s.borough = r.borough) AS websites,
CAST(0 AS BIGINT) AS high_priority_emails, CAST(0 AS BIGINT) AS high_priority_websites FROM rated r GROUP BY borough""")
def city_job_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts of the city job; no site has been read, so none is rated high."""
    return _city_job(spark, sf_dir).summary


@query(f"""{_CITY} SELECT mail AS email, name, borough AS district, CAST(score AS VARCHAR) AS english_score, CASE WHEN website = '' THEN NULL ELSE website END AS website, CAST(locations AS VARCHAR) AS locations FROM mails WHERE n = 1""")
def city_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city job's e-mail list written as CSV, a folder for each district, and read again."""
    path = f"{Scratch(spark, 'files').base}/emails"
    relations.write_csv(relations.layout(_city_job(spark, sf_dir).emails, "city_emails"), path, by="district")
    return readers.read_table(spark, path).select("email", "name", "district", "english_score", "website", "locations")


@query(f"""{_CITY} SELECT mail AS email, CASE WHEN split_part(mail, '@', 2) = 'brand1.test' THEN 'no_mx' ELSE 'null_mx' END AS reason, name, borough AS district FROM rated WHERE split_part(mail, '@', 2) IN ('brand1.test', 'redwidget.test')""")
def city_job_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of rejected addresses of the city job, in the layout of its file."""
    return relations.layout(_city_job(spark, sf_dir).rejected, "rejected")
