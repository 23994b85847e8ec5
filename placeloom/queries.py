"""Queries over the driver's tables: each applies operators of the library, most with an equivalent in SQL.

The tables hold no venues, so a deterministic view makes venues of ``part`` and ``nation``; see ``VENUES``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo, pages, text
from .functions import values as V
from .operators import enrich, joins, relations, resolve
from .operators.predicates import is_closed, wanted
from .plans.scratch import Scratch, measured, ship
from .sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Venues as SQL that both engines run.
VENUES = """
SELECT p_partkey AS seq, p_name AS name, n_name AS borough, p_type AS kind, p_partkey % 25 AS unit,
  51.28 + ((p_partkey * 7919) % 4200) / CAST(10000.0 AS DOUBLE) AS lat, -0.52 + ((p_partkey * 104729) % 8600) / CAST(10000.0 AS DOUBLE) AS lon,
  CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat('https://www.', lower(replace(p_brand, '#', '')), '.test/Menu?x=1') WHEN 2 THEN concat('http://', replace(p_name, ' ', ''), '.test/')
    WHEN 3 THEN concat('https://', replace(p_name, ' ', ''), '.test/#top') WHEN 4 THEN concat('facebook.com/', lower(replace(p_brand, '#', ''))) ELSE concat('//', replace(p_name, ' ', '-'), '.co.test') END AS site,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat('info@', lower(replace(p_brand, '#', '')), '.test') WHEN 2 THEN concat('x', CAST(p_partkey % 40 AS VARCHAR(9)), '.y@gmail.com')
    WHEN 3 THEN concat('press@', replace(p_name, ' ', ''), '.test') ELSE concat('bookings@', replace(p_name, ' ', ''), '.test') END AS mail,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('020 7', CAST(100 + p_partkey % 700 AS VARCHAR(9)), ' 0000') END AS tel,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('E', CAST(p_partkey % 18 + 1 AS VARCHAR(9)), CASE WHEN p_partkey % 4 = 0 THEN 'W' ELSE '' END, ' ', CAST(p_partkey % 9 AS VARCHAR(9)), 'AB') END AS pc,
  CASE p_type WHEN 'ECONOMY' THEN 'pizza; italian' WHEN 'SMALL' THEN 'sushi' WHEN 'MEDIUM' THEN 'burger' WHEN 'PROMO' THEN 'Fish_and_chips,fish' WHEN 'LARGE' THEN 'curry' ELSE '' END AS cuisine,
  CASE p_partkey % 4 WHEN 0 THEN 'cafe' WHEN 1 THEN 'pub' WHEN 2 THEN 'fast_food' ELSE 'restaurant' END AS amenity
FROM part JOIN nation ON p_partkey % 25 = n_nationkey
"""
_SITE = """CASE WHEN site = '' THEN '' WHEN regexp_matches(site, '(?i)^https?://') THEN site ELSE 'https://' || regexp_replace(site, '^/+', '') END"""
_HOST = "regexp_replace(regexp_extract(lower({0}), '^https?://([^/?#:]*)', 1), '^www\\.', '')"
_KEY = "regexp_replace(regexp_replace(regexp_replace(lower({0}), '^https?://(www\\.)?', ''), '[?#].*$', '', 's'), '/+$', '')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(measured(spark))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out first: a file of a million short rows is one piece or two for Spark, and what is made of a row takes long."""
    part = _table(spark, sf_dir, "part").repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")
    return spark.sql(VENUES.replace("FROM part JOIN nation", "FROM {part} AS part JOIN {nation} AS nation"), part=part, nation=_table(spark, sf_dir, "nation"))


def venues(spark: SparkSession, sf_dir: str, kinds: bool = False) -> DataFrame:
    """The view as venue rows, contacts split; with ``kinds`` their categories too, which take longer than all else.

    Written, as the expressions are long and most plans read the rows several times.
    """
    v = _view(spark, sf_dir)
    tags = F.create_map(F.lit("cuisine"), "cuisine", F.lit("amenity"), "amenity", F.lit("name"), "name")
    given = [F.col("mail").alias("email"), F.col("site").alias("website"), F.col("tel").alias("phone"), F.col("pc").alias("postcode")]
    fixed = [F.lit("openstreetmap").alias("source"), F.lit(True).alias("latin_name")]
    rows = readers.venue_rows(v.select("seq", "borough", "name", "lat", "lon", tags.alias("tags"), *given, *fixed))
    if kinds:
        rows = rows.withColumn("categories", text.categorize(F.col("tags"), F.col("name")))
    return Scratch(spark, "venues").put(relations.split_contacts(rows))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _joined(c: Column) -> Column:
    return F.array_join(c, "; ")


@query(f"""WITH k AS (SELECT page_id, url, {_KEY.format("url")} AS site_key FROM pages)
SELECT site_key, min(page_id) AS page_id, count(*) AS locations FROM k GROUP BY site_key""")
def site_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "pages").select("page_id", text.site_key(F.col("url")).alias("site_key"))
    return resolve.unique_rows(rows, F.col("site_key"), [F.col("page_id")]).select("site_key", "page_id", "locations")


@query(f"""WITH h AS (SELECT seq, {_HOST.format(_SITE)} AS host FROM ({VENUES}) v), p AS (SELECT *, string_split(host, '.') AS parts FROM h)
SELECT seq, host, CASE WHEN len(parts) > 2 AND parts[len(parts) - 1] IN ('co', 'org', 'ac', 'com') THEN array_to_string(parts[len(parts) - 2:], '.') ELSE array_to_string(parts[greatest(len(parts) - 1, 1):], '.') END AS root,
  list_has_any(parts, ['facebook', 'deliveroo', 'instagram']) AS other_site FROM p""")
def url_host_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = text.normalize_url(F.col("site"))
    return _view(spark, sf_dir).select("seq", text.host(F.col("site")).alias("host"), text.site_root(site).alias("root"), text.not_venue_site(F.col("site")).alias("other_site"))


@query(r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages)
SELECT page_id, CAST(length(t) AS INTEGER) AS chars, CAST(len(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) AS INTEGER) AS words FROM t""")
def visible_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "pages").select("page_id", pages.without_tags(F.col("html")).alias("t"))
    return rows.select("page_id", F.length("t").alias("chars"), F.size(F.filter(F.split("t", r"\s+"), lambda x: x != "")).alias("words"))


@query(r"""WITH t AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages),
c AS (SELECT page_id, html, len(regexp_extract_all(regexp_replace(t, '&[a-z]+;', '', 'g'), '[A-Za-z]')) AS latin, len(regexp_extract_all(t, '[\x{0E00}-\x{0E7F}]')) AS thai, lower(regexp_extract(html, '(?i)<html[^>]{0,300}?\blang=["'']?([a-zA-Z-]{2,10})', 1)) AS lang FROM t)
SELECT page_id, CASE WHEN latin + thai > 0 AND (latin / (latin + thai) >= 0.85 OR (starts_with(lang, 'en') AND latin / (latin + thai) >= 0.6)) THEN 'English' WHEN latin + thai > 0 AND latin / (latin + thai) >= 0.3 OR regexp_matches(html, '(?i)hreflang=["'']?en') THEN 'Bilingual' ELSE 'Local' END AS language FROM c""")
def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", pages.page_language(F.col("html")).alias("language"))


@query(r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages)
SELECT page_id, CASE WHEN regexp_matches(t, '(?i)domain (is |may be )?for sale|buy this domain|this domain has expired|domain parking|parked free|is parked|hugedomains|sedo\.com|dan\.com/buy') AND len(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) < 400 THEN 'parked'
  WHEN regexp_matches(t, '(?i)permanently closed|closed permanently|closed for good|has now closed|have now closed|ceased trading|no longer trading|closed down') THEN 'closed' ELSE 'ok' END AS status FROM t""")
def site_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", pages.site_status(pages.visible_text(F.col("html"))).alias("status"))


@query(f"""SELECT doc_id, array_to_string(regexp_extract_all(text, '{V.EMAIL.replace("'", "''")}'), '; ') AS emails FROM documents WHERE regexp_matches(text, '{V.EMAIL.replace("'", "''")}')""")
def raw_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit("(" + V.EMAIL + ")"), F.lit(1))
    return _table(spark, sf_dir, "documents").where(F.col("text").rlike(V.EMAIL)).select("doc_id", _joined(found).alias("emails"))


_JUNK = " OR ".join([f"contains(x, '{j}')" for j in V.JUNK_PARTS] + [f"ends_with(x, '{e}')" for e in V.JUNK_ENDS])


@query(f"""WITH e AS (SELECT doc_id, text, list_distinct(list_filter(list_transform(regexp_extract_all(text, '{V.EMAIL.replace("'", "''")}'), lambda x: lower(trim(x, '.'))), lambda x: NOT ({_JUNK} OR regexp_matches(x, '{V.NOT_FOR_CONTACT}')))) AS found FROM documents)
SELECT doc_id, array_to_string(found, '; ') AS emails FROM e WHERE contains(text, '@') OR len(found) > 0""")
def clean_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of texts after cleaning, hidden ones too; those under example domains all go, their texts stay."""
    found = _table(spark, sf_dir, "documents").select("doc_id", "text", _joined(pages.page_emails(F.col("text"))).alias("emails"))
    return found.where(F.contains("text", F.lit("@")) | (F.col("emails") != "")).select("doc_id", "emails")


@query("""SELECT p_partkey, 'info@' || replace(p_name, ' ', '') || '.test; hello@' || lower(replace(p_brand, '#', '')) || '.test' AS emails FROM part""")
def deobfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = F.concat(F.lit("write to info [at] "), F.replace("p_name", F.lit(" "), F.lit("")), F.lit(" [dot] test, or hello at "), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit(" dot test"))
    return _table(spark, sf_dir, "part").select("p_partkey", _joined(pages.page_emails(hidden)).alias("emails"))


_LINK = V.LINK.replace("'", "''")


@query(rf"""WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root, url, regexp_extract_all(html, '{_LINK}', 1) AS hrefs, regexp_extract_all(html, '{_LINK}', 2) AS labels FROM pages),
h AS (SELECT page_id, url, list_transform(list_filter(range(1, len(hrefs) + 1), lambda i: starts_with(hrefs[i], '/') AND (regexp_matches(hrefs[i], '{V.CONTACT_HINT}') OR regexp_matches(regexp_replace(labels[i], '<[^>]+>', '', 'g'), '{V.CONTACT_HINT}'))), lambda i: root || replace(hrefs[i], '&amp;', '&')) AS found FROM l),
d AS (SELECT page_id, list_filter(found, lambda x: rtrim(x, '/') <> rtrim(url, '/')) AS f FROM h)
SELECT page_id, array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i)[1:4], '; ') AS links FROM d""")
def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", _joined(pages.contact_links(F.col("html"), F.col("url"))).alias("links"))


@query(f"""SELECT seq, CASE WHEN length(d) >= 8 THEN d ELSE '' END AS phone FROM (SELECT seq, regexp_replace(d0, '^02', '0') AS d FROM (SELECT seq, regexp_replace(tel, '[^0-9]', '', 'g') AS d1, CASE WHEN starts_with(d1, '02') THEN '0' || d1[3:] ELSE d1 END AS d0 FROM ({VENUES}) v) x) y""".replace("regexp_replace(d0, '^02', '0') AS d", "d0 AS d"))
def phone_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir).select("seq", text.phone_key(F.col("tel"), "02").alias("phone"))


_CATS = """list_sort(list_distinct(list_filter([CASE WHEN kind = 'ECONOMY' THEN 'Pizza' END, CASE WHEN kind = 'ECONOMY' THEN 'Italian' END, CASE WHEN kind = 'SMALL' THEN 'Sushi' END, CASE WHEN kind = 'SMALL' THEN 'Asian' END,
  CASE WHEN kind = 'MEDIUM' THEN 'Burger' END, CASE WHEN kind = 'PROMO' THEN 'Seafood' END, CASE WHEN kind = 'LARGE' THEN 'Indian' END, CASE WHEN amenity = 'pub' THEN 'Pub' END,
  CASE WHEN kind = 'STANDARD' AND amenity = 'cafe' THEN 'Cafe' WHEN kind = 'STANDARD' AND amenity = 'fast_food' THEN 'Takeaway' WHEN kind = 'STANDARD' AND amenity = 'restaurant' THEN 'Restaurant' END], lambda x: x IS NOT NULL)))"""


@query(f"SELECT seq, array_to_string({_CATS}, '; ') AS categories FROM ({VENUES}) v")
def categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.create_map(F.lit("cuisine"), "cuisine", F.lit("amenity"), "amenity")
    return _view(spark, sf_dir).select("seq", _joined(text.categorize(tags, F.col("name"))).alias("categories"))


@query(f"""WITH c AS (SELECT seq, {_CATS} AS cats, CASE seq % 3 WHEN 0 THEN 'English' WHEN 1 THEN 'Bilingual' ELSE 'Local' END AS lang, seq % 2 = 0 AS latin FROM ({VENUES}) v),
w AS (SELECT *, list_filter(cats, lambda x: x IN ('Burger', 'Pizza', 'Italian', 'Pub')) AS west FROM c),
s AS (SELECT *, CASE lang WHEN 'English' THEN 3 WHEN 'Bilingual' THEN 2 ELSE 0 END + CASE WHEN len(west) > 0 THEN 2 ELSE 0 END + CASE WHEN latin THEN 1 ELSE 0 END AS score FROM w)
SELECT seq, CAST(score AS INTEGER) AS english_score, CASE WHEN score >= 4 THEN 'High' WHEN score >= 2 THEN 'Medium' ELSE 'Low' END AS english_priority, CASE WHEN score >= 3 THEN 'yes' ELSE 'no' END AS english,
  concat_ws('; ', CASE lang WHEN 'English' THEN 'website in English' WHEN 'Bilingual' THEN 'website has English' END, CASE WHEN len(west) > 0 THEN 'Western food (' || array_to_string(west, ', ') || ')' END, CASE WHEN latin THEN 'English/Latin-script name' END) AS why FROM s""")
def score_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.create_map(F.lit("cuisine"), "cuisine", F.lit("amenity"), "amenity")
    lang = F.when(F.col("seq") % 3 == 0, "English").when(F.col("seq") % 3 == 1, "Bilingual").otherwise("Local")
    told = text.english(lang, text.categorize(tags, F.col("name")), F.col("seq") % 2 == 0)
    return _view(spark, sf_dir).select("seq", *[c.alias(n) for n, c in told.items()])


@query(f"""WITH v AS ({VENUES}), k AS (SELECT seq, borough, substr(regexp_replace(name, '[^a-z0-9]', '', 'g'), 1, 12) AS n, replace(pc, ' ', '') AS p FROM v)
SELECT seq FROM k r WHERE seq % 2 = 1 AND NOT EXISTS (SELECT 1 FROM k m WHERE m.seq % 2 = 0 AND m.p <> '' AND m.borough = r.borough AND m.n = r.n AND m.p = r.p)""")
def anti_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir).withColumnRenamed("pc", "postcode")
    return joins.not_on_map(v.where("seq % 2 = 1"), v.where("seq % 2 = 0")).select("seq")


CENTERS = {"North": [51.6, -0.1], "East": [51.51, 0.1], "South": [51.38, -0.1], "West": [51.5, -0.35], "Centre": [51.51, -0.13]}
_CENTERS = ", ".join(f"({i}, '{n}', {y}, {x})" for i, (n, (y, x)) in enumerate(CENTERS.items()))


@query(f"""WITH v AS ({VENUES}), c(i, n, y, x) AS (VALUES {_CENTERS}),
d AS (SELECT seq, n, row_number() OVER (PARTITION BY seq ORDER BY (y - lat) * (y - lat) + ((x - lon) * cos(radians(lat))) * ((x - lon) * cos(radians(lat))), i) AS r FROM v, c)
SELECT seq, n AS area FROM d WHERE r = 1""")
def nearest_sub_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.label_sub_areas(readers.venue_rows(_view(spark, sf_dir)), CENTERS).select("seq", "area")


#: Areas of every borough: ord, name, place, postcode districts. The last has no place.
_AREAS = [(0, "Alder", 51.4, -0.3, "E1,E2,E3W"), (1, "Birch", 51.6, 0.1, "E4,E5"), (2, "Cedar", 51.5, -0.1, "E1,E9"), (3, "Dogwood", None, None, "E7,E9")]


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(_AREAS, "i int, area string, lat double, lon double, d string")
    n = _table(spark, sf_dir, "nation").where("n_nationkey < 20")
    return n.select("n_nationkey", F.col("n_name").alias("borough")).crossJoin(F.broadcast(rows)).select((F.col("n_nationkey") * 10 + F.col("i")).alias("ord"), "borough", "area", "lat", "lon", F.split("d", ",").alias("districts"))


_AREA_SQL = f"""a AS (SELECT n_nationkey * 10 + i AS ord, n_name AS ab, area, y, x, ds FROM nation, (VALUES {", ".join(f"({i}, '{n}', CAST({'NULL' if y is None else y} AS DOUBLE), CAST({'NULL' if x is None else x} AS DOUBLE), {d.split(',')})" for i, n, y, x, d in _AREAS)}) t(i, area, y, x, ds) WHERE n_nationkey < 20),
o AS (SELECT seq, borough, lat, lon, split_part(pc, ' ', 1) AS raw FROM v),
p AS (SELECT seq, lat, lon, a.*, raw <> '' AND list_has_any(ds, [raw, regexp_replace(raw, '^(E[0-9]+)[A-Z]$', '\\1')]) AS isin FROM o JOIN a ON ab = borough),
q AS (SELECT *, sqrt((y - lat) * (y - lat) + ((x - lon) * cos(radians(y))) * ((x - lon) * cos(radians(y)))) AS d FROM p),
g AS (SELECT seq, bool_or(isin) AS hit, arg_min(area, d) FILTER (WHERE isin AND y IS NOT NULL) AS near_in, arg_min(area, d) FILTER (WHERE y IS NOT NULL) AS near, string_agg(area, ' / ' ORDER BY area) FILTER (WHERE isin) AS names FROM q GROUP BY seq),
assigned AS (SELECT v.seq, CASE WHEN hit THEN coalesce(near_in, names) ELSE coalesce(near, '') END AS area FROM v LEFT JOIN g USING (seq))"""


@query(f"WITH v AS ({VENUES}), {_AREA_SQL} SELECT seq, area FROM assigned")
def area_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = readers.venue_rows(_view(spark, sf_dir).withColumnRenamed("pc", "postcode"))
    return joins.assign_areas(v, _areas(spark, sf_dir)).select("seq", "area")


def area_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``area_assign``, with the nearest found by descent in every borough."""
    v = readers.venue_rows(_view(spark, sf_dir).withColumnRenamed("pc", "postcode"))
    return joins.assign_areas(v, _areas(spark, sf_dir), few=0).select("seq", "area")


QUERIES["area_search"], ORACLES["area_search"] = area_search, ORACLES["area_assign"]


@query(f"SELECT borough, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM ({VENUES}) v WHERE lat <> 0 AND lon <> 0 GROUP BY borough")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.centroids(_view(spark, sf_dir)).select("borough", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


_OWN = f"""v AS ({VENUES}), urls AS (SELECT *, {_SITE} AS url FROM v), own AS (SELECT *, CASE WHEN url = '' OR regexp_matches(url, 'facebook') THEN '' ELSE url END AS website FROM urls)"""


@query(f"""WITH {_OWN}, n AS (SELECT replace(name, ' ', '') AS slug, regexp_replace(regexp_extract(lower(website), '^https?://([^/?#]*)', 1), '^www\\.', '') AS d, count(*) AS n FROM own WHERE website <> '' GROUP BY 1, 2),
t AS (SELECT slug, sum(n) AS total, max(n) AS top, arg_max(d, n) AS d FROM n GROUP BY slug HAVING sum(n) >= 3 AND max(n) / sum(n) >= 0.5)
SELECT seq, 'https://' || t.d || '/' AS website, 'chain site (same name as ' || CAST(CAST(total AS BIGINT) AS VARCHAR) || ' mapped branches)' AS website_type FROM own JOIN t ON replace(name, ' ', '') = slug WHERE website = ''""")
def brand_site_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.add_brand_sites(venues(spark, sf_dir), agreement=0.5).where(F.col("website_type").startswith("chain")).select("seq", "website", "website_type")


_LABEL = "CASE seq % 3 WHEN 0 THEN concat('The ', name) WHEN 1 THEN name ELSE 'Else' END"


@query(f"""WITH v AS (SELECT *, replace(name, ' ', '') AS f FROM ({VENUES}) x), i AS (SELECT seq AS iseq, lat + 0.001 AS lat, lon, replace(lower({_LABEL}), ' ', '') AS f FROM v WHERE seq % 4 <> 0)
SELECT r.seq AS seq, min(x.iseq) AS item FROM v r JOIN i x ON abs(x.lat - r.lat) < 0.01 WHERE (x.f = r.f OR (length(r.f) >= 4 AND contains(x.f, r.f)) OR (length(x.f) >= 4 AND contains(r.f, x.f)))
  AND sqrt((x.lat - r.lat) * (x.lat - r.lat) + ((x.lon - r.lon) * cos(radians(x.lat))) * ((x.lon - r.lon) * cos(radians(x.lat)))) * 111320 <= 200 GROUP BY r.seq""")
def range_join_200m(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir)
    items = v.where("seq % 4 <> 0").select("seq", F.expr(_LABEL).alias("label"), F.concat(F.lit("https://item.test/"), F.col("seq").cast("string")).alias("site"), (F.col("lat") + F.lit(0.001)).alias("lat"), "lon")
    got = joins.add_wikidata(readers.venue_rows(v.drop("site")), items).where("website <> ''")
    return got.select("seq", F.substring_index("website", "/", -1).cast("long").alias("item"))


@query(f"""WITH v AS ({VENUES}), c AS (SELECT seq, CAST(round_even(lat * 200, 0) AS BIGINT) AS cy, CAST(round_even(lon * 200, 0) AS BIGINT) AS cx FROM v)
SELECT a.seq, count(*) AS candidates FROM c a JOIN c b ON abs(a.cy - b.cy) <= 1 AND abs(a.cx - b.cx) <= 1 AND b.seq < a.seq GROUP BY a.seq""")
def grid_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _view(spark, sf_dir).select("seq", geo.cell(F.col("lat"), 200).alias("y"), geo.cell(F.col("lon"), 200).alias("x"))
    own = v.select(F.col("seq").alias("o"), F.col("y").alias("cy"), F.col("x").alias("cx"))
    return geo.neighbours(v, F.col("y"), F.col("x")).join(own, ["cy", "cx"]).where("o < seq").groupBy("seq").agg(F.count(F.lit(1)).alias("candidates"))


#: A coordinate to three decimals, rounded from its exact binary value.
_DECIMALS = "replace(printf('%.3f', {0}), '-0.000', '0.000')"


@query(f"""WITH RECURSIVE {_OWN}, r AS (SELECT seq, name, borough, lower(name) AS g, row_number() OVER (PARTITION BY lower(name) ORDER BY seq) AS i, 'a' || lower(pc) || '|' || lower(website) AS a,
  CASE WHEN lat <> 0 AND lon <> 0 THEN 'b' || {_DECIMALS.format("lat")} || ':' || {_DECIMALS.format("lon")} ELSE 'a' || lower(pc) || '|' || lower(website) END AS b FROM own),
f(g, i, seq, name, borough, kept, seen) AS (
  SELECT g, i, seq, name, borough, true, [a, b] FROM r WHERE i = 1
  UNION ALL SELECT r.g, r.i, r.seq, r.name, r.borough, NOT list_has_any(f.seen, [r.a, r.b]), CASE WHEN list_has_any(f.seen, [r.a, r.b]) THEN f.seen ELSE list_concat(f.seen, [r.a, r.b]) END FROM f JOIN r ON r.g = f.g AND r.i = f.i + 1)
SELECT seq, name, borough FROM f WHERE kept""")
def collect_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.drop_repeats(venues(spark, sf_dir)).select("seq", "name", "borough")


@query(f"""WITH {_OWN}, r AS (SELECT seq, row_number() OVER (PARTITION BY lower(name), lower(pc), lower(website) ORDER BY seq) AS n FROM own)
SELECT seq FROM r WHERE n = 1""")
def collect_dedupe_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.drop_repeats(venues(spark, sf_dir).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double"), "address": F.lit("")})).select("seq")


def _again(name: str, of: str) -> Callable[[Query], Query]:
    """Registers another way to the result of query ``of``, held against the same SQL."""

    def add(fn: Query) -> Query:
        QUERIES[name], ORACLES[name] = fn, ORACLES[of]
        return fn

    return add


@_again("collect_dedupe_rounds", "collect_dedupe")
def _collect_dedupe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``collect_dedupe``, with every component settled in parallel rounds."""
    return resolve.drop_repeats(venues(spark, sf_dir), held=1).select("seq", "name", "borough")


#: Whether the names of rows x and r agree: equal, or the shorter, of four letters at least, inside the longer.
_NAMES = "(x.f = r.f OR (length(x.f) <= length(r.f) AND length(x.f) >= 4 AND contains(r.f, x.f)) OR (length(r.f) <= length(x.f) AND length(r.f) >= 4 AND contains(x.f, r.f)))"
_METRES = "111320 * sqrt((x.lat - r.lat) * (x.lat - r.lat) + (x.lon - r.lon) * cos(radians({0}.lat)) * (x.lon - r.lon) * cos(radians({0}.lat)))"
_SAME = f"((x.mail <> '' AND x.mail = r.mail) OR (x.key <> '' AND x.key = r.key) OR (x.phone <> '' AND x.phone = r.phone) OR ({_NAMES} AND {_METRES.format('r')} <= 100))"
_ROW = "struct_pack(seq := seq, f := f, lat := lat, lon := lon, spot := spot, mail0 := mail, key0 := key, phone0 := phone, mail := mail, key := key, phone := phone, website := website, tel := tel, merged := CAST(1 AS BIGINT))"


def _filled(column: str, by: str) -> str:
    """What row x has in ``column`` once it has joined with the present row: the same unless it has no ``by``."""
    return f"{column} := CASE WHEN x.{by} = '' THEN {column} ELSE x.{column} END"


@query(f"""WITH RECURSIVE {_OWN}, r AS (SELECT row_number() OVER (ORDER BY seq) AS i, seq, replace(name, ' ', '') AS f, name, lat, lon, mail, website, tel, {_KEY.format("website")} AS key, regexp_replace(tel, '[^0-9]', '', 'g') AS phone,
  {_DECIMALS.format("lat")} || ':' || {_DECIMALS.format("lon")} AS spot FROM own),
s(i, kept) AS (
  SELECT CAST(0 AS BIGINT), list({_ROW}) FILTER (WHERE false) FROM r
  UNION ALL
  SELECT i, CASE WHEN j IS NULL THEN list_append(coalesce(kept, []), {_ROW})
    ELSE list_transform(kept, lambda x: CASE WHEN x.seq = j THEN struct_pack(seq := x.seq, f := x.f, lat := x.lat, lon := x.lon, spot := x.spot, mail0 := x.mail0, key0 := x.key0, phone0 := x.phone0, {_filled("mail", "mail")},
      {_filled("key", "website")}, {_filled("phone", "tel")}, {_filled("website", "website")}, {_filled("tel", "tel")}, merged := x.merged + 1) ELSE x END) END
  FROM (SELECT r.*, s.kept, coalesce(list_filter(s.kept, lambda x: r.mail <> '' AND x.mail0 = r.mail)[1].seq, list_filter(s.kept, lambda x: r.key <> '' AND x.key0 = r.key)[1].seq, list_filter(s.kept, lambda x: r.phone <> '' AND x.phone0 = r.phone)[1].seq,
    list_filter(s.kept, lambda x: x.spot = r.spot AND {_SAME})[1].seq) AS j FROM s JOIN r ON r.i = s.i + 1) q)
SELECT x.seq AS seq, name, x.mail AS email, x.website AS website, x.tel AS phone, x.merged AS merged FROM (SELECT unnest(kept) AS x FROM (SELECT kept FROM s ORDER BY i DESC LIMIT 1)) u JOIN r ON r.seq = x.seq""")
def master_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = resolve.master(venues(spark, sf_dir), "44")
    return kept.select("seq", "name", "email", "website", "phone", "merged")


@_again("master_fold_rounds", "master_fold")
def _master_fold_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``master_fold``, with components of more than three rows settled in parallel rounds."""
    kept, _ = resolve.master(venues(spark, sf_dir), "44", held=3)
    return kept.select("seq", "name", "email", "website", "phone", "merged")


#: The catalogue has every second of our venues once more, a hundred metres or two further north.
_MOVED = "CASE WHEN seq % 8 = 0 THEN CAST(0.002 AS DOUBLE) ELSE CAST(0.001 AS DOUBLE) END"
_PLACE = "struct_pack(seq := {0}, f := f, lat := lat, lon := lon, cy := cy, cx := cx, mail := mail, website := website, tel := tel, phone := phone)"


@query(f"""WITH RECURSIVE {_OWN}, r AS (SELECT seq, replace(name, ' ', '') AS f, name, lat, lon, CAST(round_even(lat * 200, 0) AS BIGINT) AS cy, CAST(round_even(lon * 200, 0) AS BIGINT) AS cx, mail, website, tel, regexp_replace(tel, '[^0-9]', '', 'g') AS phone FROM own),
new AS (SELECT row_number() OVER (ORDER BY seq) AS i, * REPLACE (lat + {_MOVED} AS lat, CAST(round_even((lat + {_MOVED}) * 200, 0) AS BIGINT) AS cy) FROM r WHERE seq % 4 = 0),
s(i, kept) AS (
  SELECT CAST(0 AS BIGINT), list({_PLACE.format("seq")} ORDER BY seq) FROM r WHERE seq % 2 = 0
  UNION ALL
  SELECT i, CASE WHEN j IS NULL THEN list_append(kept, {_PLACE.format("seq + 1099511627776")})
    ELSE list_transform(kept, lambda x: CASE WHEN x.seq = j THEN struct_pack(seq := x.seq, f := x.f, lat := x.lat, lon := x.lon, cy := x.cy, cx := x.cx, {_filled("mail", "mail")}, {_filled("website", "website")}, {_filled("tel", "tel")}, {_filled("phone", "tel")}) ELSE x END) END
  FROM (SELECT r.*, s.kept, list_sort(list_transform(list_filter(s.kept, lambda x: abs(x.cy - r.cy) <= 1 AND abs(x.cx - r.cx) <= 1 AND (({_NAMES} AND {_METRES.format('x')} <= 150) OR (r.phone <> '' AND r.phone = x.phone))),
    lambda x: struct_pack(cy := x.cy, cx := x.cx, seq := x.seq)))[1].seq AS j FROM s JOIN new r ON r.i = s.i + 1) q)
SELECT x.seq AS seq, name, x.mail AS email, x.website AS website, x.tel AS phone FROM (SELECT unnest(kept) AS x FROM (SELECT kept FROM s ORDER BY i DESC LIMIT 1)) u JOIN r ON r.seq = x.seq % 1099511627776""")
def overture_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venues(spark, sf_dir)
    moved = v.where("seq % 4 = 0").withColumn("lat", F.col("lat") + F.expr(_MOVED)).withColumn("seq", F.col("seq") + F.lit(1 << 40))
    kept, _ = resolve.merge_places(v.where("seq % 2 = 0"), moved, "44")
    return kept.select("seq", "name", "email", "website", "phone")


@query(f"""WITH RECURSIVE {_OWN}, c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'redwidget' ELSE regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') END AS f,
  CASE WHEN c_custkey % 11 = 0 THEN 'not a food venue' WHEN c_custkey % 13 = 0 THEN 'permanently closed' WHEN c_mktsegment = 'MACHINERY' THEN 'outside the area' ELSE '' END AS excluded,
  list_filter([CASE WHEN c_custkey % 5 = 0 THEN 'e:x' || (c_custkey % 50) || '.y@gmail.com' END, CASE WHEN c_custkey % 7 = 0 THEN 'f:https://www.facebook.com/brand' || (c_custkey % 30) END, CASE WHEN c_custkey % 4 = 0 THEN 'w:redwidget.test' END], lambda x: x IS NOT NULL) AS keys FROM customer),
o AS (SELECT seq, replace(name, ' ', '') AS f, list_filter([CASE WHEN mail <> '' THEN 'e:' || mail END, CASE WHEN site LIKE 'facebook.com/%' THEN 'f:https://www.' || site END, CASE WHEN website <> '' THEN 'w:' || {_KEY.format("website")} END,
  CASE WHEN tel <> '' THEN 'p:' || regexp_replace(tel, '[^0-9]', '', 'g') END], lambda x: x IS NOT NULL) AS keys FROM own),
posts AS (SELECT f, unnest(keys) AS key FROM o),
hit AS (SELECT DISTINCT x.k FROM (SELECT k, f, unnest(keys) AS key FROM c WHERE excluded = '') x JOIN posts r USING (key) WHERE left(x.key, 1) IN ('e', 'f') OR {_NAMES}),
alone AS (SELECT f FROM o WHERE length(f) >= 6 GROUP BY f HAVING count(*) = 1),
n AS (SELECT row_number() OVER (ORDER BY k) AS i, k, f, keys, f IN (SELECT f FROM alone) AS named FROM c WHERE excluded = '' AND k NOT IN (SELECT k FROM hit)),
s(i, kept, k, outcome) AS (
  SELECT CAST(0 AS BIGINT), list(struct_pack(key := '', f := '')) FILTER (WHERE false), CAST(0 AS BIGINT), '' FROM n
  UNION ALL
  SELECT i, CASE WHEN hits = 0 AND NOT named THEN list_concat(coalesce(kept, []), list_transform(keys, lambda y: struct_pack(key := y, f := f))) ELSE kept END, k, CASE WHEN hits > 0 THEN 'merged' WHEN named THEN 'merged by name' ELSE 'new' END
  FROM (SELECT r.*, s.kept, coalesce(len(list_filter(s.kept, lambda x: list_contains(r.keys, x.key) AND (left(x.key, 1) IN ('e', 'f') OR {_NAMES}))), 0) AS hits FROM s JOIN n r ON r.i = s.i + 1) q),
every AS (SELECT outcome FROM s WHERE k > 0 UNION ALL SELECT 'merged' FROM hit UNION ALL SELECT 'excluded: ' || excluded FROM c WHERE excluded <> '')
SELECT outcome, count(*) AS n FROM every GROUP BY outcome""")
def partner_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = resolve.collect_social(venues(spark, sf_dir))
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(
        k.alias("line"), F.when(k % 3 == 0, F.lit("red widget")).otherwise(F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("district_label"),
        *[F.lit("").alias(c) for c in ("instagram_handle", "instagram_url", "facebook_page", "source_method")], F.when(k % 7 == 0, F.concat(F.lit("facebook.com/brand"), (k % 30).cast("string"))).otherwise("").alias("facebook_url"),
        F.when(k % 4 == 0, "https://redwidget.test/").otherwise("").alias("website"), F.when(k % 5 == 0, F.concat(F.lit("x"), (k % 50).cast("string"), F.lit(".y@gmail.com"))).otherwise("").alias("email"),
        F.lit("").alias("phone"), F.when(k % 11 == 0, "NOT A FOOD VENUE").when(k % 13 == 0, "Permanently closed").otherwise("").alias("notes"),
    )
    spec = {"source": "partner", "path": "partner.csv", "exclude_districts": ["MACHINERY"]}
    p = readers.partner_venues(rows, spec).withColumn("seq", F.col("line") + F.lit(1 << 40))
    told = resolve.collect_social(readers.venue_rows(p)).join(p.select("seq", "excluded"), "seq")
    return resolve.merge_partners(v, told, "44")[1]


_LIVE = f"""{_OWN}, hinted AS (SELECT *, CASE WHEN kind IN ('ECONOMY', 'MEDIUM') OR amenity = 'pub' THEN 3 ELSE 1 END AS s FROM own), scored AS (SELECT *, s + CASE seq % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 0 END AS e FROM hinted),
mails AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mail ORDER BY e DESC, borough, lower(name), seq) AS r FROM scored WHERE mail <> '') x WHERE r = 1),
sites AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY.format("website")} ORDER BY e DESC, borough, lower(name), seq) AS r FROM scored WHERE website <> '') x WHERE r = 1)"""


def _scored(v: DataFrame) -> DataFrame:
    """Venues with scores, as if their sites had been read."""
    lang = F.when(F.col("seq") % 3 == 0, "English").when(F.col("seq") % 3 == 1, "Bilingual").otherwise("Local")
    return relations.score(v.withColumn("site_language", lang))


def _live(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = _scored(venues(spark, sf_dir, kinds=True))
    return v, relations.email_rows(v, relations.by_score()), relations.site_rows(v, relations.by_score())


@query(f"""WITH {_LIVE}, b AS (SELECT borough, count(*) AS n FROM scored GROUP BY 1), m AS (SELECT borough, count(*) AS n, count(*) FILTER (WHERE e >= 4) AS high FROM mails GROUP BY 1), w AS (SELECT borough, count(*) AS n, count(*) FILTER (WHERE e >= 4) AS high FROM sites GROUP BY 1)
SELECT b.borough AS district, b.n AS venues, coalesce(m.n, 0) AS emails, coalesce(w.n, 0) AS websites, coalesce(m.high, 0) AS high_priority_emails, coalesce(w.high, 0) AS high_priority_websites FROM b LEFT JOIN m USING (borough) LEFT JOIN w USING (borough)""")
def district_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, emails, sites = _live(spark, sf_dir)
    return relations.district_summary(v, emails, sites)


@query(f"""WITH {_LIVE}, {_AREA_SQL},
m AS (SELECT borough, area, count(*) AS n FROM mails JOIN assigned USING (seq) GROUP BY 1, 2), w AS (SELECT borough, area, count(*) AS n FROM sites JOIN assigned USING (seq) GROUP BY 1, 2),
k AS (SELECT borough, area FROM m UNION SELECT borough, area FROM w UNION SELECT ab, area FROM a)
SELECT k.borough, CASE WHEN k.area = '' THEN '(unassigned)' ELSE k.area END AS area, coalesce(m.n, 0) AS emails, coalesce(w.n, 0) AS websites FROM k LEFT JOIN m USING (borough, area) LEFT JOIN w USING (borough, area)""")
def area_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = _areas(spark, sf_dir)
    v = _scored(joins.assign_areas(venues(spark, sf_dir, kinds=True), areas))
    return relations.area_summary(relations.email_rows(v, relations.by_score()), relations.site_rows(v, relations.by_score()), areas)


@query(f"""WITH {_LIVE}, d AS (SELECT *, count(*) OVER (PARTITION BY borough) AS density FROM scored WHERE website = '')
SELECT seq, density FROM d ORDER BY s DESC, density DESC, borough, seq LIMIT 50""")
def top_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venues(spark, sf_dir, kinds=True)
    v = v.withColumn("english_hint", text.english_hint(F.col("categories"), F.col("latin_name")))
    return enrich.queue(v, limit=50).select("seq", "density")


@query("""WITH e AS (SELECT s_suppkey, l || CAST(s_suppkey % 3 AS VARCHAR) || '@gmail.com' AS e, i FROM supplier, (VALUES (0, 'a.b'), (1, 'press'), (2, 'info'), (3, 'plain'), (4, 'bookings')) t(i, l)),
r AS (SELECT *, CASE WHEN e LIKE 'bookings%' THEN 0 WHEN e LIKE 'info%' THEN 1 WHEN e LIKE 'plain%' THEN 2 WHEN e LIKE 'a.b%' THEN 3 ELSE 4 END AS r FROM e)
SELECT s_suppkey, string_agg(e, '; ' ORDER BY r) AS emails FROM r GROUP BY s_suppkey""")
def email_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_ = F.transform(text.strings(["a.b", "press", "info", "plain", "bookings"]), lambda x: F.concat(x, (F.col("s_suppkey") % 3).cast("string"), F.lit("@gmail.com")))
    return _table(spark, sf_dir, "supplier").select("s_suppkey", _joined(text.valid_emails(all_, F.array(F.lit("https://any.test/")))).alias("emails"))


@query("""SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) x WHERE n = 1""")
def log_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = readers.last_wins(_table(spark, sf_dir, "events"), "user_id", "event_id")
    return got.select("user_id", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


_MX = [("gmail.com", "ok"), ("brand1.test", "no_domain"), ("brand2.test", "null_mx"), ("redwidget.test", "no_mx"), ("brand3.test", "unknown")]


@query(f"""WITH v AS ({VENUES}), mx(domain, status) AS (VALUES {", ".join(map(str, _MX))}), e AS (SELECT seq, mail, split_part(mail, '@', 2) AS domain FROM v WHERE mail <> '')
SELECT seq, mail AS email, CASE WHEN coalesce(status, 'unknown') IN ('ok', 'unknown') THEN 'valid' ELSE status END AS verdict FROM e LEFT JOIN mx USING (domain)""")
def validate_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venues(spark, sf_dir)
    live, rejected = joins.validate(v.withColumn("name", F.col("seq").cast("string")), spark.createDataFrame(_MX, "domain string, status string"))
    return live.where("email <> ''").select("seq", "email", F.lit("valid").alias("verdict")).unionAll(rejected.select(F.col("name").cast("long"), "email", "reason"))


@query(f"""SELECT seq FROM ({VENUES}) v WHERE lon >= -0.3 AND lon <= 0.1 AND lat >= 51.4 AND lat <= 51.6 AND kind <> 'LARGE' AND seq % 10 / 10.0 >= 0.5""")
def bbox_food_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue filters: box, taxonomy and confidence."""
    v = _view(spark, sf_dir).where(F.col("kind") != "LARGE").where((F.col("seq") % 10) / 10 >= 0.5)
    return readers.clip(v.withColumn("district", F.lit("x")), [{"name": "x", "clip": {"south": 51.4, "north": 51.6, "west": -0.3, "east": 0.1}}]).select("seq")


@query("""SELECT s_name AS name, s_nationkey AS nation, NULL AS segment FROM supplier UNION ALL SELECT c_name, c_nationkey, c_mktsegment FROM customer""")
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    b = _table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@query(f"""WITH v AS ({VENUES}) SELECT seq, CASE WHEN seq % 8 = 0 THEN 'disused' WHEN seq % 8 = 1 THEN 'hours' WHEN seq % 8 = 2 AND seq % 100 < 50 THEN 'ended' WHEN seq % 8 = 3 THEN 'noted' END AS why FROM v WHERE seq % 8 IN (0, 1, 3) OR (seq % 8 = 2 AND seq % 100 < 50)""")
def closed_on_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    case = s % 8
    tags = (
        F.when(case == 0, F.create_map(F.lit("disused"), F.lit("yes"))).when(case == 1, F.create_map(F.lit("opening_hours"), F.lit(" OFF ")))
        .when(case == 2, F.create_map(F.lit("end_date"), F.when(s % 100 < 50, "2020-05").otherwise("2031-01-01"))).when(case == 3, F.create_map(F.lit("note"), F.lit("Permanently closed since spring")))
        .otherwise(F.create_map(F.lit("note"), F.lit("closed on Sundays")))
    )
    why = F.when(case == 0, "disused").when(case == 1, "hours").when(case == 2, "ended").otherwise("noted")
    return _view(spark, sf_dir).where(is_closed(tags, "2024-06-30")).select("seq", why.alias("why"))


@query(f"""WITH {_OWN} SELECT seq, regexp_replace(regexp_replace(lower(regexp_extract(website, '^https?://([^?#]*)', 1)), '^www\\.', ''), '/+$', '') AS crawl_key FROM own WHERE website <> ''""")
def crawl_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return venues(spark, sf_dir).where("website <> ''").select("seq", text.crawl_key(F.col("website")).alias("crawl_key"))


@query(f"""WITH v AS ({VENUES}) SELECT seq, array_to_string(list_distinct([split_part(pc, ' ', 1), regexp_replace(split_part(pc, ' ', 1), '^(E[0-9]+)[A-Z]$', '\\1')]), ' ') AS x, regexp_replace(split_part(pc, ' ', 1), '^(E[0-9]+)[A-Z]$', '\\1') AS district FROM v WHERE pc <> ''""".replace("array_to_string(list_distinct([split_part(pc, ' ', 1), regexp_replace(split_part(pc, ' ', 1), '^(E[0-9]+)[A-Z]$', '\\1')]), ' ') AS x, ", ""))
def postcode_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir).where("pc <> ''").select("seq", text.district(F.col("pc")).alias("district"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'https://www.facebook.com/' || lower(replace(p_brand, '#', '.')) WHEN p_partkey % 4 = 1 THEN 'https://www.facebook.com/' || CAST(p_partkey AS VARCHAR) WHEN p_partkey % 4 = 2 THEN '' ELSE 'https://www.facebook.com/profile.php?id=' || CAST(p_partkey AS VARCHAR) END AS facebook,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'https://www.instagram.com/' || lower(replace(p_brand, '#', '_')) || '/' END AS instagram FROM part""")
def social_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    fb = (
        F.when(k % 4 == 0, F.concat(F.lit("@"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("."))))).when(k % 4 == 1, F.concat(F.lit("http://fb.com/pages/Some-Name/"), k.cast("string")))
        .when(k % 4 == 2, F.lit("facebook.com/events/12")).otherwise(F.concat(F.lit("https://m.facebook.com/profile.php?ref=x&id="), k.cast("string")))
    )
    ig = F.when(k % 3 == 0, F.lit("https://instagram.com/p/abc")).when(k % 3 == 1, F.concat(F.lit("@"), F.replace("p_brand", F.lit("#"), F.lit("_")))).otherwise(F.concat(F.lit("instagram.com/"), F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit("/?hl=en")))
    return _table(spark, sf_dir, "part").select("p_partkey", text.canonical_facebook(fb).alias("facebook"), text.canonical_instagram(ig).alias("instagram"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN 'bad_syntax' WHEN 1 THEN 'typo_domain' WHEN 2 THEN 'no_mx' END AS reason FROM customer WHERE c_custkey % 4 <> 3) x GROUP BY reason""")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    mail = F.when(k == 0, "no address").when(k == 1, "me@gmial.com").when(k == 2, "me@dead.test").otherwise("me@fine.test")
    v = readers.venue_rows(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("name"), mail.alias("email")))
    _, rejected = joins.validate(v, spark.createDataFrame([("dead.test", "no_mx")], "domain string, status string"))
    return relations.reject_reasons(rejected)


@query(r"""WITH p AS (SELECT doc_id, regexp_replace(strip_accents(regexp_replace(text, '[’‘´`]', chr(39), 'g')), '[^\x00-\x7F]', '', 'g') AS t FROM documents)
SELECT doc_id, trim(regexp_replace(replace(replace(lower(t), '&', ' and '), chr(39), ''), '[^a-z0-9]+', ' ', 'g')) AS folded FROM p""")
def fold_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text, folded."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 AND n_name <> 'x' THEN 'City of London' ELSE n_name END AS short FROM nation""")
def short_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 3
    name = F.when(k == 0, F.concat(F.lit("London Borough of "), "n_name")).when(k == 1, F.concat(F.lit("Royal Borough of "), "n_name")).otherwise("City of London")
    return _table(spark, sf_dir, "nation").select("n_nationkey", text.short_borough(name).alias("short"))


@query(f"""WITH {_OWN} SELECT count(*) AS venues, CAST(0 AS BIGINT) AS closed, count(*) FILTER (WHERE mail <> '' OR website <> '') AS reachable FROM own""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.totals(venues(spark, sf_dir, kinds=True))


@query("""SELECT n_name AS name, n_name || ' District' AS label FROM nation""")
def district_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    known = n.where("n_nationkey % 2 = 0").select(F.concat("n_name", F.lit(" District")).alias("label"))
    return joins.district_labels(n.select(F.col("n_name").alias("name")), known)


@query(f"""WITH {_LIVE} SELECT seq, array_to_string(list_sort(list_distinct(CASE WHEN r > 0 THEN [mail] END)), '; ') AS email, borough AS district FROM mails""")
def email_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The e-mail relation: one row per address."""
    _, emails, _ = _live(spark, sf_dir)
    return emails.select("seq", "email", F.col("borough").alias("district"))


@query(f"""WITH {_LIVE} SELECT seq, website FROM sites""")
def site_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, sites = _live(spark, sf_dir)
    return sites.select("seq", "website")


_FEW, _ENDS = V.DOMAIN_ENDS[:2], V.DOMAIN_ENDS
_KIND = {w: f"list_has_any(cats, {kinds})" if kinds else "true" for w, kinds in V.DOMAIN_WORDS}
_WORDS = ", ".join(f"CASE WHEN NOT contains(stem, '{w}') AND {k} THEN list_transform({_FEW}, lambda e: stem || '{w}' || e) ELSE [] END" for w, k in _KIND.items())


@query(rf"""WITH c AS (SELECT seq, lower(name) AS name, {_CATS} AS cats FROM ({VENUES}) v), w AS (SELECT *, replace(name, ' ', '') AS stem, replace(name, ' ', '-') AS dashed, list_filter(string_split(name, ' '), lambda x: length(x) >= 3 AND NOT list_contains({V.GENERIC}, x)) AS good FROM c),
d AS (SELECT seq, stem, good, flatten([list_transform({_ENDS}, lambda e: stem || e), CASE WHEN contains(dashed, '-') THEN list_transform({_FEW}, lambda e: dashed || e) ELSE [] END,
  CASE WHEN NOT contains(stem, 'london') THEN list_transform({_FEW}, lambda e: stem || 'london' || e) ELSE [] END, {_WORDS}]) AS found FROM w)
SELECT seq, CASE WHEN len(good) > 0 AND length(stem) BETWEEN 4 AND 40 THEN array_to_string(found[1:30], '; ') ELSE '' END AS domains FROM d""")
def domain_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venues(spark, sf_dir, kinds=True)
    return v.select("seq", _joined(text.domain_candidates(F.col("name"), F.lit(""), F.col("categories"))).alias("domains"))


@query()
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues inside two overlapping squares."""
    import struct

    def square(w: float, s: float, e: float, n: float) -> bytes:
        ring = [(w, s), (e, s), (e, n), (w, n), (w, s)]
        return struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in ring)

    boxes = [("a", -0.4, 51.3, 0.0, 51.5), ("b", -0.1, 51.4, 0.2, 51.6)]
    rows = [(n, (w, e, s, t), bytearray(square(w, s, e, t))) for n, w, s, e, t in boxes]
    areas = spark.createDataFrame(rows, "district string, bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>, geometry binary")
    return geo.point_in_polygon(_view(spark, sf_dir).select("seq", "lat", "lon"), areas).select("seq", "district")


ORACLES["point_in_polygon"] = f"""WITH v AS ({VENUES}) SELECT seq, d AS district FROM v, (VALUES ('a', -0.4, 51.3, 0.0, 51.5), ('b', -0.1, 51.4, 0.2, 51.6)) t(d, w, s, e, n) WHERE lon > w AND lon < e AND lat > s AND lat < n"""


def _district(k: int) -> bytes:
    """Two squares of nation ``k`` as one multipolygon, the first with a hole."""
    import struct

    def ring(w: float, s: float, e: float, n: float) -> bytes:
        return struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in ((w, s), (e, s), (e, n), (w, n), (w, s)))

    w, s = k * 0.03 - 0.5, k % 5 * 0.05 + 51.3
    first = struct.pack("<BII", 1, 3, 2) + ring(w, s, w + 0.2, s + 0.2) + ring(w + 0.05, s + 0.05, w + 0.1, s + 0.15)
    return struct.pack("<BII", 1, 6, 2) + first + struct.pack("<BII", 1, 3, 1) + ring(w + 0.3, s, w + 0.32, s + 0.02)


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


@query(f"""WITH v AS ({VENUES}), a AS (SELECT n_name, n_nationkey * {_d("0.03")} - {_d("0.5")} AS w, n_nationkey % 5 * {_d("0.05")} + {_d("51.3")} AS s FROM nation)
SELECT seq, n_name AS district FROM v, a WHERE
  (lon > w AND lon < w + {_d("0.2")} AND lat > s AND lat < s + {_d("0.2")} AND NOT (lon >= w + {_d("0.05")} AND lon <= w + {_d("0.1")} AND lat >= s + {_d("0.05")} AND lat <= s + {_d("0.15")}))
  OR (lon > w + {_d("0.3")} AND lon < w + {_d("0.32")} AND lat > s AND lat < s + {_d("0.02")})""")
def polygon_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues in the districts of all nations: multipolygons with a hole that overlap one another."""

    @F.pandas_udf("binary")
    def shape(k: pd.Series) -> pd.Series:
        return k.map(_district)

    areas = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("district"), shape("n_nationkey").alias("geometry"))
    return geo.point_in_polygon(_view(spark, sf_dir).select("seq", "lat", "lon"), areas).select("seq", "district")


_VALUES = sorted({v for vs in V.CUISINES.values() for v in vs} | {"other"})
_SERVED = ", ".join(f"('{v}', '{c}')" for c, vs in V.CUISINES.items() for v in vs)


@query(f"""WITH t(v, c) AS (VALUES {_SERVED}), s AS (SELECT s_suppkey, unnest(list_distinct([{_VALUES}[s_suppkey % {len(_VALUES)} + 1], {_VALUES}[s_suppkey * 7 % {len(_VALUES)} + 1]])) AS v FROM supplier)
SELECT s_suppkey, coalesce(string_agg(DISTINCT c, '; ' ORDER BY c), 'Restaurant') AS categories FROM s LEFT JOIN t USING (v) GROUP BY s_suppkey""")
def categorize_cuisines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cuisine tags of all that are known, in turn, written with another case and separator."""
    values, k = text.strings(_VALUES), F.col("s_suppkey")
    pick = lambda i: F.element_at(values, (i % len(_VALUES) + 1).cast("int"))
    tags = F.create_map(F.lit("cuisine"), F.concat(F.upper(pick(k)), F.when(k % 2 == 0, "; ").otherwise(","), pick(k * 7)))
    return _table(spark, sf_dir, "supplier").select("s_suppkey", _joined(text.categorize(tags, F.lit("x"))).alias("categories"))


_SITES = [f"https://www.{h}/a" for h in V.OTHER_SITE_HOSTS] + [f"m.{x}.co.uk/b" for x in [*V.OTHER_SITE_LABELS, *V.COMPANY_LABELS]] + ["https://a.x.com", "myfacebook.test", "https://kite.test/?u=facebook.com", "xx.com", ""]


@query(rf"""WITH s AS (SELECT c_custkey, {_SITES}[c_custkey % {len(_SITES)} + 1] AS url FROM customer), h AS (SELECT c_custkey, regexp_replace(regexp_extract(regexp_replace(url, '^https?://', ''), '^[^/?#]*'), '^www\.', '') AS host FROM s),
k AS (SELECT c_custkey, host IN {tuple(V.OTHER_SITE_HOSTS)} OR ends_with(host, '.x.com') OR list_has_any(string_split(host, '.'), {V.OTHER_SITE_LABELS}) AS other, list_has_any(string_split(host, '.'), {V.COMPANY_LABELS}) AS company FROM h)
SELECT c_custkey, other AS not_venue_site, other OR company AS aggregator FROM k""")
def site_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which web addresses are a venue's own: every host and label of the lists, and some that only look like them."""
    url = F.element_at(text.strings(_SITES), (F.col("c_custkey") % len(_SITES) + 1).cast("int"))
    return _table(spark, sf_dir, "customer").select("c_custkey", text.not_venue_site(url).alias("not_venue_site"), text.is_aggregator(url).alias("aggregator"))


_SHOWN = "regexp_replace(regexp_replace(regexp_replace(website, '^.*?://', ''), '^www\\.', ''), '/+$', '')"


@query(f"""WITH {_OWN}, r AS (SELECT *, seq % 3 + 1 AS locations, row_number() OVER (ORDER BY borough, lower(name), seq) - 1 AS number FROM own WHERE website <> ''),
s AS (SELECT borough, min(number) AS first, count(*) AS n FROM r GROUP BY borough),
p AS (SELECT borough, first, 2 + coalesce(sum(ceil(n / 30)) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS page FROM s),
t AS (SELECT r.*, first, CAST(page + floor((number - first) / 30) AS BIGINT) AS page, {_SHOWN} AS bare FROM r JOIN p USING (borough))
SELECT number, borough AS section, 'b_' || regexp_replace(borough, '[^A-Za-z0-9]', '', 'g') AS anchor, page, name, website AS target,
  CASE WHEN length(bare) > 48 THEN substr(bare, 1, 45) || '...' ELSE bare END AS shown,
  concat_ws(' \u00b7 ', nullif(tel, ''), nullif(mail, ''), CASE WHEN locations <> 1 THEN locations || ' branches' END) AS details FROM t""")
def website_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed list of websites by borough, with numbers, anchors and pages."""
    rows = venues(spark, sf_dir).where("website <> ''").withColumn("locations", F.col("seq") % 3 + 1)
    return relations.document(rows.select("seq", "borough", "area", "name", "website", "email", "phone", "locations"), "websites")


@query(f"""SELECT seq FROM (SELECT seq, {_CATS} AS cats FROM ({VENUES}) v) c WHERE list_has_any(cats, ['Pizza', 'Pub', 'Seafood'])""")
def wanted_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues of the categories that a run asks for."""
    tags = F.create_map(F.lit("cuisine"), "cuisine", F.lit("amenity"), "amenity")
    told = _view(spark, sf_dir).withColumn("categories", text.categorize(tags, F.col("name")))
    return told.where(wanted(F.col("categories"), ["Pizza", "Pub", "Seafood"])).select("seq")


@query(f"""SELECT seq, borough FROM ({VENUES}) v WHERE contains(lower(borough), 'nation_1') OR contains(lower(borough), 'n_7')""")
def picked_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues of the units that a run asks for by a part of their name, whatever the case."""
    return readers.pick_units(_view(spark, sf_dir).select("seq", "borough"), ["NATION_1", "n_7"], "borough")


_FOUND = "lower(name) || '|' || upper(replace(pc, ' ', ''))"


@query(f"""WITH {_OWN}, k AS (SELECT {_FOUND} AS key, min(seq) AS s FROM v GROUP BY 1), log AS (SELECT key, CASE WHEN s % 3 = 0 THEN '' ELSE 'https://found' || s || '.test/' END AS found, CASE s % 2 WHEN 0 THEN 'phone' ELSE 'postcode' END AS evidence FROM k)
SELECT seq, found AS website, 'own site (found by name, ' || evidence || ' verified)' AS website_type FROM own JOIN log ON key = {_FOUND} WHERE website = '' AND found <> '' AND seq % 11 <> 0""")
def discovery_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites that a search has found go to open venues of that name and postcode without one."""
    v = venues(spark, sf_dir).withColumn("closed", F.col("seq") % 11 == 0)
    log = _view(spark, sf_dir).groupBy(text.discovery_key(F.col("name"), F.col("pc")).alias("key")).agg(F.min("seq").alias("s"))
    found = F.when(F.col("s") % 3 == 0, "").otherwise(F.concat(F.lit("https://found"), "s", F.lit(".test/")))
    log = log.select("key", found.alias("website"), F.when(F.col("s") % 2 == 0, "phone").otherwise("postcode").alias("evidence"))
    got = joins.take_discovery(v, log)
    return got.where(F.col("website_type").startswith("own site (found")).select("seq", "website", "website_type")


@query(f"""WITH {_OWN} SELECT seq, CASE WHEN seq % 3 = 0 THEN 'https://l' || seq || '.test' ELSE '' END AS website, seq % 3 = 0 AND seq % 2 = 0 AS closed FROM own WHERE website = '' AND mail = ''""")
def places_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and closures of a lookup table for venues that have neither a site nor an address."""
    v = venues(spark, sf_dir).withColumn("closed", F.lit(False))
    status = F.when(F.col("seq") % 2 == 0, "CLOSED_PERMANENTLY").otherwise("OPERATIONAL")
    lookup = _view(spark, sf_dir).where("seq % 3 = 0").select("seq", F.concat(F.lit("https://l"), "seq", F.lit(".test")).alias("website"), status.alias("business_status"))
    bare = v.where("website = '' and email = ''").select("seq")
    return joins.take_places_lookup(v, lookup).join(bare, "seq").select("seq", "website", "closed")


_NAMED = "'info@' || replace(p_name, ' ', '') || '.test'"


@query(f"""SELECT p_partkey, {_NAMED} || CASE WHEN p_partkey % 3 = 0 THEN '; plain' || p_partkey || '@gmail.com' ELSE '' END AS emails FROM part""")
def cloudflare_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages that hide them as bytes XORed with the first, each with a key of its own; plain ones come after them."""
    key = (F.col("p_partkey") * 37 % 255 + 1).cast("int")
    mail = F.concat(F.lit("info@"), F.replace("p_name", F.lit(" "), F.lit("")), F.lit(".test"))
    pair = lambda n: F.lower(F.lpad(F.hex(n.cast("long")), 2, "0"))
    each = F.transform(F.sequence(F.lit(1), F.length(mail)), lambda i: pair(F.ascii(F.substr(mail, i, F.lit(1))).bitwiseXOR(key)))
    hidden = F.concat(F.lit('<a class="__cf_email__" data-cfemail="'), pair(key), F.array_join(each, ""), F.lit('">[protected]</a>'))
    plain = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" or plain"), "p_partkey", F.lit("@gmail.com"))).otherwise("")
    return _table(spark, sf_dir, "part").select("p_partkey", _joined(pages.page_emails(F.concat(plain, hidden))).alias("emails"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/home' || page_id WHEN 1 THEN 'https://to' || page_id || '.test/' END AS target FROM pages""")
def soft_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where pages forward to: by a refresh or a script, if they are short; the stored page behind makes the others long."""
    k = F.col("page_id").cast("string")
    refresh = F.concat(F.lit('<meta http-equiv="Refresh" content="0; URL=/home'), k, F.lit('">'))
    script = F.concat(F.lit("<script>window.location.href = 'https://to"), k, F.lit(".test/'</script>"))
    long = F.concat(refresh, F.rpad("html", 3000, "."))
    page = F.when(F.col("page_id") % 4 == 0, refresh).when(F.col("page_id") % 4 == 1, script).when(F.col("page_id") % 4 == 2, long).otherwise("<p>no way on</p>")
    return _table(spark, sf_dir, "pages").select("page_id", pages.soft_redirect(page).alias("target"))


@query("""SELECT event_id, CASE WHEN event_id % 6 IN (1, 2) OR event_id % 5 = 1 THEN 'dead' ELSE 'unknown' END AS status FROM events""")
def fetch_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a failed fetch tells of a site: gone for good, or nothing."""
    e = F.col("event_id")
    code = F.when(e % 6 == 1, 404).when(e % 6 == 2, 410).when(e % 6 == 3, 500).when(e % 6 == 4, 403)
    error = F.when(e % 5 == 1, "[Errno -2] Name or service not known").when(e % 5 == 2, "timed out")
    return _table(spark, sf_dir, "events").select("event_id", pages.fetch_status(code, error).alias("status"))


_CRAWLED = "regexp_replace(regexp_replace(lower(regexp_extract(website, '^https?://([^?#]*)', 1)), '^www\\.', ''), '/+$', '')"


@query(f"""WITH {_OWN}, k AS (SELECT *, {_CRAWLED} AS key FROM own WHERE website <> ''), log AS (SELECT key, min(seq) AS s FROM k GROUP BY key HAVING min(seq) % 5 <> 0),
t AS (SELECT k.seq, mail, s, coalesce(s % 4 IN (0, 1), false) AS shut, CASE WHEN s IS NOT NULL THEN 'found' || s || '@gmail.com' END AS found FROM k LEFT JOIN log USING (key))
SELECT seq, shut AS closed, CASE WHEN mail = '' AND NOT shut AND found IS NOT NULL THEN found ELSE mail END AS email,
  CASE WHEN mail <> '' AND NOT shut AND found IS NOT NULL THEN found ELSE '' END AS others, CASE WHEN NOT shut AND s % 2 = 1 THEN 'English' ELSE '' END AS site_language FROM t""")
def crawl_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a crawl has read goes to venues: closed sites, own and free-mail addresses, the language; some sites are not in the log."""
    v = venues(spark, sf_dir)
    log = v.where("website <> ''").groupBy(text.crawl_key(F.col("website")).alias("key")).agg(F.min("seq").alias("s")).where("s % 5 <> 0")
    mails = F.array(F.concat(F.lit("found"), "s", F.lit("@gmail.com")), F.concat(F.lit("else"), "s", F.lit("@other.test")))
    status = F.element_at(text.strings(["closed", "dead", "ok", "unknown"]), (F.col("s") % 4 + 1).cast("int"))
    lang = F.when(F.col("s") % 2 == 1, "English").otherwise("")
    got = joins.take_crawl(v, log.select("key", mails.alias("emails"), status.alias("status"), F.lit("").alias("final_url"), lang.alias("lang")))
    return got.where("website <> ''").select("seq", "closed", "email", _joined(F.col("other_emails")).alias("others"), "site_language")
