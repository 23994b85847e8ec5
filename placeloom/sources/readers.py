"""Readers of the sources, and their flattening into venue rows. Every ``read_`` takes a path that Spark can list."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo, text
from ..functions import values as V
from . import schemas


@dataclass
class CityConfig:
    """Settings of a city; missing keys take the defaults."""

    slug: str = ""
    country_code: str = ""
    min_phone_digits: int = 10
    postcode_needs_name: bool = False
    tlds: list[str] = field(default_factory=lambda: list(V.DOMAIN_ENDS))
    city_word: str = "london"
    city_aliases: list[str] = field(default_factory=list)
    city_evidence: str = ""
    local_script: str = ""
    english_priority: bool = False
    exclude_units: list[str] = field(default_factory=list)
    expected_units: int = 0
    osm_areas: list[dict] = field(default_factory=list)
    bbox: dict | None = None
    sub_areas: dict[str, list[float]] = field(default_factory=dict)
    overture: dict = field(default_factory=dict)
    partner_csvs: list[dict] = field(default_factory=list)

    @classmethod
    def parse(cls, data: str) -> CityConfig:
        told = json.loads(data)
        return cls(**{k: v for k, v in told.items() if k in cls.__dataclass_fields__ and v is not None})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CityConfig:
        return cls.parse("\n".join(r.value for r in spark.read.text(path, wholetext=True).limit(1).collect()))


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Map elements with ``unit`` (the file's name) and the order in which they stand."""
    rows = spark.read.schema(schemas.MAP_ELEMENT).option("multiLine", True).json(path)
    unit = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.json)?$", 1), "_", " ")
    return rows.select("*", unit.alias("unit"), F.monotonically_increasing_id().alias("pos"))


def food_elements(rows: DataFrame) -> DataFrame:
    """Elements tagged as places to eat or drink."""
    tag = lambda k: F.col("tags")[k]
    food = tag("amenity").isin(V.FOOD_AMENITIES) | ((tag("amenity") == "bar") & (tag("food") == "yes")) | tag("shop").isin(V.FOOD_SHOPS) | ((tag("street_vendor") == "yes") & tag("cuisine").isNotNull())
    return rows.where(F.coalesce(food, F.lit(False)))


def around(rows: DataFrame, lat: float, lon: float, metres: float) -> DataFrame:
    """Elements within a circle."""
    y, x = F.coalesce("lat", "center.lat"), F.coalesce("lon", "center.lon")
    return rows.where(geo.within(F.lit(lat), F.lit(lon), y, x, metres))


def custom_elements(rows: DataFrame, spec: dict, areas: DataFrame | None = None) -> DataFrame:
    """Elements of one entry of ``osm_areas``: around a point, or inside the administrative area of an English name and level.

    ``areas`` is (name_en, admin_level, bbox, geometry); it is needed for the latter only.
    """
    if "around" in spec:
        return around(rows, *spec["around"])
    own = areas.where((F.col("name_en") == spec["admin_name_en"]) & (F.col("admin_level").cast("string") == str(spec["admin_level"])))
    at = rows.withColumns({"_y": F.coalesce("lat", "center.lat"), "_x": F.coalesce("lon", "center.lon")})
    inside = geo.point_in_polygon(at, own.select("bbox", "geometry"), "_y", "_x")
    return inside.select(*rows.columns).dropDuplicates(["type", "id"])


def snapshot(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` as they were when first asked for: written to ``path`` unless that holds them already."""
    spark = rows.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def place_nodes(rows: DataFrame) -> DataFrame:
    """(ord, name, lat, lon) of named points."""
    return rows.where(text.blank(F.col("tags")["name"]) != "").select(F.col("pos").alias("ord"), F.col("tags")["name"].alias("name"), "lat", "lon")


def place_point(places: DataFrame, name: str) -> tuple[float, float] | None:
    """Where the first place of this name lies."""
    r = places.where(F.col("name") == name).orderBy("ord").select("lat", "lon").first()
    return (r.lat, r.lon) if r else None


def units(rows: DataFrame, config: CityConfig) -> DataFrame:
    """(label, id) of administrative areas, without excluded ones, by label and id."""
    label = F.coalesce(F.nullif(F.col("tags")["name:en"], F.lit("")), F.col("tags")["name"])
    got = rows.select(label.alias("label"), "id").distinct()
    if config.exclude_units:
        got = got.where(~F.col("label").isin(config.exclude_units))
    return got.orderBy("label", "id")


def pick_units(rows: DataFrame, wanted: list[str], label: str = "label") -> DataFrame:
    """Units that contain one of ``wanted``, whatever the case; all if nothing is asked for."""
    if not wanted:
        return rows
    hit = F.lit(False)
    for w in wanted:
        hit |= F.contains(F.lower(label), F.lit(w.lower()))
    return rows.where(hit)


def _tag(*keys: str) -> Column:
    return text.first_filled(*[F.col("tags")[k] for k in keys])


def venue_rows(df: DataFrame) -> DataFrame:
    """``df`` with all venue columns, in order; what is missing is blank (strings), empty (lists) or null."""
    want = T._parse_datatype_string(schemas.VENUE)
    cols = []
    for f in want:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.dataType == T.StringType():
            c = F.coalesce(c, F.lit(""))
        elif f.name in ("other_emails", "categories"):
            c = F.coalesce(c, F.array().cast("array<string>"))
        elif f.name == "closed":
            c = F.coalesce(c, F.lit(False))
        elif f.name == "merged":
            c = F.coalesce(c, F.lit(1).cast("long"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def element_venues(rows: DataFrame) -> DataFrame:
    """Map elements (with ``unit`` and ``pos``) as venues, ``seq`` from pos.

    Zeros give way to a centre; without one a longitude of 0 stays beside a latitude that is not 0.
    """
    at = lambda k: F.coalesce(F.when(F.col(k) != 0, F.col(k)), F.col(f"center.{k}"), F.when(F.col("lat") != 0, F.col(k)))
    address = F.concat_ws(" ", *[F.nullif(F.col("tags")[k], F.lit("")) for k in ("addr:housenumber", "addr:street")])
    return venue_rows(
        rows.select(
            F.col("pos").alias("seq"), F.col("unit").alias("borough"), text.strip(_tag("name")).alias("name"), text.strip(_tag("name:en")).alias("name_en"), "tags",
            text.strip(_tag("email", "contact:email")).alias("email"), text.strip(_tag("website", "contact:website", "url")).alias("website"),
            text.strip(_tag("phone", "contact:phone")).alias("phone"), address.alias("address"), _tag("addr:postcode").alias("postcode"),
            _tag("contact:facebook", "facebook").alias("facebook"), _tag("contact:instagram", "instagram").alias("instagram"),
            F.concat(F.lit("https://www.openstreetmap.org/"), "type", F.lit("/"), F.col("id").cast("string")).alias("osm_url"),
            at("lat").alias("lat"), at("lon").alias("lon"), F.lit("openstreetmap").alias("source"),
        )
    )


def read_register(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.REGISTER).option("multiLine", True).json(path)
    return rows.where(F.col("BusinessTypeID").isin(list(V.BUSINESS_TAGS))).withColumn("pos", F.monotonically_increasing_id())


def authorities(spark: SparkSession, path: str) -> DataFrame:
    """(name, id) from a JSON object of authority names and numbers; names in our spelling."""
    got = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,bigint>")).alias("name", "id"))
    for a, b in V.AUTHORITY_ALIASES.items():
        got = got.withColumn("name", F.when(F.col("name") == a, b).otherwise(F.col("name")))
    return got


def register_venues(rows: DataFrame, unit: Column) -> DataFrame:
    """Register entries as venues; retailers only if their name is that of a baker, deli, ice cream, donut or bagel shop."""
    name, kind = text.strip(text.blank(F.col("BusinessName"))), F.col("BusinessTypeID")
    hint = lambda c: name.rlike("(?iu)" + V.NAME_PATTERNS[c])
    keep = F.lit(False)
    for c in V.RETAIL_CATEGORIES:
        keep |= hint(c)
    tags = F.create_map(F.lit("name"), name)
    for k, v in V.BUSINESS_TAGS.items():
        if v:
            tags = F.when(kind == k, F.map_concat(F.create_map(*[F.lit(x) for kv in v.items() for x in kv]), F.create_map(F.lit("name"), name))).otherwise(tags)
    tags = F.when(kind == V.RETAIL_TYPE, F.create_map(F.lit("name"), name, F.lit("shop"), F.when(hint("Bakery"), "bakery").otherwise("deli"))).otherwise(tags)
    at = [F.col(f"geocode.{k}").try_cast("double") for k in ("latitude", "longitude")]
    both = at[0].isNotNull() & at[1].isNotNull()
    return venue_rows(
        rows.where((F.coalesce(kind, F.lit(0)) != V.RETAIL_TYPE) | keep).select(
            F.col("pos").alias("seq"), unit.alias("borough"), name.alias("name"), tags.alias("tags"), F.col("Phone").alias("phone"),
            F.concat_ws(", ", *[F.nullif(F.col(f"AddressLine{i}"), F.lit("")) for i in (1, 2, 3)]).alias("address"), F.col("PostCode").alias("postcode"),
            F.concat(F.lit("https://ratings.food.gov.uk/business/"), F.col("FHRSID").cast("string")).alias("osm_url"),
            F.when(both, at[0]).alias("lat"), F.when(both, at[1]).alias("lon"), F.lit("food standards agency").alias("source"),
        )
    )


def _box(b: dict) -> Column:
    return (F.col("bbox.xmax") >= b["west"]) & (F.col("bbox.xmin") <= b["east"]) & (F.col("bbox.ymax") >= b["south"]) & (F.col("bbox.ymin") <= b["north"])


def catalogue(places: DataFrame, divisions: DataFrame, config: CityConfig) -> DataFrame:
    """Open food places inside the city's divisions, with lat, lon, district and region; a place in two divisions counts twice."""
    o = config.overture
    label = F.coalesce(F.col("names.common")["en"], F.col("names.primary"))
    if o.get("divisions"):
        named = F.lit(False)
        for d in o["divisions"]:
            named |= (F.col("subtype") == d["subtype"]) & (label == d["name"])
        wanted = named & (F.col("country") == o.get("country", ""))
    else:
        wanted = (F.col("subtype") == o.get("division_subtype", "county")) & F.col("region").isin(o["regions"])
    box = _box(config.bbox)
    areas = divisions.where(wanted & box).select(label.alias("district"), "region", "bbox", "geometry")
    food = (F.try_element_at("taxonomy.hierarchy", F.lit(1)) == "food_and_drink") & (F.col("confidence") >= o.get("min_confidence", 0.5)) & (F.coalesce("operating_status", F.lit("open")) == "open")
    number = lambda at: wkb_double(F.col("geometry"), at)
    rows = places.where(box & food).select(
        "id", F.col("names.primary").alias("name"), F.col("names.common")["en"].alias("name_en"), F.col("taxonomy.hierarchy").alias("hierarchy"), "websites", "emails", "socials", "phones",
        F.try_element_at("addresses", F.lit(1))["freeform"].alias("address"), F.try_element_at("addresses", F.lit(1))["postcode"].alias("postcode"), "confidence", "operating_status",
        F.try_element_at("sources", F.lit(1))["dataset"].alias("dataset"), number(14).alias("lat"), number(6).alias("lon"),
    )
    return clip(geo.point_in_polygon(rows, areas), o.get("divisions", []))


def wkb_double(geometry: Column, at: int) -> Column:
    """The double at byte ``at`` (from 1) of well-known binary, in the byte order that its first byte names."""
    h = F.hex(F.substring(geometry, at, 8))
    turned = F.concat(*[F.substring(h, i, 2) for i in range(15, 0, -2)])
    bits = F.when(F.hex(F.substring(geometry, 1, 1)) == "01", turned).otherwise(h)
    high = F.conv(F.substring(bits, 1, 3), 16, 10).cast("long")
    mantissa = F.conv(F.substring(bits, 4, 13), 16, 10).cast("double")
    sign, exponent = F.when(high >= 2048, -1.0).otherwise(1.0), high % 2048
    return F.when((exponent == 0) & (mantissa == 0), F.lit(0.0)).otherwise(sign * (1 + mantissa / F.lit(float(1 << 52))) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))


def clip(rows: DataFrame, divisions: list[dict]) -> DataFrame:
    """Rows of a division that has a clip box must lie in it, edges included."""
    keep = F.lit(True)
    for d in divisions:
        if c := d.get("clip"):
            keep &= (F.col("district") != d["name"]) | (F.col("lat").between(c["south"], c["north"]) & F.col("lon").between(c["west"], c["east"]))
    return rows.where(keep)


def catalogue_venues(rows: DataFrame) -> DataFrame:
    """Catalogue places (``seq`` gives their order) as venues."""
    h = F.coalesce("hierarchy", F.array().cast("array<string>"))
    leaf = F.coalesce(F.try_element_at(h, F.lit(-1)), F.lit("food_and_drink"))
    tags = F.create_map().cast("map<string,string>")
    tags = F.when(leaf.endswith("_restaurant"), F.create_map(F.lit("cuisine"), F.regexp_replace(leaf, "_restaurant$", ""))).otherwise(tags)
    for k, v in V.LEAF_TAGS.items():
        tags = F.when(leaf == k, F.create_map(*[F.lit(x) for kv in v.items() for x in kv])).otherwise(tags)
    amenity = F.when(F.array_contains(h, "restaurant"), "restaurant").when(F.array_contains(h, "casual_eatery"), "cafe").otherwise("restaurant")
    tags = F.when(F.map_contains_key(tags, "amenity"), tags).otherwise(F.map_concat(tags, F.create_map(F.lit("amenity"), amenity)))
    first = lambda c: text.blank(F.try_element_at(c, F.lit(1)))
    social = lambda w: first(F.filter("socials", lambda s: F.contains(F.lower(s), F.lit(w))))
    name = text.blank(F.col("name"))
    return venue_rows(
        rows.select(
            "seq", F.col("district").alias("borough"), text.strip(name).alias("name"), text.strip(text.blank(F.col("name_en"))).alias("name_en"),
            F.map_concat(tags, F.create_map(F.lit("name"), name)).alias("tags"), F.array_join(F.coalesce("emails", F.array().cast("array<string>")), "; ").alias("email"),
            first(F.col("websites")).alias("website"), first(F.col("phones")).alias("phone"), "address", "postcode", social("facebook").alias("facebook"), social("instagram").alias("instagram"),
            F.concat(F.lit("overture:"), "id").alias("osm_url"), "lat", "lon",
            F.concat(F.lit("overture"), F.when(text.blank(F.col("dataset")) != "", F.concat(F.lit(" ("), "dataset", F.lit(")"))).otherwise("")).alias("source"),
        )
    )


def read_wikidata(spark: SparkSession, path: str) -> DataFrame:
    """(seq, label, site, lat, lon) of items whose place is a point."""
    rows = spark.read.schema(schemas.WIKIDATA).option("multiLine", True).json(path)
    return wikidata_points(rows.withColumn("seq", F.monotonically_increasing_id()))


def wikidata_points(rows: DataFrame) -> DataFrame:
    point = r"^Point\(([-\d.]+) ([-\d.]+)\)"
    at = lambda i: F.regexp_extract("coord.value", point, i).try_cast("double")
    return rows.where(F.col("coord.value").rlike(point)).select("seq", F.col("itemLabel.value").alias("label"), F.col("site.value").alias("site"), at(2).alias("lat"), at(1).alias("lon"))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    return area_rows(spark.read.schema(schemas.AREA).option("header", True).csv(path).withColumn("ord", F.monotonically_increasing_id()))


def area_rows(rows: DataFrame) -> DataFrame:
    """(ord, borough, area, names, post_town, districts) of rows that have a borough and an area."""
    split = F.array_distinct(F.filter(F.transform(F.split(text.blank(F.col("districts")), ","), lambda d: F.upper(text.strip(d))), lambda d: d != ""))
    return rows.where("borough <> '' and area <> ''").select("ord", "borough", "area", text.area_names(F.col("area")).alias("names"), "post_town", split.alias("districts"))


def read_partner(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PARTNER).option("header", True).csv(path).withColumn("line", F.monotonically_increasing_id())


def partner_outcome(notes: Column, district: Column, excluded: list[str]) -> Column:
    """Why a partner row is left out, else empty."""
    n = text.blank(notes)
    out = F.when(n.rlike("(?i)not a food venue"), "not a food venue").when(n.rlike("(?i)permanently closed"), "permanently closed")
    return out.when(F.coalesce(district.isin(excluded), F.lit(False)), "outside the area").otherwise("") if excluded else out.otherwise("")


def partner_venues(rows: DataFrame, spec: dict) -> DataFrame:
    """Partner rows as venues, with ``line`` (from 0), ``excluded`` and the district they keep if they stay new."""
    b = lambda k: text.blank(F.col(k))
    site = text.normalize_url(b("website"))
    other = (site != "") & text.not_venue_site(site)
    source = spec.get("source", "partner")
    district = F.col("district_label")
    for k, v in spec.get("district_map", {}).items():
        district = F.when(F.col("district_label") == k, v).otherwise(district)
    name = text.strip(b("name"))
    cols = {
        "name": name, "tags": F.create_map(F.lit("name"), name), "email": text.strip(b("email")), "website": F.when(other, "").otherwise(site), "social_website": F.when(other, site).otherwise(""),
        "phone": text.strip(F.substring_index(b("phone"), ";", 1)), "facebook": text.first_filled(b("facebook_url"), b("facebook_page")), "instagram": text.first_filled(b("instagram_url"), b("instagram_handle")),
        "osm_url": F.concat(F.lit(f"{source}:{spec.get('path', '').rpartition('/')[2]}#"), (F.col("line") + 2).cast("string")), "source": F.lit(source), "borough": text.blank(district), "area": text.blank(district),
        "admin_district": F.lit(spec.get("admin_district", "")),
        "partner_notes": F.concat(F.when(b("notes").rlike("(?i)temporarily closed"), "temporarily closed (per partner); ").otherwise(""), b("notes")),
    }
    keep = rows.select("line", partner_outcome(F.col("notes"), F.col("district_label"), spec.get("exclude_districts", [])).alias("excluded"), *[c.alias(k) for k, c in cols.items()])
    return keep


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGE).parquet(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines in the order of ``pos``; a line cut short is left out."""
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return rows.where("_corrupt_record is null").drop("_corrupt_record")


def last_wins(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """The last record of each key."""
    last = Window.partitionBy(key).orderBy(F.desc(pos))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def fresh_crawls(rows: DataFrame) -> DataFrame:
    """Crawl records that need no new crawl."""
    v, status = F.coalesce("v", F.lit(1)), F.coalesce("status", F.lit(""))
    keep = (v >= 3) | ~status.isin("unknown", "ok") | ((status == "ok") & (F.size("emails") > 0))
    stale = (status == "dead") & F.contains(F.col("key"), F.lit("/")) & (v < 4)
    return rows.where(F.col("emails").isNotNull() & keep & ~stale)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written CSV relation, all columns strings."""
    return spark.read.option("header", True).csv(path)
