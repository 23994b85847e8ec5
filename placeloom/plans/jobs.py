"""Whole runs: collecting venues, and the two batch jobs with their output relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import enrich, joins, relations, resolve
from ..operators.predicates import is_closed, wanted
from ..sources import readers, schemas
from ..sources.readers import CityConfig
from ..streaming.logs import exists
from .scratch import Scratch, measured

_STEP = 1 << 40  # sources follow one another in seq
CRAWL_VERSION = 4  # of crawl records


@dataclass
class Run:
    """Relations of a run; all lazy."""

    venues: DataFrame
    emails: DataFrame
    sites: DataFrame
    social: DataFrame
    rejected: DataFrame
    summary: DataFrame
    master: DataFrame | None = None
    report: DataFrame | None = None


def collect_boroughs(elements: DataFrame, register: DataFrame | None, today: str, categories: list[str] | None = None) -> DataFrame:
    """Open, named venues of the map, and those of the register that the map lacks; ``register`` has ``unit``."""
    got = readers.element_venues(readers.food_elements(elements)).where(F.col("name") != "").where(~is_closed(F.col("tags"), today))
    if register is not None:
        extra = readers.register_venues(register, F.col("unit")).where(F.col("name") != "")
        got = got.unionByName(joins.not_on_map(extra, got).withColumn("seq", F.col("seq") + _STEP))
    # written, as a filter would repeat the long expression of the categories, beyond what code can be generated for
    told = got.withColumn("categories", text.categorize(F.col("tags"), F.col("tags")["name"]))
    told = Scratch(measured(elements.sparkSession), "categories").put(told)
    return resolve.drop_repeats(told.where(wanted(F.col("categories"), categories or [])))


def extra_area(elements: DataFrame, register: DataFrame, places: DataFrame, name: str, metres: float, today: str) -> DataFrame | None:
    """Venues within ``metres`` of the place ``name``, for areas outside all units; None if there is no such place."""
    at = readers.place_point(places, name)
    if at is None:
        return None
    near = geo.located(F.col("lat")) & geo.within(F.lit(at[0]), F.lit(at[1]), F.col("lat"), F.col("lon"), metres)
    return collect_boroughs(readers.around(elements, *at, metres), register, today).where((F.col("source") != "food standards agency") | near)


def localise(venues: DataFrame, local: str, scratch: Scratch) -> DataFrame:
    """Names in the local script stand aside where an English one exists; categories follow the name that is shown.

    Names are written first: a category has them in many places, and code for their expressions in each would be too long.
    """
    is_local = F.col("name").rlike(local) if local else F.lit(False)
    out = venues.withColumns({"latin_name": ~is_local, "name_local": F.when(is_local, F.col("name")).otherwise("")})
    out = out.withColumn("name", F.when(is_local & (F.col("name_en") != ""), F.col("name_en")).otherwise(F.col("name")))
    return scratch.put(out).withColumn("categories", text.categorize(F.col("tags"), F.col("name"))).select(venues.columns)


def collect_city(elements: DataFrame, config: CityConfig, today: str, places: DataFrame | None = None, divisions: DataFrame | None = None, partners: list[tuple[dict, DataFrame]] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Venues of a city from map, catalogue and partners; the second value is the partners' report."""
    scratch = Scratch(measured(elements.sparkSession), "collect")
    got = readers.element_venues(readers.food_elements(elements)).where(F.col("name") != "").where(~is_closed(F.col("tags"), today))
    got = resolve.drop_repeats(scratch.put(localise(got.withColumn("area", F.col("borough")), config.local_script, scratch)))
    if places is not None and config.overture:
        rows = readers.catalogue(places, divisions, config)
        if not config.osm_areas:
            label = joins.district_labels(rows.select(F.col("district").alias("name")), got.select(F.col("borough").alias("label")).distinct())
            rows = rows.join(label.withColumnRenamed("name", "district"), "district").withColumn("district", F.col("label")).drop("label")
        rows = scratch.put(rows.orderBy("id", "district").withColumn("seq", F.monotonically_increasing_id() + _STEP * 2))
        extra = localise(readers.catalogue_venues(rows), config.local_script, scratch).withColumn("area", F.col("borough"))
        got, _ = resolve.merge_places(got, extra, config.country_code)
    report = None
    if partners:
        got = resolve.collect_social(got)
        rows = None
        for i, (spec, table) in enumerate(partners):
            one = readers.partner_venues(table, spec)
            keep = one.select("line", "excluded")
            one = readers.venue_rows(one.withColumn("seq", F.col("line") + _STEP * (3 + i))).join(keep.select((F.col("line") + _STEP * (3 + i)).alias("seq"), "excluded"), "seq")
            rows = one if rows is None else rows.unionByName(one)
        flags = rows.select("seq", "excluded")
        rows = scratch.put(resolve.collect_social(rows.drop("excluded")).join(flags, "seq"))
        acts, report = resolve.merge_partners(got, rows, config.country_code)
        got = resolve.with_partners(got, rows.drop("excluded"), acts, config.local_script)
    if config.sub_areas:
        got = joins.label_sub_areas(got, config.sub_areas)
    return got, report


@dataclass
class Logs:
    """Folders of JSON lines that runs append to, so that a later run only tries what no earlier one has."""

    crawl: str = ""
    discovery: str = ""


def known_records(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """What earlier runs have logged, if there is a log."""
    return readers.read_log(spark, path, schema) if path and exists(spark, path) else None


def _append(rows: DataFrame, path: str, known: DataFrame | None) -> DataFrame:
    """Appends ``rows`` after all that the log has, and returns them with their places."""
    last = -1 if known is None else known.agg(F.max("pos")).first()[0]
    rows = Scratch(measured(rows.sparkSession), "log").put(rows.withColumn("pos", F.monotonically_increasing_id() + F.lit((-1 if last is None else last) + 1)))
    if path:
        relations.append_log(rows, path)
    return rows


def find_sites(venues: DataFrame, pages: DataFrame, dns: DataFrame, config: CityConfig | None, limit: int = 0, log: str = "") -> DataFrame:
    """Sites found by name, in this run or an earlier one; ``limit`` venues that no run has tried are tried."""
    known = known_records(venues.sparkSession, log, schemas.DISCOVERY_LOG)
    new = enrich.discover(enrich.queue(venues, known, limit), pages, dns, config)
    # venues of one name and postcode share a record, the last one tried
    new = readers.last_wins(new, "key", "seq").select("key", "website", "evidence", "tried")
    new = _append(new, log, known)
    every = new if known is None else new.unionByName(known.select(new.columns))
    return joins.take_discovery(venues, readers.last_wins(every, "key"))


def read_sites(venues: DataFrame, pages: DataFrame, log: str = "") -> DataFrame:
    """What the venues' sites say; sites with a fresh record are not read again."""
    known = known_records(venues.sparkSession, log, schemas.CRAWL_LOG)
    todo = venues.where("website <> ''").select("website")
    if known is not None:
        fresh = readers.last_wins(readers.fresh_crawls(known), "key")
        todo = todo.withColumn("key", text.crawl_key(F.col("website"))).join(fresh.select("key"), "key", "left_anti").select("website")
    new = _append(enrich.crawl(todo, pages).withColumn("v", F.lit(CRAWL_VERSION)), log, known)
    if known is not None:
        new = readers.last_wins(new.unionByName(fresh.select(new.columns)), "key")
    return joins.take_crawl(venues, new)


def enrich_venues(
    venues: DataFrame, wikidata: DataFrame | None, pages: DataFrame | None, dns: DataFrame | None, config: CityConfig | None, limit: int = 0, logs: Logs | None = None, lookup: DataFrame | None = None,
) -> DataFrame:
    """Contacts split, sites from items, chains and searches, then what the sites say; ``lookup`` is a table of sites by seq."""
    scratch, logs = Scratch(measured(venues.sparkSession), "enrich"), logs or Logs()
    got = scratch.put(relations.split_contacts(venues))  # written, as what follows would repeat its expressions in filters
    if wikidata is not None:
        got = joins.add_wikidata(got, wikidata)
    got = scratch.put(joins.add_brand_sites(got))
    if pages is not None and dns is not None:  # a search needs both
        if config is not None and config.english_priority:
            got = got.withColumn("english_hint", text.english_hint(F.col("categories"), F.col("latin_name"))).select(venues.columns)
        got = scratch.put(find_sites(got, pages, dns, config, limit, logs.discovery))
    if lookup is not None:
        got = joins.take_places_lookup(got, lookup)
    if pages is not None:
        got = read_sites(got, pages, logs.crawl)
    return scratch.put(got)


def borough_run(venues: DataFrame, areas: DataFrame, place_nodes: DataFrame, mx: DataFrame, wikidata: DataFrame | None = None, pages: DataFrame | None = None, dns: DataFrame | None = None, **more) -> Run:
    """The job over boroughs: areas, contacts, validation, and one row per e-mail, site and profile.

    The summary has the areas of boroughs that have venues. ``more`` goes to ``enrich_venues``.
    """
    located = joins.locate_areas(areas, place_nodes, venues)
    got = enrich_venues(joins.assign_areas(venues, located), wikidata, pages, dns, None, **more)
    live, rejected = joins.validate(got.where("not closed"), mx)
    live = Scratch(measured(venues.sparkSession), "live").put(resolve.collect_social(live))
    order = relations.by_borough()
    emails, sites = relations.email_rows(live, order), relations.site_rows(live, order)
    return Run(live, emails, sites, relations.social_rows(live, order), rejected, relations.area_summary(emails, sites, located.join(venues.select("borough").distinct(), "borough", "left_semi")))


def city_run(venues: DataFrame, config: CityConfig, mx: DataFrame, wikidata: DataFrame | None = None, pages: DataFrame | None = None, dns: DataFrame | None = None, **more) -> Run:
    """The job over a city: contacts, validation, scores, master list and relations.

    E-mail and site relations hold contacts as they were before the master list filled blanks, the social relation those after.
    """
    scratch = Scratch(measured(venues.sparkSession), "city")
    got = enrich_venues(venues, wikidata, pages, dns, config, **more)
    live, rejected = joins.validate(got.where("not closed"), mx)
    live = scratch.put(relations.score(resolve.collect_social(live)))
    order = relations.by_score()
    emails, sites = relations.email_rows(live, order), relations.site_rows(live, order)
    # the fold reads venues in the order of the lists
    ranked = scratch.put(_ranked(live))
    kept, _ = resolve.master(ranked.drop("seq").withColumnRenamed("place", "seq"), config.country_code)
    kept = scratch.put(kept)
    filled = ranked.join(kept.select(F.col("seq").alias("place"), *[F.col(c).alias(f"_{c}") for c in ("email", "website", "phone")]), "place", "left")
    filled = filled.select(*[F.coalesce(f"_{c}", c).alias(c) if c in ("email", "website", "phone") else F.col(c) for c in live.columns])
    return Run(live, emails, sites, relations.social_rows(filled, order), rejected, relations.district_summary(live, emails, sites), master=kept)


def _ranked(live: DataFrame) -> DataFrame:
    """``live`` with ``place``, an ordinal in the order of the lists: unique and ascending, with gaps.

    Rows are ranged by score, borough and name and numbered inside their range, so no task sees them all.
    """
    n = max(1, int(live.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return live.repartitionByRange(n, *relations.by_score()).sortWithinPartitions(*relations.by_score()).withColumn("place", F.monotonically_increasing_id())
