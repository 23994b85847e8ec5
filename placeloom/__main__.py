"""Runs a job over a folder of tables: ``python -m placeloom boroughs|city --tables DIR --out DIR``.

The folder has ``elements`` and ``places`` (map JSON, a file for each unit), ``areas.csv``, ``register`` (JSON, a folder
``unit=NAME`` for each unit), ``pages`` and ``dns`` (parquet), ``mx`` (JSON lines), ``wikidata`` (JSON), ``catalogue/places`` and
``catalogue/divisions`` (parquet), and the city's ``config.json`` with its partner lists. What is missing is left out. Logs of
crawls and searches are appended to under ``--logs``, so a later run goes on where this one ended.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession

from .operators import enrich, relations
from .plans import jobs
from .plans.scratch import Scratch
from .sources import readers, schemas
from .streaming.logs import exists


def _options(argv: list[str] | None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="placeloom", description=__doc__)
    ap.add_argument("job", choices=["boroughs", "city"])
    ap.add_argument("--tables", required=True, help="folder of the input tables")
    ap.add_argument("--out", required=True, help="folder of the lists")
    ap.add_argument("--logs", default="", help="folder of the logs (default: none are kept)")
    ap.add_argument("--units", nargs="*", default=[], help="units that contain one of these texts (default: all)")
    ap.add_argument("--categories", nargs="*", default=[], help="venues of these categories only")
    ap.add_argument("--no-register", action="store_true", help="without the register's venues")
    ap.add_argument("--no-crawl", action="store_true", help="without reading venues' sites")
    ap.add_argument("--search", type=int, default=0, metavar="N", help="look for the sites of N venues by name (with --until-done again and again)")
    ap.add_argument("--until-done", action="store_true", help="search on until no venue is left to try")
    ap.add_argument("--today", default=datetime.date.today().isoformat())
    return ap.parse_args(argv)


class _Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str | None:
        return p if exists(self.spark, p := f"{self.root}/{name}") else None

    def elements(self, name: str) -> DataFrame | None:
        return readers.read_elements(self.spark, p) if (p := self.path(name)) else None

    def parquet(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(p) if (p := self.path(name)) else None

    def mx(self) -> DataFrame:
        if p := self.path("mx"):
            return readers.last_wins(readers.read_log(self.spark, p, schemas.MX_LOG), "domain").select("domain", "status")
        return self.spark.createDataFrame([], "domain string, status string")


def _write(run: jobs.Run, out: str, kind: str, units: DataFrame) -> None:
    by = "borough" if kind == "borough" else "district"
    for name, rows in (("emails", run.emails), ("websites", run.sites), ("social", run.social)):
        table = relations.layout(rows, f"{kind}_{name}")
        relations.write_csv(table, f"{out}/{name}")
        if name != "social":
            relations.write_csv(table, f"{out}/{name}_by_{by}", by, units)
    relations.write_csv(run.rejected, f"{out}/rejected")
    relations.write_csv(run.summary, f"{out}/summary")
    if run.master is not None:
        relations.write_csv(relations.layout(run.master, "city_master"), f"{out}/master")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    told = _options(argv)
    spark = spark or SparkSession.builder.appName("placeloom").getOrCreate()
    tables = _Tables(spark, told.tables)
    scratch = Scratch(spark, "run")
    elements = readers.pick_units(tables.elements("elements"), told.units, "unit")
    units = elements.select("unit").distinct()
    pages, dns = tables.parquet("pages"), tables.parquet("dns")
    wikidata = readers.read_wikidata(spark, p) if (p := tables.path("wikidata")) else None
    logs = jobs.Logs(f"{told.logs}/crawl", f"{told.logs}/discovery") if told.logs else None
    if told.job == "boroughs":
        register = None if told.no_register or not (p := tables.path("register")) else readers.pick_units(readers.read_register(spark, p), told.units, "unit")
        config, kind = None, "borough"
        venues = jobs.collect_boroughs(elements, register, told.today, told.categories)
    else:
        config, kind = readers.CityConfig.read(spark, f"{told.tables}/config.json"), "city"
        partners = [(spec, readers.read_partner(spark, f"{told.tables}/{spec['path']}")) for spec in config.partner_csvs]
        venues, report = jobs.collect_city(elements, config, told.today, tables.parquet("catalogue/places"), tables.parquet("catalogue/divisions"), partners)
        if report is not None:
            relations.partner_report(report).coalesce(1).write.mode("overwrite").text(f"{told.out}/partner_report")
    venues = scratch.put(venues)
    if told.search and logs and told.until_done and pages is not None and dns is not None:
        todo = relations.split_contacts(venues)
        while enrich.queue(todo, jobs.known_records(spark, logs.discovery, schemas.DISCOVERY_LOG)).limit(1).count():
            jobs.find_sites(todo, pages, dns, config, told.search, logs.discovery)
    more = {"limit": told.search, "logs": logs, "pages": None if told.no_crawl else pages, "dns": dns if told.search else None, "wikidata": wikidata}
    if told.job == "boroughs":
        nodes = tables.elements("places")
        places = readers.place_nodes(nodes) if nodes is not None else spark.createDataFrame([], "ord long, name string, lat double, lon double")
        run = jobs.borough_run(venues, readers.read_areas(spark, f"{told.tables}/areas.csv"), places, tables.mx(), **more)
    else:
        run = jobs.city_run(venues, config, tables.mx(), **more)
    _write(run, told.out.rstrip("/"), kind, units)
    scratch.clear()


if __name__ == "__main__":
    main()
