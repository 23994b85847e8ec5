"""Output relations, summaries and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions import values as V
from ..plans.scratch import Scratch
from . import numbering
from .predicates import has_email, has_site, only_social
from .resolve import unique_rows
from .skew import bounded


def by_borough() -> list[Column]:
    return [F.col("borough"), F.lower("name"), F.col("seq")]


def by_score() -> list[Column]:
    """As ascending columns; what has no score comes last."""
    return [F.coalesce(-F.col("english_score"), F.lit(1 << 30)), F.col("borough"), F.lower("name"), F.col("seq")]


def email_rows(venues: DataFrame, order: list[Column]) -> DataFrame:
    return unique_rows(venues.where(has_email()), F.col("email"), order)


def site_rows(venues: DataFrame, order: list[Column]) -> DataFrame:
    return unique_rows(venues.where(has_site()), text.site_key(F.col("website")), order)


def social_rows(venues: DataFrame, order: list[Column]) -> DataFrame:
    return unique_rows(venues.where(only_social()), F.col("social_url"), order)


def score(venues: DataFrame) -> DataFrame:
    return venues.withColumns(text.english(F.col("site_language"), F.col("categories"), F.col("latin_name"))).select(venues.columns)


def split_contacts(venues: DataFrame) -> DataFrame:
    """First clean address as email, the rest as other_emails; a site that is not the venue's own becomes social_website."""
    found = text.clean_emails(text.split_emails(F.col("email")))
    site = text.normalize_url(F.col("website"))
    out = venues.withColumn("_f", found).withColumn("_w", site)
    other = (F.col("_w") != "") & text.not_venue_site(F.col("_w"))
    has = F.size("_f") > 0
    return (
        out.withColumn("email", text.blank(F.try_element_at("_f", F.lit(1)))).withColumn("other_emails", F.slice("_f", F.lit(2), F.greatest(F.size("_f") - 1, F.lit(0))))
        .withColumn("email_source", F.when(has, F.substring_index(text.first_filled(F.col("source"), F.lit("openstreetmap")), " + ", 1)).otherwise(""))
        .withColumn("social_website", F.when(other, F.col("_w")).otherwise(F.col("social_website"))).withColumn("website", F.when(other, "").otherwise(F.col("_w")))
        .withColumn("website_type", F.when(F.col("website") != "", "own site").otherwise("")).select(venues.columns)
    )


def area_summary(emails: DataFrame, sites: DataFrame, areas: DataFrame) -> DataFrame:
    """(borough, area, emails, websites): listed areas in their order, then others by name; areas has ord, borough, area."""
    count = lambda d, n: d.groupBy("borough", "area").agg(F.count(F.lit(1)).alias(n))
    both = count(emails, "emails").join(count(sites, "websites"), ["borough", "area"], "full")
    all_ = areas.select("ord", "borough", "area").join(both, ["borough", "area"], "full")
    name = F.when(F.col("ord").isNull() & (F.col("area") == ""), "(unassigned)").otherwise(F.col("area"))
    return all_.orderBy(F.col("ord").asc_nulls_last(), "borough", "area").select("borough", name.alias("area"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("emails", "websites")])


def district_summary(venues: DataFrame, emails: DataFrame, sites: DataFrame) -> DataFrame:
    """(district, venues, emails, websites, high_priority_emails, high_priority_websites), by district."""
    high = F.count_if(F.col("english_priority") == "High")
    part = lambda d, n: d.groupBy("borough").agg(F.count(F.lit(1)).alias(n), high.alias(f"high_priority_{n}"))
    out = venues.groupBy("borough").agg(F.count(F.lit(1)).alias("venues")).join(part(emails, "emails"), "borough", "left").join(part(sites, "websites"), "borough", "left")
    return out.orderBy("borough").select(F.col("borough").alias("district"), "venues", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("emails", "websites", "high_priority_emails", "high_priority_websites")])


def totals(venues: DataFrame) -> DataFrame:
    """One row of run totals."""
    return venues.agg(
        F.count(F.lit(1)).alias("venues"), F.count_if("closed").alias("closed"), F.count_if(~F.col("closed") & ((F.col("email") != "") | (F.col("website") != ""))).alias("reachable"),
    )


def reject_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def document_order(rows: DataFrame) -> DataFrame:
    """The order of printed lists: by priority, district and name where rated; else by borough, area (blank last) and name."""
    return rows.orderBy(*_document_keys(rows))


def _document_keys(rows: DataFrame) -> list[Column]:
    if "english_priority" in rows.columns:
        rank = F.when(F.col("english_priority") == "High", 0).when(F.col("english_priority") == "Medium", 1).otherwise(2)
        return [rank, F.coalesce(F.nullif("district", F.lit("")), "borough") if "borough" in rows.columns else F.col("district"), F.lower("name")]
    return [F.col("borough"), F.when(F.col("area") == "", "~").otherwise(F.col("area")), F.lower("name")]


def document(rows: DataFrame, kind: str, tie: str = "seq", per_page: int = 30) -> DataFrame:
    """A printed list of ``kind`` (emails, websites or social) as rows: number, section, anchor, page, name, target, shown, details.

    Sections are priorities where rows are rated, else boroughs; the index is page 1, each section starts a page, and a page holds
    ``per_page`` rows. ``tie`` orders rows that are equal otherwise. Numbers have no gaps (see ``numbering``); the sections,
    a row for each borough, are summed in one task.
    """
    scratch = Scratch(rows.sparkSession, "document")
    rated = "english_priority" in rows.columns
    section = F.concat("english_priority", F.lit(" English priority")) if rated else F.col("borough")
    keys = _document_keys(rows)
    told = numbering.numbered(rows.withColumn("section", section), [*keys, F.col(tie)], "number", scratch)
    parts = told.groupBy("section").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    pages = F.coalesce(F.sum(F.ceil(F.col("n") / per_page)).over(before), F.lit(0))
    parts = parts.select("section", "first", (F.lit(2) + pages).alias("page"))
    told = told.join(bounded(parts), "section").withColumn("page", (F.col("page") + F.floor((F.col("number") - F.col("first")) / per_page)).cast("long"))

    value = {"emails": "email", "websites": "website", "social": "social_url"}[kind]
    target = F.concat(F.lit("mailto:"), "email") if kind == "emails" else F.col(value)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "(?s)^.*?://", ""), r"^www\.", ""), "/+$", "")
    shown = F.col("email") if kind == "emails" else bare
    if kind == "websites":
        shown = F.when(F.length(bare) > 48, F.concat(F.substring(bare, 1, 45), F.lit("..."))).otherwise(bare)
    has = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    local = F.when(has("name_local") != F.col("name"), F.col("name_local")) if "name_local" in rows.columns else F.lit(None)
    language = F.concat(F.lit("site: "), has("site_language")) if rated else F.lit(None)
    branches = F.when(has("locations") != "1", F.concat(has("locations"), F.lit(" branches")))
    details = F.concat_ws(" \u00b7 ", local, F.coalesce(has("district"), has("area")), has("categories"), has("phone"), language, has("email") if kind == "websites" else F.lit(None), branches)
    anchor = F.concat(F.lit("b_"), F.regexp_replace("section", r"[^\p{L}\p{N}]", ""))
    return told.select("number", "section", anchor.alias("anchor"), "page", "name", target.alias("target"), shown.alias("shown"), details.alias("details"))


def layout(rows: DataFrame, name: str) -> DataFrame:
    """The columns of an output, lists joined by "; "."""
    if "borough" in rows.columns and "district" not in rows.columns:
        rows = rows.withColumn("district", F.col("borough"))
    joined = {c: F.array_join(c, "; ") for c in ("categories", "other_emails") if c in rows.columns and rows.schema[c].dataType.typeName() == "array"}
    return rows.withColumns(joined).select(*V.LAYOUTS[name])


def _file_name(c: Column) -> Column:
    """Runs of other characters than letters, digits and underscores as one underscore."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\W+", "_"), "^_+|_+$", "")


def write_csv(rows: DataFrame, path: str, by: str | None = None, every: DataFrame | None = None) -> None:
    """CSV with a header; one folder per value of ``by`` where it is given.

    Values of ``every`` (one column, a short list of units) that have no rows get a file of the header alone.
    """
    option = {"header": True, "escape": '"'}
    if by is None:
        rows.write.mode("overwrite").options(**option).csv(path)
        return
    rows.withColumn("part", _file_name(F.col(by))).write.mode("overwrite").options(**option).partitionBy("part").csv(path)
    if every is not None:
        parts = every.select(_file_name(F.col(every.columns[0])).alias("part")).distinct()
        for r in parts.join(rows.select(_file_name(F.col(by)).alias("part")).distinct(), "part", "left_anti").collect():
            rows.limit(0).coalesce(1).write.mode("overwrite").options(**option).csv(f"{path}/part={r.part}")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def partner_report(report: DataFrame) -> DataFrame:
    """One JSON text of counts by outcome."""
    return report.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n"))))).alias("report"))
