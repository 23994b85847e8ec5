"""Row filters of the venue pipeline as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text
from ..functions import values as V


def is_closed(tags: Column, today: str) -> Column:
    """Marked as closed, disused or demolished on the map; ``today`` is an ISO date."""
    tag = lambda k: text.blank(tags[k])
    gone = F.lit(False)
    for k in V.CLOSED_TAGS:
        gone |= tag(k).isin("yes", "permanently")
    end = F.substring(tag("end_date"), 1, 10)
    return (
        gone | F.lower(text.strip(tag("opening_hours"))).isin("closed", "off") | ((end != "") & (end <= today))
        | tag("name").rlike("(?iu)" + V.CLOSED_NAME) | tag("note").rlike("(?iu)" + V.CLOSED_NOTE)
    )


def wanted(categories: Column, names: list[str]) -> Column:
    return F.arrays_overlap(categories, text.strings(names)) if names else F.lit(True)


def has_email() -> Column:
    return F.col("email") != ""


def has_site() -> Column:
    return (F.col("website") != "") & ~text.not_venue_site(F.col("website"))


def only_social() -> Column:
    return (F.col("email") == "") & (F.col("website") == "") & (F.col("social_url") != "")
