"""Entity resolution. Each rule reads rows in order and changes the state that later rows see, so rows that can
influence one another are brought together: small groups are replayed by ``seq`` (``replay``), large ones settle in parallel rounds as
far as keys decide (``greedy``). Everything else runs apart and never leaves the JVM.

What is compared is prepared by column expressions: folded names, and the keys of addresses, sites, phones and places.
``Rule`` says which of them lead to an earlier row, which prove it the same, and which blanks it fills.
"""

from __future__ import annotations

from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo, text
from ..plans.scratch import Scratch, measured, ship
from . import near
from . import partners as partners_
from .components import components
from .greedy import settle
from .replay import Rule, first_filled, replay
from .skew import with_values

HELD = 20_000  # rows of a component that one task replays before others

_STRINGS = "array<string>"


def _star(keys: DataFrame, scratch: Scratch, key: str = "k") -> DataFrame:
    """Links of every row to the first row with the same key; linear in the rows."""
    total = keys.count()
    first = scratch.put(keys.groupBy(key).agg(F.count(F.lit(1)).alias("c"), F.min("seq").alias("b")).where("c > 1"), total)
    met = with_values(keys.select("seq", key), first, key, "seq", total)
    return met.where("seq <> b").select(F.col("seq").alias("a"), "b").distinct()


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    return components(links, scratch).withColumnRenamed("node", "seq")


def _matched(rows: DataFrame, rule: Rule, scratch: Scratch, held: int) -> DataFrame:
    """(seq, into) for the rows of (seq, keys, what ``rule`` reads) that join an earlier one; sure keys are the rule's.

    Components up to ``held`` rows are replayed. The rows of larger ones settle in rounds (see ``greedy``); what is still open
    then, as it depends on names, places or values that others were given, is replayed with the rows that it can meet only.
    """
    keys = scratch.put(rows.select("seq", F.posexplode("keys").alias("pos", "k")))
    roots = _roots(_star(keys, scratch), scratch)
    large = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > held).select("root")
    large = scratch.put(large)
    if not large.limit(1).count():
        return replay(rows, roots, rule, scratch).where("into is not null").select("seq", "into")

    few = replay(rows, roots.join(large, "root", "left_anti"), rule, scratch).where("into is not null").select("seq", "into")
    sure = F.substring("k", 1, 1).isin(list(rule.sure))
    own = scratch.put(keys.join(roots.join(large, "root", "left_semi").select("seq"), "seq").withColumn("sure", sure))
    few_open = min(HELD, own.select("seq").distinct().count() // 10)  # one task replays these and what they meet
    joined, stayed, open_ = (scratch.put(t) for t in settle(own, scratch, few=few_open))
    if not open_.limit(1).count():
        return few.unionAll(joined)

    asks = own.join(open_, "seq").select("k").distinct()
    meets = own.join(stayed, "seq").join(asks, "k", "left_semi").select("seq").distinct()
    meets = scratch.put(meets.select("seq", F.col("seq").alias("_told")))
    fills = list(rule.fills)
    given = joined.join(meets.select(F.col("seq").alias("into")), "into").join(rows.select("seq", *fills), "seq")
    first = [F.min(F.when(F.col(c) != "", F.col("seq"))) for c in fills]
    given = given.groupBy("into").agg(F.array_distinct(F.array_compact(F.array(*first))).alias("s")) if fills else None
    part = open_.select("seq", F.lit(None).cast("long").alias("_told")).unionAll(meets)
    if given is not None:
        part = part.unionAll(given.select(F.explode("s").alias("seq"), F.col("into").alias("_told")))
    part = scratch.put(part)
    links = _star(own.join(part.where("_told is null or _told = seq").select("seq"), "seq"), scratch)
    links = links.unionAll(part.where("_told <> seq").select(F.col("seq").alias("a"), F.col("_told").alias("b")))
    rest = replay(rows.join(part, "seq"), _roots(links, scratch), replace(rule, told="_told"), scratch)
    rest = rest.join(open_, "seq", "left_semi").where("into is not null").select("seq", "into")
    return few.unionAll(joined).unionAll(rest)


def _settled(rows: DataFrame, acts: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` that stay, with the values of ``columns`` after the replay."""
    done = acts.select("seq", "into", *[F.col(c).alias(f"_{c}") for c in columns])
    kept = rows.join(done, "seq", "left").where("into is null")
    return kept.select([F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def _prepared(rows: DataFrame, country: str) -> DataFrame:
    """``rows`` with what rules compare: folded and plain name, and the keys of address, site and phone (empty where there is none)."""
    return rows.withColumns(
        {
            "_fold": F.replace(text.fold(F.col("name")), F.lit(" "), F.lit("")), "_raw": text.strip(text.blank(F.col("name"))), "_mail": F.lower(text.blank(F.col("email"))),
            "_site": text.site_key(F.col("website")), "_phone": text.phone_key(F.col("phone"), country),
        }
    )


def _spot(rows: DataFrame) -> Column:
    """The cell of three decimals, rounded from the exact binary value; null without a place."""

    @F.pandas_udf(T.StringType())
    def key(lat: pd.Series, lon: pd.Series) -> pd.Series:
        at = zip(lat.astype(float).tolist(), lon.astype(float).tolist(), strict=True)
        return pd.Series([None if a != a or b != b else f"{round(a, 3) + 0.0}:{round(b, 3) + 0.0}" for a, b in at], dtype=object)

    return key("lat", "lon")


def _listed(*keys: Column) -> Column:
    return F.coalesce(F.array_compact(F.array(*keys)), F.array().cast(_STRINGS))


_FILL = ["email", "website", "phone", "facebook", "instagram"]


def drop_repeats(venues: DataFrame, held: int = HELD) -> DataFrame:
    """Keeps a venue unless a kept earlier one has its name and (postcode or address, site), or its name and place to three places.

    Rows meet those they share a key with, so the branches of a chain at different places stay apart.
    """
    scratch = Scratch(measured(venues.sparkSession), "repeats")
    low = lambda c: F.lower(text.blank(F.col(c)))
    where = F.when(low("postcode") != "", low("postcode")).otherwise(low("address"))
    thin = venues.select("seq", low("name").alias("n"), where.alias("p"), low("website").alias("w"), F.when(geo.located(F.col("lat"), F.col("lon")), F.col("lat")).alias("lat"), "lon")
    spot = _spot(thin)
    keys = _listed(F.to_json(F.struct(F.lit("a").alias("k"), "n", "p", "w")), F.when(spot.isNotNull(), F.to_json(F.struct(F.lit("b").alias("k"), "n", spot.alias("s")))))
    thin = scratch.put(thin.select("seq", keys.alias("keys")))
    gone = _matched(thin, Rule("keys", "keys", {}, sure="{"), scratch, held)
    return venues.join(gone.select("seq"), "seq", "left_anti")


def merge_places(venues: DataFrame, places: DataFrame, country: str = "", metres: float = 150) -> tuple[DataFrame, DataFrame]:
    """Adds catalogue places to venues unless an earlier row nearby has the name within ``metres``, or the phone; then it fills blanks.

    Both need ``seq``, places after venues. Returns all kept rows, and (seq, into) of the merged places. Rows that could meet
    have names that contain one another within ``metres`` (see ``near``), or share a phone within two cells (a phone may be filled
    once from one cell away, and matched from one further).
    """
    scratch = Scratch(measured(venues.sparkSession), "places")
    columns = venues.columns
    both = venues.select("*", F.lit(False).alias("_new")).unionByName(places.select(*columns, F.lit(True).alias("_new")).where(geo.located(F.col("lat")) & (F.col("name") != "")))
    cells = {"cy": F.when(geo.located(F.col("lat")), geo.cell(F.col("lat"), 200)), "cx": F.when(geo.located(F.col("lat")), geo.cell(F.col("lon"), 200))}
    cell = lambda dy, dx: F.concat_ws("/", F.col("cy") + dy, F.col("cx") + dx)
    here = F.col("cy").isNotNull()
    around = F.array(*[cell(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    none = F.array().cast(_STRINGS)
    rows = _prepared(both, country).withColumns(cells).withColumns({"_post": F.when(here, F.array(cell(0, 0))).otherwise(none), "_probe": F.when(here, around).otherwise(none)})
    rows = scratch.put(rows.select("seq", "_new", "cy", "cx", "lat", "lon", "_fold", "_raw", "_phone", "_post", "_probe", *_FILL))
    at = rows.where("cy is not null")

    named = near.named_pairs(at.withColumn("side", F.col("_new").cast("int")), metres, scratch).where("x_side = 1 or y_side = 1")
    first = F.col("x_seq") < F.col("y_seq")
    early = lambda c: F.when(first, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}"))
    late = lambda c: F.when(first, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}"))
    named = named.where(geo.within(early("lat"), early("lon"), late("lat"), late("lon"), metres))
    links = named.select(late("seq").alias("a"), early("seq").alias("b")).distinct()
    # equal phones: every row is tied to the first of its phone in each cell around, which ties all within two cells
    phones = at.where("_phone <> ''").select("seq", "_phone", F.explode("_probe").alias("c"))
    links = links.unionAll(_star(phones.select("seq", F.concat_ws("/", "_phone", "c").alias("k")), scratch))

    fills: dict[str, str | None] = {c: "_phone" if c == "phone" else None for c in _FILL}
    rule = Rule("_probe", "_post", fills, equal=("_phone",), metres=metres, measured_at_holder=True, joins="_new")
    acts = replay(rows, _roots(links, scratch), rule, scratch)
    return _settled(both, acts, _FILL).select(columns), acts.where("into is not null").select("seq", "into")


def master(venues: DataFrame, country: str = "", held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """One row per venue by e-mail, site, phone, or name and place; blanks are filled and ``merged`` counts the rows.

    Returns the kept rows and (seq, into). Keys are those a row had when it was read; the match itself sees filled values. Two rows
    with one e-mail, site or phone as a key are always the same, so chains of any size settle in rounds.
    """
    scratch = Scratch(measured(venues.sparkSession), "master")
    rows = _prepared(venues, country)
    spot = _spot(rows)
    keyed = lambda p, c: F.when(F.col(c) != "", F.concat(F.lit(p), c))
    where = F.when(geo.located(F.col("lat")) & spot.isNotNull(), F.concat(F.lit("g:"), spot))
    rows = rows.withColumn("keys", _listed(keyed("e:", "_mail"), keyed("w:", "_site"), keyed("p:", "_phone"), where))
    rows = scratch.put(rows.select("seq", "lat", "lon", "_fold", "_raw", "_mail", "_site", "_phone", "keys", "email", "website", "phone"))
    fills: dict[str, str | None] = {"email": "_mail", "website": "_site", "phone": "_phone"}
    rule = Rule("keys", "keys", fills, equal=("_mail", "_site", "_phone"), sure="ewp", metres=100)
    gone = scratch.put(_matched(rows, rule, scratch, held))
    given = scratch.put(first_filled(gone, rows, list(fills)))
    done = given.select("seq", "joined", *[F.col(c).alias(f"_{c}") for c in fills])
    kept = venues.join(gone.select("seq"), "seq", "left_anti").join(done, "seq", "left")
    out = {c: F.when(text.blank(F.col(c)) == "", F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in fills}
    out["merged"] = F.col("merged") + F.coalesce("joined", F.lit(0))
    return kept.select([out[c].alias(c) if c in out else F.col(c) for c in venues.columns]), gone


def unique_rows(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order`` (ascending columns that tell rows apart), with ``locations``, the rows that share it.

    Each task reduces its rows of a key to the first before they meet, so a key that many rows share is one row a task.
    """
    keep = [c for c in rows.columns if c != "locations"]
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    first = rows.groupBy(key.alias("_k")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in keep]), place).alias("_r"), F.count(F.lit(1)).alias("_n"))
    return first.select(*[F.col(f"_r.`{c}`") for c in keep], F.col("_n").alias("locations"))


def collect_social(venues: DataFrame) -> DataFrame:
    """Canonical facebook, instagram and social_url of each venue."""
    tag = lambda k: F.coalesce(F.col("tags")[k], F.lit(""))
    site = text.blank(F.col("social_website"))
    fb = F.when(site.rlike(r"(?i)facebook\.com|fb\.com|fb\.me"), text.canonical_facebook(site)).otherwise("")
    ig = F.when(F.contains(F.lower(site), F.lit("instagram.com")), text.canonical_instagram(site)).otherwise("")
    out = venues.withColumns(
        {
            "facebook": text.first_filled(*[text.canonical_facebook(c) for c in (tag("contact:facebook"), tag("facebook"), F.col("facebook"))], fb),
            "instagram": text.first_filled(*[text.canonical_instagram(c) for c in (tag("contact:instagram"), tag("instagram"), F.col("instagram"))], ig),
        }
    )
    return out.withColumn("social_url", text.first_filled(F.col("instagram"), F.col("facebook"))).select(venues.columns)


def merge_partners(venues: DataFrame, partners: DataFrame, country: str = "") -> tuple[DataFrame, DataFrame]:
    """Merges partner venues (seq after all venues; ``excluded`` tells why a row is left out) by contact, then by unique name.

    Returns (seq, outcome, into, changed, contacts...) for every row, and the report (outcome, n).
    Both inputs have canonical social links. A name counts as unique if exactly one venue that is not a partner's has it.
    """
    ship(venues.sparkSession)
    scratch = Scratch(measured(venues.sparkSession), "partners")
    told = ["email", "website", "social_website", "phone", "facebook", "instagram", "source", "partner_notes"]
    own = venues.select("seq", "name", *told, F.lit(False).alias("_new"))
    rows = _prepared(own.unionByName(partners.where("excluded = ''").select("seq", "name", *told, F.lit(True).alias("_new"))), country)

    phones = F.filter(F.transform(F.split("phone", "[;,/]"), lambda x: text.phone_key(x, country)), lambda x: x != "")
    mails = F.filter(text.split_emails(F.col("_mail")), lambda e: F.contains(e, F.lit("@")))
    named = lambda p, xs: F.transform(xs, lambda x: F.concat(F.lit(p), x))
    site = F.when((F.col("website") != "") & ~text.not_venue_site(F.col("website")), F.col("_site"))
    social = [F.when(F.col(c) != "", F.concat(F.lit(p), F.lower(c))) for c, p in (("instagram", "i:"), ("facebook", "f:"))]
    keys = F.concat(named("e:", mails), _listed(*social), named("w:", _listed(site)), named("p:", phones))
    rows = scratch.put(rows.withColumn("keys", keys))

    long = rows.where(F.length("_fold") >= 6)
    held = long.where("not _new").groupBy("_fold").agg(F.count(F.lit(1)).alias("held"), F.min("seq").alias("_first")).where("held = 1")
    alone = scratch.put(long.where("_new").join(held, "_fold").select("seq", "_first"))
    # names and keys do not change, so what rows take over is left until all have found theirs
    joined = scratch.put(partners_.found(rows, alone, "eif", scratch))
    gains = partners_.taken(joined, rows, [*_FILL, "social_website"])

    after = gains.select("seq", "joined", *[F.col(c).alias(f"_{c}") for c in told]).join(joined, "seq", "full")
    outcome = F.when(~F.col("_new"), "ours").when(F.col("into").isNull(), "new").when(F.col("by") == "name", "merged by name").otherwise("merged")
    acts = rows.select("seq", "_new", *told).join(after, "seq", "left")
    acts = scratch.put(acts.select("seq", outcome.alias("outcome"), "into", (F.coalesce("joined", F.lit(0)) > 0).alias("changed"), *[F.coalesce(f"_{c}", c).alias(c) for c in told]))
    report = acts.where("outcome <> 'ours'").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    left_out = partners.where("excluded <> ''").groupBy(F.concat(F.lit("excluded: "), "excluded").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return acts, report.unionAll(left_out)


def with_partners(venues: DataFrame, partners: DataFrame, acts: DataFrame, local: str = "") -> DataFrame:
    """All venues after ``merge_partners``: ours with what they gained, and partner venues that stayed new."""
    from ..sources.readers import venue_rows

    gained = ["email", "website", "social_website", "phone", "facebook", "instagram", "source", "partner_notes"]
    changed = acts.where("outcome = 'ours' and changed").select("seq", *[F.col(c).alias(f"_{c}") for c in gained])
    ours = venues.join(changed, "seq", "left")
    ours = ours.select([F.coalesce(f"_{c}", c).alias(c) if c in gained else F.col(c) for c in venues.columns])
    new = partners.join(acts.where("outcome = 'new'").select("seq", *[F.col(c).alias(f"_{c}") for c in gained]), "seq")
    is_local = F.col("name").rlike(local) if local else F.lit(False)
    new = new.select(*[c for c in partners.columns if c not in gained], *[F.col(f"_{c}").alias(c) for c in gained])
    new = new.withColumns({"name_local": F.when(is_local, F.col("name")).otherwise(""), "latin_name": ~is_local})
    new = new.withColumn("categories", text.categorize(F.create_map(F.lit("amenity"), F.lit("restaurant")), F.col("name")))
    return ours.unionByName(venue_rows(new))

