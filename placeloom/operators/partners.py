"""How rows of partners find the venue that they join, and what it takes over, without a component in one task.

A row looks under its keys in turn and joins the earliest row that has stayed under the first key that leads to one. Some keys prove two
rows the same, others ask for names that agree. Here the name goes into the key: a row is found under (key, its name) and asks for (key, name) for each of the
names of that key that agree with its own. Rows found under one such token are all the same for whoever asks, so the first is enough, and
venues, which join nobody, are known to stay from the start. Partners settle in rounds as in ``greedy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch
from . import near
from .components import components
from .greedy import JOIN, NONE, WAIT
from .replay import Rule, first_filled, replay
from .skew import with_values

_BREAK = "[;,\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def _agreeing(named: DataFrame, scratch: Scratch) -> DataFrame:
    """(k, n, m): for the names of a key those that hold one another, the shorter with four letters at least; ``named`` is (k, _fold, new)."""
    names = scratch.put(named.where(F.length("_fold") >= 4).groupBy("k", "_fold").agg(F.max("new").alias("new")))
    wide = names.groupBy("k").agg(F.min(F.length("_fold")).alias("least"), F.max(F.length("_fold")).alias("most"), F.max("new").alias("any")).where("any and least < most").drop("any")
    names = scratch.put(names.join(wide, "k"))
    rare = near.rarest_runs(names.select("_fold").distinct(), scratch)
    x = names.where("length(_fold) < most").join(rare, "_fold").select("k", "g", F.col("_fold").alias("a"), F.col("new").alias("x"))
    y = names.where("length(_fold) > least").select("k", F.col("_fold").alias("b"), F.col("new").alias("y"), F.explode(near._runs(F.col("_fold"))).alias("g"))
    met = scratch.put(x.join(y, ["k", "g"]).where("(x or y) and length(a) < length(b) and contains(b, a)").select("k", "a", "b").distinct())
    return met.select("k", F.col("a").alias("n"), F.col("b").alias("m")).unionAll(met.select("k", F.col("b").alias("n"), F.col("a").alias("m")))


def found(rows: DataFrame, last: DataFrame, sure: str, scratch: Scratch, rounds: int = 12, least: float = 0.05) -> DataFrame:
    """(seq, into, by) of the rows of partners that join another; ``rows`` has seq, keys, _fold, _raw and _new, venues come before partners.

    Keys that start with one of ``sure`` prove the same, others ask for a name that agrees; ``last`` (seq, _first) tells whom a row joins that no key leads on.
    """
    every = rows.select("seq", "_new", "_fold", F.when(F.col("_fold") != "", F.concat(F.lit("="), "_fold")).when(F.col("_raw") != "", F.concat(F.lit("~"), "_raw")).alias("n"), F.posexplode("keys").alias("pos", "k"))
    proves = F.substring("k", 1, 1).isin(list(sure))
    own = scratch.put(every.where("_new"))
    ours = scratch.put(every.where("not _new").join(own.select("k").distinct(), "k", "left_semi"))
    agree = _agreeing(own.unionByName(ours).where(~proves).select("k", "_fold", F.col("_new").alias("new")), scratch)
    token = F.when(proves, F.col("k")).otherwise(F.concat("k", F.lit("\n"), "n"))
    plain = own.select("seq", "pos", token.alias("t")).where("t is not null")
    other = own.where(~proves).select("seq", "pos", "k", F.col("_fold").alias("n")).join(agree, ["k", "n"]).select("seq", "pos", F.concat("k", F.lit("\n="), "m").alias("t"))
    posts = own.select("seq", token.alias("t")).where("t is not null").distinct().join(last.select("seq"), "seq", "left_anti")
    posts, held = scratch.put(posts), scratch.put(ours.select("seq", token.alias("t")).where("t is not null").groupBy("t").agg(F.min("seq").alias("held")))
    # tokens that nobody is found under lead nowhere
    has = scratch.put(posts.select("t").unionAll(held.select("t")).distinct())
    asks = scratch.put(plain.unionAll(other).join(has, "t", "left_semi").distinct())
    total, joined = asks.count(), None
    open_ = asks.select("seq").distinct().count()
    for _ in range(rounds):
        if not open_:
            break
        first = posts.groupBy("t").agg(F.min("seq").alias("first"))
        values = scratch.put(asks.groupBy("t").agg(F.count(F.lit(1)).alias("c")).join(first, "t", "left").join(held, "t", "left"), total)
        told = with_values(asks, values, "t", "seq", total)
        before = lambda c: F.min(F.when(F.col(c) < F.col("seq"), F.col(c))).alias(c)
        told = told.groupBy("seq", "pos").agg(before("held"), before("first"))
        sure_ = F.col("held").isNotNull() & (F.col("first").isNull() | (F.col("held") < F.col("first")))
        told = told.withColumn("what", F.when(sure_, JOIN).when(F.col("first").isNotNull(), WAIT).otherwise(NONE))
        act = told.groupBy("seq").agg(F.min_by(F.struct("what", "held"), F.when(F.col("what") != NONE, F.col("pos"))).alias("x"))
        act = scratch.put(act.select("seq", F.coalesce("x.what", F.lit(NONE)).alias("what"), F.col("x.held").alias("into")), total)
        joins = act.where(F.col("what") == JOIN).select("seq", "into")
        joined = joins if joined is None else joined.unionAll(joins)
        more = posts.join(act.where(F.col("what") == NONE).select("seq"), "seq").groupBy("t").agg(F.min("seq").alias("held"))
        held = scratch.put(held.unionAll(more).groupBy("t").agg(F.min("held").alias("held")), total)
        wait = act.where(F.col("what") == WAIT).select("seq")
        asks, posts = scratch.put(asks.join(wait, "seq"), total), scratch.put(posts.join(wait, "seq"), total)
        was, open_ = open_, asks.select("seq").distinct().count()
        if was - open_ < least * was:
            break
    if open_:
        rest = _replayed(asks, posts, held, scratch)
        joined = rest if joined is None else joined.unionAll(rest)
    named = last.select("seq", F.col("_first").alias("into"))
    if joined is None:
        return named.withColumn("by", F.lit("name"))
    joined = scratch.put(joined)
    return joined.withColumn("by", F.lit("key")).unionAll(named.join(joined, "seq", "left_anti").withColumn("by", F.lit("name")))


def _replayed(asks: DataFrame, posts: DataFrame, held: DataFrame, scratch: Scratch) -> DataFrame:
    """(seq, into) of rows that wait for one another in long chains, replayed by component beside the first rows that stayed under what they ask for."""
    known = scratch.put(held.join(asks.select("t").distinct(), "t", "left_semi"))
    tied = asks.select("seq", "t").unionAll(known.select(F.col("held").alias("seq"), "t"))
    star = tied.join(tied.groupBy("t").agg(F.min("seq").alias("b")), "t").select(F.col("seq").alias("a"), "b").distinct()
    probe = asks.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("probe"))
    post = posts.unionAll(known.select(F.col("held").alias("seq"), "t")).groupBy("seq").agg(F.collect_list("t").alias("post"))
    both = scratch.put(probe.join(post, "seq", "full").withColumns({c: F.coalesce(c, F.array()) for c in ("probe", "post")}))
    done = replay(both, components(star, scratch).withColumnRenamed("node", "seq"), Rule("probe", "post", {}, sure="{", earliest=True), scratch)
    return done.where("into is not null").select("seq", "into")


def taken(joined: DataFrame, rows: DataFrame, fills: list[str]) -> DataFrame:
    """(seq, joined, ...) of each row that others joined, with all that it has after them: blanks filled, new addresses added, sources appended, the last notes."""
    first = first_filled(joined, rows, fills)
    each = joined.select("seq", "into").join(rows.select("seq", "email", "source", "partner_notes"), "seq")
    addresses = lambda c: F.filter(F.split(c, _BREAK), lambda x: F.contains(x, F.lit("@")))
    mails = each.select("into", "seq", F.posexplode(addresses("email")).alias("pos", "x")).groupBy("into", F.lower("x").alias("l"), "seq").agg(F.collect_list(F.struct("seq", "pos", "x")).alias("xs"))
    mails = mails.groupBy("into", "l").agg(F.min_by("xs", "seq").alias("xs")).groupBy(F.col("into").alias("seq")).agg(F.array_sort(F.flatten(F.collect_list("xs"))).alias("_mails"))
    notes = each.groupBy(F.col("into").alias("seq")).agg(F.array_sort(F.collect_list(F.struct("seq", "source"))).alias("_sources"), F.max_by("partner_notes", "seq").alias("_notes"))
    got = rows.select("seq", *fills, "source").join(first.select("seq", "joined", *[F.col(c).alias(f"_{c}") for c in fills]), "seq").join(notes, "seq").join(mails, "seq", "left")
    full = {c: F.when(F.coalesce(c, F.lit("")) == "", F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in fills}
    got = got.withColumns({**full, "source": F.concat_ws(" + ", "source", F.transform("_sources", lambda x: x["source"])), "partner_notes": F.col("_notes")})
    known = F.transform(addresses("email"), F.lower)
    more = F.transform(F.filter(F.coalesce("_mails", F.array()), lambda x: ~F.array_contains(known, F.lower(x["x"]))), lambda x: x["x"])
    return got.withColumn("email", F.array_join(F.concat(F.array("email"), more), "; ")).select("seq", "joined", *fills, "source", "partner_notes")
