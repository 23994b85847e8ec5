"""Ordered replay of many components at once: rows arrive sorted by component and order, and one task runs thousands of them.

A task reads Arrow batches and holds the rows of one component at a time as plain lists; a component costs what its rows cost, there
is no call or table for each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..plans.scratch import Scratch

_YIELD = 20_000  # rows that are returned at once


@dataclass(frozen=True)
class Rule:
    """How a row finds the earlier one that it joins.

    ``probe`` and ``post`` are array columns: the keys under which a row looks, in turn, and those under which it is found once it
    stays. A row found under a key that starts with one of ``sure`` is the same, as is one with an equal value in a column of
    ``equal`` (its own or one that it was given), or one whose name agrees, within ``metres`` where they are given. ``fills`` names the
    columns that a row takes over while its own are blank, with the key column that goes with each.
    """

    probe: str
    post: str
    fills: dict[str, str | None]
    equal: tuple[str, ...] = ()
    sure: str = ""
    metres: float | None = None
    measured_at_holder: bool = False  # degrees of longitude are as wide as at the earlier row, else as at the later
    joins: str | None = None  # boolean column: rows that may join others; all if None
    last: str | None = None  # seq of a row to join where no key leads to one
    adds: tuple[str, ...] = ()  # "; " lists that take over what they lack, whatever they have
    notes: dict[str, str] = field(default_factory=dict)  # columns that every joining row changes: "append" or "replace"
    earliest: bool = False  # ``probe`` has (pos, t): the earliest row under any key ``t`` of one ``pos`` counts, and every key is sure
    told: str | None = None  # seq of the row that a row is known to join, its own if it is known to stay; no key is looked up for it

    def columns(self) -> list[str]:
        """What a replay may change."""
        return list(dict.fromkeys([*self.fills, *self.adds, *self.notes]))

    def reads(self) -> list[str]:
        """Columns that a replay needs."""
        named = ["_fold", "_raw", "lat", "lon"] if self.metres is not None else ["_fold", "_raw"]
        if set(self.sure) >= {"{"}:  # every key proves the same, so nothing else is compared
            named = []
        flags = [c for c in (self.joins, self.last, self.told) if c]
        keys = [c for c in self.fills.values() if c]
        return list(dict.fromkeys(["seq", self.probe, self.post, *self.columns(), *keys, *self.equal, *named, *flags]))


class Replay:
    """Rows of one component in order; columns are lists, rows are numbers."""

    def __init__(self, rule: Rule, columns: dict[str, list]):
        self.rule, self.col, self.n = rule, columns, len(columns["seq"])
        self.number = {s: i for i, s in enumerate(columns["seq"])} if rule.last or rule.told else {}
        self.found: dict[str, list[int]] = {}
        self.into: list[int | None] = [None] * self.n
        self.by: list[str | None] = [None] * self.n
        self.count = [0] * self.n

    def _names_agree(self, i: int, j: int) -> bool:
        (a, b), raw = sorted((self.col["_fold"][i], self.col["_fold"][j]), key=len), self.col["_raw"]
        if not a:
            return raw[i] != "" and raw[i] == raw[j]
        return a == b or (len(a) >= 4 and a in b)

    def _close(self, i: int, j: int) -> bool:
        (y, x), (v, u) = ((self.col["lat"][k], self.col["lon"][k]) for k in (i, j))
        if not y or not v:
            return False
        return geo.METRES * math.hypot(y - v, (x - u) * math.cos(math.radians(y))) <= self.rule.metres

    def _same(self, j: int, i: int, key: str) -> bool:
        """Whether row ``i`` is row ``j``, which it found under ``key``."""
        rule, col = self.rule, self.col
        if key[:1] in rule.sure or any(col[c][i] and col[c][i] == col[c][j] for c in rule.equal):
            return True
        pair = (j, i) if rule.measured_at_holder else (i, j)
        return self._names_agree(i, j) and (rule.metres is None or self._close(*pair))

    def holder(self, i: int) -> tuple[int | None, str | None]:
        """The row that row ``i`` joins, and by what."""
        if self.rule.told and (known := self.col[self.rule.told][i]) is not None:
            j = self.number[known]
            return (None if j == i else j), "key"
        if self.rule.earliest:
            best, at = None, None
            for key in self.col[self.rule.probe][i]:
                if best is not None and key["pos"] != at:
                    break
                if (j := self.found.get(key["t"])) and (best is None or j[0] < best):
                    best, at = j[0], key["pos"]
            return best, "key"
        for key in self.col[self.rule.probe][i]:
            for j in self.found.get(key, ()):
                if self._same(j, i, key):
                    return j, "key"
        last = self.col[self.rule.last][i] if self.rule.last else None
        return (None, None) if last is None else (self.number[last], "name")

    def take(self, j: int, i: int) -> None:
        """Row ``j`` takes over what it lacks of row ``i``."""
        lacks = [c for c in self.rule.fills if not self.col[c][j] and self.col[c][i]]
        for c in [*lacks, *(k for c in lacks if (k := self.rule.fills[c]))]:
            self.col[c][j] = self.col[c][i]
        for c in self.rule.adds:
            known, more = ([x for x in re.split(r"[;,\s]+", self.col[c][k]) if "@" in x] for k in (j, i))
            more = [x for x in more if x.lower() not in {y.lower() for y in known}]
            self.col[c][j] = "; ".join([self.col[c][j], *more])
        for c, how in self.rule.notes.items():
            self.col[c][j] = self.col[c][i] if how == "replace" else f"{self.col[c][j]} + {self.col[c][i]}"
        self.count[j] += 1

    def run(self) -> dict[str, list]:
        may = self.col[self.rule.joins] if self.rule.joins else None
        for i in range(self.n):
            j, self.by[i] = self.holder(i) if may is None or may[i] else (None, None)
            if j is None:
                for key in self.col[self.rule.post][i]:
                    self.found.setdefault(key, []).append(i)
            else:
                self.into[i] = self.col["seq"][j]
                self.take(j, i)
        out = {"seq": self.col["seq"], "into": self.into, "by": self.by, "joined": self.count}
        return out | {c: self.col[c] for c in self.rule.columns()}


def replay(rows: DataFrame, roots: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """(seq, into, by, joined, ...) for the rows of each component of ``roots`` (seq, root), replayed in order; other rows get none."""
    reads = rule.reads()
    names = ["seq", "into", "by", "joined", *rule.columns()]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * len(rule.columns())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in reads}
        done: dict[str, list] = {c: [] for c in names}
        now = None

        def finish() -> None:
            for c, values in Replay(rule, held).run().items():
                done[c].extend(values)
            for c in reads:
                held[c] = []

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done[c], k) for c, k in zip(names, kinds, strict=True)], names)
            for c in names:
                done[c] = []
            return out

        for batch in batches:
            root, *own = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(root):
                if root[at] != now:
                    if now is not None:
                        finish()
                        if len(done["seq"]) >= _YIELD:
                            yield packed()
                    now = root[at]
                end = at + 1
                while end < len(root) and root[end] == now:
                    end += 1
                for c, values in zip(reads, own, strict=True):
                    held[c].extend(values[at:end])
                at = end
        if now is not None:
            finish()
        yield packed()

    dealt = rows.select(*reads).join(roots, "seq").repartition("root").sortWithinPartitions("root", "seq").select("root", *reads)
    schema = ", ".join(["seq long, into long, by string, joined long", *[f"`{c}` string" for c in rule.columns()]])
    return scratch.put(dealt.mapInArrow(run, schema))


def first_filled(joined: DataFrame, rows: DataFrame, fills: list[str]) -> DataFrame:
    """(seq, joined, ...) for each row that others joined: how many, and of each column the first value that one of them has.

    ``joined`` is (seq, into); rows of one holder are reduced in tasks before they meet.
    """
    own = joined.join(rows.select("seq", *fills), "seq")
    first = [F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("seq"))).alias(c) for c in fills]
    return own.groupBy(F.col("into").alias("seq")).agg(F.count(F.lit(1)).alias("joined"), *first)
