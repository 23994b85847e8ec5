"""URL filters by a Bloom filter cascade: exact membership of listed domains among all domains of a corpus, without joins.

A key is a domain: a host of the corpus or one of its parents; a host is listed if one of its keys is. Level 0 is a Bloom
filter made of the list alone. The corpus's keys are sifted through it in a scan; the few that pass are compared with the list as
text, and only they go on: level 1 holds those that passed by mistake, level 2 the listed ones that pass level 1 by
mistake, and so on until nothing passes by mistake. A key of the corpus is listed exactly if the first level that lacks it is
an odd one (or if none does and their number is odd). The universe is every key of the corpus, so no answer is wrong.

Cascades are built in shards of the keys' hashes, each in a task of its own, and shipped in parts of ``most`` bytes: one part
stays in a task's memory, several are read one after another for each block of pages. Hashes have 64 bits; an unlisted key with the
hash of a listed one is found when the levels are built, and kept apart as text.

Rules (host, path, verdict) come before the list: a rule fits its host and all subdomains where the url's path starts with the
rule's; the longest wins.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; repeated rows keep
a row each; null and empty listed domains list nothing; an empty table gives an empty result; other columns are carried, whatever
their names, unless ``host``, ``path``, ``rule`` or ``verdict``, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import U, hash_ranges, mix, text_bytes
from .rows import free_name
from placeloom.plans.scratch import Scratch

RATE = 1 / 64  # of mistakes at level 0; later levels err half of the time
ROWS = 200_000  # pages that a task holds where cascades come in several parts


def _lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return _lowered(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def hash_texts(column: pa.Array) -> np.ndarray:
    raw, at = text_bytes(column)
    return hash_ranges(raw, at[:-1], at[1:])


def host_keys(hosts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the keys of hosts: each host and what follows each of its dots; positions in the hosts' bytes."""
    raw, at = text_bytes(hosts)
    dots = np.flatnonzero(raw == ord(".")) + 1
    start = np.unique(np.concatenate([at[:-1], dots]))
    start = start[start < at[-1]]  # an empty host, or what follows a last dot, is no key
    row = np.searchsorted(at, start, "right") - 1
    return row, start, at[1:][row]


class Cascade:
    """Levels of (bits, number of hash functions)."""

    def __init__(self, levels: list[tuple[np.ndarray, int]]):
        self.levels = levels

    @staticmethod
    def _places(h: np.ndarray, level: int, bits: int, k: int) -> Iterator[np.ndarray]:
        a, b = mix(h + U(2 * level + 1)), mix(h ^ U(0x5851F42D4C957F2D + level)) | U(1)
        for i in range(k):
            yield ((a + U(i) * b) >> U(16)) % U(bits)

    @classmethod
    def first(cls, listed: np.ndarray) -> Cascade:
        """Level 0 alone, from the distinct keys of the list."""
        out = cls([])
        out._add(listed, RATE)
        return out

    def _add(self, inside: np.ndarray, rate: float) -> None:
        k = max(1, round(-math.log2(rate)))
        bits = -(-max(64, math.ceil(len(inside) * k / math.log(2))) // 8) * 8
        filled = np.zeros(bits, np.uint8)
        for p in self._places(inside, len(self.levels), bits, k):
            filled[p] = 1
        self.levels.append((np.packbits(filled), k))

    def grow(self, listed: np.ndarray, others: np.ndarray) -> Cascade:
        """Levels 1 and on, from the keys of the universe that pass level 0; ``listed`` and ``others`` share none."""
        inside, outside = others, listed
        while len(inside):
            self._add(inside, 0.5)
            inside, outside = outside[self._has(len(self.levels) - 1, outside)], inside
        return self

    def _has(self, level: int, h: np.ndarray) -> np.ndarray:
        packed, k = self.levels[level]
        got = np.ones(len(h), bool)
        for p in self._places(h, level, self._bits(level), k):
            p = p.astype(np.int64)
            got &= packed[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1 == 1
        return got

    def _bits(self, level: int) -> int:
        return len(self.levels[level][0]) * 8

    def listed(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), len(self.levels) % 2 == 1)
        left = np.arange(len(h))
        for level in range(len(self.levels)):
            got = self._has(level, h[left])
            out[left[~got]] = level % 2 == 1
            left = left[got]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *[x for b, k in self.levels for x in (len(b), k)]], np.int64)
        return head.tobytes() + b"".join(b.tobytes() for b, _ in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> Cascade:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        head, at, levels = np.frombuffer(data, np.int64, 2 * n, 8), 8 + 16 * n, []
        for size, k in head.reshape(-1, 2).tolist():
            levels.append((np.frombuffer(data, np.uint8, size, at), k))
            at += size
        return cls(levels)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U(20)) % U(shards)).astype(np.int32)


def _sharded(domains: DataFrame, shards: int) -> DataFrame:
    """``domains`` (domain, listed) with ``h`` and ``shard``, dealt by shard."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = hash_texts(b.column(0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64)), pa.array(_shard(h, shards))], ["domain", "listed", "h", "shard"])

    return domains.select("domain", "listed").mapInArrow(number, "domain string, listed boolean, h long, shard int").repartition(shards, "shard")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    held = [b for b in batches if b.num_rows]
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        shard = rows["shard"].to_numpy()
        for s in np.unique(shard).tolist():
            yield s, rows.filter(pa.array(shard == s)).combine_chunks()


def first_levels(listed: DataFrame, shards: int) -> DataFrame:
    """(shard, data): level 0 of each shard of the list (domain, listed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in _by_shard(batches):
            data = Cascade.first(np.unique(rows["h"].to_numpy().view(np.uint64))).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([data], pa.binary())], ["shard", "data"])

    return _sharded(listed, shards).mapInArrow(run, "shard int, data binary")


def grown(data: bytes, keys: list[str], h: np.ndarray, listed: np.ndarray) -> tuple[bytes, list[str]]:
    """A shard's cascade from its level 0 and the keys that pass it, and unlisted keys that have the hash of a listed one."""
    on = np.unique(h[listed])
    alike = ~listed & np.isin(h, on)
    cascade = Cascade.from_bytes(data).grow(on, np.unique(h[~listed & ~alike]))
    return cascade.to_bytes(), [keys[i] for i in np.flatnonzero(alike)]


def all_levels(first: DataFrame, passed: DataFrame, shards: int) -> DataFrame:
    """(shard, data, alike): whole cascades from level 0 and the keys (domain, listed) of the universe that pass it."""
    head = first.select(F.lit(None).cast("string").alias("domain"), F.lit(False).alias("listed"), F.lit(0).cast("long").alias("h"), "shard", "data").repartition(shards, "shard")
    rows = head.unionByName(_sharded(passed, shards).withColumn("data", F.lit(None).cast("binary"))).repartition(shards, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in _by_shard(batches):
            is_head = rows["data"].is_valid()
            data = rows.filter(is_head)["data"][0].as_py()
            own = rows.filter(pc.invert(is_head))
            built, alike = grown(data, own["domain"].to_pylist(), own["h"].to_numpy().view(np.uint64), own["listed"].to_numpy(zero_copy_only=False).astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([built], pa.binary()), pa.array([alike], pa.list_(pa.string()))], ["shard", "data", "alike"])

    return rows.mapInArrow(run, "shard int, data binary, alike array<string>")


class Shipped:
    """Cascades of all shards as broadcasts of ``most`` bytes each (a larger shard is one alone)."""

    def __init__(self, table: DataFrame, shards: int, most: int):
        self.shards, self.parts = shards, []
        size = {r.shard: r.n for r in table.select("shard", F.octet_length("data").alias("n")).toLocalIterator()}
        group: list[int] = []
        for s in sorted(size):
            if group and sum(size[x] for x in group) + size[s] > most:
                self.parts.append(self._part(table, group))
                group = []
            group.append(s)
        if group:
            self.parts.append(self._part(table, group))

    @staticmethod
    def _part(table: DataFrame, group: list[int]) -> tuple[list[int], Broadcast]:
        rows = table.where(F.col("shard").between(group[0], group[-1])).select("shard", "data").collect()
        return group, table.sparkSession.sparkContext.broadcast({r.shard: bytes(r.data) for r in rows})

    def has(self, h: np.ndarray) -> np.ndarray:
        """Which keys the cascades tell as listed."""
        out, shard = np.zeros(len(h), bool), _shard(h, self.shards)
        for group, sent in self.parts:
            mine = np.flatnonzero(np.isin(shard, group))
            if len(mine):
                data = sent.value
                for s in np.unique(shard[mine]).tolist():
                    at = mine[shard[mine] == s]
                    out[at] = Cascade.from_bytes(data[s]).listed(h[at])
            if len(self.parts) > 1:
                sent.__dict__.pop("_value", None)  # a task keeps one part at a time
        return out


def _sift(seen: DataFrame, first: Shipped) -> DataFrame:
    """(domain): the distinct keys of hosts (host) that pass level 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = b.column(0)
            raw, _ = text_bytes(hosts)
            _, start, end = host_keys(hosts)
            on = np.flatnonzero(first.has(hash_ranges(raw, start, end)))
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([data[x:y].decode() for x, y in zip(start[on].tolist(), end[on].tolist(), strict=True)], pa.string())], ["domain"])

    return seen.mapInArrow(run, "domain string").distinct()


def judge(pages: DataFrame, domains: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", most: int = 64 << 20, per_shard: int = 1_000_000) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``domains`` (domain) lists hosts to block with all their subdomains."""
    scratch = Scratch(pages.sparkSession, "cascade")
    rest = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    flag = free_name("listed", rest)
    rows = pages.select(*[F.col(f"`{c}`") for c in rest], host(url).alias("host"), path(url).alias("path"))
    listed = scratch.put(domains.select(_lowered(F.col("domain")).alias("domain"), F.lit(True).alias("listed")).where("domain <> ''").distinct())
    size = listed.count()
    shards = max(1, -(-size // per_shard))
    first = scratch.put(first_levels(listed, shards), shards)
    passed = _sift(rows.select("host").distinct(), Shipped(first, shards, most))
    passed = scratch.put(passed.join(listed, "domain", "left").select("domain", F.coalesce("listed", F.lit(False)).alias("listed")))
    built = scratch.put(all_levels(first, passed, shards), shards)
    cascades = Shipped(built, shards, most)
    alike = frozenset(r.x for r in built.select(F.explode("alike").alias("x")).toLocalIterator())  # pairs of one 64-bit hash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> Iterator[pa.RecordBatch]:
            hosts = pc.dictionary_encode(pa.chunked_array([b.column(len(rest)) for b in held])).combine_chunks()
            known, place = hosts.dictionary, hosts.indices.to_numpy(zero_copy_only=False)
            raw, _ = text_bytes(known)
            row, start, end = host_keys(known)
            on = cascades.has(hash_ranges(raw, start, end))
            for i in np.flatnonzero(on) if alike else ():
                on[i] = raw[start[i] : end[i]].tobytes().decode() not in alike
            got = np.bincount(row[on], minlength=len(known))[place] > 0 if len(known) else np.zeros(len(place), bool)
            for b in held:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got[: b.num_rows])], [*b.schema.names, flag])
                got = got[b.num_rows :]
            held.clear()

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if len(cascades.parts) < 2 or sum(x.num_rows for x in held) >= ROWS:
                yield from close()
        if held:
            yield from close()

    rows = rows.mapInArrow(run, rows.withColumn(flag, F.lit(True)).schema)
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later, longer ones stand outside
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    verdict = F.coalesce(verdict, F.when(F.col(flag), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select(*[F.col(f"`{c}`") for c in rest], "host", "path", rule.alias("rule"), verdict.alias("verdict"))
