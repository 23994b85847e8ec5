"""N-gram Jaccard join by vertical partitioning: exact links between texts whose shingle sets overlap enough.

All shingles stand in one global order (that of their hashes), and the order is cut into fragments. Texts of equal shingle
sets are one class with one representative. Sizes fall into geometric groups; in a group two linked sets differ in d
shingles at most, so of d + 1 + s fragments more than s are equal in both. A representative posts a hash of each of its
fragments; those that nobody shares are dropped. Partial overlaps are counted fragment by fragment and summed per pair, but
only for pairs that may link and are not connected yet:

1. A fragment is weak if more than ``COMMON`` texts have it. That depends on the fragment alone, so a text with at most s weak
   fragments may leave them all out and still shares the rest of its due. A text with more of them is heavy (it has many near
   copies, or consists of passages that many share). Of each weak fragment the heavy text with most weak fragments is the hub,
   and each heavy text is counted against the hub that it shares most fragments with: one pair a text, however large the group.
   Connected texts get one label.
2. Now a fragment is weak if more than ``COMMON`` labels have it. Each text counts the fragments that it shares with each other
   label; with fewer than its due it has no link there. Texts of two labels that both pass are counted against each other, in one
   task with all that are tied to them by such pairs if they fit a block, else pair by pair of labels.
3. Of the texts that are still heavy, without having found a label to share, those stay that have enough of their shingles in common with
   any others of them. Their shingles are ordered by how many of them have each, and linked texts share one of their rarest, as many as a
   text may lack and one. By these they form loose clusters, and are counted in blocks of ``BLOCK`` texts (or ``BLOCK_SHINGLES``
   shingles) at most one size class apart. Texts of a cluster's most frequent label meet its other texts only.

No link between texts of different components is lost: fragments prove a pair unlinked, or it is counted exactly. Tasks
return spanning forests of their links, not pairs.

Defined results: null, empty and white texts have no shingles and are linked with nothing; fewer than k words count as one
shingle; ids may be of any type that has an order; a null id keeps its row and is its own component; rows that repeat an id
keep a row each; an empty table gives an empty result; other columns are ignored. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bit_table, held, prefix_bits
from .bytetext import U, Words, mix, shingles, slices, text_bytes
from placeloom.operators.components import components
from .quotient import CountingQuotientFilter
from .rows import ROW, numbered, small
from placeloom.plans.scratch import Scratch

COMMON = 4
KEYS = 1_000_000  # that are broadcast at most (some 30 MB)
BLOCK = 1000  # texts
BLOCK_SHINGLES = 800_000
FRAGMENTS = 8  # of the global order, in which overlaps are counted
SALTS = 32


def size_groups(num: int, den: int, upto: int = 1 << 40) -> np.ndarray:
    """First sizes of the groups, ascending."""
    out = [1]
    while out[-1] <= upto:
        out.append(out[-1] * 8 // 5 + 1)
    return np.array(out, np.int64)


def fragment_hashes(value: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the fragments that each sorted set sends, n+1 offsets, and how many more each set may leave out."""
    size = np.diff(at)
    first = size_groups(num, den, int(size.max(initial=1)))
    own = np.searchsorted(first, size, "right") - 1
    found, of = [], []
    spare = np.full(len(size), 1 << 30)
    for back in range(64):
        group = own - back
        last = first[np.maximum(group, 0) + 1] - 1
        use = np.flatnonzero((size > 0) & (group >= 0) & (num * size <= den * last))
        if not len(use):
            break
        differ = last[use] * (den - num) // num
        use, differ = use[differ > 0], differ[differ > 0]  # else only equal sets link
        if not len(use):
            continue
        slack = 3 + differ // 8
        pieces = differ + 1 + slack
        base = np.concatenate([[0], np.cumsum(pieces)])
        rows = np.repeat(np.arange(len(use)), size[use])
        v = value[np.repeat(at[use] - np.concatenate([[0], np.cumsum(size[use])])[:-1], size[use]) + np.arange(len(rows))]
        piece = base[rows] + ((v >> U(32)) * pieces[rows].astype(np.uint64) >> U(32)).astype(np.int64)
        count = np.bincount(piece, minlength=base[-1])
        run = np.concatenate([[U(0)], np.cumsum(mix(v))])
        end = np.cumsum(count)
        row = np.repeat(np.arange(len(use)), pieces)
        place = np.arange(base[-1]) - base[row]
        sent = mix(mix(run[end] - run[end - count] + count.astype(np.uint64) * U(0x9E3779B97F4A7C15)) + place.astype(np.uint64) * U(0xD6E8FEB86659FD93) + (own[use][row] - back).astype(np.uint64))
        empty = count == 0
        left = slack - np.bincount(row[empty], minlength=len(use))
        spare[use] = np.minimum(spare[use], np.maximum(left, 0))
        keep = ~(empty & (left >= 0)[row])
        found.append(sent[keep])
        of.append(use[row[keep]])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64), np.zeros(len(size), np.int32)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return found[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(size)))]).astype(np.int64), spare.astype(np.int32)


def _sets(docs: DataFrame, key: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """(k, n, s1, s2, sent, spare): size and 128-bit digest of each set, the hashes of its fragments, and how many it may leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            value, at = shingles(Words(*text_bytes(b.column(1))), k)
            sums = [np.concatenate([[U(0)], np.cumsum(mix(value ^ U(c)))]) for c in (0x1234567, 0x89ABCDEF)]
            s = [mix(x[at[1:]] - x[at[:-1]]).view(np.int64) for x in sums]
            sent, cut, spare = fragment_hashes(value, at, num, den)
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(sent.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at)), pa.array(s[0]), pa.array(s[1]), lists, pa.array(spare)], ["k", "n", "s1", "s2", "sent", "spare"])

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, "k long, n long, s1 long, s2 long, sent array<long>, spare int")


def _shared(sent: DataFrame, ranges: int) -> DataFrame:
    """(h, common): hashes that at least two rows of the lists ``sent`` have, and whether more than COMMON do."""
    schema = "part int, f binary, c binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            got = list(CountingQuotientFilter.of(np.concatenate(held)).pieces(ranges)) if held else []
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary()), pa.array([x[2] for x in got], pa.binary())], ["part", "f", "c"])

        for b in batches:
            held.append(b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) > 1_000_000:
                yield close()
        yield close()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            x = held[0].merge(*held[1:])
            many = x.counts > 1
            return pa.RecordBatch.from_arrays([pa.array(x.fingerprints()[many].view(np.int64)), pa.array(x.counts[many] > COMMON)], ["h", "common"])

        now, held = None, []
        for b in batches:
            for i in range(b.num_rows):
                part, f, c = (x[i].as_py() for x in b.columns)
                if part != now and held:
                    yield close()
                    held = []
                now = part
                held.append(CountingQuotientFilter.piece(f, c))
        if held:
            yield close()

    return sent.select("sent").mapInArrow(build, schema).repartition(1 << ranges, "part").sortWithinPartitions("part").mapInArrow(merge, "h long, common boolean")


def overlaps(value: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray, exact: type = np.float32) -> np.ndarray:
    """Overlaps of the sets ``left`` with the sets ``right`` (numbers of owners), summed over the fragments of the global order."""
    total = np.zeros((len(left), len(right)), exact)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    column = np.cumsum(new, dtype=np.int32) - 1
    many = np.bincount(column)[column] > 1 if len(column) else new  # what one set alone has adds to no overlap
    value, owner, column = value[many], owner[many], column[many]
    row, at = (np.full(int(max(left.max(), right.max())) + 1, -1) for _ in range(2))
    row[left], at[right] = np.arange(len(left)), np.arange(len(right))
    fragment = value >> U(64 - (FRAGMENTS - 1).bit_length())
    for f in range(FRAGMENTS):
        a, b = np.searchsorted(fragment, np.array([f, f + 1], np.uint64))
        while a < b:
            end = min(b, int(np.searchsorted(column, column[a] + 1024)))
            who, where = owner[a:end], column[a:end] - column[a]
            x, y = (np.zeros((n, int(where[-1]) + 1), np.float32) for n in total.shape)
            x[row[who[row[who] >= 0]], where[row[who] >= 0]] = 1
            y[at[who[at[who] >= 0]], where[at[who] >= 0]] = 1
            total += x @ y.T  # 1024 at most, so exact
            a = end
    return total


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of each component of a link matrix between the nodes ``left`` and ``right``; roots are left out as nodes."""
    rows, cols = linked.any(1), linked.any(0)
    nodes, roots = [], []
    while rows.any():
        x = np.zeros(len(rows), bool)
        x[np.argmax(rows)] = True
        y = np.zeros(len(cols), bool)
        new = x
        while new.any():
            rows &= ~new
            met = linked[new].any(0) & cols
            cols &= ~met
            y |= met
            new = linked[:, met].any(1) & rows
            x |= new
        own = np.unique(np.concatenate([left[x], right[y]]))
        nodes.append(own[1:])
        roots.append(np.full(len(own) - 1, own[0]))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(nodes or none), np.concatenate(roots or none)


def _count_block(ids: list[int], sides: list[int], sets: list[bytes], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between texts of different sides; texts of side 0 link with one another too."""
    side, key = np.array(sides), np.array(ids, np.int64)
    left, right = np.flatnonzero(side < 2), np.flatnonzero(side == 2) if side.all() else np.arange(len(side))
    if not len(left) or not len(right):
        return key[:0], key[:0]
    size = np.array([len(x) // 8 for x in sets])
    small_sets = size.max() * den < 1 << 24  # then all sums are exact in 32 bits
    size = size.astype(np.int32 if small_sets else np.int64)
    both = overlaps(np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(ids), dtype=np.int32), size), left, right, np.float32 if small_sets else np.float64).astype(size.dtype)
    linked = (den + num) * both >= num * (size[left][:, None] + size[right][None, :])
    linked &= both > 0
    linked &= (side[left][:, None] != side[right][None, :]) | (side[left] == 0)[:, None]
    return forest(linked, key[left], key[right])


def _texts(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(k, t): the texts of the keys ``k`` of ``wanted``, or those of all rows where they are too many for a broadcast of numbers."""
    mine, keys = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")), small(wanted.select("k"), KEYS)
    return mine.join(keys, "k", "left_semi")


def _links(docs: DataFrame, key: str, text: str, members: DataFrame, k: int, num: int, den: int, tasks: int) -> DataFrame:
    """(a, b): links inside the blocks; ``members`` has k and the array ``at`` of (task, side)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            value, at = shingles(Words(*text_bytes(b.column(1))), k)
            ids, raw, rows = b.column(0).to_pylist(), value.tobytes(), []
            for i, where in enumerate(b.column(2).to_pylist()):
                own = raw[8 * at[i] : 8 * at[i + 1]]
                rows += [(w["task"], w["side"], ids[i], own) for w in where]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["task", "side", "k", "v"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sides, own = None, [], [], []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _count_block(ids, sides, own, num, den)], ["a", "b"])

        for b in slices(batches, "v", 4_000_000):
            for task, side, i, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if task != now:
                    if len(ids) > 1:
                        yield close()
                    now, ids, sides, own = task, [], [], []
                ids.append(i)
                sides.append(side)
                own.append(v)
        if len(ids) > 1:
            yield close()

    mine = _texts(docs, key, text, members).join(small(members, 100_000), "k").select("k", "t", "at")
    dealt = mine.mapInArrow(sets, "task string, side int, k long, v binary").repartition(tasks, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(count, "a long, b long")


def _blocks_of(n: str = "n") -> Column:
    """Blocks that a group of texts with ``n`` shingles each needs."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum(n) / F.lit(BLOCK_SHINGLES))).cast("int")


def _place(task: Column, side: Column | int) -> Column:
    return F.struct(task.alias("task"), (F.lit(side) if isinstance(side, int) else side).cast("int").alias("side"))


def _upto(n: Column) -> Column:
    """0 to n - 1, empty for 0."""
    return F.filter(F.sequence(F.lit(-1), n - 1), lambda j: j >= 0)


def _hub_members(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(k, at): tasks that count each k of ``pairs`` (k, hub) against its hub; the hub goes to every block of its texts."""
    rows = pairs.join(sizes.withColumnRenamed("node", "k"), "k")
    count = rows.groupBy("hub").agg(_blocks_of().alias("m"))
    name = lambda i: F.concat_ws("*", F.col("hub"), i)
    own = rows.join(count, "hub").select("k", _place(name(F.pmod(F.xxhash64("k"), F.col("m").cast("long"))), 2).alias("at"))
    return own.unionAll(count.select(F.col("hub").alias("k"), F.explode(F.transform(_upto(F.col("m")), lambda i: _place(name(i), 1))).alias("at")))


def _label_members(passed: DataFrame, sizes: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """(k, at): tasks for the texts of two labels that both have texts which pass; ``passed`` is (k, label, other).

    Labels that are tied so by pairs are one task as long as their texts fit a block; beyond that each pair of labels is a task, or
    as many as it has pairs of blocks.
    """
    rows = passed.join(sizes.withColumnRenamed("node", "k"), "k")
    rows = scratch.put(rows.select("k", "n", F.least("label", "other").alias("x"), F.greatest("label", "other").alias("y"), (F.col("label") > F.col("other")).alias("upper")), most)
    count = rows.groupBy("x", "y", "upper").agg(_blocks_of().alias("m"))
    count = count.groupBy("x", "y").agg(*[F.max(F.when(F.col("upper") == u, F.col("m"))).alias(c) for u, c in ((False, "mx"), (True, "my"))])
    count = scratch.put(count.where("mx > 0 and my > 0"), most)
    tied = components(count.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch).withColumnRenamed("node", "x")
    rows = scratch.put(rows.join(small(count.join(small(tied), "x")), ["x", "y"]), most)
    whole = scratch.put(rows.select("k", "n", "root").distinct().groupBy("root").agg(_blocks_of().alias("m")), most)
    alone = rows.join(small(whole.where("m = 1").select("root")), "root").select("k", _place(F.concat_ws("=", F.lit(""), "root"), 0).alias("at")).distinct()
    name = lambda i, j: F.concat_ws("/", F.col("x"), F.col("y"), i, j)
    block = lambda m: F.pmod(F.xxhash64("k"), F.col(m).cast("long")).cast("int")
    lower = F.transform(_upto(F.col("my")), lambda j: _place(name(block("mx"), j), 1))
    upper = F.transform(_upto(F.col("mx")), lambda i: _place(name(i, block("my")), 2))
    apart = rows.join(small(whole.where("m > 1").select("root")), "root").select("k", F.explode(F.when(F.col("upper"), upper).otherwise(lower)).alias("at"))
    return alone.unionAll(apart)


def _cluster_members(loose: DataFrame) -> DataFrame:
    """(k, at): the tasks of each member of a loose cluster (k, root, n, class, label).

    Texts of one label are connected, so those of the label that most members have (``mass``) meet the others only, and a cluster of
    one label needs no task. A cluster of one block is one task. Larger ones are cut by size class (ratio den/num, so linked sizes are
    in one class or adjacent ones) and by hash; every two blocks that may hold a link share a task.
    """
    label = loose.groupBy("root", "label").agg(F.count(F.lit(1)).alias("c"))
    label = label.groupBy("root").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.count(F.lit(1)).alias("labels"))
    size = loose.groupBy("root").agg(_blocks_of().alias("m"))
    rows = loose.join(small(label.where("labels > 1").join(size, "root")), "root").withColumn("mass", F.col("label") == F.col("most"))
    alone = rows.where("m = 1").select("k", F.array(_place(F.concat_ws(".", F.lit(""), "root"), F.when(F.col("mass"), 2).otherwise(0))).alias("at"))
    large = rows.where("m > 1")
    count = large.groupBy("root", "class", "mass").agg(_blocks_of().alias("blocks"))
    near = count.select("root", "mass", F.explode(F.array(*[F.struct((F.col("class") + d).alias("class"), F.lit(d).alias("d"), F.col("blocks").alias("b")) for d in (-1, 0, 1)])).alias("x"))
    blocks = [(u, d, c) for u, names in ((False, ("below", "own", "above")), (True, ("mass_below", "mass_own", "mass_above"))) for d, c in zip((1, 0, -1), names, strict=True)]
    near = near.groupBy("root", F.col("x.class").alias("class")).agg(*[F.coalesce(F.max(F.when((F.col("mass") == u) & (F.col("x.d") == d), F.col("x.b"))), F.lit(0)).alias(c) for u, d, c in blocks])
    cut = large.join(small(near), ["root", "class"])
    cut = cut.withColumn("i", F.pmod(F.xxhash64("k"), F.when(F.col("mass"), F.col("mass_own")).otherwise(F.col("own")).cast("long")).cast("int"))
    name = lambda c, i, d, j: F.concat_ws(".", F.col("root"), c, i, d, j)
    c, i = F.col("class"), F.col("i")
    # pairs inside a block are counted where it meets the first block above, or alone where there is none
    meets = F.filter(_upto(F.col("own")), lambda j: (i != j) | (F.col("above") == 0))
    inside = F.transform(meets, lambda j: _place(name(c, F.least(i, j), F.lit("="), F.greatest(i, j)), F.when(i == j, 0).otherwise(F.when(i < j, 1).otherwise(2))))
    above = F.transform(_upto(F.col("above")), lambda j: _place(name(c, i, F.lit("+"), j), F.when(j == 0, 0).otherwise(1)))
    below = F.transform(_upto(F.col("below")), lambda j: _place(name(c - 1, j, F.lit("+"), i), 2))
    between = lambda c, mass: F.concat_ws("*", c, mass)
    masses = lambda x, d: F.transform(_upto(F.col(x)), lambda j: _place(name(between(c, c + d), i, F.lit("*"), j), 1))
    others = lambda x, d: F.transform(_upto(F.col(x)), lambda j: _place(name(between(c + d, c), j, F.lit("*"), i), 2))
    mass = F.concat(others("below", -1), others("own", 0), others("above", 1))
    at = F.when(F.col("mass"), mass).otherwise(F.concat(inside, above, below, masses("mass_below", -1), masses("mass_own", 0), masses("mass_above", 1)))
    return alone.unionAll(cut.select("k", at.alias("at"))).select("k", F.explode("at").alias("at"))


def _alike(docs: DataFrame, key: str, text: str, wanted: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(k, n, sent): of the texts ``wanted`` (k), those that may link with another of them, with their shingles.

    A linked text has num / den of its shingles in common with its partner, so with texts that are not its own. A few shingles count
    as such by mistake, which keeps a text too many.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            value, at = shingles(Words(*text_bytes(b.column(1))), k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.view(np.int64)))], ["k", "n", "sent"])

    mine = _texts(docs, key, text, wanted).join(small(wanted), "k").select("k", "t")
    every = scratch.put(mine.mapInArrow(sets, "k long, n long, sent array<long>"))
    total = int(every.agg(F.sum("n")).first()[0] or 0)
    shared = scratch.put(_shared(every, max(3, (total // 500_000).bit_length())), total)
    bits = prefix_bits(shared.count())
    known = docs.sparkSession.sparkContext.broadcast(bit_table(shared, bits))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            n = b.column(1).to_numpy()
            met = np.bincount(np.repeat(np.arange(len(n)), n)[held(known.value, bits, h)], minlength=len(n))
            yield b.filter(pa.array(den * met >= num * n))

    out = scratch.put(every.mapInArrow(sift, every.schema))
    scratch.drop(every, shared)
    return out


def _loose_clusters(sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(node, root): components of ``sets`` (k, n, sent) that share one of their rarest shingles, as many as a set may lack and one.

    If two sets share none of these, then the one whose last of them comes first in the order of all has too few left to link. Shingles of one set alone are
    no part of any overlap and count as lacking.
    """
    one = sets.select("k", "n", F.explode("sent").alias("h"))
    often = scratch.put(one.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    own = one.join(small(often), "h").groupBy("k").agg(F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "h"))).alias("met"))
    may = F.size("met") - F.ceil(F.col("n") * num / F.lit(den)) + 1
    rare = scratch.put(own.withColumn("may", may.cast("int")).where("may > 0").select("k", F.explode(F.slice("met", F.lit(1), F.col("may"))).alias("x")).select("k", "x.h"))
    first = rare.groupBy("h").agg(F.min("k").alias("b"))
    out = components(rare.join(first, "h").select(F.col("k").alias("a"), "b").where("a <> b").distinct(), scratch)
    scratch.drop(often, rare)
    return out


def _postings(reps: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    """(k, h, spare, common): the fragments that at least two representatives have, and whether more than COMMON do.

    They are sifted in the scan; a few that only one has pass by mistake, and meet nobody.
    """
    ranges = max(3, (total // 500_000).bit_length())
    shared = scratch.put(_shared(reps, ranges), total)
    n = shared.count()
    bits = prefix_bits(n)
    known = reps.sparkSession.sparkContext.broadcast(bit_table(shared, bits))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sent = b.column(2)
            h = sent.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            row = np.repeat(np.arange(b.num_rows), sent.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            on = held(known.value, bits, h)
            row = pa.array(row[on])
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), pa.array(h[on].view(np.int64)), b.column(1).take(row)], ["k", "h", "spare"])

    sifted = reps.select("k", "spare", "sent").mapInArrow(sift, "k long, h long, spare int")
    common = small(shared.where("common").select("h", "common"))
    out = scratch.put(sifted.join(common, "h", "left").select("k", "h", "spare", F.coalesce("common", F.lit(False)).alias("common")), total)
    scratch.drop(shared)
    return out


def _heavy(posts: DataFrame) -> DataFrame:
    """(k, weak): texts with more weak (``common``) fragments than they may leave out."""
    count = posts.groupBy("k").agg(F.count_if("common").alias("weak"), F.min("spare").alias("spare"))
    return count.where("weak > spare").select("k", "weak")


def _linked(docs: DataFrame, key: str, text: str, reps: DataFrame, sizes: DataFrame, fragments: int, k: int, num: int, den: int, tasks: int, scratch: Scratch) -> DataFrame:
    """(node, root): components of the representatives that have a link."""
    posts = _postings(reps, fragments, scratch)

    def counted(members: DataFrame) -> DataFrame:
        at = scratch.put(members.groupBy("k").agg(F.collect_set("at").alias("at")), fragments)
        out = scratch.put(_links(docs, key, text, at, k, num, den, tasks), fragments)
        scratch.drop(at)
        return out

    # 1: each heavy text against one hub
    heavy = scratch.put(_heavy(posts), fragments)
    weak = posts.where("common").select("k", "h").join(small(heavy), "k")
    hub = weak.groupBy("h").agg(F.max(F.struct("weak", (-F.col("k")).alias("k"))).alias("m")).select("h", (-F.col("m.k")).alias("hub"))
    star = weak.join(hub, "h").where("k <> hub").groupBy("k", "hub").agg(F.count(F.lit(1)).alias("c"))
    best = star.groupBy("k").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
    found = counted(_hub_members(scratch.put(best, fragments), sizes))
    label = components(found, scratch)

    # 2: texts against the labels that they share enough fragments with
    own = posts.join(small(label.withColumnRenamed("node", "k")), "k", "left")
    own = scratch.put(own.select("k", "h", "spare", F.coalesce("root", "k").alias("label")), fragments)
    scratch.drop(posts, heavy)
    labels = scratch.put(own.select("h", "label").distinct(), fragments)
    many = scratch.put(labels.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), fragments)
    rows = scratch.put(own.join(small(many), "h"), fragments)
    weak = rows.where(F.col("c") > COMMON)
    left_out = scratch.put(weak.groupBy("k").agg(F.count(F.lit(1)).alias("weak"), F.min("spare").alias("spare")), fragments)
    scratch.drop(own)
    others = labels.withColumnRenamed("label", "other").join(small(many.where(F.col("c") <= COMMON).select("h")), "h", "left_semi")
    met = rows.where(F.col("c") <= COMMON).join(others, "h").where("label <> other")
    met = met.groupBy("k", "label", "other").agg(F.count(F.lit(1)).alias("c"), F.min("spare").alias("spare"))
    met = met.join(small(left_out.select("k", "weak")), "k", "left")
    due = F.greatest(F.lit(1), F.col("spare") + 1 - F.coalesce("weak", F.lit(0)))
    members = _label_members(met.where(F.col("c") >= due).select("k", "label", "other"), sizes, fragments, scratch)

    # 3: what is heavy still
    rest = scratch.put(left_out.where("weak > spare").select("k"), fragments)
    if rest.limit(1).count():
        loose = _loose_clusters(_alike(docs, key, text, rest, k, num, den, scratch), num, den, scratch)
        kind = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(den / num) + 1e-9))).cast("int")
        loose = loose.join(sizes, "node").join(small(label.withColumnRenamed("root", "label")), "node", "left")
        loose = loose.select(F.col("node").alias("k"), "root", "n", kind.alias("class"), F.coalesce("label", "node").alias("label"))
        members = members.unionAll(_cluster_members(scratch.put(loose, fragments)))
    members = scratch.put(members, fragments)
    scratch.drop(labels, rows, many)
    return components(found.unionAll(counted(members)), scratch)


def link_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(``key``, n_shingles, component_id): documents link when den * intersection >= num * union of their k-word shingle sets.

    The component is named by its smallest id. With ``scratch`` the tables that the result reads are parts of it.
    """
    scratch = scratch.part("jaccard") if scratch else Scratch(docs.sparkSession, "jaccard")
    if docs.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte"):
        rows, row = numbered(docs.select(F.col(key), F.col(text)), scratch, key)
        got = link_components(rows.where(F.col(key).isNotNull()), k, num, den, row, text, scratch).join(rows.select(row, key), row)
        got = got.join(rows.select(F.col(row).alias("component_id"), F.col(key).alias(f"{ROW}_name")), "component_id").select(key, "n_shingles", F.col(f"{ROW}_name").alias("component_id"))
        nulls = link_components(rows.where(F.col(key).isNull()).select(F.lit(None).cast("long").alias(row), text), k, num, den, row, text, scratch)
        return got.unionAll(nulls.select(F.lit(None).cast(got.schema[key].dataType).alias(key), "n_shingles", F.lit(None).cast(got.schema[key].dataType).alias("component_id")))
    full = scratch.put(_sets(docs, key, text, k, num, den))
    total = full.agg(F.count(F.lit(1)), F.sum(F.size("sent"))).first()
    rows = int(total[0] or 0)
    sets = scratch.put(full.select("k", "n", "s1", "s2"), rows)
    salt = F.pmod(F.hash("k"), F.lit(SALTS))
    lean = sets.where("n > 0").select("k", "s1", "s2", salt.alias("salt"))
    some = lean.groupBy("s1", "s2", "salt").agg(F.min("k").alias("rep"), F.count(F.lit(1)).alias("c"))
    whole = some.groupBy("s1", "s2").agg(F.min("rep").alias("rep"), F.sum("c").alias("c"))
    copied = scratch.put(whole.where("c > 1 and rep is not null").select("s1", "s2", "rep"), rows)
    copies = small(copied)
    # a row stands for its class unless the class has a smaller id
    reps = full.where("n > 0 and k is not null").join(copies, ["s1", "s2"], "left").where("rep is null or rep = k")
    reps = scratch.put(reps.select("k", "n", "sent", "spare"), rows)
    scratch.drop(full)
    sizes = scratch.put(reps.groupBy(F.col("k").alias("node")).agg(F.max("n").alias("n")), rows)
    tasks = max(8, rows // 8_000)
    roots = _linked(docs, key, text, reps, sizes, int(total[1] or 0), k, num, den, tasks, scratch)
    scratch.drop(reps, sizes)
    # classes and components meet, then go back to the rows by (set, salt), so that no hot class meets in one task
    of = scratch.put(copied.join(small(roots.withColumnRenamed("node", "rep")), "rep", "left").select("s1", "s2", F.coalesce("root", "rep").alias("component")), rows)
    back = scratch.put(some.select("s1", "s2", "salt").join(small(of), ["s1", "s2"]), rows)
    out = sets.select("k", "n", "s1", "s2", salt.alias("salt")).join(small(back), ["s1", "s2", "salt"], "left")
    out = out.join(small(roots.withColumnRenamed("node", "k")), "k", "left")
    component = F.when(F.col("n") == 0, F.col("k")).otherwise(F.coalesce("component", "root", "k"))
    return out.select(F.col("k").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"), component.cast(docs.schema[key].dataType).alias("component_id"))
