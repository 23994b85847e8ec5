"""Benchmark decontamination by template canonicalisation.

Words lose their outer punctuation and case (folded over all of Unicode); numbers, units after a number, and names (capitalised words)
become typed placeholders that keep their values as slots. Numbers have digits or are English number words from two on, also joined by a
hyphen; a word of capitals throughout is a name if no neighbour is one too (then it is only a loud text). A capital that opens a sentence may be a name or not, and texts
are quoted inside other sentences, so every text has three readings: ``CAPITALS`` takes each capitalised word for a slot wherever
it stands (in items one that opens a sentence must keep its value if it is one of the ``OPENING`` words and no name elsewhere in the
item), ``OPENERS`` leaves those that open a sentence literal, ``WORDS`` has no slots at all.

Items whose templates agree in every placeholder, in the pattern of equal names and in the values that may not change are one class
under their least id, and share windows; only their exact words are kept apart. Windows of ``WINDOW`` template words of every
document are tested against a bit table of the benchmark's windows in the scan; what passes is hash-joined with the windows of
the classes. Windows of one pair on one diagonal are an alignment; those of its windows count that are consistent (``agreed``):
each name of the item stands for one name of the document and the other way round, as most of its mentions have it; a window
with another name is left out, one whose values are all unchanged never. Numbers and units may coincide by chance in the item or
in the document, so they are free, unless a name is evenly torn between others: then each must stand for one value too. So a
question with other numbers or names is caught, and a chance mixture of the same template is not.

A window that more than ``COMMON`` classes have (a preamble, say) tells none of them: a class keeps its own windows only, those that
``COMMON`` classes at most have, exact words and templates apart; if it has none of its own, its rarest. So a window meets few
classes, however many items open alike, and no match rests on what items have in common.

A document and a class match if consistent alignments share ``least`` of the windows that the class keeps, or all if it keeps fewer.
An item shorter than a window is one window of its own length. Windows with fewer than half literal words in every reading with
slots are left out, unless the item has no others: then those with a fifth at least stand for it, and where there are none
of these either its words themselves, without slots.

Defined results: null and empty texts match nothing; items without words never match; repeated rows of either table match
each; repeated ids are one document with the windows of all its rows, and an item for each text; empty tables give no matches; a
null id is an id, but names a class only if none of its items has another; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_table, held, prefix_bits
from .bytetext import U, Words, hash_ranges, mix, slices, text_bytes, window_hashes
from .rows import FEW, keyed, small, without
from placeloom.plans.scratch import Scratch

WINDOW = 8
LEAST = 4
COMMON = 8
_CASED = 0x1F000  # no letter from here on has case

#: Unit words.
UNITS = """
mm cm m km inch inches ft foot feet yard yards mile miles mg g kg t gram grams kilogram kilograms ton tons lb lbs oz
ml cl l litre litres liter liters s sec second seconds min minute minutes h hour hours day days week weeks month months
year years hz khz mhz ghz v kv a ma w kw mw j kj n pa kpa k kb mb gb tb byte bytes bit bits mph kmh percent % usd eur gbp
dollar dollars euro euros pound pounds cent cents degree degrees
""".split()

#: More unit words: every prefix with every base, and their plurals.
_PREFIXES = ["", "nano", "micro", "milli", "centi", "deci", "hecto", "kilo", "mega", "giga", "tera"]
_BASES = "metre meter gram gramme litre liter watt volt amp ampere joule newton pascal hertz byte bit second calorie tonne".split()
MORE_UNITS = [f"{p}{b}{s}" for p in _PREFIXES for b in _BASES for s in ("", "s")]
MORE_UNITS += [f"{b}{s}" for b in "acre hectare gallon pint quart ounce knot kelvin celsius fahrenheit franc peso cup mole".split() for s in ("", "s")] + ["yen", "rupee", "rupees"]

#: Number words, those of tens and ones joined by a hyphen.
_ONES = "one two three four five six seven eight nine".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBERS = [*_ONES[1:], *"ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), *_TENS]
NUMBERS += [f"{t}-{o}" for t in _TENS for o in _ONES] + "dozen hundred thousand million billion".split()

#: Words that open sentences without being names, in English, French, Spanish and German.
OPENING = """
a an the this that these those it he she we you they i there here his her its our your their my
what which who whom whose when where why how if in on at of by for from to with without after before during between among
and or but as so then thus because while since although each every all any some no one two three both
is are was were do does did has have had can could will would should may might must let given suppose assume
add answer calculate choose compare compute convert count describe draw estimate evaluate explain express factor fill find
give identify list make multiply name order prove read round select show simplify solve state subtract sum use write
le la les un une des il elle on nous vous ils elles ce cette ces que qui quel quelle où quand comment pourquoi si dans calculer trouver
el los las uno una unos unas ella ellos este esta cada qué cuál quién dónde cuándo cómo por en calcula halla
der die das ein eine er sie es wir ihr was wer wie wo wann warum welche wenn in berechne finde
""".split()

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), ord("%")]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
#: What holds for the value of a word of an item.
LITERAL, FREE, NAME, FIXED = 0, 1, 2, 3
CAPITALS, OPENERS, WORDS = 0, 1, 2
_NUMBER, _NAME, _UNIT = U(0xA11CE), U(0xB0B), U(0xCA7)


def _hash_words(words: list[str]) -> np.ndarray:
    raw, at = text_bytes(pa.array([" ".join(words)]))
    return Words(raw, at).hashes()


def _folded(texts: pa.Array) -> pa.Array:
    """Case-folded texts; bytes that are not UTF-8 stay."""
    fold = lambda t: t.lower() if t.isascii() else t.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
    return pa.array([fold(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.large_binary())


def _inner(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words have a letter or digit, and the byte range of each of those without outer punctuation."""
    good = np.flatnonzero(_ALNUM[w.raw]) if len(w.raw) else np.zeros(0, np.int64)
    a, b = np.searchsorted(good, w.start), np.searchsorted(good, w.end)
    keep = b > a
    return keep, *((good[a[keep]], good[b[keep] - 1] + 1) if len(good) else (w.start[keep], w.end[keep]))


@cache
def _cases() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point below ``_CASED`` is an upper-case, a lower-case letter."""
    every = [chr(i) for i in range(_CASED)]
    return np.array([c.isupper() or c.istitle() for c in every]), np.array([c.islower() for c in every])


def _points(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the UTF-8 letters at byte positions (0 from ``_CASED`` on), and where the next ones start."""
    b = [raw[np.minimum(at + i, len(raw) - 1)].astype(np.int64) for i in range(4)]
    size = 1 + (b[0] >= 0xC0) + (b[0] >= 0xE0) + (b[0] >= 0xF0)
    point = np.where(size == 1, b[0], b[0] & np.array([0, 0, 0x1F, 0x0F, 0x07])[size])
    for i in range(1, 4):
        point = np.where(size > i, point << 6 | b[i] & 0x3F, point)
    return np.where(point < _CASED, point, 0), at + size


def _capitals(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words are an upper-case letter and then a lower-case one."""
    out = np.zeros(len(start), bool)
    if len(start):
        some = np.flatnonzero((raw[start] >= 65) & (raw[start] <= 90) | (raw[start] >= 0xC3))
        upper, lower = _cases()
        first, at = _points(raw, start[some])
        out[some] = upper[first] & (at < end[some]) & lower[_points(raw, at)[0]]
    return out


def _acronyms(raw: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words are two capitals A to Z or more and nothing else, between words that are not."""
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    out = (end - start > 1) & (upper[end] - upper[start] == end - start)
    beside = np.zeros(len(out), bool)
    both = out[1:] & out[:-1] & (doc[1:] == doc[:-1])
    beside[1:] |= both
    beside[:-1] |= both
    return out & ~beside


class Template:
    """Template words of a piece of texts: ``symbol``, ``value`` (of slots), ``kind`` by reading, ``word`` and ``doc`` of each."""

    def __init__(self, texts: pa.Array):
        raw, at = text_bytes(texts)
        w = Words(raw, at)
        keep, start, end = _inner(w)
        self.doc = w.doc[keep]
        n = len(start)
        # folding changes lengths of words, but neither their number nor which have letters or digits
        folded = Words(*text_bytes(_folded(texts)))
        self.word = hash_ranges(folded.raw, *_inner(folded)[1:])
        digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
        number = (digits[end] > digits[start]) | np.isin(self.word, _hash_words(NUMBERS))
        capital = _capitals(raw, start, end) | _acronyms(raw, start, end, self.doc)
        # a sentence starts a text, follows a full stop, or a line break
        opens = np.ones(n, bool)
        if n > 1:
            lines = np.concatenate([[0], np.cumsum(raw == 10)])
            opens[1:] = (self.doc[1:] != self.doc[:-1]) | _STOP[raw[w.end[keep][:-1] - 1]] | (lines[start[1:]] > lines[end[:-1]])
        after = np.zeros(n, bool)
        after[1:] = number[:-1] & (self.doc[1:] == self.doc[:-1])
        unit = after & np.isin(self.word, _hash_words(UNITS + MORE_UNITS)) & ~number
        free = number | unit
        name = capital & ~free
        first = name & opens
        self.opener = np.concatenate([[0], np.cumsum(first)])
        self.symbol, self.value, self.kind = [], [], []
        for slot in (free | name, free | name & ~opens):
            kind = np.where(number, _NUMBER, np.where(unit, _UNIT, _NAME))
            self.symbol.append(np.where(slot, mix(kind), self.word))
            self.value.append(np.where(slot, mix(self.word ^ kind), U(0)))
            self.kind.append(np.where(slot, np.where(free, FREE, NAME), LITERAL).astype(np.int8))
        # of one item: what opens a sentence is a name unless it is a word that often does, and no name inside one
        fixed = np.isin(self.word, _hash_words(OPENING)) & ~np.isin(self.word, self.word[name & ~opens])
        self.kind[CAPITALS][first & fixed] = FIXED
        self.count = np.bincount(self.doc, minlength=len(at) - 1) if n else np.zeros(len(at) - 1, np.int64)

    def windows(self, k: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each window of k template words inside one text."""
        h = window_hashes(self.word ^ U(0xE8AC7) if reading == WORDS else self.symbol[reading], k)
        inside = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1 :]) if len(h) else np.zeros(0, np.int64)
        return inside, mix(h[inside] + U(k))

    def literals(self, first: np.ndarray, k: int, reading: int) -> np.ndarray:
        """Number of words of each window that have to be the same."""
        slots = np.concatenate([[0], np.cumsum((self.kind[reading] == FREE) | (self.kind[reading] == NAME))])
        return k - (slots[first + k] - slots[first])

    def slots(self, first: np.ndarray, k: int, reading: int) -> list[list[int]]:
        """Values of the slots of each window, by place; 0 for a literal word."""
        return [[0] * k] * len(first) if reading == WORDS else self.value[reading][first[:, None] + np.arange(k)].view(np.int64).tolist() if len(first) else []

    def kinds(self, first: np.ndarray, k: int, reading: int) -> list[list[int]]:
        """What holds for each word of each window, by place."""
        return [[LITERAL] * k] * len(first) if reading == WORDS else self.kind[reading][first[:, None] + np.arange(k)].tolist() if len(first) else []


def _votes(pairs: Iterable[tuple[int, int]]) -> dict[int, int | None]:
    """For each left value the right one that it has most often, itself where it is among those; None if others tie."""
    count: dict[int, Counter] = defaultdict(Counter)
    for x, y in pairs:
        count[x][y] += 1
    out: dict[int, int | None] = {}
    for x, c in count.items():
        most = max(c.values())
        best = [y for y, n in c.items() if n == most]
        out[x] = x if x in best else best[0] if len(best) == 1 else None
    return out


def agreed(windows: list[tuple[int, list[int], list[int], list[int]]]) -> list[int]:
    """Places of the windows (place, kinds, slots, seen) of one diagonal that are consistent."""
    mention: dict[int, set[tuple[int, int, int]]] = {FREE: set(), NAME: set()}
    for pos, kinds, slots, seen in windows:
        for i, kind in enumerate(kinds):
            if kind in mention:
                mention[kind].add((pos + i, slots[i], seen[i]))
    there, back = _votes((x, y) for _, x, y in mention[NAME]), _votes((y, x) for _, x, y in mention[NAME])
    torn = None in there.values() or None in back.values()
    free = _votes((x, y) for _, x, y in mention[FREE]) if torn else {}

    def fits(kind: int, x: int, y: int) -> bool:
        if kind == NAME:
            return there[x] == y and back[y] == x
        return kind == LITERAL or (x == y if kind == FIXED else not torn or free[x] == y)

    places = set()
    for pos, kinds, slots, seen in windows:
        if all(x == y for kind, x, y in zip(kinds, slots, seen, strict=True) if kind) or all(map(fits, kinds, slots, seen)):
            places.add(pos)
    return sorted(places)


def _first_seen(values: np.ndarray) -> np.ndarray:
    """For each value the number of distinct ones that came before its first occurrence."""
    _, first, place = np.unique(values, return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[place]


def signature(t: Template) -> int:
    """Equal for items of one template: placeholders, which names are equal, and the values that must stay."""
    symbol, value, kind = t.symbol[CAPITALS], t.value[CAPITALS], t.kind[CAPITALS]
    slot = np.zeros(len(symbol), np.uint64)
    slot[kind == FIXED] = value[kind == FIXED]
    names = np.flatnonzero(kind == NAME)
    slot[names] = _first_seen(value[names]).astype(np.uint64) + U(1)
    every = mix(symbol + mix(slot + kind.astype(np.uint64) * U(0x51ED)))
    return int(window_hashes(every, len(every)).view(np.int64)[0])


def benchmark_windows(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(item, sign, k, reading, pos, h, kinds, slots, total): the windows that stand for each item; ``sign`` tells its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item", "sign", "k", "reading", "pos", "h", "kinds", "slots"]
        types = [None, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int8()), pa.list_(pa.int64())]
        for b in slices(batches, "t"):
            for i in range(b.num_rows):
                t = Template(b.column(1).slice(i, 1))
                k = min(window, len(t.word))
                if not k:
                    continue
                got = {x: t.windows(k, x) for x in (CAPITALS, OPENERS, WORDS)}
                literal = {x: t.literals(got[x][0], k, x) for x in (CAPITALS, OPENERS)}
                rich = {x: literal[x] * 2 >= k for x in literal}
                if not (rich[CAPITALS] | rich[OPENERS]).any():
                    rich = {x: literal[x] * 5 >= k for x in literal}
                rich[WORDS] = rich[CAPITALS] | rich[OPENERS]
                if not rich[WORDS].any():
                    rich[WORDS][:] = True
                rich[OPENERS] &= t.opener[got[OPENERS][0] + k] > t.opener[got[OPENERS][0]]  # else as in CAPITALS
                sign = signature(t)
                for x, (first, h) in got.items():
                    first, h = first[rich[x]], h[rich[x]]
                    m = len(first)
                    cols = [[b.column(0)[i].as_py()] * m, [sign] * m, [k] * m, [x] * m, first, h.view(np.int64), t.kinds(first, k, x), t.slots(first, k, x)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, b.column(0).type if j == 0 else types[j]) for j, c in enumerate(cols)], names)

    kind = items.schema[key].dataType.simpleString()
    schema = f"item {kind}, sign long, k int, reading int, pos int, h long, kinds array<tinyint>, slots array<long>"
    return items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("t")).mapInArrow(run, schema)


def item_classes(windows: DataFrame) -> DataFrame:
    """(sign, class, n_items): the least id and the number of items of each class, from ``benchmark_windows``."""
    return windows.select("sign", "item").distinct().groupBy("sign").agg(F.min("item").alias("class"), F.count(F.lit(1)).alias("n_items"))


def own_windows(bench: DataFrame, common: int = COMMON) -> DataFrame:
    """The windows by which each class is known, with ``total``, the number of their places."""
    many = bench.select("h", "sign").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("many"))
    exact = (F.col("reading") == WORDS).alias("exact")
    every = bench.select("*", exact).join(many, "h")
    rarest = every.groupBy("sign", "exact").agg(F.min("many").alias("rarest"))
    own = every.join(rarest, ["sign", "exact"]).where(F.col("many") <= F.greatest(F.lit(common), "rarest"))
    total = own.groupBy("sign").agg(F.countDistinct("pos").cast("int").alias("total"))
    return own.join(total, "sign").select(*bench.columns, "total")


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text", item_text: str = "text", window: int = WINDOW, least: int = LEAST, scratch: Scratch | None = None) -> DataFrame:
    """(``key``, ``item_key``, n_items, n_windows, item_windows, reparameterised): every matching pair of document and class of items.

    The class is named by its least id and has ``n_items`` items; ``item_windows`` are those that it keeps; ``reparameterised`` tells that too few windows are verbatim.
    """
    spark = docs.sparkSession
    scratch = scratch.part("templates") if scratch else Scratch(spark, "templates")
    every = scratch.put(benchmark_windows(items, item_key, item_text, window))
    size = every.count()
    classes = scratch.put(item_classes(every), size)
    # items of one class share a row for each window but for those of exact words that differ
    bench = every.groupBy("sign", "k", "reading", "pos", "h").agg(F.min_by(F.struct("kinds", "slots"), "item").alias("x"))
    bench = scratch.put(own_windows(bench.join(small(classes), "sign").select("sign", "n_items", "k", "reading", "pos", "h", "x.kinds", "x.slots")), size)
    n = bench.count()
    bits = prefix_bits(n, 64)
    ks = sorted((r.k, r.reading) for r in bench.select("k", "reading").distinct().collect())  # 3 * ``window`` at most
    known = spark.sparkContext.broadcast(bit_table(bench, bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for b in slices(batches, "t"):
            t = Template(b.column(1))
            start = np.concatenate([[0], np.cumsum(t.count)])
            for k, reading in ks:
                first, h = t.windows(k, reading)
                on = held(table, bits, h)
                first, h = first[on], h[on]
                doc = t.doc[first]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), pa.array(first - start[doc], pa.int64()), pa.array(h.view(np.int64)), pa.array(t.slots(first, k, reading), pa.list_(pa.int64()))],
                    ["doc", "at", "h", "seen"],
                )

    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("t")).mapInArrow(scan, f"doc {kind}, at long, h long, seen array<long>")
    pair = found.join(small(bench, FEW // (window + 4)), "h").withColumn("diagonal", F.col("at") - F.col("pos"))
    # distinct windows of one diagonal: as many as the class has there, if the id is not repeated
    window_of = F.struct("pos", "kinds", "slots", "seen", (F.col("reading") == WORDS).alias("exact"))
    line = pair.groupBy("doc", "sign", "diagonal").agg(F.collect_set(window_of).alias("z"), F.max("total").alias("total"), F.max("n_items").alias("n_items"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = b.column(4).to_pylist()
            places = [agreed([(w["pos"], w["kinds"], w["slots"], w["seen"]) for w in z]) for z in told]
            exact = [sorted({w["pos"] for w in z if w["exact"]}) for z in told]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *[pa.array(x, pa.list_(pa.int32())) for x in (places, exact)]], ["doc", "sign", "total", "n_items", "pos", "exact"])

    line = line.select("doc", "sign", "total", "n_items", "z").mapInArrow(judge, f"doc {kind}, sign long, total int, n_items long, pos array<int>, exact array<int>")
    places = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    both = line.where(F.size("pos") > 0).groupBy("doc", "sign").agg(places("pos").alias("n_windows"), places("exact").alias("exact"), F.max("total").alias("item_windows"), F.max("n_items").alias("n_items"))
    due = F.least(F.lit(least), F.col("item_windows"))
    both = both.where(F.col("n_windows") >= due).join(small(classes.select("sign", "class")), "sign")
    return both.select(F.col("doc").alias(key), F.col("class").alias(item_key), "n_items", "n_windows", "item_windows", (F.col("exact") < due).alias("reparameterised"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", scratch: Scratch | None = None, **options) -> DataFrame:
    """``docs`` without the rows that match an item; each is judged by itself, whatever its id."""
    scratch = scratch.part("clean") if scratch else Scratch(docs.sparkSession, "clean")
    rows, row = keyed(docs, scratch, key)
    inner = scratch.part("matches")
    gone = scratch.put(matches(rows, items, row, scratch=inner, **options).select(row).distinct())
    inner.clear()
    return without(rows, gone, row).select(docs.columns)
