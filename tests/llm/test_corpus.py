"""Corpus operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placeloom.llm import bpe, bytetext, cascade, chat, gam, jaccard, lengths, ngram, quotient, shards, templates
from placeloom.llm.queries import VOCAB, remainder

EXTRA = "k long, t string, n long, score double"  # names that operators use inside


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, "x", 1, 0.5) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, " + EXTRA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def prose(rng, n, vocab=400):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(vocab)) for _ in range(n))


ODD = [None, "", "   \n", "one", "One", " o ne", "two words", "é " * 5, "x " * 30_000, "x " * 30_000]


# --- 1: URL filters ---

RULES = [("com", "/en/", "block"), ("a.com", "/en/7", "allow")]


def judged(url, listed):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", "")
    fit = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda r: len(r[0]), default=(None, None))
    return host, path, rule, verdict or ("block" if any(host == d or host.endswith("." + d) for d in listed) else "allow")


@pytest.mark.parametrize("most,per_shard", [(1 << 20, 1000), (1 << 20, 7), (0, 7)])
def test_cascade_judges_every_page(spark, most, per_shard):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "HTTP://A.com/en/7?x", "https://a.com/en/8#y", "x://b.org", "http://b.org://c"] + [f"http://h{rng.randrange(90)}.{rng.choice('ab')}.org/{rng.choice(['en/7', 'x'])}" for _ in range(300)]
    listed = ["h3.a.org", "b.org"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = cascade.judge(pages, spark.createDataFrame([(d,) for d in listed], "domain string"), RULES, most=most, per_shard=per_shard).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: judged(u, listed) for i, u in enumerate(urls)}
    odd = spark.createDataFrame([(None, "http://b.org/x", 1), (2, "http://b.org/x", 2), (2, "http://b.org/x", 2)], "page_id long, url string, listed int").withColumn("Rule", F.lit("r"))
    got = cascade.judge(odd, spark.createDataFrame([("B.org",), (None,), ("",)], "domain string"), [], most=most)
    assert got.columns == ["page_id", "url", "listed", "host", "path", "rule", "verdict"] and [r.verdict for r in got.collect()] == ["block"] * 3
    assert cascade.judge(pages.where("false"), spark.createDataFrame([], "domain string"), RULES, most=most).count() == 0


def test_cascade_is_exact_over_its_universe():
    h = np.unique(np.random.default_rng(3).integers(0, 2**63, 50_000).astype(np.uint64))
    for n in (0, 1, 500, 25_000, len(h)):
        first = cascade.Cascade.first(h[:n])
        passed = first.listed(h)
        assert passed[:n].all() and passed[n:].sum() < 0.03 * len(h) + 10
        c = cascade.Cascade.from_bytes(cascade.Cascade.from_bytes(first.to_bytes()).grow(h[:n], h[n:][passed[n:]]).to_bytes())
        assert c.listed(h[:n]).all() and not c.listed(h[n:]).any()


def test_cascade_keeps_equal_hashes_apart():
    first = cascade.Cascade.first(np.array([7, 8], np.uint64)).to_bytes()
    built, alike = cascade.grown(first, ["in", "twin", "out"], np.array([7, 7, 9], np.uint64), np.array([True, False, False]))
    assert alike == ["twin"] and cascade.Cascade.from_bytes(built).listed(np.array([7, 9], np.uint64)).tolist() == [True, False]


def test_keys_of_hosts():
    raw, _ = bytetext.text_bytes(hosts := pa.array(["a.b.org", "", None, "x.", ".y", "z"]))
    got = [(int(r), raw[s:e].tobytes()) for r, s, e in zip(*cascade.host_keys(hosts), strict=True)]
    assert got == [(0, b"a.b.org"), (0, b"b.org"), (0, b"org"), (3, b"x."), (4, b".y"), (4, b"y"), (5, b"z")]


# --- words ---


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += "".join("b" if c == "a" else "a" for c in t)
    return t, "".join("b" if c == "a" else "a" for c in t)


def test_words_have_hashes_of_their_own():
    one, two = thue_morse(1024)
    texts = [" ".join([one, two, "Abc", "abc", "q" * 32, "q" * 33, "q" * 33, "q" * 34, "abcdefgh", "abcdefghi", "abc\0"]), None, "", one]
    h = bytetext.Words(*bytetext.text_bytes(pa.array(texts))).hashes().tolist()
    assert h[2] == h[3] and h[5] == h[6] and h[11] == h[0] and len(set(h)) == 9


# --- 2: sharding ---


def test_hilbert_curve_steps_to_neighbours(spark):
    bits, n = 3, 3
    cells = spark.range(1 << bits * n).select(*[(F.shiftright("id", bits * i) % (1 << bits)).alias(f"x{i}") for i in range(n)])
    own = cells.select("*", *[F.col(f"x{i}").alias(f"c{i}") for i in range(n)])
    for name, e in shards.hilbert_index([F.col(f"x{i}") for i in range(n)], bits):
        own = own.withColumn(name, e)
    path = [tuple(r)[1:] for r in own.select("h", "c0", "c1", "c2").orderBy("h").collect()]
    assert len(set(path)) == 512 and all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(path, path[1:], strict=False))


@pytest.mark.parametrize("n", [0, 1, 15, 16, 100, 1003])
def test_shards_are_even_and_gapless(spark, n):
    df = spark.range(n).select(F.when(F.col("id") % 50 == 3, None).otherwise(F.floor(F.col("id") / 2)).alias("doc_id"), F.lit("h").alias("h"), F.lit(1).alias("k"), F.lit("r").alias("row"))
    cells = [F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)), F.lit(0).cast("long")]
    out = shards.cut(shards.curve_order(df, cells, 2, "doc_id"), 16, n).collect()
    slots = Counter(r["shard"] for r in out)
    assert len(out) == n and (n == 0 or max(slots.values()) - (min(slots.values()) if n >= 16 else 0) <= 1)
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(c)) for s, c in slots.items())


def test_shards_take_odd_keys_and_names(spark):
    df = spark.createDataFrame([(k, x, "h") for k in (None, "7", "x y") for x in (None, 1.0, float("nan"), 2.0)], "doc_id string, x double, slot string").withColumn("shard", F.lit("s"))
    out = shards.cut(shards.curve_order(df, [F.col("x")], 2, "doc_id"), 3, 12)
    rows = out.collect()
    assert sorted(r.position for r in rows) == list(range(12)) and Counter(r["shard"] for r in rows) == {0: 4, 1: 4, 2: 4}
    assert [r.x for r in sorted(rows, key=lambda r: r.position)][-6:] == [1.0] * 3 + [2.0] * 3 and len(set(out.columns)) == len(out.columns)


def test_written_shards_prune_on_every_dimension(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(4096).select("id", (F.col("id") * 7919 % 64).alias("x"), (F.col("id") * 104729 % 61).alias("y")).repartition(8)
    shards.write_shards(df, [F.shiftright("x", 3), F.shiftright("y", 3)], 3, "id", 8, str(tmp_path / "out"), files=2)
    df.repartition(16).write.parquet(str(tmp_path / "plain"))

    def reads(folder, column, least, most):
        """Files whose statistics let them hold a value of the range, and all files."""
        every = [f for f in (tmp_path / folder).rglob("*.parquet")]
        stats = [pq.read_metadata(f).row_group(0).column(pq.read_schema(f).get_field_index(column)).statistics for f in every]
        return sum(s.min <= most and s.max >= least for s in stats), len(every)

    for column in "xy":
        some, every = reads("out", column, 0, 7)
        assert some <= every // 2 and reads("plain", column, 0, 7)[0] == 16
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4096 and {r["count"] for r in back.groupBy("shard").count().collect()} == {512}
    assert sorted(r.id for r in back.where("x < 8 and y < 8").collect()) == sorted(r.id for r in df.where("x < 8 and y < 8").collect())


# --- 3: exact duplicates ---


def test_quotient_filter_counts_and_merges():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 500, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in "ab")
    f = quotient.CountingQuotientFilter.of(a).merge(quotient.CountingQuotientFilter.of(b))
    true = Counter(np.concatenate([a, b]).tolist())
    assert dict(zip(f.fingerprints().tolist(), f.counts.tolist(), strict=True)) == true and f.count(12345) == 0
    assert all(f.count(int(k)) == n for k, n in list(true.items())[:50])
    back = [quotient.CountingQuotientFilter.piece(x, c) for _, x, c in f.pieces(3)]
    assert sum(int(x.counts.sum()) for x in back) == 6000


def test_exact_dedup(spark):
    texts = ODD + ["a b", "ab", "a  b", "a\tb\x0b", "a\x1cb", "c", "c"]
    got = {r.doc_id: r for r in quotient.dedupe(table(spark, texts)).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    for i, n in enumerate(norm):
        group = [j for j, m in enumerate(norm) if m == n]
        keep = min(group, key=lambda j: (-len(texts[j] or ""), j))
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, len(group), keep == i, hashlib.sha256(n.encode()).hexdigest())
    assert quotient.dedupe(table(spark, [])).count() == 0
    twice = quotient.dedupe(table(spark, ["q", "q"], [4, 4])).collect()
    assert [(r.keep_id, r.group_size) for r in twice] == [(4, 2)] * 2
    assert quotient.dedupe(table(spark, ["q", "r"], [None, 1])).count() == 2
    named = spark.createDataFrame([("q", "a"), ("p", "a"), (None, "a  "), ("z", "b")], "name string, text string")
    assert sorted((r.name or "", r.keep_id, r.kept) for r in quotient.dedupe(named, key="name").collect()) == [("", "p", False), ("p", "p", True), ("q", "p", False), ("z", "z", True)]


def test_exact_dedup_keeps_no_null_id_among_others(spark):
    got = quotient.dedupe(table(spark, ["a b  ", "ab", "a b", "c"], [None, 3, 4, None])).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [(0, 0, 1, True), (0, 4, 3, False), (3, 4, 3, False), (4, 4, 3, True)]


# --- 4: decontamination ---


def test_templates_catch_other_values_only_if_consistent(spark):
    item = "Yesterday the farmer Anna sold 12 red apples to Ben for 30 dollars and then Anna bought 12 green pears"
    other = "Yesterday the farmer Clara sold 7 red apples to David for 99 dollars and then Clara bought 7 green pears"
    mixed = "Yesterday the farmer Clara sold 7 red apples to David for 99 dollars and then Eve bought 8 green pears"
    tail = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    docs = [None, "", tail, f"{tail} {item} {tail}", f"{tail}. {other}", f"{tail}. {mixed}", item[:40], item.upper(), "short one here", f"{tail} {item} {tail}"]
    items = spark.createDataFrame([(1, item), (2, "short one here"), (3, None), (4, "...")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in templates.matches(table(spark, docs), items).collect()}
    assert {(3, 1, False), (4, 1, True), (9, 1, False), (8, 2, False)} <= got
    assert not {d for d, i, _ in got} & {0, 1, 2, 5, 6}
    kept = templates.clean(table(spark, docs), items)
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 2, 5, 6} and kept.columns == table(spark, docs).columns
    assert templates.matches(table(spark, docs), items.where("false")).count() == 0 and templates.matches(table(spark, []), items).count() == 0


def matched(spark, item, docs):
    """For each text whether it matches the item."""
    got = templates.matches(table(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    ids = {r.doc_id for r in got.collect()}
    return [i in ids for i in range(len(docs))]


def test_templates_drop_only_windows_that_conflict(spark):
    item = "on the table of the old kitchen there lay {} red apples and {} green pears which the cook wanted to bake for the guests"
    assert matched(spark, item.format(3, 3), [item.format(4, 6)]) == [True]
    assert matched(spark, item.format(3, 4), [item.format(7, 7)]) == [True]
    tale = "then the farmer {} walked over the wide field to the mill where the miller told {} that the flour was sold out so that {} had to go home with nothing"
    names = tale.format("Anna", "Anna", "Anna")
    assert matched(spark, names, [tale.format(*x) for x in (("Anna", "Anna", "Eve"), ("Clara", "Clara", "Eve"))]) == [True, True]
    # two texts of the template run together: the name is torn, and so is the number
    gave = "first farmer {} gave {} of the pears away and then farmer {} gave {} of them"
    assert matched(spark, gave.format("Anna", 12, "Anna", 12), [gave.format("Clara", 7, "Eve", 8), gave.format("Clara", 7, "Clara", 8)]) == [False, True]


def test_templates_read_openers_as_names_too(spark):
    short = "Which of the eight planets has the most moons today?"
    tail = "wa wb wc wd we wf wg wh some text before and"
    assert matched(spark, short, [f"{tail} {short} {tail}", f"{tail}. {short}", f"{tail} {short.replace('Which', 'None')}"]) == [True, True, False]
    sums = "{0} has {1} apples. {0} buys {2} more apples. {0} gives {3} apples away. How many apples does {0} have left?"
    assert matched(spark, sums.format("Anna", 12, 7, 5), [sums.format("Clara", 31, 8, 4), f"{tail} {sums.format('Clara', 31, 8, 4)}"]) == [True, True]
    named = "the farmer Anna has {1} red apples. {0} sells {2} of the apples to the miller"
    broken = named.format("Anna", 12, 7).replace("farmer Anna", "farmer\nAnna")
    assert matched(spark, named.format("Anna", 12, 7), [broken, broken.replace("Anna", "Clara"), broken.replace("12", "9").upper()]) == [True, True, True]


def test_templates_fold_all_case(spark):
    spanish = "el niño pequeño comió la manzana roja en el jardín de su abuela durante la última tarde de otoño porque él tenía hambre"
    german = "die große straße führt über den fluss und an den äckern vorbei bis zu einem schönen schloss auf der höhe"
    russian = "маленький мальчик ел красное яблоко в саду у своей бабушки прошлой осенью когда он был очень голоден и устал"
    for item in (spanish, german, russian):
        assert matched(spark, item, [f"ABC DEF {item.upper()} XYZ", "nothing of this is in here"]) == [True, False]
        assert matched(spark, item.upper(), [f"abc def {item} xyz"]) == [True]


def test_folding_keeps_the_words():
    text = " ".join(f"{chr(i)} a{chr(i)}" for i in range(33, 0x20000) if not 0xD800 <= i < 0xE000)
    column = pa.array([text, None, "", "ÀÉ ß"])
    before, after = (bytetext.Words(*bytetext.text_bytes(c)) for c in (column, templates._folded(column)))
    assert before.count.tolist() == after.count.tolist() and (templates._inner(before)[0] == templates._inner(after)[0]).all()
    assert len(templates._folded(pa.array([b"\xff A"]))[0].as_py()) == 3


def test_short_items_of_numbers_and_names(spark):
    tail = "wa wb wc wd we wf wg wh some text before"
    cases = {
        "Add 12 7 3 and 5": ("Add 4 9 8 and 1", "Add 4 9 8 or 1"), "Compute 3 * 4 + 5 - 6": ("Compute 7 * 8 + 1 - 2", "Divide 7 * 8 + 1 - 2"), "Anna has 5 apples": ("Ben has 7 apples", "the ben has some apples"),
        "Which town has 3 mills?": ("Which town has 8 mills?", "Every town has 8 mills?"), "12 7 3": ("12 7 3", "4 5 6"),
    }
    for item, (same, other) in cases.items():
        assert matched(spark, item, [same, f"{tail}. {same} {tail}", f"{tail}. {other} {tail}"]) == [True, True, False], item


def test_items_of_one_template_are_one_class(spark):
    ask = "the farmer {} sold {} red apples to his neighbour and {} pears to the miller"
    items = spark.createDataFrame([(i, ask.format("Anna" if i % 2 else "Ben", i, 2 * i)) for i in range(40)] + [(50, ask.replace("miller", "baker").format("Eve", 1, 1)), (None, None)], "item_id long, text string")
    docs = [f"wa wb. {ask.format('Carl', 99, 98)} wc", f"wa wb. {ask.format('Anna', 7, 14)} wc", "wa wb wc", ask.replace("miller", "baker").format("Tom", 5, 6)]
    got = {(r.doc_id, r.item_id, r.n_items, r.reparameterised) for r in templates.matches(table(spark, docs), items).collect()}
    assert {x for x in got if x[1] == 0 and x[0] < 2} == {(0, 0, 40, True), (1, 0, 40, False)} and (3, 50, 1, True) in got and 2 not in {x[0] for x in got}
    twice = "first {} met {} at the mill and then {} went home with all of the flour"
    same, other = (spark.createDataFrame([(1, twice.format("Anna", "Ben", x))], "item_id long, text string") for x in ("Anna", "Ben"))
    assert templates.item_classes(templates.benchmark_windows(same.unionAll(other.withColumn("item_id", F.lit(2).cast("long"))), "item_id", "text", 8)).count() == 2


def questions(rng):
    """Templates with slots {n} numbers, {u} units, and {A} {B} names, of several lengths and with names at any place."""
    names, units = ["Anna", "Ben", "Clara", "David", "Eve", "Frank", "Élise", "Jürgen"], ["kg", "metres", "hours", "litres", "dollars", "%"]
    shapes = [
        "{A} buys {n} apples and {n} pears. {A} gives {n} of them to {B}. How many does {A} have left?", "A train leaves {A} at {n} hours and goes {n} {u} to the north. When does it reach {B}?",
        "{A} is {n} years old. {B} is {n} years older than {A}. How old is {B}?", "What is {n} plus {n} minus {n}?", "Compute {n} * {n} + {n} - {n}", "Add {n} {n} {n} and {n}", "{A} has {n} coins",
        "If {A} and {B} share {n} {u} of flour evenly, how much does each of them get?", "The sum of {n} and {n} is how much more than {n}?", "How many {u} are there in {n} {u} of water?",
        "In a field of {n} {u} by {n} {u} the farmer {A} plants {n} trees in each row; how many rows does {A} need?", "Le fermier {A} vend {n} pommes rouges à son voisin {B} pour {n} euros et achète {n} poires",
        "Yesterday {A} met {B} near the old mill and lent him {n} {u} until the end of the week", "Which number comes next after {n} {n} {n} {n}?", "Der Bauer {A} verkauft {n} rote Äpfel an {B} und kauft dann {n} Birnen",
    ]

    def filled(shape):
        pair = rng.sample(names, 2)
        text = shape.replace("{A}", pair[0]).replace("{B}", pair[1])
        while "{n}" in text or "{u}" in text:
            text = text.replace("{n}", str(rng.randrange(2, 500)), 1).replace("{u}", rng.choice(units), 1)
        return text

    return shapes, filled


def test_recall_of_other_values(spark):
    """Of re-parameterised questions inside prose at least 0.9 are found, and no text without one is taken for one."""
    rng = random.Random(17)
    shapes, filled = questions(rng)
    items = spark.createDataFrame([(i, filled(s)) for i, s in enumerate(shapes)], "item_id long, text string")
    docs, want = [], []
    for _ in range(20):
        for i, s in enumerate(shapes):
            lead = prose(rng, rng.randrange(5, 40), 5000)
            docs.append(f"{lead}{rng.choice(['. ', ': ', chr(10), ' '])}{filled(s)} {prose(rng, 20, 5000)}")
            want.append(i)
    words_ = [filled(s).split() for s in shapes for _ in range(20)]
    clean = [" ".join(rng.sample(w, len(w))) for w in words_ if len(w) > 8] + [prose(rng, 60, 5000) for _ in range(100)]
    clean += [f"{rng.choice(['Tom', 'Lea'])} sees {rng.randrange(90)} birds in the tall tree behind the {w} and counts them again" for w in ("house", "barn", "mill", "church", "school")]
    got = {(r.doc_id, r.item_id) for r in templates.matches(table(spark, docs + clean), items).collect()}
    found = sum((d, i) in got for d, i in enumerate(want))
    false = {d for d, _ in got if d >= len(docs)}
    print(f"recall {found / len(want):.3f}, false {len(false)} of {len(clean)}; missed {Counter(i for d, i in enumerate(want) if (d, i) not in got)}")
    assert found >= 0.9 * len(want) and not false


@pytest.mark.parametrize("numbers", [False, True])
def test_verbatim_passages_against_brute_force(spark, numbers):
    rng = random.Random(9)
    spell = lambda t: t if numbers else "".join(chr(ord(c) + 49) if c.isdigit() else c for c in t)
    items = [spell(prose(rng, n, 5000)) for n in (3, 9, 20, 40)]
    docs = [spell(prose(rng, 60, 5000)) for _ in range(30)]
    for i, t in enumerate(items):
        docs[i * 3] = f"{docs[i * 3][:100]} {t} {docs[i * 3]}"
    got = templates.matches(table(spark, docs), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    want = {(d, i) for d, t in enumerate(docs) for i, s in enumerate(items) if f" {s} " in f" {t} "}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


# --- 5: BPE ---


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCAB)
    rng = random.Random(2)
    letters = "abcdeéÉßſİΣσςc'sT012٣²½Ⅷ漢Ａ_-!?<|>\n\t \xa0​é😀\x00\x1c\x85"
    texts = ODD[:8] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["<|endoftext|>a <|startoftext|>", "a" * 5000, "the" * 400]
    got = {r.doc_id: r for r in bpe.digests(table(spark, texts), VOCAB).collect()}
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()), x
    plain = bpe.encode(table(spark, ["two words", None]), VOCAB).orderBy("doc_id").collect()
    assert plain[0].ids == t.encode("two words", add_special_tokens=False).ids and plain[1].ids == [] and plain[1].decoded == ""
    assert bpe.digests(table(spark, []), VOCAB).count() == 0
    odd = spark.createDataFrame([(None, "the"), (3, "the"), (3, "of the")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in bpe.digests(odd, VOCAB).collect()) == [(0, 1), (3, 1), (3, 2)]
    clash = bpe.lengths(odd.select(F.col("text").alias("t"), F.lit(1).alias("text_"), F.lit("x").alias("n_tokens"), F.lit("y").alias("__text")), VOCAB, "t")
    assert clash.columns == ["text_", "__text", "n_tokens"] and sorted(r.n_tokens for r in clash.collect()) == [1, 1, 2]


# --- 6: Jaccard join ---


def linked(texts, k, num, den):
    sets = []
    for t in texts:
        w = words("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("k,num,den,block", [(3, 90, 100, 400), (5, 80, 100, 400), (5, 80, 100, 6), (3, 90, 100, 5)])
def test_jaccard_components(spark, monkeypatch, k, num, den, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(k * den + block)
    texts = list(ODD[:8]) + ["Two words", "two  WORDS"]
    for _ in range(12):
        base = prose(rng, rng.choice([4, 12, 30, 80, 300])).split()
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = "z" + str(rng.randrange(9999))
            if rng.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * rng.uniform(0.8, 1)))]
            texts.append(" ".join(copy))
    passage = prose(rng, 40)
    texts += [f"{passage} {prose(rng, n)}" for n in (3, 4, 5, 6, 7, 8, 9, 10, 40, 41, 42, 300)]
    base = prose(rng, 50).split()
    texts += [" ".join(base[:i] + ["z"] + base[i + 1 :]) for i in range(0, 50, 4)] + [" ".join(base)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(table(spark, texts), k, num, den).collect()}
    assert got == linked(texts, k, num, den)


def test_jaccard_odd_tables(spark):
    assert jaccard.link_components(table(spark, [])).count() == 0
    got = jaccard.link_components(table(spark, ["a b c", "a b c", "a b c", None], [5, 5, None, None])).collect()
    assert sorted((r.doc_id or -1, r.n_shingles) for r in got) == [(-1, 0), (-1, 1), (5, 1), (5, 1)]
    named = spark.createDataFrame([("q", "a b c d"), ("p", "a b  c d"), (None, "a b c d"), ("r", ""), ("p", "x y z")], "name string, text string")
    got = jaccard.link_components(named, 3, 90, 100, key="name").collect()
    assert sorted((r.name or "", r.n_shingles, r.component_id or "") for r in got) == [("", 2, ""), ("p", 1, "p"), ("p", 2, "p"), ("q", 2, "p"), ("r", 0, "r")]


def test_jaccard_heavy_texts_that_cannot_link(spark, monkeypatch):
    """Texts that share half of their words with all others are heavy, but none of them is counted, however many they are."""
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rows, plain = [], jaccard._links

    def links(docs, key, text, members, *rest):
        rows.append(members.select(F.explode("at")).count())
        return plain(docs, key, text, members, *rest)

    monkeypatch.setattr(jaccard, "_links", links)
    rng = random.Random(30)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} {' '.join('q' + str(rng.randrange(10**9)) for _ in range(55))}" for _ in range(150)]
    texts += [f"{texts[i]} more" for i in (3, 3, 140)] + [passage, f"{passage} once more"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(table(spark, texts)).collect()}
    assert got == linked(texts, 5, 80, 100) and sum(rows) < 4 * len(texts)


@pytest.mark.parametrize("block", [7, 1000])
def test_jaccard_blocks_of_a_cluster(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block)
    rows = [(k, k % 3, 1, rng.choice([4, 5, 6, 6, 8]), 900 if rng.random() < 0.7 else rng.choice([k, 901])) for k in range(150)] + [(k, 5, 1, 4, 77) for k in range(200, 230)]
    met = {}
    for r in jaccard._cluster_members(spark.createDataFrame(rows, "k long, root long, n long, class int, label long")).collect():
        met.setdefault(r["at"].task, []).append((r.k, r["at"].side))
    counted = {(a, b) for x in met.values() for a, s in x for b, t in x if a < b and (s != t or s == 0)}
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and abs(a[3] - b[3]) <= 1 and a[4] != b[4]}
    assert want and want <= counted
    assert not any(a[4] == b[4] == 900 for a, b in ((rows[a], rows[b]) for a, b in counted)) and not any(a >= 200 for a, _ in counted)
    assert all(len(x) < 4 * block for x in met.values())


def test_jaccard_tells_long_words_apart(spark):
    one, two = thue_morse(1024)
    got = jaccard.link_components(table(spark, [f"{one} x y", f"{two} x y", f"{one} x y"]), 3, 90, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 1, 2: 0}


def test_overlaps_of_very_large_sets_are_whole():
    shared, n = 671_121, 0
    base = np.arange(shared, dtype=np.uint64) * np.uint64(2**40)
    a, b = (np.concatenate([base, np.arange(m, dtype=np.uint64) + np.uint64(2**63 + at)]) for m, at in ((37_284, 1), (37_285, 10**9)))
    size = len(a) + len(b) - shared
    assert 100 * shared >= 90 * size > 100 * shared - 100
    for n, want in ((0, 1), (9, 0)):
        wider = np.concatenate([b, np.arange(n, dtype=np.uint64) + np.uint64(2**63 + 10**12)])
        node, _ = jaccard._count_block([1, 2], [1, 2], [a.tobytes(), wider.tobytes()], 90, 100)
        assert len(node) == want


def test_counting_a_block():
    sets = [np.array(x, np.uint64).tobytes() for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [], [1, 2, 3, 4], [1, 2, 3, 4, 9, 10, 11])]
    links = lambda sides: sorted(zip(*(x.tolist() for x in jaccard._count_block([0, 1, 2, 3, 4], sides, sets, 80, 100)), strict=True))
    assert links([0] * 5) == [(1, 0), (3, 0)] and links([1, 2, 2, 1, 1]) == [(1, 0)] and links([2] * 5) == [] and links([0, 2, 2, 2, 2]) == [(1, 0), (3, 0)]


def test_fragments_share_one_for_every_link():
    rng = np.random.default_rng(8)
    for n in (9, 10, 50, 333, 2000):
        for num in (80, 90):
            a = np.sort(rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1))
            for cut in range(n * (100 - num) // num + 1):
                b = np.sort(np.concatenate([a[: n - cut // 2], rng.integers(0, 2**63, cut - cut // 2).astype(np.uint64)]))
                inter = len(np.intersect1d(a, b))
                if 100 * inter >= num * (len(a) + len(b) - inter) and inter < max(len(a), len(b)):
                    h, at, _ = jaccard.fragment_hashes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), num, 100)
                    assert len(np.intersect1d(h[: at[1]], h[at[1] :])), (n, num, cut)


# --- 7: classifier ---


def test_gam_learns_held_out_texts(spark):
    rng = random.Random(4)
    good = [" ".join(prose(rng, 60).split()) + "." for _ in range(300)]
    bad = [" ".join(w + rng.choice(["!!", "$$$"]) for w in prose(rng, 60).split()) for _ in range(300)]
    texts = [t for p in zip(good, bad, strict=True) for t in p] + ODD
    docs = table(spark, texts)
    labels = docs.where("doc_id < 600").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality")).unionAll(spark.createDataFrame([(1, None), (None, 1), (3, 5)], "doc_id long, quality int"))
    model = gam.train(docs, labels, "quality", remainder(4) != 2)
    got = {r.doc_id: r.score for r in gam.score(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.7) == (i % 2 == 0) for i in held) >= 0.98 * len(held) and all(0 <= s <= 1 for s in got.values()) and len(got) == len(texts)
    assert gam.keep(docs, model, 0.7).count() == sum(s >= 0.7 for s in got.values())
    odd = spark.createDataFrame([(None, good[0], 1), (1, good[1], 2), (1, bad[0], 3)], "doc_id long, text string, x long")
    assert [r.x for r in gam.keep(odd, model, 0.7).orderBy("x").collect()] == [1, 2] and gam.score(odd, model).count() == 3
    none = gam.train(docs, labels.where("false"), "quality", F.lit(True))
    assert {r.score for r in gam.score(docs, none).collect()} == {0.5} and gam.score(table(spark, []), model).count() == 0


# --- 8: lengths ---


def test_length_histogram(spark):
    rng = random.Random(6)
    texts = ODD + [prose(rng, rng.randrange(40)) for _ in range(200)]
    b = bpe.BacktrackingBPE.load(VOCAB)
    n = sorted(len(b.encode(t or "")) for t in texts)
    got = {r.n_tokens: r for r in lengths.suffix_sums(lengths.histogram(table(spark, texts), VOCAB)).collect()}
    assert {k: r.n_docs for k, r in got.items()} == Counter(n)
    for k, r in got.items():
        assert r.docs_at_least == sum(x >= k for x in n) and r.tokens_at_least == sum(x for x in n if x >= k) and r.truncated_tokens == sum(min(x, k) for x in n)
        assert math.isclose(r.quantile, sum(x <= k for x in n) / len(n)) and r.total_docs == len(n) and r.total_tokens == sum(n)
    grouped = lengths.suffix_sums(lengths.histogram(table(spark, texts).withColumn("g", F.when(F.col("doc_id") % 2 == 0, "a")), VOCAB, by=["g"]), ["g"])
    assert grouped.agg(F.sum("n_docs")).first()[0] == len(texts)
    sums = lengths.suffix_sums(lengths.histogram(table(spark, texts), VOCAB))
    assert lengths.truncated_total(sums, 17) == sum(min(x, 17) for x in n)
    assert lengths.suffix_sums(lengths.histogram(table(spark, []), VOCAB)).count() == 0


# --- 9: chat ---


def test_reply_trees_pick_the_best_branch(spark):
    rows = [("r", None, 1.0), ("a", "r", 5.0), ("b", "r", 1.0), ("a1", "a", 1.0), ("a2", "a", 9.0), ("solo", "gone", None), ("x", "y", 1.0), ("y", "x", 1.0), ("z", "y", 1.0), (None, "r", 99.0)]
    nodes = spark.createDataFrame(rows, "node string, parent string, score double").withColumns({"n": F.lit(1), "path": F.lit("p"), "rank": F.lit(2)})
    got = {}
    for r in chat.paths(nodes, top=2).collect():
        got.setdefault((r["path"], r["rank"]), {})[r["depth"]] = r["node"]
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {("a2", 1): ["r", "a", "a2"], ("a1", 2): ["r", "a", "a1"], ("solo", 1): ["solo"]}
    assert chat.paths(nodes.where("false")).count() == 0
    chain = spark.range(300).select(F.col("id").alias("node"), (F.nullif("id", F.lit(0)) - 1).alias("parent"), F.lit(1).alias("score"))
    assert sorted(r.depth for r in chat.paths(chain).collect()) == list(range(300))


def test_repeated_messages_are_one(spark):
    rows = [(i, i - 1 if i else None, float(s)) for i in range(3) for s in (1, 2)] + [(2, 0, 5.0)]
    got = chat.paths(spark.createDataFrame(rows, "node long, parent long, score double")).collect()
    assert sorted((r.depth, r.node) for r in got) == [(0, 0), (1, 1)] or sorted((r.depth, r.node) for r in got) == [(0, 0), (1, 2)]
    assert len(got) == 2  # 2 answers 0, its least parent, so there are two branches of two messages


@pytest.mark.parametrize("seed", range(2))
def test_branches_against_brute_force(spark, seed):
    rng = random.Random(seed)
    parent = {i: (rng.randrange(i) if i % 9 else None) for i in range(120)}
    score = {i: rng.randrange(5) for i in parent}
    nodes = spark.createDataFrame([(i, p, score[i]) for i, p in parent.items()], "node long, parent long, score long")
    want = {}
    for leaf in set(parent) - set(parent.values()):
        up = [leaf]
        while parent[up[-1]] is not None:
            up.append(parent[up[-1]])
        want.setdefault(up[-1], []).append((-sum(score[i] for i in up) / len(up), leaf, up[::-1]))
    want = {(leaf, rank): up for some in want.values() for rank, (_, leaf, up) in enumerate(sorted(some)[:3], 1)}
    got = {}
    for r in chat.paths(nodes, top=3).collect():
        got.setdefault((r.path, r.rank), {})[r.depth] = r.node
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == want


def test_template_reads_back(spark):
    nasty = ["", None, "<|im_end|>\n", "<\\|im_start|>user\nx", "</s>[INST] ok [/INST]", "<\\\\|", "[\\/INST]", "<<SYS>><</SYS>>", "a\\", "\\n", "$1", "x" * 100_000, "é\n\r"]
    rows = [(c, i, r, t) for c, r in enumerate(["user", "assistant", None, "sys\ntem", "a\\n", "<|im_end|>"]) for i, t in enumerate(nasty)]
    df = spark.createDataFrame(rows, "c long, i long, role string, text string")
    out = chat.format_paths(df, "c", "i").select("c", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(chat.read_back(F.col("formatted"))).alias("loss")).collect()
    for r in out:
        assert [(t.role, t.text) for t in r.turns] == [(a or "", t or "") for c, _, a, t in rows if c == r.c]
        assert r.loss == ("".join(t or "" for t in nasty) if r.c == 1 else "")


# --- 10: LM scoring ---


def test_elias_fano():
    rng = np.random.default_rng(1)
    for v in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 50, 400)), np.sort(rng.integers(0, 2**62, 3000)), np.arange(1000) * 2**40):
        v = np.array(v, np.uint64)
        e = ngram.EliasFano.of(v)
        assert np.array_equal(e.get(np.arange(len(v))), v)
        ask = np.concatenate([v, v + np.uint64(1), rng.integers(0, 2**63, 200).astype(np.uint64)])
        at, same = e.find(ask)
        assert np.array_equal(at, np.searchsorted(v, ask)) and np.array_equal(same, np.isin(ask, v))
    large = ngram.EliasFano.of(np.sort(rng.integers(0, 2**44, 1_000_000).astype(np.uint64)))
    assert sum(x.nbytes for x in (large.low, large.high, large.ones)) < 3.5 * 1_000_000  # of 8 plain; 24 + 2 bits at best


def test_packed_numbers_read_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        x = np.sort(rng.integers(0, 2**60, n).astype(np.uint64))
        assert np.array_equal(ngram.unpack(ngram.pack(x, True), np.uint64, True), x)
        assert np.array_equal(ngram.unpack(ngram.pack(x.astype(np.uint16)), np.uint16), x.astype(np.uint16))


def test_trie_file_is_memory_mapped(tmp_path):
    import mmap

    c = np.array([3, 3, 3, 8, 9, 9], np.uint64)
    w = np.array([1, 5, 7, 5, 0, 2**32 - 1], np.uint64)
    n = np.array([4, 1, 1, 2, 1, 3])
    (tmp_path / "trie").write_bytes(ngram.NgramTrie.build(c, w, n, {}, 32).to_bytes())
    with (tmp_path / "trie").open("rb") as f:
        t = ngram.NgramTrie.open(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    rank, found = t.contexts(np.array([3, 8, 9, 4, 10], np.uint64))
    assert found.tolist() == [True, True, True, False, False]
    got = ngram.probability(t.lookup(rank, found, np.array([3, 1, 1, 1, 0], np.uint32), np.array([1, 2, 7, 5, 2**32 - 1, 1], np.uint64)))
    assert np.allclose(got, [3.25 / 6, 0, 0.25 / 6, 1.25 / 2, 2.25 / 4, 0], rtol=1e-3)


@pytest.mark.parametrize("order,chunk,shard", [(3, 1_500_000, 2_500_000), (2, 120, 300), (3, 120, 300), (4, 500, 300)])
def test_scores_against_brute_force(spark, monkeypatch, order, chunk, shard):
    monkeypatch.setattr(ngram, "CHUNK", chunk)
    rng = random.Random(7)
    long = thue_morse(1024)
    texts = ODD[:8] + [" ".join(rng.choice(["the", "The", "of", f"w{rng.randrange(40)}", f"v{rng.randrange(3000)}"]) for _ in range(rng.randrange(50))) for _ in range(150)]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]
    texts[train.index(True, 20)], texts[train.index(False, 20)] = f"{long[0]} x", f"{long[1]} x"
    seqs = [["<s>"] * (order - 1) + [*words("".join(c.lower() if c.isascii() else c for c in t or "")), None] for t in texts]
    count = {n: Counter() for n in range(1, order + 1)}
    for s, on in zip(seqs, train, strict=True):
        for i in range(order - 1, len(s)) if on else ():
            for n in count:
                count[n][tuple(s[i - n + 1 : i + 1])] += 1
    total, types = sum(count[1].values()), len(count[1])
    context, successors = Counter(), Counter()
    for n in range(2, order + 1):
        for g, c in count[n].items():
            context[g[:-1]] += c
            successors[g[:-1]] += 1
    got = {r.doc_id: r for r in ngram.score(table(spark, texts), remainder(5) != 1, order=order, shard_tokens=shard).collect()}
    for i, s in enumerate(seqs):
        base = full = known = 0.0
        for j in range(order - 1, len(s)):
            p = (count[1][s[j],] + 0.5) / (total + 0.5 * (types + 1))
            known += count[1][s[j],] > 0
            base += math.log10(p)
            for n in range(2, order + 1):
                c = tuple(s[j - n + 1 : j])
                if context[c]:
                    p = max(count[n][*c, s[j]] - 0.75, 0) / context[c] + 0.75 * successors[c] / context[c] * p
            full += math.log10(p)
        r = got[i]
        assert (r.training, r.n_tokens, r.n_known, r.train_tokens) == (train[i], len(s) - order + 1, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, full, rel_tol=2e-3, abs_tol=1e-3)


def test_scores_of_odd_tables(spark):
    assert ngram.score(table(spark, []), F.lit(True)).count() == 0
    got = ngram.score(table(spark, ["a b", None]), F.lit(False)).collect()
    assert [r.n_known for r in got] == [0, 0] and all(math.isfinite(r.score) for r in got)
    odd = spark.createDataFrame([(None, "a b", True), (1, "a b", None), (1, "a c", True)], "doc_id long, text string, c boolean").withColumns({"chunk": F.lit(1), "k": F.lit("k")})
    got = sorted((r.doc_id or 0, r.training, r.n_known, r.train_tokens) for r in ngram.score(odd, F.col("c")).collect())
    assert got == [(0, True, 3, 6), (1, False, 3, 6), (1, True, 3, 6)]
