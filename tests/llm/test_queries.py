"""The registered queries and the pipeline over the smallest driver tables, where those are there."""

import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from placeloom.llm import bytetext

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def test_op2_has_the_sizes_and_sums_of_its_texts(spark):
    from placeloom.llm.queries import op2_hilbert_shards

    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op2_hilbert_shards(spark, SF).collect()
    assert {r.doc_id: (r["size"], r["text_crc32"]) for r in out} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_words(text):
    """Words without case and outer punctuation, as a reader would compare passages."""
    found = (re.sub(r"^[^\w%]+|[^\w%]+$", "", w) for w in (text or "").casefold().split())
    return [w for w in found if w]


def linked_groups(rows, k=5, num=80, den=100):
    """{id: least id reachable} by brute force over all pairs that share a shingle."""
    sets = {i: {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set()) for i, t in rows for w in [words_of(t)]}
    holders, root = {}, {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {(a, b) for own in holders.values() for a in own for b in own if a < b}:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as p
    from placeloom.llm import gam
    from placeloom.llm.queries import VOCAB, quality_model
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(p.STAGES)
    model = quality_model(spark, SF)
    a = {r.doc_id: r.text for r in steps["quality"](spark, docs, SF).collect()}
    every = {r.doc_id: r.text for r in docs.collect()}
    # the sum of tables by plain Python
    features = lambda t: gam.features(*bytetext.text_bytes(pa.array([t])))[0]

    def accepted(t):
        x = features(t)
        at = [int(np.searchsorted(e, v, "right")) for e, v in zip(model.edges, x, strict=True)]
        total = model.intercept + sum(t[i] for t, i in zip(model.tables, at, strict=True)) + sum(g[model.coarse[i][at[i]], model.coarse[j][at[j]]] for (i, j), g in model.pairs.items())
        return 1 / (1 + math.exp(-total)) >= 0.7

    assert set(a) == {i for i, t in every.items() if accepted(t)}
    groups = {}
    for i, t in a.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    want = {min(g)[1] for g in groups.values()}
    kept = spark.createDataFrame([r for r in docs.collect() if r.doc_id in a], docs.schema)
    b = steps["exact_dedup"](spark, kept, SF).collect()
    assert {r.doc_id for r in b} == want and len(b) == len(want)
    root = linked_groups([(r.doc_id, r.text) for r in b])
    c = steps["near_dedup"](spark, spark.createDataFrame(b, docs.schema), SF).collect()
    assert {r.doc_id for r in c} == {i for i, x in root.items() if i == x}
    items = [plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 8]) for w in items for i in range(max(1, len(w) - 7))}
    whole = {r.doc_id for r in c if any(f" {' '.join(w)} " in f" {' '.join(plain_words(r.text))} " for w in items)}
    free = {r.doc_id for r in c if not any(tuple(w[i : i + 8]) in windows for w in [plain_words(r.text)] for i in range(len(w)))}
    d = steps["decontaminate"](spark, spark.createDataFrame(c, docs.schema), SF).collect()
    assert not {r.doc_id for r in d} & whole and free <= {r.doc_id for r in d} and whole
    t = Tokenizer.from_file(VOCAB)
    out = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in steps["encode"](spark, spark.createDataFrame(d, docs.schema), SF).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in d:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert out[r.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
    assert {(r.doc_id, r.n_tokens) for r in p.run(spark, SF).collect()} == {(i, x[0]) for i, x in out.items()}


def test_pipeline_stages_of_nothing(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in p.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
    odd = spark.createDataFrame([(None, None, "en", "s", 0, "x"), (1, "", "en", "s", 0, "y")], "doc_id long, text string, lang string, source string, n_chars long, _row string")
    for name in ("exact_dedup", "near_dedup", "decontaminate"):
        out = dict(p.STAGES)[name](spark, odd, SF)
        assert out.columns == odd.columns and out.count() == (1 if name == "exact_dedup" else 2)


def test_pipeline_stages_go_by_rows(spark):
    import corpus_pipeline as p

    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 150").first().text
    text = lambda n: " ".join(f"word{'abcdefghij'[n]}{i}" for i in range(60))
    # nulls with own texts, a null with a copy, one id with equal rows, one id with a copy of another's text, near copies
    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (5, text(2)), (6, text(3)), (6, text(3)), (7, text(4)), (7, text(5)), (8, text(5)), (9, text(6)), (None, text(6) + " more"), (None, item[:60]), (None, item[60:]), (None, item)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    steps = dict(p.STAGES)
    a = steps["exact_dedup"](spark, docs, SF)
    assert sorted(r.text for r in a.collect()) == sorted({t for _, t in rows}) and a.columns == docs.columns
    assert {(r.doc_id, r.text) for r in a.collect()} >= {(5, text(2)), (7, text(5)), (None, text(0))}
    b = steps["near_dedup"](spark, a, SF)
    assert sorted(r.text for r in b.collect()) == sorted({t for _, t in rows} - {text(6) + " more"}) and b.columns == docs.columns
    c = steps["decontaminate"](spark, b, SF)
    left = {r.text for r in c.collect()}
    assert item not in left and {text(i) for i in range(7)} <= left and c.columns == docs.columns


def test_registered_queries_equal_their_sql(spark):
    import duckdb

    from placeloom.llm import queries

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    for name, sql in queries.ORACLES.items():
        want = con.sql(sql)
        names = sorted(want.columns)
        got = sorted(tuple(map(str, r)) for r in queries.QUERIES[name](spark, SF).select(*names).collect())
        assert got == sorted(tuple(map(str, r)) for r in con.sql(f"SELECT {', '.join(names)} FROM want").fetchall()), name
