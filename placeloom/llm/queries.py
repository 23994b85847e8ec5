"""Queries ``opN_<name>`` of the corpus operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, cascade, centroids, chat, cobucket, gam, jaccard, lengths, ngram, quotient, shards, simhash, templates
from placeloom.plans.scratch import Scratch, ship

try:
    from public_tokenizers import path as vocabulary
except ModuleNotFoundError:  # the same files where the package is not on the path

    def vocabulary(name: str) -> str:
        return f"/opt/tokenizers/{name}"


VOCAB = vocabulary("word_bpe_49k.json")
SHARDS = 16
BUCKETS = 600


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Hosts that the URL filter blocks with their subdomains.
BLOCKED = [f"{name}.example.{end}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for end in ("com", "net", "org")]
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    domains = spark.createDataFrame([(d,) for d in BLOCKED], "domain string")
    return cascade.judge(pages, domains, RULES).drop("url")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rh, rp, rv) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
names(d) AS (SELECT n || '.example.' || e FROM (VALUES ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) a(n), (VALUES ('com'), ('net'), ('org')) b(e)),
best AS (
  SELECT page_id, host, path, (
    SELECT max_by(struct_pack(r := rh || rp, v := rv), length(rh || rp)) FROM rules
    WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS x,
    (SELECT count(*) FROM names WHERE host = d OR ends_with(host, '.' || d)) AS listed
  FROM p
)
SELECT page_id, host, path, x.r AS rule, coalesce(x.v, CASE WHEN listed > 0 THEN 'block' ELSE 'allow' END) AS verdict FROM best
"""


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "lang", "source")
    cells = [
        F.pmod(F.coalesce(F.regexp_extract("source", "([0-9]{1,9})", 1).try_cast("long"), F.lit(0)), F.lit(16)).cast("long"),
        F.coalesce(F.pmod(F.ascii("lang") * 7 + F.ascii(F.substring("lang", 2, 1)), F.lit(16)), F.lit(0)).cast("long"),
        F.least(F.lit(15), F.greatest(F.lit(0), F.length(F.bin("size")) - 4)).cast("long"),
    ]
    rows = docs.count()
    out = shards.cut(shards.curve_order(docs, cells, 4, "doc_id", rows), SHARDS, rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert_index")


def _hilbert_sql(source: str, cells: int, bits: int) -> tuple[str, str]:
    """CTEs that add the curve index ``h`` to ``source`` with columns x0, x1, ..., and the name of the last."""
    steps = [("s", "CAST(0 AS BIGINT)"), ("t", "CAST(0 AS BIGINT)")]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        steps.append(("x0", f"CASE WHEN x0 & {1 << b} <> 0 THEN xor(x0, {low}) ELSE x0 END"))
        for i in range(1, cells):
            steps += [("s", f"xor(x0, x{i}) & {low}"), ("x0", f"CASE WHEN x{i} & {1 << b} <> 0 THEN xor(x0, {low}) ELSE xor(x0, s) END"), (f"x{i}", f"CASE WHEN x{i} & {1 << b} <> 0 THEN x{i} ELSE xor(x{i}, s) END")]
    steps += [(f"x{i}", f"xor(x{i}, x{i - 1})") for i in range(1, cells)]
    steps += [("t", f"CASE WHEN x{cells - 1} & {1 << b} <> 0 THEN xor(t, {(1 << b) - 1}) ELSE t END") for b in range(bits - 1, 0, -1)]
    steps.append(("h", " | ".join(f"(((xor(x{i}, t) >> {b}) & 1) << {b * cells + cells - 1 - i})" for b in range(bits) for i in range(cells))))
    text, last, known = [], source, {f"x{i}" for i in range(cells)}
    for n, (name, expr) in enumerate(steps):
        text.append(f"hs{n} AS (SELECT * REPLACE ({expr} AS {name}) FROM {last})" if name in known else f"hs{n} AS (SELECT *, {expr} AS {name} FROM {last})")
        last = f"hs{n}"
        known.add(name)
    return ", ".join(text), last


_CURVE, _LAST = _hilbert_sql("placed", 3, 4)
OP2_SQL = f"""
WITH RECURSIVE bits(i, r, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) q(i)
  UNION ALL SELECT i, r + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM bits WHERE r < 8
), tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE r = 8),
byt AS (
  SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT))) AS b
  FROM documents
), placed AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, xor(list_reduce(b, lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32,
    CAST(coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})', 1), '') AS BIGINT), 0) % 16 AS BIGINT) AS x0,
    CAST(coalesce((ascii(lang) * 7 + ascii(substr(lang, 2, 1))) % 16, 0) AS BIGINT) AS x1,
    CAST(least(15, greatest(0, length(bin(CAST(size AS BIGINT))) - 4)) AS BIGINT) AS x2
  FROM byt, tab
), {_CURVE}, line AS (
  SELECT *, row_number() OVER (ORDER BY h, ((doc_id % 4294967296) * 1103515245) % 4294967296, doc_id) - 1 AS p, count(*) OVER () AS n FROM {_LAST}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p * {SHARDS} // n AS INTEGER) AS shard, p - (n * (p * {SHARDS} // n) + {SHARDS - 1}) // {SHARDS} AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, h AS hilbert_index FROM line
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient.dedupe(_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY sha) AS n FROM d
)
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM g
"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), VOCAB)


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    told = told.unionAll(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    # the table's conversations are chains: each turn answers the one before
    line = told.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    nodes = line.select(F.struct("conv_id", "i").alias("node"), F.when(F.col("i") > 1, F.struct(F.col("conv_id"), (F.col("i") - 1).alias("i"))).alias("parent"), F.length(F.coalesce("text", F.lit(""))).alias("score"))
    chosen = chat.paths(nodes).select(F.col("path.conv_id").alias("conv_id"), "depth", F.col("node.i").alias("i"))
    turns = chosen.join(line, [chosen.conv_id.eqNullSafe(line.conv_id), chosen.i == line.i]).select(chosen.conv_id, "depth", "role", "text")
    done = chat.format_paths(turns, "conv_id", "depth").select("*", chat.read_back(F.col("formatted")).alias("turns"))
    every = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("turns"))
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + 10 + 1
    + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1~\2\3', 'g'))) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""


def reply_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best branches of each conversation taken as a tree in which turn i answers turn i div 2, formatted and read back."""
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    line = told.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    above = F.when(F.col("i") > 1, F.struct(F.col("conv_id"), F.shiftright("i", 1).alias("i")))
    nodes = line.select(F.struct("conv_id", "i").alias("node"), above.alias("parent"), F.length(F.coalesce("text", F.lit(""))).alias("score"))
    chosen = chat.paths(nodes, top=2).select(F.col("path.conv_id").alias("conv_id"), F.col("path.i").alias("leaf"), "rank", "depth", F.col("node.i").alias("i"))
    turns = chosen.join(line, ["conv_id", "i"]).select(F.struct("conv_id", "rank", "leaf").alias("path"), "depth", "i", "role", "text")
    done = chat.format_paths(turns, "path", "depth").select("path", chat.read_back(F.col("formatted")).alias("turns"))
    routes = turns.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "i"))), lambda x: x["i"].cast("string")), ">").alias("route"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("score"))
    every = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    out = done.join(routes, "path")
    return out.select("path.conv_id", F.col("path.rank").cast("long").alias("rank"), F.col("path.leaf").cast("long").alias("leaf"), "route", "score", F.sha2(every, 256).alias("turns_sha256"))


BRANCHES_SQL = r"""
WITH RECURSIVE line AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), path(conv_id, i, route, score, n, told) AS (
  SELECT conv_id, i, CAST(i AS VARCHAR), CAST(length(text) AS BIGINT), 1, role || chr(10) || text || chr(10) FROM line WHERE i = 1
  UNION ALL
  SELECT l.conv_id, l.i, p.route || '>' || l.i, p.score + length(l.text), p.n + 1, p.told || l.role || chr(10) || l.text || chr(10)
  FROM path p JOIN line l ON l.conv_id = p.conv_id AND l.i // 2 = p.i WHERE l.i > 1
), leaf AS (
  SELECT * FROM path p WHERE NOT EXISTS (SELECT 1 FROM line l WHERE l.conv_id = p.conv_id AND l.i // 2 = p.i AND l.i > 1)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score / n DESC, i) AS rank FROM leaf)
SELECT conv_id, rank, i AS leaf, route, score, sha256(told) AS turns_sha256 FROM ranked WHERE rank <= 2
"""


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.c AS component_id
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = s.doc_id
"""

QUALITY = 0.7


def remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def quality_model(spark: SparkSession, sf_dir: str) -> gam.Gam:
    return gam.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), "quality", remainder(4) != 2)


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = gam.score(_table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", F.when(F.col("score") >= QUALITY, 1).otherwise(0).alias("predicted"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = Scratch(spark, "lengths").put(lengths.histogram(_table(spark, sf_dir, "documents"), VOCAB))  # the sums read it twice
    return lengths.suffix_sums(hist)


def op10_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram.score(_table(spark, sf_dir, "documents"), remainder(5) != 1)
    return got.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_weighted_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), clusters=16, rounds=3)


def _lloyd_sql(rounds: int, clusters: int) -> str:
    """Lloyd's rounds as a CTE each: (r, c, d) assigns row r, (c, q) are the centroids."""
    steps = [
        """kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (SELECT sha256('1:' || vec_id) AS h, q FROM kept ORDER BY h LIMIT {clusters}))",
    ]
    gap = "CAST(list_sum(list_transform(list_zip(k.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    for i in range(rounds + 1):
        steps.append(f"g{i} AS (SELECT k.r, c.c, {gap} AS d FROM kept k, c{i} c)")
        steps.append(f"a{i} AS (SELECT r, c, d FROM g{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(k.q) AS x, generate_subscripts(k.q, 1) AS i FROM a{i} a JOIN kept k USING (r)) GROUP BY c, i
  ) GROUP BY c
)""")
            steps.append(f"c{i + 1} AS (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m USING (c))")
    return ",\n".join(steps)


OP11_SQL = f"""
WITH {_lloyd_sql(3, 16)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a3 a JOIN kept USING (r) JOIN c3 c ON c.c = a.c
"""


def op12_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_table(spark, sf_dir, "documents"), k=4, radius=4)


def op13_cobucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, lines = (_table(spark, sf_dir, name) for name in ("sales", "sale_lines"))
    sale = F.coalesce(cobucket.bucket_of(F.col("sale_id"), BUCKETS), F.lit(BUCKETS + 1))
    start = F.when(sale % 4 == 1, sale - 1).otherwise(sale)
    item = F.coalesce(cobucket.bucket_of(F.col("item_id"), BUCKETS, salt=""), F.lit(0))
    return cobucket.pair(sales, lines, "sale_id", ("sales", "sale_lines"), (start, item), BUCKETS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_cascade": op1_url_cascade,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_templates": op4_templates,
    "op5_bpe": op5_bpe,
    "op6_jaccard": op6_jaccard,
    "op7_quality_gam": op7_quality_gam,
    "op8_length_histogram": op8_length_histogram,
    "op9_reply_trees": op9_reply_trees,
    "op10_ngram_trie": op10_ngram_trie,
    "op11_weighted_centroids": op11_weighted_centroids,
    "op12_covering_simhash": op12_covering_simhash,
    "op13_cobucket": op13_cobucket,
    "reply_branches": reply_branches,
}
ORACLES = {
    "op1_url_cascade": OP1_SQL, "op2_hilbert_shards": OP2_SQL, "op3_exact_dedup": OP3_SQL, "op6_jaccard": OP6_SQL,
    "op9_reply_trees": OP9_SQL, "op11_weighted_centroids": OP11_SQL, "reply_branches": BRANCHES_SQL,
}
