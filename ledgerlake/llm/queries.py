"""The registered queries of this subpackage and their DuckDB text, by operator number."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import (
    chat, decontaminate, jaccard, language, licences, mixing, pages, periods, pii, simhash, substrings, token_counts,
    trie)
from ledgerlake.llm.kernels import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PROBE = "\\### Assistant: </turn> ok"

_OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         replace(replace(replace(coalesce(role, ''), '\', '\\'), '</', '<\/'), '<|', '<\|') AS er,
         replace(replace(replace(coalesce(text, ''), '\', '\\'), '</', '<\/'), '<|', '<\|') AS et
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 20) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_register("op7_chat_format", _OP7_SQL)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation (and the control-string probe -7) and digest what is read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    kinds = dict(turns.dtypes)
    probe = probe.select(*[F.col(c).cast(kinds[c]).alias(c) for c in turns.columns])
    back = chat.read_back(chat.format_conversations(turns.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@_register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-centroid language of every document; lang_pred is the nearest centroid's language.

    Rejection is a column of its own (the pipeline drops by it).
    """
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs)
    rows = language.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return rows.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
                       "lang_pred", "score", "rejected")


@_register("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data and those that the skip-chain field adds, in every whole document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.train(docs), keep=["doc_id"])


@_register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole document, and the longest prefix within 512 tokens."""
    import public_tokenizers
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])


_OP8_SQL = """
WITH s AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS c FROM documents GROUP BY source),
w AS (SELECT source, c, CASE WHEN c > 0 THEN pow(CAST(c AS DOUBLE), 0.5) ELSE 0.0 END AS w FROM s),
r AS (
  SELECT source, CASE WHEN c > 0 THEN w / (SELECT sum(w) FROM w) * (SELECT sum(c) FROM w) / c ELSE 1.0 END AS rate
  FROM w),
p AS (SELECT source, rate, greatest(CAST(ceil(rate / 16.0) AS INT), 1) AS m FROM r),
k AS (SELECT source, m, i, exp(i * ln(rate / m) - rate / m - CASE WHEN i < 1 THEN 0.0 ELSE lgamma(i + 1) END) AS pk
      FROM p, range(0, 120) AS g(i)),
f AS (SELECT source, m, i, sum(pk) OVER (PARTITION BY source ORDER BY i) AS cdf FROM k),
h AS (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
u AS (SELECT DISTINCT h.key, h.source, j, CAST(CAST('0x' || substr(md5('mix-1|' || h.key || '|' || j), 1, 13) AS BIGINT)
             AS DOUBLE) / 4503599627370496.0 AS u
      FROM h JOIN p ON h.source IS NOT DISTINCT FROM p.source, range(1, p.m + 1) AS g(j)),
n AS (SELECT u.key, u.source, count(*) AS n FROM u JOIN f ON u.source IS NOT DISTINCT FROM f.source AND f.cdf <= u.u
      GROUP BY u.key, u.source)
SELECT h.doc_id, h.text, h.lang, h.source, h.n_chars, CAST(x AS INT) AS replica,
       substr(md5('mix-1|order|' || h.key || '|' || x), 1, 16) AS shuffle_key
FROM h JOIN n ON h.key = n.key AND h.source IS NOT DISTINCT FROM n.source, range(1, n.n + 1) AS g(x)
"""


@_register("op8_mix_sources", _OP8_SQL)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by its Poisson count, in global random order; target shares by square root of characters."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


_OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, range(1, greatest(len(w) - 10, 0) + 2) AS g(i) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM bw), range(1, len(w) - n + 2) AS g(i)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, range(i, i + n) AS g(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_register("op9_decontamination", _OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of every benchmark item in every whole document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_register("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every whole document, of its edited text and of the next document's, and their likeness.

    Ids divisible by 50 are searched for in all rows within 6 bits.
    """
    return simhash.compare_and_search(_table(spark, sf_dir, "documents"))


_OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
       FROM w, range(1, greatest(len(w) - 3, 0) + 2) AS g(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(root, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.root, e.y FROM r JOIN e ON r.node = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n
"""


@_register("op4_jaccard_join", _OP4_SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of links of Jaccard 0.9 or more over three-word shingles of whole documents."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), k=3, threshold=90)


@_register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte covered by a 50-byte string that also starts in an earlier document is removed."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


@_register("op1_page_text")
def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page: marked articles, else what nearest-URL differencing leaves."""
    return pages.extract(_table(spark, sf_dir, "pages"))


@_register("op11_license_scan")
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, identifier tags and expressions in every whole document."""
    rows = licences.scan_licences(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("findings", lambda f: f["kind"] == "base")
    places = F.transform(base, lambda f: f["word"])
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda f: f["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", "permitted",
        F.array_join(F.transform("expressions", lambda e: e["text"]), "\n").alias("expressions"))


def _with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by crc32, the words from a point on repeat a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, F.filter(
        F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("words"))
    counted = split.withColumn("n", F.size("words"))
    cut = (counted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
           .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    new = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


@_register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every whole document, with repeats planted in every tenth."""
    docs = _with_planted_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = periods.collapse_runs(docs, keep=["doc_id"]).withColumn("best", periods.longest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_OP12_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z:
                          CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS g(i))),
o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations),
cv AS (
  SELECT c, c - c % 100 AS b, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(c AS VARCHAR), i, 1))::BIGINT)),
           lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM o GROUP BY c), crc),
r AS (
  SELECT cv.c, o.i AS d, o.role, o.text FROM cv JOIN o ON o.c = cv.b AND o.i <= cv.h
  UNION ALL
  SELECT cv.c, o.i - cv.h + least(cv.h, coalesce(base.n, 0)), o.role, o.text
  FROM cv JOIN o ON o.c = cv.c AND o.i > cv.h LEFT JOIN cv AS base ON base.c = cv.b),
m AS (
  SELECT c, d, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY c ORDER BY d)) AS k,
         length(text) AS chars FROM r
  UNION ALL SELECT c, 0, '', 0 FROM cv),
e AS (SELECT c, max(d) AS last FROM m GROUP BY c),
n AS (SELECT d, k, min(c) AS rep, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY d, k),
pairs AS (SELECT DISTINCT u.d, u.k, v.d AS vd, v.k AS vk FROM m AS u JOIN m AS v ON u.c = v.c AND v.d >= u.d),
kids AS (SELECT d, k, count(*) AS n_children FROM pairs WHERE vd = d + 1 GROUP BY d, k),
sub AS (
  SELECT p.d, p.k, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (kids.k IS NULL) AS n_leaves
  FROM pairs AS p JOIN n ON n.d = p.vd AND n.k = p.vk LEFT JOIN kids ON kids.d = p.vd AND kids.k = p.vk GROUP BY p.d, p.k),
ends AS (SELECT m.d, m.k, string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) AS ids
         FROM m JOIN e ON e.c = m.c AND e.last = m.d GROUP BY m.d, m.k),
up AS (SELECT v.d, v.k, any_value(n.rep) AS parent FROM m AS v JOIN m AS u ON u.c = v.c AND u.d = v.d - 1
       JOIN n ON n.d = u.d AND n.k = u.k GROUP BY v.d, v.k)
SELECT n.rep AS conv_id, n.d AS depth, up.parent AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN sub USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN ends USING (d, k) LEFT JOIN up USING (d, k)
"""


@_register("op12_prefix_trie", _OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each one rebuilt upon the first turns of its hundred's first."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    h = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 6
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))))
    heads = turns.where("conv_id % 100 = 0").withColumn("nth", nth).where("nth <= 5").withColumnRenamed("conv_id", "head")
    convs = turns.select("conv_id").distinct()
    borrowed = convs.withColumn("head", F.expr("conv_id - conv_id % 100")).join(heads, "head").where(F.col("nth") <= h)
    return trie.prefix_trie(turns, borrowed, skip=h)
