"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op5_covering_simhash")
def op5_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.covering_simhash import simhash_components
    r = simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return r.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cairn.llm.token_counts import count_tokens
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' ') AS w0
  FROM documents),
dw AS (SELECT r, doc_id, list_filter(w0, lambda x: x <> '') AS w FROM d),
b AS (
  SELECT item_id,
         list_filter(string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' '), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT occ.r, occ.n, occ.i, win.item_id FROM occ JOIN win USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, n, i FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@register("op9_winnowing", OP9_SQL)
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.winnowing import benchmark_hits
    r = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, k=5)
    return r.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(~*)(\||/?s>|/?unk>|</?SYS>>|/?INST\])', '\1\2~\3', 'g') AS body,
         regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(~*)(\||/?s>|/?unk>|</?SYS>>|/?INST\])', '\1\2~\3', 'g') AS head
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(head) + 1 + length(body) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@register("op4_reply_trees", OP4_SQL)
def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.common import cut
    from cairn.llm.reply_trees import branches, chains, format_branches, read_back
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    nodes = cut(chains(said.unionByName(extra)))
    back = read_back(format_branches(branches(nodes.select("node", "parent", "score"), top=1), nodes.select("node", "role", "text")))
    roots = nodes.filter("parent IS NULL").select(F.col("node").alias("root"), "conv_id")
    loss = F.array_join("loss_texts", "")
    return back.join(roots, "root").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP2_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op2_lsh_forest", OP2_SQL)
def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.lsh_forest import nearest
    r = nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)
    return r.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@register("op1_mincut_html")
def op1_mincut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.html_mincut import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@register("op7_bigru_langid")
def op7_bigru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.bigru_langid import fit, identify
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    net = fit(docs.filter(fold != 2))
    return (identify(docs.select("doc_id", "text"), net)
            .select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"))


@register("op3_fm_quality")
def op3_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.fm_quality import fit, quality_scores
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = fit(docs.select("doc_id", "text", "n_chars"), labels.filter(fold != 0))
    return (quality_scores(docs.select("doc_id", "text", "n_chars"), model)
            .select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")))


@register("op6_fuzzy_lines")
def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.fuzzy_lines import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_dropped")


@register("op10_ipf_mixing")
def op10_ipf_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.ipf_mixing import calibrated_sample
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return calibrated_sample(docs).select("doc_id", "source", "lang", "p_keep")


def planted_period(doc_id, words: list) -> list:
    """The contract's rule: in one document of ten the words from a on repeat their first p."""
    from zlib import crc32
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


@register("op11_period_runs")
def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.period_runs import periodic_runs
    r = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_period)
    longest = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], (b["length"] - a["length"]).cast("int"))
                           .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                           .otherwise((a["period"] - b["period"]).cast("int")))
    top = F.try_element_at(longest, F.lit(1))
    lines = F.array_join(F.transform("runs", lambda x: F.format_string("%d,%d,%d\n", x["start"], x["length"], x["period"])), "")
    return r.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.coalesce(F.sha2("collapsed", 256), "words_sha256").alias("collapsed_sha256"))


_TERMS = (r"list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '')")
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS wt FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM d, total WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
s AS (SELECT item_id, r, doc_id, CAST(sum(c * wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@register("op12_bag_search", OP12_SQL)
def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.bag_search import ranked
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10).select("item_id", "rank", "doc_id", "score")


OP13_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""


@register("op13_block_naming", OP13_SQL)
def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.llm.block_naming import exact_groups
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
