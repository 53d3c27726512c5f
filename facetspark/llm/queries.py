"""The operators bound to the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetspark.llm import alignment, bpe, cosine, hosttext, langid, mixing, packing, pii, preference, quality, search, simhash, tokenfiles
from facetspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; FACETSPARK_TOKENIZERS names another folder."""
    folder = os.environ.get("FACETSPARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def id_crc(c: str = "doc_id") -> Column:
    return F.crc32(F.col(c).cast("string").cast("binary"))


@register
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


@register
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixing.taken(plan).select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__total").alias("source_size"),
        F.col("__target").alias("target"), "taken")


@register
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc() % 3 == 1, F.lit(False))
    # the remainder picks the learning rows, so another hash picks the sample among them; of id and
    # text, as ids may be null or repeated
    pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**32))
    model = langid.train(docs.where(~held_out), "text", "lang", pick)
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


@register
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    def count(kind: int) -> Column:  # F.filter gives a second parameter the position in the array
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
                        pii.spelled(F.col("found")).alias("spans"))


@register
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words", "base_failed", "kept")


ORACLE_SQL["op5_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
c AS (SELECT doc_id, ws, len(ws) AS n,
        list_sum(list_transform(ws, lambda x: length(x))) AS chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS dup,
        greatest(50, n // 5) + 1 AS long_
      FROM w),
p AS (SELECT doc_id, n, long_, ws, unnest(range(1, n + 1)) AS i FROM c),
k8 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i+7], ' ')) AS times
       FROM p WHERE i + 7 <= n),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS j FROM k8 WHERE times > 1),
r AS (SELECT doc_id, count(*) AS repeat_ FROM hit GROUP BY doc_id),
far AS (SELECT DISTINCT doc_id FROM (
          SELECT doc_id, count(*) AS times FROM p WHERE i + long_ - 1 <= n
          GROUP BY doc_id, md5(array_to_string(ws[i:i+long_-1], ' '))) WHERE times > 1),
f AS (SELECT c.doc_id, n, coalesce(chars, 0) AS chars, symbols, dup, coalesce(repeat_, 0) AS repeat_,
        far.doc_id IS NOT NULL AS far
      FROM c LEFT JOIN r ON r.doc_id = c.doc_id LEFT JOIN far ON far.doc_id = c.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(chars AS BIGINT) AS word_chars, CAST(symbols AS BIGINT) AS n_symbols,
  CAST(dup AS BIGINT) AS n_dup_lines, CAST(repeat_ AS BIGINT) AS n_repeat_words,
  n < 20 OR 100 * repeat_ > 30 * n AS base_failed,
  NOT (n < 20 OR 100 * repeat_ > 30 * n) AND NOT far AS kept
FROM f
"""


@register
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine.embedding_components(table(spark, sf_dir, "embeddings"), threshold=0.9)


ORACLE_SQL["op6_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v
      WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b
      ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) AND list_dot_product(a.u, b.u) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c ON c.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id
"""


@register
def op7_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    docs = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    return bpe.decode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register
def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.reply_pairs(preference.conversations(table(spark, sf_dir, "conversations")))
    done = preference.format_pairs(pairs)
    spelled = lambda m: F.array_join(F.transform(m, lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return done.select("conv_id", "n_prompt_turns", *[
        F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("prompt", "chosen_text", "rejected_text")],
        spelled("chosen_mask").alias("chosen_mask"), spelled("rejected_mask").alias("rejected_mask"))


ORACLE_SQL["op8_preference_format"] = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, i, text, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM t WHERE role = 'assistant'),
p AS (SELECT conv_id, max(i) FILTER (back = 1) AS last, max(text) FILTER (back = 1) AS good,
        coalesce(max(text) FILTER (back = 2), '') AS bad FROM a GROUP BY conv_id),
h AS (SELECT t.conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i) AS prompt
      FROM t JOIN p ON p.conv_id = t.conv_id AND (t.i < p.last OR t.i = p.last AND good = bad) GROUP BY t.conv_id),
r AS (SELECT conv_id, last, good = bad AS same, good, bad,
        '<|im_start|>assistant' || chr(10) || good || '<|im_end|>' || chr(10) AS c,
        '<|im_start|>assistant' || chr(10) || bad || '<|im_end|>' || chr(10) AS j FROM p)
SELECT r.conv_id, CAST(CASE WHEN same THEN last ELSE last - 1 END AS BIGINT) AS n_prompt_turns,
  sha256(coalesce(prompt, '')) AS prompt_sha256,
  sha256(CASE WHEN same THEN '' ELSE c END) AS chosen_text_sha256,
  sha256(CASE WHEN same THEN '' ELSE j END) AS rejected_text_sha256,
  CASE WHEN same THEN '' ELSE '22:' || (22 + length(good) + 11) END AS chosen_mask,
  CASE WHEN same THEN '' ELSE '22:' || (22 + length(bad) + 11) END AS rejected_mask
FROM r LEFT JOIN h ON h.conv_id = r.conv_id
"""


@register
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@register
def op10_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosttext.main_text(table(spark, sf_dir, "pages"))


@register
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


ORACLE_SQL["op11_ranked_search"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
c AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(len(ts)) AS BIGINT) AS L FROM d WHERE len(ts) > 0),
p AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
f AS (SELECT doc_id, n, t, count(*) AS tf FROM p GROUP BY doc_id, n, t),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY item_id, t),
w AS (SELECT f.t, CAST(floor(1000 * ln((2 * any_value(c.N) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, c WHERE f.t IN (SELECT t FROM q) GROUP BY f.t),
s AS (SELECT q.item_id, f.doc_id, CAST(sum(q.times * w.w * ((1000000000 * f.tf) //
          (1000 * f.tf + 12 * (100 - 25 + ((25 * f.n * c.N) // c.L))))) AS BIGINT) AS score
      FROM q JOIN f ON f.t = q.t JOIN w ON w.t = q.t, c GROUP BY q.item_id, f.doc_id),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""


@register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), keep_groups=False,
    ).withColumnRenamed("groups", "groups_sha256")


@register
def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), window=4096, end_id=2)
    return pieces.select("doc_id", "start", (F.length("data") / 4).cast("long").alias("length"),
                         F.crc32("data").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
