"""Registered queries: each operator bound to the provided test tables.

``QUERIES[name](spark, sf_dir)`` builds a DataFrame from the Parquet
tables in ``sf_dir``; ``ORACLE_SQL[name]`` is the same question in plain
SQL over views of the same tables, used to check results with a second
engine. Column names and types agree between the two. Aggregated doubles
are rounded (4 digits, correlations 6) because two engines sum floats in
different orders; row-level arithmetic is exact and left unrounded.

Every query reads whole tables; none samples, caps or filters rows to keep
the check cheap. Queries that write (round trips) use a fresh folder under
the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetspark.functions import presets
from facetspark.operators import clean, derive, keys, profile, segments
from facetspark.plans import studies
from facetspark.plans.sql import bucket_average, register, run_sql
from facetspark.session import scratch_dir
from facetspark.sinks import partition_sizes, preview, write_csv, write_parquet
from facetspark.sources import read_csv, read_parquet, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = " ".join(sql.split())
        return fn
    return wrap


def r4(c):
    return F.round(c, 4)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# ---------------------------------------------------------------- shared bits

def _scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with an integer 2..100 score (quantity x 2)."""
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_extendedprice", (F.col("l_quantity") * 2).cast("int").alias("score"))


def _sql_case(col: str, bounds, labels) -> str:
    whens = " ".join(f"WHEN {col} < {b} THEN '{lab}'" for b, lab in zip(bounds, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


BUCKET4_SQL = _sql_case("score", presets.POPULARITY_BOUNDS_4, presets.POPULARITY_LABELS_4)
BUCKET10_SQL = _sql_case("score", presets.POPULARITY_BOUNDS_10, presets.POPULARITY_LABELS_10)
SCORED_SQL = "SELECT l_orderkey, l_extendedprice, CAST(l_quantity * 2 AS INTEGER) AS score FROM lineitem"

MIN_PARTS_PER_BRAND = 80

LINE_MEASURES = {
    "avg_quantity": "l_quantity",
    "avg_price": "l_extendedprice",
    "avg_discount": "l_discount",
    "avg_tax": "l_tax",
}


def _line_segments() -> dict[str, object]:
    r = F.col("l_returnflag") == "R"
    o = F.col("l_linestatus") == "O"
    f = F.col("l_linestatus") == "F"
    return {
        "returned": r,
        "returned open cheap": r & o & (F.col("l_discount") < 0.05),
        "finished low tax": f & (F.col("l_tax") < 0.04),
        "finished": f,
    }


SEGMENT_SQL_PARTS = [
    ("returned", "l_returnflag = 'R'"),
    ("returned open cheap", "l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount < 0.05"),
    ("finished low tax", "l_linestatus = 'F' AND l_tax < 0.04"),
    ("finished", "l_linestatus = 'F'"),
]


def _segment_sql(name: str, cond: str) -> str:
    return (f"SELECT '{name}' AS tagged_as, round(avg(l_quantity), 4) AS avg_quantity, "
            f"round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 4) AS avg_discount, "
            f"round(avg(l_tax), 4) AS avg_tax, count(*) AS n_rows FROM lineitem WHERE {cond} HAVING count(*) > 0")


SEGMENTS_SQL = " UNION ALL ".join(_segment_sql(n, c) for n, c in SEGMENT_SQL_PARTS)
SUPPORTED_BRANDS_SQL = f"SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) >= {MIN_PARTS_PER_BRAND}"


# ---------------------------------------------------------------- cleaning

@query("project_complete", """
    SELECT event_id, event_type, value FROM (
      SELECT event_id, NULLIF(event_type, 'error') AS event_type, value FROM events) t
    WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""")
def q_project_complete(spark, sf):
    ev = read_table(spark, sf, "events")
    return clean.project_complete(
        ev, [F.col("event_id"), F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), F.col("value")])


@query("not_null_filter", """
    SELECT event_id, user_id, event_type FROM (
      SELECT event_id, user_id, NULLIF(event_type, 'error') AS event_type FROM events) t
    WHERE event_type IS NOT NULL""")
def q_not_null_filter(spark, sf):
    ev = read_table(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return clean.drop_null(ev, "event_type")


@query("lower_category", """
    SELECT lower(c_mktsegment) AS c_mktsegment, count(*) AS count FROM customer GROUP BY 1""")
def q_lower_category(spark, sf):
    return profile.counts(clean.lower_case(read_table(spark, sf, "customer"), "c_mktsegment"), "c_mktsegment")


@query("rename_cast_drop", """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS DOUBLE) AS customer_id, o_orderstatus,
           o_totalprice, o_orderpriority FROM orders""")
def q_rename_cast_drop(spark, sf):
    od = clean.rename(read_table(spark, sf, "orders"), {"o_orderkey": "order_id", "o_custkey": "customer_id"})
    return clean.typed(od, {"customer_id": "double"}).drop("o_orderdate")


@query("sql_expr_filter", """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
           l_extendedprice / l_quantity AS unit_price
    FROM lineitem WHERE l_quantity >= 20""")
def q_sql_expr_filter(spark, sf):
    li = read_table(spark, sf, "lineitem").where("l_quantity >= 20")
    return li.select("l_orderkey", "l_linenumber",
                     F.expr("l_extendedprice * (1 - l_discount)").alias("net_price"),
                     F.expr("l_extendedprice / l_quantity").alias("unit_price"))


# ---------------------------------------------------------------- derived columns

@query("bucket4_mean", f"""
    SELECT {BUCKET4_SQL} AS score_bucket, round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM ({SCORED_SQL}) s GROUP BY 1""")
def q_bucket4_mean(spark, sf):
    rows = derive.with_bucket(_scored_lines(spark, sf), "score", presets.POPULARITY_BOUNDS_4,
                              presets.POPULARITY_LABELS_4, "score_bucket")
    out = profile.mean_profile(rows, "score_bucket", {"avg_price": "l_extendedprice"}, count_name="n_rows", order=True)
    return _rounded(out, 4, "avg_price")


@query("bucket10_mean", f"""
    SELECT {BUCKET10_SQL} AS score_bucket, round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM ({SCORED_SQL}) s GROUP BY 1""")
def q_bucket10_mean(spark, sf):
    rows = derive.with_bucket(_scored_lines(spark, sf), "score", presets.POPULARITY_BOUNDS_10,
                              presets.POPULARITY_LABELS_10, "score_bucket")
    out = profile.mean_profile(rows, "score_bucket", {"avg_price": "l_extendedprice"}, count_name="n_rows", order=True)
    return _rounded(out, 4, "avg_price")


@query("bucket_sql", f"""
    SELECT {BUCKET4_SQL} AS score_bucket, round(avg(l_extendedprice), 4) AS avg_price
    FROM ({SCORED_SQL}) s GROUP BY 1""")
def q_bucket_sql(spark, sf):
    rows = derive.with_popularity_bucket(_scored_lines(spark, sf), source="score", target="score_bucket")
    register({"scored_lines": rows})
    return run_sql(spark, "SELECT score_bucket, ROUND(AVG(l_extendedprice), 4) AS avg_price "
                          "FROM scored_lines GROUP BY score_bucket ORDER BY score_bucket")


@query("bucket_partitioned_sql", f"""
    SELECT {BUCKET10_SQL} AS score_bucket, round(avg(l_extendedprice), 4) AS avg_l_extendedprice
    FROM ({SCORED_SQL}) s GROUP BY 1""")
def q_bucket_partitioned_sql(spark, sf):
    """Bucket, write partitioned by bucket, read back, average per bucket in SQL."""
    rows = derive.with_popularity_bucket(_scored_lines(spark, sf), source="score", fine=True, target="score_bucket")
    path = scratch_dir(spark, "score_buckets")
    write_parquet(rows, path, partition_by=["score_bucket"])
    back = read_parquet(spark, path, schema=rows.schema)
    return _rounded(bucket_average(back, "score_bucket", "l_extendedprice"), 4, "avg_l_extendedprice")


@query("flag_map", """
    SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
           CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open, count(*) AS count
    FROM lineitem GROUP BY 1, 2""")
def q_flag_map(spark, sf):
    li = read_table(spark, sf, "lineitem")
    r = derive.with_flags(li, {"l_returnflag": "is_returned"}, truthy="R", drop_sources=True)
    r = derive.with_flags(r, {"l_linestatus": "is_open"}, truthy="O", drop_sources=True)
    return profile.counts(r, ["is_returned", "is_open"])


@query("decade_profile", """
    SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) AS decade,
           round(avg(o_totalprice), 4) AS avg_totalprice, round(avg(o_totalprice * 100), 4) AS avg_totalprice_x100,
           count(*) AS n_orders
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def q_decade_profile(spark, sf):
    res = studies.decade_trends(read_table(spark, sf, "orders"), date="o_orderdate", measures={
        "avg_totalprice": "o_totalprice", "avg_totalprice_x100": F.col("o_totalprice") * 100}, count_name="n_orders")
    return _rounded(res["profile"], 4, "avg_totalprice", "avg_totalprice_x100")


DATE_TEXT_SQL = """
    SELECT o_totalprice, CASE o_orderstatus WHEN 'O' THEN 'n/a' WHEN 'P' THEN '29th April 2013'
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date FROM orders"""


@query("decade_bad_dates", f"""
    SELECT CAST(floor(year(try_cast(release_date AS DATE)) / 10) * 10 AS BIGINT) AS decade,
           round(avg(o_totalprice), 4) AS avg_totalprice, count(*) AS n_orders
    FROM ({DATE_TEXT_SQL}) t WHERE try_cast(release_date AS DATE) IS NOT NULL GROUP BY 1""")
def q_decade_bad_dates(spark, sf):
    od = read_table(spark, sf, "orders")
    # release dates as an export would hold them: ISO text, placeholders, prose
    text = F.when(F.col("o_orderstatus") == "O", F.lit("n/a")) \
        .when(F.col("o_orderstatus") == "P", F.lit("29th April 2013")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = od.select("o_totalprice", text.alias("release_date"))
    res = studies.decade_trends(raw, date="release_date", measures={"avg_totalprice": "o_totalprice"},
                                count_name="n_orders")
    return _rounded(res["profile"], 4, "avg_totalprice")


@query("decade_partitioned", """
    SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) AS decade,
           round(avg(o_totalprice), 4) AS avg_totalprice, count(*) AS n_orders
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def q_decade_partitioned(spark, sf):
    """Decade added, written partitioned by decade, read back with its schema."""
    rows = derive.with_decade(read_table(spark, sf, "orders").select("o_totalprice", "o_orderdate"), "o_orderdate")
    path = scratch_dir(spark, "decades")
    write_parquet(rows, path, partition_by=["decade"])
    back = read_parquet(spark, path, schema=rows.schema)
    out = profile.decade_profile(back, "decade", {"avg_totalprice": "o_totalprice"}, count_name="n_orders")
    return _rounded(out, 4, "avg_totalprice")


# ---------------------------------------------------------------- aggregations

@query("group_stats_having", f"""
    SELECT p_brand, round(avg(p_retailprice), 4) AS avg_price, min(p_retailprice) AS min_price,
           max(p_retailprice) AS max_price, round(stddev_samp(p_retailprice), 4) AS stddev_price, count(*) AS n
    FROM part GROUP BY p_brand HAVING count(*) >= {MIN_PARTS_PER_BRAND}""")
def q_group_stats_having(spark, sf):
    out = profile.group_stats(read_table(spark, sf, "part"), "p_brand", "p_retailprice",
                              min_count=MIN_PARTS_PER_BRAND, label="price")
    return _rounded(out, 4, "avg_price", "stddev_price")


@query("mean_profile", """
    SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, round(avg(l_extendedprice), 4) AS avg_price,
           round(avg(l_discount), 4) AS avg_discount, round(avg(l_tax), 4) AS avg_tax
    FROM lineitem GROUP BY 1""")
def q_mean_profile(spark, sf):
    out = profile.mean_profile(read_table(spark, sf, "lineitem"), "l_returnflag", LINE_MEASURES, order=True)
    return _rounded(out, 4, *LINE_MEASURES)


@query("count_one_key", "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY 1")
def q_count_one_key(spark, sf):
    return profile.counts(read_table(spark, sf, "orders"), "o_orderstatus")


@query("count_two_keys", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY 1, 2""")
def q_count_two_keys(spark, sf):
    return profile.counts(read_table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("share_of_group", """
    SELECT p_brand, p_type, count, round(CAST(count AS DOUBLE) / total * 100, 2) AS percentage FROM (
      SELECT p_brand, p_type, count(*) AS count, sum(count(*)) OVER (PARTITION BY p_brand) AS total
      FROM part GROUP BY 1, 2) t""")
def q_share_of_group(spark, sf):
    return profile.share_of_group(read_table(spark, sf, "part"), "p_brand", "p_type")


@query("flag_share", """
    SELECT is_finished, o_orderpriority, count, round(CAST(count AS DOUBLE) / total * 100, 2) AS percentage FROM (
      SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finished, o_orderpriority, count(*) AS count,
             sum(count(*)) OVER (PARTITION BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS total
      FROM orders GROUP BY 1, 2) t""")
def q_flag_share(spark, sf):
    """Share of each priority within finished / unfinished orders (flag x category)."""
    return _order_flags(spark, sf)["share_o_orderpriority"]


def _order_flags(spark, sf):
    """orders as a flag table: is_finished (status F) with priority as the category."""
    table = studies.flag_table(read_table(spark, sf, "orders"), source_flag="o_orderstatus", flag="is_finished",
                               measures=("o_totalprice",), categories=("o_orderpriority",), lower=(), truthy="F")
    return studies.flag_profile(table, "is_finished", {"avg_totalprice": "o_totalprice"},
                                share_of=("o_orderpriority",), count_of=(), store=False)


@query("flag_category_counts", """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finished, o_orderpriority, count(*) AS count
    FROM orders GROUP BY 1, 2""")
def q_flag_category_counts(spark, sf):
    """Rows per (flag, category) rolled up from the flag summary."""
    return _order_flags(spark, sf)["counts_o_orderpriority"]


@query("flag_category_totals", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def q_flag_category_totals(spark, sf):
    """Rows per category over both flag values, rolled up from the same summary."""
    return _order_flags(spark, sf)["totals_o_orderpriority"]


@query("flag_mean_profile", """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finished,
           round(avg(o_totalprice), 4) AS avg_totalprice FROM orders GROUP BY 1""")
def q_flag_mean_profile(spark, sf):
    table = studies.flag_table(read_table(spark, sf, "orders"), source_flag="o_orderstatus", flag="is_finished",
                               measures=("o_totalprice",), categories=("o_orderpriority",), lower=(), truthy="F")
    res = studies.flag_profile(table, "is_finished", {"avg_totalprice": "o_totalprice"},
                               share_of=(), count_of=())
    return _rounded(res["profile"], 4, "avg_totalprice")


@query("correlations", """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr_quantity_price,
           round(corr(l_discount, l_tax), 6) AS corr_discount_tax FROM lineitem""")
def q_correlations(spark, sf):
    out = profile.correlations(read_table(spark, sf, "lineitem"), {
        "corr_quantity_price": ("l_quantity", "l_extendedprice"),
        "corr_discount_tax": ("l_discount", "l_tax"),
    })
    return _rounded(out, 6, "corr_quantity_price", "corr_discount_tax")


@query("score_correlations", """
    SELECT round(corr(CAST(l_quantity * 2 AS INTEGER), l_extendedprice), 6) AS corr_score_l_extendedprice,
           round(corr(l_discount, l_extendedprice), 6) AS corr_l_discount_l_extendedprice FROM lineitem""")
def q_score_correlations(spark, sf):
    li = read_table(spark, sf, "lineitem").withColumn("score", (F.col("l_quantity") * 2).cast("int"))
    res = studies.score_buckets(li, score="score", measure="l_extendedprice", other="l_discount", carry=())
    return _rounded(res["correlations"], 6, *res["correlations"].columns)


@query("pivot_counts", """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P
    FROM orders GROUP BY 1""")
def q_pivot_counts(spark, sf):
    return profile.pivot_counts(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("pivot_counts_found", """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P
    FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT' GROUP BY 1""")
def q_pivot_counts_found(spark, sf):
    """The pivoted values found in the data; some cells have no row."""
    od = read_table(spark, sf, "orders").where("o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'")
    return profile.pivot_counts(od, "o_orderpriority", "o_orderstatus")


FLAG_SOME_SQL = "SELECT NULLIF(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice FROM orders"


@query("flag_profile_nulls", f"""
    SELECT status, o_orderpriority, count, round(CAST(count AS DOUBLE) / total * 100, 2) AS percentage FROM (
      SELECT status, o_orderpriority, count(*) AS count, sum(count(*)) OVER (PARTITION BY status) AS total
      FROM ({FLAG_SOME_SQL}) f WHERE status IS NOT NULL GROUP BY 1, 2) t""")
def q_flag_profile_nulls(spark, sf):
    """Rows without a flag are left out; a column both shared and counted, in another case."""
    table = read_table(spark, sf, "orders").select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_orderpriority", "o_totalprice")
    res = studies.flag_profile(table, "status", {"avg_totalprice": "o_totalprice"},
                               share_of=("o_orderpriority",), count_of=("O_ORDERPRIORITY",), store=False)
    return res["share_o_orderpriority"]


@query("recased_columns", f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax,
           {_sql_case("l_quantity", presets.POPULARITY_BOUNDS_4, presets.POPULARITY_LABELS_4)} AS score_bucket
    FROM lineitem""")
def q_recased_columns(spark, sf):
    """A table whose column names are in another case than the study's."""
    li = read_table(spark, sf, "lineitem")
    li = li.toDF(*[c.upper() for c in li.columns])
    return studies.score_buckets(li, "l_quantity", "l_extendedprice", "l_tax", carry=("l_orderkey", "l_linenumber"),
                                 bucket_column="score_bucket")["coarse_rows"]


# ---------------------------------------------------------------- keys

@query("min_support_rows", f"SELECT * FROM part WHERE p_brand IN ({SUPPORTED_BRANDS_SQL})")
def q_min_support_rows(spark, sf):
    return keys.min_support(read_table(spark, sf, "part"), "p_brand", MIN_PARTS_PER_BRAND)


@query("distinct_keys", "SELECT DISTINCT p_brand FROM part")
def q_distinct_keys(spark, sf):
    return keys.distinct_keys(read_table(spark, sf, "part"), "p_brand")


@query("dense_index", f"""
    SELECT CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_index,
           CAST(p_retailprice AS DOUBLE) AS p_retailprice
    FROM part WHERE p_brand IN ({SUPPORTED_BRANDS_SQL})""")
def q_dense_index(spark, sf):
    return studies.category_index(read_table(spark, sf, "part"), "p_brand", "p_retailprice",
                                  min_count=MIN_PARTS_PER_BRAND)


@query("category_stats", f"""
    SELECT p_type, round(avg(p_retailprice), 4) AS avg_price, min(p_retailprice) AS min_price,
           max(p_retailprice) AS max_price, round(stddev_samp(p_retailprice), 4) AS stddev_price,
           count(*) AS song_count
    FROM part GROUP BY p_type HAVING count(*) >= {presets.MIN_SONGS_PER_EMOTION}""")
def q_category_stats(spark, sf):
    res = studies.category_measure(read_table(spark, sf, "part"), "p_type", "p_retailprice", label="price")
    return _rounded(res["stats"], 4, "avg_price", "stddev_price")


@query("row_id", """
    SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id, * FROM orders""")
def q_row_id(spark, sf):
    return keys.row_id(read_table(spark, sf, "orders"), order_by=["o_orderkey"])


@query("row_id_file_order", """
    SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS id, * FROM events""")
def q_row_id_file_order(spark, sf):
    """Ids in the order rows are stored, no sort (the original numbered its
    export this way). The events file is stored by event_id, which is how the
    oracle can name that order."""
    return keys.row_id(read_table(spark, sf, "events"), spread="auto")


UNEQUAL_FILES_SQL = "CASE WHEN event_id % 100 = 0 THEN 0 WHEN event_id % 10 = 0 THEN 1 ELSE 2 END"


@query("row_id_many_files", f"""
    SELECT folder, CAST(sum(n) OVER (ORDER BY folder) - n + 1 AS BIGINT) AS first_id,
           CAST(sum(n) OVER (ORDER BY folder) AS BIGINT) AS last_id, n AS n_ids
    FROM (SELECT {UNEQUAL_FILES_SQL} AS folder, count(*) AS n FROM events GROUP BY 1) t""")
def q_row_id_many_files(spark, sf):
    """Ids follow the files' paths although Spark packs the largest files first."""
    rows = read_table(spark, sf, "events").withColumn("folder", F.expr(UNEQUAL_FILES_SQL))
    path = scratch_dir(spark, "unequal_files")
    write_parquet(rows, path, partition_by=["folder"])
    ids = keys.row_id(read_parquet(spark, path, schema=rows.schema), spread="auto")
    return ids.groupBy("folder").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                                     F.countDistinct("id").alias("n_ids"))


# ---------------------------------------------------------------- segments

@query("segment_single", """
    SELECT 'returned' AS tagged_as, round(avg(l_quantity), 4) AS avg_quantity,
           round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM lineitem WHERE l_returnflag = 'R'""")
def q_segment_single(spark, sf):
    out = segments.labelled_profile(read_table(spark, sf, "lineitem"), F.col("l_returnflag") == "R", "returned",
                                    {"avg_quantity": "l_quantity", "avg_price": "l_extendedprice"}, count_name="n_rows")
    return _rounded(out, 4, "avg_quantity", "avg_price")


@query("segment_all", """
    SELECT 'returned open' AS tagged_as, round(avg(l_quantity), 4) AS avg_quantity,
           round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' HAVING count(*) > 0""")
def q_segment_all(spark, sf):
    cond = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    out = segments.labelled_profile(read_table(spark, sf, "lineitem"), cond, "returned open",
                                    {"avg_quantity": "l_quantity", "avg_price": "l_extendedprice"}, count_name="n_rows")
    return _rounded(out, 4, "avg_quantity", "avg_price")


@query("segment_comparison", SEGMENTS_SQL)
def q_segment_comparison(spark, sf):
    out = segments.segment_profile(read_table(spark, sf, "lineitem"), _line_segments(), LINE_MEASURES,
                                   count_name="n_rows")
    return _rounded(out, 4, *LINE_MEASURES)


WIDE_MEASURES_SQL = {
    "avg_quantity": "l_quantity",
    "avg_price": "l_extendedprice",
    "avg_discount": "l_discount",
    "avg_tax": "l_tax",
    "avg_net": "l_extendedprice * (1 - l_discount)",
    "avg_charge": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
    "avg_unit_price": "l_extendedprice / l_quantity",
    "avg_squared_quantity": "l_quantity * l_quantity",
    "avg_line": "l_linenumber",
}
MANY_SEGMENTS_SQL = {
    **dict(SEGMENT_SQL_PARTS),
    "small": "l_quantity < 10",
    "large": "l_quantity >= 40",
    "large returned": "l_quantity >= 40 AND l_returnflag = 'R'",
    "first lines": "l_linenumber = 1",
}


@query("segment_many", " UNION ALL ".join(
    f"SELECT '{name}' AS tagged_as, " + ", ".join(f"round(avg({e}), 4) AS {a}" for a, e in WIDE_MEASURES_SQL.items())
    + f", count(*) AS n_rows FROM lineitem WHERE {cond} HAVING count(*) > 0" for name, cond in MANY_SEGMENTS_SQL.items()))
def q_segment_many(spark, sf):
    """Eight overlapping segments of nine measures, from sums per set of segments."""
    out = segments.segment_profile(
        read_table(spark, sf, "lineitem"), {name: F.expr(cond) for name, cond in MANY_SEGMENTS_SQL.items()},
        {a: F.expr(e) for a, e in WIDE_MEASURES_SQL.items()}, count_name="n_rows")
    return _rounded(out, 4, *WIDE_MEASURES_SQL)


@query("segment_union", SEGMENTS_SQL)
def q_segment_union(spark, sf):
    li = read_table(spark, sf, "lineitem")
    parts = [segments.labelled_profile(li, cond, name, LINE_MEASURES, count_name="n_rows")
             for name, cond in _line_segments().items()]
    return _rounded(segments.union_profiles(parts), 4, *LINE_MEASURES)


@query("segment_count", """
    SELECT count(*) AS n_rows FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'""")
def q_segment_count(spark, sf):
    cond = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return segments.segment_size(read_table(spark, sf, "lineitem"), cond)


@query("tag_comparison", """
    SELECT 'urgent' AS tagged_as, round(avg(o_totalprice), 4) AS avg_totalprice, count(*) AS n_orders
      FROM orders WHERE o_orderpriority = '1-URGENT' HAVING count(*) > 0
    UNION ALL
    SELECT 'urgent finished', round(avg(o_totalprice), 4), count(*)
      FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' HAVING count(*) > 0
    UNION ALL
    SELECT 'finished', round(avg(o_totalprice), 4), count(*)
      FROM orders WHERE o_orderstatus = 'F' HAVING count(*) > 0""")
def q_tag_comparison(spark, sf):
    """Tag table (0/1 flags, sources dropped) and overlapping tag segments."""
    od = read_table(spark, sf, "orders").select(
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent_src"),
        (F.col("o_orderstatus") == "F").cast("int").alias("finished_src"),
        "o_totalprice")
    table = studies.tag_table(od, {"urgent_src": "is_urgent", "finished_src": "is_finished"},
                              measures=("o_totalprice",))
    return _rounded(studies.tag_comparison(
        table, {"urgent": ("is_urgent",), "urgent finished": ("is_urgent", "is_finished"),
                "finished": ("is_finished",)},
        {"avg_totalprice": "o_totalprice"}, count_name="n_orders"), 4, "avg_totalprice")


# ---------------------------------------------------------------- sinks and sources

@query("preview_topk", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def q_preview_topk(spark, sf):
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(od, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("csv_roundtrip", "SELECT * FROM nation")
def q_csv_roundtrip(spark, sf):
    nation = read_table(spark, sf, "nation")
    path = scratch_dir(spark, "nation_csv")
    write_csv(nation, path)
    return read_csv(spark, path, schema=nation.schema)


@query("csv_text_roundtrip", "SELECT * FROM documents")
def q_csv_text_roundtrip(spark, sf):
    """Whole documents (multi-line prose with quotes and commas) written as CSV
    and read back with the export's options: every text comes back unchanged."""
    docs = read_table(spark, sf, "documents")
    path = scratch_dir(spark, "documents_csv")
    write_csv(docs, path)
    return read_csv(spark, path, schema=docs.schema, empty_as_null=False)


SONG_TEXT_SQL = """
    SELECT 'order ' || o_orderkey || ',' || chr(10) || '"live"' AS title, (o_custkey % 100) || '.5' AS score,
           '-' || (o_orderkey % 30) || '.25 dB' AS loudness,
           CASE o_orderstatus WHEN 'P' THEN '120 dB' ELSE CAST(o_orderkey % 200 AS VARCHAR) END AS tempo,
           CASE o_orderstatus WHEN 'F' THEN '1.0' WHEN 'O' THEN '0' ELSE 'yes' END AS flag FROM orders"""


@query("csv_typed_ingest", f"""
    SELECT title, TRY_CAST(score AS DOUBLE) AS score, TRY_CAST(replace(loudness, ' dB', '') AS DOUBLE) AS loudness,
           TRY_CAST(tempo AS DOUBLE) AS tempo, TRY_CAST(flag AS DOUBLE) AS flag FROM ({SONG_TEXT_SQL}) t""")
def q_csv_typed_ingest(spark, sf):
    """Numbers as an export holds them (decimals, 1.0 flags, a unit suffix, junk)
    in multi-line CSV, through the song reader; no value that is a number is lost."""
    return studies.read_songs(spark, _song_export(spark, sf)).toDF("title", "score", "loudness", "tempo", "flag")


def _song_export(spark, sf) -> str:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    raw = read_table(spark, sf, "orders").select(
        F.concat(F.lit("order "), key, F.lit(',\n"live"')).alias("title"),
        F.concat(F.col("o_custkey") % 100, F.lit(".5")).alias("Popularity"),
        F.concat(F.lit("-"), key % 30, F.lit(".25 dB")).alias(presets.LOUDNESS),
        F.when(status == "P", "120 dB").otherwise((key % 200).cast("string")).alias("Tempo"),
        F.when(status == "F", "1.0").when(status == "O", "0").otherwise("yes").alias("Good for Work/Study"))
    path = scratch_dir(spark, "songs_csv")
    write_csv(raw, path)
    return path


def _mixed_export(spark, sf) -> str:
    """Orders as a multi-line CSV export with values of many kinds: whole
    numbers, decimals, days, words, numbers with words among them, and text."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    raw = read_table(spark, sf, "orders").select(
        key.alias("whole"), (F.col("o_custkey") % 100 + F.lit(0.25)).alias("decimal"),
        F.concat(F.lit(2000) + key % 20, F.lit("-0"), F.lit(1) + key % 9, F.lit("-1"), key % 9).alias("day"),
        F.when(status == "F", "true").otherwise("false").alias("yes_no"),
        F.when(status == "P", "n/a").otherwise((key % 50).cast("string")).alias("mixed"),
        F.when(key % 3 > 0, key % 7).alias("gaps"),
        F.concat(F.lit('said "'), key, F.lit('",\nthen left')).alias("words"))
    path = scratch_dir(spark, "mixed_csv")
    write_csv(raw, path)
    return path


@query("csv_inferred_types", r"""
    SELECT CAST(o_orderkey AS INTEGER) AS whole, CAST(o_custkey % 100 + 0.25 AS DOUBLE) AS decimal,
           CAST((2000 + o_orderkey % 20) || '-0' || (1 + o_orderkey % 9) || '-1' || (o_orderkey % 9) AS DATE) AS day,
           o_orderstatus = 'F' AS yes_no,
           CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_orderkey % 50 AS VARCHAR) END AS mixed,
           CAST(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 7 END AS INTEGER) AS gaps,
           'said "' || o_orderkey || '",' || chr(10) || 'then left' AS words
    FROM orders""")
def q_csv_inferred_types(spark, sf):
    """A mixed export read with inferred types: one more pass over the file
    finds, per column, the narrowest type that holds every value."""
    return read_csv(spark, _mixed_export(spark, sf), infer_schema=True)


@query("csv_ingest_losses", f"""
    WITH t AS ({SONG_TEXT_SQL})
    SELECT 'Popularity' AS column_name, count(*) AS n_rows, count(score) AS n_values,
           count(score) - count(TRY_CAST(score AS DOUBLE)) AS n_lost FROM t
    UNION ALL SELECT '{presets.LOUDNESS}', count(*), count(loudness),
           count(loudness) - count(TRY_CAST(replace(loudness, ' dB', '') AS DOUBLE)) FROM t
    UNION ALL SELECT 'Tempo', count(*), count(tempo), count(tempo) - count(TRY_CAST(tempo AS DOUBLE)) FROM t
    UNION ALL SELECT 'Good for Work/Study', count(*), count(flag), count(flag) - count(TRY_CAST(flag AS DOUBLE)) FROM t""")
def q_csv_ingest_losses(spark, sf):
    """Values that typing an export makes null, per column, observed in the pass that writes it as Parquet."""
    songs, found = studies.read_songs_counted(spark, _song_export(spark, sf))
    write_parquet(songs, scratch_dir(spark, "songs_typed"))
    return found.report(spark)


@query("single_file_csv", """
    SELECT p_brand, count(*) AS count FROM part GROUP BY 1""")
def q_single_file_csv(spark, sf):
    counted = profile.counts(read_table(spark, sf, "part"), "p_brand")
    path = scratch_dir(spark, "brand_counts_csv")
    write_csv(counted, path, single_file=True)
    return read_csv(spark, path, schema=counted.schema)


@query("parquet_roundtrip", "SELECT * FROM part")
def q_parquet_roundtrip(spark, sf):
    part = read_table(spark, sf, "part")
    path = scratch_dir(spark, "part_parquet")
    write_parquet(part, path, codec="snappy")
    return read_parquet(spark, path)


@query("partition1_roundtrip", """
    SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
           round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows FROM lineitem GROUP BY 1""")
def q_partition1_roundtrip(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    rows = derive.with_flags(li, {"l_returnflag": "is_returned"}, truthy="R", drop_sources=True)
    path = scratch_dir(spark, "lines_by_flag")
    write_parquet(rows, path, partition_by=["is_returned"], rebalance=True)
    back = read_parquet(spark, path, schema=rows.schema)
    out = profile.mean_profile(back, "is_returned", {"avg_price": "l_extendedprice"}, count_name="n_rows")
    return _rounded(out, 4, "avg_price")


@query("partition2_pruned", """
    SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open,
           round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM lineitem WHERE l_returnflag = 'R' AND l_discount < 0.05 GROUP BY 1""")
def q_partition2_pruned(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice", "l_discount")
    rows = derive.with_flags(li, {"l_returnflag": "is_returned"}, truthy="R", drop_sources=True)
    rows = derive.with_flags(rows, {"l_linestatus": "is_open"}, truthy="O", drop_sources=True)
    path = scratch_dir(spark, "lines_by_two_flags")
    write_parquet(rows, path, partition_by=["is_returned", "is_open"])
    back = read_parquet(spark, path, schema=rows.schema)
    kept = back.where((F.col("is_returned") == 1) & (F.col("l_discount") < 0.05))
    out = profile.mean_profile(kept, "is_open", {"avg_price": "l_extendedprice"}, count_name="n_rows")
    return _rounded(out, 4, "avg_price")


@query("partition_stats", "SELECT count(*) AS n_rows FROM lineitem")
def q_partition_stats(spark, sf):
    return partition_sizes(read_table(spark, sf, "lineitem")).agg(F.sum("n_rows").cast("long").alias("n_rows"))


@query("partition_rows", "SELECT CAST(o_custkey % 5 AS INTEGER) AS partition, count(*) AS n_rows FROM orders GROUP BY 1")
def q_partition_rows(spark, sf):
    """Rows of each physical partition, the partition of a row being known."""
    od = read_table(spark, sf, "orders").select((F.col("o_custkey") % 5).cast("int").alias("at"))
    return partition_sizes(od.repartitionById(5, F.col("at")))


# Inventory items each registered query exercises. S5 (the
# session) is not listed: every query runs on the caller's session.
COVERAGE: dict[str, tuple[str, ...]] = {
    "project_complete": ("P1", "F1"),
    "not_null_filter": ("F2",),
    "lower_category": ("E4", "R3", "O2"),
    "rename_cast_drop": ("P2", "P3", "P4", "E11"),
    "sql_expr_filter": ("E7", "E8", "E12"),
    "bucket4_mean": ("E1", "F6", "R2", "R5", "O1"),
    "bucket10_mean": ("E2", "F6", "O1"),
    "bucket_sql": ("E1", "Q1", "Q2", "R9", "O1"),
    "bucket_partitioned_sql": ("E2", "W3", "S2", "S3", "R9", "Q2"),
    "flag_map": ("E3", "P4", "R4", "O3"),
    "decade_profile": ("E5", "E6", "F2", "R7", "R8", "O1"),
    "decade_bad_dates": ("E5", "E6", "F2"),
    "decade_partitioned": ("W3", "S3", "F2", "R7"),
    "group_stats_having": ("R1", "R2", "F5", "O1", "P6"),
    "mean_profile": ("R5", "R6"),
    "count_one_key": ("R3", "O2"),
    "count_two_keys": ("R4", "O3"),
    "share_of_group": ("R12", "J3", "E8", "E9", "O3"),
    "flag_share": ("R12", "J3", "E3", "E9", "O3"),
    "flag_category_counts": ("R4", "E3", "O3"),
    "flag_category_totals": ("R3", "O2"),
    "flag_mean_profile": ("R5", "E3"),
    "correlations": ("R10",),
    "score_correlations": ("R10",),
    "pivot_counts": ("R14",),
    "min_support_rows": ("J1", "F5"),
    "distinct_keys": ("R11",),
    "dense_index": ("N1", "J1", "J2", "E10", "E11", "R11"),
    "category_stats": ("R1", "F5", "P6"),
    "row_id": ("K2", "K3", "S4"),
    "row_id_file_order": ("K2", "K3", "S4"),
    "segment_single": ("F3", "P5", "R6"),
    "segment_all": ("F4", "P5", "R13"),
    "segment_comparison": ("U2", "R6", "R13"),
    "segment_union": ("U1", "U2", "P5"),
    "segment_count": ("W8", "R13", "F4"),
    "tag_comparison": ("U2", "E3", "F3", "F4", "P4", "R13"),
    "preview_topk": ("W7", "O4"),
    "csv_roundtrip": ("S1", "W5"),
    "csv_text_roundtrip": ("S1", "W5"),
    "single_file_csv": ("W6", "K1"),
    "parquet_roundtrip": ("W1", "W2", "S2"),
    "partition1_roundtrip": ("W3", "S3"),
    "partition2_pruned": ("W4", "S3", "F3", "F4"),
    "partition_stats": ("W9",),
    "partition_rows": ("W9",),
    "csv_typed_ingest": ("S1", "E11", "W5"),
    "flag_profile_nulls": ("R3", "R4", "R12"),
    "recased_columns": ("P1", "E1"),
    "pivot_counts_found": ("R14",),
    "row_id_many_files": ("K2", "K3"),
    "csv_inferred_types": ("S1",),
    "csv_ingest_losses": ("S1", "E11"),
    "segment_many": ("U2", "R6", "R13"),
}
