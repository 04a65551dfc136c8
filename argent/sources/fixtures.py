"""Bronze-shaped tables derived from the driver's parquet tables.

The reference reads change-captured source tables that we do not have; these
recipes turn the TPC-H-like driver tables into tables of the same shape (key,
business columns, sync time ``_synced``, soft-delete flag ``_deleted``).
Every recipe is a plain projection / join of whole driver tables, so its size
grows with the scale factor. The DuckDB oracle spells the same recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.functions.exprs import lit_ts

SYNCED = "_synced"
DELETED = "_deleted"

# Fixed "now" of the fixtures.
EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-03 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def del_flag(k: Column) -> Column:
    """Soft-delete flag with all three values: true, NULL, false."""
    return (F.when(k % 11 == 0, F.lit(True))
            .when(k % 5 == 0, F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)))


def syn_time(k: Column) -> Column:
    """Two sync times, one early and one late in January 2024."""
    return F.when(k % 2 == 0, lit_ts("2024-01-05 00:00:00")).otherwise(lit_ts("2024-01-29 00:00:00"))


def orders_v1(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("ORDER_ID"),
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col("o_orderdate").cast("string").alias("ORDER_DATE"),
        F.col("o_totalprice").alias("TOTAL_AMOUNT"),
        F.concat(F.lit("  "), F.lower("o_orderstatus"), F.lit(" ")).alias("ORDER_STATUS"),
        F.col("o_orderdate").alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def orders_v2(spark, sf_dir) -> DataFrame:
    """Second delivery of every third order: new amount, status and flag."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 == 0)
    k = F.col("o_orderkey")
    return o.select(
        k.alias("ORDER_ID"),
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col("o_orderdate").cast("string").alias("ORDER_DATE"),
        (F.col("o_totalprice") + 1).alias("TOTAL_AMOUNT"),
        F.lit("shipped").alias("ORDER_STATUS"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(2))).alias(SYNCED),
        (k % 13 == 0).alias(DELETED),
    )


def order_headers(spark, sf_dir) -> DataFrame:
    return orders_v1(spark, sf_dir).unionByName(orders_v2(spark, sf_dir))


def order_lines(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("LINE_ID"),
        F.col("l_orderkey").alias("ORDER_ID"),
        F.col("l_partkey").alias("ITEM_ID"),
        F.col("l_quantity").alias("QUANTITY"),
        F.col("l_extendedprice").alias("UNIT_PRICE"),
        F.col("l_shipdate").alias(SYNCED),
        del_flag(F.col("l_orderkey")).alias(DELETED),
        F.col("l_suppkey").alias("TIE"),
    )


def addresses(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    return j.select(
        k.alias("ADDRESS_ID"),
        F.concat(F.lit("  "), F.lower("n_name")).alias("CITY"),
        F.concat(F.lower("r_name"), F.lit(" ")).alias("STATE"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def city_tiers(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("n_nationkey")
    return j.select(
        k.cast("long").alias("CITY_TIER_ID"),
        F.lower("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        F.when(k % 4 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" tier"), (k % 4).cast("string"))).alias("TIER"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def categories(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_type").distinct()
    k = F.length("p_type")
    return p.select(
        F.col("p_type").alias("CATEGORY_ID"),
        F.when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("CATEGORY_NAME"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def brands(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand").distinct()
    k = F.length("p_brand")
    return p.select(
        F.col("p_brand").alias("BRAND_ID"),
        F.when(F.col("p_brand") == "Brand#2", F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("BRAND_NAME"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def items(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("ITEM_ID"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string"))
         .when(F.col("p_size") > 25, F.lit("ACTIVE")).otherwise(F.lit("RETIRED")).alias("STATUS"),
        F.col("p_type").alias("CATEGORY_ID"),
        F.col("p_brand").alias("BRAND_ID"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def customers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 17 == 0, F.lit("broken at example"))
             .when(k % 19 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com"))))
    return c.select(
        k.alias("CUSTOMER_ID"),
        email.alias("EMAIL"),
        F.concat(F.lit("+00-"), k.cast("string")).alias("PHONE"),
        F.col("c_name").alias("FIRST_NAME"),
        F.col("c_mktsegment").alias("LAST_NAME"),
        lit_ts("2023-06-15 00:00:00").alias("REGISTRATION_DATE"),
        F.col("c_mktsegment").alias("CUSTOMER_TYPE"),
        F.when(F.col("c_acctbal") < 0, F.lit("BLOCKED")).otherwise(F.lit("ACTIVE")).alias("STATUS"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def _events(spark, sf_dir, types) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type").isin(*types))


def registration_source(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir, ["signup"])
    k = F.col("event_id")
    return e.select(
        k.alias("REGISTRATION_ID"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.lit("web")).otherwise(F.lit("app")).alias("CHANNEL"),
        F.col("ts").alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def incidents(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir, ["error"])
    k = F.col("event_id")
    return e.select(
        k.alias("INCIDENT_ID"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.when(k % 9 == 0, F.lit("not a date")).otherwise(F.col("ts").cast("string")).alias("INCIDENT_DATE"),
        F.col("ts").alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def interactions(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir, ["click", "view"])
    k = F.col("event_id")
    return e.select(
        k.alias("INTERACTION_ID"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.col("ts").cast("string").alias("INTERACTION_DATE"),
        F.col("ts").alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def surveys(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir, ["purchase"])
    k = F.col("event_id")
    return e.select(
        k.alias("SURVEY_ID"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.when(k % 10 == 0, F.lit(None).cast("long")).otherwise(k % 13).alias("NPS_SCORE"),
        (k % 7).alias("CSAT_SCORE"),
        F.col("ts").alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


def campaigns(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("CAMPAIGN_ID"),
        F.col("s_name").alias("CAMPAIGN_NAME"),
        F.col("s_acctbal").alias("TOTAL_SPEND"),
        F.col("s_nationkey").alias("CUSTOMERS_ACQUIRED"),
        syn_time(k).alias(SYNCED),
        del_flag(k).alias(DELETED),
    )


# Bronze fixture per source table name.
BRONZE_FIXTURES = {
    "order_headers": order_headers,
    "order_lines": order_lines,
    "addresses": addresses,
    "city_tiers": city_tiers,
    "items": items,
    "categories": categories,
    "brands": brands,
    "customers": customers,
    "registration_source": registration_source,
    "incidents": incidents,
    "interactions": interactions,
    "surveys": surveys,
    "campaigns": campaigns,
}


def bronze(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return BRONZE_FIXTURES[source](spark, sf_dir)


def fixture_as_of(source: str) -> str:
    return ORDERS_AS_OF if source in ("order_headers", "order_lines") else EVENTS_AS_OF


# Three-run customer history fixture (snapshot input per run).
HISTORY_RUNS = {
    1: "2024-01-10 00:00:00",
    2: "2024-01-20 00:00:00",
    3: "2024-01-30 00:00:00",
}


def history_run(base: DataFrame, key: str, change_col: str, run: int) -> DataFrame:
    """Source snapshot of a keyed table as delivered on run 1, 2 or 3.

    Key classes: ``late`` (k % 10 = 9) first appears on run 2, ``gone``
    (k % 19 = 0, not late) disappears on run 2, ``changed`` (k % 5 = 0) gets
    ``change_col = 'CHANGED'`` on run 2, and k % 38 = 0 comes back on run 3.
    """
    k = F.col(key)
    late, gone, changed = (k % 10 == 9), (k % 19 == 0) & (k % 10 != 9), (k % 5 == 0)
    t05, t15, t25 = lit_ts("2024-01-05 00:00:00"), lit_ts("2024-01-15 00:00:00"), lit_ts("2024-01-25 00:00:00")
    if run == 1:
        return base.where(~late).withColumn(SYNCED, t05)
    run2 = (base.where(~gone)
            .withColumn(change_col, F.when(changed, F.lit("CHANGED")).otherwise(F.col(change_col)))
            .withColumn(SYNCED, F.when(changed | late, t15).otherwise(t05)))
    if run == 2:
        return run2
    back = base.where(k % 38 == 0).withColumn(SYNCED, t25)
    return run2.unionByName(back)


def customers_run(spark, sf_dir, run: int) -> DataFrame:
    """Customers snapshot of run 1, 2 or 3 (three-run history fixture)."""
    return history_run(customers(spark, sf_dir), "CUSTOMER_ID", "STATUS", run)


def items_run(spark, sf_dir, run: int) -> DataFrame:
    """Item master snapshot of run 1, 2 or 3 (same key classes)."""
    return history_run(items(spark, sf_dir), "ITEM_ID", "STATUS", run)


# ---------------------------------------------------------------------------
# Change-log and full-compare fixtures
# ---------------------------------------------------------------------------
SEQ = "_seq"


def orders_bronze_base(spark, sf_dir) -> DataFrame:
    """Bronze order headers before the change log: every order not divisible by 7."""
    return orders_v1(spark, sf_dir).where(F.col("ORDER_ID") % 7 != 0)


def order_changes(spark, sf_dir) -> DataFrame:
    """Change log: inserts of the orders missing from the base (k % 7 = 0),
    then updates of every third order, deletes where k % 13 = 0."""
    v1 = orders_v1(spark, sf_dir)
    v2 = orders_v2(spark, sf_dir)
    biz = ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"]
    ins = v1.where(F.col("ORDER_ID") % 7 == 0).select(*biz, F.col(SYNCED).alias(SEQ), F.lit("I").alias("_op"))
    upd = v2.select(*biz, F.col(SYNCED).alias(SEQ),
                    F.when(F.col("ORDER_ID") % 13 == 0, F.lit("D")).otherwise(F.lit("U")).alias("_op"))
    return ins.unionByName(upd)


def campaigns_extract(spark, sf_dir, version: int) -> DataFrame:
    """Two full extracts of the campaign source. Version 1 lacks k % 9 = 0;
    version 2 has these and lacks the other k % 7 = 0, renames k % 5 = 0 and has no spend for k % 4 = 0
    (version 1 has none for k % 8 = 0)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    if version == 1:
        return s.where(k % 9 != 0).select(
            k.alias("CAMPAIGN_ID"), F.col("s_name").alias("CAMPAIGN_NAME"),
            F.when(k % 8 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("TOTAL_SPEND"),
            F.col("s_nationkey").alias("CUSTOMERS_ACQUIRED"))
    return s.where((k % 7 != 0) | (k % 9 == 0)).select(
        k.alias("CAMPAIGN_ID"),
        F.when(k % 5 == 0, F.concat(F.col("s_name"), F.lit(" (renewed)"))).otherwise(F.col("s_name")).alias("CAMPAIGN_NAME"),
        F.when(k % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("TOTAL_SPEND"),
        F.col("s_nationkey").alias("CUSTOMERS_ACQUIRED"))


def orders_extract(spark, sf_dir, version: int) -> DataFrame:
    """Two full extracts of order headers: version 1 lacks k % 9 = 0; version 2
    has these, lacks the other k % 7 = 0 and carries the second delivery for every third order."""
    biz = ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"]
    v1 = orders_v1(spark, sf_dir).select(*biz)
    if version == 1:
        return v1.where(F.col("ORDER_ID") % 9 != 0)
    v2 = orders_v2(spark, sf_dir).select(*biz)
    k = F.col("ORDER_ID")
    there = (k % 7 != 0) | (k % 9 == 0)
    return v1.where((k % 3 != 0) & there).unionByName(v2.where(there))
