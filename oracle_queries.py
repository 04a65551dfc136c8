"""DuckDB SQL for the correctness oracle.

Independent spellings (plain SQL over the driver's tables) of the fixtures
and of every registered query. Kept apart from the Spark code on purpose:
it shares no code with the library, only the written definitions.
"""

from __future__ import annotations

RUN1 = "run-0001"
RUN2 = "run-0002"
EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-03 00:00:00"


def DEL(k: str) -> str:
    return f"(case when {k} % 11 = 0 then true when {k} % 5 = 0 then null else false end)"


def SYN(k: str) -> str:
    return (f"(case when {k} % 2 = 0 then timestamp '2024-01-05 00:00:00' "
            f"else timestamp '2024-01-29 00:00:00' end)")


FIXTURES = {
    "orders_v1": f"""select o_orderkey as ORDER_ID, o_custkey as CUSTOMER_ID,
        cast(o_orderdate as varchar) as ORDER_DATE, o_totalprice as TOTAL_AMOUNT,
        concat('  ', lower(o_orderstatus), ' ') as ORDER_STATUS, o_orderdate as _synced,
        {DEL('o_orderkey')} as _deleted from orders""",
    "orders_v2": """select o_orderkey as ORDER_ID, o_custkey as CUSTOMER_ID,
        cast(o_orderdate as varchar) as ORDER_DATE, o_totalprice + 1 as TOTAL_AMOUNT,
        'shipped' as ORDER_STATUS, o_orderdate + interval 2 day as _synced,
        (o_orderkey % 13 = 0) as _deleted from orders where o_orderkey % 3 = 0""",
    "order_lines": f"""select l_orderkey * 10 + l_linenumber as LINE_ID, l_orderkey as ORDER_ID,
        l_partkey as ITEM_ID, l_quantity as QUANTITY, l_extendedprice as UNIT_PRICE,
        l_shipdate as _synced, {DEL('l_orderkey')} as _deleted, l_suppkey as TIE from lineitem""",
    "addresses": f"""select c_custkey as ADDRESS_ID, concat('  ', lower(n_name)) as CITY,
        concat(lower(r_name), ' ') as STATE, {SYN('c_custkey')} as _synced, {DEL('c_custkey')} as _deleted
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "city_tiers": f"""select cast(n_nationkey as bigint) as CITY_TIER_ID, lower(n_name) as CITY, r_name as STATE,
        case when n_nationkey % 4 = 3 then null else concat(' tier', cast(n_nationkey % 4 as varchar)) end as TIER,
        {SYN('n_nationkey')} as _synced, {DEL('n_nationkey')} as _deleted
        from nation join region on n_regionkey = r_regionkey""",
    "categories": f"""select p_type as CATEGORY_ID, case when p_type = 'ECONOMY' then null else p_type end as CATEGORY_NAME,
        {SYN('length(p_type)')} as _synced, {DEL('length(p_type)')} as _deleted
        from (select distinct p_type from part)""",
    "brands": f"""select p_brand as BRAND_ID, case when p_brand = 'Brand#2' then null else p_brand end as BRAND_NAME,
        {SYN('length(p_brand)')} as _synced, {DEL('length(p_brand)')} as _deleted
        from (select distinct p_brand from part)""",
    "items": f"""select p_partkey as ITEM_ID,
        case when p_size % 10 = 0 then null when p_size > 25 then 'ACTIVE' else 'RETIRED' end as STATUS,
        p_type as CATEGORY_ID, p_brand as BRAND_ID, {SYN('p_partkey')} as _synced, {DEL('p_partkey')} as _deleted
        from part""",
    "customers": f"""select c_custkey as CUSTOMER_ID,
        case when c_custkey % 17 = 0 then 'broken at example' when c_custkey % 19 = 0 then null
             else concat(replace(lower(c_name), '#', '.'), '@example.com') end as EMAIL,
        concat('+00-', cast(c_custkey as varchar)) as PHONE, c_name as FIRST_NAME, c_mktsegment as LAST_NAME,
        timestamp '2023-06-15 00:00:00' as REGISTRATION_DATE, c_mktsegment as CUSTOMER_TYPE,
        case when c_acctbal < 0 then 'BLOCKED' else 'ACTIVE' end as STATUS,
        {SYN('c_custkey')} as _synced, {DEL('c_custkey')} as _deleted from customer""",
    "registration_source": f"""select event_id as REGISTRATION_ID, user_id as CUSTOMER_ID,
        case when event_id % 4 = 0 then null when event_id % 4 = 1 then 'web' else 'app' end as CHANNEL,
        ts as _synced, {DEL('event_id')} as _deleted from events where event_type = 'signup'""",
    "incidents": f"""select event_id as INCIDENT_ID, user_id as CUSTOMER_ID,
        case when event_id % 9 = 0 then 'not a date' else cast(ts as varchar) end as INCIDENT_DATE,
        ts as _synced, {DEL('event_id')} as _deleted from events where event_type = 'error'""",
    "interactions": f"""select event_id as INTERACTION_ID, user_id as CUSTOMER_ID,
        cast(ts as varchar) as INTERACTION_DATE, ts as _synced, {DEL('event_id')} as _deleted
        from events where event_type in ('click', 'view')""",
    "surveys": f"""select event_id as SURVEY_ID, user_id as CUSTOMER_ID,
        case when event_id % 10 = 0 then null else event_id % 13 end as NPS_SCORE,
        event_id % 7 as CSAT_SCORE, ts as _synced, {DEL('event_id')} as _deleted
        from events where event_type = 'purchase'""",
    "campaigns": f"""select s_suppkey as CAMPAIGN_ID, s_name as CAMPAIGN_NAME, s_acctbal as TOTAL_SPEND,
        s_nationkey as CUSTOMERS_ACQUIRED, {SYN('s_suppkey')} as _synced, {DEL('s_suppkey')} as _deleted
        from supplier""",
}
FIXTURES["order_headers"] = f"select * from ({FIXTURES['orders_v1']}) union all select * from ({FIXTURES['orders_v2']})"

# Per model: key, cleaned select list, dedup order extra, fixture name.
MODEL_SQL = {
    "registration_source": ("REGISTRATION_ID", "CUSTOMER_ID, coalesce(CHANNEL, 'Unknown') as CHANNEL", ""),
    "incidents": ("INCIDENT_ID", "CUSTOMER_ID, try_cast(INCIDENT_DATE as timestamp) as INCIDENT_DATE", ""),
    "interactions": ("INTERACTION_ID", "CUSTOMER_ID, try_cast(INTERACTION_DATE as timestamp) as INTERACTION_DATE", ""),
    "surveys": ("SURVEY_ID", "CUSTOMER_ID, cast(NPS_SCORE as decimal(38,0)) as NPS_SCORE, "
                "cast(CSAT_SCORE as decimal(38,0)) as CSAT_SCORE", ""),
    "addresses": ("ADDRESS_ID", "upper(trim(CITY)) as CITY, upper(trim(STATE)) as STATE", ""),
    "brands": ("BRAND_ID", "coalesce(BRAND_NAME, 'Unknown') as BRAND_NAME", ""),
    "categories": ("CATEGORY_ID", "coalesce(CATEGORY_NAME, 'Unknown') as CATEGORY_NAME", ""),
    "city_tiers": ("CITY_TIER_ID", "upper(trim(CITY)) as CITY, upper(trim(STATE)) as STATE, "
                   "upper(trim(TIER)) as TIER", ""),
    "order_headers": ("ORDER_ID", "CUSTOMER_ID, try_cast(ORDER_DATE as timestamp) as ORDER_DATE, "
                      "cast(TOTAL_AMOUNT as decimal(18,2)) as TOTAL_AMOUNT, upper(trim(ORDER_STATUS)) as ORDER_STATUS", ""),
    "order_lines": ("LINE_ID", "ORDER_ID, ITEM_ID, cast(QUANTITY as decimal(38,0)) as QUANTITY, "
                    "cast(UNIT_PRICE as decimal(18,2)) as UNIT_PRICE",
                    ", ITEM_ID asc nulls first, ORDER_ID asc nulls first, QUANTITY asc nulls first, UNIT_PRICE asc nulls first"),
    "campaigns": ("CAMPAIGN_ID", "cast(CAMPAIGN_NAME as varchar) as CAMPAIGN_NAME, "
                  "cast(TOTAL_SPEND as decimal(38,0)) as TOTAL_SPEND, "
                  "cast(CUSTOMERS_ACQUIRED as decimal(38,0)) as CUSTOMERS_ACQUIRED", ""),
}


def as_of_for(model: str) -> str:
    return ORDERS_AS_OF if model in ("order_headers", "order_lines") else EVENTS_AS_OF


def model_build(model: str, source_sql: str | None = None, as_of: str | None = None, run_id: str = RUN1,
                where: str = "", propagate_deletes: bool = False) -> str:
    """Full build of a staging model as one SQL statement."""
    key, select, tie = MODEL_SQL[model]
    src = source_sql or FIXTURES[model]
    as_of = as_of or as_of_for(model)
    active = "(_deleted = false or _deleted is null)"
    if propagate_deletes:
        pre, post = f"select * from ({src}) s {('where ' + where) if where else ''}", ""
    else:
        pre = f"select * from ({src}) s where {active} {('and (' + where + ')') if where else ''}"
        post = ""
    return f"""with src as ({pre}),
        ranked as (select *, row_number() over (partition by {key} order by _synced desc nulls first{tie}) as _rn
                   from src)
        select {key}, {select}, _synced as _bronze_sync_timestamp,
               timestamp '{as_of}' as _silver_load_timestamp, '{run_id}' as _run_id, _deleted as _is_deleted
        from ranked where _rn = 1 {post}"""


ORACLES: dict[str, str] = {}

for _id, _model in [("m1", "registration_source"), ("m2", "incidents"), ("m3", "interactions"),
                    ("m4", "surveys"), ("m5", "addresses"), ("m6", "brands"), ("m7", "categories"),
                    ("m8", "city_tiers"), ("m9", "order_headers"), ("m10", "order_lines"),
                    ("m11", "campaigns")]:
    ORACLES[f"{_id}_{_model}"] = model_build(_model)


MODEL_COLS = {
    "registration_source": ["REGISTRATION_ID", "CUSTOMER_ID", "CHANNEL"],
    "incidents": ["INCIDENT_ID", "CUSTOMER_ID", "INCIDENT_DATE"],
    "interactions": ["INTERACTION_ID", "CUSTOMER_ID", "INTERACTION_DATE"],
    "surveys": ["SURVEY_ID", "CUSTOMER_ID", "NPS_SCORE", "CSAT_SCORE"],
    "addresses": ["ADDRESS_ID", "CITY", "STATE"],
    "brands": ["BRAND_ID", "BRAND_NAME"],
    "categories": ["CATEGORY_ID", "CATEGORY_NAME"],
    "city_tiers": ["CITY_TIER_ID", "CITY", "STATE", "TIER"],
    "order_headers": ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"],
    "order_lines": ["LINE_ID", "ORDER_ID", "ITEM_ID", "QUANTITY", "UNIT_PRICE"],
    "campaigns": ["CAMPAIGN_ID", "CAMPAIGN_NAME", "TOTAL_SPEND", "CUSTOMERS_ACQUIRED"],
}
AUDIT = ["_bronze_sync_timestamp", "_silver_load_timestamp", "_run_id", "_is_deleted"]
ORDERS_CUT = "2000-01-01 00:00:00"
EVENTS_CUT = "2024-01-20 00:00:00"
EARLY_DAY = "2024-01-30 00:00:00"
MIN_TS = "timestamp '2000-01-01 00:00:00'"


def cut_for(model: str) -> str:
    return ORDERS_CUT if model in ("order_headers", "order_lines") else EVENTS_CUT


def run1_sql(model: str, early_from: str | None = None) -> str:
    cut = cut_for(model)
    where = f"_synced < timestamp '{cut}'" + (f" or _synced >= timestamp '{early_from}'" if early_from else "")
    return model_build(model, where=where, as_of=cut, run_id=RUN1)


def merge_sql(model: str, window: bool = False, early_from: str | None = None, lookback: int = 3,
              t1_null: tuple = ()) -> str:
    """Two runs: run-1 table, incremental run-2 batch, then the merge formula
    (batch left-join target) union (target anti-join batch)."""
    key = MODEL_COLS[model][0]
    as_of2 = as_of_for(model)
    t1 = run1_sql(model, early_from)
    if t1_null:
        t1 = f"select * replace ({', '.join(f'null as {c}' for c in t1_null)}) from ({t1}) r"
    hw = f"(select coalesce(max(_bronze_sync_timestamp), {MIN_TS}) from t1)"
    b = model_build(model, where=f"_synced > {hw} or _synced >= timestamp '{as_of2}' - interval {lookback} day",
                    as_of=as_of2, run_id=RUN2)
    win = f"coalesce(t1._bronze_sync_timestamp >= timestamp '{as_of2}' - interval 3 day, false)" if window else "true"
    cols = MODEL_COLS[model] + AUDIT
    sel_b = ", ".join(f"case when e.{key} is not null then e._silver_load_timestamp else b._silver_load_timestamp end as {c}"
                      if c == "_silver_load_timestamp" else f"b.{c}" for c in cols)
    return f"""with t1 as ({t1}), b as ({b}),
        e as (select {key}, _silver_load_timestamp from t1 where {win})
        select {sel_b} from b left join e on b.{key} = e.{key}
        union all
        select {", ".join("t1." + c for c in cols)} from t1
        where not ({win}) or not exists (select 1 from b where b.{key} = t1.{key})"""


def dedup_sql(src: str, key: str, cols: str, tie: str = "", where: str = "") -> str:
    return f"""select {cols} from (select *, row_number() over (partition by {key}
        order by _synced desc nulls first{tie}) as _rn from ({src}) s {('where ' + where) if where else ''}) r
        where _rn = 1"""


ACTIVE = "(_deleted = false or _deleted is null)"

ORACLES.update({
    "s1_read_bronze": f"select LINE_ID, ORDER_ID, ITEM_ID, QUANTITY, UNIT_PRICE, _synced, _deleted from ({FIXTURES['order_lines']})",
    "p1_select": f"select ORDER_ID, CUSTOMER_ID, ORDER_STATUS from ({FIXTURES['order_headers']})",
    "p2_audit_rename": dedup_sql(FIXTURES["brands"], "BRAND_ID",
                                 "BRAND_ID, _synced as _bronze_sync_timestamp, _deleted as _is_deleted", where=ACTIVE),
    "p3_run_id": dedup_sql(FIXTURES["brands"], "BRAND_ID", f"BRAND_ID, '{RUN1}' as _run_id", where=ACTIVE),
    "p4_load_time": dedup_sql(FIXTURES["brands"], "BRAND_ID",
                              f"BRAND_ID, timestamp '{EVENTS_AS_OF}' as _silver_load_timestamp", where=ACTIVE),
    "p5_high_water_filter": f"""with t1 as ({run1_sql('interactions')})
        select INTERACTION_ID, _synced, _deleted from ({FIXTURES['interactions']}) s
        where _synced > (select coalesce(max(_bronze_sync_timestamp), {MIN_TS}) from t1)
           or _synced >= timestamp '{EVENTS_AS_OF}'""",
    "p6_lookback": f"""with t1 as ({run1_sql('interactions')})
        select INTERACTION_ID, _synced, _deleted from ({FIXTURES['interactions']}) s
        where _synced > (select coalesce(max(_bronze_sync_timestamp), {MIN_TS}) from t1)
           or _synced >= timestamp '{EVENTS_AS_OF}' - interval 3 day""",
    "p7_active_only": f"select ORDER_ID, _synced, _deleted from ({FIXTURES['order_headers']}) s where {ACTIVE}",
    "p8_limit_dates": model_build("order_headers",
                                  where=f"try_cast(ORDER_DATE as date) >= date '{ORDERS_AS_OF[:10]}' - interval 90 day"),
    "p9_keep_rank1": dedup_sql(FIXTURES["order_headers"], "ORDER_ID", "ORDER_ID, TOTAL_AMOUNT, _synced, _deleted",
                               where=ACTIVE),
    "p11_transform_chain": model_build("city_tiers"),
    "p12_violations": f"select SURVEY_ID, NPS_SCORE from ({model_build('surveys')}) m where NPS_SCORE < 0 or NPS_SCORE > 10",
    "w1_dedup_latest": dedup_sql(FIXTURES["order_lines"], "LINE_ID", "LINE_ID, ITEM_ID, TIE, _synced, _deleted",
                                 tie=", ITEM_ID asc nulls first, TIE asc nulls first"),
    "o3_top1_per_group": dedup_sql(FIXTURES["orders_v1"], "CUSTOMER_ID", "CUSTOMER_ID, ORDER_ID, _synced",
                                   tie=", ORDER_ID asc nulls first"),
    "a1_high_water": f"select coalesce(max(_bronze_sync_timestamp), {MIN_TS}) as high_water from ({run1_sql('order_headers')}) t",
    "s6_merge_upsert": merge_sql("order_headers"),
    "s7_merge_exclude": f"select LINE_ID, _silver_load_timestamp, _run_id, _bronze_sync_timestamp from ({merge_sql('order_lines')}) m",
    "s8_materialize": model_build("addresses"),
    "j3_merge_match": merge_sql("surveys"),
    "j4_merge_window": merge_sql("order_headers", window=True),
    "u1_union": merge_sql("campaigns"),
    "st3_late_data": merge_sql("interactions", window=True, early_from=EARLY_DAY),
})


# ---------------------------------------------------------------------------
# Type-2 history: one SQL step per snapshot run
# ---------------------------------------------------------------------------
OPEN_END = "timestamp '9999-12-31 00:00:00'"
HISTORY_AS_OF = {1: "2024-01-10 00:00:00", 2: "2024-01-20 00:00:00", 3: "2024-01-30 00:00:00"}
CUSTOMER_COLS = ["CUSTOMER_ID", "EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME", "REGISTRATION_DATE",
                 "CUSTOMER_TYPE", "STATUS", "_synced", "_deleted"]
ITEM_COLS = ["ITEM_ID", "STATUS", "CATEGORY_ID", "BRAND_ID", "_synced", "_deleted"]


def run_source_sql(base: str, key: str, run: int) -> str:
    t05, t15, t25 = (f"timestamp '2024-01-{d} 00:00:00'" for d in ("05", "15", "25"))
    r1 = f"select * replace ({t05} as _synced) from ({base}) b where not ({key} % 10 = 9)"
    r2 = (f"select * replace (case when {key} % 5 = 0 then 'CHANGED' else STATUS end as STATUS, "
          f"case when {key} % 5 = 0 or {key} % 10 = 9 then {t15} else {t05} end as _synced) "
          f"from ({base}) b where not ({key} % 19 = 0 and {key} % 10 <> 9)")
    r3 = f"{r2} union all select * replace ({t25} as _synced) from ({base}) b where {key} % 38 = 0"
    return {1: r1, 2: r2, 3: r3}[run]


def sid(key: str, ts: str) -> str:
    return (f"md5(concat_ws('|', coalesce(cast({key} as varchar), ''), "
            f"coalesce(strftime({ts}, '%Y-%m-%d %H:%M:%S.%f'), '')))")


def history_sql(base: str, key: str, cols: list, runs=(1, 2, 3)) -> str:
    """CTE chain h1..hN: the history after each run, spelled as plain SQL."""
    c = ", ".join(cols)
    sc = lambda a: ", ".join(f"{a}.{x}" for x in cols)
    ctes = []
    for r in runs:
        src = f"""s{r} as (select {c} from (select *, row_number() over (partition by {key}
                  order by _synced desc nulls first) as _rn from ({run_source_sql(base, key, r)}) x) y where _rn = 1)"""
        ctes.append(src)
        if r == runs[0]:
            ctes.append(f"""h{r} as (select {c}, {sid(key, '_synced')} as scd_id, _synced as valid_from,
                {OPEN_END} as valid_to, _synced as updated_at, true as is_current, false as is_deleted from s{r})""")
            continue
        p, now = f"h{r - 1}", f"timestamp '{HISTORY_AS_OF[r]}'"
        back = "greatest(s._synced, c.valid_from)"
        ctes.append(f"""h{r} as (
            select * from {p} where not is_current
            union all
            select {sc('c')}, c.scd_id, c.valid_from,
                   case when s.{key} is null and not c.is_deleted then {now}
                        when s.{key} is not null and c.is_deleted then {back}
                        when s.{key} is not null and s._synced > c.valid_from then s._synced
                        else c.valid_to end as valid_to,
                   c.updated_at, false as is_current, c.is_deleted
              from {p} c left join s{r} s on c.{key} = s.{key}
             where c.is_current and ((s.{key} is null and not c.is_deleted)
                   or (s.{key} is not null and (c.is_deleted or s._synced > c.valid_from)))
            union all
            select {sc('c')}, c.scd_id, c.valid_from, c.valid_to, c.updated_at, c.is_current, c.is_deleted
              from {p} c left join s{r} s on c.{key} = s.{key}
             where c.is_current and not ((s.{key} is null and not c.is_deleted)
                   or (s.{key} is not null and (c.is_deleted or s._synced > c.valid_from)))
            union all
            select {sc('c')}, {sid('c.' + key, now)}, {now}, {OPEN_END}, {now}, true, true
              from {p} c left join s{r} s on c.{key} = s.{key}
             where c.is_current and s.{key} is null and not c.is_deleted
            union all
            select {sc('s')}, {sid('s.' + key, 'case when c.is_deleted then ' + back + ' else s._synced end')},
                   case when c.is_deleted then {back} else s._synced end, {OPEN_END},
                   case when c.is_deleted then {back} else s._synced end, true, false
              from s{r} s left join (select * from {p} where is_current) c on c.{key} = s.{key}
             where c.{key} is null or c.is_deleted or s._synced > c.valid_from)""")
    return "with " + ",\n".join(ctes)


CUST_HIST = history_sql(FIXTURES["customers"], "CUSTOMER_ID", CUSTOMER_COLS)
CUST_HIST2 = history_sql(FIXTURES["customers"], "CUSTOMER_ID", CUSTOMER_COLS, runs=(1, 2))
ITEM_HIST = history_sql(FIXTURES["items"], "ITEM_ID", ITEM_COLS)
ITEM_HIST2 = history_sql(FIXTURES["items"], "ITEM_ID", ITEM_COLS, runs=(1, 2))
# PHONE is not in the source of run 1; it comes last of the source columns.
_EVOLVED = [c for c in CUSTOMER_COLS if c != "PHONE"] + ["PHONE"]
CUST_EVOLVE = history_sql(FIXTURES["customers"], "CUSTOMER_ID", _EVOLVED).replace(
    f"s1 as (select {', '.join(_EVOLVED)} from", f"s1 as (select {', '.join(_EVOLVED[:-1])}, cast(null as varchar) as PHONE from", 1)
_CUR = "is_current and (is_deleted = false or is_deleted is null)"

ORACLES.update({
    "s10_scd2_apply": f"{CUST_HIST} select * from h3",
    "s10_history_evolve": f"{CUST_EVOLVE} select * from h3",
    "m12_customer_history": f"{CUST_HIST} select * from h3",
    "m13_item_history": f"{ITEM_HIST} select * from h3",
    "m14_current_customers": f"""{CUST_HIST} select CUSTOMER_ID, EMAIL, PHONE, FIRST_NAME, LAST_NAME,
        REGISTRATION_DATE, CUSTOMER_TYPE, STATUS, valid_from, valid_to, updated_at from h3 where {_CUR}""",
    "s11_current_view": f"""{ITEM_HIST2} select ITEM_ID, STATUS, CATEGORY_ID, BRAND_ID, valid_from, valid_to,
        updated_at from h2 where {_CUR}""",
    "p10_current_rows": f"{CUST_HIST2} select CUSTOMER_ID, STATUS, valid_from, is_deleted from h2 where {_CUR}",
    "j5_history_compare": f"""{CUST_HIST2}, s3 as (select CUSTOMER_ID, _synced from (select *, row_number() over
        (partition by CUSTOMER_ID order by _synced desc nulls first) as _rn
        from ({run_source_sql(FIXTURES['customers'], 'CUSTOMER_ID', 3)}) x) y where _rn = 1),
        c as (select * from h2 where is_current)
        select coalesce(c.CUSTOMER_ID, s.CUSTOMER_ID) as CUSTOMER_ID,
               case when c.CUSTOMER_ID is null then 'insert'
                    when s.CUSTOMER_ID is null and c.is_deleted then 'deleted'
                    when s.CUSTOMER_ID is null then 'delete'
                    when c.is_deleted then 'return'
                    when s._synced > c.valid_from then 'update' else 'unchanged' end as action
          from c full outer join s3 s on c.CUSTOMER_ID = s.CUSTOMER_ID""",
    "f16_open_end": f"{CUST_HIST2} select CUSTOMER_ID, valid_from, valid_to from h2 where valid_to = {OPEN_END}",
    "f17_scd_id": f"{CUST_HIST2} select CUSTOMER_ID, updated_at, scd_id from h2",
})


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
def _res(check: str, table: str, column: str, severity: str, failures: str) -> str:
    return (f"select '{check}' as \"check\", '{table}' as \"table\", '{column}' as \"column\", "
            f"'{severity}' as severity, cast({failures} as bigint) as failures, "
            f"case when {failures} > 0 then '{severity}' else 'pass' end as status")


def _row_check(src: str, table: str, checks: list) -> str:
    """checks: (name, column, severity, failing predicate); NULL predicate passes."""
    parts = [f"select * from (select {_res(n, table, c, s, 'f')[7:]} from "
             f"(select count(*) filter (where coalesce({pred}, false)) as f from ({src}) x) y)"
             for n, c, s, pred in checks]
    return " union all ".join(parts)


def _unique_check(src: str, table: str, col: str, severity: str = "error") -> str:
    return (f"select {_res('unique_' + col.lower(), table, col, severity, 'f')[7:]} from "
            f"(select count(*) as f from (select {col} from ({src}) x where {col} is not null "
            f"group by {col} having count(*) > 1) g) y")


def _suite_sql(model: str, as_of: str) -> str:
    src = model_build(model)
    day = f"timestamp '{as_of[:10]} 00:00:00'"
    suites = {
        "order_headers": ([("ORDER_ID", "error")],
                          [("not_null_order_id", "ORDER_ID", "error", "ORDER_ID is null"),
                           ("not_null_customer_id", "CUSTOMER_ID", "error", "CUSTOMER_ID is null"),
                           ("not_null_total_amount", "TOTAL_AMOUNT", "error", "TOTAL_AMOUNT is null"),
                           ("in_range_total_amount", "TOTAL_AMOUNT", "error", "not (TOTAL_AMOUNT >= 0)"),
                           ("not_null_order_date", "ORDER_DATE", "error", "ORDER_DATE is null"),
                           ("not_after_order_date", "ORDER_DATE", "warn", f"not (ORDER_DATE <= {day})")]),
        "order_lines": ([("LINE_ID", "error")],
                        [("not_null_line_id", "LINE_ID", "error", "LINE_ID is null"),
                         ("not_null_order_id", "ORDER_ID", "error", "ORDER_ID is null"),
                         ("in_range_quantity", "QUANTITY", "warn", "not (QUANTITY >= 1)")]),
        "surveys": ([("SURVEY_ID", "error")],
                    [("not_null_survey_id", "SURVEY_ID", "error", "SURVEY_ID is null"),
                     ("in_range_nps_score", "NPS_SCORE", "warn", "not (NPS_SCORE >= 0 and NPS_SCORE <= 10)"),
                     ("in_range_csat_score", "CSAT_SCORE", "warn", "not (CSAT_SCORE >= 1 and CSAT_SCORE <= 5)")]),
        "campaigns": ([("CAMPAIGN_ID", "error")],
                      [("not_null_campaign_id", "CAMPAIGN_ID", "error", "CAMPAIGN_ID is null"),
                       ("in_range_total_spend", "TOTAL_SPEND", "warn", "not (TOTAL_SPEND >= 0)")]),
        "city_tiers": ([("CITY_TIER_ID", "error")],
                       [("not_null_tier", "TIER", "warn", "TIER is null")]),
        "registration_source": ([("REGISTRATION_ID", "error")],
                                [("not_null_customer_id", "CUSTOMER_ID", "error", "CUSTOMER_ID is null"),
                                 ("not_null_channel", "CHANNEL", "error", "CHANNEL is null")]),
    }
    uniq, rows = suites[model]
    return " union all ".join([_row_check(src, model, rows)] + [_unique_check(src, model, c, s) for c, s in uniq])


EMAIL_COLUMN_RE = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
EMAIL_TEST_RE = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
EMAIL_MACRO_RE = r"^[a-zA-Z0-9._%+'-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _re(pattern: str) -> str:
    return pattern.replace("'", "''")


def _fresh(name: str, src: str, warn: int, err: int, as_of: str) -> str:
    age = f"(epoch_us(timestamp '{as_of}') - epoch_us(m)) / 60000000.0"
    return (f"select '{name}' as source, m as max_loaded_at, {age} as age_minutes, "
            f"case when m is null then 'error' when {age} > {err} then 'error' when {age} > {warn} then 'warn' "
            f"else 'pass' end as status from (select max(_synced) as m from ({src}) x) y")


GROUP_OF = {"order_headers": "erp", "order_lines": "erp", "addresses": "erp", "city_tiers": "erp", "items": "erp",
            "categories": "erp", "brands": "erp", "customers": "crm", "registration_source": "crm",
            "incidents": "crm", "interactions": "crm", "surveys": "crm", "campaigns": "marketing"}
RULES = {"erp": (60, 240), "crm": (60, 240), "marketing": (1440, 2880)}
_HEADERS_J4 = merge_sql("order_headers", window=True)
_CUR_PARENT = "select CUSTOMER_ID from h2 where is_current = true"

ORACLES.update({
    "a2_duplicate_groups": f"""select ORDER_ID, count(*) as n_records from ({_HEADERS_J4}) m
        where ORDER_ID is not null group by ORDER_ID having count(*) > 1""",
    "d1_unique": _unique_check(_HEADERS_J4, "order_headers", "ORDER_ID"),
    "d2_not_null": _row_check(model_build("city_tiers"), "city_tiers", [("not_null_tier", "TIER", "warn", "TIER is null")])
    + " union all " + _unique_check(model_build("city_tiers"), "city_tiers", "CITY_TIER_ID"),
    "d3_in_range": _suite_sql("surveys", EVENTS_AS_OF),
    "d4_not_after": _row_check(model_build("incidents"), "incidents",
                               [("not_after_incident_date", "INCIDENT_DATE", "warn",
                                 f"not (INCIDENT_DATE <= timestamp '{EVENTS_CUT[:10]} 00:00:00')")]),
    "d5_matches": _row_check(FIXTURES["customers"], "customers",
                             [("not_null_email", "EMAIL", "error", "EMAIL is null"),
                              ("matches_email", "EMAIL", "warn", f"not regexp_matches(EMAIL, '{_re(EMAIL_COLUMN_RE)}')")]),
    "d6_positive": _row_check(model_build("campaigns"), "campaigns",
                              [("positive_total_spend", "TOTAL_SPEND", "error",
                                "TOTAL_SPEND is not null and TOTAL_SPEND <= 0")]),
    "d7_has_type": " union all ".join(
        f"select * from (select {_res('has_type_' + c.lower(), 'order_headers', c, 'error', 'f')[7:]} from "
        f"(select case when upper(typeof({c})) <> upper('{t}') then 1 else 0 end as f "
        f"from ({model_build('order_headers')}) x limit 1) y)"
        for c, t in (("ORDER_ID", "bigint"), ("TOTAL_AMOUNT", "DECIMAL(18,2)"), ("CUSTOMER_ID", "integer"))),
    "o2_type_probe": " union all ".join(
        f"select * from (select {_res('has_type_' + c.lower(), 'surveys', c, 'error', 'f')[7:]} from "
        f"(select case when upper(typeof({c})) <> upper('{t}') then 1 else 0 end as f "
        f"from ({model_build('surveys')}) x limit 1) y)"
        for c, t in (("SURVEY_ID", "BIGINT"), ("NPS_SCORE", "decimal(38,0)"), ("CSAT_SCORE", "double"))),
    "d8_valid_email": _row_check(FIXTURES["customers"], "customers",
                                 [("valid_email_email", "EMAIL", "error",
                                   f"EMAIL is not null and not regexp_matches(EMAIL, '{_re(EMAIL_TEST_RE)}')")]),
    "j1_orphans": f"""{CUST_HIST2} select child.ORDER_ID, child.CUSTOMER_ID from ({model_build('order_headers')}) child
        left join ({_CUR_PARENT}) parent on child.CUSTOMER_ID = parent.CUSTOMER_ID
        where child.CUSTOMER_ID is not null and parent.CUSTOMER_ID is null""",
    "d9_references": f"""{CUST_HIST2} select {_res('references_customer_id', 'order_headers', 'CUSTOMER_ID', 'error', 'f')[7:]}
        from (select count(*) as f from ({model_build('order_headers')}) child
        left join ({_CUR_PARENT}) parent on child.CUSTOMER_ID = parent.CUSTOMER_ID
        where child.CUSTOMER_ID is not null and parent.CUSTOMER_ID is null) y""",
    "a3_freshness": _fresh("interactions", FIXTURES["interactions"], 60, 240, "2024-01-31 01:30:00"),
    "d10_freshness": " union all ".join(_fresh(n, FIXTURES[n], *RULES[g], "2024-01-31 03:00:00")
                                        for n, g in GROUP_OF.items()),
    "a4_run_checks": _suite_sql("order_headers", ORDERS_AS_OF),
    "d11_run_status": f"""select errors, warnings, passed, case when errors > 0 then 'error' when warnings > 0 then 'warn'
        else 'pass' end as run_status from (select count(*) filter (where status = 'error') as errors,
        count(*) filter (where status = 'warn') as warnings, count(*) filter (where status = 'pass') as passed
        from ({' union all '.join(_suite_sql(m, as_of_for(m)) for m in ('order_headers', 'order_lines', 'surveys', 'campaigns', 'city_tiers', 'registration_source'))}) r) y""",
    "j2_inner_join_order": f"""select o.ORDER_ID, o.CUSTOMER_ID, c.LAST_NAME from ({model_build('order_headers')}) o
        join ({FIXTURES['customers']}) c on o.CUSTOMER_ID = c.CUSTOMER_ID order by c.LAST_NAME, o.ORDER_ID""",
    "o1_sort": f"select CAMPAIGN_ID, CAMPAIGN_NAME from ({model_build('campaigns')}) m order by CAMPAIGN_NAME",
})


# ---------------------------------------------------------------------------
# Change feeds, schema evolution, docs, governance, column functions
# ---------------------------------------------------------------------------
_BIZ = "ORDER_ID, CUSTOMER_ID, ORDER_DATE, TOTAL_AMOUNT, ORDER_STATUS"
_BASE = f"select * from ({FIXTURES['orders_v1']}) v where ORDER_ID % 7 <> 0"
_CHANGES = f"""select {_BIZ}, _synced as _seq, 'I' as _op from ({FIXTURES['orders_v1']}) a where ORDER_ID % 7 = 0
    union all select {_BIZ}, _synced as _seq, case when ORDER_ID % 13 = 0 then 'D' else 'U' end as _op
    from ({FIXTURES['orders_v2']}) b"""


def _pick(c: str) -> str:
    return (f"case when c.ORDER_ID is not null and (c._op <> 'D' or t.ORDER_ID is null) "
            f"then c.{c} else t.{c} end as {c}")


def _extract_sql(kind: str, version: int) -> str:
    if kind == "campaigns":
        if version == 1:
            return """select s_suppkey as CAMPAIGN_ID, s_name as CAMPAIGN_NAME,
                case when s_suppkey % 8 = 0 then null else s_acctbal end as TOTAL_SPEND,
                s_nationkey as CUSTOMERS_ACQUIRED from supplier where s_suppkey % 9 <> 0"""
        return """select s_suppkey as CAMPAIGN_ID,
            case when s_suppkey % 5 = 0 then concat(s_name, ' (renewed)') else s_name end as CAMPAIGN_NAME,
            case when s_suppkey % 4 = 0 then null else s_acctbal end as TOTAL_SPEND,
            s_nationkey as CUSTOMERS_ACQUIRED from supplier where (s_suppkey % 7 <> 0 or s_suppkey % 9 = 0)"""
    v1 = f"select {_BIZ} from ({FIXTURES['orders_v1']}) a"
    if version == 1:
        return f"{v1} where ORDER_ID % 9 <> 0"
    return (f"{v1} where ORDER_ID % 3 <> 0 and (ORDER_ID % 7 <> 0 or ORDER_ID % 9 = 0) union all "
            f"select {_BIZ} from ({FIXTURES['orders_v2']}) b where ORDER_ID % 7 <> 0 or ORDER_ID % 9 = 0")


def _diff_sql(kind: str, key: str, cols: list) -> str:
    differs = " or ".join(f"p.{c} is distinct from c.{c}" for c in cols)
    vals = ", ".join(f"case when c.{key} is not null then c.{x} else p.{x} end as {x}" for x in [key, *cols])
    return f"""select * from (select case when p.{key} is null then 'insert' when c.{key} is null then 'delete'
        when {differs} then 'update' end as op, {vals}
        from ({_extract_sql(kind, 1)}) p full outer join ({_extract_sql(kind, 2)}) c on p.{key} = c.{key}) d
        where op is not null"""


_CAMP = ["CAMPAIGN_NAME", "TOTAL_SPEND", "CUSTOMERS_ACQUIRED"]

ORACLES.update({
    "s2_apply_changes": f"""with t as ({_BASE}), c as (select * from (select *, row_number() over
        (partition by ORDER_ID order by _seq desc nulls first) as _rn from ({_CHANGES}) x) y where _rn = 1)
        select {', '.join(_pick(c) for c in _BIZ.split(', '))},
            case when c.ORDER_ID is not null then timestamp '{ORDERS_AS_OF}' else t._synced end as _synced,
            case when c.ORDER_ID is not null then c._op = 'D' else t._deleted end as _deleted
        from t full outer join c on t.ORDER_ID = c.ORDER_ID""",
    "s3_snapshot_diff": _diff_sql("campaigns", "CAMPAIGN_ID", _CAMP),
    "s3_orders_diff": _diff_sql("orders", "ORDER_ID", ["CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "ORDER_STATUS"]),
    "s4_changed_columns": f"""select * from (select p.CAMPAIGN_ID, concat_ws(',', {', '.join(
        f"case when p.{c} is distinct from c.{c} then '{c}' end" for c in _CAMP)}) as changed_columns from ({_extract_sql('campaigns', 1)}) p join ({_extract_sql('campaigns', 2)}) c
        on p.CAMPAIGN_ID = c.CAMPAIGN_ID) d where changed_columns <> ''""",
    "s5_retain_changes": f"""select INTERACTION_ID, _synced from ({FIXTURES['interactions']}) s
        where _synced >= timestamp '{EVENTS_AS_OF}' - interval 2 day""",
    "s9_schema_evolve": merge_sql("campaigns", t1_null=("CUSTOMERS_ACQUIRED",)),
    "s12_with_docs": model_build("brands"),
    "g1_tag_pii": FIXTURES["customers"],
    "g2_mask_string": f"""select CUSTOMER_ID, '***MASKED***' as EMAIL, '***MASKED***' as PHONE, FIRST_NAME
        from ({FIXTURES['customers']}) c""",
    "g3_mask_date": f"""select ORDER_ID, make_date(year(cast(ORDER_DATE as date)), 1, 1) as ORDER_DAY,
        cast(ORDER_DATE as date) as ORDER_DAY_ADMIN from ({FIXTURES['orders_v1']}) o""",
    "g4_masked_view": f"""select * replace ('***MASKED***' as EMAIL, '***MASKED***' as PHONE,
        '***MASKED***' as FIRST_NAME, '***MASKED***' as LAST_NAME) from ({FIXTURES['customers']}) c""",
    "f1_or_unknown": f"select CATEGORY_ID, coalesce(CATEGORY_NAME, 'Unknown') as CATEGORY_NAME from ({FIXTURES['categories']}) c",
    "f2_clean_upper": f"select ADDRESS_ID, upper(trim(CITY)) as CITY, upper(trim(STATE)) as STATE from ({FIXTURES['addresses']}) a",
    "f3_money": f"select LINE_ID, TIE, cast(UNIT_PRICE as decimal(18,2)) as UNIT_PRICE from ({FIXTURES['order_lines']}) l",
    "f4_whole": f"""select SURVEY_ID, cast(NPS_SCORE as decimal(38,0)) as NPS_SCORE,
        cast(CSAT_SCORE / 2 as decimal(38,0)) as CSAT_HALF from ({FIXTURES['surveys']}) s""",
    "f5_to_text": f"select CAMPAIGN_ID, cast(CUSTOMERS_ACQUIRED as varchar) as CUSTOMERS_ACQUIRED from ({FIXTURES['campaigns']}) c",
    "f6_try_ts": f"select INCIDENT_ID, try_cast(INCIDENT_DATE as timestamp) as INCIDENT_DATE from ({FIXTURES['incidents']}) i",
    "f8_days_ago": f"""select INTERACTION_ID, _synced from ({FIXTURES['interactions']}) s
        where _synced >= timestamp '{EVENTS_AS_OF}' - interval 3 day""",
    "f10_is_email": f"""select CUSTOMER_ID, coalesce(regexp_matches(EMAIL, '{_re(EMAIL_MACRO_RE)}'), false) as EMAIL_OK
        from ({FIXTURES['customers']}) c""",
    "f11_regex": f"""select CUSTOMER_ID, regexp_matches(EMAIL, '{_re(EMAIL_MACRO_RE)}') as match_macro,
        regexp_matches(EMAIL, '{_re(EMAIL_TEST_RE)}') as match_test,
        regexp_matches(EMAIL, '{_re(EMAIL_COLUMN_RE)}') as match_column from ({FIXTURES['customers']}) c""",
    "f14_year_floor": f"select ORDER_ID, make_date(year(_synced), 1, 1) as ORDER_YEAR from ({FIXTURES['orders_v1']}) o",
    "f15_upper_differs": f"select CATEGORY_ID, upper(CATEGORY_ID) <> upper(CATEGORY_NAME) as DIFFERS from ({FIXTURES['categories']}) c",
})

ORACLES.update({
    "st1_micro_batch": model_build("surveys"),
    "st2_stream_upsert": model_build("order_headers"),
    "st4_stream_high_water": f"""select coalesce(max(_bronze_sync_timestamp), {MIN_TS}) as high_water
        from ({model_build('order_headers')}) m""",
})

ORACLES["f7_lit_ts"] = f"""select INCIDENT_ID, coalesce(try_cast(INCIDENT_DATE as timestamp), {MIN_TS}) as INCIDENT_AT
    from ({FIXTURES['incidents']}) i"""

_DIFF_C = _diff_sql("campaigns", "CAMPAIGN_ID", _CAMP)
ORACLES["s3_full_compare_apply"] = f"""with t as (select *, timestamp '2024-01-30 00:00:00' as _synced, false as _deleted
        from ({_extract_sql('campaigns', 1)}) p), d as ({_DIFF_C})
    select coalesce(t.CAMPAIGN_ID, d.CAMPAIGN_ID) as CAMPAIGN_ID,
        {', '.join(f"case when d.CAMPAIGN_ID is not null and (d.op <> 'delete' or t.CAMPAIGN_ID is null) then d.{c} else t.{c} end as {c}" for c in _CAMP)},
        case when d.CAMPAIGN_ID is not null then timestamp '{EVENTS_AS_OF}' else t._synced end as _synced,
        case when d.CAMPAIGN_ID is not null then d.op = 'delete' else t._deleted end as _deleted
    from t full outer join d on t.CAMPAIGN_ID = d.CAMPAIGN_ID"""

ORACLES["f9_as_of"] = f"""select INTERACTION_ID, timestamp '{EVENTS_AS_OF}' as AS_OF, _synced <= timestamp '{EVENTS_AS_OF}' as BEFORE_AS_OF,
    _synced <= cast(now() as timestamp) as BEFORE_NOW from ({FIXTURES['interactions']}) i"""
ORACLES["f12_type_name"] = f"""select ORDER_ID, upper(typeof(ORDER_ID)) as ID_TYPE, upper(typeof(TOTAL_AMOUNT)) as AMOUNT_TYPE
    from ({model_build('order_headers')}) m"""
ORACLES["f13_case_when"] = f"""select CUSTOMER_ID, case when CUSTOMER_ID % 4 in (0, 1) then EMAIL else '***MASKED***' end as EMAIL
    from ({FIXTURES['customers']}) c"""

ORACLES["s9_type_widen"] = f"select * replace (cast(CUSTOMER_ID as bigint) as CUSTOMER_ID) from ({merge_sql('order_headers')}) m"
ORACLES["s2_ingest_runs"] = f"""with t as ({_BASE}), c as (select * from (select *, row_number() over
        (partition by ORDER_ID order by _seq desc nulls first) as _rn from ({_CHANGES}) x) y where _rn = 1)
    select {', '.join(_pick(c) for c in _BIZ.split(', '))},
        case when c.ORDER_ID is not null then timestamp '{ORDERS_AS_OF}' else timestamp '2001-08-02 00:00:00' end as _synced,
        c.ORDER_ID is not null and c._op = 'D' as _deleted
    from t full outer join c on t.ORDER_ID = c.ORDER_ID"""
ORACLES["s3_ingest_compare"] = ORACLES["s3_full_compare_apply"]
