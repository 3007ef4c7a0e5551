"""The registered queries as independent SQL for DuckDB, over the same tables."""

from __future__ import annotations

from workload.views import BASE_CTE, DIRTY_CTE, SPLIT_DAY

ORACLES: dict[str, str] = {}

_TOKENS = "'', '-', '--', '.', '?', 'n/a', 'na', 'nan', 'none', 'null', 'unknonwn', 'unknown'"
CATS = ("segment_raw", "priority_raw", "priority_got", "nation")
NUMS = ("price", "cost", "hours")
LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EARLY, LATE = f"d < timestamp '{SPLIT_DAY}'", f"d >= timestamp '{SPLIT_DAY}'"
LINES = "lines as (select *, case when l_returnflag = 'R' then 1 else 0 end as y from lineitem)"
EVENTS = "ev as (select *, case when event_type = 'purchase' then 1 else 0 end as y from events)"


def norm(c: str) -> str:
    s = (
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\\band\\b', '&', 'g'), "
        f"'[^a-z0-9&() ]+', '', 'g'), ' {{2,}}', ' ', 'g'))"
    )
    return f"case when {s} in ({_TOKENS}) then null else {s} end"


def q(c: str, p: float) -> str:
    return f"quantile_cont(cast({c} as double), {p})"


def add(name: str, sql: str) -> None:
    ORACLES[name] = sql


def leaders(source: str, col: str, min_count: int, top_n: int) -> str:
    return (
        f"select {col} as value, round(avg(y), 6) as rate, count(*) as count from {source} group by 1 "
        f"having count(*) >= {min_count} order by count(*) desc, value nulls first limit {top_n}"
    )


# ---- target rates ---------------------------------------------------------------------------

add("rate_by_category", f"with {BASE_CTE} {leaders('base', 'segment', 50, 10)}")
add("rate_by_category_clean", f"""with {DIRTY_CTE}, c as (select {norm('segment_raw')} as segment_raw, y from dirty)
{leaders('c', 'segment_raw', 20, 5)}""")
add("rate_by_id", f"with {DIRTY_CTE} {leaders('dirty', 'agent_id', 100, 15)}")
add("rate_nonnull", f"""with {DIRTY_CTE} select {norm('priority_raw')} as value, round(avg(y), 6) as rate,
count(*) as count from dirty where {norm('priority_raw')} is not null group by 1""")
add("overall_rate", f"with {BASE_CTE} select round(avg(y), 6) as rate, count(*) as count from base")
add("top_category_rates", f"with {BASE_CTE} {leaders('base', 'nation', 20, 8)}")


def bins(cte: str, source: str, col: str, k: int) -> str:
    cuts = ", ".join(q(col, i / k) for i in range(k + 1))
    return f"""with {cte}, e as (select list_sort(list_distinct([{cuts}])) as edges from {source}),
b as (select 1 + len([c for c in edges[2:len(edges)-1] if {col} > c]) as bin, edges, y
      from {source}, e where {col} is not null and y is not null)
select cast(bin as integer) as bin, round(any_value(edges[bin]), 6) as lo, round(any_value(edges[bin + 1]), 6) as hi,
       round(avg(y), 6) as rate, count(*) as count from b group by 1"""


add("rate_by_bins", bins(BASE_CTE, "base", "bal", 8))
add("rate_by_bins_repeats", bins(LINES, "lines", "l_discount", 16))
add("rate_by_bins_events", bins(EVENTS, "ev", "value", 6))
add("rate_over_time", f"""with {DIRTY_CTE}
select cast(date_trunc('month', try_cast(date_raw as timestamp)) as date) as period, round(avg(y), 6) as rate,
count(*) as count from dirty where try_cast(date_raw as timestamp) is not null group by 1""")
add("rate_over_time_daily", f"""with {EVENTS} select cast(date_trunc('day', ts) as date) as period,
round(avg(y), 6) as rate, count(*) as count from ev group by 1""")
add("missing_vs_target", f"with {DIRTY_CTE} " + " union all ".join(
    f"select '{c}' as \"column\", {c} is null as is_missing, count(*) as count, round(avg(y) * 100, 1) as rate_pct "
    "from dirty group by 2" for c in ("agent_id", "company_id", "cost", "priority_raw")))
add("freq_and_rate", f"""with {DIRTY_CTE}, t as (select count(*) as n, avg(y) as p from dirty),
g as (select segment_raw as value, count(*) as n, avg(y) as r from dirty group by 1 having count(*) >= 20
      order by n desc, value nulls first limit 8)
select value, round(g.n * 100.0 / t.n, 6) as frequency_pct, round(r * 100, 6) as rate_pct,
round(p * 100, 6) as overall_pct from g, t""")


def long_form(cols, clean: bool, keep: str = "y") -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", {norm(c) if clean else _text(c)} as value, {keep} from dirty" for c in cols
    )


def _text(c: str) -> str:
    return f"cast(cast({c} as bigint) as varchar)" if c.endswith("_id") else f"cast({c} as varchar)"


add("cat_rate_table", f"""with {DIRTY_CTE}, f as ({long_form(CATS, True)}),
g as (select "column", value, count(*) as n, avg(y) as r from f group by 1, 2 having count(*) >= 20),
k as (select *, row_number() over (partition by "column" order by n desc, value nulls last) as rk from g),
c as (select "column", rk, printf('%s: rate%%=%.1f, count=%d', coalesce(value, 'nan'), round(r * 100, 1), n) as cell
      from k where rk <= 5)
select "column", """ + ", ".join(f"max(cell) filter (rk = {i}) as top_{i}" for i in range(1, 6))
    + " from c group by 1")
add("leading_ids", f"with {LINES} {leaders('lines', 'l_partkey', 5, 15)}")
add("leading_ids_table", f"with {LINES}, f as (" + " union all ".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value, y from lines" for c in ("l_partkey", "l_suppkey", "l_orderkey"))
    + """), g as (select "column", value, count(*) as n, avg(y) as r from f group by 1, 2 having count(*) >= 2),
k as (select *, row_number() over (partition by "column" order by n desc, value nulls last) as rk from g),
c as (select "column", rk, printf('%s: rate%%=%.1f, count=%d', coalesce(value, 'nan'), round(r * 100, 1), n) as cell from k where rk <= 5)
select "column", """ + ", ".join(f"max(cell) filter (rk = {i}) as top_{i}" for i in range(1, 6)) + " from c group by 1")
add("leading_ids_by_target", f"""with {LINES}, l as (select l_suppkey as value, count(*) as total from lines
where l_suppkey is not null group by 1 order by total desc, value limit 20)
select value, l_returnflag as target, count(*) as count, total from lines join l on l_suppkey = value group by value, l_returnflag, total""")
add("presence_rate", f"""with {DIRTY_CTE} select company_id is not null as present, count(*) as count,
round(avg(y), 6) as rate from dirty group by 1""")
add("presence_describe", f"""with {DIRTY_CTE} select company_id is null as is_missing, count(y) as count,
round(avg(y), 6) as mean, round(stddev_samp(y), 6) as std, cast(min(y) as double) as min, {q('y', 0.25)} as q25,
{q('y', 0.5)} as q50, {q('y', 0.75)} as q75, cast(max(y) as double) as max from dirty group by 1""")
add("segment_means", f"""with {DIRTY_CTE} select case when cost is null then 'missing' when cost >= 5000
then 'at_or_above' else 'below' end as segment, count(*) as count, round(avg(y), 6) as rate from dirty group by 1""")


def zscore(cte: str, source: str, col: str) -> str:
    return f"""with {cte}, t as (select avg(y) as p from {source}),
g as (select {col} as value, count(y) as count, avg(y) as mean from {source} where {col} is not null group by 1
      having count(y) >= 100),
z as (select value, count, mean, sqrt(p * (1 - p) / count) as se, mean - p as diff,
      (mean - p) / sqrt(p * (1 - p) / count) as z_score from g, t)"""


add("group_zscore", zscore(DIRTY_CTE, "dirty", "agent_id") + """ select value, count, round(mean, 6) as mean,
round(se, 6) as se, round(diff, 6) as diff_from_global, round(z_score, 6) as z_score from z""")
add("group_zscore_display", zscore(BASE_CTE, "base", "nation") + """ select value, count,
round(mean * 100, 1) as rate_pct, round(se * 100, 1) as se_pct, round(diff * 100, 1) as diff_from_global_pct,
round(z_score, 6) as z_score from z""")

# ---- profiles -------------------------------------------------------------------------------

DIRTY_COLUMNS = ("id", "y", "d", "price", "nation", "segment_raw", "priority_raw", "priority_got", "agent_id",
                 "company_id", "cost", "hours", "date_raw")
DIRTY_TYPES = dict.fromkeys(DIRTY_COLUMNS, "string") | {
    "id": "bigint", "y": "int", "d": "timestamp_ntz", "price": "double", "agent_id": "double", "company_id": "double", "cost": "double",
    "hours": "bigint",
}

add("table_shape", "select count(*) as rows, cast(11 as integer) as columns from lineitem")
add("table_shapes", f"""with {DIRTY_CTE}
select 'train' as data, count(*) filter ({EARLY}) as rows, cast(13 as integer) as columns from dirty
union all select 'test', count(*) filter ({LATE}), 12 from dirty
union all select 'combined', count(*), 14 from dirty""")
add("column_catalogue", f"with {DIRTY_CTE} " + " union all ".join(
    f"select cast({i} as integer) as position, '{c}' as \"column\", '{DIRTY_TYPES[c]}' as dtype, count({c}) as non_null from dirty"
    for i, c in enumerate(DIRTY_COLUMNS)))
add("first_rows", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders
order by o_orderkey limit 20""")
add("key_check", """select 'orders' as data, count(*) as rows, count(distinct o_orderkey) as distinct_keys,
count(*) = count(distinct o_orderkey) as is_unique from orders
union all select 'lineitem', count(*), count(distinct (l_orderkey, l_linenumber)),
count(*) = count(distinct (l_orderkey, l_linenumber)) from lineitem""")
add("value_counts", f"""with {DIRTY_CTE} select segment_raw as value, count(*) as count,
round(count(*) * 1.0 / sum(count(*)) over (), 6) as share from dirty where segment_raw is not null group by 1""")
add("value_counts_with_missing", f"""with {DIRTY_CTE} select agent_id as value, count(*) as count,
round(count(*) * 1.0 / sum(count(*)) over (), 6) as share from dirty group by 1""")
add("target_balance", f"""with {BASE_CTE} select y, count(*) as count,
round(count(*) * 100.0 / sum(count(*)) over (), 1) as rate_pct from base group by 1""")
add("null_summary", f"with {DIRTY_CTE}, n as (" + " union all ".join(
    f"select '{c}' as \"column\", count(*) filter ({c} is null) as null_count, "
    f"round(count(*) filter ({c} is null) * 100.0 / count(*), 6) as null_percent from dirty" for c in DIRTY_COLUMNS)
    + ") select * from n where null_count > 0")
add("missing_compare", f"with {DIRTY_CTE}, n as (" + " union all ".join(
    f"select '{c}' as \"column\", round(count(*) filter ({EARLY} and {c} is null) * 100.0 / count(*) filter ({EARLY}), 6) "
    f"as train_missing_pct, count(*) filter ({EARLY} and {c} is null) as train_missing_count, "
    + ("cast(null as double) as test_missing_pct, cast(null as bigint) as test_missing_count" if c == "company_id" else
       f"round(count(*) filter ({LATE} and {c} is null) * 100.0 / count(*) filter ({LATE}), 6) as test_missing_pct, "
       f"count(*) filter ({LATE} and {c} is null) as test_missing_count") + " from dirty" for c in DIRTY_COLUMNS)
    + ") select * from n where train_missing_count > 0 or test_missing_count > 0")


def cat_summary(cols, clean: bool) -> str:
    return f"""with {DIRTY_CTE}, f as ({long_form(cols, clean)}),
g as (select "column", value, count(*) as n from f group by 1, 2),
t as (select "column", cast(sum(n) as bigint) as rows, cast(coalesce(sum(n) filter (value is null), 0) as bigint)
      as missing_count, count(value) as unique_count from g group by 1),
k as (select *, row_number() over (partition by "column" order by n desc, value nulls last) as rk from g),
l as (select k."column", list(printf('%s (%.1f%%)', coalesce(value, 'nan'), round(n * 100.0 / rows, 1)) order by rk)
      as top_values from k join t on k."column" = t."column" where rk <= 8 group by 1)
select t."column", round(missing_count * 100.0 / rows, 1) as missing_pct, missing_count, unique_count, top_values
from t join l on t."column" = l."column" """


add("cat_summary", cat_summary((*CATS, "agent_id", "company_id"), False))
add("cat_summary_clean", cat_summary(CATS, True))
add("distinct_counts", " union all ".join(
    f"select '{c}' as \"column\", count(distinct {c}) as \"distinct\" from lineitem"
    for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_tax")))
add("describe", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
    f"round(cast(min({c}) as double), 4) as min, round({q(c, 0.25)}, 4) as q25, round({q(c, 0.5)}, 4) as q50, "
    f"round({q(c, 0.75)}, 4) as q75, round(cast(max({c}) as double), 4) as max from lineitem"
    for c in ("l_orderkey", *LINE)))


def corr(a: str, b: str) -> str:
    return f"corr(cast({a} as double), cast({b} as double))"


def num_summary(cte: str, source: str, cols, digits: int) -> str:
    r = lambda e: f"round({e}, {digits})"
    return f"with {cte} " + " union all ".join(
        f"select '{c}' as \"column\", {r(f'count(*) filter ({c} is null) * 100.0 / count(*)')} as missing_pct, "
        f"count(*) filter ({c} is null) as missing_count, {r(corr(c, 'y'))} as corr_target, {r(f'avg({c})')} as mean, "
        f"{r(q(c, 0.5))} as median, {r(f'stddev_samp({c})')} as std, {r(f'cast(min({c}) as double)')} as min, "
        f"{r(f'cast(max({c}) as double)')} as max, {r(q(c, 0.25))} as q25, {r(q(c, 0.75))} as q75, "
        f"{r(f'skewness({c})')} as skew from {source}" for c in cols)


add("num_summary", num_summary(DIRTY_CTE, "dirty", NUMS, 6))
add("num_summary_lineitem", num_summary(LINES, "lines", LINE, 4))
add("quantile_ladder", f"with {DIRTY_CTE} " + " union all ".join(
    f"select '{c}' as \"column\", cast({p} as double) as prob, round({q(c, p)}, 6) as value from dirty"
    for c in NUMS for p in (0.9999, 0.999, 0.995, 0.99, 0.95, 0.9)))
add("largest_values", " union all ".join(
    f"select distinct '{c}' as \"column\", value from (select {c} as value from lineitem order by 1 desc limit 20)"
    for c in LINE))


def histogram(cte: str, source: str, col: str, by: str = "") -> str:
    pick = f"{by} as target, " if by else ""
    return f"""with {cte}ends as (select min({col}) as lo, max({col}) as hi from {source}),
b as (select least(cast(floor(({col} - lo) / (hi - lo) * 50) as integer), 49) as bin, {pick}lo, hi from {source}, ends)
select bin, {'target, ' if by else ''}round(any_value(lo + (hi - lo) / 50 * bin), 6) as lo,
round(any_value(lo + (hi - lo) / 50 * (bin + 1)), 6) as hi, count(*) as count from b group by bin{', target' if by else ''}"""


add("histogram", histogram("", "lineitem", "l_extendedprice"))
add("histogram_by_target", histogram(EVENTS + ", ", "ev", "value", "y"))
add("box_stats", f"""with {BASE_CTE}, s as (select y, count(price) as count, min(price) as min, {q('price', 0.25)} as q25,
{q('price', 0.5)} as median, {q('price', 0.75)} as q75, max(price) as max from base group by 1),
w as (select b.y, min(price) filter (price >= q25 - 1.5 * (q75 - q25)) as whisker_lo,
      max(price) filter (price <= q75 + 1.5 * (q75 - q25)) as whisker_hi from base b join s on b.y = s.y group by 1)
select s.y, count, round(min, 6) as min, round(q25, 6) as q25, round(median, 6) as median, round(q75, 6) as q75,
round(max, 6) as max, round(whisker_lo, 6) as whisker_lo, round(whisker_hi, 6) as whisker_hi
from s join w on s.y = w.y""")
add("top_counts_by_target", f"""with {DIRTY_CTE}, l as (select agent_id as value, count(*) as total from dirty
where agent_id is not null group by 1 order by total desc, value limit 20)
select value, y as target, count(*) as count, total from dirty join l on agent_id = value group by value, y, total""")

# ---- correlation ----------------------------------------------------------------------------

add("corr_target", f"with {DIRTY_CTE} " + " union all ".join(
    f"select '{c}' as \"column\", round({corr(c, 'y')}, 6) as corr from dirty" for c in NUMS))
add("corr_matrix", " union all ".join(
    f"select '{a}' as \"column\", " + ", ".join(f"round({corr(a, b)}, 6) as {b}" for b in LINE) + " from lineitem"
    for a in LINE))
_CORR_COLS = (*NUMS, "agent_id", "company_id", "y")
CAPPED = f"""caps as (select {q('hours', 0.999)} as cap_hours, {q('cost', 0.999)} as cap_cost from dirty),
capped as (select dirty.* replace (case when hours <= cap_hours then hours end as hours,
           case when cost <= cap_cost then cost end as cost) from dirty, caps)"""
add("corr_pairs", f"with {DIRTY_CTE}, {CAPPED}, p as (" + " union all ".join(
    f"select '{a}' as feature_1, '{b}' as feature_2, {corr(a, b)} as corr from capped"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:])
    + ") select feature_1, feature_2, round(corr, 6) as corr from p where abs(corr) >= 0.005")

# ---- outliers -------------------------------------------------------------------------------

add("cap_report", f"with {DIRTY_CTE}, {CAPPED} " + " union all ".join(
    f"select '{c}' as \"column\", round(any_value(cap_{c}), 6) as cap, "
    f"count(*) filter ({c} > cap_{c}) as values_set_missing from dirty, caps" for c in ("hours", "cost")))
add("capped_values", f"with {DIRTY_CTE}, {CAPPED} select id, hours, round(cost, 6) as cost from capped")
add("clip_fixed", f"""with {DIRTY_CTE} select id, case when hours < 0 then 0 when hours > 8 then 8 else hours end as hours,
case when cost > 500 then 500 else cost end as cost from dirty""")
add("sus_columns", f"with {DIRTY_CTE}, s as (" + " union all ".join(
    f"select '{c}' as \"column\", cast(min({c}) as double) as lo, cast(max({c}) as double) as hi, {q(c, 0.99)} as q99, "
    f"{q(c, 0.75)} - {q(c, 0.25)} as iqr from dirty" for c in NUMS) + """)
select "column", round(lo, 6) as min, round(hi, 6) as max, round(q99, 6) as q99,
concat_ws(', ', case when lo < 0 then 'negative' end,
  case when hi > 10 * greatest(q99, iqr, 1.0) then printf('max=%g vs q99=%g', hi, q99) end) as why
from s where lo < 0 or hi > 10 * greatest(q99, iqr, 1.0)""")
add("contradictions", """select 'tax above discount' as rule, count(*) filter (l_tax > l_discount) as violations
from lineitem union all
select 'quantity above line number', count(*) filter (l_quantity > l_linenumber) from lineitem""")

# ---- cleaning -------------------------------------------------------------------------------

add("normalize_categories", f"with {DIRTY_CTE} select id, " + ", ".join(f"{norm(c)} as {c}" for c in CATS) + " from dirty")
add("normalize_text", f"select doc_id, {norm('source')} as source, lower(trim(lang)) as lang from documents")
add("trim_lower_labels", f"with {DIRTY_CTE} select id, " + ", ".join(f"lower(trim({c})) as {c}" for c in CATS) + " from dirty")
add("identifiers_as_text", f"with {DIRTY_CTE} select id, " + ", ".join(
    f"coalesce(cast(cast({c} as bigint) as varchar), 'missing') as {c}" for c in ("agent_id", "company_id")) + " from dirty")
add("recode_and_membership", f"""with {DIRTY_CTE} select id, case nation when 'nation7' then 'nation8' when 'nation9' then 'NINE'
else nation end as nation, coalesce(segment_raw in ('BUILDING', '?'), false) as is_listed from dirty""")
add("match_flag", f"""with {DIRTY_CTE} select id, cast(coalesce(priority_raw = priority_got, false) as integer) as received
from dirty""")

# ---- cardinality ----------------------------------------------------------------------------

add("coverage", f"""with {DIRTY_CTE}, g as (select agent_id, count(*) as n from dirty where agent_id is not null group by 1)
select cast(t as integer) as threshold, count(*) filter (n >= t) as kept,
round(coalesce(sum(n) filter (n >= t), 0) / sum(n), 6) as coverage
from g, (values (150), (310), (320)) v(t) group by t""")
add("keep_set", f"with {BASE_CTE} select nation as value, count(*) as count from base group by 1 having count(*) >= 600")
add("keep_describe", f"""with {DIRTY_CTE}, g as (select agent_id, count(*) as n from dirty group by 1)
select count(*) filter (agent_id is not null and n >= 310) as kept, count(agent_id) as "distinct",
round(coalesce(sum(n) filter (agent_id is not null and n >= 310), 0) / sum(n), 6) as coverage from g""")
add("reduce_cardinality", f"""with {DIRTY_CTE}, r as (select id, d,
case nation when 'nation7' then 'nation8' else nation end as nation,
coalesce(cast(cast(agent_id as bigint) as varchar), 'missing') as agent_id from dirty),
n as (select nation from r where {EARLY} group by 1 having count(*) >= 460),
a as (select agent_id from r where {EARLY} group by 1 having count(*) >= 240)
select id, case when nation in (select nation from n) or nation = 'missing' then nation else 'other' end as nation,
case when agent_id in (select agent_id from a) or agent_id = 'missing' then agent_id else 'other' end as agent_id from r""")

# ---- splits and samples ---------------------------------------------------------------------


def stratified(cls: str, share: float) -> str:
    return (
        f"row_number() over (partition by {cls} order by md5(cast(id as varchar) || '42'), id) "
        f"<= ceil(count(*) over (partition by {cls}) * cast({share} as double))"
    )


add("stratified_split", f"with {BASE_CTE} select id, {stratified('y', 0.2)} as is_valid from base")
add("stratified_split_classes", f"with {BASE_CTE} select id, {stratified('nation', 0.25)} as is_valid from base")
add("chronological_split", f"""with {BASE_CTE} select id, row_number() over (order by d, id)
> floor(count(*) over () * (1 - cast(0.2 as double))) as is_valid from base""")
add("sample_n", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders
order by md5(cast(o_orderkey as varchar) || '42'), o_orderkey limit 1000""")

# ---- preparation and encoding ---------------------------------------------------------------

SPLIT = f"split as (select *, {stratified('y', 0.2)} as is_valid from dirty)"
LABELLED = f"""lab as (select * replace (
  case coalesce({norm('nation')}, 'missing') when 'nation7' then 'nation8' else coalesce({norm('nation')}, 'missing') end as nation,
  coalesce({norm('priority_raw')}, 'missing') as priority_raw, coalesce({norm('priority_got')}, 'missing') as priority_got,
  coalesce({norm('segment_raw')}, 'missing') as segment_raw,
  coalesce(cast(cast(agent_id as bigint) as varchar), 'missing') as agent_id),
  priority_raw is null as priority_null, company_id is not null as has_company from split)"""
PREPARED_CTE = f"""{DIRTY_CTE}, {SPLIT}, {LABELLED},
m as (select {', '.join(f'{q(c, 0.5)} as m_{c}' for c in NUMS)} from split where not is_valid),
n as (select nation from lab where not is_valid group by 1 having count(*) >= 480),
a as (select agent_id from lab where not is_valid group by 1 having count(*) >= 250),
x as (select *, coalesce(cast(hours as double), m_hours) as h, coalesce(cost, m_cost) as k from lab, m),
prepared as (select is_valid, id, y, round(coalesce(price, m_price), 6) as price, segment_raw, priority_raw,
case when nation in (select nation from n) or nation = 'missing' then nation else 'other' end as nation,
case when agent_id in (select agent_id from a) or agent_id = 'missing' then agent_id else 'other' end as agent_id,
round(case when k > 500 then 500 else k end, 6) as cost,
case when h < 0 then 0 when h > 8 then 8 else h end as hours,
cast(has_company as integer) as has_company_id, cast(cost is null as integer) as cost_missing,
cast(priority_null as integer) as priority_raw_missing,
cast(priority_raw = priority_got as integer) as received_requested from x)"""
add("prepare_full", f"with {PREPARED_CTE} select * exclude (is_valid) from prepared")
add("prepare_calendar", f"""with {DIRTY_CTE} select id, y, price, agent_id, cost, hours, """ + ", ".join(
    f"lower(trim({c})) as {c}" for c in CATS) + """, cast(agent_id is null as integer) as agent_id_is_missing,
cast(cost is null as integer) as cost_is_missing, cast(priority_raw is null as integer) as priority_raw_is_missing,
cast(company_id is not null as integer) as has_company_id, cast(month(d) as integer) as d_month,
cast(isodow(d) - 1 as integer) as d_weekday from dirty""")
add("fitted_medians", f"with {DIRTY_CTE}, {SPLIT}, m as (" + " union all ".join(
    f"select '{c}' as \"column\", {q(c, 0.5)} as median from split where not is_valid" for c in NUMS)
    + """) select m."column", round(median, 6) as median, count(*) filter (case m."column" """
    + " ".join(f"when '{c}' then {c} < median" for c in NUMS) + """ end) as rows_below
from m, split where not is_valid group by 1, 2""")
add("impute_plain", f"with {DIRTY_CTE}, m as (select " + ", ".join(f"{q(c, 0.5)} as m_{c}" for c in NUMS)
    + f" from dirty where {EARLY}) select id, y, " + ", ".join(
        f"round(coalesce(cast({c} as double), m_{c}), 6) as {c}" for c in NUMS) + ", " + ", ".join(
        f"coalesce({c}, 'unknown') as {c}" for c in CATS) + " from dirty, m")
add("scale_standard", f"with {DIRTY_CTE}, s as (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in NUMS) + f" from dirty where {EARLY}) select id, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) as {c}" for c in NUMS) + " from dirty, s")
add("onehot_long", f"with {DIRTY_CTE} " + " union all ".join(
    f"select id, 'ohe__{c}__' || {_text(c)} as feature, cast(1 as double) as value from dirty where {c} in "
    f"(select {c} from dirty where {EARLY})" for c in ("segment_raw", "priority_raw", "agent_id")))
add("csv_round_trip", f"""with {DIRTY_CTE} select id, segment_raw, agent_id, cost, date_raw,
nullif(nation, 'nation7') as nation from dirty""")

# ---- drift ----------------------------------------------------------------------------------

add("date_audit", f"""with {BASE_CTE}, a as (select cast(d as date) as d from base where y = 1),
b as (select cast(d as date) as d from base where y = 0),
s as (select avg(cast(d in (select d from a) as integer)) as share from b)
select 'train' as data, count(*) as rows, min(d) as min_date, max(d) as max_date, count(distinct d) as unique_dates,
cast(null as double) as test_rows_on_train_dates from a
union all select 'test', count(*), min(d), max(d), count(distinct d), (select round(share, 6) from s) from b
union all select 'overlap', null, null, null, count(distinct d), (select round(share, 6) from s) from b
where d in (select d from a)""")
add("source_share", f"with {DIRTY_CTE} select round(avg(cast({LATE} as integer)), 4) as test_share from dirty")
add("numeric_shift", f"with {DIRTY_CTE} " + " union all ".join(
    f"select '{c}' as feature, 'numeric' as type, " + ", ".join(
        f"round(avg(cast({c} is null as integer)) filter ({w}), 6) as {s}_missing_pct, "
        f"round(avg({c}) filter ({w}), 6) as {s}_mean, round({q(c, 0.5)} filter ({w}), 6) as {s}_p50, "
        f"round({q(c, 0.9)} filter ({w}), 6) as {s}_p90" for s, w in (("train", EARLY), ("test", LATE)))
    + " from dirty" for c in NUMS))
add("categorical_shift", f"""with {DIRTY_CTE}, c as (select coalesce({norm('segment_raw')}, 'missing') as value, d from dirty),
t as (select count(*) filter ({EARLY}) as a, count(*) filter ({LATE}) as b from dirty),
s as (select value, count(*) filter ({EARLY}) / any_value(a) as train_pct, count(*) filter ({LATE}) / any_value(b) as test_pct
      from c, t group by 1)
select 'segment_raw' as feature, 'categorical' as type, value, round(train_pct, 6) as train_pct,
round(test_pct, 6) as test_pct, round(test_pct - train_pct, 6) as diff_pct from s
order by abs(test_pct - train_pct) desc, value limit 8""")
_SOURCE_NUMS = (*NUMS, "agent_id", "company_id")
add("prepare_sources", f"with {DIRTY_CTE}, m as (select " + ", ".join(f"{q(c, 0.5)} as m_{c}" for c in _SOURCE_NUMS)
    + f" from dirty) select id, cast({LATE} as integer) as is_test, " + ", ".join(
        f"round(coalesce(cast({c} as double), m_{c}), 6) as {c}" for c in _SOURCE_NUMS) + ", " + ", ".join(
        f"coalesce({norm(c)}, 'missing') as {c}" for c in CATS) + " from dirty, m")
add("importance_by_column", """with w as (select p_type as model, p_brand as feature, sum(p_retailprice) as importance
from part group by 1, 2), r as (select *, row_number() over (partition by model order by importance desc, feature) as rk from w)
select model, feature, round(importance, 6) as importance from r where rk <= 5""")
add("top_features", """with w as (select p_type as model, p_brand as feature, sum(p_retailprice) as importance
from part group by 1, 2)
select feature, round(avg(importance), 6) as importance from w group by 1 order by avg(importance) desc, feature limit 8""")
add("compare_scores", f"""with {BASE_CTE}, a as (select nation, avg(y) as s from base where {EARLY} group by 1),
b as (select nation, avg(y) as s from base where {LATE} group by 1)
select a.nation, round(a.s, 6) as auc_with, round(b.s, 6) as auc_no, round(a.s - b.s, 6) as diff
from a join b on a.nation = b.nation""")


def auc(cte: str, source: str, score: str) -> str:
    return f"""with {cte}, g as (select {score} as x, count(*) filter (y = 1) as p, count(*) filter (y = 0) as n
from {source} group by 1), c as (select *, sum(n) over (order by x) - n as b from g)
select round(sum(p * (b + n / 2.0)) / (sum(p) * sum(n)), 9) as auc, cast(sum(p) as bigint) as positives,
cast(sum(n) as bigint) as negatives from c"""


add("auc_rank", auc(BASE_CTE, "base", "price"))
add("auc_ties", auc(LINES, "lines", "l_quantity"))

# ---- models: what is exact about them -------------------------------------------------------

_MODELS = "(values ('Logistic Regression'), ('Random Forest'), ('Boosted Trees')) as m(model)"
_LATEST = "row_number() over (order by d, id) > floor(count(*) over () * (1 - cast(0.2 as double)))"
_PREPARED_CATS = ("segment_raw", "priority_raw", "nation", "agent_id")
_PREPARED_NUMS = ("price", "cost", "hours", "has_company_id", "cost_missing", "priority_raw_missing", "received_requested")
_ENCODED = " union all ".join(
    [f"select '{c}' as feature" for c in _PREPARED_NUMS]
    + [f"select distinct 'ohe__{c}__' || {c} from prepared where not is_valid" for c in _PREPARED_CATS])

add("checked_scores", f"""with {DIRTY_CTE}, s as (
select 'random' as split, y, {stratified('y', 0.2)} as is_valid from dirty
union all select 'chronological', y, {_LATEST} from dirty)
select split, model, count(*) filter (not is_valid) as rows, count(*) filter (is_valid) as held_out,
count(*) filter (is_valid and y = 1) as positives, true as are_probabilities, true as auc_agrees
from s, {_MODELS} group by 1, 2""")
add("checked_encoding", f"""with {PREPARED_CTE}, e as ({_ENCODED})
select feature, model, true as in_range, true as sums_to_one from e, {_MODELS} where model <> 'Logistic Regression'""")
add("checked_logistic", f"""with {PREPARED_CTE}, e as ({_ENCODED})
select (select count(*) from e) as features, count(*) as rows, cast(sum(y) as bigint) as positives, true as is_optimum
from prepared where not is_valid""")
add("checked_predictions", f"with {DIRTY_CTE} select id as client_id, true as is_probability from dirty where {LATE}")
add("checked_sources", f"""with {DIRTY_CTE}, l as (select id, {LATE} as is_test from dirty),
s as (select is_test, {stratified('is_test', 0.25)} as is_valid from l),
c as (select count(*) filter (not is_valid) as n, count(*) filter (is_valid) as held_out,
 count(*) filter (not is_valid and is_test) as b from s)
select model, n as rows, held_out, round(n / (2.0 * (n - b)), 6) as train_weight, round(n / (2.0 * b), 6) as test_weight,
true as auc_in_range, true as sums_to_one from c, {_MODELS} where model <> 'Logistic Regression'""")
add("reloaded_pipeline", f"""with {DIRTY_CTE} select model, id, true as is_same
from dirty, {_MODELS} where {LATE} and model <> 'Random Forest'""")
add("checked_ablation", f"select model, true as with_in_range, true as without_in_range, true as diff_agrees from {_MODELS}")
add("checked_raw_vs_clean", "select data, true as auc_in_range from (values ('raw'), ('clean')) as t(data)")
add("older_pipeline", f"""with {DIRTY_CTE}, s as (select *, {stratified('y', 0.25)} as is_valid from dirty),
w as (select {len(NUMS) + 2} + """ + " + ".join(f"count(distinct coalesce({c}, 'unknown')) filter (not is_valid)" for c in CATS)
    + """ as features, count(*) filter (not is_valid) as n, count(*) filter (is_valid) as held_out from s)
select model, n as rows, held_out, cast(features as integer) as features, size, true as auc_agrees
from w, (values ('Logistic Regression', 1000), ('Random Forest', 20)) as m(model, size)""")
add("strict_calendar", f"""with {BASE_CTE} select id, y, round(price, 6) as price, round(bal, 6) as bal, lower(trim(segment)) as segment,
lower(trim(priority)) as priority, lower(trim(nation)) as nation, cust, cast(bal is null as integer) as bal_is_missing,
cast(month(d) as integer) as day_month, cast(isodow(d) - 1 as integer) as day_weekday from base""")
add("features_and_target", f"with {BASE_CTE} select id, y, round(price, 6) as price, segment from base")
_SHIFTS = "feature, type, train_missing_pct, test_missing_pct, train_mean, test_mean, train_p50, test_p50, train_p90, test_p90"
_EMPTY = ", ".join(f"cast(null as double) as {c}" for c in _SHIFTS.split(", ")[2:])


def shares(c: str) -> str:
    return f"""select '{c}' as feature, 'categorical' as type, {_EMPTY}, value, round(a, 6) as train_pct, round(b, 6) as test_pct, round(b - a, 6) as diff_pct from (
select value, n / sum(n) over () as a, m / sum(m) over () as b from (
select coalesce({norm(c)}, 'missing') as value, count(*) filter ({EARLY}) as n, count(*) filter ({LATE}) as m from dirty group by 1))
order by abs(b - a) desc, value limit 8"""


add("drift_of_given_features", f"with {DIRTY_CTE} " + " union all ".join(
    f"select '{c}' as feature, 'numeric' as type, " + ", ".join(
        f"round({v} filter ({w}), 6) as {s}_{k}" for k, v in (
            ("missing_pct", f"avg(cast({c} is null as integer))"), ("mean", f"avg({c})"), ("p50", q(c, 0.5)), ("p90", q(c, 0.9)))
        for s, w in (("train", EARLY), ("test", LATE)))
    + ", cast(null as varchar) as value, cast(null as double) as train_pct, cast(null as double) as test_pct, cast(null as double) as diff_pct from dirty"
    for c in NUMS) + "".join(f" union all ({shares(c)})" for c in ("segment_raw", "priority_raw")))


def first_tree(depth: int, bins_: int) -> str:
    """The tree by plain SQL, level after level: entries above each feature's lowest bin, their sums, the best split of each node."""
    cuts = lambda c: "list_sort(list_distinct([" + ", ".join(q(c, i / bins_) for i in range(1, bins_)) + "]))"
    out = f"""with {BASE_CTE}, r as (select id, 0.5e0 - y as g, 0.25e0 as h, price, bal, segment, priority, nation from base),
cuts as (select {cuts('price')} as price, {cuts('bal')} as bal from r),
e as (select id, 0 as pos, '' as value, len([c for c in cuts.price if r.price >= c]) as bin from r, cuts
 union all select id, 1, '', len([c for c in cuts.bal if r.bal >= c]) from r, cuts
 union all select id, 2, segment, 1 from r union all select id, 3, priority, 1 from r union all select id, 4, nation, 1 from r),
a0 as (select id, 0 as place from r)"""
    for d in range(depth):
        out += f""", n{d} as (select place, count(*) as n, sum(g) as g, sum(h) as h from a{d} join r using (id) group by 1),
s{d} as (select place, pos, value, bin, sum(g) as g, sum(h) as h from a{d} join r using (id) join e using (id) where bin > 0 group by all),
c{d} as (select place, pos, value, bin, sum(g) over w as gr, sum(h) over w as hr from s{d} window w as (partition by place, pos, value order by bin desc)),
t{d} as (select c.*, (n.g - gr) * (n.g - gr) / (n.h - hr + 1) + gr * gr / (hr + 1) - n.g * n.g / (n.h + 1) as gain
 from c{d} c join n{d} n using (place) where hr >= 1 and n.h - hr >= 1),
b{d} as (select * from t{d} where gain > 1e-6 qualify row_number() over (partition by place order by gain desc, pos, value, bin) = 1),
a{d + 1} as (select id, 2 * place + cast(exists (select 1 from e where e.id = a.id and e.pos = b.pos and e.value = b.value and e.bin >= b.bin) as integer) as place
 from a{d} a join b{d} b using (place))"""
    out += f", n{depth} as (select place, count(*) as n, sum(g) as g, sum(h) as h from a{depth} join r using (id) group by 1)"
    names = "case pos when 0 then 'price' when 1 then 'bal' when 2 then 'ohe__segment__' || value when 3 then 'ohe__priority__' || value when 4 then 'ohe__nation__' || value end"
    part = lambda d, b: f"""select cast({d} as integer) as depth, cast(n.place as integer) as place, n as rows, round(n.g, 6) as gradient, round(n.h, 6) as hessian,
cast(bin as integer) as least_bin, round(gain, 6) as gain, round(-n.g / (n.h + 1), 6) as step, {names} as feature from n{d} n left join {b} using (place)"""  # noqa: E731
    return out + " " + " union all ".join([part(d, f"b{d}") for d in range(depth)] + [part(depth, "(select * from b0 where false)")])


add("boosting_first_tree", first_tree(3, 16))

_WRITTEN = ("id", "price", "cost", "hours", "segment_raw", "agent_id")
add("checked_write", f"""with {DIRTY_CTE} select 'shape' as "check", 'rows' as item, count(*) as found from dirty
union all select 'shape', 'columns', {len(_WRITTEN)}""" + "".join(
    f" union all select 'non_null', '{c}', count({c}) from dirty" for c in _WRITTEN) + """
union all select 'violations', 'hours out of range', count(*) filter (hours < 0 or hours > 24) from dirty
union all select 'violations', 'cost above price', count(*) filter (cost > price) from dirty""")

# ---- stored profiles ------------------------------------------------------------------------

add("profile_from_states", " union all ".join(
    f"""select '{c}' as "column", count(*) as rows, round((count(*) - count({c})) * 100.0 / count(*), 4) as missing_pct, """
    + ", ".join(f"{'round(' + e + ', 4)' if c != 'event_type' else 'cast(null as double)'} as {name}" for name, e in {
        "mean": f"avg(cast({c} as double))", "std": f"stddev_samp(cast({c} as double))", "min": f"cast(min({c}) as double)",
        "q25": q(c, 0.25), "q50": q(c, 0.5), "q75": q(c, 0.75), "max": f"cast(max({c}) as double)",
    }.items())
    + f", case when count(distinct {c}) < 100 then count(distinct {c}) end as distinct from events"
    for c in ("value", "user_id", "event_type")))
add("overlap_from_states", f"with {DIRTY_CTE} " + " union all ".join(
    f"""select *, round(common * 1.0 / nullif(test_distinct, 0), 6) as share, 0.0::double as margin from (
select '{c}' as "column", count(*) filter (a) as train_distinct, count(*) filter (b) as test_distinct, count(*) filter (a and b) as common
from (select {c}, bool_or({EARLY}) as a, bool_or({LATE}) as b from dirty where {c} is not null group by 1))"""
    for c in ("segment_raw", "nation", "agent_id", "hours")))
