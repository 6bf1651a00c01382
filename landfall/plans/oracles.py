"""DuckDB statements of what each registered query must return.

They run on the same Parquet tables (registered as views). DuckDB's own casts
are more lenient than ours in places (``try_cast('3.7' as int)`` is 4 there),
so whole-number text is guarded by a pattern, exactly as the rule in
:mod:`landfall.functions.casts` states it. Types are cast explicitly where the
engines differ (DuckDB sums to DECIMAL(38,s) and HUGEINT, ``year()`` to BIGINT).
"""

from __future__ import annotations

from landfall.functions.casts import FALSE_WORDS, TRUE_WORDS
from landfall.plans import fixtures as fx
from landfall.plans.queries import CATALOG, EXTRACT_SQL, FAILING_STEPS, STEPS
from landfall.sources.jdbc import clean_query

LINEITEM_COLUMNS = [s.name for s in fx.LINEITEM_RULE.specs]
ORDERS_COLUMNS = [s.name for s in fx.ORDERS_RULE.specs]
CUSTOMER_COLUMNS = [s.name for s in fx.CUSTOMER_RULE.specs]


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _dirty_cte() -> str:
    cols = []
    for c in LINEITEM_COLUMNS:
        expr = f"cast({c} as varchar)"
        for column, modulus, bad in fx.DIRTY_RULES:
            if column == c:
                expr = f"case when l_orderkey % {modulus} = 0 then '{bad}' else {expr} end"
        cols.append(f"{expr} as {c}")
    return "dirty as (select " + ", ".join(cols) + " from lineitem)"


def _parse(raw: str, type_name: str, formats: tuple[str, ...]) -> str:
    t = type_name.lower()
    text = f"trim({raw})"
    if t in ("int", "bigint"):
        return f"case when regexp_matches({text}, '^[+-]?[0-9]+$') then try_cast({text} as {t}) end"
    if t.startswith("decimal"):
        return f"try_cast({text} as {t})"
    if t == "timestamp":
        parts = []
        for f in formats:
            if f == "iso":
                parts.append(f"try_cast({text} as timestamp)")
            elif f == "dd.MM.yyyy":
                parts.append(f"try_strptime({text}, '%d.%m.%Y')")
            elif f == "MM/dd/yyyy":
                parts.append(f"try_strptime({text}, '%m/%d/%Y')")
            else:
                raise ValueError(f)
        return f"coalesce({', '.join(parts)})" if len(parts) > 1 else parts[0]
    if t == "string":
        return raw
    raise ValueError(type_name)


def _blank(raw: str) -> str:
    return f"({raw} is null or trim({raw}) = '')"


def _typed_ctes(rule=fx.LINEITEM_RULE, source: str = "dirty") -> str:
    """``typed``: typed columns plus ``bad_<col>`` flags and ``rejected``."""
    cols, flags = [], []
    for s in rule.specs:
        parsed = _parse(s.name, s.type, s.formats)
        cols.append(f"{parsed} as {s.name}")
        if s.type == "string":
            continue
        bad = f"(not {_blank(s.name)} and {parsed} is null)"
        if not s.nullable:
            bad = f"({bad} or {_blank(s.name)})"
        flags.append((s, bad))
    flag_cols = [f"{bad} as bad_{s.name}, {s.name} as raw_{s.name}" for s, bad in flags]
    rejected = " or ".join(f"bad_{s.name}" for s, _ in flags)
    return (
        f"typed0 as (select {', '.join(cols)}, {', '.join(flag_cols)} from {source}),\n"
        f"typed as (select *, ({rejected}) as rejected from typed0)"
    )


def _expected(spec) -> str:
    return spec.type if spec.nullable else f"{spec.type} not null"


def _latest_lines(source: str, money: bool) -> str:
    """Latest line per (l_orderkey, l_linenumber) under the library's total order."""
    m = fx.MONEY
    if money:
        cols = (
            "l_orderkey, l_partkey, l_suppkey, l_linenumber, "
            + ", ".join(f"cast({c} as {m}) as {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
            + ", l_returnflag, l_linestatus, l_shipdate"
        )
    else:
        cols = ", ".join(LINEITEM_COLUMNS)
    rest = [c for c in LINEITEM_COLUMNS if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    order = "l_shipdate desc nulls last, " + ", ".join(f"{c} asc nulls last" for c in rest)
    return (
        f"select {', '.join(LINEITEM_COLUMNS)} from ("
        f"select *, row_number() over (partition by l_orderkey, l_linenumber order by {order}) as rn "
        f"from (select {cols} from {source})) where rn = 1"
    )


def _text_select(columns: list[str], table: str) -> str:
    return f"select {', '.join(f'cast({c} as varchar) as {c}' for c in columns)} from {table}"


PIPELINE_REPORT = f"""
with l as ({_latest_lines('lineitem', money=True)})
select n_name,
       cast(year(o_orderdate) as integer) as o_year,
       cast(count(*) as bigint) as line_count,
       cast(sum(l_quantity) as decimal(38,2)) as sum_qty,
       cast(sum(l_extendedprice * (1 - l_discount)) as decimal(38,4)) as revenue
from l
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
group by n_name, year(o_orderdate)
"""

MULTI_SOURCE = (
    "select case o_orderkey % 3 "
    + " ".join(f"when {k} then '{n}'" for k, n in enumerate(fx.SOURCE_NAMES[:-1]))
    + f" else '{fx.SOURCE_NAMES[-1]}' end as source, "
    + ", ".join(f"cast({c} as varchar) as {c}" for c in ORDERS_COLUMNS)
    + " from orders"
)

EXTRACT_CATALOG = " union all ".join(
    f"select 'tpch_stg.{name}' as table_name, count(*) as rows_written from ({clean_query(q)})"
    for name, q in CATALOG.items()
)

LOAD_AUDIT = (
    " union all ".join(
        f"select 'tpch' as source, 'tpch_stg.{t}' as table_name, 1 as status, 'refresh' as mode, "
        f"count(*) as rows_written from {t}"
        for t in ("customer", "orders", "nation")
    )
    + " union all select 'tpch', 'tpch_stg.broken', 0, 'refresh', cast(null as bigint)"
)

CAST_INT = f"""
with {_dirty_cte()}
select {_parse('l_orderkey', 'bigint', ())} as l_orderkey,
       {_parse('l_linenumber', 'int', ())} as l_linenumber,
       l_partkey as raw_value,
       {_parse('l_partkey', 'bigint', ())} as value
from dirty
"""

CAST_DECIMAL = f"""
with {_dirty_cte()}
select {_parse('l_orderkey', 'bigint', ())} as l_orderkey,
       {_parse('l_linenumber', 'int', ())} as l_linenumber,
       l_extendedprice as raw_value,
       {_parse('l_extendedprice', fx.MONEY, ())} as value
from dirty
"""

CAST_BOOLEAN = f"""
select c_custkey, raw_value,
       case when lower(trim(raw_value)) in ({_words(TRUE_WORDS)}) then true
            when lower(trim(raw_value)) in ({_words(FALSE_WORDS)}) then false end as value
from (select c_custkey, [{_words(fx.BOOLEAN_WORDS)}][c_custkey % 8 + 1] as raw_value from customer)
"""

CAST_TIMESTAMP = f"""
select o_orderkey, raw_value, {_parse('raw_value', 'timestamp', ('iso', 'dd.MM.yyyy'))} as value
from (select o_orderkey,
             case o_orderkey % 3 when 0 then cast(o_orderdate as varchar)
                                 when 1 then strftime(o_orderdate, '%Y-%m-%d')
                                 else strftime(o_orderdate, '%d.%m.%Y') end as raw_value
      from orders)
"""

TYPED_ACCEPTED = f"""
with {_dirty_cte()},
{_typed_ctes()}
select {', '.join(LINEITEM_COLUMNS)} from typed where not rejected
"""

_entry_specs = [s for s in fx.LINEITEM_RULE.specs if s.type != "string"]
REJECT_ROWS = f"""
with {_dirty_cte()},
{_typed_ctes()}
""" + "\nunion all\n".join(
    f"select l_orderkey, l_linenumber, '{s.name}' as column_name, raw_{s.name} as raw_value, "
    f"'{_expected(s)}' as expected_type from typed where bad_{s.name}"
    for s in _entry_specs
)

RECONCILE = f"""
with {_dirty_cte()},
{_typed_ctes()},
acc as (select * from typed where not rejected),
li as (select (select count(*) from typed) as rows_read,
              (select count(*) from (select distinct l_orderkey, l_linenumber from acc)) as rows_written,
              (select count(*) from typed where rejected) as rows_rejected)
select 'dirty' as source, 'dirty_tf.lineitem' as table_name, rows_read, rows_written, rows_rejected,
       rows_read - rows_written - rows_rejected as rows_duplicate,
       (select count(*) from lineitem) as staged_rows, true as balanced from li
union all
select 'dirty', 'dirty_tf.orders', count(*), count(distinct o_orderkey), 0,
       count(*) - count(distinct o_orderkey), count(*), true from orders
union all
select 'dirty', 'dirty_tf.customer', count(*), count(distinct c_custkey), 0,
       count(*) - count(distinct c_custkey), count(*), true from customer
"""

_FACT = f"""
with l as ({_latest_lines('lineitem', money=True)})
select l.l_orderkey, l.l_linenumber, c_custkey, c_mktsegment, c_nationkey,
       p_partkey, p_brand, p_type, s_suppkey, s_nationkey,
       o_orderdate, o_orderstatus, l_shipdate,
       l_quantity, l_extendedprice, l_discount,
       l_extendedprice * (1 - l_discount) as revenue
from l
join orders on l.l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join part on l.l_partkey = p_partkey
join supplier on l.l_suppkey = s_suppkey
"""

DWH_FACT = f"select * replace (cast(revenue as decimal(18,4)) as revenue) from ({_FACT})"

DWH_REPORT = f"""
select c_mktsegment, cast(date_trunc('month', o_orderdate) as date) as order_month,
       cast(count(*) as bigint) as line_count,
       cast(sum(l_quantity) as decimal(38,2)) as sum_qty,
       cast(sum(revenue) as decimal(38,4)) as revenue
from ({_FACT})
group by all
"""

FACT_UNMATCHED = """
select * from (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, case
    when o.o_orderkey is null then 'order'
    when c.c_custkey is null then 'customer'
    when l_partkey not in (select p_partkey from part where p_partkey % 25 <> 0) then 'part'
    when l_suppkey not in (select s_suppkey from supplier where s_suppkey % 9 <> 0) then 'supplier' end as missing
  from lineitem
  left join (select * from orders where o_orderkey % 40 <> 0) o on o.o_orderkey = l_orderkey
  left join (select * from customer where c_custkey % 30 <> 0) c on c.c_custkey = o.o_custkey)
where missing is not null
"""

ORPHAN_ROWS = """
select * from lineitem l
where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_orderkey % 50 <> 0)
"""

UPSERT_LATEST = """
select o_orderkey, o_custkey,
       case when o_orderkey % 10 = 0 then 'X' else o_orderstatus end as o_orderstatus,
       case when o_orderkey % 10 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       o_orderdate, o_orderpriority
from orders
"""


def _steps_cte(steps) -> str:
    *head, last = steps
    ctes = ",\n".join(f"{s.name} as ({clean_query(s.sql)})" for s in head)
    return f"with {ctes}\n{clean_query(last.sql)}"


INCREMENTAL_TRANSFORM = f"""
with {_dirty_cte()},
{_typed_ctes()},
acc as (select {', '.join(LINEITEM_COLUMNS)} from typed where not rejected)
{_latest_lines('acc', money=False)}
"""

_SLASHED_CTE = f"""{_dirty_cte()},
slashed as (
  select * replace (case when cast(l_orderkey as bigint) % 5 = 2
                         then coalesce(strftime(try_cast(l_shipdate as timestamp), '%m/%d/%Y'), l_shipdate)
                         else l_shipdate end as l_shipdate) from dirty
)"""

REPAIRED_REJECTS = f"""
with {_SLASHED_CTE},
{_typed_ctes(fx.REPAIRED_RULE, "slashed")},
acc as (select {', '.join(LINEITEM_COLUMNS)} from typed where not rejected)
{_latest_lines('acc', money=False)}
"""

def _profile_of(c: str) -> str:
    text = f"trim({c})"
    iso = f"(regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') and try_cast({text} as timestamp) is not null)"
    dotted, slashed = (f"try_strptime({text}, '{f}') is not null" for f in ("%d.%m.%Y", "%m/%d/%Y"))
    number = "'^[+-]?([0-9]+)([.]([0-9]+))?$'"
    whole = f"regexp_replace(regexp_extract({text}, {number}, 1), '^0+', '')"
    return f"""
select '{c}' as column_name, count(*) as row_count, count(*) filter (where {_blank(c)}) as blanks,
       count({_parse(c, 'int', ())}) as ints, count({_parse(c, 'bigint', ())}) as bigints,
       count(*) filter (where regexp_matches({text}, {number})) as decimals,
       count(*) filter (where regexp_matches({text}, '^[+-]?0[0-9]')) as led_by_zero,
       count(*) filter (where lower({text}) in ({_words((*TRUE_WORDS, *FALSE_WORDS))})) as booleans,
       count(*) filter (where {iso} or {dotted} or {slashed}) as timestamps,
       coalesce(max(length({whole})) filter (where regexp_matches({text}, {number})), 0) as whole_digits,
       coalesce(max(length(regexp_extract({text}, {number}, 3))) filter (where regexp_matches({text}, {number})), 0) as scale,
       coalesce(max(length({c})), 0) as longest,
       count(*) filter (where {iso}) as format_0, count(*) filter (where {dotted}) as format_1,
       count(*) filter (where {slashed}) as format_2
from slashed"""


TYPE_PROFILE = f"""
with {_SLASHED_CTE},
states as ({" union all ".join(_profile_of(c) for c in LINEITEM_COLUMNS)})
select *, case when row_count = blanks then 'string'
               when ints = row_count - blanks and led_by_zero = 0 then 'int'
               when bigints = row_count - blanks and led_by_zero = 0 then 'bigint'
               when decimals = row_count - blanks and not (scale = 0 and led_by_zero > 0)
                    and greatest(whole_digits, 1) + scale <= 38
               then 'decimal(' || (greatest(whole_digits, 1) + scale) || ',' || scale || ')'
               when booleans = row_count - blanks then 'boolean'
               when timestamps = row_count - blanks then 'timestamp' else 'string' end as proposed
from states
"""

SNAPSHOT_DIFF = """
with before as (select * from orders where o_orderkey % 997 <> 1),
after as (select * replace (case when o_orderkey % 983 = 3 then 'X' else o_orderstatus end as o_orderstatus,
                            case when o_orderkey % 983 = 3 and o_orderkey % 2 = 1 then o_custkey + 1 else o_custkey end as o_custkey)
          from orders where o_orderkey % 991 <> 2)
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
       case when b.o_orderkey is null then 'inserted' when a.o_orderkey is null then 'deleted' else 'changed' end as kind,
       case when a.o_orderkey is null or b.o_orderkey is null then '' else concat_ws(',',
         case when a.o_custkey <> b.o_custkey then 'o_custkey' end,
         case when a.o_orderstatus <> b.o_orderstatus then 'o_orderstatus' end) end as changed,
       b.o_orderstatus as old_status, a.o_orderstatus as new_status
from before b full join after a on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_custkey <> b.o_custkey or a.o_orderstatus <> b.o_orderstatus
"""

REPORT_DELTAS = """
select case when o_orderkey % 983 = 3 then 'X' else o_orderstatus end as o_orderstatus, cast(year(o_orderdate) as integer) as o_year,
       count(*) as row_count, cast(sum(cast(o_totalprice as decimal(18,4))) as decimal(38,4)) as sum_o_totalprice
from orders where o_orderkey % 991 <> 2 group by all
"""

CONTENT_CHECK = """
with o as (select *, o_orderkey % 900 = 4 as replaced from orders)
select o_orderkey, 'changed' as kind, 'o_custkey' as column_name,
       cast(o_custkey as varchar) as left_value, cast(o_custkey + 1 as varchar) as right_value
from o where o_orderkey % 500 = 7 and not replaced
union all
select o_orderkey, 'changed', 'o_orderstatus', o_orderstatus, null from o where o_orderkey % 700 = 9 and not replaced
union all
select o_orderkey, 'deleted', null, null, null from o where replaced
union all
select -o_orderkey, 'inserted', null, null, null from o where replaced
"""

SURROGATE_KEYS = f"""
with o as (select case o_orderkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as source, * from orders),
first as (select source, o_custkey, row_number() over (order by source, o_custkey) as customer_sk
          from (select distinct source, o_custkey from o where {fx.FIRST_ORDERS})),
later as (select source, o_custkey, row_number() over (order by source, o_custkey) + (select count(*) from first) as customer_sk
          from (select distinct source, o_custkey from o anti join first using (source, o_custkey)))
select source, o_custkey, customer_sk, count(*) as order_count
from o join (select * from first union all select * from later) using (source, o_custkey) group by all
"""

_HISTORY = """
changes as (select o_custkey, o_orderdate, max_by(o_orderpriority, (o_orderpriority, o_orderstatus)) as o_orderpriority,
                   max_by(o_orderstatus, (o_orderpriority, o_orderstatus)) as o_orderstatus
            from orders group by o_custkey, o_orderdate),
told as (select *, lag(o_orderpriority) over w is not distinct from o_orderpriority
                   and lag(o_orderstatus) over w is not distinct from o_orderstatus as same
         from changes window w as (partition by o_custkey order by o_orderdate)),
history as (select o_custkey, o_orderpriority, o_orderstatus, o_orderdate as valid_from,
                   lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to
            from told where not same)
"""

DIMENSION_HISTORY = f"with {_HISTORY} select * from history"

FACT_AS_OF = f"""
with {_HISTORY},
lines as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey
          from lineitem left join (select o_orderkey, o_custkey from orders where o_orderkey % 40 <> 0) on o_orderkey = l_orderkey)
select lines.*, o_orderpriority, o_orderstatus, valid_from
from lines left join history on history.o_custkey = lines.o_custkey
  and l_shipdate >= valid_from and (valid_to is null or l_shipdate < valid_to)
"""

UPSERT_UNKEYED = "select * replace (case when o_orderkey % 20 <> 0 then o_orderkey end as o_orderkey) from orders"


EARLY_FACTS = """
with o as (select * from orders where o_orderkey % 13 <> 6),
     c as (select * from customer where c_custkey % 13 <> 6),
     p as (select * from part where p_partkey % 13 <> 6),
     s as (select * from supplier where s_suppkey % 13 <> 6)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey, o_orderdate, c_nationkey,
       case when c_custkey is not null then p_brand end as p_brand,
       case when c_custkey is not null and p_partkey is not null then s_nationkey end as s_nationkey,
       case when o_orderkey is null then 'erp.orders' when c_custkey is null then 'erp.customer'
            when p_partkey is null then 'erp.part' when s_suppkey is null then 'erp.supplier' end as missing
from lineitem left join o on l_orderkey = o_orderkey left join c on o_custkey = c_custkey
left join p on l_partkey = p_partkey left join s on l_suppkey = s_suppkey
"""

# All pairs of a nation by edit distance; Spark never lists them.
MATCHED_ENTITIES = """
with recursive base as (
  select cast(c_custkey as bigint) as k, substr(md5(cast(c_custkey as varchar)), 1, 12) as code,
         cast(c_custkey % 12 + 1 as int) as place, cast(c_nationkey as int) as nation, c_mktsegment as m,
         case when c_custkey % 5 = 0 then 'DE-' || cast(c_custkey - c_custkey % 10 as varchar) end as tax
  from customer
),
records as (
  select k * 4 as record_id, 0 as trust, substr(code, 1, 6) || ' ' || upper(substr(code, 7, 6)) as name,
         nation, tax as tax_no, case when k % 7 <> 0 then m end as segment from base
  union all
  select k * 4 + 1, 1, substr(code, 1, place - 1) || 'X' || substr(code, place + 1), nation, null,
         case when k % 4 <> 0 then m end from base where k % 2 = 0
  union all
  select k * 4 + 2, 2, substr(code, 1, place - 1) || substr(code, place + 1), nation, lower(tax), lower(m)
  from base where k % 3 = 0
),
compared as (
  select record_id, nation, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') as name,
         regexp_replace(lower(tax_no), '[^a-z0-9]+', '', 'g') as tax_no from records
),
links as (
  select l.record_id as a, r.record_id as b from compared l join compared r
    on l.nation = r.nation and l.record_id <> r.record_id
   and abs(length(l.name) - length(r.name)) <= 1 and levenshtein(l.name, r.name) <= 1
  union
  select l.record_id, r.record_id from compared l join compared r on l.tax_no = r.tax_no and l.record_id <> r.record_id
),
reach as (
  select record_id as a, record_id as b from records
  union
  select reach.a, links.b from reach join links on reach.b = links.a
),
entities as (select a as record_id, min(b) as entity_id from reach group by a)
select entity_id, count(*) as record_count,
       arg_min(name, (trust, record_id)) filter (where name is not null) as name,
       arg_min(nation, (trust, record_id)) filter (where nation is not null) as nation,
       arg_min(tax_no, (trust, record_id)) filter (where tax_no is not null) as tax_no,
       arg_min(segment, (trust, record_id)) filter (where segment is not null) as segment
from records join entities using (record_id)
group by entity_id
"""

ORACLE_SQL: dict[str, str] = {
    "pipeline_report": PIPELINE_REPORT,
    "extract_query": clean_query(EXTRACT_SQL),
    "extract_catalog": EXTRACT_CATALOG,
    "multi_source_stage": MULTI_SOURCE,
    "incremental_hwm": "select * from events",
    "incremental_stream": "select * from events",
    "load_append": "select * from customer",
    "full_refresh": "select * from customer where c_acctbal > 0",
    "load_audit": LOAD_AUDIT,
    "stage_as_text": _text_select(LINEITEM_COLUMNS, "lineitem"),
    "cast_int": CAST_INT,
    "cast_decimal": CAST_DECIMAL,
    "cast_boolean": CAST_BOOLEAN,
    "cast_timestamp": CAST_TIMESTAMP,
    "typed_accepted": TYPED_ACCEPTED,
    "reject_rows": REJECT_ROWS,
    "dedup_exact": "select min(doc_id) as doc_id, count(*) as copies from documents group by text",
    "dedup_latest": _latest_lines("lineitem", money=False),
    "reconcile": RECONCILE,
    "run_steps": _steps_cte(STEPS),
    "step_isolation": clean_query(FAILING_STEPS[0].sql),
    "dwh_fact": DWH_FACT,
    "dwh_report": DWH_REPORT,
    "fact_unmatched": FACT_UNMATCHED,
    "early_facts": EARLY_FACTS,
    "orphan_rows": ORPHAN_ROWS,
    "upsert_latest": UPSERT_LATEST,
    "upsert_unkeyed": UPSERT_UNKEYED,
    "incremental_transform": INCREMENTAL_TRANSFORM,
    "landed_pipeline": INCREMENTAL_TRANSFORM,
    "repaired_rejects": REPAIRED_REJECTS,
    "type_profile": TYPE_PROFILE,
    "snapshot_diff": SNAPSHOT_DIFF,
    "content_check": CONTENT_CHECK,
    "report_deltas": REPORT_DELTAS,
    "surrogate_keys": SURROGATE_KEYS,
    "matched_entities": MATCHED_ENTITIES,
    "dimension_history": DIMENSION_HISTORY,
    "fact_as_of": FACT_AS_OF,
}
