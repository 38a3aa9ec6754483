"""DuckDB SQL computing the same answers as the registered queries.

Each statement runs on the parquet tables registered as views.  Column names
and types are aligned with the Spark results.
"""

from __future__ import annotations

from tessera.catalog import ACCOUNT_CHANGES_SQL, SAVED_QUERIES_SQL, STATUS_SQL
from tessera.functions.casting import INT_TEXT, JVM_FLOAT_TEXT, TIMESTAMP_TEXT
from tessera.functions.typenames import CANDIDATES, NUMERIC_PRECEDENCE


def _enc(v: str) -> str:
    """CSV value rule."""
    return (
        f"(case when {v} is null then '' "
        f"when contains({v}, '\"') or contains({v}, chr(10)) or contains({v}, ',') "
        f"then '\"' || replace({v}, '\"', '\"\"') || '\"' else {v} end)"
    )


def _line(cols: list[str]) -> str:
    return " || ',' || ".join(_enc(f"cast({c} as varchar)") for c in cols)


def _newlines(c: str) -> str:
    return f"regexp_replace({c}, '\\r\\n?|\\n', ' ', 'g')"


EVENT_STRINGS_SQL = """
s as (
  select cast(event_id as varchar) as event_id, cast(ts as varchar) as ts, cast(user_id as varchar) as user_id,
         event_type, cast(value as varchar) as value, props,
         case when event_type = 'purchase' then 'C' || cast(user_id as varchar) end as coupon,
         case when value > 50 then 'true' when value <= 10 then 'false' end as flag,
         '' as blank,
         case when event_type = 'click' then cast(user_id as varchar) else cast(ts as varchar) end as mixed
  from events
)"""

EVENT_STRING_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "coupon", "flag", "blank", "mixed"]


def _test(v: str, cand: str, ts_format: str | None = None) -> str:
    if cand == "integer":
        return f"(regexp_full_match({v}, '{INT_TEXT}') and try_cast({v} as integer) is not null)"
    if cand == "long":
        return f"(regexp_full_match({v}, '{INT_TEXT}') and try_cast({v} as bigint) is not null)"
    if cand == "double":
        return f"regexp_full_match({v}, '{JVM_FLOAT_TEXT}')"
    if cand == "timestamp":
        if ts_format:
            return f"(try_strptime({v}, '{ts_format}') is not null)"
        return f"(regexp_full_match({v}, '{TIMESTAMP_TEXT}') and try_cast({v} as timestamp) is not null)"
    if cand == "boolean":
        return f"(lower({v}) in ('true', 'false'))"
    raise ValueError(cand)


def _type_case(v: str, empty: str, ts_format: str | None = None) -> str:
    nb = f"({v} is not null and {v} <> '')"
    checks = {c: f"bool_and(case when {nb} then {_test(v, c, ts_format)} end)" for c in CANDIDATES}
    whens = " ".join(f"when {checks[c]} then '{c}'" for c in CANDIDATES)
    return f"(case when {checks[CANDIDATES[0]]} is null then {empty} {whens} else 'string' end)"


def _infer_sql(source: str = "s", extra: str = "") -> str:
    parts = [
        f"select cast({i} as integer) as \"position\", '{c}' as \"column\", {_type_case(c, chr(39) + 'string' + chr(39))} as type from {source}"
        for i, c in enumerate(EVENT_STRING_COLUMNS)
    ]
    return f"with {EVENT_STRINGS_SQL}{extra} " + " union all ".join(parts)


def _infer_pattern_sql() -> str:
    cols = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    src = """with t as (select cast(o_orderkey as varchar) as o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as o_orderdate,
        cast(o_totalprice as varchar) as o_totalprice, o_orderpriority from orders) """
    parts = [
        f"select cast({i} as integer) as \"position\", '{c}' as \"column\", "
        f"{_type_case(c, chr(39) + 'string' + chr(39), '%Y-%m-%dT%H:%M:%S')} as type from t"
        for i, c in enumerate(cols)
    ]
    return src + " union all ".join(parts)


def _infer_orders_sql() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    src = f"with t as (select {', '.join(f'cast({c} as varchar) as {c}' for c in cols)} from orders) "
    return src + " union all ".join(
        f"select cast({i} as integer) as \"position\", '{c}' as \"column\", {_type_case(c, chr(39) + 'string' + chr(39))} as type from t" for i, c in enumerate(cols)
    )


def _merge_sql() -> str:
    per = " union all ".join(
        f"select event_type, '{c}' as \"column\", {_type_case(c, 'null')} as type from s group by event_type"
        for c in EVENT_STRING_COLUMNS
    )
    rank = "case type " + " ".join(f"when '{n}' then {i}" for i, n in enumerate(NUMERIC_PRECEDENCE)) + " end"
    wider = "case max(r) " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(NUMERIC_PRECEDENCE)) + " end"
    return f"""with {EVENT_STRINGS_SQL}, per as ({per}), ranked as (select *, {rank} as r from per)
select "column", case when min(type) is null then 'string'
  when min(type) = max(type) then min(type)
  when bool_and(case when type is not null then r is not null end) then {wider}
  else 'string' end as type
from ranked group by "column"
"""


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]



def _cut(table: str, cols: list[str], order: list[str], max_bytes: int) -> str:
    """CTEs that number parts cut on the running byte offset of the encoded lines."""
    by = ", ".join(order)
    return f"""l as (select *, {_line(cols)} as line from {table}),
        sized as (select *, strlen(line) + 1 as b from l),
        placed as (select *, sum(b) over (order by {by} rows unbounded preceding) - b as start from sized),
        cuts as (select *, start // {max_bytes} as cut from placed),
        numbered as (select *, dense_rank() over (order by cut) as part_number from cuts)"""


_LINES_SQL = """t as (select l_orderkey, l_linenumber, max(l_partkey) as partkey, max(l_quantity) as quantity from lineitem group by all),
        c as (select l_orderkey, l_linenumber, quantity + 1 as quantity from t where l_linenumber % 2 = 0
              union all select -o_orderkey - 1, 1, 0.5 from orders)"""

# Spark type name, dataset type, precision, scale, format per DuckDB column type.
_TYPE_MAP_SQL = """
tm as (
  select * from (values
    ('BIGINT', 'long', 'Numeric', 18, 0, null),
    ('INTEGER', 'integer', 'Numeric', 10, 0, null),
    ('DOUBLE', 'double', 'Numeric', 14, 4, null),
    ('VARCHAR', 'string', 'Text', null, null, null),
    ('TIMESTAMP', 'timestamp', 'Date', null, null, 'yyyy-MM-dd''T''HH:mm:ss.SSS''Z''')
  ) t(column_type, spark_type, dataset_type, "precision", scale, format)
)"""


def _profile_sql(tbl: str) -> str:
    return f"""with {_TYPE_MAP_SQL},
cols as (select column_name, column_type, row_number() over () - 1 as pos from (describe {tbl})),
strs as (select coalesce(cast(columns(*) as varchar), chr(0)) from {tbl}),
raw as (unpivot strs on columns(*) into name column_name value v0),
vals as (select column_name, nullif(v0, chr(0)) as v from raw),
st as (
  select column_name,
         cast(max(length(v)) as bigint) as max_length,
         cast(count(*) filter (where v is null) as bigint) as null_count,
         cast(max(length(regexp_replace(split_part(v, '.', 1), '^-', ''))) as bigint) as int_w,
         cast(max(length(rtrim(split_part(v, '.', 2), '0'))) as bigint) as frac_w
  from vals group by column_name
)
select cast(c.pos as integer) as "position", c.column_name as "column", '{tbl}.' || c.column_name as full_name,
       tm.spark_type, coalesce(tm.dataset_type, 'Text') as dataset_type,
       cast(tm."precision" as integer) as "precision",
       cast(case when tm."precision" is not null then coalesce(tm.scale, 0) end as integer) as scale,
       case when tm."precision" is not null then '0' end as default_value,
       tm.format, cast(null as varchar) as can_truncate,
       st.max_length, st.null_count,
       case when tm.dataset_type = 'Numeric' then st.int_w end as int_digits,
       case when tm.dataset_type = 'Numeric' then st.frac_w end as frac_digits,
       case when tm.dataset_type = 'Numeric' then coalesce(st.int_w, 0) <= tm."precision" - coalesce(tm.scale, 0) else true end as fits
from cols c left join tm using (column_type) join st using (column_name)
"""


ORACLE: dict[str, str] = {
    "group_count": "select event_type, cast(user_id as integer) as user_id, count(*) as count from events group by all",
    "group_all": "select count(*) as count from events",
    "limit_rows": """select event_type, cast(user_id as integer) as user_id, count(*) as count from events
        group by all order by event_type, user_id limit 2000""",
    "multi_load": "select c_mktsegment, count(*) as count from customer group by all",
    "dataset_scan": "select * from customer",
    "header_union": """with k as (
        select 'event_id' as name from events having count(*) > 0
        union all select 'ts' from events having count(*) > 0
        union all select 'user_id' from events having count(*) > 0
        union all select 'event_type' from events having count(*) > 0
        union all select 'value' from events having count(*) > 0
        union all select 'props' from events having count(*) > 0
        union all select 'coupon' from events where event_type = 'purchase' having count(*) > 0
        union all select 'flag' from events where value > 50 or value <= 10 having count(*) > 0)
        select cast(row_number() over (order by name) - 1 as integer) as "position", name from k""",
    "header_widest": """with r as (
        select list_sort(list_filter(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props',
               case when event_type = 'purchase' then 'coupon' end,
               case when value > 50 or value <= 10 then 'flag' end], lambda x: x is not null)) as k
        from events),
        best as (select k from r order by len(k) desc, k desc limit 1)
        select cast(generate_subscripts(k, 1) - 1 as integer) as "position", unnest(k) as name from best""",
    "infer_types": _infer_sql(),
    "merge_types": _merge_sql(),
    "infer_sample": _infer_sql("s1000", ", s1000 as (select * from s order by cast(event_id as bigint) limit 1000)"),
    "infer_pattern": _infer_pattern_sql(),
    "cast_numeric": """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax from lineitem""",
    "cast_narrow": """select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as tinyint) as ln_byte,
        cast(l_linenumber as smallint) as ln_short, cast(l_quantity as float) as qty from lineitem""",
    "cast_decimal": "select o_orderkey, cast(o_totalprice as decimal(12, 2)) as price from orders",
    "cast_boolean": """select event_id, case when lower(w) in ('true', 'false') then lower(w) = 'true' end as flag
        from (select event_id, case event_type when 'click' then 'TRUE' when 'view' then 'false'
              when 'purchase' then 'True' when 'signup' then 'yes' else 't' end as w from events)""",
    "cast_timestamp": "select event_id, ts, date_trunc('second', ts) as ts_s from events",
    "cast_date": "select o_orderkey, cast(o_orderdate as date) as o_orderdate from orders",
    "blank_to_null": """select o_orderkey, case when o_orderstatus = 'F' then null else o_custkey end as custkey,
        case when o_orderstatus = 'F' then '' else o_orderpriority end as priority from orders""",
    "url_encode": """select page_id,
        replace(replace(replace(url_encode(url), '%20', '+'), '%2A', '*'), '~', '%7E') as url,
        replace(replace(replace(url_encode(html), '%20', '+'), '%2A', '*'), '~', '%7E') as html from pages""",
    "csv_lines": f"select doc_id, {_line(DOC_COLS)} as line from documents",
    "pages": "select *, cast((row_number() over (order by o_orderkey) - 1) // 1000 as bigint) as page from orders",
    "pk_chunks": """select chunk_id, min(o_orderkey) as min_key, max(o_orderkey) as max_key, count(*) as n_rows
        from (select o_orderkey, cast((row_number() over (order by o_orderkey) - 1) // 2000 as bigint) as chunk_id
              from orders) group by chunk_id""",
    "object_query": """select o_orderkey, o_custkey, o_orderpriority from orders
        where not (o_orderstatus = 'F') and o_orderpriority is not null""",
    "query_all": "select o_orderkey, o_custkey, o_orderpriority from orders where o_orderpriority is not null",
    "name_resolution": f"""with {SAVED_QUERIES_SQL},
        segs as (select query_id, unnest(string_split(query, '"')) as seg,
                        unnest(range(len(string_split(query, '"')))) as pos,
                        len(string_split(query, '"')) as n from q),
        marked as (select *, lag(seg) over (partition by query_id order by pos) as prev from segs),
        r as (select name, min(dataset_id) as dataset_id from reg group by name),
        fixed as (select m.query_id, m.pos,
                         case when m.pos % 2 = 1 and m.pos < m.n - 1
                                   and regexp_matches(m.prev, '(^|[^A-Za-z0-9_])load\\s*$')
                              then coalesce(r.dataset_id, m.seg) else m.seg end as seg
                  from marked m left join r on r.name = m.seg)
        select query_id, string_agg(seg, '"' order by pos) as query from fixed group by query_id""",
    "bulk_read": f"""select doc_id, {_newlines('text')} as text, {_newlines('lang')} as lang,
        {_newlines('source')} as source, n_chars from documents""",
    "bulk_newlines": f"select conv_id, turn, {_newlines('role')} as role, {_newlines('text')} as text from conversations",
    "bulk_infer": f"""select cast(conv_id as integer) as conv_id, cast(turn as integer) as turn, {_newlines('role')} as role,
        {_newlines('text')} as text from conversations""",
    "bulk_last": f"""with {_cut("conversations", ["conv_id", "turn", "role", "text"], ["conv_id", "turn"], 500000)},
        b as (select *, cast((start - cut * 500000) * 2 // 500000 + 1 as integer) as result from numbered),
        last as (select part_number, max(result) as result from b group by part_number)
        select conv_id, turn, {_newlines('role')} as role, {_newlines('text')} as text
        from b join last using (part_number, result)""",
    "bulk_guard": """select doc_id, 'text' as "column", cast(length(text) as bigint) as length from documents
        where length(text) > 4096""",
    "encoded_size": f"""select count(*) as rows, cast(coalesce(sum(strlen(line) + 1), 0) as bigint) as bytes
        from (select {_line(DOC_COLS)} as line from documents)""",
    "size_partitions": f"""select rows, bytes,
        cast(case when bytes <= 500000 then 1 else bytes // 500000 + 1 end as bigint) as parts
        from (select count(*) as rows, cast(coalesce(sum(strlen(line) + 1), 0) as bigint) as bytes
              from (select {_line(DOC_COLS)} as line from documents))""",
    "part_manifest": f"""with {_cut("orders", ORDER_COLS, ["o_orderkey"], 100000)}
        select part_number, count(*) as rows, cast(sum(b) as bigint) as bytes from numbered group by 1""",
    "batch_payloads": f"""with {_cut("orders", ORDER_COLS, ["o_orderkey"], 100000)}
        select part_number, count(*) as rows,
               '{",".join(ORDER_COLS)}' || chr(10) || string_agg(line, chr(10) order by o_orderkey) as payload
        from numbered group by 1""",
    "parts_acknowledged": f"""with {_cut("orders", ORDER_COLS, ["o_orderkey"], 100000)}
        select count(distinct part_number) as parts, cast(count(*) as bigint) as rows, cast(sum(b) as bigint) as bytes, true as ok from numbered""",
    "bulk_completed": f"""with {_cut("conversations", ["conv_id", "turn", "role", "text"], ["conv_id", "turn"], 20000)}
        select conv_id, turn, {_newlines('role')} as role, {_newlines('text')} as text from numbered
        where part_number % 5 <> 0 and part_number % 2 <> 1""",
    "size_repartition": f"""with s as (select cast(coalesce(sum(strlen({_line(DOC_COLS)}) + 1), 0) as bigint) as bytes, count(*) as n from documents)
        select cast(case when bytes <= 500000 then 1 else bytes // 500000 + 1 end as bigint) as partitions, cast(n as bigint) as rows, true as even from s""",
    "text_columns": """select 'orders' as dataset, (select count(*) from orders) as rows, cast(0 as bigint) as texts, false as ok
        union all select 'lineitem', (select count(*) from lineitem), cast(count(*) as bigint), count(*) > 0 from (describe lineitem) where column_type = 'VARCHAR'
        union all select 'customer', (select count(*) from customer), cast(count(*) as bigint), count(*) > 0 from (describe customer) where column_type = 'VARCHAR'""",
    "upsert_two_keys": f"""with {_LINES_SQL}
        select t.l_orderkey, t.l_linenumber, t.partkey, case when c.l_orderkey is not null then c.quantity else t.quantity end as quantity
        from t left join c using (l_orderkey, l_linenumber)
        union all select l_orderkey, l_linenumber, cast(null as bigint), quantity from c anti join t using (l_orderkey, l_linenumber)""",
    "publish_upsert_two_keys": f"""with {_LINES_SQL}
        select t.l_orderkey, t.l_linenumber, t.partkey, case when c.l_orderkey is not null then c.quantity else t.quantity end as quantity, 'line' as kind
        from t left join c using (l_orderkey, l_linenumber)
        union all select l_orderkey, l_linenumber, cast(null as bigint), quantity, 'line' from c anti join t using (l_orderkey, l_linenumber)""",
    "publish_new_schema": "select * from supplier",
    "publish_append_wider": """select s_suppkey, s_name, cast(null as double) as s_acctbal from supplier
        union all select s_suppkey, s_name, s_acctbal from supplier""",
    "publish_commits": """select cast(1 as bigint) as version, 'Overwrite' as operation, 'Completed' as state, count(*) as rows from customer
        union all select 2, 'Append', 'Completed', count(*) from customer where c_custkey % 3 = 0
        union all select 3, 'Upsert', 'Completed', (select count(*) from customer) + (select count(*) from customer where c_custkey % 3 = 0)""",
    "all_succeeded": f"""with s as (select o_orderpriority as p, {STATUS_SQL} as status from orders)
        select 'finished' as jobs, bool_and(status not in ('Failed', 'New', 'Queued', 'InProgress')) as ok from s where p in ('1-URGENT', '2-HIGH')
        union all select 'all', bool_and(status not in ('Failed', 'New', 'Queued', 'InProgress')) from s""",
    "not_null_fields": "select o_orderkey, o_orderdate as closed from orders where o_orderstatus = 'F'",
    "limit_groups": """select event_type, cast(user_id as integer) as user_id, count(*) as count from events
        group by all order by event_type, user_id limit 20""",
    "page_union": "select * from orders",
    "exact_sample": """select * from orders order by md5('7|' || cast(o_orderkey as varchar)), o_orderkey limit 100""",
    "insert": f"""with {ACCOUNT_CHANGES_SQL}
        select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
        union all select c_custkey, c_name, cast(null as integer), c_acctbal, cast(null as varchar) from changes""",
    "update": f"""with {ACCOUNT_CHANGES_SQL}
        select t.c_custkey,
               case when s.c_custkey is not null and s.c_name is not null and s.c_name <> '' then s.c_name else t.c_name end as c_name,
               t.c_nationkey,
               case when s.c_custkey is not null and s.c_acctbal is not null then s.c_acctbal else t.c_acctbal end as c_acctbal,
               t.c_mktsegment
        from customer t left join changes s on t.c_custkey = s.c_custkey""",
    "upsert": f"""with {ACCOUNT_CHANGES_SQL}
        select t.c_custkey,
               case when s.c_custkey is not null and s.c_name is not null and s.c_name <> '' then s.c_name else t.c_name end as c_name,
               t.c_nationkey,
               case when s.c_custkey is not null and s.c_acctbal is not null then s.c_acctbal else t.c_acctbal end as c_acctbal,
               t.c_mktsegment
        from customer t left join changes s on t.c_custkey = s.c_custkey
        union all
        select c_custkey, c_name, cast(null as integer), c_acctbal, cast(null as varchar) from changes
        where c_custkey not in (select c_custkey from customer)""",
    "write_outcomes": f"""with {ACCOUNT_CHANGES_SQL}
        select case when c_custkey in (select c_custkey from customer) then 'updated' else 'not_found' end as outcome,
               count(*) as rows from changes group by 1""",
    "publish_overwrite": "select * from part",
    "publish_append": "select * from supplier union all select * from supplier",
    "publish_upsert": f"""with {ACCOUNT_CHANGES_SQL}
        select * from customer where c_custkey not in (select c_custkey from changes)
        union all
        select ch.c_custkey, ch.c_name, cu.c_nationkey, ch.c_acctbal, cu.c_mktsegment
        from changes ch left join customer cu using (c_custkey)""",
    "field_profile": _profile_sql("lineitem"),
    "type_map_override": f"""with {_TYPE_MAP_SQL},
        cols as (select column_name, column_type from (describe orders))
        select column_name as "column", tm.spark_type, coalesce(tm.dataset_type, 'Text') as dataset_type,
               cast(tm."precision" as integer) as "precision",
               cast(case when tm."precision" is not null then coalesce(tm.scale, 0) end as integer) as scale,
               case when tm.spark_type = 'timestamp' then 'dd.MM.yyyy HH:mm' else tm.format end as format,
               case when tm.spark_type = 'string' then 'true' end as can_truncate
        from cols left join tm using (column_type)""",
    "metadata_table": f"""with {_TYPE_MAP_SQL},
        cols as (select column_name, column_type, row_number() over () - 1 as pos from (describe lineitem))
        select 'lineitem' as object, cast(pos as integer) as "position", column_name as name,
               coalesce(tm.dataset_type, 'Text') as type, cast(tm."precision" as integer) as "precision",
               cast(case when tm."precision" is not null then coalesce(tm.scale, 0) end as integer) as scale,
               tm.format, case when tm."precision" is not null then '0' end as default_value,
               column_name in ('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber') as is_unique_id
        from cols left join tm using (column_type)""",
    "scale_limit": """select column_name as "column", 8 as scale from (describe orders) where column_type = 'DOUBLE'""",
    "job_outcomes": f"""with s as (select o_orderkey as job_id, {STATUS_SQL} as status from orders),
        w as (select distinct l_orderkey as job_id from lineitem),
        j as (select coalesce(s.status, 'missing') as status from w left join s using (job_id))
        select case when status = 'Failed' then 'failure' when status in ('New', 'Queued', 'InProgress') then 'pending'
                    else 'success' end as outcome, status, count(*) as jobs from j group by all""",
    "csv_source": """select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, p_type,
        cast(p_size as varchar) as p_size, cast(p_retailprice as varchar) as p_retailprice from part""",
    "example_rows": """select cast(o_orderkey as varchar) as c1, cast(o_orderkey + 1 as varchar) as c2,
        cast(o_orderkey + 2 as varchar) as c3, cast(o_orderkey + 3 as varchar) as c4 from orders""",
}

ORACLE["upsert_full_outer"] = ORACLE["upsert"]
ORACLE |= {
    "infer_incremental": _infer_orders_sql(),
    "job_states": """with log as (select l_orderkey as job_id, l_shipdate as moment, l_linenumber as line, case when l_returnflag = 'R' then 'Failed' when l_returnflag = 'A' then 'InProgress'
          when l_linestatus = 'O' then 'Queued' else 'Completed' end as status from lineitem),
        r as (select *, row_number() over (partition by job_id order by moment desc, line desc, status desc) as k, min(moment) over (partition by job_id) as since,
              max(moment) over (partition by job_id) as last_at from log)
        select job_id, status, since, last_at, case when status = 'Failed' then 'failure' when status = 'Completed' then 'success'
          when since + interval 90 days < timestamp '1999-01-01' then 'timed_out' else 'pending' end as outcome from r where k = 1""",
    "key_ranges": "select true as fits, o_orderkey, o_custkey from orders",
    "csv_multiline": "select * from documents",
    "sample_replacement": """with r as (select *, row_number() over (order by o_orderkey) - 1 as k, count(*) over () as n from orders),
        d as (select i as draw, cast('0x' || substr(md5('7:' || cast(i as varchar)), 1, 15) as bigint) % (select count(*) from orders) as k
              from range((select count(*) // 10 from orders)) t(i))
        select r.* exclude (k, n), d.draw from d join r on d.k = r.k""",
    "cast_timestamp_lenient": """select event_id, case when event_id % 11 = 0 then null else
        cast(make_date(cast(year(ts) as bigint), 1, 1) as timestamp) + to_months(cast(event_id % 17 - 1 as integer)) + to_days(cast(event_id % 70 - 1 as integer))
        + to_hours(event_id % 100) + to_minutes(event_id % 200) + to_seconds(event_id % 90) end as ts from events""",
    "bulk_states": f"""with {_cut("conversations", ["conv_id", "turn", "role", "text"], ["conv_id", "turn"], 20000)}
        select conv_id, turn, {_newlines('role')} as role, {_newlines('text')} as text from numbered
        where part_number % 3 <> 0 or part_number % 6 = 0""",
    "publish_upsert_range": """with t as (select max(o_orderkey) as top from orders),
        n as (select o.* from orders o, t where o_orderkey >= top // 2 and o_orderkey < top // 2 + top // 100)
        select o.o_orderkey, case when n.o_orderkey is null then o.o_custkey else o.o_custkey + 1 end as o_custkey, o.o_totalprice, o.o_orderstatus,
               case when n.o_orderkey is not null then 'changed' end as note
        from orders o left join n on o.o_orderkey = n.o_orderkey
        union all select o_orderkey + top, o_custkey, null, null, 'new' from n, t""",
}
ORACLE["bulk_replaced"], ORACLE["bulk_header_infer"] = ORACLE["bulk_newlines"], ORACLE["bulk_infer"]
ORACLE["bulk_read_range"] = ORACLE["bulk_read"]
ORACLE["stream_batches"] = ORACLE["bulk_column_order"] = ORACLE["bulk_read"]

_JAVA_TS = ("(strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || "
            "coalesce(nullif(rtrim(strftime(ts, '%f'), '0'), ''), '0'))")
ORACLE["csv_lines_java"] = (
    "select event_id, "
    + " || ',' || ".join(_enc(_JAVA_TS if c == "ts" else f"cast({c} as varchar)")
                          for c in ["event_id", "ts", "user_id", "event_type", "value", "props"])
    + " as line from events"
)

_FLAG = "case when value > 50 then true when value <= 10 then false end"
ORACLE["records_missing_blank"] = (
    "select event_id, case when event_type = 'purchase' then 'C' || cast(user_id as varchar) else '' end as coupon, "
    f"{_FLAG} as flag from events"
)
ORACLE["records_missing_null"] = (
    "select event_id, case when event_type = 'purchase' then 'C' || cast(user_id as varchar) end as coupon, "
    f"{_FLAG} as flag from events"
)
ORACLE["read_widest"] = (
    "select cast(event_id as integer) as event_id, ts, cast(user_id as integer) as user_id, event_type, value, "
    "props, case when event_type = 'purchase' then 'C' || cast(user_id as varchar) else '' end as coupon, "
    f"{_FLAG} as flag from events"
)
