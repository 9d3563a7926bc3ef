"""SQL for the registered queries, over the same tables."""

from __future__ import annotations

BOUND = 6 * 3_600_000
INTERVAL = 30 * 24 * 3_600_000
WATERMARK_DELAY = 1_000

LOG = """
log as (
  select event_id as seq, epoch_us(ts) // 1000 as ts, 'mid_' || user_id as mid, user_id, value,
         event_type as page_id,
         case when event_id % 3 <> 0 then 'p' || (event_id % 7) end as last_page_id,
         case when event_id % 2 = 0 then '1' else '0' end as is_new,
         case when event_id % 50 = 0 then 'dirty' when event_type = 'signup' then 'start'
              when event_type = 'purchase' then 'display' else 'page' end as route
  from events),
page as (select * from log where route = 'page')"""

REPAIRED = f"""{LOG},
ranked as (
  select *, row_number() over (partition by mid order by seq) as rn from log where route <> 'dirty'),
repaired as (
  select *, rn > 1 and is_new = '1' as flag_repaired,
         case when rn > 1 and is_new = '1' then '0' else is_new end as fixed from ranked)"""

TOPIC_ROWS = f"""{REPAIRED},
topic_rows as (
  select case route when 'start' then 'dwd_start_log' else 'dwd_page_log' end as topic, fixed,
         cast(null as varchar) as reason
  from repaired where route in ('start', 'page')
  union all select 'dwd_display_log', null, null from repaired, range(2) where route = 'display'
  union all select 'dirty_log', null, 'not_json_object' from log where route = 'dirty')"""

NEIGHBOURS = f"""{LOG},
n as (
  select *, lead(ts) over w as nts, lead(last_page_id) over w as nlast, lag(ts) over w as pts
  from page window w as (partition by mid order by ts, seq))"""

PATTERN = f"""last_page_id is null and (nts is null or nts - ts >= {BOUND} or nlast is null)"""
REASON = f"case when nts is null or nts - ts >= {BOUND} then 'timeout' else 'match' end"
IN_SESSION = f"""last_page_id is null and case when nts - ts <= {BOUND} then nlast is null
  else coalesce(ts - pts <= {BOUND}, false) end"""
DECIDED = f"""(nts <= (select max(ts) - {WATERMARK_DELAY} from page)
  or ts + {BOUND} <= (select max(ts) - {WATERMARK_DELAY} from page))"""

# The end of a row's window: its slice of 16 bounds, and a bound more.
PASSED = f"""(ts // {16 * BOUND} + 1) * {16 * BOUND} + {BOUND} <= (select max(ts) - {WATERMARK_DELAY} from page)"""

SESSIONS = f"""{LOG},
marked as (
  select mid, ts, seq,
         case when ts - lag(ts) over w <= {BOUND} then 0 else 1 end as is_start
  from page window w as (partition by mid order by ts, seq)),
numbered as (
  select mid, ts, sum(is_start) over (partition by mid order by ts, seq) as no from marked),
sessions as (
  select mid, min(ts) as first_ts, max(ts) as last_ts, count(*) as n_rows
  from numbered group by mid, no)"""

FEED = """
feed as (
  select o_orderkey as seq, 'order_info' as "tableName", o_orderkey as k,
         case o_orderkey % 5 when 0 then 'update' when 1 then 'delete' when 2 then 'read'
              else 'insert' end as type
  from orders
  union all select c_custkey, 'user_info', null, 'insert' from customer
  union all select n_nationkey, 'base_province', null, 'insert' from nation)"""

DIMS = r"""
dim_user as (
  select c_custkey as id, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
         cast((epoch_ms(timestamp '2024-01-01')
          - epoch_ms(cast(date '1960-01-01' + cast(c_custkey * 37 % 15000 as integer) as timestamp)))
          // 31536000000 as integer) as age
  from customer),
dim_province as (
  select n_nationkey as id, n_name as name, cast(n_nationkey + 1000 as varchar) as area_code,
         'CN-' || n_nationkey as iso_code, substr(r_name, 1, 2) || '-' || n_nationkey as iso_3166_2
  from nation join region on n_regionkey = r_regionkey),
dim_sku as (
  select p_partkey as id, regexp_extract(p_brand, '(\d+)$', 1) as tm_id,
         cast(cast('0x' || substr(md5(p_type), 1, 8) as bigint) as varchar) as category3_id,
         cast(p_partkey % 100 as varchar) as spu_id, p_brand, p_type
  from part),
dim_tm as (select distinct tm_id as id, p_brand as tm_name from dim_sku),
dim_c3 as (select distinct category3_id as id, p_type as name from dim_sku),
dim_spu as (select cast(s_suppkey as varchar) as id, s_name as spu_name from supplier),
dim_sku_wide as (
  select dim_sku.id, tm_id, category3_id, spu_id, tm_name, dim_c3.name as category3_name, spu_name
  from dim_sku left join dim_tm on tm_id = dim_tm.id
  left join dim_c3 on category3_id = dim_c3.id left join dim_spu on spu_id = dim_spu.id)"""

ORDERS = """
o as (
  select o_orderkey as id, cast(c_nationkey as bigint) as province_id, o_orderstatus as order_status,
         o_custkey as user_id, cast(o_totalprice as decimal(16,2)) as total_amount,
         cast(cast(o_totalprice as decimal(16,2)) + 5 as decimal(16,2)) as original_total_amount,
         strftime(o_orderdate + interval 15 minute, '%Y-%m-%d %H:%M:%S') as expire_time,
         cast(null as varchar) as operate_time,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
         strftime(o_orderdate, '%Y-%m-%d') as create_date, strftime(o_orderdate, '%H') as create_hour,
         epoch_ms(date_trunc('second', o_orderdate)) as create_ts
  from orders left join customer on o_custkey = c_custkey),
d as (
  select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as sku_id,
         'part ' || l_partkey as sku_name, cast(l_quantity as bigint) as sku_num,
         cast(l_extendedprice as decimal(16,2)) as order_price,
         cast(l_extendedprice as decimal(16,2)) as split_total_amount,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as create_time,
         epoch_ms(date_trunc('second', l_shipdate)) as create_ts
  from lineitem)"""

PAIRS = f"""{ORDERS},
pairs as (
  select d.id as detail_id, o.id as order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
         o.province_id, o.order_status, o.user_id, o.total_amount, o.original_total_amount,
         o.expire_time, o.create_time, o.operate_time, o.create_date, o.create_hour,
         d.split_total_amount
  from o join d on o.id = d.order_id
   and d.create_ts between o.create_ts - {INTERVAL} and o.create_ts + {INTERVAL})"""

GAPS = f"""{PAIRS},
gaps as (
  select * replace (case when sku_id % 2 = 0 then order_status end as order_status,
                    case when sku_id % 3 = 0 then total_amount end as total_amount,
                    case when sku_id % 2 = 1 then order_price end as order_price) from pairs)"""


RULE_LOG = """
slots as (
  select s_suppkey as k, s_suppkey * 150 as pos,
         case when s_suppkey % 4 = 3 then 'user_info' else 'order_info' end as src,
         case when s_suppkey % 4 = 2 then 'update' else 'insert' end as op,
         s_suppkey % 11 = 0 as gone, s_suppkey % 13 = 0 and s_suppkey % 4 <> 3 as moved,
         case when s_suppkey % 4 = 3 then 'c_custkey,c_name' when s_suppkey % 3 = 0 then 'o_orderkey'
              when s_suppkey % 3 = 1 then 'o_custkey,o_orderkey' else 'o_orderkey,o_totalprice' end as fields
  from supplier),
rule_events as (
  select k, pos, src, op, not (gone or moved) as live, fields from slots
  union all select k, pos, src, 'read', true, fields from slots where moved and not gone),
versions as (
  select *, lead(pos) over (partition by src, op order by pos) as until from rule_events)"""


def _first(column: str) -> str:
    position = "{a: detail_id, b: sku_id, c: order_price, d: sku_num}"
    return f"arg_min({column}, {position}) filter (where {column} is not null) as {column}"


FACT_CELLS = """select seq, sink_table, o_orderkey, o_custkey, o_totalprice, o_orderstatus,
  c_custkey, c_name, n_name, fields from r"""

ORACLE: dict[str, str] = {
    "log_valid": f"""with {LOG} select seq, mid, ts, '{{"common":{{"is_new":"' || is_new || '","mid":"' || mid
          || '","uid":"' || user_id || '","vc":"v' || (seq % 4) || '"}},'
          || case when route = 'start' then '"start":{{"entry":"tile"}},' else
             '"page":{{"during_time":' || cast(trunc(value * 100) as bigint)
             || coalesce(',"last_page_id":"' || last_page_id || '"', '') || ',"page_id":"' || page_id || '"}},' end
          || case when route = 'display' then '"displays":[' || list_aggregate([
               '{{"display_type":"shelf","item":"' || (case n when 1 then seq % 1000 else seq % 777 end)
               || '","item_type":"article","order":' || n || ',"pos_id":' || (n + 2) || '}}' for n in [1, 2]],
               'string_agg', ',') || '],' else '' end
          || '"ts":' || ts || '}}' as value from log where route <> 'dirty'""",
    "log_dirty": """select event_id as seq, '{"common":{"mid":"mid_' || user_id as value,
        'not_json_object' as reason from events where event_id % 50 = 0""",
    "log_parse": f"""with {LOG} select seq, 'v' || (seq % 4) as vc,
        case when route <> 'start' then cast(trunc(value * 100) as bigint) end as during_time,
        case route when 'start' then 'common,start,ts' when 'display' then 'common,displays,page,ts'
                   else 'common,page,ts' end as fields
        from log where route <> 'dirty'""",
    "log_isnew_repair": f"with {REPAIRED} select seq, mid, fixed as is_new, flag_repaired from repaired",
    "log_split_counts": f"with {LOG} select route, count(*) as n from log group by route",
    "log_start": f"with {LOG} select seq, mid, ts from log where route = 'start'",
    "log_page": f"with {LOG} select seq, mid, page_id, last_page_id, ts from page",
    "log_display_explode": f"""with {LOG}
        select seq, cast(seq % 1000 as varchar) as item, 'article' as item_type, page_id,
               cast(1 as integer) as order_no, cast(6 as integer) as n_fields
        from log where route = 'display'
        union all select seq, cast(seq % 777 as varchar), 'article', page_id, 2, 6
        from log where route = 'display'""",
    "log_outputs": f"""with {TOPIC_ROWS} select topic, reason, count(*) as n,
        cast(sum(case when fixed = '1' then 1 else 0 end) as bigint) as n_new
        from topic_rows group by topic, reason""",
    "log_rolled": f"""with {LOG} select strftime(make_timestamp(ts * 1000), '%Y-%m-%d') as day, count(*) as n,
        count_if(route = 'dirty') as n_dirty, count_if(route = 'page') as n_pages from log group by day""",
    "uv_daily": f"""with {LOG}, r as (
        select mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') as day, seq, ts,
               row_number() over (partition by mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d')
                                  order by ts, seq) as rn
        from page where last_page_id is null) select mid, day, seq, ts from r where rn = 1""",
    "jumpout_pattern": f"with {NEIGHBOURS} select mid, seq, ts, {REASON} as reason from n where {PATTERN}",
    "jumpout_session": f"with {NEIGHBOURS} select mid, seq, ts from n where {IN_SESSION}",
    "jumpout_session_single": f"""with {NEIGHBOURS} select mid, seq, ts from n
        where last_page_id is null and (nts is null or nts - ts > {BOUND} or nlast is null)""",
    "session_windows": f"with {SESSIONS} select mid, first_ts, last_ts, n_rows from sessions",
    "cdc_normalise": f"""with {FEED} select seq, type, 'retail' as database, "tableName",
        case when type <> 'delete' then cast(o_totalprice as decimal(16,2)) end as total,
        case when k % 5 in (0, 1) then k end as before_key,
        type = 'delete' as no_data, coalesce(type <> 'delete' and k is not null, false) as null_kept
        from feed left join orders on k = o_orderkey""",
    "cdc_nonempty": f"""with {FEED} select "tableName", type, count(*) as n from feed
        where type <> 'delete' group by "tableName", type""",
    "cdc_table_filter": f"""with {FEED} select 'retail' as database, "tableName", count(*) as n from feed
        where "tableName" in ('order_info', 'base_province') group by "tableName" """,
    "cdc_keep_deletes": f"""with {FEED} select seq, case type when 'read' then 'insert' else type end as type,
        k as o_orderkey from feed where "tableName" = 'order_info'""",
    "cdc_route_fact": f"""with {FEED}, r as (
        select seq, case type when 'insert' then 'dwd_order_info' else 'dwd_order_info_u' end as sink_table,
          cast(o_orderkey as varchar) as o_orderkey,
          case when type = 'insert' then cast(o_custkey as varchar) end as o_custkey,
          case when type = 'insert' then cast(o_totalprice as decimal(16,2)) end as o_totalprice,
          case when type = 'update' then o_orderstatus end as o_orderstatus,
          cast(null as varchar) as c_custkey, cast(null as varchar) as c_name, cast(null as varchar) as n_name,
          case type when 'insert' then 'o_custkey,o_orderkey,o_totalprice'
                    else 'o_comment,o_orderkey,o_orderstatus' end as fields
        from feed join orders on k = o_orderkey where type in ('insert', 'update')) {FACT_CELLS}""",
    "cdc_route_dim": f"""with r as (
        select c_custkey as seq, 'dim_user_info' as sink_table, cast(null as varchar) as o_orderkey,
          cast(null as varchar) as o_custkey, cast(null as decimal(16,2)) as o_totalprice,
          cast(null as varchar) as o_orderstatus, cast(c_custkey as varchar) as c_custkey, c_name,
          cast(null as varchar) as n_name, 'c_custkey,c_mktsegment,c_name' as fields from customer
        union all select n_nationkey, 'dim_base_province', null, null, null, null, null, null, n_name,
          'n_name,n_nationkey' from nation) {FACT_CELLS}""",
    "cdc_unrouted": f"""with {FEED} select seq, type, "tableName" from feed where type = 'read'""",
    "cdc_route_pulled": f"""with {FEED} select seq, "tableName",
        case "tableName" when 'user_info' then 'dim_user_info' when 'base_province' then 'dim_base_province'
          else case type when 'insert' then 'dwd_order_info' else 'dwd_order_info_u' end end as sink_table,
        cast(case "tableName" when 'user_info' then 6 when 'base_province' then 4 else 7 end as integer) as n_fields
        from feed where type in ('insert', 'update')""",
    "rules_current": """with r as (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn
        from orders) select 't_' || o_custkey as source_table, 'insert' as operate_type,
        'dwd_' || o_orderkey as sink_table from r where rn = 1 and o_orderstatus <> 'F'""",
    "cdc_initial": """with f as (select max(o_orderkey) * 4 // 10 as low, max(o_orderkey) * 6 // 10 as high,
          max(o_orderkey) // 2 as mid from orders),
        t as (select o_orderkey as id, o_orderkey % 5 as k from orders),
        held as (select id, case when k = 2 or id > mid then 'old' else 'new' end as status from t, f
          where (k in (0, 2) or (k = 1 and id > mid) or (k in (3, 4) and id <= mid))
            and (k = 2 or id <= low or id > high))
        select low as seq, 'read' as type, id, status from held, f
        union all select id, case k when 0 then 'update' when 1 then 'delete' else 'insert' end, id,
          case when k <> 1 then 'new' end from t, f where k <> 2 and id > low""",
    "cdc_route_asof": f"""with {FEED}, {RULE_LOG}, placed as (
        select case "tableName" when 'user_info' then seq * 10 else seq end as seq, "tableName", type
        from feed where type <> 'delete')
        select seq, "tableName", p.type,
          case when k is null then 'unrouted' when src = 'user_info' then 'dim' else 'fact' end as route,
          case when src = 'user_info' then 'dim_v' || k else 'dwd_v' || k end as sink_table, fields
        from placed p left join versions v on p."tableName" = src and p.type = op and live
          and seq > pos and (until is null or seq <= until)""",
    "dim_upsert_current": """with u as (
        select o_custkey, max(o_orderkey) as last_order, max(o_orderkey) filter (where o_orderkey % 2 = 0) as s
        from orders group by o_custkey)
        select cast(u.o_custkey as varchar) as c_custkey, cast(last_order as varchar) as last_order,
          case when s % 4 = 0 then o_orderstatus end as last_status
        from u left join orders on o_orderkey = s""",
    "dim_user_age": f"with {DIMS} select id, gender, age from dim_user",
    "dim_join_user": f"""with {DIMS} select gender as user_gender, count(*) as n
        from orders left join dim_user on o_custkey = id group by gender""",
    "dim_join_province": f"""with {DIMS} select name as province_name, area_code as province_area_code,
        iso_code as province_iso_code, iso_3166_2 as province_3166_2_code, count(*) as n
        from customer left join dim_province on c_nationkey = id group by all""",
    "dim_join_sku": f"""with {DIMS} select tm_id, category3_id, spu_id, tm_name, category3_name, spu_name,
        count(*) as n from lineitem left join dim_sku_wide on l_partkey = id group by all""",
    "dim_join_trademark": f"with {DIMS} select id as sku_id, tm_name from dim_sku_wide",
    "dim_join_category3": f"with {DIMS} select id as sku_id, category3_name from dim_sku_wide",
    "dim_join_spu": f"with {DIMS} select id as sku_id, spu_name from dim_sku_wide",
    "order_parse": f"""with {ORDERS} select id, province_id, order_status, user_id, total_amount,
        original_total_amount, expire_time, operate_time, create_time, create_date, create_hour, create_ts from o""",
    "order_detail_parse": f"""with {ORDERS} select id, order_id, sku_id, sku_name, sku_num, order_price,
        split_total_amount, create_time, create_ts from d""",
    "order_dirty": f"""with {ORDERS}, texts as (
        select 'order' as kind, id from o union all select 'detail', id from d)
        select 'dirty_orders' as topic, kind,
          case id % 50 when 0 then 'not_json_object' when 1 then 'no_key' else 'no_time' end as reason, count(*) as n,
          cast(sum(case when id % 50 = 0 then 9 else 0 end) as bigint) as n_chars
        from texts where id % 50 < 3 group by all""",
    "order_unmatched": f"""with {ORDERS} select id, user_id, create_ts from o where not exists (
        select 1 from d where d.order_id = o.id
          and d.create_ts between o.create_ts - {INTERVAL} and o.create_ts + {INTERVAL})""",
    "stream_order_unmatched": f"""with {ORDERS}, w as (
        select least((select max(create_ts) from o), (select max(create_ts) from d)) as mark)
        select id from o, w where o.create_ts + {INTERVAL} < mark and not exists (
        select 1 from d where d.order_id = o.id
          and d.create_ts between o.create_ts - {INTERVAL} and o.create_ts + {INTERVAL})""",
    "stream_late": f"""with {LOG}, m as (select max(user_id) as last from events),
        placed as (select seq, ts, cast(user_id >= last // 4 as int) + cast(user_id >= last * 2 // 4 as int)
            + cast(user_id >= last * 3 // 4 as int) as batch from page, m),
        reached as (select b.batch, max(p.ts) - {WATERMARK_DELAY} as watermark
          from (select distinct batch from placed) b join placed p on p.batch < b.batch - 1 group by b.batch)
        select seq, watermark, ts from placed join reached using (batch) where ts <= watermark""",
    "order_interval_join": f"""with {PAIRS} select detail_id, order_id, sku_id, order_price, sku_num, province_id,
        order_status, user_id, total_amount, expire_time, create_date, create_hour, split_total_amount from pairs""",
    "order_wide_rows": f"""with {PAIRS}, {DIMS} select detail_id, order_id, sku_id, order_price, sku_num, sku_name,
        province_id, order_status, user_id, total_amount, cast(0 as decimal(16,2)) as activity_reduce_amount,
        cast(5 as decimal(16,2)) as coupon_reduce_amount, original_total_amount,
        cast(10 as decimal(16,2)) as feight_fee, cast(null as decimal(16,2)) as split_feight_fee,
        cast(0 as decimal(16,2)) as split_activity_amount, cast(1 as decimal(16,2)) as split_coupon_amount,
        split_total_amount, expire_time, create_time, operate_time, create_date, create_hour,
        p.name as province_name, area_code as province_area_code, iso_code as province_iso_code,
        iso_3166_2 as province_3166_2_code, age as user_age, gender as user_gender,
        cast(spu_id as bigint) as spu_id, cast(tm_id as bigint) as tm_id,
        cast(category3_id as bigint) as category3_id, spu_name, tm_name, category3_name
        from pairs left join dim_user u on user_id = u.id left join dim_province p on province_id = p.id
        left join dim_sku_wide s on sku_id = s.id""",
    "order_wide_merge": f"""with {GAPS} select order_id, {_first('order_status')}, {_first('total_amount')},
        {_first('sku_id')}, {_first('order_price')}, {_first('sku_num')} from gaps group by order_id""",
    "order_wide_merge_pair": f"""with {GAPS} select detail_id, order_id,
        coalesce(gaps.order_status, o.order_status) as order_status,
        coalesce(gaps.total_amount, o.total_amount) as total_amount, sku_id, order_price, gaps.create_date
        from gaps left join o on order_id = o.id""",
    "sink_topics": """select case when o_orderkey % 5 = 0 then 'dwd_order_info_u' else 'dwd_order_info' end as topic,
        o_orderkey from orders where o_orderkey % 5 in (0, 3, 4)""",
    "sink_quarantine": """select '{"common":{"mid":"mid_' || user_id as value, 'not_json_object' as reason
        from events where event_id % 50 = 0""",
    "stream_isnew": f"""with {TOPIC_ROWS} select topic, count(*) as n,
        cast(sum(case when fixed = '1' then 1 else 0 end) as bigint) as n_new from topic_rows group by topic""",
    "stream_uv_job": f"""with {LOG} select distinct mid,
        strftime(make_timestamp(ts * 1000), '%Y-%m-%d') as day from page where last_page_id is null""",
    "stream_jumpout": f"""with {NEIGHBOURS} select mid, seq, ts, {REASON} as reason from n
        where {PATTERN} and {DECIDED}""",
    "stream_jumpout_job": f"with {NEIGHBOURS} select mid, ts from n where {PATTERN} and {DECIDED}",
    "stream_session": f"with {NEIGHBOURS} select mid, seq, ts from n where {IN_SESSION} and {DECIDED}",
    "stream_jumpout_windows": f"""with {NEIGHBOURS} select mid, seq, ts, {REASON} as reason from n
        where {PATTERN} and {PASSED}""",
    "stream_jumpout_windows_job": f"with {NEIGHBOURS} select mid, ts from n where {PATTERN} and {PASSED}",
    "stream_session_by_windows": f"with {NEIGHBOURS} select mid, seq, ts from n where {IN_SESSION} and {PASSED}",
    "stream_session_windows": f"""with {SESSIONS} select mid, first_ts, last_ts, n_rows from sessions
        where last_ts + {BOUND} <= (select max(ts) - {WATERMARK_DELAY} from page)""",
    "stream_interval_join": f"""with {PAIRS} select detail_id, order_id, sku_id, order_price, sku_num, province_id,
        order_status, user_id, total_amount, expire_time, create_date, create_hour, split_total_amount from pairs""",
    "stream_order_wide": f"""with {PAIRS}, {DIMS} select detail_id, order_id, age as user_age, gender as user_gender,
        p.name as province_name, area_code as province_area_code, iso_code as province_iso_code,
        iso_3166_2 as province_3166_2_code,
        cast(spu_id as bigint) as spu_id, tm_name, category3_name, spu_name
        from pairs left join dim_user u on user_id = u.id left join dim_province p on province_id = p.id
        left join dim_sku_wide s on sku_id = s.id""",
    "stream_route": """select case o_orderkey % 5 when 0 then 'dwd_order_info_u' when 2 then 'unrouted_changes'
        else 'dwd_order_info' end as topic, o_orderkey from orders where o_orderkey % 5 <> 1""",
    "stream_dim_upsert": """select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer""",
    "dim_schema_change": """select cast(c_custkey as varchar) as c_custkey, c_name,
        case when c_custkey >= (select max(c_custkey) * 2 // 4 from customer) then c_mktsegment end as c_mktsegment
        from customer""",
    "stream_route_pulled": """select t as topic, t as sink_table, count(*) as n from (
        select case o_orderkey % 5 when 0 then 'dwd_order_info_u' else 'dwd_order_info' end as t
        from orders where o_orderkey % 5 in (0, 3, 4)) group by t""",
}
ORACLE["stream_order_wide_from_feed"] = ORACLE["stream_order_wide"]
ORACLE["stream_uv_daily"] = ORACLE["uv_daily"]
# The time zone of the local form is eight hours ahead all year.
ORACLE["stream_uv_daily_local"] = ORACLE["uv_daily"].replace("make_timestamp(ts * 1000)", "make_timestamp((ts + 28800000) * 1000)")
