"""SQL for the same results, written for DuckDB over the plain tables.

The SQL works on the tables directly (no maps, no JSON) and states each rule its own way: windows
by integer division, "first" rules by ordinary window functions over all rows, joins without any
reduction beforehand unless the rule asks for one.
"""

from __future__ import annotations

import re

# ---- building blocks -----------------------------------------------------------

CTES: dict[str, str] = {}

CTES["ev"] = """
  select event_id, 'm' || user_id as mid, case when event_id % 3 <> 0 then user_id::varchar end as uid,
    'v' || (user_id % 3) as vc, 'c' || (user_id % 2) as ch, (user_id % 25)::varchar as ar,
    case when event_id % 4 = 0 then '1' else '0' end as is_new,
    case event_type when 'view' then 'good_detail' when 'click' then 'home' when 'signup' then 'login'
      when 'purchase' then 'trade' else 'cart' end as page_id,
    case when event_id % 5 = 2 then 'search' when event_id % 5 > 2 then 'home' end as last_page_id,
    case when event_id % 5 = 2 then p_name end as item,
    case when event_id % 5 = 2 then 'keyword' end as item_type,
    round(value * 100)::bigint as during_time,
    epoch_us(ts) // 1000 as slow_ms,
    (1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1000) // 1000 as fast_ms,
    event_type, props
  from events left join part on p_partkey = event_id % (select max(p_partkey) + 1 from part)"""
CTES["page"] = "select *, slow_ms as ts, make_timestamp(slow_ms * 1000)::date as d from ev"
CTES["fpage"] = "select *, fast_ms as ts, make_timestamp(fast_ms * 1000)::date as d from ev"

FIXED = """
  select * replace (case when is_new = '1' and d <> first_value(
      case when is_new = '1' then d else d - 1 end) over (partition by mid order by ts, event_id)
    then '0' else is_new end as is_new) from {src}"""
CTES["fixed"] = FIXED.format(src="page")
CTES["fixed_fast"] = FIXED.format(src="fpage")

JUMP = """
  select * from (
    select *, lead(ts) over w as n_ts, lead(last_page_id is null) over w as n_start
    from {src} window w as (partition by mid order by ts, event_id))
  where last_page_id is null and (n_ts is null or n_ts - ts >= 10000 or n_start)"""
CTES["jump"] = JUMP.format(src="fpage")

VISITOR = """
  select * from (select *, row_number() over (partition by mid, d order by ts, event_id) as rn
    from {src} where last_page_id is null) where rn = 1"""

LINE_TS = "(epoch(l_shipdate)::bigint + l_orderkey % 600)"
ORDER_TS = "(epoch(o_orderdate)::bigint + o_orderkey % 600)"


def stamp(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds})::bigint * 1000000), '%Y-%m-%d %H:%M:%S')"


def day(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds})::bigint * 1000000), '%Y-%m-%d')"


def amount(cents: str) -> str:
    return f"((({cents})::bigint)::decimal(18,0) * 0.01::decimal(3,2))::decimal(16,2)::varchar"


def bounds(seconds: str, size: int) -> str:
    start = f"(({seconds}) // {size} * {size})"
    return f"{stamp(start)} as stt, {stamp(start + f' + {size}')} as edt"


CTES["line"] = f"""
  select *, round(l_extendedprice * 100)::bigint as cents, l_quantity::bigint as qty,
    l_orderkey || '-' || l_linenumber as detail_id,
    l_orderkey || '-' || l_linenumber || '-' || round(l_extendedprice * 100)::bigint || '-' || l_partkey || '-'
      || l_suppkey as line_id,
    {LINE_TS} as sec from lineitem"""
CTES["net"] = f"""
  select *, {amount('(cents * (100 - round(l_discount * 100)::bigint) + 50) // 100')} as net_amount,
    {amount('(cents * 2 + qty) // (qty * 2)')} as price,
    (qty::decimal(16,2) * ({amount('(cents * 2 + qty) // (qty * 2)')})::decimal(16,2))::varchar as original
  from line"""
CTES["dic"] = "select * from (values ('A'), ('R'), ('F'), ('O')) v(code)"
CTES["detail"] = f"""
  select detail_id as order_detail_id, l_orderkey::varchar as order_id, l_partkey::varchar as sku_id,
    'sku ' || l_partkey as sku_name, price as order_price, qty::varchar as sku_num, {stamp('sec')} as order_create_time,
    l_returnflag as source_type, l_suppkey::varchar as source_id, original as split_original_amount,
    net_amount as split_total_amount, {amount('round(l_discount * 100)')} as split_activity_amount,
    {amount('round(l_tax * 100)')} as split_coupon_amount, sec as ts
  from net"""
CTES["info"] = f"""
  select o_orderkey::varchar as order_id, 'c' || o_custkey as consignee,
    '1' || lpad(o_custkey::varchar, 10, '0') as consignee_tel, {amount('round(o_totalprice * 100)')} as total_amount,
    case when v.type = 'insert' then '1001' when o_orderstatus = 'F' then '1002' when o_orderstatus = 'P' then '1003'
      else '1005' end as order_status,
    o_custkey::varchar as user_id, o_orderpriority as payment_way, 'T' || o_orderkey as out_trade_no,
    null::varchar as trade_body, case when v.type = 'update' then {stamp(ORDER_TS + ' + 30')} end as operate_time,
    {stamp(ORDER_TS + ' + 900')} as expire_time, null::varchar as process_status, null::varchar as tracking_no,
    null::varchar as parent_order_id, c_nationkey::varchar as province_id,
    case when o_orderkey % 4 <> 0 then {amount('o_orderkey % 50 * 100 + 25')} end as activity_reduce_amount,
    case when o_orderkey % 3 <> 0 then {amount('o_orderkey % 30 * 100 + 50')} end as coupon_reduce_amount,
    {amount('round(o_totalprice * 100) + 1000')} as original_total_amount,
    {amount('o_orderkey % 10 * 100')} as feight_fee, '0.00' as feight_fee_reduce, v.type as type,
    case when v.type = 'update' then '{{"order_status":"1001"}}' end as old
  from orders left join customer on c_custkey = o_custkey cross join (values ('insert'), ('update')) v(type)"""
CTES["act"] = f"""
  select * from (select detail_id, (l_partkey % 7)::varchar as activity_id, (l_suppkey % 5)::varchar as activity_rule_id,
    {stamp('sec')} as activity_create_time, row_number() over (partition by detail_id order by sec desc, line_id desc) as rn
    from line where l_discount > 0.05) where rn = 1"""
CTES["cou"] = f"""
  select * from (select detail_id, (l_partkey % 11)::varchar as coupon_id, line_id as coupon_use_id,
    {stamp('sec')} as coupon_create_time, row_number() over (partition by detail_id order by sec desc, line_id desc) as rn
    from line where l_tax > 0.04) where rn = 1"""
CTES["wide"] = """
  select d.*, i.* exclude (order_id), a.* exclude (detail_id, rn), c.* exclude (detail_id, rn), 'name ' || code as dic_name
  from detail d join info i on d.order_id = i.order_id join dic on code = source_type
    left join act a on a.detail_id = order_detail_id left join cou c on c.detail_id = order_detail_id"""
TIES = "ts desc, split_original_amount desc, sku_id desc, split_total_amount desc, source_id desc"
CTES["latest"] = f"""
  select * from (select *, row_number() over (partition by order_detail_id order by {TIES}) as rn
    from wide where type = 'insert') where rn = 1"""
CTES["latest_s"] = """
  select *, epoch(strptime(order_create_time, '%Y-%m-%d %H:%M:%S'))::bigint as sec from latest"""
CTES["paid"] = f"""
  select w.order_detail_id, w.order_id, w.user_id, w.sku_id, w.province_id, w.activity_id, w.activity_rule_id, w.coupon_id,
    p.pt as payment_type_code, 'name ' || code as payment_type_name, p.callback_time, w.source_id, w.source_type, w.sku_num,
    w.split_original_amount, w.split_activity_amount, w.split_coupon_amount, w.split_total_amount as split_payment_amount
  from wide w join (select o_orderkey::varchar as oid,
      case o_orderkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end as pt, {stamp(ORDER_TS + ' + 60')} as callback_time
    from orders where o_orderstatus = 'F' and o_orderkey % 10 <> 0) p on p.oid = w.order_id
    join dic on code = p.pt"""
CTES["paid_once"] = """
  select order_detail_id, user_id, callback_time from (
    select order_detail_id, user_id, callback_time, epoch(strptime(callback_time, '%Y-%m-%d %H:%M:%S')) as paid_sec,
      lag(paid_sec) over (partition by order_detail_id order by paid_sec, user_id) as before from paid)
  where before is null or paid_sec - before > 5"""
CTES["refund"] = f"""
  select line_id as id, l_suppkey::varchar as user_id, l_orderkey::varchar as order_id, l_partkey::varchar as sku_id,
    i.province_id, {day('sec')} as date_id, {stamp('sec')} as create_time, l_returnflag as refund_type_code,
    'name ' || t.code as refund_type_name,
    case when l_linenumber % 2 = 0 then l_linestatus else 'Z' end as refund_reason_type_code,
    'name ' || r.code as refund_reason_type_name, 'line ' || l_linenumber as refund_reason_txt, qty::varchar as refund_num,
    net_amount as refund_amount, sec as ts
  from net left join (select order_id, province_id from info where type = 'update' and order_status = '1005') i
      on i.order_id = l_orderkey::varchar
    left join dic t on t.code = l_returnflag
    left join dic r on r.code = case when l_linenumber % 2 = 0 then l_linestatus else 'Z' end
  where l_returnflag = 'R'"""
CTES["cart"] = f"""
  select line_id as id, o_custkey::varchar as user_id, l_partkey::varchar as sku_id, price as cart_price,
    case when l_linenumber = 1 then qty else l_linenumber - 3 end::int as sku_num, 'sku ' || l_partkey as sku_name,
    null::varchar as is_checked, {stamp(ORDER_TS)} as create_time,
    case when l_linenumber <> 1 then {stamp(ORDER_TS + ' + l_linenumber * 86400')} end as operate_time, '0' as is_ordered,
    null::varchar as order_time, l_returnflag as source_type, l_suppkey::varchar as source_id, 'name ' || code as dic_name
  from net join orders on o_orderkey = l_orderkey join dic on code = l_returnflag
  where l_linenumber = 1 or l_linenumber > 3"""
CTES["coupon"] = f"""
  select 'insert' as type, '' as key, * from line where l_linenumber = 1
  union all select 'update', 'using_time', * from line where l_discount > 0.05
  union all select 'update', 'used_time', * from line where l_tax > 0.04"""
CTES["sku"] = """
  select p_partkey::varchar as sku_id, p_name as spu_id,
    case when not starts_with(p_name, 'red') then 'spu ' || p_name end as spu_name, p_brand as trademark_id,
    case when p_brand <> 'Brand#9' then 'tm ' || p_brand end as trademark_name,
    p_size::varchar as category3_id, 'third ' || p_size as category3_name,
    (p_size % 10)::varchar as category2_id, 'second ' || (p_size % 10) as category2_name,
    (p_size % 10 % 3)::varchar as category1_id, 'first ' || (p_size % 10 % 3) as category1_name
  from part"""
CTES["partlog"] = """
  select 'bootstrap-insert' as type, p.*, 0 as plus from part p
  union all select 'update', p.*, 3600 from part p where p_partkey % 2 = 0
  union all select 'delete', p.*, 7200 from part p where p_partkey % 5 = 0"""

SPU = ("category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, spu_id, spu_name, "
       "trademark_id, trademark_name")
REF = ("trademark_id, trademark_name, category1_id, category1_name, category2_id, category2_name, category3_id, "
       "category3_name")
PAGE_COLS = "event_id, mid, page_id, last_page_id, ts"

# ---- one statement per query -----------------------------------------------------

SQL: dict[str, str] = {}

# every log record, and damaged copies of some: empty (event_id % 89 = 0) or cut short (% 97)
SQL["read_topic"] = """select event_id, 0::bigint as is_empty, 1::bigint as is_whole from page
  union all select event_id, (event_id % 89 = 0)::bigint, 0 from page where event_id % 89 = 0 or event_id % 97 = 0"""

SQL["read_change_log"] = f"""
  with x as (
    select 'order_info' as "table", 'insert' as type, {ORDER_TS} as ts from orders
    union all select 'order_info', 'update', {ORDER_TS} + 30 from orders
    union all select 'order_detail', 'insert', sec from line
    union all select 'order_detail_activity', 'insert', sec from line where l_discount > 0.05
    union all select 'order_detail_coupon', 'insert', sec from line where l_tax > 0.04
    union all select 'payment_info', 'update', {ORDER_TS} + 60 from orders where o_orderstatus <> 'P'
    union all select 'order_refund_info', 'insert', sec from line where l_returnflag = 'R'
    union all select 'cart_info', case when l_linenumber = 1 then 'insert' else 'update' end, {ORDER_TS}
      from line join orders on o_orderkey = l_orderkey
    union all select 'coupon_use', type, sec from coupon
    union all select case when l_linenumber % 3 = 0 then 'cart_info_mark' else 'favor_info' end,
      case when l_linenumber % 3 = 1 then 'insert' else 'update' end, sec from line
    union all select 'comment_info', 'insert', sec from line
    union all select 'user_info', 'insert', 1704067200 + c_custkey * 7 from customer
    union all select 'part', type, 1704067200 + p_partkey + plus from partlog
    union all select 'nation', 'insert', 1704067200 from nation)
  select "table", type, count(*) as n, sum(ts)::bigint as ts_sum, count(*) as with_id from x group by all"""

SQL["read_detail_topic"] = """select order_detail_id, order_id, sku_id, split_original_amount, type, order_status, user_id,
  activity_id, coupon_id, dic_name, ts from wide"""
SQL["read_dim"] = """select p_partkey::varchar as id, p_name as spu_id, p_brand as tm_id, p_size::varchar as category3_id
  from part"""
SQL["write_upsert"] = """
  select order_detail_id, order_id, sku_id, type, order_status, split_total_amount from (
    select *, row_number() over (partition by order_detail_id order by ts desc, type desc, split_original_amount desc,
      sku_id desc, split_total_amount desc, source_id desc) as rn from wide) where rn = 1"""
SQL["upsert_dim"] = f"""select p_partkey::varchar as id, p_name,
  {amount('round(p_retailprice * 100) + case when p_partkey % 2 = 0 then 100 else 0 end')} as p_retailprice from part"""

SQL["parse_json_or_dirty"] = """select event_id, 0::bigint as dirty, mid, ts from page
  union all select event_id, 1, null, null from page where event_id % 97 = 0 and event_id % 89 <> 0"""
SQL["drop_control_rows"] = "select type, p_partkey::varchar as id, 1704067200 + p_partkey + plus as ts from partlog"
SQL["drop_empty_and_keep_insert"] = """select order_detail_id, order_id, type, split_original_amount from wide
  where type = 'insert'"""
SQL["explode_displays"] = f"""select {PAGE_COLS}, props as item, pos::varchar as pos
  from page, unnest(range(1, (event_id % 4 + 1)::bigint)) u(pos) where event_id % 11 <> 0 and event_type = 'view'"""
SQL["explode_actions"] = f"""select {PAGE_COLS}, props as action_id, pos::varchar as pos
  from page, unnest(range(1, (event_id % 3 + 1)::bigint)) u(pos) where event_id % 11 <> 0 and event_type = 'click'"""

ROUTED = """
  select 'dwd_traffic_error_log' as topic, mid, is_new, ts::varchar as ts, case when event_id % 11 <> 0 then page_id end as page_id,
    (event_id % 10)::varchar as error_code, case when event_id % 11 = 0 then 'icon' end as entry, null::varchar as pos
    from {src} where event_type = 'error'
  union all select 'dwd_traffic_start_log', mid, is_new, ts::varchar, null, null, 'icon', null from {src} where event_id % 11 = 0
  union all select 'dwd_traffic_page_log', mid, is_new, ts::varchar, page_id, null, null, null from {src} where event_id % 11 <> 0
  union all select 'dwd_traffic_display_log', mid, is_new, ts::varchar, page_id, null, null, pos::varchar
    from {src}, unnest(range(1, (event_id % 4 + 1)::bigint)) u(pos) where event_id % 11 <> 0 and event_type = 'view'
  union all select 'dwd_traffic_action_log', mid, is_new, ts::varchar, page_id, null, null, pos::varchar
    from {src}, unnest(range(1, (event_id % 3 + 1)::bigint)) u(pos) where event_id % 11 <> 0 and event_type = 'click'"""
SQL["split_log"] = ROUTED.format(src="page")
SQL["base_log_split"] = ROUTED.format(src="fixed") + """
  union all select 'dirty_data', null, null, null, null, null, null, null from page
    where event_id % 97 = 0 and event_id % 89 <> 0"""
SQL["route_side_output"] = f"select topic, count(*) as n from ({SQL['base_log_split']}) group by topic"

SQL["pick_change"] = f"""select order_id as id, order_status, user_id, operate_time, {ORDER_TS} + 30 as ts
  from info join orders on o_orderkey::varchar = order_id where type = 'update'"""
CHANGED = """
  select 'coupon_use' as "table", line_id as id, {using}::bigint as using_time, 0::bigint as sku_num from coupon
    where type = 'update'
  union all select 'cart_info', line_id, 0, 1 from line join orders on o_orderkey = l_orderkey where l_linenumber <> 1"""
SQL["changed_key_not_null"] = CHANGED.format(using="0")
SQL["changed_key_exists"] = CHANGED.format(using="(key = 'using_time')")
SQL["prune_map_columns"] = """select '{"id":"' || p_partkey || '","p_name":"' || p_name || '"}' as data,
  1704067200 + p_partkey + 3600 as ts from part where p_partkey % 2 = 0"""
SQL["filter_home_detail"] = f"select {PAGE_COLS} from page where event_type in ('view', 'click')"
SQL["filter_session_start"] = f"select {PAGE_COLS} from page where event_id % 5 < 2"
SQL["filter_login"] = f"select {PAGE_COLS}, uid from page where event_id % 5 < 2 and event_id % 3 <> 0"
SQL["filter_search_keyword"] = f"select {PAGE_COLS}, item from page where event_id % 5 = 2 and item is not null"

SQL["join_order_wide"] = "select order_detail_id, sku_id, order_id, type, activity_id, coupon_id, dic_name, ts from wide"
SQL["join_payment_detail"] = "select order_detail_id, order_id, payment_type_name, split_payment_amount from paid"
SQL["join_refund"] = "select id, province_id, refund_type_name, refund_reason_type_name from refund"
SQL["lookup_join_inner"] = """select detail_id as order_detail_id, l_partkey::varchar as sku_id, l_returnflag as source_type,
  'name ' || code as dic_name from line join dic on code = l_returnflag"""
SQL["lookup_join_left"] = """select detail_id as order_detail_id, l_partkey::varchar as sku_id, l_returnflag as source_type,
  'name ' || code as dic_name from line left join dic on code = l_returnflag"""
SQL["dim_join"] = """select detail_id as order_detail_id, l_partkey::varchar as sku_id, sec as ts, p_name as spu_id,
  p_brand as tm_id from line left join part on p_partkey = l_partkey"""
SQL["dim_chain_order"] = f"""select detail_id as order_detail_id, sku_id, sec as ts, {SPU}
  from line left join sku on sku_id = l_partkey::varchar"""
SQL["dim_chain_refund"] = f"""select line_id as id, sku_id, {REF}
  from line left join sku on sku_id = l_partkey::varchar where l_returnflag = 'R'"""
SQL["dim_province"] = """select c_nationkey::varchar as province_id, count(*) as n, any_value(n_name) as province_name
  from orders join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey group by c_nationkey"""
SQL["broadcast_config_join"] = """
  select 'part' as "table", type, 'dim_part' as sink_table, p_partkey::varchar as id, 1704067200 + p_partkey + plus as ts
    from partlog
  union all select 'part', case when p_partkey % 200 = 0 then 'bootstrap-start' else 'bootstrap-complete' end, 'dim_part', null,
    1704067200 + p_partkey from part where p_partkey % 100 = 0
  union all select 'nation', 'insert', 'dim_nation', n_nationkey::varchar, 1704067200 from nation"""
SQL["dim_route"] = f"""
  select 'dim_part' as sink_table, type, 1704067200 + p_partkey + plus as ts, p_partkey::varchar as pk,
    '{{"id":"' || p_partkey || '","p_name":"' || p_name || '","p_retailprice":"' ||
    {amount("round(p_retailprice * 100) + case when type = 'update' then 100 else 0 end")} || '"}}' as data
    from partlog where type <> 'delete'
  union all select 'dim_nation', 'insert', 1704067200, n_nationkey::varchar,
    '{{"id":"' || n_nationkey || '","name":"' || n_name || '"}}' from nation"""

SQL["fix_is_new"] = f"select {PAGE_COLS}, is_new from fixed"
SQL["unique_visitor"] = f"select {PAGE_COLS} from ({VISITOR.format(src='page')})"
SQL["user_jump"] = f"select {PAGE_COLS} from jump"
SQL["order_detail_wide"] = "select * from wide"
SQL["order_add"] = "select order_detail_id, order_id, sku_id, sku_num, user_id, type from wide where type = 'insert'"
SQL["order_cancel"] = """select order_detail_id, order_id, sku_id, user_id, order_status, operate_time from wide
  where type = 'update' and order_status = '1003'"""
SQL["pay_success"] = "select * from paid"
SQL["order_refund"] = "select * from refund"
SQL["cart_add"] = "select * from cart"
SQL["coupon_get"] = f"""select line_id as id, (l_partkey % 11)::varchar as coupon_id, l_suppkey::varchar as user_id,
  {day('sec')} as date_id, {stamp('sec')} as get_time, sec as ts from coupon where type = 'insert'"""
COUPON = """select line_id as id, (l_partkey % 11)::varchar as coupon_id, l_suppkey::varchar as user_id,
  l_orderkey::varchar as order_id, {day} as date_id, {stamp} as {name}, sec as ts from coupon where key = '{key}'"""
SQL["coupon_order"] = COUPON.format(day=day("sec + 86400"), stamp=stamp("sec + 86400"), name="order_time", key="using_time")
SQL["coupon_pay"] = COUPON.format(day=day("sec + 172800"), stamp=stamp("sec + 172800"), name="payment_time", key="used_time")
SQL["favor_add"] = f"""select line_id as id, l_suppkey::varchar as user_id, l_partkey::varchar as sku_id, {day('sec')} as date_id,
  {stamp('sec')} as create_time, sec as ts from line where l_linenumber % 3 <> 0"""
SQL["comment_add"] = f"""select line_id as id, l_suppkey::varchar as user_id, l_partkey::varchar as sku_id,
  l_orderkey::varchar as order_id, {day('sec')} as date_id, {stamp('sec')} as create_time, l_returnflag as appraise_code,
  'name ' || code as appraise_name, sec as ts from line left join dic on code = l_returnflag"""
SQL["user_register"] = f"""select c_custkey::varchar as user_id, {day('1704067200 + c_custkey * 7')} as date_id,
  {stamp('1704067200 + c_custkey * 7')} as create_time, 1704067200 + c_custkey * 7 as ts from customer"""

WORDS = r"unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+'))"
SQL["kw_window"] = f"""
  select 'search' as source, {bounds('ts // 1000', 10)}, keyword, count(*) as keyword_count
  from (select ts, {WORDS.format(text='item')} as keyword from fpage where event_id % 5 = 2) group by all"""
# Four lots of records; the watermark of a lot comes from the words of the lots before it.
CTES["lots"] = f"""
  select (event_id * 3 // (select max(event_id) + 1 from events)) + (event_id % 7 = 3)::int as lot, ts // 1000 as sec,
    {WORDS.format(text='item')} as keyword from fpage where event_id % 5 = 2"""
CTES["marks"] = """
  select l.lot, max(e.sec) - 2 as mark from (select unnest(range(0, 5)) as lot) l join lots e on e.lot < l.lot group by l.lot"""
CTES["in_time"] = """
  select lots.*, coalesce(sec // 10 * 10 + 10 > mark, true) as counted from lots left join marks on marks.lot = lots.lot
  where sec // 10 * 10 + 10 <= (select max(mark) from marks)"""
SQL["watermark"] = f"""
  select 'search' as source, {bounds('sec', 10)}, keyword, count(*) as keyword_count from in_time where counted group by all"""
SQL["late_data"] = f"""
  select {bounds('sec', 10)}, keyword, count(*) as n_rows, sum(counted::int)::bigint as n_counted,
    sum((not counted)::int)::bigint as n_late from in_time group by all"""
UNION = """
  select ts, ar, ch, is_new, vc, 1 as uv_ct, 0 as sv_ct, 0 as pv_ct, 0 as dur_sum, 0 as uj_ct from ({uv})
  union all select ts, ar, ch, is_new, vc, 0, 0, 0, 0, 1 from ({uj})
  union all select ts, ar, ch, is_new, vc, 0, case when last_page_id is null then 1 else 0 end, 1, during_time, 0 from {src}"""
SQL["traffic_window"] = f"""
  with p as (select * from fixed_fast where event_id % 11 <> 0)
  select {bounds('ts // 1000', 5)}, ar, ch, is_new, vc, sum(uv_ct)::bigint as uv_ct, sum(sv_ct)::bigint as sv_ct,
    sum(pv_ct)::bigint as pv_ct, sum(dur_sum)::bigint as dur_sum, sum(uj_ct)::bigint as uj_ct
  from ({UNION.format(uv=VISITOR.format(src='p'), uj=JUMP.format(src='p'), src='p')}) group by all"""
SQL["traffic_window_from_streams"] = SQL["traffic_window"]
SQL["union_streams"] = f"""select ts, ar, ch, is_new, vc, uv_ct::bigint as uv_ct, sv_ct::bigint as sv_ct, pv_ct::bigint as pv_ct,
  dur_sum::bigint as dur_sum, uj_ct::bigint as uj_ct
  from ({UNION.format(uv=VISITOR.format(src='fpage'), uj='select * from jump', src='fpage')})"""

FIRSTS = """(select *, lag(d) over (partition by {key} order by ts, event_id) as prev from page where {cond})"""
SQL["home_detail_uv_window"] = f"""
  select {bounds('ts // 1000', 10)}, sum(case when page_id = 'home' then 1 else 0 end)::bigint as home_uv_ct,
    sum(case when page_id = 'good_detail' then 1 else 0 end)::bigint as good_detail_uv_ct
  from {FIRSTS.format(key='mid, page_id', cond="page_id in ('home', 'good_detail')")}
  where prev is null or prev <> d group by all"""
LOGIN = "uid is not null and last_page_id is null"
SQL["login_window"] = f"""
  select {bounds('ts // 1000', 10)}, sum(case when d - prev >= 8 then 1 else 0 end)::bigint as back_ct, count(*) as uu_ct
  from {FIRSTS.format(key='uid', cond=LOGIN)} where prev is null or prev <> d group by all"""
SQL["register_window"] = f"""select {bounds('1704067200 + c_custkey * 7', 10)}, count(*) as register_ct from customer group by all"""
SQL["cart_uu_window"] = f"""
  with x as (select user_id, coalesce(operate_time, create_time) as t from cart),
  y as (select *, epoch(strptime(t, '%Y-%m-%d %H:%M:%S'))::bigint as sec,
    row_number() over (partition by user_id, t[1:10] order by t) as rn from x)
  select {bounds('sec', 10)}, count(*) as cart_add_uu_ct from y where rn = 1 group by all"""

ORDER_WINDOW = """
  with x as (select *, lag(order_create_time[1:10]) over w as prev,
      row_number() over (partition by order_id, sec // 10 order by sec, order_detail_id) as nth from latest_s
    window w as (partition by user_id order by sec, order_detail_id))
  select {bounds}, sum((prev is null or prev <> order_create_time[1:10])::int)::bigint as order_unique_user_count,
    sum((prev is null)::int)::bigint as order_new_user_count,
    {sums}
  from x group by all"""
_AMOUNTS = {"order_activity_reduce_amount": "activity_reduce_amount", "order_coupon_reduce_amount": "coupon_reduce_amount",
            "order_original_total_amount": "original_total_amount"}
SQL["order_window"] = ORDER_WINDOW.format(bounds=bounds("sec", 10), sums=", ".join(
    f"sum(coalesce({c}::decimal(16,2), 0))::double as {n}" for n, c in _AMOUNTS.items()))
SQL["order_window_per_order"] = ORDER_WINDOW.format(bounds=bounds("sec", 10), sums=", ".join(
    f"sum(case when nth = 1 then coalesce({c}::decimal(16,2), 0) else 0 end)::double as {n}" for n, c in _AMOUNTS.items()))
SQL["payment_window"] = f"""
  with x as (select *, epoch(strptime(callback_time, '%Y-%m-%d %H:%M:%S'))::bigint as sec,
    lag(callback_time[1:10]) over (partition by user_id order by callback_time, order_detail_id) as prev from paid_once)
  select {bounds('sec', 10)}, count(*) as payment_suc_unique_user_count,
    sum((prev is null)::int)::bigint as payment_suc_new_user_count
  from x where prev is null or prev <> callback_time[1:10] group by all"""
SQL["province_window"] = f"""
  select {bounds('sec', 10)}, province_id, n_name as province_name, count(distinct order_id) as order_count,
    sum(split_total_amount::decimal(16,2))::double as order_amount
  from latest_s left join nation on n_nationkey::varchar = province_id group by all"""
SQL["spu_order_window"] = f"""
  select {bounds('sec', 10)}, user_id, {SPU}, count(distinct order_id) as order_count,
    sum(split_total_amount::decimal(16,2))::double as order_amount
  from latest_s left join sku using (sku_id) group by all"""
SQL["refund_window"] = f"""
  select {bounds('ts', 10)}, sku_id, {REF}, count(*) as refund_count
  from refund left join sku using (sku_id) group by all"""
SQL["refund_window_by_user"] = f"""
  select {bounds('ts', 10)}, user_id, {REF}, count(*) as refund_count
  from refund left join sku using (sku_id) group by all"""

SQL["first_of_day"] = """select mid as key, strftime(d, '%Y-%m-%d') as day, min(ts) as first_time
  from page where page_id in ('home', 'good_detail') group by mid, d"""
SQL["first_of_day_and_ever"] = f"""select uid as key, strftime(d, '%Y-%m-%d') as day, ts as first_time,
  (prev is null)::bigint as is_new from {FIRSTS.format(key='uid', cond='uid is not null')} where prev is null or prev <> d"""
SQL["returning_user"] = f"""select uid as key, strftime(d, '%Y-%m-%d') as day, ts as first_time,
  coalesce(d - prev >= 8, false)::bigint as is_back from {FIRSTS.format(key='uid', cond=LOGIN)}
  where prev is null or prev <> d"""
SQL["dedup_keep_last"] = f"""select order_detail_id, sku_id, order_price, split_total_amount, ts from (
  select *, row_number() over (partition by order_detail_id order by {TIES}) as rn from detail) where rn = 1"""
SQL["dedup_keep_first"] = """select order_id, id, create_time from (
  select *, row_number() over (partition by order_id order by create_time, id) as rn from refund) where rn = 1"""
SQL["dedup_keep_first_sliding"] = "select order_detail_id, user_id, callback_time from paid_once"

SQL["time_functions"] = """select event_id, strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') as full,
  strftime(d, '%Y-%m-%d') as day, ts // 1000 * 1000 as full_ms, epoch_ms(d::timestamp) as day_ms,
  strftime(d, '%Y-%m-%d') as day_part,
  strftime(make_timestamp(ts // 10000 * 10000000), '%Y-%m-%d %H:%M:%S') as stt from page"""
SQL["compare_zulu"] = """
  with x as (select event_id, strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') || '.' ||
      lpad((ts % 1000)::varchar, 3, '0') as t, ts % 1000 as ms, event_id % 3 as k from page),
  y as (select *, case k when 0 then ms // 100 * 100 when 1 then ms // 10 * 10 else ms end as cut_ms from x)
  select event_id, t[1:21 + k] || 'Z' as a, t || 'Z' as b, (case when cut_ms < ms then -1 else 0 end)::bigint as cmp from y"""
SQL["keyword_split"] = f"""select event_id, item, {WORDS.format(text='item')} as word from page
  where event_id % 5 = 2 and item is not null"""
# Phrases without blanks, cut by the words in part names: the longest first, a letter that begins none alone.
CTES["cutting"] = r"""
  select string_agg(w, '|' order by length(w) desc, w) || '|\p{L}|\p{N}+' as pattern from (
    select distinct unnest(regexp_extract_all(lower(p_name), '[\p{L}\p{N}]+')) as w from part)
  where regexp_full_match(w, '\p{L}+')"""
LISTED = "unnest(regexp_extract_all(lower(replace(item, ' ', '')), pattern))"
SQL["kw_window_word_list"] = f"""
  select 'search' as source, {bounds('ts // 1000', 10)}, keyword, count(*) as keyword_count
  from (select ts, {LISTED} as keyword from fpage, cutting where event_id % 5 = 2) group by all"""
SQL["keyword_split_function"] = f"""select event_id, replace(item, ' ', '') as item, {LISTED} as word from page, cutting
  where event_id % 5 = 2 and item is not null"""
# Written to a table and read back: the results are those of the rows that went in.
SQL["read_dictionary"] = SQL["lookup_join_inner"]
SQL["read_dim_config"] = f"select sink_table, type, count(*) as n from ({SQL['dim_route']}) group by all"
SQL["write_topic"] = "select order_detail_id, order_id, sku_id, type from wide"
SQL["write_append_table"] = SQL["user_register"]
SQL["ensure_dim_table"] = "select p_partkey::varchar as id, p_name from part"
SQL["keyword_count"] = f"""select lang, keyword, count(*) as keyword_count from (
  select lang, {WORDS.format(text='text')} as keyword from documents) group by all"""


def _needed(text: str) -> list[str]:
    """Building blocks a statement uses, in dependency order."""
    out: list[str] = []

    def visit(sql: str) -> None:
        for name, body in CTES.items():
            if name not in out and re.search(rf"\b(from|join|,)\s*\(?{name}\b", sql):
                visit(body)
                if name not in out:
                    out.append(name)

    visit(text)
    return out


def statement(name: str) -> str:
    body = SQL[name].strip()
    blocks = ",\n".join(f"{n} as ({CTES[n]})" for n in _needed(body))
    if not blocks:
        return body
    if body.startswith("with "):
        return f"with {blocks},\n{body[5:]}"
    return f"with {blocks}\n{body}"


def oracle() -> dict[str, str]:
    return {name: statement(name) for name in SQL}
