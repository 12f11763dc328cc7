"""The record tables of the engine, derived from the driver's tables (FIXTURES.md), as text both SQL dialects share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: What the dialects write differently: {K} is the number under k in props, {EPOCH} the whole seconds of ts.
SPARK = {"{K}": "get_json_object(props, '$.k')", "{EPOCH}": "unix_seconds(cast(date_trunc('second', ts) as timestamp))"}
DUCK = {"{K}": "json_extract_string(props, '$.k')", "{EPOCH}": "cast(epoch(date_trunc('second', ts)) as bigint)"}

ADAPTERS = {
    "change_events": """
select lpad(cast(event_id as string), 16, '0') as id, event_id as seq,
       case event_type when 'signup' then 'insert' when 'purchase' then 'replace' when 'error' then 'delete' else 'update' end as operation_type,
       'app' as db, case when user_id % 3 = 0 then 'admins' else 'users' end as coll, cast(user_id as string) as document_key,
       date_trunc('second', ts) as cluster_time, ts, value, cast({K} as bigint) as k, cast({K} as bigint) % 10 = 0 as no_fields_changed
from events""",
    "monitor_entries": """
select cast(event_id as string) as event_id, concat('sub-', cast(event_id % 3 as string)) as subscription_id, event_type as event_name,
       concat('bus-', cast(event_id % 2 as string)) as bus_id,
       case when user_id % 5 = 0 then '' else concat('pod-', cast(user_id % 5 as string)) end as instance_id,
       case when event_id % 2 = 0 then 'broadcast' else 'worker_pool' end as delivery_mode,
       case event_id % 7 when 0 then 'pending' when 1 then 'failed' when 2 then 'retrying' else 'completed' end as status,
       case when event_id % 7 = 1 then 'boom' when event_id % 11 = 0 then null else '' end as error,
       cast(event_id % 4 as int) as retry_count, ts as started_at,
       case when event_id % 7 = 0 then null else cast(floor(value * 10) as bigint) end as duration_ms
from events""",
    "acks": """
select cast(event_id as string) as event_id, ts as created_at, case when event_id % 4 = 0 then null else ts + interval '1' minute end as acked_at
from events""",
    "outbox": """
select o_orderkey as id, concat('order.', lower(o_orderstatus)) as event_name, cast(o_orderkey as string) as event_id,
       case when o_orderstatus = 'O' then 'pending' when o_orderstatus = 'P' then 'processing' when o_orderkey % 5 = 0 then 'failed' else 'published' end as status,
       5 - cast(substr(o_orderpriority, 1, 1) as int) as priority, o_orderdate as created_at,
       case when o_orderstatus = 'P' then o_orderdate + interval '1' day end as claimed_at,
       case when o_orderstatus = 'F' and o_orderkey % 5 <> 0 then o_orderdate + interval '2' day end as published_at,
       cast(o_orderkey % 4 as int) as retry_count
from orders""",
    "queue": """
select o_orderkey as seq, concat('q-', cast(o_custkey % 4 as string)) as event_name,
       case o_orderstatus when 'O' then 'pending' when 'P' then 'inflight' else 'acked' end as status,
       o_orderdate as enqueued_at, cast(o_orderkey % 3 as int) as retry_count,
       case when o_orderstatus = 'P' then o_orderdate + interval '1' hour end as inflight_at,
       case when o_orderstatus = 'F' then o_orderdate + interval '1' day end as acked_at
from orders""",
    "claims": """
select cast(o_orderkey as string) as message_id,
       case o_orderstatus when 'O' then 'released' when 'P' then 'processing' else 'completed' end as status,
       concat('w-', cast(o_custkey % 8 as string)) as worker_id, concat('ev-', cast(o_orderkey % 3 as string)) as event_name,
       o_orderdate as created_at, o_orderdate + interval '1' hour as updated_at,
       o_orderdate + interval '30' day as expires_at, o_orderkey % 2 = 0 as has_payload
from orders""",
    "deliveries": "select cast(user_id as string) as message_id, event_id as seq, ts as arrived_at from events",
    "checkpoint_log": """
select event_type as event_name, concat('c-', cast(user_id % 5 as string)) as consumer_id, lpad(cast(event_id as string), 16, '0') as checkpoint, ts as updated_at, event_id as seq
from events""",
    "raw_changes": """
select *, case when seq % 23 = 0 then concat('{"_id":{"_data":"', cast(seq as string), '"') else concat('{"_id":{"_data":"', token, '"},"operationType":"', op, '","ns":{',
       case when seq % 19 = 0 then '' else concat('"db":"shop","coll":"', coll, '"') end, '},"documentKey":{"_id":',
       case user_id % 5 when 0 then concat('{"$oid":"', hex24, '"}') when 1 then concat('"k-', cast(user_id as string), '"') when 2 then cast(user_id as string)
            when 3 then '{"$binary":{"base64":"q80=","subType":"04"}}' else concat('{"$numberDouble":"', cast(user_id as string), '.50"}') end, '}',
       case when op in ('insert', 'replace') then concat(',"fullDocument":{"name":"n', cast(user_id as string), '","at":{"$date":{"$numberLong":"', cast(ms as string), '"}},"total":{"$numberDecimal":"1.50"},"n":{"$numberLong":"',
            cast(k as string), '"},"x":{"$numberDouble":"', case when seq % 29 = 0 then 'NaN' else '2.5' end, '"},"tags":["a<b",{"$oid":"0123456789abcdef01234567"}]}')
            when op = 'update' then concat(',"updateDescription":{"updatedFields":{', case when k % 10 = 0 then '' else concat('"k":', cast(k as string)) end, '},"removedFields":[', case when seq % 6 = 0 then '"old"' else '' end, ']',
            case when seq % 5 = 0 then ',"truncatedArrays":[{"field":"list","newSize":3}]' else '' end, '}') else '' end,
       ',"clusterTime":{"$timestamp":{"t":', cast(epoch as string), ',"i":1}}}') end as raw
from (select event_id as seq, user_id, case when event_id % 17 = 0 then '' else lpad(cast(event_id as string), 16, '0') end as token,
             case event_type when 'signup' then 'insert' when 'purchase' then 'replace' when 'error' then 'delete' else 'update' end as op,
             case when user_id % 3 = 0 then 'admins' else 'users' end as coll, lpad(cast(user_id as string), 24, '0') as hex24, cast({K} as bigint) as k,
             1704067200000 + event_id * 1000 + (event_id % 3) * 250 as ms, {EPOCH} as epoch, date_trunc('second', ts) as clock from events) t""",
    "ack_log": """
select cast(event_id as string) as event_id, event_id * 10 as seq, 'store' as op, ts as moment from events
union all select cast(event_id as string), event_id * 10 + 1, 'store', ts + interval '1' hour from events where event_id % 10 = 0
union all select cast(event_id as string), event_id * 10 + 2, 'ack', ts + interval '1' minute from events where event_id % 4 <> 0
union all select cast(event_id as string), event_id * 10 + 3, 'ack', ts + interval '2' minute from events where event_id % 8 = 1
union all select concat('x-', cast(event_id as string)), event_id * 10 + 4, 'ack', ts from events where event_id % 50 = 0""",
    "outbox_log": """
select o_orderkey as id, o_orderkey * 10 as seq, 'store' as op, o_orderdate as moment, cast(null as string) as worker, cast(null as string) as error from orders
union all select o_orderkey, o_orderkey * 10 + 1, 'claim', o_orderdate + interval '1' day, concat('w-', cast(o_custkey % 8 as string)), null from orders where o_orderstatus <> 'O'
union all select o_orderkey, o_orderkey * 10 + 2, 'fail', o_orderdate + interval '2' day, null, 'boom' from orders where o_orderstatus = 'F' and o_orderkey % 5 = 0
union all select o_orderkey, o_orderkey * 10 + 3, 'retry', o_orderdate + interval '3' day, null, null from orders where o_orderstatus = 'F' and o_orderkey % 10 = 0
union all select o_orderkey, o_orderkey * 10 + 4, 'claim', o_orderdate + interval '4' day, 'w-9', null from orders where o_orderstatus = 'F' and o_orderkey % 20 = 0
union all select o_orderkey, o_orderkey * 10 + 5, 'recover', o_orderdate + interval '5' day, null, null from orders where o_orderstatus = 'P' and o_orderkey % 3 = 0
union all select o_orderkey, o_orderkey * 10 + 6, 'ack', o_orderdate + interval '2' day, null, null from orders where o_orderstatus = 'F' and o_orderkey % 5 <> 0
union all select -o_orderkey, o_orderkey * 10 + 7, 'ack', o_orderdate, null, null from orders where o_orderkey % 50 = 0""",
    "queue_log": """
select o_orderkey as seq_id, o_orderkey * 10 as seq, 'append' as op, o_orderdate as moment from orders
union all select o_orderkey, o_orderkey * 10 + 1, 'fetch', o_orderdate + interval '1' hour from orders where o_orderstatus <> 'O'
union all select o_orderkey, o_orderkey * 10 + 2, 'nack', o_orderdate + interval '2' hour from orders where o_orderstatus <> 'O' and o_orderkey % 3 = 0
union all select o_orderkey, o_orderkey * 10 + 3, 'fetch', o_orderdate + interval '3' hour from orders where o_orderstatus <> 'O' and o_orderkey % 6 = 0
union all select o_orderkey, o_orderkey * 10 + 4, 'ack', o_orderdate + interval '1' day from orders where o_orderstatus = 'F'
union all select -o_orderkey, o_orderkey * 10 + 5, 'nack', o_orderdate from orders where o_orderkey % 50 = 0""",
    "lease_log": """
select cast(user_id as string) as message_id, event_id as seq, case event_type when 'purchase' then 'complete' when 'signup' then 'release' else 'acquire' end as op,
       ts as moment, concat('w-', cast(event_id % 4 as string)) as worker from events""",
    "dedup_log": "select cast(user_id as string) as message_id, event_id as seq, case event_type when 'error' then 'mark' else 'check' end as op, ts as moment from events",
    "lifecycle_log": """
select cast(user_id as string) as event_id, event_id * 10 as seq, 'start' as op, ts as moment, concat('sub-', cast(event_id % 3 as string)) as subscription_id, event_type as event_name,
       case when user_id % 2 = 0 then 'broadcast' else 'worker_pool' end as delivery_mode, cast(null as string) as status, cast(null as bigint) as duration_ms, cast(null as string) as error
from events where event_id % 2 = 0
union all select cast(user_id as string), event_id * 10 + 1, 'complete', ts + interval '1' second, case when event_id % 5 = 0 then '' else concat('sub-', cast(event_id % 3 as string)) end, null, null,
       case when event_id % 7 = 1 then 'failed' else 'completed' end, cast(floor(value) as bigint), case when event_id % 7 = 1 then 'boom' end from events where event_id % 3 <> 0
union all select cast(user_id as string), event_id * 10 + 2, 'publish', ts, null, event_type, null, null, null, null from events where event_id % 11 = 0""",
    "dead_letters": "select cast(event_id as string) as event_id, 'gave up' as reason, ts + interval '1' hour as moment from events where event_id % 14 = 1",
    "schema_log": "select event_type as name, cast({K} as int) as version, ts as written_at, event_id as seq from events",
}
EVENTS_NOW, ORDERS_NOW = "2024-01-31 00:00:00", "1999-01-01 00:00:00"


def sql_text(name: str, source: str) -> str:
    """The adapter as a template of spark.sql over the DataFrame named source."""
    text = ADAPTERS[name]
    for token, own in SPARK.items():
        text = text.replace(token, own)
    return text.replace("{", "{{").replace("}", "}}").replace(f"from {source}", f"from {{{source}}}")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A record table over the tables in sf_dir; the scan reads only the columns that a query ends up using."""
    source = "events" if "from events" in ADAPTERS[name] else "orders"
    return spark.sql(sql_text(name, source), **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})


def duck(name: str) -> str:
    """The same table as a named subquery of the other dialect."""
    text = ADAPTERS[name]
    for token, own in DUCK.items():
        text = text.replace(token, own)
    return f"{name} as ({text})"
