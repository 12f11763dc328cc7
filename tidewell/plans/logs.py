"""Queries over logs of transitions, each with the SQL that gives the same rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import changes, folds, state
from tidewell.plans.registry import ORACLES, query
from tidewell.sources.adapters import EVENTS_NOW, ORDERS_NOW, duck

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
FIRST = "select event_id, min(seq) as began, arg_min(moment, seq) as created_at from ack_log where op = 'store' group by event_id"
ACKED = f"(select b.event_id, b.created_at, (select arg_min(a.moment, a.seq) from ack_log a where a.event_id = b.event_id and a.op = 'ack' and a.seq > b.began) as acked_at from ({FIRST}) b)"


@query("ack_log", f"select * from {ACKED}")
def ack_state(log: DataFrame) -> DataFrame:
    return folds.ack_state(log)


@query("ack_log", f"select count(*) as stored, count(acked_at) as acked, count(*) - count(acked_at) as pending from {ACKED}")
def ack_pending_gauge(log: DataFrame) -> DataFrame:
    """The pending gauge: new stores less real acknowledgements."""
    s = folds.ack_state(log)
    return s.agg(F.count(F.lit(1)).alias("stored"), F.count("acked_at").alias("acked"), (F.count(F.lit(1)) - F.count("acked_at")).alias("pending"))


@query("ack_log", f"select event_id, acked_at from {ACKED} where acked_at is null or acked_at + interval 20 day > timestamp '{EVENTS_NOW}'")
def ack_retention(log: DataFrame) -> DataFrame:
    """What an expiry of 20 days leaves: pending ones never expire."""
    return folds.unexpired(folds.ack_state(log), "acked_at", EVENTS_NOW, "20 days").select("event_id", "acked_at")


@query("ack_log", "select event_id, seq from ack_log l where op = 'ack' and not exists (select 1 from ack_log s where s.op = 'store' and s.event_id = l.event_id)")
def ack_unknown(log: DataFrame) -> DataFrame:
    return folds.unknown(log, "event_id", "store").select("event_id", "seq")


_OUTBOX = """(select id, case last_op when 'store' then 'pending' when 'claim' then 'processing' when 'ack' then 'published' when 'fail' then 'failed' else 'pending' end as status,
case when freed = 'claim' then claimed_at end as claimed_at, case when unowned = 'claim' then claimed_by end as claimed_by, published_at, last_error, retry_count, created_at from (
select id, arg_max(op, seq) as last_op, arg_max(op, seq) filter (op in ('claim', 'recover')) as freed, arg_max(op, seq) filter (op in ('claim', 'recover', 'retry')) as unowned, arg_max(moment, seq) filter (op = 'claim') as claimed_at,
arg_max(worker, seq) filter (op = 'claim') as claimed_by, arg_max(moment, seq) filter (op = 'ack') as published_at, arg_max(error, seq) filter (op = 'fail') as last_error, cast(count(*) filter (op = 'fail') as integer) as retry_count,
min(moment) filter (op = 'store') as created_at, bool_or(op = 'store') as stored from outbox_log group by id) where stored)"""


@query("outbox_log", f"select * from {_OUTBOX}")
def outbox_state(log: DataFrame) -> DataFrame:
    return folds.outbox_state(log)


@query("outbox_log outbox", f"""select s.id, 100 as seq, 'claim' as op, timestamp '{ORDERS_NOW}' as moment, 'relay-1' as worker, cast(null as varchar) as error from {_OUTBOX} s join outbox o on o.id = s.id where s.status in ('pending', 'failed')
order by o.priority desc, s.created_at, s.id limit 150""")
def outbox_claim_transition(log: DataFrame, o: DataFrame) -> DataFrame:
    """The log rows by which a relay takes its next batch, with owner and time."""
    return folds.claim(folds.outbox_state(log).join(o.select("id", "priority"), "id"), 150, "relay-1", ORDERS_NOW, 100)


@query("outbox_log outbox", f"""select id, status, claimed_by, retry_count from (select s.id, case when c.id is null then s.status else 'processing' end as status, case when c.id is null then s.claimed_by else 'relay-1' end as claimed_by, s.retry_count
from {_OUTBOX} s left join (select s.id from {_OUTBOX} s join outbox o on o.id = s.id where s.status in ('pending', 'failed') order by o.priority desc, s.created_at, s.id limit 150) c on c.id = s.id)""")
def outbox_after_claim(log: DataFrame, o: DataFrame) -> DataFrame:
    """The state after that batch: its rows appended to the log and folded."""
    seq = 1 << 60
    rows = folds.claim(folds.outbox_state(log).join(o.select("id", "priority"), "id"), 150, "relay-1", ORDERS_NOW, seq)
    return folds.outbox_state(log.unionByName(rows)).select("id", "status", "claimed_by", "retry_count")


@query("outbox_log outbox", f"""select s.id, case when o.event_id like '%7' then 'published' when o.event_id like '%8' then 'failed' else s.status end as status, case when o.event_id like '%8' then 'late' else s.last_error end as last_error,
s.retry_count + case when o.event_id like '%8' then 1 else 0 end as retry_count from {_OUTBOX} s join outbox o on o.id = s.id""")
def outbox_by_event_id(log: DataFrame, o: DataFrame) -> DataFrame:
    """Messages acknowledged and failed by event id: a semi join to the events named."""
    named, seq = o.select("id", "event_id"), 1 << 60
    acked = folds.by_event(named, o.where("event_id like '%7'"), "ack", ORDERS_NOW, seq)
    failed = folds.by_event(named, o.where("event_id like '%8'"), "fail", ORDERS_NOW, seq, "late")
    return folds.outbox_state(log.unionByName(acked).unionByName(failed)).select("id", "status", "last_error", "retry_count")


@query("outbox_log", "select id, op from outbox_log l where not exists (select 1 from outbox_log s where s.op = 'store' and s.id = l.id)")
def outbox_unknown(log: DataFrame) -> DataFrame:
    """Acks and failures of messages that are not there: the not-found errors."""
    return folds.unknown(log, "id", "store").select("id", "op")


@query("outbox_log", f"select count(*) as deleted from {_OUTBOX} where status = 'published' and published_at < timestamp '{ORDERS_NOW}' - interval 1500 day")
def outbox_cleanup_count(log: DataFrame) -> DataFrame:
    """How many rows a cleanup deletes."""
    return state.stuck(folds.outbox_state(log), "published", "published_at", ORDERS_NOW, "1500 days").agg(F.count(F.lit(1)).alias("deleted"))


@query("queue_log", """select seq_id, case arg_max(op, seq) when 'append' then 'pending' when 'fetch' then 'inflight' when 'ack' then 'acked' else 'pending' end as status,
case when arg_max(op, seq) filter (op in ('fetch', 'nack')) = 'fetch' then arg_max(moment, seq) filter (op = 'fetch') end as inflight_at, arg_max(moment, seq) filter (op = 'ack') as acked_at, cast(count(*) filter (op = 'nack') as integer) as retry_count
from queue_log group by seq_id having bool_or(op = 'append')""")
def queue_state(log: DataFrame) -> DataFrame:
    return folds.queue_state(log)


@query("queue_log", "select seq_id, op from queue_log l where not exists (select 1 from queue_log s where s.op = 'append' and s.seq_id = l.seq_id)")
def queue_unknown(log: DataFrame) -> DataFrame:
    return folds.unknown(log, "seq_id", "append").select("seq_id", "op")


_FETCH = f"""select event_name, seq, 'inflight' as status, timestamp '{ORDERS_NOW}' as inflight_at, retry_count from (select *, row_number() over (partition by event_name order by enqueued_at, seq) as n from queue
where seq > 500 and (status = 'pending' or status = 'inflight' and inflight_at < timestamp '{ORDERS_NOW}' - interval 5 minute)) where n <= 5"""


@query("queue", _FETCH)
def queue_fetch_after_checkpoint(q: DataFrame) -> DataFrame:
    """The next messages past a checkpoint, as they are once in flight; late redelivery is no retry."""
    taken = state.fetch(q.where("seq > 500"), 5, ORDERS_NOW)
    return taken.select("event_name", "seq", F.lit("inflight").alias("status"), F.expr(f"timestamp_ntz '{ORDERS_NOW}'").alias("inflight_at"), "retry_count")


# The fold of leases entry by entry: who holds one, until when.
_LEASES = """l as (select *, row_number() over (partition by message_id order by moment, seq) as n from lease_log),
r(message_id, n, seq, op, won, status, worker_id, expires_at, created_at, updated_at) as (
  select message_id, 0::bigint, null::bigint, null::varchar, false, null::varchar, null::varchar, null::timestamp, null::timestamp, null::timestamp from (select distinct message_id from l)
  union all
  select message_id, n2, seq2, op2, w, case when w then 'processing' when op2 = 'complete' and status is not null then 'completed' when op2 = 'release' then null else status end,
    case when w then worker when op2 = 'release' then null else worker_id end, case when w then moment + interval 1 hour when op2 = 'complete' and status is not null then moment + interval 1 day when op2 = 'release' then null else expires_at end,
    case when w then coalesce(created_at, moment) when op2 = 'release' then null else created_at end, case when w or op2 = 'complete' and status is not null then moment when op2 = 'release' then null else updated_at end
  from (select r.*, l.moment, l.worker, l.n as n2, l.seq as seq2, l.op as op2, l.op = 'acquire' and (r.status is null or r.expires_at < l.moment) as w from r join l on l.message_id = r.message_id and l.n = r.n + 1))"""


def _recursive(table: str, ctes: str, select: str) -> str:
    return f"with recursive {duck(table)}, {ctes} {select}"


@query("lease_log", None)
def lease_wins(log: DataFrame) -> DataFrame:
    """Who gets the lease, of all that try."""
    return folds.lease_wins(log, HOUR, DAY)


@query("lease_log", None)
def lease_state(log: DataFrame) -> DataFrame:
    return folds.lease_state(log, HOUR, DAY)


@query("lease_log", None)
def lease_reset_stale(log: DataFrame) -> DataFrame:
    """Leases once those in processing and not touched for a day are reset, as a capped store does."""
    return folds.reset_stale(folds.lease_state(log, HOUR, DAY), EVENTS_NOW, "1 day", keep_rows=True).select("message_id", "status", "expires_at")


@query("dedup_log", None)
def dedup_with_marks(log: DataFrame) -> DataFrame:
    """Which checks find a duplicate, where marks start the expiry anew."""
    return folds.marked_dedup(log, DAY)


@query("lifecycle_log", """select event_id, subscription_id, b.event_name as event_name, b.moment as started_at, case when c.seq > b.seq then c.status when b.op = 'publish' then 'published' else 'pending' end as status,
case when c.seq > b.seq then c.duration_ms end as duration_ms, case when c.seq > b.seq then c.moment when b.op = 'publish' then b.moment end as completed_at, case when c.seq > b.seq then c.error end as error from (
select event_id, sub as subscription_id, arg_max({'seq': seq, 'moment': moment, 'event_name': event_name, 'op': op}, rank) filter (op <> 'complete') as b, arg_max({'seq': seq, 'moment': moment, 'status': status, 'duration_ms': duration_ms, 'error': error}, seq) filter (op = 'complete') as c
from (select *, case when op = 'start' and delivery_mode = 'worker_pool' then '' when op = 'publish' then '__publish__' else subscription_id end as sub, case when op = 'start' and delivery_mode = 'worker_pool' then -seq else seq end as rank from lifecycle_log) group by event_id, sub) where b is not null""")
def monitor_lifecycle(log: DataFrame) -> DataFrame:
    """Start, completion and publication of deliveries, folded."""
    return folds.lifecycle_state(log)


_VERSIONS = "select *, m is null or version >= m as accepted from (select *, max(version) over (partition by name order by seq rows between unbounded preceding and 1 preceding) as m from schema_log)"


@query("schema_log", f"select name, arg_max(version, seq) as version, arg_min(written_at, seq) as created_at, arg_max(written_at, seq) as updated_at from ({_VERSIONS}) where accepted group by name")
def schema_state(log: DataFrame) -> DataFrame:
    return folds.schema_state(log)


@query("schema_log", f"select name, version, written_at as updated_at, seq from ({_VERSIONS}) where accepted")
def schema_change_feed(log: DataFrame) -> DataFrame:
    return folds.schema_changes(log)


@query("change_events", "select document_key, arg_min(id, seq) as id from change_events where operation_type = 'insert' and document_key not in (select document_key from change_events where operation_type = 'delete' and cast(document_key as bigint) % 4 = 0) group by document_key")
def insert_unless_there(c: DataFrame) -> DataFrame:
    """One row for each new key, the first of it: a key that is there already is a duplicate."""
    there = c.where("operation_type = 'delete' and cast(document_key as bigint) % 4 = 0").select("document_key").distinct()
    return folds.insert_new(c.where("operation_type = 'insert'").select("document_key", "id", "seq"), there, "document_key", "seq").select("document_key", "id")


@query("outbox", "select id, case when id % 3 = 0 then 'replaced' else status end as status from outbox where id % 2 = 0")
def replace_existing(o: DataFrame) -> DataFrame:
    """Rows replace those of their id; a replacement of what is not there changes nothing."""
    there = o.where("id % 2 = 0").select("id", "status")
    return folds.replace(o.where("id % 3 = 0").select("id", F.lit("replaced").alias("status")), there, "id")


@query("outbox", "select id from outbox where id % 3 = 0 and id % 2 <> 0")
def replace_missing(o: DataFrame) -> DataFrame:
    """The replacements whose row is not there: the not-found errors."""
    return folds.missing(o.where("id % 3 = 0").select("id"), o.where("id % 2 = 0"), "id")


@query("monitor_entries acks dead_letters", "select m.event_id, m.status, a.acked_at is not null as acked, d.reason from monitor_entries m left join acks a using (event_id) left join dead_letters d using (event_id) where m.status in ('failed', 'retrying')")
def diagnose_dead_letters(m: DataFrame, a: DataFrame, d: DataFrame) -> DataFrame:
    """Failed deliveries with their acknowledgement and dead letter."""
    failed = m.where(F.col("status").isin("failed", "retrying")).select("event_id", "status")
    acked = a.select("event_id", F.col("acked_at").isNotNull().alias("_acked"))
    return failed.join(acked, "event_id", "left").join(d.select("event_id", "reason"), "event_id", "left").select("event_id", "status", F.coalesce("_acked", F.lit(False)).alias("acked"), "reason")


@query("checkpoint_log", "select consumer_id, arg_max(checkpoint, seq) as checkpoint from checkpoint_log group by consumer_id")
def checkpoint_by_consumer(c: DataFrame) -> DataFrame:
    """The collapsed view of a listing over all events: consumers that events share overwrite one another."""
    return changes.latest_per_key(c, ["consumer_id"], F.col("seq")).select("consumer_id", "checkpoint")


def _sql() -> None:
    ORACLES["lease_wins"] = _recursive("lease_log", _LEASES, "select message_id, seq, won from r where op = 'acquire'")
    last = "(select * from r qualify row_number() over (partition by message_id order by n desc) = 1)"
    ORACLES["lease_state"] = _recursive("lease_log", _LEASES, f"select message_id, status, worker_id, expires_at, created_at, updated_at from {last} where status is not null")
    stale = f"status = 'processing' and updated_at < timestamp '{EVENTS_NOW}' - interval 1 day"
    ORACLES["lease_reset_stale"] = _recursive("lease_log", _LEASES, f"select message_id, case when {stale} then 'released' else status end as status, case when {stale} then timestamp '{EVENTS_NOW}' else expires_at end as expires_at from {last} where status is not null")
    marks = """l as (select *, row_number() over (partition by message_id order by moment, seq) as n from dedup_log), r(message_id, n, seq, op, duplicate, ends) as (
      select message_id, 0::bigint, null::bigint, null::varchar, false, null::timestamp from (select distinct message_id from l) union all
      select l.message_id, l.n, l.seq, l.op, l.op = 'check' and r.ends is not null and r.ends >= l.moment, case when l.op = 'check' and r.ends is not null and r.ends >= l.moment then r.ends else l.moment + interval 1 day end from r join l on l.message_id = r.message_id and l.n = r.n + 1)"""
    ORACLES["dedup_with_marks"] = _recursive("dedup_log", marks, "select message_id, seq, duplicate from r where op = 'check'")


_sql()
