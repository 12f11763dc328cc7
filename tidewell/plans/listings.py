"""Queries over listings, summaries and metrics, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import documents as D
from tidewell.operators import changes, folds, monitor, state
from tidewell.plans.registry import query
from tidewell.sources.adapters import EVENTS_NOW, ORDERS_NOW

KEYS = ["started_at", "event_id", "subscription_id"]
MARK = """base64(encode('{"s":"' || strftime(started_at, '%Y-%m-%dT%H:%M:%S') || case when microsecond(started_at) % 1000000 = 0 then '' else rtrim(strftime(started_at, '.%f'), '0') end || 'Z","e":"' || event_id || '","u":"' || subscription_id || '"}'))"""


def entry_mark() -> dict:
    return {"s": D.rfc3339(F.col("started_at")), "e": F.col("event_id"), "u": F.col("subscription_id")}


@query("monitor_entries", f"""select event_id, subscription_id, started_at, n > 50 as has_more, case when n > 50 then (select {MARK} from (select * from p order by started_at, event_id, subscription_id limit 50) order by started_at desc, event_id desc, subscription_id desc limit 1) end as next_cursor
from (select *, (select count(*) from p) as n from p order by started_at, event_id, subscription_id limit 50)""", with_="p as (select * from monitor_entries where status = 'failed')")
def monitor_list_page(m: DataFrame) -> DataFrame:
    """A page with the mark of the next one."""
    failed = monitor.Filter(statuses=("failed",)).apply(m)
    return monitor.listing(failed, KEYS, 50, entry_mark()).select("event_id", "subscription_id", "started_at", "has_more", "next_cursor")


@query("monitor_entries", "select event_id, subscription_id from monitor_entries where status = 'failed' order by started_at, event_id, subscription_id limit 50 offset 50")
def monitor_list_next(m: DataFrame) -> DataFrame:
    """The page after the first, by the mark that the first one gave."""
    failed = monitor.Filter(statuses=("failed",)).apply(m)
    mark = monitor.listing(failed, KEYS, 50, entry_mark()).select("next_cursor").first()
    found = D.read_cursor(mark["next_cursor"] if mark and mark["next_cursor"] else "")
    cursor = [F.lit(found["s"].rstrip("Z")).cast("timestamp_ntz"), F.lit(found["e"]), F.lit(found["u"])] if found else None
    return monitor.listing(failed, KEYS, 50, entry_mark(), cursor).select("event_id", "subscription_id")


@query("acks", "select event_id, created_at from acks where acked_at is not null and created_at < timestamp '2024-01-20 00:00:00' order by created_at desc, event_id desc limit 100 offset 250")
def ack_list_offset(a: DataFrame) -> DataFrame:
    """The third page of acknowledged events, by offset."""
    acked = monitor.Filter(end="2024-01-20 00:00:00", time_column="created_at").apply(a.where("acked_at is not null"))
    return monitor.offset_page(acked, ["created_at", "event_id"], 250).select("event_id", "created_at")


@query("claims", "select message_id, worker_id, updated_at, has_more from (select *, (select count(*) from w) > 40 as has_more from w order by updated_at, message_id limit 40)",
       with_=f"w as (select * from claims where status = 'processing' and updated_at < timestamp '{ORDERS_NOW}' - interval 1200 day and event_name = 'ev-1' and created_at >= timestamp '1992-01-01' and created_at < timestamp '1999-01-01')")
def workers_list_stale(c: DataFrame) -> DataFrame:
    """Leases by a stale timeout, which takes the place of the statuses asked for."""
    found = monitor.worker_filter(c, ORDERS_NOW, stale="1200 days", statuses=["completed"], equal={"event_name": "ev-1"}, after="1992-01-01 00:00:00", before="1999-01-01 00:00:00")
    return monitor.listing(found, ["updated_at", "message_id"], 40, {"u": D.rfc3339(F.col("updated_at")), "i": F.col("message_id")}).select("message_id", "worker_id", "updated_at", "has_more")


_COUNTS = """count(*) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, coalesce(cast(trunc(avg(duration_ms)) as bigint), 0) as avg_ms, coalesce(round(count(*) filter (status = 'failed') / count(*), 6), 0.0) as error_rate"""


@query("monitor_entries", f"""select grouping(status, event_name, instance_id) as facet, status, event_name, instance_id, {_COUNTS} from monitor_entries where started_at >= timestamp '2024-01-15 00:00:00' - interval 24 hour
group by grouping sets ((status), (event_name), (instance_id), ()) having not (grouping(status, event_name, instance_id) = 6 and instance_id is not distinct from '')""")
def monitor_summary_last_day(m: DataFrame) -> DataFrame:
    """All summaries in one pass; without bounds the last 24 hours count."""
    return monitor.full_summary(m, "2024-01-15 00:00:00")


@query("monitor_entries", "select event_name, cast(least(12, len(list_filter([0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0], lambda b: duration_ms / 1000.0 > b))) as integer) as bucket, count(*) as n, sum(duration_ms) as total_ms from monitor_entries where duration_ms is not null group by all")
def handler_duration_histogram(m: DataFrame) -> DataFrame:
    timed = m.where("duration_ms is not null").withColumn("s", F.col("duration_ms") / 1000.0)
    return monitor.histogram(timed, F.col("s"), monitor.DURATION_BOUNDS, ["event_name"], [F.sum("duration_ms").alias("total_ms")])


@query("lease_log", "select op, worker, count(*) as n, sum(case op when 'acquire' then 1 when 'release' then -1 else 0 end) as active from lease_log group by op, worker")
def recorder_counters(log: DataFrame) -> DataFrame:
    """Counters and the up-and-down gauge of streams, by reason."""
    step = F.when(F.col("op") == "acquire", 1).when(F.col("op") == "release", -1).otherwise(0)
    return log.groupBy("op", "worker").agg(F.count(F.lit(1)).alias("n"), F.sum(step).alias("active"))


@query("monitor_entries", "select event_id, case when delivery_mode = 'worker_pool' then '' else subscription_id end as subscription_id, case when duration_ms > 0 then duration_ms // 10 end as duration_ms, coalesce(error, '') as error from monitor_entries")
def entry_records(m: DataFrame) -> DataFrame:
    """Entries as records: tenths of a millisecond are cut, no duration is null, a worker pool has no subscription."""
    return monitor.to_record(m.withColumn("micros", F.col("duration_ms") * 100), "micros").select("event_id", "subscription_id", "duration_ms", "error")


@query("outbox", "select id, status from outbox where id = (select min(id) from outbox)")
def point_read(o: DataFrame) -> DataFrame:
    return monitor.one(o, "id", o.agg(F.min("id")).first()[0]).select("id", "status")


@query("change_events", "select id, document_key, value from change_events where operation_type <> 'update' or value is not null")
def full_document_required(c: DataFrame) -> DataFrame:
    """Updates must have their image."""
    return changes.full_document(c.select("id", "operation_type", "document_key", "value"), "required", "value").select("id", "document_key", "value")


@query("change_events", "select id, case when operation_type <> 'update' then value end as value from change_events")
def full_document_default(c: DataFrame) -> DataFrame:
    """Updates come without image."""
    return changes.full_document(c.select("id", "operation_type", "value"), "default", "value").select("id", "value")


@query("claims", f"select message_id, expires_at from claims where expires_at > timestamp '{ORDERS_NOW}' - interval 400 day")
def claims_unexpired(c: DataFrame) -> DataFrame:
    return folds.unexpired(c, "expires_at", "1997-11-27 00:00:00").select("message_id", "expires_at")


@query("checkpoint_log", f"select event_name || ':' || consumer_id as id, updated_at from checkpoint_log where updated_at + interval 10 day > timestamp '{EVENTS_NOW}' and event_name = 'click'")
def checkpoints_unexpired(c: DataFrame) -> DataFrame:
    kept = folds.unexpired(c.where("event_name = 'click'"), "updated_at", EVENTS_NOW, "10 days")
    return kept.select(F.concat_ws(":", "event_name", "consumer_id").alias("id"), "updated_at")


@query("change_events", "select id, 'app.' || coll || ':node-1' as resume_key from change_events")
def resume_keys(c: DataFrame) -> DataFrame:
    return c.select("id", changes.resume_key(F.col("db"), F.col("coll"), "node-1").alias("resume_key"))
