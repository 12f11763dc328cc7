"""Queries over the record tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import documents as D
from tidewell.operators import changes, folds, monitor, state
from tidewell.operators.monitor import Filter
from tidewell.sources.adapters import EVENTS_NOW, ORDERS_NOW, duck, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(tables: str, sql: str | None, name: str | None = None, with_: str = "") -> Callable:
    """Register a function of the record tables named, and SQL over the same names (and those of the subqueries in with_)."""
    used = tables.split()

    def put(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(*(read(spark, sf_dir, t) for t in used))
        if sql:
            ORACLES[key] = f"with {', '.join([*map(duck, used), *filter(None, [with_])])} {sql}"
        return f

    return put


EMPTY = "operation_type = 'update' and no_fields_changed"
META = "strftime(cluster_time, '%Y-%m-%dT%H:%M:%SZ')"


@query("change_events", f"select document_key, id, operation_type, value from (select *, row_number() over (partition by document_key order by ts desc, seq desc) as n from change_events where not ({EMPTY})) where n = 1")
def coalesce_latest(c: DataFrame) -> DataFrame:
    effective = changes.drop_empty_updates(c, F.col("no_fields_changed"))
    return changes.latest_per_key(effective, ["document_key"], F.col("ts"), F.col("seq")).select("document_key", "id", "operation_type", "value")


@query("change_events", "select document_key, count(*) - 1 as superseded from change_events group by document_key")
def coalesce_superseded_count(c: DataFrame) -> DataFrame:
    return changes.superseded(c, ["document_key"])


@query("change_events", f"select id, operation_type, document_key from change_events where not ({EMPTY})")
def drop_empty_updates(c: DataFrame) -> DataFrame:
    return changes.drop_empty_updates(c, F.col("no_fields_changed")).select("id", "operation_type", "document_key")


for _kind, _ops in changes.EVENT_TYPES.items():
    _list = ", ".join(f"'{o}'" for o in _ops)
    query("change_events", f"select id, operation_type from change_events where operation_type in ({_list})", f"filter_{_kind}")(lambda c, kind=_kind: changes.of_event_type(c, kind).select("id", "operation_type"))


@query("change_events", "select id, coll from change_events where db = 'app' and coll in ('admins')")
def collection_filter(c: DataFrame) -> DataFrame:
    return changes.of_collections(c, "app", ["admins"]).select("id", "coll")


@query("change_events", f"select id, ts from change_events where ts >= timestamp '{EVENTS_NOW}' - interval 7 day")
def start_from_past(c: DataFrame) -> DataFrame:
    return changes.since(c, EVENTS_NOW, "7 days").select("id", "ts")


@query("change_events", f"select id, operation_type, db, coll, db || '.' || coll as namespace, document_key, {META} as clock from change_events")
def normalize_changes(c: DataFrame) -> DataFrame:
    return c.select("id", "operation_type", "db", "coll", changes.namespace().alias("namespace"), "document_key", D.rfc3339(F.col("cluster_time")).alias("clock"))


@query("change_events", """select id, case when operation_type = 'delete' then 'text/plain' else 'application/json' end as content_type,
case when operation_type = 'delete' then document_key else '{"k":' || k || '}' end as payload from change_events where operation_type = 'delete' or k is not null""")
def payload_shape(c: DataFrame) -> DataFrame:
    return changes.payload(c, F.when(F.col("k").isNotNull(), F.to_json(F.struct("k"))))


@query("change_events", f"""select id, case when operation_type = 'delete' then 'text/plain' else 'application/json' end as content_type, operation_type as operation,
db as database, coll as collection, db || '.' || coll as namespace, document_key, {META} as cluster_time from change_events""")
def metadata_map(c: DataFrame) -> DataFrame:
    kind = F.when(F.col("operation_type") == "delete", "text/plain").otherwise("application/json")
    return c.select("id", kind.alias("content_type"), F.col("operation_type").alias("operation"), F.col("db").alias("database"), F.col("coll").alias("collection"), changes.namespace().alias("namespace"), "document_key", D.rfc3339(F.col("cluster_time")).alias("cluster_time"))


@query("change_events", """select id, case when strlen('{"k":' || k || '}') <= 7 then '{"k":' || k || '}' end as updated_fields from change_events where operation_type = 'update'""")
def update_fields_size_cap(c: DataFrame) -> DataFrame:
    return c.where("operation_type = 'update'").select("id", changes.capped_fields(F.to_json(F.struct("k")), 7).alias("updated_fields"))


@query("change_events", "select id, cast(trunc(value) as bigint) as as_long, cast(k as double) as as_double from change_events")
def field_extract_coerce(c: DataFrame) -> DataFrame:
    fields = F.to_json(F.struct("value", "k"))
    return c.select("id", D.field(fields, "value", "long").alias("as_long"), D.field(fields, "k", "double").alias("as_double"))


@query("change_events", "select id, k is not null as has_k, false as has_other from change_events")
def field_presence(c: DataFrame) -> DataFrame:
    keys = F.json_object_keys(F.to_json(F.struct("k")))
    return c.select("id", F.array_contains(keys, "k").alias("has_k"), F.array_contains(keys, "other").alias("has_other"))


@query("deliveries", "select message_id, seq from (select *, row_number() over (partition by message_id order by arrived_at, seq) as n from deliveries) where n = 1")
def dedup_key_first(d: DataFrame) -> DataFrame:
    return changes.first_delivery(d, "message_id", "arrived_at", "seq").select("message_id", "seq")


@query("change_events", "select id, r.registered from change_events, (values ('audit'), ('search'), ('cache')) as r(registered)")
def fanout_all(c: DataFrame) -> DataFrame:
    return changes.fan_out(c, ["audit", "search", "cache"]).select("id", "registered")


@query("change_events", """select id, e.document_key, l.id as current_id, l.value as current_value from change_events e left join
(select document_key, id, value from (select *, row_number() over (partition by document_key order by ts desc, seq desc) as n from change_events where operation_type <> 'delete') where n = 1) l using (document_key)
where operation_type = 'update'""".replace("select id, e.document_key", "select e.id, document_key"))
def update_lookup(c: DataFrame) -> DataFrame:
    images = changes.latest_per_key(c.where("operation_type <> 'delete'"), ["document_key"], F.col("ts"), F.col("seq"))
    current = images.select("document_key", F.col("id").alias("current_id"), F.col("value").alias("current_value"))
    return changes.with_current(c.where("operation_type = 'update'").select("id", "document_key"), current, "document_key")


@query("acks", "select event_id, created_at from acks where acked_at is null and created_at >= timestamp '2024-01-05 00:00:00' order by created_at desc, event_id desc limit 100")
def ack_list(a: DataFrame) -> DataFrame:
    pending = Filter(start="2024-01-05 00:00:00", time_column="created_at").apply(a.where("acked_at is null"))
    return monitor.page(pending, ["created_at", "event_id"], descending=True).select("event_id", "created_at")


@query("acks", "select count(*) as pending from acks where acked_at is null")
def ack_count_pending(a: DataFrame) -> DataFrame:
    return a.where("acked_at is null").agg(F.count(F.lit(1)).alias("pending"))


ENTRY = ["event_id", "subscription_id", "status"]


@query("monitor_entries", "select event_id, subscription_id, status from monitor_entries where delivery_mode = 'broadcast' and status in ('failed', 'retrying') and error is distinct from '' and retry_count >= 1 and started_at < timestamp '2024-01-31 00:00:00'")
def monitor_filter(m: DataFrame) -> DataFrame:
    return Filter({"delivery_mode": "broadcast"}, ("failed", "retrying"), has_error=True, end=EVENTS_NOW, min_retries=1).apply(m).select(ENTRY)


@query("monitor_entries", "select event_id, subscription_id, status from monitor_entries where coalesce(error, '') = '' and duration_ms >= 500")
def monitor_filter_no_error(m: DataFrame) -> DataFrame:
    return Filter(has_error=False, min_duration_ms=500).apply(m).select(ENTRY)


KEYSET = ["started_at", "event_id", "subscription_id"]
CURSOR = "(timestamp '2024-01-10 00:00:00', '', '')"
for _name, _down in (("monitor_page_asc", False), ("monitor_page_desc", True)):
    _order = ", ".join(f"{k} {'desc' if _down else 'asc'}" for k in KEYSET)
    query("monitor_entries", f"select event_id, subscription_id, status from monitor_entries where (started_at, event_id, subscription_id) {'<' if _down else '>'} {CURSOR} order by {_order} limit 50", _name)(
        lambda m, down=_down: monitor.page(m, KEYSET, 50, [F.expr("timestamp_ntz '2024-01-10 00:00:00'"), F.lit(""), F.lit("")], down).select(ENTRY)
    )


@query("monitor_entries", "select event_id, subscription_id, status, started_at from monitor_entries where event_id = '77'")
def monitor_by_event(m: DataFrame) -> DataFrame:
    return Filter({"event_id": "77"}).apply(m).orderBy("started_at", "subscription_id").select(*ENTRY, "started_at")


_COUNTS = """count(*) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'retrying') as retrying,
count(*) filter (status = 'pending') as pending, coalesce(cast(trunc(avg(duration_ms)) as bigint), 0) as avg_ms, coalesce(round(count(*) filter (status = 'failed') / count(*), 6), 0.0) as error_rate"""
for _name, _by, _where in (("status", "status", "true"), ("event", "event_name", "true"), ("instance", "instance_id", "instance_id is distinct from ''"), ("global", "", "true")):
    query("monitor_entries", f"select {_by + ', ' if _by else ''}{_COUNTS} from monitor_entries where {_where} {'group by ' + _by if _by else ''}", f"monitor_summary_{_name}")(
        lambda m, by=_by: monitor.summary(m.where(~F.col("instance_id").eqNullSafe("")) if by == "instance_id" else m, *([by] if by else []))
    )


@query("monitor_entries", """select * from (select grouping(status, event_name, instance_id) as facet, status, event_name, instance_id, count(*) as total, count(*) filter (status = 'failed') as failed
from monitor_entries group by grouping sets ((status), (event_name), (instance_id), ())) where not (facet = 6 and instance_id is not distinct from '')""")
def monitor_summary_facets(m: DataFrame) -> DataFrame:
    return monitor.facets(m)


@query("monitor_entries", "select min(started_at) as oldest, max(started_at) as newest from monitor_entries")
def monitor_range(m: DataFrame) -> DataFrame:
    return m.agg(F.min("started_at").alias("oldest"), F.max("started_at").alias("newest"))


_STUCK = f"status = 'pending' and started_at < timestamp '{EVENTS_NOW}' - interval 20 day"


@query("monitor_entries", f"select count(*) as stuck from monitor_entries where {_STUCK}")
def monitor_stuck_count(m: DataFrame) -> DataFrame:
    return state.stuck(m, "pending", "started_at", EVENTS_NOW, "20 days").agg(F.count(F.lit(1)).alias("stuck"))


@query("monitor_entries", f"select event_id, started_at from monitor_entries where {_STUCK} order by started_at, event_id limit 10")
def monitor_stuck_entries(m: DataFrame) -> DataFrame:
    return state.stuck(m, "pending", "started_at", EVENTS_NOW, "20 days").orderBy("started_at", "event_id").limit(10).select("event_id", "started_at")


_KEYED = "select *, event_name || '/' || bus_id as k, cast(event_id as bigint) as seq from monitor_entries where delivery_mode ="


@query("monitor_entries", f"select k, status, error from (select *, row_number() over (partition by k, subscription_id order by seq desc) as n from ({_KEYED} 'broadcast')) where n = 1")
def monitor_record_broadcast(m: DataFrame) -> DataFrame:
    """Last write of an event and subscription wins."""
    keyed = m.where("delivery_mode = 'broadcast'").select(F.concat_ws("/", "event_name", "bus_id").alias("k"), "subscription_id", "status", "error", F.col("event_id").cast("long").alias("seq"))
    return changes.latest_per_key(keyed, ["k", "subscription_id"], F.col("seq")).select("k", "status", "error")


@query("monitor_entries", f"select k, '' as subscription_id, status from (select *, row_number() over (partition by k order by seq) as n from ({_KEYED} 'worker_pool')) where n = 1")
def monitor_record_workerpool(m: DataFrame) -> DataFrame:
    """First write of an event wins; the subscription is blanked."""
    keyed = m.where("delivery_mode = 'worker_pool'").select(F.concat_ws("/", "event_name", "bus_id").alias("k"), F.lit("").alias("subscription_id"), "status", F.col("event_id").cast("long").alias("seq"))
    return changes.latest_per_key(keyed, ["k", "subscription_id"], -F.col("seq")).select("k", "subscription_id", "status")


@query("outbox", "select id, status, priority, created_at from outbox where status in ('pending', 'failed') order by priority desc, created_at, id limit 200")
def outbox_claim(o: DataFrame) -> DataFrame:
    return state.claim_batch(o, 200).select("id", "status", "priority", "created_at")


_OLD = f"status = 'processing' and claimed_at < timestamp '{ORDERS_NOW}' - interval 1000 day"


@query("outbox", f"select id, case when {_OLD} then 'pending' else status end as status, case when not coalesce({_OLD}, false) then claimed_at end as claimed_at from outbox")
def outbox_recover_stuck(o: DataFrame) -> DataFrame:
    return state.recover(o, ORDERS_NOW, "1000 days").select("id", "status", "claimed_at")


@query("outbox", "select id, case when status = 'failed' and retry_count < 2 then 'pending' else status end as status from outbox")
def outbox_retry_failed(o: DataFrame) -> DataFrame:
    return state.retry(o, 2).select("id", "status")


@query("outbox", f"select id from outbox where not coalesce(status = 'published' and published_at < timestamp '{ORDERS_NOW}' - interval 1500 day, false)")
def outbox_cleanup(o: DataFrame) -> DataFrame:
    return folds.delete(o, state.older("published", "published_at", ORDERS_NOW, "1500 days")).select("id")


@query("outbox", "select status, count(*) as n from outbox group by status")
def outbox_count(o: DataFrame) -> DataFrame:
    return o.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("queue", f"""select event_name, seq, rank from (select *, cast(row_number() over (partition by event_name order by enqueued_at, seq) as integer) as rank from queue
where status = 'pending' or status = 'inflight' and inflight_at < timestamp '{ORDERS_NOW}' - interval 5 minute) where rank <= 20""")
def queue_fetch_next(q: DataFrame) -> DataFrame:
    return state.fetch(q, 20, ORDERS_NOW).select("event_name", "seq", "rank")


@query("queue", "select count(*) filter (status = 'pending') as pending, count(*) filter (status = 'inflight') as inflight, count(*) filter (status = 'acked') as acked, count(*) as total from queue")
def queue_stats(q: DataFrame) -> DataFrame:
    return q.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("pending", "inflight", "acked")), F.count(F.lit(1)).alias("total"))


@query("queue", f"select seq from queue where not coalesce(status = 'acked' and acked_at < timestamp '{ORDERS_NOW}' - interval 1500 day, false)")
def queue_purge(q: DataFrame) -> DataFrame:
    return folds.delete(q, state.older("acked", "acked_at", ORDERS_NOW, "1500 days")).select("seq")


@query("queue", "select seq, 'pending' as status, retry_count + 1 as retry_count, cast(null as timestamp) as inflight_at from queue where status = 'inflight'")
def queue_nack(q: DataFrame) -> DataFrame:
    return state.nack(q).select("seq", "status", "retry_count", "inflight_at")


@query("claims", f"select message_id, status from claims where status is null or expires_at < timestamp '{ORDERS_NOW}' - interval 1000 day")
def claims_acquirable(c: DataFrame) -> DataFrame:
    return state.acquirable(c, "1996-04-06 00:00:00").select("message_id", "status")


_STALE = f"status = 'processing' and updated_at < timestamp '{ORDERS_NOW}' - interval 1200 day"


@query("claims", f"select message_id, updated_at from claims where {_STALE} order by updated_at, message_id limit 100")
def claims_stale(c: DataFrame) -> DataFrame:
    return monitor.page(state.stuck(c, "processing", "updated_at", ORDERS_NOW, "1200 days"), ["updated_at", "message_id"]).select("message_id", "updated_at")


@query("claims", f"select message_id, event_name from claims where {_STALE} and has_payload")
def claims_stale_payloads(c: DataFrame) -> DataFrame:
    return state.stuck(c, "processing", "updated_at", ORDERS_NOW, "1200 days").where("has_payload").select("message_id", "event_name")


@query("claims", "select message_id, worker_id, updated_at from claims where worker_id = 'w-3' and (updated_at, message_id) > (timestamp '1995-01-01 00:00:00', '') order by updated_at, message_id limit 100")
def workers_page(c: DataFrame) -> DataFrame:
    found = Filter({"worker_id": "w-3"}).apply(c)
    return monitor.page(found, ["updated_at", "message_id"], cursor=[F.expr("timestamp_ntz '1995-01-01 00:00:00'"), F.lit("")]).select("message_id", "worker_id", "updated_at")


@query("deliveries", None)
def dedup_ttl(d: DataFrame) -> DataFrame:
    return state.ttl_dedup(d, 86_400)


ORACLES["dedup_ttl"] = f"""with recursive {duck("deliveries")}, acc(message_id, t) as (select message_id, min(arrived_at) from deliveries group by message_id union all
select a.message_id, (select min(d.arrived_at) from deliveries d where d.message_id = a.message_id and d.arrived_at > a.t + interval 1 day) from acc a where a.t is not null)
select d.message_id, d.seq, d.arrived_at from deliveries d join acc on d.message_id = acc.message_id and d.arrived_at = acc.t"""


@query("checkpoint_log", "select event_name, consumer_id, checkpoint from (select *, row_number() over (partition by event_name, consumer_id order by seq desc) as n from checkpoint_log) where n = 1")
def checkpoint_latest(c: DataFrame) -> DataFrame:
    return changes.latest_per_key(c, ["event_name", "consumer_id"], F.col("seq")).select("event_name", "consumer_id", "checkpoint")


@query("checkpoint_log", "select event_name || ':' || consumer_id as id, max(updated_at) as updated_at from checkpoint_log group by 1")
def queue_checkpoints(c: DataFrame) -> DataFrame:
    return c.groupBy(F.concat_ws(":", "event_name", "consumer_id").alias("id")).agg(F.max("updated_at").alias("updated_at"))


_RUNNING = "select *, max(version) over (partition by name order by seq rows between unbounded preceding and 1 preceding) as m from schema_log"


@query("schema_log", f"select name, version, written_at from (select *, row_number() over (partition by name order by seq desc) as n from ({_RUNNING}) where m is null or version >= m) where n = 1")
def schema_current(s: DataFrame) -> DataFrame:
    accepted = folds.schema_versions(s).where("accepted")
    return changes.latest_per_key(accepted, ["name"], F.col("seq")).select("name", "version", "written_at")


@query("schema_log", f"select name, count(*) as rejected from ({_RUNNING}) where version < m group by name")
def schema_rejected_downgrades(s: DataFrame) -> DataFrame:
    return folds.schema_versions(s).where("not accepted").groupBy("name").agg(F.count(F.lit(1)).alias("rejected"))


@query("outbox", "select id, created_at from outbox where (created_at, id) > (timestamp '1994-06-01 00:00:00', 0) order by created_at, id limit 100")
def store_page(o: DataFrame) -> DataFrame:
    return monitor.page(o, ["created_at", "id"], cursor=[F.expr("timestamp_ntz '1994-06-01 00:00:00'"), F.lit(0)]).select("id", "created_at")


@query("outbox", f"select count(*) as older from outbox where created_at < timestamp '{ORDERS_NOW}' - interval 1000 day")
def store_older_than(o: DataFrame) -> DataFrame:
    return Filter(end="1996-04-06 00:00:00", time_column="created_at").apply(o).agg(F.count(F.lit(1)).alias("older"))


_BUCKET = "len(list_filter([" + ", ".join(f"{float(b)}" for b in monitor.LAG_BOUNDS) + "], lambda b: v > b))"


@query("change_events", f"select operation_type, {_BUCKET} as bucket, count(*) as n from (select operation_type, greatest(date_diff('microsecond', cluster_time, ts) / 1000000.0, 0.0)::double as v from change_events) group by all")
def lag_histogram(c: DataFrame) -> DataFrame:
    lag = F.expr("timestampdiff(microsecond, cluster_time, ts)") / F.lit(1_000_000.0)
    return monitor.histogram(c, lag, by=["operation_type"])


@query("monitor_entries", "select event_name, case when status = 'completed' then 'processed' else 'failed' end as outcome, count(*) as n from monitor_entries where status <> 'pending' group by all")
def processed_failed_counts(m: DataFrame) -> DataFrame:
    outcome = F.when(F.col("status") == "completed", "processed").otherwise("failed")
    return m.where("status <> 'pending'").groupBy("event_name", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("monitor_entries acks", "select m.event_id, m.status, a.acked_at is not null as acked from monitor_entries m left join acks a using (event_id) where m.status in ('failed', 'retrying')")
def diagnose_event(m: DataFrame, a: DataFrame) -> DataFrame:
    found = Filter(statuses=("failed", "retrying")).apply(m).select("event_id", "status")
    return found.join(a.select("event_id", F.col("acked_at").isNotNull().alias("is_acked")), "event_id", "left").select("event_id", "status", F.coalesce("is_acked", F.lit(False)).alias("acked"))


@query("outbox", "select id, created_at from outbox order by created_at desc, id desc limit 500")
def capped_retain(o: DataFrame) -> DataFrame:
    return state.capped(o, 500, "created_at", "id").select("id", "created_at")


@query("change_events", "select date_trunc('day', ts) as day, operation_type, count(*) as n, count(distinct document_key) as documents from change_events group by all")
def change_rate_daily(c: DataFrame) -> DataFrame:
    """An extra: tumbling windows of change counts."""
    return c.groupBy(F.date_trunc("day", "ts").alias("day"), "operation_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("document_key").alias("documents"))
