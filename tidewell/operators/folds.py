"""Current state out of logs of transitions, and the transitions themselves.

Every mutable store is an append-only log (key, seq, op, moment, arguments); seq orders it. Where the last or first entry of a
kind decides, the fold is an aggregate, combined before the shuffle, so a hot key is no burden. Where each step depends on
the one before (leases, marks of a dedup), walk() takes the sorted entries of a key one by one, with one state in hand:
memory does not grow with a key, and a hot key takes time in one task, not space.

A transition that needs a condition (claim, retry, recover, reset) reads the current state and gives log rows for the keys
that meet it; whoever writes them is the only writer of that log, so none is claimed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import chains

#: Entries of a log that a task gets, on average, where they are dealt by key.
ENTRIES = 250_000


def op(name: str) -> Column:
    return F.col("op") == name


def last(value: str | Column, when: Column) -> Column:
    """The value at the largest seq where when holds."""
    return F.max_by(value, F.when(when, F.col("seq")))


def _told(log: DataFrame, key: str, first: str) -> DataFrame:
    """log with _began: whether its key is there and has an entry with the op first. Dealt by key once, to tasks of ENTRIES or so.

    The number of tasks follows the entries, not their bytes: keys in order compress so well that few tasks would sort them all.
    """
    dealt = log.repartition(max(1, -(-log.count() // ENTRIES)), key)
    began = F.max(F.coalesce(op(first), F.lit(False))).over(Window.partitionBy(key))
    return dealt.withColumn("_began", F.col(key).isNotNull() & began)


def known(log: DataFrame, key: str, first: str) -> DataFrame:
    """The entries of log whose key began with the op first; what names another key found nothing to change."""
    return _told(log, key, first).where("_began").drop("_began")


def unknown(log: DataFrame, key: str, first: str) -> DataFrame:
    """The entries that name a key that never began: an error for whoever wrote them."""
    return _told(log, key, first).where("not _began").drop("_began")


def insert_new(rows: DataFrame, there: DataFrame, key: str, order: str) -> DataFrame:
    """The rows to append: one for each key that is not there yet, the first by order."""
    rest = [c for c in rows.columns if c != key]
    firsts = rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(key, "_row.*")
    return firsts.join(there.select(key), key, "left_anti").select(*rows.columns)


def replace(rows: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """there with the rows that replace others of their key; a key that is not there is replaced by nothing (see missing())."""
    new = rows.join(there.select(key), key, "left_semi")
    return there.join(new.select(key), key, "left_anti").unionByName(new)


def upsert(rows: DataFrame, there: DataFrame, key: str) -> DataFrame:
    return there.join(rows.select(key), key, "left_anti").unionByName(rows)


def missing(rows: DataFrame, there: DataFrame, key: str) -> DataFrame:
    return rows.join(there.select(key), key, "left_anti")


def delete(df: DataFrame, predicate: Column) -> DataFrame:
    """What stays: a narrow filter, no join. Rows for which the predicate is null stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def ack_state(log: DataFrame) -> DataFrame:
    """event_id, created_at, acked_at of acknowledgement entries (ops store, ack).

    A second store changes nothing; the first ack after the store counts; an ack of what is not stored is lost.
    """
    began = log.where(op("store")).groupBy("event_id").agg(F.min("seq").alias("began"), F.min_by("moment", "seq").alias("created_at"))
    acks = log.where(op("ack")).join(began.select("event_id", "began"), "event_id").where("seq > began")
    done = acks.groupBy("event_id").agg(F.min_by("moment", "seq").alias("acked_at"))
    return began.join(done, "event_id", "left").select("event_id", "created_at", "acked_at")


def outbox_state(log: DataFrame) -> DataFrame:
    """id and the state of each stored message (ops store, claim, ack, fail, retry, recover): the last op gives the status.

    Neither ack nor fail looks at the status or the owner; a failure counts as a retry.
    """
    status = F.create_map(*(F.lit(x) for pair in (("store", "pending"), ("claim", "processing"), ("ack", "published"), ("fail", "failed"), ("retry", "pending"), ("recover", "pending")) for x in pair))
    freed, unowned = last(op("claim"), op("claim") | op("recover")), last(op("claim"), op("claim") | op("recover") | op("retry"))
    out = log.groupBy("id").agg(
        F.element_at(status, F.max_by("op", "seq")).alias("status"), F.when(freed, last("moment", op("claim"))).alias("claimed_at"), F.when(unowned, last("worker", op("claim"))).alias("claimed_by"),
        last("moment", op("ack")).alias("published_at"), last("error", op("fail")).alias("last_error"), F.count_if(op("fail")).cast("int").alias("retry_count"),
        F.count_if(op("store")).alias("_stored"), F.min(F.when(op("store"), F.col("moment"))).alias("created_at"),
    )
    return out.where("_stored > 0").drop("_stored")


def queue_state(log: DataFrame) -> DataFrame:
    """seq_id and the state of each appended message (ops append, fetch, ack, nack). Late redelivery is no retry, a nack is one."""
    status = F.create_map(*(F.lit(x) for pair in (("append", "pending"), ("fetch", "inflight"), ("ack", "acked"), ("nack", "pending")) for x in pair))
    out = log.groupBy("seq_id").agg(
        F.element_at(status, F.max_by("op", "seq")).alias("status"), F.when(last(op("fetch"), op("fetch") | op("nack")), last("moment", op("fetch"))).alias("inflight_at"),
        last("moment", op("ack")).alias("acked_at"), F.count_if(op("nack")).cast("int").alias("retry_count"), F.count_if(op("append")).alias("_appended"),
    )
    return out.where("_appended > 0").drop("_appended")


def lifecycle_state(log: DataFrame) -> DataFrame:
    """event_id, subscription_id and the state of deliveries (ops start, complete, publish).

    Of a worker pool the first start counts and is kept without subscription, else the last, which clears what a
    completion had set. A completion changes only a delivery that has started, under just the subscription it names: so
    that of a worker pool must name none.
    """
    pool = F.col("delivery_mode") == "worker_pool"
    kept = log.withColumn("subscription_id", F.when(op("start") & pool, "").when(op("publish"), "__publish__").otherwise(F.col("subscription_id")))
    begins = op("start") | op("publish")
    rank = F.when(op("complete"), F.col("seq")).when(begins & F.coalesce(pool, F.lit(False)), -F.col("seq")).otherwise(F.col("seq"))
    out = kept.groupBy("event_id", "subscription_id").agg(
        F.max_by(F.struct("seq", "moment", "event_name", "op"), F.when(begins, rank)).alias("b"), F.max(F.when(op("complete"), F.struct("seq", "moment", "status", "duration_ms", "error"))).alias("c"),
    )
    ended = F.col("c").isNotNull() & (F.col("c.seq") > F.col("b.seq"))
    return out.where("b is not null").select(
        "event_id", "subscription_id", F.col("b.event_name").alias("event_name"), F.col("b.moment").alias("started_at"),
        F.when(ended, F.col("c.status")).when(F.col("b.op") == "publish", "published").otherwise("pending").alias("status"),
        F.when(ended, F.col("c.duration_ms")).alias("duration_ms"), F.when(ended, F.col("c.moment")).when(F.col("b.op") == "publish", F.col("b.moment")).alias("completed_at"), F.when(ended, F.col("c.error")).alias("error"),
    )


def claim(state: DataFrame, n: int, worker: str, at: str, seq: int) -> DataFrame:
    """Log rows by which worker takes the next n messages of an outbox: pending or failed, by priority, then age, then id."""
    taken = state.where(F.col("status").isin("pending", "failed")).orderBy(F.desc("priority"), "created_at", "id").limit(n)
    return taken.select("id", F.lit(seq).cast("long").alias("seq"), F.lit("claim").alias("op"), F.expr(f"timestamp_ntz '{at}'").alias("moment"), F.lit(worker).alias("worker"), F.lit(None).cast("string").alias("error"))


def by_event(state: DataFrame, events: DataFrame, name: str, at: str, seq: int, error: str | None = None) -> DataFrame:
    """Log rows of op name (ack, fail) for the messages of the events given (event_id)."""
    found = state.join(events.select("event_id"), "event_id", "left_semi")
    return found.select("id", F.lit(seq).cast("long").alias("seq"), F.lit(name).alias("op"), F.expr(f"timestamp_ntz '{at}'").alias("moment"), F.lit(None).cast("string").alias("worker"), F.lit(error).cast("string").alias("error"))


def walk(log: DataFrame, key: str, order: list[str], schema: str, step: Callable[[dict | None, dict], tuple[dict | None, list[dict]]], end: Callable[[object, dict | None], list[dict]] | None = None) -> DataFrame:
    """Rows of schema that step gives along each key's entries in order; step takes and returns the key's state.

    end gives rows for the last state of a key. One state is held at a time, and batches are as long as Arrow's.
    """
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, began = None, None, False
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                if not began or row[key] != at:
                    if began and end:
                        out += end(at, state)
                    at, state, began = row[key], None, True
                state, more = step(state, row)
                out += more
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if began and end:
            yield pa.RecordBatch.from_pylist(end(at, state), schema=arrow)

    return log.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def lease_step(ttl, completion) -> Callable:  # noqa: ANN001
    """Leases of one message (ops acquire, complete, release): who tries to take one wins if there is none or it has run out.

    Completion keeps it for completion from then on, whoever asks; release gives it up. Both need a lease to be there.
    """

    def step(state: dict | None, row: dict) -> tuple[dict | None, list[dict]]:
        at, won = row["moment"], False
        if row["op"] == "acquire":
            won = state is None or state["expires_at"] < at
            if won:
                created = state["created_at"] if state else at
                state = {"status": "processing", "worker_id": row["worker"], "expires_at": at + ttl, "created_at": created, "updated_at": at}
        elif state is not None:
            state = {**state, "status": "completed", "expires_at": at + completion, "updated_at": at} if row["op"] == "complete" else None
        return state, [{"message_id": row["message_id"], "seq": row["seq"], "won": won}] if row["op"] == "acquire" else []

    return step


LEASE = "message_id string, status string, worker_id string, expires_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"


def _lease_chain(rows: DataFrame, ttl, completion) -> DataFrame:  # noqa: ANN001
    """Of hot keys' entries (chains.split()) those that change a lease: an acquisition that wins; a completion or release of a lease that is there.

    What changes a lease next follows from an entry's kind alone: after an acquisition or a completion the first completion or
    release, or the first acquisition after it has run out; after a release the first acquisition.
    """
    kind = F.col("row.op")
    asked, ends = rows.where(kind == "acquire").select("key", "at"), rows.where(kind != "acquire").select("key", "at")
    micros = lambda d: d.days * 86_400_000_000 + d.seconds * 1_000_000 + d.microseconds
    lasts = F.when(kind == "acquire", micros(ttl)).otherwise(micros(completion))
    out = rows.select("key", F.when(kind == "release", F.col("at")).otherwise(chains.after(lasts)).alias("at"), F.col("at").alias("own"), (kind == "release").alias("free"))
    again = chains.next_after(out, asked).select("key", F.col("own").alias("at"), "free", F.col("to").alias("again"))
    ended = chains.next_after(again, ends)
    to = F.when(F.col("free"), F.col("again")).otherwise(F.least("again", "to"))
    on = chains.reached(asked.groupBy("key").agg(F.min("at").alias("at")), ended.select("key", "at", to.alias("to")))
    return chains.table(rows.join(on, ["key", "at"]))


def lease_wins(log: DataFrame, ttl, completion, hot_rows: int = chains.HOT_ROWS) -> DataFrame:  # noqa: ANN001
    """message_id, seq, won of each attempt to take a lease. Keys of hot_rows entries or more are spread over tasks."""
    cold, rows = chains.split(log, "message_id", "moment", hot_rows)
    out = walk(cold, "message_id", ["moment", "seq"], "message_id string, seq bigint, won boolean", lease_step(ttl, completion))
    if rows is None:
        return out
    won = _lease_chain(rows, ttl, completion).select("key", "at", F.lit(True).alias("won"))
    tried = rows.where("row.op = 'acquire'").join(won, ["key", "at"], "left")
    return out.unionByName(tried.select("row.message_id", "row.seq", F.coalesce("won", F.lit(False)).alias("won")))


def lease_state(log: DataFrame, ttl, completion, hot_rows: int = chains.HOT_ROWS) -> DataFrame:  # noqa: ANN001
    """The leases that are there at the end of the log. Keys of hot_rows entries or more are spread over tasks."""
    step = lease_step(ttl, completion)
    cold, rows = chains.split(log, "message_id", "moment", hot_rows)
    out = walk(cold, "message_id", ["moment", "seq"], LEASE, lambda s, r: (step(s, r)[0], []), lambda key, s: [{"message_id": key, **s}] if s else [])
    if rows is None:
        return out
    changes = _lease_chain(rows, ttl, completion)
    freed = changes.where("row.op = 'release'").groupBy("key").agg(F.max("at").alias("freed"))
    live = changes.join(freed, "key", "left").where("freed is null or at > freed")
    taken = F.col("row.op") == "acquire"
    last = live.groupBy("key").agg(F.max_by("row", "at").alias("last"), F.max_by("row.worker", F.when(taken, F.col("at"))).alias("worker_id"), F.min_by("row.moment", F.when(taken, F.col("at"))).alias("created_at"))
    kind, at = F.col("last.op"), F.col("last.moment")
    ends = at + F.when(kind == "acquire", F.lit(ttl)).otherwise(F.lit(completion))
    return out.unionByName(last.select(F.col("last.message_id").alias("message_id"), F.when(kind == "acquire", "processing").otherwise("completed").alias("status"), "worker_id", ends.alias("expires_at"), "created_at", at.alias("updated_at")))


def reset_stale(leases: DataFrame, as_of: str, older_than: str, keep_rows: bool = False) -> DataFrame:
    """Leases after those in processing and not touched for older_than are reset: taken away, or (keep_rows) marked as released."""
    stale = (F.col("status") == "processing") & (F.col("updated_at") < F.expr(f"timestamp_ntz '{as_of}' - interval {older_than}"))
    if not keep_rows:
        return delete(leases, stale)
    now = F.expr(f"timestamp_ntz '{as_of}'")
    return leases.withColumns({"status": F.when(stale, "released").otherwise(F.col("status")), "expires_at": F.when(stale, now).otherwise(F.col("expires_at")), "updated_at": F.when(stale, now).otherwise(F.col("updated_at"))})


def marked_dedup(log: DataFrame, ttl, hot_rows: int = chains.HOT_ROWS) -> DataFrame:  # noqa: ANN001
    """message_id, seq, duplicate of each check in a log of checks and marks; a mark starts the expiry anew, a check only if it is not over.

    Keys of hot_rows entries or more are spread over tasks: from every mark, and from a key's first entry, the first check after
    the expiry follows, and so on, up to the next mark.
    """

    def step(state: dict | None, row: dict) -> tuple[dict | None, list[dict]]:
        again = row["op"] == "check" and state is not None and not state["expires_at"] < row["moment"]
        if not again:
            state = {"expires_at": row["moment"] + ttl}
        return state, [{"message_id": row["message_id"], "seq": row["seq"], "duplicate": again}] if row["op"] == "check" else []

    cold, rows = chains.split(log, "message_id", "moment", hot_rows)
    out = walk(cold, "message_id", ["moment", "seq"], "message_id string, seq bigint, duplicate boolean", step)
    if rows is None:
        return out
    checks, marks = rows.where("row.op = 'check'").select("key", "at"), rows.where("row.op <> 'check'").select("key", "at")
    micros = ttl.days * 86_400_000_000 + ttl.seconds * 1_000_000 + ttl.microseconds
    ends = rows.select("key", chains.after(F.lit(micros)).alias("at"), F.col("at").alias("own"))
    then = chains.next_after(ends, checks).select("key", F.col("own").alias("at"), F.col("to").alias("then"))
    links = chains.next_after(then, marks).select("key", "at", F.when(F.col("to").isNull() | (F.col("then") < F.col("to")), F.col("then")).alias("to"))
    heads = marks.unionByName(rows.groupBy("key").agg(F.min("at").alias("at")))
    first = chains.reached(heads, links).withColumn("first", F.lit(True))
    tried = rows.where("row.op = 'check'").join(first, ["key", "at"], "left")
    return out.unionByName(tried.select("row.message_id", "row.seq", F.col("first").isNull().alias("duplicate")))


def unexpired(df: DataFrame, column: str, as_of: str, ttl: str | None = None, always: Column | None = None) -> DataFrame:
    """Rows that retention still shows: column (and ttl) is not past as_of; rows without it, or where always holds, stay."""
    ends = F.col(column) if ttl is None else F.col(column) + F.expr(f"interval {ttl}")
    live = F.coalesce(ends > F.expr(f"timestamp_ntz '{as_of}'"), F.lit(True))
    return df.where(live if always is None else live | always)


def schema_versions(log: DataFrame, slices: int = 64) -> DataFrame:
    """The log of (name, seq, version, written_at) with accepted: no version below the largest accepted before it (equal is fine).

    The largest version before equals the largest accepted one. It runs over slices of seq: the maximum of each slice
    first (an aggregate), then of the slices before, then within a slice; so a name that takes all rows is spread.
    """
    bounds = log.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    lo, width = bounds["lo"] or 0, max(1, -(-((bounds["hi"] or 0) - (bounds["lo"] or 0) + 1) // slices))
    sliced = log.withColumn("_slice", F.floor((F.col("seq") - lo) / width).cast("int"))
    tops = sliced.groupBy("name", "_slice").agg(F.max("version").alias("top"))
    earlier = tops.withColumn("_before", F.max("top").over(Window.partitionBy("name").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))).select("name", "_slice", "_before")
    inside = F.max("version").over(Window.partitionBy("name", "_slice").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    both = sliced.withColumn("_inside", inside).join(earlier, ["name", "_slice"])
    before = F.greatest("_before", "_inside")
    return both.withColumn("accepted", before.isNull() | (F.col("version") >= before)).drop("_slice", "_before", "_inside")


def schema_state(log: DataFrame) -> DataFrame:
    """name, version, created_at, updated_at of each schema; the time of the first accepted entry is kept."""
    kept = schema_versions(log).where("accepted")
    return kept.groupBy("name").agg(F.max_by("version", "seq").alias("version"), F.min_by("written_at", "seq").alias("created_at"), F.max_by("written_at", "seq").alias("updated_at"))


def schema_changes(log: DataFrame) -> DataFrame:
    """The feed of changes that watchers are told of: name, version, updated_at of each accepted entry."""
    return schema_versions(log).where("accepted").select("name", "version", F.col("written_at").alias("updated_at"), "seq")
