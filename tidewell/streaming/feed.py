"""A change feed that runs: options, subscriptions, outcomes, acknowledgements, dead letters, restarts, metrics, health.

Feed takes the place of a transport over a change source. Each batch goes to every subscriber (there is no routing by event). A
handler gets a batch of messages and may give back what became of each (id, outcome, error, seconds); without that all are ok, and
per_message() makes such a handler of a function of one message. A message is acknowledged if every subscriber's outcome for
it is ok or ack; one that was rejected goes to the dead letters, as does text that is no document; one that was
nacked stays pending. All subscribers run even if some fail; their errors are raised together after that, and the batch runs
again after a restart for those that failed only.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewell.operators import monitor, normalize
from tidewell.sources import changefeed
from tidewell.streaming import stateful
from tidewell.streaming.marks import Marks

Handler = Callable[[DataFrame, int], DataFrame | None]
Middleware = Callable[[str, Handler], Handler]
MODES = ("default", "updateLookup", "whenAvailable", "required")
OUTCOMES = "id string, outcome string, error string, seconds double"


class PublishNotSupported(RuntimeError):
    """A feed is read only: events come from writes to the source."""


class HandlersFailed(RuntimeError):
    """What the subscribers of a batch raised, by name."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {e}" for name, e in errors.items()))
        self.errors = errors


class Reject(Exception):  # noqa: N818
    """Raised by a function of one message: never deliver it again."""


class Nack(Exception):  # noqa: N818
    """Raised by a function of one message: it is still to be done."""


class Ack(Exception):  # noqa: N818
    """Raised by a function of one message: it counts as done all the same."""


def per_message(f: Callable[[dict], None]) -> Handler:
    """A handler of a function of one message (a dict of its columns), run in tasks; what one message raises concerns that one alone.

    It may run again for a message if a task or the batch does.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for message in frame.to_dict("records"):
                outcome, error, began = "ok", None, time.perf_counter()
                try:
                    f(message)
                except Ack as e:
                    outcome, error = "ack", str(e)
                except Reject as e:
                    outcome, error = "reject", str(e)
                except Exception as e:  # noqa: BLE001
                    outcome, error = "nack", str(e)
                rows.append((message["id"], outcome, error, time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=["id", "outcome", "error", "seconds"])

    return lambda batch, number: batch.mapInPandas(run, OUTCOMES)


class AckStore(Protocol):
    """Where deliveries are noted: pending before they are handed out, acknowledged after."""

    def store(self, ids: DataFrame, batch: int) -> None: ...
    def ack(self, ids: DataFrame, batch: int) -> None: ...


class AckTable:
    """An ack log as Parquet under a folder: a file set per batch and op, written over when a batch runs again."""

    def __init__(self, path: str):
        self.path = path

    def _write(self, ids: DataFrame, batch: int, op: str) -> None:
        n = {"store": 0, "ack": 1}[op]
        rows = ids.select(F.col("id").alias("event_id"), F.lit(2 * batch + n).cast("long").alias("seq"), F.lit(op).alias("op"), F.current_timestamp().cast("timestamp_ntz").alias("moment"))
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}/op={op}")

    def store(self, ids: DataFrame, batch: int) -> None:
        self._write(ids, batch, "store")

    def ack(self, ids: DataFrame, batch: int) -> None:
        self._write(ids, batch, "ack")

    def log(self, spark: SparkSession) -> DataFrame:
        """The log that folds.ack_state() folds."""
        return spark.read.schema("event_id string, seq bigint, moment timestamp_ntz, batch bigint, op string").parquet(self.path).drop("batch")


class DeadLetters:
    """Messages that no one will get again, as Parquet: id, event_name ('' for text that is no document), payload, reason, error."""

    schema = "id string, payload binary, reason string, error string, batch bigint, event_name string"

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: DataFrame, batch: int, event_name: str) -> None:
        to = f"{self.path}/batch={batch}/event_name={event_name or '_'}"
        rows.select("id", "payload", "reason", "error").write.mode("overwrite").parquet(to)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path).withColumn("event_name", F.when(F.col("event_name") != "_", F.col("event_name")).otherwise(""))


@dataclass(frozen=True)
class Options:
    """How a feed reads and what it hands out; wrong combinations are a ValueError when it is made."""

    path: str
    checkpoint: str
    database: str = ""
    collection: str = ""
    instance: str = "default"
    start_at: str = "latest"
    resume: bool = True  # False: each start is a new checkpoint
    fail_on_data_loss: bool = True
    full_document: str = "default"
    documents_only: bool = False
    described: bool = False
    most_updated_bytes: int = 0
    empty_updates: bool = False
    most_files: int = 0
    pipeline: Callable[[DataFrame], DataFrame] | None = None
    scheme: str = "feed"
    first_wait: float = 1.0
    most_wait: float = 60.0
    most_restarts: int | None = None
    on_error: Callable[[Exception], None] | None = None
    on_history_lost: Callable[[Exception], None] | None = None

    def __post_init__(self) -> None:
        if not self.path or not self.checkpoint:
            raise ValueError("a feed needs a path and a checkpoint folder")
        if self.full_document not in MODES:
            raise ValueError(f"full document mode {self.full_document!r} is none of {', '.join(MODES)}")
        if self.full_document == "default" and (self.documents_only or self.most_updated_bytes > 0):
            raise ValueError("documents only and a limit of updated fields need a full document mode")
        if self.collection and not self.database:
            raise ValueError("a collection is watched within a database")

    @property
    def level(self) -> str:
        return changefeed.level(self.database, self.collection)

    @property
    def resume_key(self) -> str:
        return f"{self.database or '*'}.{self.collection or '*'}:{self.instance}"


@dataclass
class Feed:
    spark: SparkSession
    options: Options
    acks: AckStore | None = None
    metrics: Metrics | None = None
    dead_letters: DeadLetters | None = None
    handlers: dict[str, Handler] = field(default_factory=dict)
    middleware: list[Middleware] = field(default_factory=list)
    restarts: int = 0
    batches: int = 0
    _query: object = None
    _closed: bool = False

    def use(self, middleware: Middleware) -> None:
        """Wrap handlers registered from now on: middleware gets a subscriber's name and its handler and gives a handler. The first is the outermost."""
        self.middleware.append(middleware)

    def register(self, name: str, handler: Handler) -> None:
        """A subscriber; names are unique."""
        if self._closed:
            raise RuntimeError("the feed is closed")
        if name in self.handlers:
            raise ValueError(f"{name} is registered already")
        for wrap in reversed(self.middleware):
            handler = wrap(name, handler)
        self.handlers[name] = handler

    def unregister(self, name: str) -> None:
        self.handlers.pop(name, None)

    def publish(self, *_: object) -> None:
        raise PublishNotSupported("events come from writes to the source")

    def messages(self) -> DataFrame:
        """The stream of messages; text that is no document has it in malformed, which is null otherwise."""
        o = self.options
        more = {"maxFilesPerBatch": str(o.most_files)} if o.most_files else {}
        place = self._place()
        more |= {"startAfter": place["start"]}
        events = changefeed.watch(self.spark, o.path, o.database, o.collection, malformed=True, checkpoint=self.checkpoint, startAt=o.start_at, failOnDataLoss=str(o.fail_on_data_loss).lower(), **more)
        update = F.col("operation_type") == "update"
        if o.full_document == "default":
            events = events.withColumn("full_document", F.when(~update, F.col("full_document")))
        elif o.full_document == "updateLookup":
            events = stateful.looked_up(events)
        elif o.full_document == "required":
            lacking = update & F.col("full_document").isNull()
            events = events.withColumn("full_document", F.when(lacking, F.raise_error(F.lit("update without the required image"))).otherwise(F.col("full_document")))
        if not o.empty_updates:
            events = events.where(F.col("malformed").isNotNull() | ~normalize.is_empty_update())
        if o.pipeline:
            events = events.transform(o.pipeline)
        if self.metrics:
            events = self.metrics.observed(events)
        return normalize.messages(normalize.payloads(events, o.documents_only), o.scheme, o.described, o.most_updated_bytes)

    def _batch(self, batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                self._hand_out(batch.where("malformed is null").drop("malformed"), batch.where("malformed is not null"), number)
                self.batches += 1
        finally:
            batch.unpersist()

    def _hand_out(self, good: DataFrame, bad: DataFrame, number: int) -> None:
        if self.dead_letters:
            self.dead_letters.write(bad.select("id", F.encode("malformed", "utf-8").alias("payload"), F.lit("malformed").alias("reason"), F.lit(None).cast("string").alias("error")), number, "")
        if self.acks:  # noted before anyone gets it: if that fails, nothing is handed out
            self.acks.store(good, number)
        done, errors, outcomes = Marks(self.spark, f"{self.checkpoint}-done/{number}"), {}, []
        already = set(done.names())
        for name, handler in list(self.handlers.items()):
            table = f"{self.checkpoint}-outcomes/{number}/{name}"
            try:
                if name not in already:
                    found = handler(good.withColumn("event_name", F.lit(name)), number)
                    if found is not None:  # evaluated once: what follows reads the table
                        found.select("id", "outcome", "error", "seconds").write.mode("overwrite").parquet(table)
                    done.add(name, {"outcomes": found is not None})
                if done.read(name)["outcomes"]:
                    outcomes.append((name, self.spark.read.schema(OUTCOMES).parquet(table)))
            except Exception as e:  # noqa: BLE001
                errors[name] = e
        if errors:
            raise HandlersFailed(errors)
        for name, rows in outcomes:
            if self.dead_letters:
                rejected = rows.where("outcome = 'reject'").select("id", "error").dropDuplicates(["id"])
                self.dead_letters.write(good.join(rejected, "id").select("id", "payload", F.lit("reject").alias("reason"), "error"), number, name)
        if self.metrics:
            self.metrics.handled(good, set(self.handlers), dict(outcomes))
        if self.acks:
            unearned = [rows.where("outcome not in ('ok', 'ack')").select("id") for _, rows in outcomes]
            earned = good.select("id")
            for ids in unearned:
                earned = earned.join(ids.distinct(), "id", "left_anti")
            self.acks.ack(earned, number)
        for kind in ("done", "outcomes"):  # what only a rerun of an earlier batch would read
            Marks(self.spark, f"{self.checkpoint}-{kind}").remove(str(number - 2))

    @property
    def _base(self) -> str:
        o = self.options
        place = o.resume_key.replace("*", "_").replace(":", "/").replace(".", "/")
        return f"{o.checkpoint.rstrip('/')}/{place}"

    def _places(self) -> Marks:
        return Marks(self.spark, f"{self._base}-places")

    def _place(self) -> dict:
        """The newest place record (epoch; start, where it begins in the log); the first one is made when it is asked for first."""
        places = self._places()
        while not (names := places.names()):
            self._mark(0)
        return places.read(names[-1])

    def _mark(self, epoch: int) -> None:
        start = changefeed.start_place(changefeed.qualified(self.spark, self.options.path), self.options.start_at)
        self._places().add(f"{epoch:08d}", {"epoch": epoch, "start": json.dumps(start)})

    @property
    def checkpoint(self) -> str:
        """The folder of the current epoch's checkpoint: any process that asks gets the same."""
        names = self._places().names()
        epoch = int(names[-1]) if names else 0
        return self._base + (f"-{epoch}" if epoch else "")

    def start(self, **trigger: object) -> object:
        """One query over what is there (availableNow=True, the default) or as it comes (processingTime=...)."""
        if self._closed:
            raise RuntimeError("the feed is closed")
        if not self.options.resume and self._query is None:
            self.reset()
        with stateful.state_store(self.spark):
            writer = self.messages().writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
            self._query = writer.trigger(**(trigger or {"availableNow": True})).start()
        if self.metrics:
            self.metrics.opened(self.spark, self._query)
        return self._query

    def run(self, sleep: Callable[[float], None] = time.sleep, **trigger: object) -> None:
        """start() and wait; a failure is followed by a restart after a wait that doubles, and starts over after a batch that worked."""
        wait, seen = self.options.first_wait, self.batches
        while not self._closed:
            try:
                before = self.batches
                self.start(**trigger).awaitTermination()
                # A query over what is there has one batch; with most_files more may be left.
                if self._closed or "processingTime" in trigger or self.batches == before or not changefeed.pending(changefeed.qualified(self.spark, self.options.path), changefeed.qualified(self.spark, self.checkpoint)):
                    return
            except Exception as e:  # noqa: BLE001
                lost = "ChangeStreamHistoryLost" in str(e)
                if self.batches > seen:
                    wait, seen = self.options.first_wait, self.batches
                if lost:
                    if self.options.on_history_lost:  # told before the place is forgotten
                        self.options.on_history_lost(e)
                    self.reset()
                elif self.options.on_error:
                    self.options.on_error(e)
                self.restarts += 1
                if self.metrics:
                    self.metrics.reconnected(self.options.resume_key, "history_lost" if lost else "error")
                if self.options.most_restarts is not None and self.restarts > self.options.most_restarts:
                    raise
                if not lost:
                    sleep(wait)
                    wait = min(2 * wait, self.options.most_wait)
            finally:
                if self.metrics:
                    self.metrics.closed(self._query)

    def reset(self) -> None:
        """Forget the place: from now on, and in any process, the feed begins where start_at says as of now, with a new checkpoint."""
        names = self._places().names()
        self._mark(int(names[-1]) + 1 if names else 1)

    def close(self) -> None:
        """Stop and let go of the subscribers; a second call does nothing."""
        if not self._closed:
            self._closed = True
            if self._query is not None:
                self._query.stop()
            self.handlers.clear()

    def health(self) -> dict:
        q = self._query
        running = bool(q is not None and q.isActive)
        failed = q.exception() if q is not None and not running else None
        state = "closed" if self._closed else "healthy" if failed is None else "unhealthy"
        return {"status": state, "running": running, "level": self.options.level, "resume_key": self.options.resume_key, "subscribers": len(self.handlers), "restarts": self.restarts, "batches": self.batches, "error": str(failed)[:500] if failed else "", "last_progress": q.lastProgress if q is not None else None}


class Metrics:
    """What a running feed counts, by name and labels; a prefix tells feeds apart.

    changes_processed_total, changes_failed_total (event, operation, namespace): from the outcomes of handlers.
    stream_receive_lag_seconds, handler_duration_seconds: how many fell in each bucket; a bucket's index is the number of bounds below
    the value. Lags are observed on the feed's own stream, and a listener adds up what its batches report.
    stream_reconnections_total (namespace, reason); active: open queries.
    """

    NAME = "changes"

    def __init__(self, prefix: str = "", clock: Column | None = None):
        """clock: what lags are measured against (default: the time of the batch)."""
        self.prefix, self.clock, self.active, self.counters, self.lags, self.durations = prefix, clock, 0, {}, {}, {}
        self._listener: _Listener | None = None

    def _add(self, to: dict, key: object, n: int) -> None:
        if n:
            to[key] = to.get(key, 0) + n

    def opened(self, spark: SparkSession, query: object) -> None:
        self.active += 1
        if self._listener is None:
            self._listener = _Listener(self)
            spark.streams.addListener(self._listener)
        self._listener.follow(query)

    def closed(self, query: object, most_wait: float = 30.0) -> None:
        """Waits for what the query has reported."""
        if query is not None and self.active:
            self.active -= 1
            if self._listener:
                self._listener.ended(query, most_wait)

    def close(self, spark: SparkSession) -> None:
        if self._listener:
            spark.streams.removeListener(self._listener)
            self._listener = None

    def reconnected(self, namespace: str, reason: str) -> None:
        self._add(self.counters, (f"{self.prefix}stream_reconnections_total", namespace, reason), 1)

    def observed(self, events: DataFrame, name: object = NAME) -> DataFrame:
        """events with their number, the rows of each lag bucket and the largest lag (never below 0) noted per batch."""
        clock = F.unix_micros(F.current_timestamp()) if self.clock is None else F.unix_micros(self.clock.cast("timestamp"))
        lag = (clock - F.unix_micros(F.col("timestamp").cast("timestamp"))) / 1e6
        known = F.col("malformed").isNull() if "malformed" in events.columns else F.lit(True)
        bucket = F.when(known, monitor.bucket(lag, monitor.LAG_BOUNDS))
        most = F.max(F.when(known, F.greatest(F.lit(0.0), lag))).alias("receive_lag_seconds")
        return events.observe(name, F.count_if(known).alias("received"), most, *(F.count_if(bucket == i).alias(f"lag_{i}") for i in range(len(monitor.LAG_BOUNDS) + 1)), F.count_if(~known).alias("malformed"))

    def reported(self, row: dict) -> None:
        for i in range(len(monitor.LAG_BOUNDS) + 1):
            self._add(self.lags, i, row[f"lag_{i}"])
        self._add(self.counters, (f"{self.prefix}changes_malformed_total",), row["malformed"])

    def handled(self, good: DataFrame, names: set[str], outcomes: dict[str, DataFrame]) -> None:
        """Add what became of a batch: one row for each operation, namespace and outcome comes to the driver."""
        labels = [F.element_at("metadata", F.lit(c)).alias(c) for c in ("operation", "namespace")]
        for name in names:
            rows = good.select("id", *labels)
            if name in outcomes:
                rows = rows.join(outcomes[name].dropDuplicates(["id"]), "id", "left")
                for b in outcomes[name].groupBy(monitor.bucket(F.col("seconds"), monitor.DURATION_BOUNDS).alias("bucket")).count().collect():
                    self._add(self.durations, (name, b["bucket"]), b["count"])
            else:
                rows = rows.withColumn("outcome", F.lit("ok"))
            failed = F.coalesce(F.col("outcome"), F.lit("ok")).isin("nack", "reject")
            for r in rows.groupBy("operation", "namespace", failed.alias("failed")).count().collect():
                kind = "changes_failed_total" if r["failed"] else "changes_processed_total"
                self._add(self.counters, (self.prefix + kind, name, r["operation"], r["namespace"]), r["count"])


class _Listener(StreamingQueryListener):
    def __init__(self, metrics: Metrics):
        self.metrics, self.runs, self.changed = metrics, {}, threading.Condition()

    def follow(self, query) -> None:  # noqa: ANN001
        with self.changed:
            self.runs.setdefault(str(query.runId), False)

    def ended(self, query, most_wait: float) -> None:  # noqa: ANN001
        with self.changed:
            self.changed.wait_for(lambda: self.runs.get(str(query.runId), True), most_wait)

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        row = event.progress.observedMetrics.get(Metrics.NAME)
        if row is not None and str(event.progress.runId) in self.runs:
            self.metrics.reported(row.asDict())

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        with self.changed:
            self.runs[str(event.runId)] = True
            self.changed.notify_all()
