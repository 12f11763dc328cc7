"""Streams over landed files of the record tables, each equal to its batch form.

The files of a table land in slices of time, and each stream is stopped and started again after each of them: offsets and
state carry over batches and restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import changes, folds
from tidewell.plans.logs import ORACLES as BATCH
from tidewell.sources.adapters import duck, sql_text
from tidewell.sources.shared import folder
from tidewell.streaming import stateful

SLICES = 3


def land(events: DataFrame, order: str, path: str, run: Callable[[], None], slices: int = SLICES) -> None:
    """events written to path in slices by the timestamp in order, as a feed would land them; run after each of them.

    run starts a query anew each time, with the checkpoint it had before: batches, restarts and state over both.
    """
    spark, at = events.sparkSession, F.unix_micros(F.col(order).cast("timestamp"))
    bounds = events.agg(F.percentile_approx(at, [i / slices for i in range(1, slices)], 1000).alias("b")).first()["b"] or []
    slice_ = sum((F.when(at > b, 1).otherwise(0) for b in bounds), F.lit(0))
    for i in range(slices):
        events.where(slice_ == i).coalesce(spark.sparkContext.defaultParallelism).write.mode("append").parquet(f"{path}/slice={i}")
        run()


def change_stream(spark: SparkSession, landed: str, adapter: str = "change_events", files_per_trigger: int = 1_000) -> DataFrame:
    """A record table over landed files of events, as a stream; its offsets in the checkpoint take the place of resume tokens."""
    schema = spark.read.parquet(landed).drop("slice").schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{landed}/*")
    return spark.sql(sql_text(adapter, "events"), events=files)


def drain(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """All that is there now, batch by batch, through sink. With the checkpoint of an earlier run it goes on where that stopped."""
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def written(out: str) -> Callable[[DataFrame, int], None]:
    """A sink that a batch that runs again writes over."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change of each document: the newest of each batch is written, the newest of all read."""
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)

    def sink(batch: DataFrame, number: int) -> None:
        effective = changes.drop_empty_updates(batch, F.col("no_fields_changed"))
        written(out)(changes.latest_per_key(effective, ["document_key"], F.col("ts"), F.col("seq")), number)

    land(_events(spark, sf_dir), "ts", landed, lambda: drain(change_stream(spark, landed, files_per_trigger=4), sink, checkpoint))
    return changes.latest_per_key(spark.read.parquet(out).drop("batch"), ["document_key"], F.col("ts"), F.col("seq")).select("document_key", "id", "operation_type", "value")


def fanned_out(spark: SparkSession, sf_dir: str, registered: Sequence[str] = ("audit", "search")) -> DataFrame:
    """Every change in the sink of every registered name."""
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)
    land(_events(spark, sf_dir), "ts", landed, lambda: drain(changes.fan_out(change_stream(spark, landed, files_per_trigger=4).select("id", "operation_type"), registered), written(out), checkpoint))
    return spark.read.parquet(out).select("id", "operation_type", "registered")


def deduplicated(spark: SparkSession, sf_dir: str, ttl: str = "1 day") -> DataFrame:
    """Changes of which a third arrive again an hour later, each once, by state that the watermark clears.

    The watermark follows the largest time seen: what comes later than ttl behind it is dropped, and a repeat after it passes.
    """
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)
    events = _events(spark, sf_dir)
    again = events.where("event_id % 3 = 0").withColumn("ts", F.expr("ts + interval 1 hour"))

    def run() -> None:
        timed = change_stream(spark, landed).withColumn("at", F.col("ts").cast("timestamp"))
        drain(timed.withWatermark("at", ttl).dropDuplicatesWithinWatermark(["id"]).select("id", "document_key"), written(out), checkpoint)

    land(events.unionByName(again), "ts", landed, run)
    return spark.read.schema("id string, document_key string").parquet(f"{out}/*")


def windowed_rates(spark: SparkSession, sf_dir: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Changes per window and operation, updated batch by batch; what is later than late behind the newest change is dropped."""
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)

    def sink(batch: DataFrame, number: int) -> None:
        written(out)(batch.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "operation_type", "n", F.lit(number).alias("number")), number)

    def run() -> None:
        timed = change_stream(spark, landed).withColumn("at", F.col("ts").cast("timestamp"))
        drain(timed.withWatermark("at", late).groupBy(F.window("at", width), "operation_type").agg(F.count(F.lit(1)).alias("n")), sink, checkpoint, "update")

    land(_events(spark, sf_dir), "ts", landed, run)
    return changes.latest_per_key(spark.read.parquet(out).drop("batch"), ["start", "operation_type"], F.col("number")).select("start", "operation_type", "n")


def leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who gets each lease, with the leases in keyed state over batches. A batch is a slice of time, taken in order."""
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)
    state = "status string, worker_id string, expires_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    step = folds.lease_step(timedelta(hours=1), timedelta(days=1))

    def run() -> None:
        wins = stateful.folded(change_stream(spark, landed, "lease_log"), "message_id", ("moment", "seq"), step, state, "message_id string, seq bigint, won boolean")
        drain(wins, written(out), checkpoint)

    with stateful.state_store(spark):
        land(_events(spark, sf_dir), "ts", landed, run)
    return spark.read.parquet(out).select("message_id", "seq", "won")


def looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image of each updated document right after its update, from images in keyed state over batches and restarts."""
    landed, out, checkpoint = folder(spark), folder(spark), folder(spark)
    image = F.when(F.col("operation_type").isin("insert", "replace"), F.to_json(F.struct("id", "k")))
    fields = F.when(F.col("operation_type") == "update", F.when(F.col("no_fields_changed"), "{}").otherwise(F.to_json(F.struct("k"))))

    def run() -> None:
        stream = change_stream(spark, landed).select(
            "id", "operation_type", "document_key", F.concat_ws(".", "db", "coll").alias("namespace"), image.alias("full_document"), fields.alias("updated_fields"), F.array().cast("array<string>").alias("removed_fields"),
            F.lpad(F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), 20, "0").alias("file"), F.col("seq").alias("position"))
        found = stateful.looked_up(stream).where("operation_type = 'update'")
        drain(found.select("id", "document_key", F.get_json_object("full_document", "$.id").alias("current_id"), F.get_json_object("full_document", "$.k").cast("long").alias("current_k")), written(out), checkpoint)

    with stateful.state_store(spark):
        land(_events(spark, sf_dir), "ts", landed, run)
    return spark.read.schema("id string, document_key string, current_id string, current_k bigint").parquet(f"{out}/*")


LOOKED_UP = f"""with {duck('change_events')},
g as (select *, count(*) filter (operation_type <> 'update') over (partition by coll, document_key order by ts, seq) as life from change_events),
l as (select *, first_value(operation_type) over w as began, first_value(id) over w as first_id,
      last_value(case when operation_type <> 'update' or not no_fields_changed then k end ignore nulls) over (partition by coll, document_key, life order by ts, seq) as last_k from g window w as (partition by coll, document_key, life order by ts, seq))
select id, document_key, case when began in ('insert', 'replace') then first_id end as current_id, case when began in ('insert', 'replace') then last_k end as current_k from l where operation_type = 'update'"""
QUERIES = {"stream_coalesce": coalesced, "stream_fanout": fanned_out, "stream_dedup": deduplicated, "stream_windowed_rates": windowed_rates, "stream_leases": leases, "stream_update_lookup": looked_up}
ORACLES = {
    "stream_coalesce": BATCH["coalesce_latest"],
    "stream_fanout": f"with {duck('change_events')} select id, operation_type, r.registered from change_events, (values ('audit'), ('search')) as r(registered)",
    "stream_dedup": f"with {duck('change_events')} select id, document_key from change_events",
    "stream_windowed_rates": f"with {duck('change_events')} select date_trunc('day', ts)::timestamp as start, operation_type, count(*) as n from change_events group by all",
    "stream_leases": BATCH["lease_wins"],
    "stream_update_lookup": LOOKED_UP,
}
