"""Queue, outbox, leases: rows that can be taken at a given time, and what maintenance makes of them. Dedup by time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators import chains


def at(ts: str):  # noqa: ANN201
    return F.expr(f"timestamp_ntz '{ts}'")


def claim_batch(outbox: DataFrame, n: int) -> DataFrame:
    """The next n messages to publish: pending or failed, by priority, then age; ids break ties."""
    return outbox.where(F.col("status").isin("pending", "failed")).orderBy(F.desc("priority"), "created_at", "id").limit(n)


def older(status: str, column: str, as_of: str, than: str) -> Column:
    return (F.col("status") == status) & (F.col(column) < F.expr(f"timestamp_ntz '{as_of}' - interval {than}"))


def stuck(df: DataFrame, status: str, column: str, as_of: str, older_than: str) -> DataFrame:
    """Rows of a status whose time lies strictly before as_of - older_than."""
    return df.where(older(status, column, as_of, older_than))


def recover(outbox: DataFrame, as_of: str, older_than: str) -> DataFrame:
    """The outbox with claims before the cutoff given back."""
    old = (F.col("status") == "processing") & (F.col("claimed_at") < F.expr(f"timestamp_ntz '{as_of}' - interval {older_than}"))
    return outbox.withColumns({"status": F.when(old, "pending").otherwise(F.col("status")), "claimed_at": F.when(~F.coalesce(old, F.lit(False)), F.col("claimed_at"))})


def retry(outbox: DataFrame, most: int) -> DataFrame:
    again = (F.col("status") == "failed") & (F.col("retry_count") < most)
    return outbox.withColumn("status", F.when(again, "pending").otherwise(F.col("status")))


def fetch(queue: DataFrame, n: int, as_of: str, visible_again: str = "5 minutes") -> DataFrame:
    """The n oldest messages of each queue that are pending, or in flight past the visibility timeout."""
    late = (F.col("status") == "inflight") & (F.col("inflight_at") < F.expr(f"timestamp_ntz '{as_of}' - interval {visible_again}"))
    rank = F.row_number().over(Window.partitionBy("event_name").orderBy("enqueued_at", "seq"))
    return queue.where((F.col("status") == "pending") | late).withColumn("rank", rank).where(F.col("rank") <= n)


def nack(queue: DataFrame) -> DataFrame:
    """In-flight messages given back: pending again, one retry more, not in flight."""
    return queue.where("status = 'inflight'").withColumns({"status": F.lit("pending"), "retry_count": F.col("retry_count") + 1, "inflight_at": F.lit(None).cast("timestamp_ntz")})


def acquirable(claims: DataFrame, as_of: str) -> DataFrame:
    """Leases that anyone may take: without status, or expired strictly before as_of."""
    return claims.where(F.col("status").isNull() | (F.col("expires_at") < at(as_of)))


def ttl_dedup(deliveries: DataFrame, ttl_seconds: int, hot_rows: int = chains.HOT_ROWS) -> DataFrame:
    """Deliveries accepted: the first of an id, and each that comes after the expiry of the one accepted before.

    The next answer depends on the last accepted time, which no window function carries. Ids of under hot_rows deliveries are
    walked in order, batch by batch with one id and one time in hand. An id with more is spread: each of its deliveries
    is linked to the first one after its own expiry, and the links are followed from the id's first delivery.
    """
    cold, rows = chains.split(deliveries, "message_id", "arrived_at", hot_rows)
    if rows is None:
        return _walked(deliveries, ttl_seconds)
    timed = rows.where(F.col("at.us") < chains.LAST).select("key", "at")  # one without time is accepted only if the id has no others
    ends = timed.select("key", chains.after(F.lit(ttl_seconds * 1_000_000)).alias("at"), F.col("at").alias("own"))
    links = chains.next_after(ends, timed).select("key", F.col("own").alias("at"), "to")
    heads = rows.groupBy("key").agg(F.min("at").alias("at"))
    accepted = rows.join(chains.reached(heads, links), ["key", "at"]).dropDuplicates(["key", "at"])
    return _walked(cold, ttl_seconds).unionByName(accepted.select("row.*"))


def _walked(deliveries: DataFrame, ttl_seconds: int) -> DataFrame:
    """ttl_dedup() with one task for all deliveries of an id."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ttl, at_id, last = ttl_seconds * 1_000_000, object(), None
        for b in batches:
            keep = []
            times = b.column(b.schema.get_field_index("arrived_at")).cast(pa.int64())  # microseconds
            for i, t in zip(b.column(b.schema.get_field_index("message_id")).to_pylist(), times.to_pylist(), strict=True):
                keep.append(i != at_id or None not in (last, t) and last + ttl < t)
                if keep[-1]:
                    at_id, last = i, t
            yield b.filter(pa.array(keep, pa.bool_()))

    ordered = deliveries.repartition("message_id").sortWithinPartitions("message_id", F.asc_nulls_last("arrived_at"), "seq")
    return ordered.mapInArrow(walk, deliveries.schema)


def capped(df: DataFrame, n: int, *newest: str) -> DataFrame:
    """The newest n rows."""
    return df.orderBy(*map(F.desc, newest)).limit(n)
