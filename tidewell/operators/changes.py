"""Change events: filters, payloads, metadata, coalescing, fan-out and the lookup of current documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Operations behind each kind of event.
EVENT_TYPES = {"created": ("insert",), "updated": ("update", "replace"), "deleted": ("delete",)}


def drop_empty_updates(df: DataFrame, empty: Column) -> DataFrame:
    """Without updates that changed and removed no field; other operations stay."""
    return df.where(~((F.col("operation_type") == "update") & F.coalesce(empty, F.lit(False))))


def of_event_type(df: DataFrame, kind: str) -> DataFrame:
    """Changes of one kind; an unknown kind has none."""
    found = EVENT_TYPES.get(kind, ())
    return df.where(F.col("operation_type").isin(*found) if found else F.lit(False))


def of_collections(df: DataFrame, db: str | None, collections: Sequence[str]) -> DataFrame:
    """Changes of the collections; without a database or collections there is no filter."""
    return df.where((F.col("db") == db) & F.col("coll").isin(*collections)) if db and collections else df


def since(df: DataFrame, as_of: str, back: str, column: str = "ts") -> DataFrame:
    return df.where(F.col(column) >= F.expr(f"timestamp_ntz '{as_of}' - interval {back}"))


def latest_per_key(df: DataFrame, keys: Sequence[str], *newest: Column) -> DataFrame:
    """The last row of each key in the order given; map-side combined, so a hot key does not gather its rows."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*newest, F.struct(*rest).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*").select(*df.columns)


def superseded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("superseded"))


def namespace() -> Column:
    return F.concat_ws(".", "db", "coll")


def resume_key(db: Column | None, coll: Column | None, instance: str) -> Column:
    """Under what a stream's place is kept: its namespace, with * for what it does not name, and the instance."""
    return F.concat(db if db is not None else F.lit("*"), F.lit("."), coll if coll is not None else F.lit("*"), F.lit(":" + instance))


def full_document(df: DataFrame, mode: str, image: str) -> DataFrame:
    """Images of updates by mode: default (none), whenAvailable (as they are), required (a missing one is an error).

    updateLookup is with_current(). Other operations keep theirs.
    """
    update = F.col("operation_type") == "update"
    if mode == "default":
        return df.withColumn(image, F.when(~update, F.col(image)))
    if mode == "required":
        return df.withColumn(image, F.when(update & F.col(image).isNull(), F.raise_error(F.lit("update without the required image"))).otherwise(F.col(image)))
    if mode != "whenAvailable":
        raise ValueError(f"full document mode {mode!r} is none of default, whenAvailable, required")
    return df


def payload(df: DataFrame, document: Column) -> DataFrame:
    """content_type and payload of document-only delivery: a delete gives its key as text, a change without image goes."""
    deleted = F.col("operation_type") == "delete"
    return df.select("id", F.when(deleted, "text/plain").otherwise("application/json").alias("content_type"), F.when(deleted, F.col("document_key")).otherwise(document).alias("payload")).where("payload is not null")


def capped_fields(fields: Column, most: int | None) -> Column:
    """JSON of updated fields, or nothing when its bytes are over the limit (None: no limit)."""
    return fields if most is None else F.when(F.octet_length(fields) <= most, fields)


def fan_out(df: DataFrame, registered: Sequence[str]) -> DataFrame:
    """Every change for every registered name."""
    return df.withColumn("registered", F.explode(F.array(*map(F.lit, registered)))) if registered else df.limit(0).withColumn("registered", F.lit(""))


def first_delivery(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key; rows with a null or empty key bypass the dedup, each as a key of its own. One scan, combined before the shuffle."""
    keyed = F.length(F.coalesce(key, F.lit(""))) > 0
    own = F.when(~keyed, F.monotonically_increasing_id())
    rest = [c for c in df.columns if c != key]
    best = F.min(F.struct(*order, F.struct(*rest).alias("_row"))).alias("_best")
    return df.groupBy(key, own.alias("_own")).agg(best).select(key, "_best._row.*").select(*df.columns)


def with_current(changes: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Each update with the image of its document now; other operations keep their own."""
    return changes.join(current, key, "left")
