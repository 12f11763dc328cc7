"""Raw change documents (extended JSON text) to change events, payloads, metadata and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import bson
from tidewell.functions import documents as D


def parsed(raws: DataFrame, column: str = "raw") -> DataFrame:
    """raws with d, the text as a variant; null if it is no document. A generator of one row, so that nothing above parses again."""
    object_ = F.ltrim(F.col(column)).startswith("{")
    return raws.withColumn("d", F.explode(F.array(F.when(object_, F.try_parse_json(F.col(column))))))


def quarantine(raws: DataFrame, column: str = "raw") -> DataFrame:
    """Rows whose text is no document: normalize() leaves them out."""
    return parsed(raws, column).where("d is null").drop("d")


def normalize(raws: DataFrame, database: str = "", collection: str = "", column: str = "raw", keep: Sequence[str] = (), malformed: bool = False) -> DataFrame:
    """Change events of raw documents.

    An event without id gets one made of its text, so that a task that runs again gives the same; a namespace that is not
    there is the source's own. full_document, updated_fields: JSON text; null if absent, or if JSON can't hold a number of
    it (for updated fields, broken says so). described: whether there is an update description at all. timestamp has whole
    seconds. keep: columns of raws to carry along. malformed: texts that are no document stay, in a column of that name that is
    null for events.
    """
    read = parsed(raws.select(F.col(column).alias("_raw"), *keep), "_raw")
    read = read if malformed else read.where("d is not null")
    get = lambda path, kind: F.try_variant_get("d", path, kind)
    own = lambda c, other: F.when(F.coalesce(c, F.lit("")) == "", F.lit(other)).otherwise(c)
    db, coll = own(get("$.ns.db", "string"), database), own(get("$.ns.coll", "string"), collection)
    token, made = get("$._id._data", "string"), F.substring(F.sha2("_raw", 256), 1, 32)
    update, key = get("$.updateDescription", "variant"), F.col("_key")
    described = F.coalesce(F.schema_of_variant(update).startswith("OBJECT"), F.lit(False))
    document = lambda path: F.nullif(F.to_json(get(path, "variant")), F.lit("null"))
    # One conversion over the parts of a change that need it, so its expression is in the plan once.
    texts = read.withColumns({"_key": F.to_json(get("$.documentKey._id", "variant")), "_full": document("$.fullDocument"), "_updated": document("$.updateDescription.updatedFields")})
    texts = texts.withColumn("_plain", F.transform(F.array("_full", "_updated", F.when(D.odd_key(key), key)), D.plain))
    return texts.select(
        F.when(F.coalesce(token, F.lit("")) == "", made).otherwise(token).alias("id"),
        F.coalesce(get("$.operationType", "string"), F.lit("")).alias("operation_type"), db.alias("database"), coll.alias("collection"), F.concat_ws(".", db, coll).alias("namespace"),
        D.document_key(key, F.col("_plain")[2]).alias("document_key"), F.col("_plain")[0].alias("full_document"),
        described.alias("described"), F.col("_plain")[1].alias("updated_fields"), get("$.updateDescription.removedFields", "array<string>").alias("removed_fields"),
        D.beyond_json(F.col("_updated")).alias("broken"), F.transform(get("$.updateDescription.truncatedArrays", "array<struct<field:string,newSize:int>>"), lambda x: x["field"]).alias("truncated_arrays"),
        D.clock_of_millis(F.coalesce(get("$.clusterTime['$timestamp'].t", "bigint"), F.lit(0)) * 1000).alias("timestamp"),
        *keep, *([F.when(F.col("d").isNull(), F.coalesce("_raw", F.lit(""))).alias("malformed")] if malformed else []),
    )


def normalize_binary(raws: DataFrame, database: str = "", collection: str = "", column: str = "raw") -> DataFrame:
    """Change events of raw changes in their binary form; an event without id gets one made of its canonical text.

    Bytes that are no document are null texts, which normalize() leaves out: a filter here would convert all bytes once more.
    """
    return normalize(raws.select(bson.from_bson(F.col(column)).alias("raw")), database, collection)


def quarantine_binary(raws: DataFrame, column: str = "raw") -> DataFrame:
    """Rows whose bytes are no document: normalize_binary() leaves them out."""
    return raws.where(F.col(column).isNull() | bson.from_bson(F.col(column)).isNull())


def is_empty_update(described: str = "described") -> Column:
    """An update that changed and removed no field; cut arrays do not count."""
    none = (F.coalesce(F.size(F.json_object_keys("updated_fields")), F.lit(0)) <= 0) & (F.coalesce(F.size("removed_fields"), F.lit(0)) <= 0)
    return (F.col("operation_type") == "update") & (~F.col(described) | none & ~F.col("broken"))


def event_json() -> Column:
    """The whole event as JSON; parts that are empty are left out."""
    text = lambda name, c: F.concat(F.lit(f'"{name}":'), c)
    filled = lambda c, empty: F.when(c.isNotNull() & (c != empty), c)
    listed = lambda c: filled(F.to_json(c), "[]")
    update = F.concat(F.lit("{"), F.concat_ws(",", text("updated_fields", filled(F.col("updated_fields"), "{}")), text("removed_fields", listed(F.col("removed_fields"))), text("truncated_arrays", listed(F.col("truncated_arrays")))), F.lit("}"))
    parts = [text(c, D.quoted(F.col(c))) for c in ("id", "operation_type", "database", "collection", "document_key")]
    parts += [text("full_document", F.col("full_document")), F.when(F.col("described"), text("update_description", update))]
    parts += [text("timestamp", D.quoted(D.rfc3339(F.col("timestamp")))), text("namespace", D.quoted(F.col("namespace")))]
    return D.web_safe(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))


def payloads(events: DataFrame, documents_only: bool = False) -> DataFrame:
    """events with content_type and payload: the whole event (a broken one goes), or its document alone (a delete gives its key as text, what has neither goes).

    Rows of normalize(malformed=True) that are no events stay, with their text.
    """
    apart = F.col("malformed").isNotNull() if "malformed" in events.columns else F.lit(False)
    if not documents_only:
        return events.where(apart | ~F.col("broken")).withColumns({"content_type": F.lit("application/json"), "payload": event_json()})
    key = F.when((F.col("operation_type") == "delete") & (F.col("document_key") != ""), F.col("document_key"))
    has = F.col("full_document").isNotNull()
    kept = events.where(apart | has | key.isNotNull())
    return kept.withColumns({"content_type": F.when(has, "application/json").otherwise("text/plain"), "payload": F.when(has, F.col("full_document")).otherwise(key)})


def metadata(described: bool = False, most: int = 0) -> Column:
    """The string map of an event with content_type. described: updated and removed fields too; updated ones of over most bytes (0: any) are left out."""
    fixed = {"Content-Type": "content_type", "operation": "operation_type", "database": "database", "collection": "collection", "namespace": "namespace", "document_key": "document_key"}
    entries = [x for k, c in fixed.items() for x in (F.lit(k), F.col(c))] + [F.lit("cluster_time"), D.rfc3339(F.col("timestamp"))]
    if described:
        updated = D.web_safe(F.col("updated_fields"))
        entries += [F.lit("removed_fields"), F.when(F.col("described"), D.web_safe(F.to_json("removed_fields")))]
        entries += [F.lit("updated_fields"), F.when(F.col("described") & (F.octet_length(updated) <= most if most > 0 else F.lit(True)), updated)]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def messages(events: DataFrame, scheme: str, described: bool = False, most: int = 0) -> DataFrame:
    """id, source, payload (bytes), metadata, timestamp, retry_count (and malformed, if it is there) of events with payload and content_type."""
    more = [c for c in ("malformed",) if c in events.columns]
    source = F.concat(F.lit(scheme + "://"), "database", F.lit("/"), "collection")
    return events.select("id", source.alias("source"), F.encode("payload", "utf-8").alias("payload"), metadata(described, most).alias("metadata"), "timestamp", F.lit(0).alias("retry_count"), *more)
