"""Envelope and payload codecs: how messages are laid out as bytes. Any object with encode() and decode() is a codec."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import bson
from tidewell.functions import documents as D
from tidewell.functions.documents import base64_line

ENVELOPE = "id string, source string, payload binary, metadata map<string,string>, timestamp timestamp_ntz, retry_count int"


class Codec(Protocol):
    content_type: str

    def encode(self, df: DataFrame) -> DataFrame: ...
    def decode(self, df: DataFrame) -> DataFrame: ...


class JsonEnvelope:
    """Messages (the columns of ENVELOPE) as one JSON text each, in the column data; bytes of the payload as base64."""

    content_type = "application/json"

    def encode(self, df: DataFrame) -> DataFrame:
        return df.select(F.to_json(F.struct("id", "source", base64_line(F.col("payload")).alias("payload"), "metadata", "timestamp", "retry_count")).alias("data"))

    def decode(self, df: DataFrame) -> DataFrame:
        """Data that is no envelope gives a row with nulls; no time is a null time, no count is 0."""
        read = F.from_json("data", ENVELOPE.replace("payload binary", "payload string"))
        flat = df.select(read.alias("m")).select("m.*")
        return flat.withColumns({"payload": F.unbase64("payload"), "retry_count": F.coalesce("retry_count", F.lit(0))})


class BsonEnvelope:
    """Messages as one binary document each: payload is a document of its own if its bytes are one, else a binary value.

    Times have milliseconds. Metadata without entries and a count of 0 are left out. decode() gives a payload back as the bytes
    that encode() got; data that is no document gives a row with nulls, to be routed by quarantine().
    """

    content_type = "application/bson"

    def encode(self, df: DataFrame) -> DataFrame:
        inner = bson.from_bson(F.col("payload"))
        payload = F.coalesce(inner, F.concat(F.lit('{"$binary":{"base64":"'), base64_line(F.col("payload")), F.lit('","subType":"00"}}')))
        millis = (F.unix_micros(F.col("timestamp").cast("timestamp")) / 1000).cast("long")
        text = lambda name, c: F.concat(F.lit(f'"{name}":'), c)
        parts = [text("id", D.quoted(F.coalesce("id", F.lit("")))), text("source", D.quoted(F.coalesce("source", F.lit("")))), text("payload", payload)]
        parts += [text("metadata", F.when(F.size("metadata") > 0, F.to_json("metadata"))), text("timestamp", F.concat(F.lit('{"$date":{"$numberLong":"'), millis.cast("string"), F.lit('"}}')))]
        parts += [text("retry_count", F.when(F.col("retry_count") != 0, F.col("retry_count").cast("string")))]
        return df.select(bson.to_bson(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))).alias("data"))

    def decode(self, df: DataFrame) -> DataFrame:
        read = df.select(bson.from_bson(F.col("data")).alias("t")).select(F.from_json("t", "id string, source string, payload variant, metadata map<string,string>, timestamp struct<`$date`:struct<`$numberLong`:string>>, retry_count struct<`$numberInt`:string>").alias("m"))
        raw = F.try_variant_get("m.payload", "$['$binary'].base64", "string")
        return read.select(
            "m.id", "m.source", bson.bytes_or_bson(raw, F.to_json("m.payload")).alias("payload"), F.coalesce("m.metadata", F.when(F.col("m.id").isNotNull(), F.create_map().cast("map<string,string>"))).alias("metadata"),
            D.clock_of_millis(F.col("m.timestamp")["$date"]["$numberLong"].cast("long")).alias("timestamp"), F.coalesce(F.col("m.retry_count")["$numberInt"].cast("int"), F.lit(0)).alias("retry_count"))

    @staticmethod
    def quarantine(df: DataFrame) -> DataFrame:
        """Rows whose data is no document."""
        return df.where(bson.from_bson(F.col("data")).isNull())


class JsonPayload:
    """Payloads of a fixed schema as JSON bytes."""

    content_type = "application/json"

    def __init__(self, schema: str):
        self.schema = schema

    def encode(self, value: Column) -> Column:
        return F.encode(F.to_json(value), "utf-8")

    def decode(self, payload: Column) -> Column:
        return F.from_json(F.decode(payload, "utf-8"), self.schema)


class BsonPayload:
    """Payloads of a fixed schema as binary documents; bytes that are none give null."""

    content_type = "application/bson"

    def __init__(self, schema: str):
        self.schema = schema

    def encode(self, value: Column) -> Column:
        return bson.to_bson(F.to_json(value))

    def decode(self, payload: Column) -> Column:
        return F.from_json(D.plain(D.canonical(bson.from_bson(payload))), self.schema)


#: Codecs by content type; register() adds one.
CODECS: dict[str, type] = {}


def register(kind: type) -> type:
    CODECS[kind.content_type] = kind
    return kind


register(JsonPayload)
register(BsonPayload)
