"""Queries over raw change documents, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import bson
from tidewell.functions import documents as D
from tidewell.functions.codecs import BsonEnvelope, BsonPayload, JsonEnvelope, JsonPayload
from tidewell.operators import normalize as N
from tidewell.plans.registry import query

DB, COLL = "fallback", "things"
# Parts of the expected rows, as SQL over the helper columns of the adapter.
GOOD = "seq % 23 <> 0"
ID = "case when token = '' then substr(sha256(raw), 1, 32) else token end"
NS_DB, NS_COLL = f"case when seq % 19 = 0 then '{DB}' else 'shop' end", f"case when seq % 19 = 0 then '{COLL}' else coll end"
KEY = "case user_id % 5 when 0 then hex24 when 1 then 'k-' || user_id when 2 then cast(user_id as varchar) when 3 then 'abcd' else user_id || '.5' end"
AT = "strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S') || case seq % 3 when 0 then '' when 1 then '.25' else '.5' end || 'Z'"
FULL = f"""case when op in ('insert', 'replace') and seq % 29 <> 0 then '{{"at":"' || {AT} || '","n":' || k || ',"name":"n' || user_id || '","tags":["a<b",{{"$oid":"0123456789abcdef01234567"}}],"total":"1.50","x":2.5}}' end"""
FIELDS = """case when op = 'update' then case when k % 10 = 0 then '{}' else '{"k":' || k || '}' end end"""
CLOCK = "strftime(clock, '%Y-%m-%dT%H:%M:%SZ')"
EMPTY = "(op = 'update' and k % 10 = 0 and seq % 6 <> 0)"
EVENT = f"""'{{"id":"' || {ID} || '","operation_type":"' || op || '","database":"' || {NS_DB} || '","collection":"' || {NS_COLL} || '","document_key":"' || {KEY} || '"' || coalesce(',"full_document":' || replace({FULL}, '<', '\\u003c'), '')
|| case when op = 'update' then ',"update_description":{{' || concat_ws(',', case when k % 10 <> 0 then '"updated_fields":{{"k":' || k || '}}' end, case when seq % 6 = 0 then '"removed_fields":["old"]' end, case when seq % 5 = 0 then '"truncated_arrays":["list"]' end) || '}}' else '' end
|| ',"timestamp":"' || {CLOCK} || '","namespace":"' || {NS_DB} || '.' || {NS_COLL} || '"}}'"""


def events(r: DataFrame) -> DataFrame:
    return N.normalize(r, DB, COLL)


@query("raw_changes", f"""select {ID} as id, op as operation_type, {NS_DB} as database, {NS_COLL} as collection, {NS_DB} || '.' || {NS_COLL} as namespace, {KEY} as document_key, {FULL} as full_document, op = 'update' as described,
{FIELDS} as updated_fields, case when op = 'update' then case when seq % 6 = 0 then 'old' else '' end end as removed, case when op = 'update' and seq % 5 = 0 then 'list' end as truncated, clock as timestamp from raw_changes where {GOOD}""")
def raw_normalize(r: DataFrame) -> DataFrame:
    joined = {"removed": F.array_join("removed_fields", ","), "truncated": F.array_join("truncated_arrays", ",")}
    return events(r).withColumns(joined).drop("removed_fields", "truncated_arrays", "broken")


@query("raw_changes", "select seq, raw from raw_changes where seq % 23 = 0")
def raw_quarantine(r: DataFrame) -> DataFrame:
    return N.quarantine(r).select("seq", "raw")


@query("raw_changes", f"select {ID} as id, op as operation_type from raw_changes where {GOOD} and not {EMPTY}")
def raw_without_empty_updates(r: DataFrame) -> DataFrame:
    return events(r).where(~N.is_empty_update()).select("id", "operation_type")


@query("raw_changes", f"select {ID} as id, 'application/json' as content_type, {EVENT} as payload from raw_changes where {GOOD}")
def raw_payload_event(r: DataFrame) -> DataFrame:
    return N.payloads(events(r)).select("id", "content_type", "payload")


@query("raw_changes", f"""select {ID} as id, case when op = 'delete' then 'text/plain' else 'application/json' end as content_type, case when op = 'delete' then {KEY} else {FULL} end as payload
from raw_changes where {GOOD} and (op = 'delete' or {FULL} is not null)""")
def raw_payload_document(r: DataFrame) -> DataFrame:
    return N.payloads(events(r), documents_only=True).select("id", "content_type", "payload")


_META = ["Content-Type", "operation", "database", "collection", "namespace", "document_key", "cluster_time", "updated_fields", "removed_fields"]
_META_SQL = f"""select {ID} as id, 'application/json' as content_type, op as operation, {NS_DB} as database, {NS_COLL} as collection, {NS_DB} || '.' || {NS_COLL} as namespace, {KEY} as document_key, {CLOCK} as cluster_time,
case when strlen({FIELDS}) <= 7 then {FIELDS} end as updated_fields, case when op = 'update' then case when seq % 6 = 0 then '["old"]' else '[]' end end as removed_fields from raw_changes where {GOOD}"""


@query("raw_changes", _META_SQL)
def raw_metadata(r: DataFrame) -> DataFrame:
    m = N.payloads(events(r)).select("id", N.metadata(described=True, most=7).alias("m"))
    return m.select("id", *(F.try_element_at("m", F.lit(k)).alias(k.replace("-", "_").lower()) for k in _META))


@query("raw_changes", f"""select {ID} as id, 'cdc://' || {NS_DB} || '/' || {NS_COLL} as source, {EVENT} as payload, op as operation, case when op = 'update' then 9 else 7 end as entries, clock as timestamp, 0 as retry_count from raw_changes where {GOOD}""")
def message_round_trip(r: DataFrame) -> DataFrame:
    """Messages encoded as envelopes and decoded again."""
    codec = JsonEnvelope()
    out = codec.decode(codec.encode(N.messages(N.payloads(events(r)), "cdc", described=True)))
    return out.select("id", "source", F.decode("payload", "utf-8").alias("payload"), F.element_at("metadata", "operation").alias("operation"), F.size("metadata").alias("entries"), "timestamp", "retry_count")


@query("raw_changes", f"select {ID} as id, cast(k as bigint) as n, 'n' || user_id as name from raw_changes where {GOOD} and {FULL} is not null")
def payload_round_trip(r: DataFrame) -> DataFrame:
    """Documents encoded by a payload codec and decoded to its schema."""
    codec = JsonPayload("n bigint, name string")
    docs = events(r).where("full_document is not null")
    encoded = docs.select("id", codec.encode(F.from_json("full_document", codec.schema)).alias("payload"))
    return encoded.select("id", codec.decode(F.col("payload")).alias("d")).select("id", "d.n", "d.name")


@query("raw_changes", f"select {ID} as id, k % 10 <> 0 as has_k, seq % 6 = 0 as removed_old, case when k % 10 <> 0 then k end as k, case when k % 10 <> 0 then cast(k as double) end as k_double, cast(null as varchar) as k_text from raw_changes where {GOOD} and op = 'update'")
def raw_fields(r: DataFrame) -> DataFrame:
    """Typed reads of updated fields: numbers convert, a number is no string."""
    e, fields = events(r).where("described"), F.col("updated_fields")
    return e.select("id", D.has_field(fields, "k").alias("has_k"), D.has_removed(F.col("removed_fields"), "old").alias("removed_old"), D.field(fields, "k", "long").alias("k"), D.field(fields, "k", "double").alias("k_double"), D.field(fields, "k", "string").alias("k_text"))


@query("raw_changes", f"""select {ID} as id, case when k % 10 <> 0 then '{{"k":' || k || '}}' else '{{}}' end as updated_fields, case when seq % 6 = 0 then 1 else 0 end as n_removed from raw_changes where {GOOD} and op = 'update'""")
def update_description_of_metadata(r: DataFrame) -> DataFrame:
    m = N.payloads(events(r)).select("id", D.update_description(N.metadata(described=True)).alias("u")).where("u is not null")
    return m.select("id", "u.updated_fields", F.size("u.removed_fields").alias("n_removed"))


@query("raw_changes", f"select {ID} as id, {NS_DB} as database from raw_changes where {GOOD} and {NS_DB} = 'shop'")
def watch_database(r: DataFrame) -> DataFrame:
    return events(r).where("database = 'shop'").select("id", "database")


@query("raw_changes", f"select {NS_DB} || '.' || {NS_COLL} as namespace, count(*) as n from raw_changes where {GOOD} group by all")
def watch_cluster(r: DataFrame) -> DataFrame:
    """Changes of all databases, by namespace."""
    return events(r).groupBy("namespace").agg(F.count(F.lit(1)).alias("n"))


@query("raw_changes", f"select {ID} as id from raw_changes where {GOOD} and op = 'insert' and user_id % 5 = 1")
def pipeline_filter(r: DataFrame) -> DataFrame:
    """A filter of the caller's own, ahead of payloads: any function of a DataFrame."""
    return events(r).transform(lambda e: e.where((F.col("operation_type") == "insert") & F.col("document_key").startswith("k-"))).select("id")


@query("raw_changes", """select seq, case when seq % 4 = 0 then true when seq % 4 = 1 then false else seq % 4 = 2 end as lost from raw_changes""")
def history_lost(r: DataFrame) -> DataFrame:
    """Errors by code, by another code with the text, by the text alone, and by neither."""
    case = F.col("seq") % 4
    code = F.when(case == 0, D.HISTORY_LOST_CODE).when(case == 1, 11)
    text = F.when(case.isin(1, 2), F.concat(F.lit("stream failed: "), F.lit(D.HISTORY_LOST_TEXTS[1]))).otherwise("timeout")
    return r.select("seq", D.history_lost(code, text).alias("lost"))


@query("raw_changes", "select seq, 'relay-' || substr(sha256(cast(seq as varchar)), 1, 32) as worker_id from raw_changes")
def worker_ids(r: DataFrame) -> DataFrame:
    return r.select("seq", D.worker_id("relay", F.col("seq").cast("string")).alias("worker_id"))


# ---- the same changes in their binary form; of texts that are no document the bytes are taken as they are


def binary(r: DataFrame) -> DataFrame:
    return r.withColumn("raw", bson.to_bson(F.col("raw"), keep=True))


TOKEN = "case when token = '' then 'made' else token end"


@query("raw_changes", f"""select {TOKEN} as id, op as operation_type, {NS_DB} as database, {NS_COLL} as collection, {NS_DB} || '.' || {NS_COLL} as namespace, {KEY} as document_key, {FULL} as full_document, op = 'update' as described,
{FIELDS} as updated_fields, case when op = 'update' then case when seq % 6 = 0 then 'old' else '' end end as removed, case when op = 'update' and seq % 5 = 0 then 'list' end as truncated, clock as timestamp from raw_changes where {GOOD}""")
def raw_binary_normalize(r: DataFrame) -> DataFrame:
    """As raw_normalize; ids made of the bytes are told by their length."""
    joined = {"removed": F.array_join("removed_fields", ","), "truncated": F.array_join("truncated_arrays", ","), "id": F.when(F.length("id") == 32, "made").otherwise(F.col("id"))}
    return N.normalize_binary(binary(r), DB, COLL).withColumns(joined).drop("removed_fields", "truncated_arrays", "broken")


@query("raw_changes", "select seq, cast(strlen(raw) as bigint) as bytes from raw_changes where seq % 23 = 0")
def raw_binary_quarantine(r: DataFrame) -> DataFrame:
    """Bytes that are no document, whole: none is lost."""
    return N.quarantine_binary(binary(r.select("seq", "raw"))).select("seq", F.octet_length("raw").cast("long").alias("bytes"))


@query("raw_changes", f"""select {TOKEN} as id, 'cdc://' || {NS_DB} || '/' || {NS_COLL} as source, op as operation, {FULL} as payload, case when op = 'update' then 9 else 7 end as entries, clock as timestamp, cast(0 as integer) as retry_count
from raw_changes where {GOOD} and {FULL} is not null""")
def envelope_binary_round_trip(r: DataFrame) -> DataFrame:
    """Messages whose payload is a binary document, in binary envelopes and back."""
    e = N.payloads(N.normalize_binary(binary(r), DB, COLL), documents_only=True).where("content_type = 'application/json'")
    m = N.messages(e, "cdc", described=True).withColumn("payload", bson.to_bson(F.decode("payload", "utf-8")))
    codec = BsonEnvelope()
    out = codec.decode(codec.encode(m))
    text = D.plain(D.canonical(bson.from_bson(F.col("payload"))))
    return out.select(F.when(F.length("id") == 32, "made").otherwise(F.col("id")).alias("id"), "source", F.element_at("metadata", "operation").alias("operation"), text.alias("payload"), F.size("metadata").alias("entries"), "timestamp", "retry_count")


@query("raw_changes", f"select {ID} as id, cast(k as bigint) as n, 'n' || user_id as name, cast(2.5 as double) as x from raw_changes where {GOOD} and {FULL} is not null")
def payload_binary_round_trip(r: DataFrame) -> DataFrame:
    """Documents encoded by the binary payload codec and decoded to its schema."""
    codec = BsonPayload("n bigint, name string, x double")
    docs = events(r).where("full_document is not null")
    encoded = docs.select("id", codec.encode(F.from_json("full_document", codec.schema)).alias("payload"))
    return encoded.select("id", codec.decode(F.col("payload")).alias("d")).select("id", "d.n", "d.name", "d.x")
