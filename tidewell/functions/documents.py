"""Column functions over documents kept as extended JSON: conversion, keys, typed fields, clocks and cursors.

All are built-in expressions, so they stay inside generated code. A document is canonical after canonical(): keys sorted, no
spare blanks. In canonical text the marks of extended JSON can't be confused with the inside of a string, as quotes are
escaped there.
"""

from __future__ import annotations

import base64
import binascii
import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"
# The code and the texts by which a server says that the point to resume from is gone.
HISTORY_LOST_CODE = 286
HISTORY_LOST_TEXTS = ("ChangeStreamHistoryLost", "resume point may no longer be in the oplog")
NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def utc(ts: Column) -> Column:
    """A timestamp with time zone as the wall clock of UTC, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH))


def rfc3339(clock: Column) -> Column:
    """A UTC wall clock (timestamp_ntz) as RFC 3339, with as many decimals as it needs."""
    return F.concat(F.replace(clock.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def clock_of_millis(ms: Column) -> Column:
    return F.timestamp_add("MICROSECOND", ms.cast("long") * 1000, F.expr(EPOCH))


def canonical(text: Column) -> Column:
    """The same document with sorted keys and no spare blanks; null where it is no JSON."""
    return F.to_json(F.try_parse_json(text))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def plain(document: Column) -> Column:
    """A canonical document with types that plain JSON lacks made plain; null where a number is none that JSON can hold.

    Long, int and double become numbers, a decimal becomes a string, dates and timestamps become RFC 3339 in UTC (the
    ordinal of a timestamp is dropped); object ids and binaries stay marked objects.
    """

    def dates(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(r'\{"\$date":(-?\d+)\}'), 1))
        return F.aggregate(found, text, lambda t, ms: F.replace(t, F.concat(F.lit('{"$date":'), ms, F.lit("}")), F.concat(F.lit('"'), rfc3339(clock_of_millis(ms)), F.lit('"'))))

    def stamps(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(r'(\{"\$timestamp":\{"i":\d+,"t":\d+\}\})'), 1))
        seconds = lambda s: F.substring_index(F.substring_index(s, '"t":', -1), "}", 1).cast("long")
        return F.aggregate(found, text, lambda t, s: F.replace(t, s, F.concat(F.lit('"'), rfc3339(clock_of_millis(seconds(s) * 1000)), F.lit('"'))))

    values = F.regexp_replace(document, r'\{"\$(?:number(?:Long|Int|Double)":"([-+0-9.eE]+)"|(?:numberDecimal|date)":("[^"]*"))\}', "$1$2")
    dated = let(values, lambda t: F.when(t.contains('{"$date":'), dates(t)).otherwise(t))
    stamped = let(dated, lambda t: F.when(t.contains('{"$timestamp":'), stamps(t)).otherwise(t))
    return let(stamped, lambda t: F.when(~t.contains('{"$numberDouble":"'), t))


def beyond_json(document: Column) -> Column:
    """Whether a canonical document has a number that plain JSON can't hold, so that plain() is null."""
    return F.coalesce(document.rlike(r'\{"\$numberDouble":"(?![-+0-9.eE]+"\})'), F.lit(False))


def short_double(x: Column) -> Column:
    """A double in the fewest digits, with an exponent only below 1e-4 and from 1e21 on (3 and not 3.0, 1e+21)."""

    def parts(s: Column) -> Column:
        mantissa = F.substring_index(s, "E", 1)
        whole = F.substring_index(mantissa, ".", 1)
        digits = F.concat(whole, F.when(mantissa.contains("."), F.substring_index(mantissa, ".", -1)).otherwise(""))
        exponent = F.when(s.contains("E"), F.substring_index(s, "E", -1).try_cast("int")).otherwise(0)
        return F.struct(digits.alias("digits"), F.length(whole).alias("whole"), exponent.alias("exponent"))

    def shown(p: Column) -> Column:
        bare = F.ltrim(p["digits"], F.lit("0"))
        point = p["whole"] + p["exponent"] - (F.length(p["digits"]) - F.length(bare))
        return let(F.struct(F.rtrim(bare, F.lit("0")).alias("d"), point.alias("point")), lambda q: laid_out(q["d"], F.length(q["d"]), q["point"]))

    def laid_out(d: Column, n: Column, point: Column) -> Column:
        power = point - 1
        scientific = F.concat(F.substring(d, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(""), F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
        fixed = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), d)).when(point >= n, F.concat(d, F.repeat(F.lit("0"), point - n))).otherwise(F.concat(F.substring(d, F.lit(1), point), F.lit("."), F.substring(d, point + 1, n)))
        return F.when(n == 0, "0").when((power < -4) | (power >= 21), scientific).otherwise(fixed)

    named = F.when(F.isnan(x), "NaN").when(x == float("inf"), "+Inf").when(x == float("-inf"), "-Inf")
    return F.coalesce(named, F.concat(F.when(x < 0, "-").otherwise(""), let(F.abs(x).cast("string"), lambda s: let(parts(s), shown))))


def unquoted(text: Column) -> Column:
    """The string that a JSON string literal stands for."""
    return F.try_variant_get(F.try_parse_json(text), "$", "string")


def quoted(text: Column) -> Column:
    """A string as a JSON string literal."""
    return let(F.to_json(F.array(text)), lambda listed: F.substring(listed, F.lit(2), F.length(listed) - 2))


def web_safe(payload: Column) -> Column:
    """JSON with <, > and & escaped, as they only occur inside strings."""
    for mark, code in (("<", "003c"), (">", "003e"), ("&", "0026")):
        payload = F.replace(payload, F.lit(mark), F.lit("\\u" + code))
    return payload


def document_key(key: Column, converted: Column | None = None) -> Column:
    """The text of an _id given as canonical JSON: hex of object ids and binaries, a string itself, numbers, else JSON; null gives "".

    converted: plain(odd_key(key)), for a caller that has it already.
    """

    def marked(key: Column) -> Column:
        """kind and value of a marked object with one string value, as {"$oid":"..."}."""
        kind = F.substring_index(F.substring(key, F.lit(4), F.length(key)), '"', 1)
        return let(kind, lambda k: F.struct(k.alias("kind"), F.substring(key, F.length(k) + 7, F.length(key) - F.length(k) - 8).alias("value")))

    def of_mark(key: Column, m: Column) -> Column:
        kind, value = m["kind"], m["value"]
        whole = (F.concat(F.lit('{"$'), kind, F.lit('":"'), value, F.lit('"}')) == key) & ~value.contains('"')
        hexed = F.length(F.translate(F.lower(value), "0123456789abcdef", "")) == 0
        return (
            F.when(whole & (kind == "oid") & hexed & (value != ""), F.lower(value)).when(whole & kind.isin("numberLong", "numberInt") & value.try_cast("decimal(38,0)").isNotNull(), value)
            .when(whole & (kind == "numberDouble"), short_double(value.try_cast("double")))
            .when(kind == "binary", F.lower(F.hex(F.unbase64(F.substring_index(F.substring_index(key, '"base64":"', -1), '"', 1)))))
        )

    def text(key: Column) -> Column:
        number = key.try_cast("double")
        decimal = (key.contains(".") | key.contains("e") | key.contains("E")) & number.isNotNull()
        return F.when(key.startswith('"'), unquoted(key)).when(key.startswith('{"$'), let(marked(key), lambda m: of_mark(key, m))).when(decimal, short_double(number))

    other = plain(key) if converted is None else converted
    return F.when(key.isNull() | (key == "null"), "").otherwise(F.coalesce(let(key, text), other, F.when(~odd_key(key), key)))


def odd_key(key: Column) -> Column:
    """Whether a key is an object, array or number mark that document_key() gives as plain JSON."""
    return key.startswith("{") | key.startswith("[")


def field(fields: Column, key: str, kind: str) -> Column:
    """A typed value (string, boolean, long, int, double, float) of the JSON object fields, or null.

    key is one flat name, dots included. Numbers convert to each other, decimals cut toward zero; nothing else converts.
    """
    value = F.try_variant_get(F.try_parse_json(fields), "$[" + json.dumps(key).replace('"', "'") + "]", "variant")
    found = F.schema_of_variant(value)
    if kind == "string":
        return F.when(found == "STRING", F.try_variant_get(value, "$", "string"))
    if kind == "boolean":
        return F.when(found == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    number = F.try_variant_get(value, "$", "double")
    if kind in ("double", "float"):
        return F.when(found.rlike(NUMERIC), number.try_cast(kind))
    return F.when(found.rlike("INT$"), F.try_variant_get(value, "$", "bigint").try_cast(kind)).when(found.rlike(NUMERIC), F.try_variant_get(value, "$", "double").try_cast("bigint").try_cast(kind))


def has_field(fields: Column, key: str) -> Column:
    """Whether the JSON object has the key, be its value null; false without an object."""
    return F.coalesce(F.array_contains(F.json_object_keys(fields), key), F.lit(False))


def has_removed(removed: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(removed, key), F.lit(False))


def update_description(metadata: Column) -> Column:
    """updated_fields (canonical JSON object) and removed_fields of a message's metadata; null if it has neither key.

    What is malformed or of another type counts as absent on its side alone; of removed fields that are no strings, each is "".
    """
    updated, removed = F.try_element_at(metadata, F.lit("updated_fields")), F.try_element_at(metadata, F.lit("removed_fields"))
    fields = F.try_parse_json(updated)
    listed = F.try_parse_json(removed)
    names = F.transform(F.from_json(F.when(F.schema_of_variant(listed).startswith("ARRAY"), removed), "array<variant>"), lambda x: F.coalesce(F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")), F.lit("")))
    found = F.struct(F.when(F.schema_of_variant(fields).startswith("OBJECT"), F.to_json(fields)).alias("updated_fields"), names.alias("removed_fields"))
    return F.when(updated.isNotNull() | removed.isNotNull(), found)


def history_lost(code: Column, text: Column) -> Column:
    """Whether an error says that the resume point is gone: by its code; by its text only without a code."""
    says = F.lit(False)
    for t in HISTORY_LOST_TEXTS:
        says |= text.contains(t)
    return F.when(code.isNotNull(), code == HISTORY_LOST_CODE).otherwise(F.coalesce(says, F.lit(False)))


def worker_id(prefix: str, *seed: Column) -> Column:
    """prefix and a token: random without a seed, else the same for the same seed."""
    token = F.substring(F.sha2(F.concat_ws("|", *seed), 256), 1, 32) if seed else F.uuid()
    return F.concat(F.lit(prefix + "-"), token)


def base64_line(data: Column) -> Column:
    """Base64 without the line breaks that the function puts in."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def cursor(**keys: Column) -> Column:
    """The opaque mark of a row in a listing: base64 of a JSON object of its keys."""
    return base64_line(F.encode(F.to_json(F.struct(*(c.alias(k) for k, c in keys.items()))), "utf-8"))


def read_cursor(mark: str) -> dict:
    """The keys of a mark; none for an empty one. Anything but a mark is a ValueError."""
    if not mark:
        return {}
    try:
        found = json.loads(base64.b64decode(mark, validate=True))
    except (binascii.Error, ValueError) as e:
        raise ValueError(f"invalid cursor: {mark!r}") from e
    if not isinstance(found, dict):
        raise ValueError(f"invalid cursor: {mark!r}")
    return found
