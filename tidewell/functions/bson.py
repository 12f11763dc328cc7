"""Documents in their binary form (BSON): length-prefixed elements of a type byte, a name and a value, little-endian.

to_bson() and from_bson() are Arrow functions over whole columns: binary to canonical extended JSON text and back. Text with a
type that JSON lacks carries its mark ($numberLong, $date, ...); plain JSON numbers become the smallest of int32, int64 and
double that holds them. Bytes that are no document, and text that is none, give null and fail nothing: lengths that don't fit, strings
without their end, unknown types, bytes left over, names with a zero, more than DEEPEST levels.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
import struct
from decimal import Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEEPEST = 100
INT32, INT64 = range(-(1 << 31), 1 << 31), range(-(1 << 63), 1 << 63)
# Exponent bias and most digits of a 128-bit decimal.
BIAS, DIGITS = 6176, 34
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


class Malformed(ValueError):
    """The bytes or the text are no document."""


# ---- binary to extended JSON


def _cstring(data: bytes, at: int, end: int) -> tuple[str, int]:
    stop = data.find(b"\0", at, end)
    if stop < 0:
        raise Malformed("name without end")
    return data[at:stop].decode(), stop + 1


def _string(data: bytes, at: int, end: int) -> tuple[str, int]:
    size = int.from_bytes(data[at : at + 4], "little", signed=True)
    stop = at + 4 + size
    if size < 1 or stop > end or data[stop - 1]:
        raise Malformed("string of a wrong length")
    return data[at + 4 : stop - 1].decode(), stop


def _fixed(data: bytes, at: int, end: int, size: int) -> tuple[bytes, int]:
    if at + size > end:
        raise Malformed("value cut off")
    return data[at : at + size], at + size


def _double(x: float) -> str:
    return "NaN" if x != x else "Infinity" if x == float("inf") else "-Infinity" if x == float("-inf") else repr(x)


def _decimal(raw: bytes) -> str:
    bits = int.from_bytes(raw, "little")
    sign, top = "-" if bits >> 127 else "", bits >> 122 & 31
    if top >= 30:
        return "NaN" if top == 31 else sign + "Infinity"
    wide = top >> 3 == 3  # such coefficients are beyond 34 digits, so they stand for 0
    exponent = (bits >> (111 if wide else 113) & 0x3FFF) - BIAS
    coefficient = 0 if wide else bits & (1 << 113) - 1
    if coefficient >= 10**DIGITS:
        coefficient = 0
    digits = str(coefficient)
    scientific = len(digits) - 1 + exponent
    if exponent > 0 or scientific < -6:
        return f"{sign}{digits[0]}{'.' + digits[1:] if len(digits) > 1 else ''}E{scientific:+d}"
    if not exponent:
        return sign + digits
    padded = digits.zfill(1 - exponent)
    return f"{sign}{padded[:exponent]}.{padded[exponent:]}"


def _value(kind: int, data: bytes, at: int, end: int, level: int) -> tuple[object, int]:
    if kind == 0x01:
        raw, at = _fixed(data, at, end, 8)
        return {"$numberDouble": _double(struct.unpack("<d", raw)[0])}, at
    if kind == 0x02:
        return _string(data, at, end)
    if kind in (0x03, 0x04):
        return _document(data, at, end, level + 1, kind == 0x04)
    if kind == 0x05:
        size, at = _fixed(data, at, end, 5)
        body, at = _fixed(data, at, end, _length(size[:4]))
        if size[4] == 2:  # the old form has its length twice
            if len(body) < 4 or _length(body[:4]) != len(body) - 4:
                raise Malformed("binary of a wrong length")
            body = body[4:]
        return {"$binary": {"base64": base64.b64encode(body).decode(), "subType": f"{size[4]:02x}"}}, at
    if kind == 0x06:
        return {"$undefined": True}, at
    if kind == 0x07:
        raw, at = _fixed(data, at, end, 12)
        return {"$oid": raw.hex()}, at
    if kind == 0x08:
        raw, at = _fixed(data, at, end, 1)
        if raw[0] > 1:
            raise Malformed("boolean of a wrong value")
        return bool(raw[0]), at
    if kind in (0x09, 0x12):
        raw, at = _fixed(data, at, end, 8)
        number = {"$numberLong": str(int.from_bytes(raw, "little", signed=True))}
        return number if kind == 0x12 else {"$date": number}, at
    if kind == 0x0A:
        return None, at
    if kind == 0x0B:
        pattern, at = _cstring(data, at, end)
        options, at = _cstring(data, at, end)
        return {"$regularExpression": {"pattern": pattern, "options": options}}, at
    if kind == 0x0C:
        ref, at = _string(data, at, end)
        raw, at = _fixed(data, at, end, 12)
        return {"$dbPointer": {"$ref": ref, "$id": {"$oid": raw.hex()}}}, at
    if kind in (0x0D, 0x0E):
        text, at = _string(data, at, end)
        return {"$code" if kind == 0x0D else "$symbol": text}, at
    if kind == 0x0F:
        size, _ = _fixed(data, at, end, 4)
        stop = at + _length(size)
        if stop > end:
            raise Malformed("value cut off")
        code, inner = _string(data, at + 4, stop)
        scope, inner = _document(data, inner, stop, level + 1)
        if inner != stop:
            raise Malformed("code of a wrong length")
        return {"$code": code, "$scope": scope}, stop
    if kind == 0x10:
        raw, at = _fixed(data, at, end, 4)
        return {"$numberInt": str(int.from_bytes(raw, "little", signed=True))}, at
    if kind == 0x11:
        raw, at = _fixed(data, at, end, 8)
        i, t = struct.unpack("<II", raw)
        return {"$timestamp": {"t": t, "i": i}}, at
    if kind == 0x13:
        raw, at = _fixed(data, at, end, 16)
        return {"$numberDecimal": _decimal(raw)}, at
    if kind in (0x7F, 0xFF):
        return {"$maxKey" if kind == 0x7F else "$minKey": 1}, at
    raise Malformed(f"unknown type {kind}")


def _length(raw: bytes) -> int:
    size = int.from_bytes(raw, "little", signed=True)
    if size < 0:
        raise Malformed("negative length")
    return size


def _document(data: bytes, at: int, end: int, level: int = 0, listed: bool = False) -> tuple[object, int]:
    if level > DEEPEST:
        raise Malformed("too deep")
    head, start = _fixed(data, at, end, 4)
    stop = at + _length(head)
    if stop < at + 5 or stop > end or data[stop - 1]:
        raise Malformed("document of a wrong length")
    names, values, at = [], [], start
    while at < stop - 1:
        name, after = _cstring(data, at + 1, stop - 1)
        value, at = _value(data[at], data, after, stop - 1, level)
        names.append(name)
        values.append(value)
    if at != stop - 1:
        raise Malformed("bytes left over")
    return (values if listed else dict(zip(names, values, strict=True))), stop


def read(data: bytes) -> dict:
    """The document as Python values with the marks of extended JSON; Malformed if it is none."""
    try:
        found, stop = _document(data, 0, len(data))
    except (UnicodeDecodeError, struct.error, IndexError) as e:
        raise Malformed(str(e)) from e
    if stop != len(data):
        raise Malformed("bytes left over")
    return found


# ---- extended JSON to binary


def _text(value: str) -> bytes:
    raw = value.encode()
    return (len(raw) + 1).to_bytes(4, "little") + raw + b"\0"


def _name(value: str) -> bytes:
    raw = value.encode()
    if b"\0" in raw:
        raise Malformed("zero in a name")
    return raw + b"\0"


def _decimal_bytes(text: str) -> bytes:
    d = Decimal(text)
    sign, digits, exponent = d.as_tuple()
    high = sign << 127
    if d.is_nan():
        bits = 31 << 122
    elif d.is_infinite():
        bits = high | 30 << 122
    else:
        coefficient = int("".join(map(str, digits)))
        while coefficient >= 10**DIGITS and not coefficient % 10 or exponent > 6111 + DIGITS - 1 and not coefficient:
            coefficient, exponent = coefficient // 10, exponent + 1 if coefficient else 6111
        while exponent > 6111 and coefficient * 10 < 10**DIGITS:
            coefficient, exponent = coefficient * 10, exponent - 1
        if coefficient >= 10**DIGITS or not -BIAS <= exponent <= 6111:
            raise Malformed("decimal beyond its range")
        bits = high | exponent + BIAS << 113 | coefficient
    return bits.to_bytes(16, "little")


def _date(value: object) -> bytes:
    if isinstance(value, str):
        at = dt.datetime.fromisoformat(value)
        at = at if at.tzinfo else at.replace(tzinfo=dt.UTC)
        ms = (at - _EPOCH) // dt.timedelta(milliseconds=1)
    else:
        ms = int(value["$numberLong"]) if isinstance(value, dict) else int(value)
    return ms.to_bytes(8, "little", signed=True)


def _marked(x: dict) -> tuple[int, bytes] | None:
    """What a marked object stands for; None if it is a plain one."""
    key = next(iter(x))
    value = x[key]
    if len(x) == 2 and "$code" in x and "$scope" in x:
        body = _text(x["$code"]) + _bytes(x["$scope"])
        return 0x0F, (len(body) + 4).to_bytes(4, "little") + body
    if len(x) != 1 or not key.startswith("$"):
        return None
    if key == "$numberDouble":
        return 0x01, struct.pack("<d", float(value))
    if key == "$numberInt":
        return 0x10, int(value).to_bytes(4, "little", signed=True)
    if key == "$numberLong":
        return 0x12, int(value).to_bytes(8, "little", signed=True)
    if key == "$numberDecimal":
        return 0x13, _decimal_bytes(value)
    if key == "$oid":
        raw = bytes.fromhex(value)
        if len(raw) != 12:
            raise Malformed("object id of a wrong length")
        return 0x07, raw
    if key == "$date":
        return 0x09, _date(value)
    if key == "$timestamp":
        return 0x11, struct.pack("<II", value["i"], value["t"])
    if key == "$binary":
        body, kind = base64.b64decode(value["base64"], validate=True), int(value["subType"], 16)
        body = len(body).to_bytes(4, "little") + body if kind == 2 else body
        return 0x05, len(body).to_bytes(4, "little") + bytes([kind]) + body
    if key == "$regularExpression":
        return 0x0B, _name(value["pattern"]) + _name(value["options"])
    if key == "$dbPointer":
        return 0x0C, _text(value["$ref"]) + bytes.fromhex(value["$id"]["$oid"])
    if key in ("$code", "$symbol"):
        return (0x0D if key == "$code" else 0x0E), _text(value)
    if key in ("$undefined", "$minKey", "$maxKey"):
        return {"$undefined": 0x06, "$minKey": 0xFF, "$maxKey": 0x7F}[key], b""
    return None


def _element(value: object, level: int) -> tuple[int, bytes]:
    if value is None:
        return 0x0A, b""
    if isinstance(value, bool):
        return 0x08, bytes([value])
    if isinstance(value, str):
        return 0x02, _text(value)
    if isinstance(value, int):
        if value in INT32:
            return 0x10, value.to_bytes(4, "little", signed=True)
        return (0x12, value.to_bytes(8, "little", signed=True)) if value in INT64 else (0x01, struct.pack("<d", float(value)))
    if isinstance(value, float):
        return 0x01, struct.pack("<d", value)
    if isinstance(value, list):
        return 0x04, _bytes({str(i): x for i, x in enumerate(value)}, level + 1)
    return (_marked(value) if value else None) or (0x03, _bytes(value, level + 1))


def _bytes(document: dict, level: int = 0) -> bytes:
    if level > DEEPEST:
        raise Malformed("too deep")
    parts = []
    for name, value in document.items():
        kind, body = _element(value, level)
        parts += [bytes([kind]), _name(name), body]
    body = b"".join(parts)
    return (len(body) + 5).to_bytes(4, "little") + body + b"\0"


def write(document: dict) -> bytes:
    """The binary form of a document given as Python values with the marks of extended JSON; Malformed if it can't be one."""
    try:
        return _bytes(document)
    except (ValueError, KeyError, TypeError, AttributeError, OverflowError, struct.error, InvalidOperation) as e:
        raise Malformed(str(e)) from e


# ---- columns


@F.arrow_udf(T.StringType())
def _read_column(data: pa.Array) -> pa.Array:
    out = []
    for x in data.to_pylist():
        try:
            out.append(None if x is None else json.dumps(read(x), ensure_ascii=False, separators=(",", ":")))
        except Malformed:
            out.append(None)
    return pa.array(out, pa.string())


def _written(text: str | None) -> bytes | None:
    try:
        found = None if text is None else json.loads(text)
        return write(found) if isinstance(found, dict) else None
    except (ValueError, RecursionError):
        return None


@F.arrow_udf(T.BinaryType())
def _write_column(text: pa.Array) -> pa.Array:
    return pa.array(map(_written, text.to_pylist()), pa.binary())


@F.arrow_udf(T.BinaryType())
def _write_or_keep_column(text: pa.Array) -> pa.Array:
    texts = text.to_pylist()
    return pa.array((x.encode() if (b := _written(x)) is None and x is not None else b for x in texts), pa.binary())


@F.arrow_udf(T.BinaryType())
def _bytes_or_write_column(coded: pa.Array, text: pa.Array) -> pa.Array:
    out = []
    for c, x in zip(coded.to_pylist(), text.to_pylist(), strict=True):
        try:
            out.append(_written(x) if c is None else base64.b64decode(c))
        except ValueError:
            out.append(None)
    return pa.array(out, pa.binary())


def from_bson(data: Column) -> Column:
    """Canonical extended JSON of binary documents; null where the bytes are none."""
    return _read_column(data)


def to_bson(text: Column, keep: bool = False) -> Column:
    """Binary documents of extended JSON; null where the text is none, or (keep) the text's own bytes."""
    return _write_or_keep_column(text) if keep else _write_column(text)


def bytes_or_bson(coded: Column, text: Column) -> Column:
    """The bytes that coded has in base64; where it is null, the binary document of text. One call, as each makes a worker of its own."""
    return _bytes_or_write_column(coded, text)
