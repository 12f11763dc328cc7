"""Binary documents: round trips, fixed byte strings, malformed bytes, and the codecs over them."""

import datetime as dt
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions import bson, codecs
from tidewell.operators import normalize

EVERY = {
    "i": 1, "l": {"$numberLong": "5"}, "x": 2.5, "list": [1, "é", None, True, {"$oid": "0123456789abcdef01234567"}], "at": {"$date": {"$numberLong": "-1"}}, "dec": {"$numberDecimal": "1.50"},
    "bin": {"$binary": {"base64": "q80=", "subType": "04"}}, "old": {"$binary": {"base64": "q80=", "subType": "02"}}, "ts": {"$timestamp": {"t": 5, "i": 1}}, "none": {}, "big": 1 << 40, "code": {"$code": "x", "$scope": {"y": 1}},
    "js": {"$code": "f"}, "sym": {"$symbol": "s"}, "min": {"$minKey": 1}, "max": {"$maxKey": 1}, "re": {"$regularExpression": {"pattern": "a", "options": "i"}}, "un": {"$undefined": True}, "nan": {"$numberDouble": "NaN"},
    "ref": {"$dbPointer": {"$ref": "a", "$id": {"$oid": "0123456789abcdef01234567"}}}, "not a mark": {"$other": 1}, "deep": {"a": {"b": [[], [{}]]}},
}


def test_fixed_bytes():
    assert bson.write({}) == b"\x05\0\0\0\0"
    assert bson.write({"hello": "world"}) == b"\x16\0\0\0\x02hello\0\x06\0\0\0world\0\0"
    assert bson.write({"BSON": ["awesome", 5.05, 1986]}) == b"1\0\0\0\x04BSON\0&\0\0\0\x020\0\x08\0\0\0awesome\0\x011\x00333333\x14@\x102\0\xc2\x07\0\0\0\0"
    assert bson.read(b"\x0c\0\0\0\x10a\0\xff\xff\xff\xff\0") == {"a": {"$numberInt": "-1"}}


def test_every_type_comes_back():
    data = bson.write(EVERY)
    assert bson.write(bson.read(data)) == data
    assert bson.read(data)["not a mark"] == {"$other": {"$numberInt": "1"}}


@pytest.mark.parametrize("text", ["0", "-0", "0.001", "1.50", "12345678901234567890.1234567890", "NaN", "Infinity", "-Infinity", "1E+3", "9.999999999999999999999999999999999E+6144", "1E-6176", "1E-7", "0E+10"])
def test_decimals_come_back(text):
    assert bson.read(bson.write({"d": {"$numberDecimal": text}})) == {"d": {"$numberDecimal": text}}


@pytest.mark.parametrize("bad", [{"a\0b": 1}, {"a": {"$oid": "12"}}, {"a": {"$numberInt": "x"}}, {"a": {"$numberDecimal": "1E9999"}}, {"a": {"$numberLong": str(1 << 64)}}, {"a": {"$binary": {"base64": "%", "subType": "00"}}}])
def test_what_cant_be_written(bad):
    with pytest.raises(bson.Malformed):
        bson.write(bad)


json_values = st.recursive(st.none() | st.booleans() | st.integers(-(1 << 62), 1 << 62) | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(exclude_categories=["Cs"])), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(st.characters(exclude_characters="\0$", exclude_categories=["Cs"])), x, max_size=3), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(st.characters(exclude_characters="\0$", exclude_categories=["Cs"])), json_values, max_size=4))
def test_any_document_comes_back(document):
    data = bson.write(document)
    assert bson.write(bson.read(data)) == data
    assert json.loads(json.dumps(bson.read(data))) == bson.read(data)


def test_damaged_bytes_are_read_or_malformed_and_nothing_else():
    r, data = random.Random(1), bson.write(EVERY)
    for _ in range(20_000):
        bad = bytearray(data)
        for _ in range(r.randint(1, 4)):
            bad[r.randrange(len(bad))] = r.randrange(256)
        bad = bad[: r.randrange(len(bad))] if r.random() < 0.3 else bad
        try:
            bson.read(bytes(bad))
        except bson.Malformed:
            pass
    for cut in range(len(data)):
        with pytest.raises(bson.Malformed):
            bson.read(data[:cut])
    with pytest.raises(bson.Malformed):
        bson.read(data + b"\0")
    deep = b"\x05\0\0\0\0"
    for _ in range(bson.DEEPEST + 2):
        body = b"\x03a\0" + deep + b"\0"
        deep = (len(body) + 4).to_bytes(4, "little") + body
    with pytest.raises(bson.Malformed):
        bson.read(deep)


def test_columns_and_quarantine(spark):
    good = bson.write({"_id": {"_data": "7"}, "operationType": "insert", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": 5}, "fullDocument": {"n": {"$numberLong": "3"}, "x": {"$numberDouble": "NaN"}}, "clusterTime": {"$timestamp": {"t": 60, "i": 1}}})
    rows = spark.createDataFrame([(1, good), (2, good[:-1]), (3, b""), (4, None), (5, bson.write({}))], "n int, raw binary")
    assert {r.n for r in normalize.quarantine_binary(rows).collect()} == {2, 3, 4}
    events = {r.id: r for r in normalize.normalize_binary(rows, "x", "y").collect()}
    assert len(events) == 2 and events["7"].document_key == "5" and events["7"].full_document is None and events["7"].timestamp == dt.datetime(1970, 1, 1, 0, 1)
    texts = spark.createDataFrame([("[1]",), ("{",), ("5",), (None,), ('{"a":1}',)], "t string")
    assert [r.b for r in texts.select(bson.to_bson(F.col("t")).alias("b")).collect()] == [None, None, None, None, bytearray(bson.write({"a": 1}))]


def test_binary_envelope(spark):
    inner = bson.write({"a": {"$date": {"$numberLong": "1"}}})
    rows = [("i", "s", inner, {"k": "v"}, dt.datetime(2024, 1, 1, 0, 0, 0, 250_000), 2), ("j", "", b"no document", {}, dt.datetime(1960, 1, 1), 0)]
    m = spark.createDataFrame(rows, codecs.ENVELOPE)
    codec = codecs.BsonEnvelope()
    encoded = codec.encode(m)
    first = next(x for x in map(bson.read, (bytes(r.data) for r in encoded.collect())) if x["id"] == "i")
    assert list(first) == ["id", "source", "payload", "metadata", "timestamp", "retry_count"] and first["payload"] == {"a": {"$date": {"$numberLong": "1"}}}
    assert sorted((r.id, r.source, bytes(r.payload), r.metadata, r.timestamp, r.retry_count) for r in codec.decode(encoded).collect()) == rows
    broken = spark.createDataFrame([(b"xx",)], "data binary")
    assert codec.quarantine(broken).count() == 1 and codec.quarantine(encoded).count() == 0
    assert tuple(codec.decode(broken).collect()[0])[:3] == (None, None, None)
    assert codecs.CODECS["application/bson"] is codecs.BsonPayload
