"""Column functions over documents, normalisation and codecs: the stated cases one by one."""

import pytest
from pyspark.sql import functions as F

from tidewell.functions import documents as D
from tidewell.functions.codecs import CODECS, JsonEnvelope, JsonPayload
from tidewell.operators import normalize as N


def apply(spark, values, f, kind="string"):
    """f over a column of values, in their order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_document_keys(spark):
    cases = {
        None: "", "null": "", '{"$oid":"507F1F77bcf86cd799439011"}': "507f1f77bcf86cd799439011", '"my-id"': "my-id", '"a\\"b"': 'a"b', "42": "42", '{"$numberInt":"100"}': "100", '{"$numberLong":"999"}': "999",
        "3.14": "3.14", '{"$numberDouble":"3.0"}': "3", '{"$binary":{"base64":"q80=","subType":"04"}}': "abcd", "true": "true", '{"a":{"$numberLong":"1"}}': '{"a":1}',
    }
    assert apply(spark, list(cases), D.document_key) == list(cases.values())


def test_doubles_in_few_digits(spark):
    cases = {3.0: "3", 0.5: "0.5", -2.25: "-2.25", 1e20: "100000000000000000000", 1e21: "1e+21", -1.5e300: "-1.5e+300", 1e-4: "0.0001", 1.25e-5: "1.25e-05", 0.0: "0", 123456.789: "123456.789", float("inf"): "+Inf"}
    assert apply(spark, list(cases), D.short_double, "double") == list(cases.values())
    assert apply(spark, [float("nan"), None], D.short_double, "double") == ["NaN", None]


def test_plain_documents(spark):
    cases = {
        '{"b":1,"a":{"$numberDecimal":"1.50"}}': '{"a":"1.50","b":1}',
        '{"t":{"$date":{"$numberLong":"1704067200120"}},"u":[{"$date":{"$numberLong":"0"}}]}': '{"t":"2024-01-01T00:00:00.12Z","u":["1970-01-01T00:00:00Z"]}',
        '{"t":{"$timestamp":{"t":1704067200,"i":7}}}': '{"t":"2024-01-01T00:00:00Z"}', '{"t":{"$date":"2024-01-01T00:00:00Z"}}': '{"t":"2024-01-01T00:00:00Z"}',
        '{"s":"{\\"$date\\":5}"}': '{"s":"{\\"$date\\":5}"}', '{"o":{"$oid":"0123456789abcdef01234567"}}': '{"o":{"$oid":"0123456789abcdef01234567"}}',
        '{"x":{"$numberDouble":"NaN"}}': None, '{"x":{"$numberDouble":"-2.5e3"}}': '{"x":-2.5e3}', "{broken": None, None: None,
    }
    assert apply(spark, list(cases), lambda x: D.plain(D.canonical(x))) == list(cases.values())


def test_clocks_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.range(1).select(D.rfc3339(D.utc(F.timestamp_micros(F.lit(1_704_067_200_500_000)))).alias("a"), D.rfc3339(D.clock_of_millis(F.lit(1_710_054_000_000))).alias("b")).first()
        assert (row.a, row.b) == ("2024-01-01T00:00:00.5Z", "2024-03-10T07:00:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(("text", "kind", "want"), [("7", "long", 7), ("7.9", "long", 7), ("-7.9", "int", -7), ("7", "double", 7.0), ('"7"', "long", None), ("true", "long", None), ("true", "boolean", True), ("1", "boolean", None), ('"x"', "string", "x"), ("7", "string", None), ("null", "long", None), ("9007199254740993", "long", 9007199254740993)])
def test_typed_fields(spark, text, kind, want):
    assert apply(spark, [f'{{"a.b":{text},"c":1}}'], lambda x: D.field(x, "a.b", kind)) == [want]
    assert apply(spark, [f'{{"a":{{"b":{text}}}}}', None], lambda x: D.field(x, "a.b", kind)) == [None, None]


def test_field_presence(spark):
    assert apply(spark, ['{"k":null}', "{}", None, "[1]"], lambda x: D.has_field(x, "k")) == [True, False, False, False]
    assert apply(spark, [["a"], [], None], lambda x: D.has_removed(x, "a"), "array<string>") == [True, False, False]


def test_update_descriptions_of_metadata(spark):
    cases = [
        ({}, None), ({"operation": "update"}, None), ({"updated_fields": '{"b":1,"a":2}'}, ('{"a":2,"b":1}', None)), ({"updated_fields": "{bad", "removed_fields": '["x"]'}, (None, ["x"])),
        ({"updated_fields": "[1]", "removed_fields": '{"x":1}'}, (None, None)), ({"updated_fields": "", "removed_fields": ""}, (None, None)), ({"removed_fields": '["x",1]'}, (None, ["x", ""])), (None, None),
    ]
    got = apply(spark, [m for m, _ in cases], D.update_description, "map<string,string>")
    assert [tuple(g) if g else None for g in got] == [w for _, w in cases]


def test_history_lost(spark):
    df = spark.createDataFrame([(286, "x"), (11, "ChangeStreamHistoryLost"), (None, "ChangeStreamHistoryLost"), (None, "a resume point may no longer be in the oplog"), (None, "timeout"), (None, None)], "code int, text string")
    assert [r[0] for r in df.select(D.history_lost(F.col("code"), F.col("text"))).collect()] == [True, False, True, True, False, False]


def test_cursors(spark):
    mark = spark.range(1).select(D.cursor(s=F.lit("2024-01-01T00:00:00Z"), e=F.lit("x" * 100))).first()[0]
    assert D.read_cursor(mark) == {"s": "2024-01-01T00:00:00Z", "e": "x" * 100} and D.read_cursor("") == {}
    for bad in ("%%%", "bnVsbA==", "W10=", "eyJ1Ijo=", "e30"):
        with pytest.raises(ValueError, match="invalid cursor"):
            D.read_cursor(bad)


def test_worker_ids(spark):
    a = spark.range(2).select(D.worker_id("w", F.col("id").cast("string")).alias("a"), D.worker_id("w").alias("b")).collect()
    assert a[0].a != a[1].a and a[0].b != a[1].b and all(len(r.a) == 34 for r in a)


RAWS = [
    '{"_id":{"_data":"t1"},"operationType":"update","ns":{"db":"d","coll":"c"},"documentKey":{"_id":1},"updateDescription":{"updatedFields":{},"removedFields":[],"truncatedArrays":[{"field":"l","newSize":2}]},"clusterTime":{"$timestamp":{"t":5,"i":1}}}',
    '{"_id":{"_data":"t2"},"operationType":"update","ns":{"db":"d","coll":"c"},"documentKey":{"_id":2},"updateDescription":{"updatedFields":{"x":{"$numberDouble":"NaN"}},"removedFields":["y"]}}',
    '{"operationType":"delete","documentKey":{"_id":"k"}}', "{bad", None, "[]", "5",
    '{"_id":{"_data":"t3"},"operationType":"update","ns":{"db":"d","coll":"c"},"documentKey":{"_id":3}}',
]


def test_normalisation_of_odd_documents(spark):
    df = spark.createDataFrame([(r,) for r in RAWS], "raw string")
    events = N.normalize(df, "own", "col")
    got = {r.document_key: r for r in events.collect()}
    assert set(got) == {"1", "2", "k", "3"} and N.quarantine(df).count() == 4
    assert len(got["k"].id) == 32 and (got["k"].namespace, got["k"].timestamp.year) == ("own.col", 1970)
    assert got["k"].id == events.where("document_key = 'k'").first().id  # made of the text: the same each time
    assert {r.document_key for r in events.where(~N.is_empty_update()).collect()} == {"2", "k"}
    assert got["2"].broken and got["2"].updated_fields is None
    whole = {r.document_key for r in N.payloads(events).collect()}
    alone = {r.document_key: r.payload for r in N.payloads(events, documents_only=True).collect()}
    assert whole == {"1", "k", "3"} and alone == {"k": "k"}
    meta = {r.document_key: r.m for r in events.withColumn("content_type", F.lit("x")).select("document_key", N.metadata(True).alias("m")).collect()}
    assert "updated_fields" not in meta["2"] and meta["2"]["removed_fields"] == '["y"]' and "removed_fields" not in meta["3"]


def test_envelopes_of_odd_data(spark):
    codec = JsonEnvelope()
    rows = codec.decode(spark.createDataFrame([('{"id":"a","payload":"AAE="}',), ("{bad",), (None,)], "data string")).collect()
    assert (rows[0].id, bytes(rows[0].payload), rows[0].retry_count) == ("a", b"\0\1", 0) and rows[1].id is None and rows[2].id is None
    assert CODECS["application/json"] is JsonPayload
