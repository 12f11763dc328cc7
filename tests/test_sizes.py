"""What a task gets does not grow with the input."""

from pyspark.sql import functions as F

from tidewell.functions import bson, codecs
from tidewell.operators import folds, normalize
from tidewell.plans import raw, registry


def test_entries_of_unknown_keys_are_dealt_by_their_number(spark, monkeypatch):
    """Keys in order compress well, but no task gets more entries for it; null keys are known to nobody."""
    monkeypatch.setattr(folds, "ENTRIES", 500)
    log = spark.range(0, 10_000, 1, 2).selectExpr("case when id % 100 = 7 then null when id % 2 = 0 then id else id - 1 - id % 10 div 9 * 100000 end as k", "id as seq", "case when id % 2 = 0 then 'store' else 'ack' end as op")
    rows = log.collect()
    began = {r.k for r in rows if r.op == "store" and r.k is not None}
    for found, inside in ((folds.known(log, "k", "store"), True), (folds.unknown(log, "k", "store"), False)):
        sizes = found.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
        assert len(sizes) == 20 and max(sizes) < 1_000
        assert sorted(r.seq for r in found.collect()) == sorted(r.seq for r in rows if (r.k in began) == inside)
    assert folds.unknown(log.limit(0), "k", "store").collect() == []


def test_binary_changes_are_converted_once_by_few_workers(spark):
    """Each ArrowEvalPython of a plan is a worker for each task; a filter on what it gives must not convert again."""
    raws = spark.range(9).selectExpr("id as seq", "case when id % 3 = 0 then '{' else concat('{\"_id\":{\"_data\":\"', id, '\"}}') end as raw")
    normal = normalize.normalize_binary(raw.binary(raws))
    assert sorted(r.id for r in normal.collect()) == ["1", "2", "4", "5", "7", "8"]
    messages = normal.select("id", F.lit("s").alias("source"), F.when(F.col("id") == "1", F.lit(b"\x00\x01")).otherwise(bson.to_bson(F.lit('{"a":1}'))).alias("payload"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"), "timestamp", F.lit(0).alias("retry_count"))
    back = codecs.BsonEnvelope().decode(codecs.BsonEnvelope().encode(messages))
    assert {r.id: r.payload for r in back.collect()} == {r.id: r.payload for r in messages.collect()}
    evals = lambda df: df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython ")
    assert evals(registry.QUERIES["raw_binary_normalize"](spark, "/root/testdata/sf0.001")) == 1
    assert evals(registry.QUERIES["envelope_binary_round_trip"](spark, "/root/testdata/sf0.001")) <= 5
