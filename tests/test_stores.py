"""Stores: commits over several tables, and the relay over an outbox log."""

from datetime import datetime

import pytest

from tidewell.operators import folds
from tidewell.sources.stores import OUTBOX_LOG, Layout, Relay, Stores, time_ordered_id
from tidewell.streaming.feed import Metrics

AT = "2024-01-02 00:00:00"


@pytest.fixture
def stores(spark, tmp_path):
    return Stores(spark, str(tmp_path / "s"), {"orders": Layout("id bigint, day string", ("day",), ("id",)), "outbox_log": Layout(OUTBOX_LOG)})


def message(spark, i, priority=0):
    return spark.createDataFrame([(i, i, "store", datetime(2024, 1, 1), None, None, priority, "e", f"p{i}")], OUTBOX_LOG)


def test_tables_commit_together_or_not_at_all(spark, stores):
    orders = spark.createDataFrame([(2, "b"), (1, "a")], "id bigint, day string")
    assert stores.read("orders").count() == 0
    with pytest.raises(RuntimeError), stores.transaction():
        stores.append("orders", orders)
        stores.append("outbox_log", message(spark, 1))
        raise RuntimeError("business failed")
    assert stores.read("orders").count() == stores.read("outbox_log").count() == 0
    with stores.transaction("t1") as outer:
        stores.append("orders", orders)
        with stores.transaction() as inner:  # part of the outer one
            stores.append("outbox_log", message(spark, 1))
            assert inner == outer and stores.read("orders").count() == 0
    assert stores.read("orders").count() == 2 and stores.read("outbox_log").count() == 1
    assert sorted(map(tuple, stores.read("orders").where("day = 'a'").collect())) == [(1, "a")]
    with stores.transaction("t1"):  # a batch that runs again
        stores.append("orders", orders)
    assert stores.read("orders").count() == 2
    with pytest.raises(ValueError):
        Stores(spark, "")


def test_relay_publishes_in_order_and_retries_failures(spark, stores):
    for i in range(5):
        stores.append("outbox_log", message(spark, i, priority=i % 2))
    sent, broken = [], [True]

    def publish(batch):
        if broken.pop() if broken else False:
            raise OSError("broker away")
        sent.append(sorted(r.payload for r in batch.collect()))

    relay = Relay(stores, "w1", publish, batch=2)
    assert relay.once(AT) == 2 and sent == []
    failed = relay.state().where("status = 'failed'").collect()
    assert [(r.last_error, r.retry_count) for r in failed] == [("broker away", 1)] * 2
    assert relay.drain("2024-01-03 00:00:00") == 5
    assert sent[0] == ["p1", "p3"] and sorted(x for b in sent for x in b) == [f"p{i}" for i in range(5)]
    assert {r.status for r in relay.state().collect()} == {"published"}
    assert folds.unknown(stores.read("outbox_log"), "id", "store").count() == 0


def test_ids_in_the_order_of_time(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, i), f"m{i}") for i in range(20)], "at timestamp, m string")
    ids = [r.x for r in df.select(time_ordered_id("at", "m").alias("x")).collect()]
    assert ids == sorted(ids) and len(set(ids)) == 20 and {len(i) for i in ids} == {24}


def test_observed_lag_is_never_negative(spark):
    from pyspark.sql import Observation

    seen = Observation("changes")
    df = spark.createDataFrame([(datetime(2999, 1, 1),)], "timestamp timestamp_ntz")
    Metrics().observed(df, seen).collect()
    assert seen.get["received"] == 1 and seen.get["receive_lag_seconds"] == 0.0
