"""Hot keys spread over tasks give the rows of the walk: TTL dedup, dedup with marks, leases."""

import random
from datetime import datetime, timedelta

import pytest

from tidewell.operators import chains, folds, state


def log_of(spark, seed, ops):
    r = random.Random(seed)
    rows, seq = [], 0
    for key, n in (("hot", 120), ("warm", 40), ("one", 1), (None, 15)):
        for _ in range(n):
            seq += 1
            rows.append((key, seq, r.choice(ops), datetime(2024, 1, 1) + timedelta(minutes=r.randrange(0, 40 * n, 5)), f"w{r.randrange(4)}"))
    r.shuffle(rows)
    return spark.createDataFrame(rows, "message_id string, seq bigint, op string, moment timestamp_ntz, worker string")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_keys_give_the_rows_of_the_walk(spark, seed):
    hour, day = timedelta(hours=1), timedelta(hours=5)
    log = log_of(spark, seed, ("acquire", "acquire", "acquire", "complete", "release"))
    assert same(folds.lease_wins(log, hour, day, hot_rows=20), folds.lease_wins(log, hour, day))
    assert same(folds.lease_state(log, hour, day, hot_rows=20), folds.lease_state(log, hour, day))
    marked = log_of(spark, seed, ("check", "check", "check", "mark"))
    assert same(folds.marked_dedup(marked, hour, hot_rows=20), folds.marked_dedup(marked, hour))
    arrived = marked.withColumnRenamed("moment", "arrived_at")
    late = spark.createDataFrame([("hot", 900, "x", None, "w"), ("nulls", 901, "x", None, "w"), ("nulls", 902, "x", None, "w")], arrived.schema)
    every = arrived.unionByName(late)
    assert same(state.ttl_dedup(every, 3_600, hot_rows=1), state.ttl_dedup(every, 3_600))


def test_next_after_within_and_over_slices(spark):
    r = random.Random(3)
    targets = sorted({(r.choice("ab"), r.randrange(1_000), r.randrange(3)) for _ in range(150)})
    asked = sorted({(r.choice("abc"), r.randrange(-5, 1_005), r.randrange(3)) for _ in range(80)})
    frame = lambda rows: spark.createDataFrame([(k, (u, s)) for k, u, s in rows], "key string, at struct<us:bigint,seq:bigint>")
    got = {(x.key, x.at.us, x.at.seq): tuple(x.to) if x.to else None for x in chains.next_after(frame(asked), frame(targets)).collect()}
    assert got == {q: min(((u, s) for k, u, s in targets if k == q[0] and (u, s) > q[1:]), default=None) for q in asked}


def test_no_key_is_hot(spark):
    assert chains.hot_keys(spark.createDataFrame([], "k string"), "k", 1) is None
    assert chains.hot_keys(spark.createDataFrame([("a",)] * 5, "k string"), "k", 6) is None
