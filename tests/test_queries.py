"""Each query of the reference's own operators against its SQL on the smallest tables, and the stated corner cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidewell.operators import changes, monitor, state
from tidewell.plans import registry
from tidewell.sources.adapters import read
from tidewell.streaming import feeds

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def same(row):
    return tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(same, got.select(*names).collect())) == sorted(map(same, want.fetchall()))


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).columns == ["document_key", "id", "operation_type", "value"]


def test_every_oracle_has_a_query_and_every_query_of_the_engine_an_oracle():
    queries, oracles = set(__spark_entry__.queries()), set(__spark_entry__.oracle_sql())
    assert oracles <= queries and {q for q in queries - oracles if not q.startswith("op") and q != "pipeline"} == set()


def test_streams_equal_batches(spark):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(feeds.coalesced(spark, SF)) == rows(registry.QUERIES["coalesce_latest"](spark, SF))
    events = read(spark, SF, "change_events")
    assert feeds.deduplicated(spark, SF).count() == events.select("id").distinct().count()
    assert feeds.fanned_out(spark, SF).count() == 2 * events.count()
    assert rows(feeds.leases(spark, SF)) == rows(registry.QUERIES["lease_wins"](spark, SF))
    daily = events.groupBy(F.date_trunc("day", "ts"), "operation_type").count().select("operation_type", "count")
    assert rows(feeds.windowed_rates(spark, SF).select("operation_type", "n")) == rows(daily)


def test_unknown_kind_has_no_changes_and_no_collections_no_filter(spark):
    events = read(spark, SF, "change_events")
    assert changes.of_event_type(events, "other").count() == 0
    assert changes.of_collections(events, "app", []).count() == events.count()


def test_pages_join_to_the_full_order(spark):
    m, keys, got, cursor = read(spark, SF, "monitor_entries"), ["started_at", "event_id"], [], None
    while rows := monitor.page(m, keys, 37, cursor).select(*keys).collect():
        got += rows
        cursor = [F.lit(rows[-1]["started_at"]).cast("timestamp_ntz"), F.lit(rows[-1]["event_id"])]
    assert got == m.select(*keys).orderBy(*keys).collect()


def test_missing_error_counts_for_both_error_filters(spark):
    df = spark.createDataFrame([("",), (None,), ("boom",)], "error string")
    assert monitor.Filter(has_error=True).apply(df).count() == 2
    assert monitor.Filter(has_error=False).apply(df).count() == 2


def test_null_keys_bypass_the_dedup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), (None, 5)], "k string, seq int")
    assert sorted(r.seq for r in changes.first_delivery(df, "k", "seq").collect()) == [1, 3, 4, 5]


def test_ttl_runs_from_the_last_accepted(spark):
    df = spark.sql("select 'a' message_id, seq, timestamp_ntz '2024-01-01' + make_dt_interval(0, seq) as arrived_at from values (0L), (5L), (10L), (11L), (22L) as t(seq)")
    assert sorted(r.seq for r in state.ttl_dedup(df, 10 * 3600).collect()) == [0, 11, 22]


def test_ttl_of_a_hot_id_is_walked_in_batches(spark):
    df = spark.sql("select if(id % 3 < 2, 'hot', cast(id % 50 as string)) message_id, id as seq, timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, (id * 7919) % 100000) as arrived_at from range(3000) union all select null, -1L, null")
    want, last = [], {}
    for r in sorted(df.collect(), key=lambda r: (r.message_id or "", r.arrived_at, r.seq)):
        if r.message_id not in last or (r.arrived_at - last[r.message_id]).total_seconds() > 600:
            want.append(r.seq)
            last[r.message_id] = r.arrived_at
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = state.ttl_dedup(df, 600)
        assert sorted(r.seq for r in got.collect()) == sorted(want)
        assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()  # no group is held as a whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_summary_is_zero(spark):
    row = monitor.summary(read(spark, SF, "monitor_entries").where("false")).first()
    assert (row.total, row.failed, row.avg_ms, row.error_rate) == (0, 0, 0, 0.0)
