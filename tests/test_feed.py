"""The change feed: batches, resume, start points, reset, gaps, restarts, acknowledgements; and folds of logs."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell.functions import documents as D
from tidewell.operators import folds, monitor
from tidewell.sources import changefeed
from tidewell.streaming.feed import Ack, AckTable, DeadLetters, Feed, Metrics, Nack, Options, PublishNotSupported, Reject, per_message


def put(folder, name, *keys, db="shop", coll="users", op="insert"):
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps({"_id": {"_data": f"{name}-{k}"}, "operationType": op, "ns": {"db": db, "coll": coll}, "documentKey": {"_id": k}, "fullDocument": {"k": k}}) for k in keys]
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(lines))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


@pytest.fixture
def made(spark, tmp_path):
    def make(**options):
        seen = []
        feed = Feed(spark, Options(path=str(tmp_path / "log"), checkpoint=str(tmp_path / "cp"), **options))
        feed.register("all", lambda batch, n: seen.append((n, sorted(r.id for r in batch.collect()))))
        return feed, seen

    return str(tmp_path / "log"), make


def test_batches_resume_and_reset(made):
    log, make = made
    put(log, "0001", 1, 2)
    feed, seen = make(start_at="earliest")
    feed.run()
    put(log, "0002", 3)
    feed.run()
    feed.run()
    assert seen == [(0, ["0001-1", "0001-2"]), (1, ["0002-3"])]
    put(log, "0003", 4)
    again, seen2 = make(start_at="earliest")  # a new process with the same checkpoint
    again.run()
    assert [ids for _, ids in seen2] == [["0003-4"]]
    again.reset()
    again.run()
    assert [ids for _, ids in seen2[1:]] == [["0001-1", "0001-2", "0002-3", "0003-4"]]
    fresh, seen3 = make(start_at="earliest", resume=False)
    fresh.run()
    assert len(seen3[0][1]) == 4 and fresh.health()["status"] == "healthy"


def test_start_points(made):
    log, make = made
    put(log, "0001", 1)
    put(log, "0002", 2)
    old = datetime(2020, 1, 1).timestamp()
    os.utime(f"{log}/0001", (old, old))
    now, seen = make()
    now.run()
    assert seen == []
    put(log, "0003", 3)
    now.run()
    assert [ids for _, ids in seen] == [["0003-3"]]
    past, seen = make(instance="past", start_at="2021-01-01T00:00:00Z")
    past.run()
    assert [ids for _, ids in seen] == [["0002-2", "0003-3"]]


def test_history_lost(made):
    log, make = made
    for n in (1, 2, 5):
        put(log, f"000{n}", n)
    one, seen = make(start_at="earliest", most_files=1)
    one.start().awaitTermination()
    os.remove(f"{log}/0002")  # never read
    told = []
    strict, seen = make(start_at="earliest", on_history_lost=lambda e: told.append(strict.checkpoint), most_restarts=3)
    strict.metrics = Metrics("x_")
    before = strict.checkpoint
    strict.run(sleep=lambda s: None)
    assert told == [before] and strict.checkpoint != before and seen == [(0, ["0001-1", "0005-5"])]
    assert strict.metrics.counters == {("x_stream_reconnections_total", "*.*:default", "history_lost"): 1, ("x_changes_processed_total", "all", "insert", "shop.users"): 2} and strict.metrics.active == 0
    strict.metrics.close(strict.spark)
    second, seen = make(start_at="earliest")  # a new process does not meet the same loss again
    put(log, "0006", 6)
    second.run()
    assert [ids for _, ids in seen] == [["0006-6"]] and second.restarts == 0


def test_what_was_read_may_go(made):
    log, make = made
    put(log, "0001", 1)
    put(log, "0002", 2)
    feed, seen = make(start_at="earliest")
    feed.run()
    assert changefeed.trim("file://" + log, "0002") == 2 and os.listdir(log) == ["_removed"]
    put(log, "0003", 3)
    feed.run()
    assert [ids for _, ids in seen] == [["0001-1", "0002-2"], ["0003-3"]] and feed.restarts == 0
    put(log, "0004", 4)
    changefeed.trim("file://" + log, "0004")  # this one goes unread
    put(log, "0005", 5)
    told = []
    other, _ = make(start_at="earliest", on_history_lost=told.append)
    other.run()
    assert "0004" in str(told[0]) and len(told) == 1


def test_late_files_are_told(made):
    log, make = made
    put(log, "0002", 2)
    feed, seen = make(start_at="earliest", most_restarts=0)
    feed.run()
    put(log, "0001", 1)
    with pytest.raises(Exception, match="landed behind 0002"):
        feed.run()
    loose, seen = make(start_at="earliest", fail_on_data_loss=False)
    put(log, "0003", 3)
    loose.run()
    assert [ids for _, ids in seen] == [["0003-3"]]


def test_admission_holds_from_the_first_batch_on(made):
    log, make = made
    for n in range(1, 8):
        put(log, f"{n:04d}", n)
    for already in (0, 7):
        feed, seen = make(start_at="earliest", most_files=3)
        feed.run()
        assert [len(ids) for _, ids in seen] == [3, 3, 1]
        for n in range(8, 15):
            put(log, f"{n:04d}", n)
        if already:
            break
        again, seen = make(start_at="earliest", most_files=3)  # a new process
        again.run()
        assert [len(ids) for _, ids in seen] == [3, 3, 1]
        break


def test_folders_before_the_place_are_not_listed(tmp_path):
    for day in ("01", "02", "03"):
        put(str(tmp_path / day), "a", 1)
        put(str(tmp_path / day), "b", 2)
    uri = tmp_path.as_uri()
    assert [x.name for x in changefeed.listed(uri)] == ["01/a", "01/b", "02/a", "02/b", "03/a", "03/b"]
    assert [x.name for x in changefeed.listed(uri, "02/a")] == ["02/a", "02/b", "03/a", "03/b"]
    with pytest.raises(ValueError, match="scheme"):
        changefeed.listed(str(tmp_path))


def test_a_reset_holds_in_other_processes(made):
    log, make = made
    put(log, "0001", 1)
    first, _ = make(start_at="latest")
    first.run()
    put(log, "0002", 2)
    first.reset()  # from now on: 0002 is behind
    put(log, "0003", 3)  # lands while no process runs
    second, seen = make(start_at="latest")
    assert second.checkpoint == first.checkpoint != first._base
    second.run()
    third, seen3 = make(start_at="latest")
    put(log, "0004", 4)
    third.run()
    assert [ids for _, ids in seen + seen3] == [["0003-3"], ["0004-4"]]


def change(folder, name, *changes):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(c if isinstance(c, str) else json.dumps({"_id": {"_data": f"{name}-{i}"}, "ns": {"db": "d", "coll": "c"}, **c}) for i, c in enumerate(changes)))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def test_looked_up_images_over_restarts(made):
    log, make = made
    update = lambda k, fields, removed=(): {"operationType": "update", "documentKey": {"_id": k}, "updateDescription": {"updatedFields": fields, "removedFields": list(removed)}}
    insert = lambda k, d: {"operationType": "insert", "documentKey": {"_id": k}, "fullDocument": d}
    change(log, "1", insert(1, {"a": 1, "b": {"c": 2, "l": [1, 2]}}), update(1, {"a": 5}), update(2, {"x": 1}), insert(3, {"z": 0}))
    change(log, "2", update(1, {"b.c": 7, "b.l.1": 9, "n.m": 1}, ["a"]), {"operationType": "delete", "documentKey": {"_id": 3}}, update(3, {"z": 1}), "no document")
    got = {}

    def take(batch, n):
        got.update({r.id: json.loads(r.p) for r in batch.select("id", F.decode("payload", "utf-8").alias("p")).collect()})

    for _ in range(2):  # a new process for each file
        feed, _ = make(start_at="earliest", full_document="updateLookup", most_files=1)
        feed.register("take", take)
        feed.start().awaitTermination()
    assert got["1-1"]["full_document"] == {"a": 5, "b": {"c": 2, "l": [1, 2]}} and "full_document" not in got["1-2"]
    assert got["2-0"]["full_document"] == {"b": {"c": 7, "l": [1, 9]}, "n": {"m": 1}} and "full_document" not in got["2-2"] and len(got) == 7


def test_outcomes_acks_dead_letters_and_metrics(spark, made, tmp_path):
    log, make = made
    op = lambda k, t: {"operationType": "insert", "documentKey": {"_id": k}, "fullDocument": {"k": k}, "clusterTime": {"$timestamp": {"t": t, "i": 1}}}
    change(log, "1", *(op(k, 1_000 + k) for k in range(8)), "{broken", "5")
    feed, seen = make(start_at="earliest")
    feed.acks, feed.dead_letters = AckTable(str(tmp_path / "acks")), DeadLetters(str(tmp_path / "dead"))
    feed.metrics = Metrics(clock=F.lit(1_003.5).cast("timestamp"))
    order = []

    def traced(label):
        def wrap(name, handler):
            def inner(batch, n):
                order.append((label, name))
                return handler(batch, n)

            return inner

        return wrap

    feed.use(traced("outer"))
    feed.use(traced("inner"))

    def one(message):
        k = json.loads(message["payload"])["full_document"]["k"]
        if k == 1:
            raise Reject("poison")
        if k == 2:
            raise Nack("later")
        if k == 3:
            raise ValueError("surprise")
        if k == 4:
            raise Ack("fine")

    feed.register("each", per_message(one))
    feed.run()
    assert order == [("outer", "each"), ("inner", "each")] and len(seen[0][1]) == 8
    state = {r.event_id: r.acked_at is not None for r in folds.ack_state(feed.acks.log(spark)).collect()}
    assert state == {f"1-{k}": k not in (1, 2, 3) for k in range(8)}
    dead = sorted((r.event_name, r.reason, bytes(r.payload).decode()[:7], r.error) for r in feed.dead_letters.read(spark).collect())
    assert [d[:2] for d in dead] == [("", "malformed"), ("", "malformed"), ("each", "reject")] and dead[2][3] == "poison" and {d[2] for d in dead[:2]} == {"{broken", "5"}
    m = feed.metrics
    assert m.counters["changes_processed_total", "each", "insert", "d.c"] == 5 and m.counters["changes_failed_total", "each", "insert", "d.c"] == 3 and m.counters["changes_processed_total", "all", "insert", "d.c"] == 8
    events = spark.createDataFrame([(3.5 - k,) for k in range(8)], "lag double")
    assert m.lags == {r.bucket: r.n for r in monitor.histogram(events, F.col("lag")).collect()} and m.counters["changes_malformed_total",] == 2
    assert sum(m.durations.values()) == 8 and {n for n, _ in m.durations} == {"each"}
    m.close(spark)


def test_failing_handlers_dont_starve_the_others(made):
    log, make = made
    put(log, "0001", 1)
    errors, runs = [], []
    feed, seen = make(start_at="earliest", on_error=errors.append)

    def failing(name, times):
        def handler(batch, n):
            runs.append(name)
            if runs.count(name) <= times:
                raise RuntimeError(f"{name} broke")

        return handler

    feed.register("a", failing("a", 1))
    feed.register("b", failing("b", 2))
    feed.register("c", failing("c", 0))
    feed.run(sleep=lambda s: None)
    assert "a: a broke; b: b broke" in str(errors[0]) and "b: b broke" in str(errors[1]) and "a broke" not in str(errors[1]).split("===")[0]
    assert len(seen) == 1 and sorted(runs) == ["a", "a", "b", "b", "b", "c"]


def test_watch_levels(made):
    log, make = made
    put(log, "0001", 1)
    put(log, "0002", 2, coll="orders")
    put(log, "0003", 3, db="other")
    for n, options, level in ((3, {}, "cluster"), (2, {"database": "shop"}, "database"), (1, {"database": "shop", "collection": "orders"}, "collection")):
        feed, seen = make(start_at="earliest", **options)
        feed.run()
        assert len(seen[0][1]) == n and feed.options.level == level


def test_failures_restart_after_growing_waits(made):
    log, make = made
    put(log, "0001", 1)
    errors, waits, tries = [], [], []
    feed, _ = make(start_at="earliest", on_error=errors.append, first_wait=1, most_wait=3)

    def handler(batch, n):
        tries.append(n)
        if len(tries) < 5:
            raise RuntimeError("handler failed")

    feed.register("flaky", handler)
    feed.run(sleep=waits.append)
    assert waits == [1, 2, 3, 3] and len(errors) == 4 and tries == [0] * 5 and feed.restarts == 4


def test_pending_is_noted_before_and_acknowledged_after(spark, made, tmp_path):
    log, make = made
    put(log, "0001", 1, 2)
    acks = AckTable(str(tmp_path / "acks"))
    feed, seen = make(start_at="earliest", most_restarts=0)
    feed.acks = acks
    feed.register("bad", lambda batch, n: 1 / 0)
    with pytest.raises(Exception, match="division"):
        feed.run(sleep=lambda s: None)
    state = lambda: folds.ack_state(acks.log(spark))
    assert [(r.event_id, r.acked_at) for r in state().orderBy("event_id").collect()] == [("0001-1", None), ("0001-2", None)]
    feed.unregister("bad")
    feed.run()
    assert state().where("acked_at is null").count() == 0 and len(seen) == 1  # who had the batch does not get it again

    class Broken(AckTable):
        def store(self, ids, batch):
            raise OSError("no store")

    put(log, "0002", 3)
    blocked, seen = make(start_at="earliest", most_restarts=0)
    blocked.acks = Broken("")
    with pytest.raises(Exception, match="no store"):
        blocked.run(sleep=lambda s: None)
    assert seen == []


def test_options_and_subscriptions(spark, made):
    _, make = made
    for wrong in ({"documents_only": True}, {"most_updated_bytes": 5}, {"full_document": "maybe"}, {"collection": "c"}):
        with pytest.raises(ValueError):
            make(**wrong)
    with pytest.raises(ValueError):
        Options(path="", checkpoint="x")
    feed, _ = make(database="d", full_document="whenAvailable", documents_only=True)
    assert feed.options.resume_key == "d.*:default"
    with pytest.raises(ValueError, match="registered"):
        feed.register("all", print)
    with pytest.raises(PublishNotSupported):
        feed.publish("x")
    feed.close()
    feed.close()
    assert feed.health()["status"] == "closed" and feed.handlers == {}
    with pytest.raises(RuntimeError):
        feed.register("late", print)
    with pytest.raises(RuntimeError):
        feed.start()


def test_required_images(made):
    log, make = made
    os.makedirs(log)
    with open(f"{log}/0001", "w") as f:
        f.write('{"_id":{"_data":"a"},"operationType":"update","updateDescription":{"updatedFields":{"x":1}}}')
    feed, _ = make(start_at="earliest", full_document="required", most_restarts=0)
    with pytest.raises(Exception, match="required image"):
        feed.run(sleep=lambda s: None)
    loose, seen = make(start_at="earliest", full_document="whenAvailable", instance="b")
    loose.run()
    assert seen == [(0, ["a"])]


@pytest.mark.parametrize("size", [1 << 30, 1_000_000, 999, 7])
def test_ranges_of_long_files(tmp_path, monkeypatch, size):
    monkeypatch.setattr(changefeed, "BLOCK", 10_000)
    lines = [f'{{"n":{i},"pad":"{"é" * (i % 300)}"}}' for i in range(9000 if size > 10_000 else 60)]
    (tmp_path / "f").write_text("\n".join(lines) + ("\n" if size != 999 else ""))
    reader = changefeed.Reader({"path": tmp_path.as_uri(), "startat": "earliest", "bytespertask": str(size)})
    start = reader.initialOffset()
    parts = reader.partitions(start, reader.latestOffset())
    assert len(parts) == -(-os.path.getsize(tmp_path / "f") // size)
    batches = [b for p in parts for b in reader.read(p)]
    assert [x for b in batches for x in b.column(2).to_pylist()] == lines
    whole = (tmp_path / "f").read_bytes()
    assert all(whole[p:].startswith(x.encode()) for b in batches for p, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
    assert max(b.num_rows for b in batches) <= changefeed.LINES


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def test_leases(spark):
    rows = [("a", 1, "acquire", at(0), "w1"), ("a", 2, "acquire", at(0.5), "w2"), ("a", 3, "acquire", at(2), "w2"), ("a", 4, "complete", at(2.5), "w1"), ("a", 5, "acquire", at(4), "w3"), ("b", 6, "complete", at(0), "w1"), ("b", 7, "acquire", at(1), "w1"), ("b", 8, "release", at(1.1), "w9"), ("b", 9, "acquire", at(1.2), "w2")]
    log = spark.createDataFrame(rows, "message_id string, seq bigint, op string, moment timestamp_ntz, worker string")
    wins = {r.seq: r.won for r in folds.lease_wins(log, timedelta(hours=1), timedelta(days=1)).collect()}
    assert wins == {1: True, 2: False, 3: True, 5: False, 7: True, 9: True}
    held = {r.message_id: (r.status, r.worker_id, r.created_at) for r in folds.lease_state(log, timedelta(hours=1), timedelta(days=1)).collect()}
    assert held == {"a": ("completed", "w2", at(0)), "b": ("processing", "w2", at(1.2))}
    state = folds.lease_state(log, timedelta(hours=1), timedelta(days=1))
    assert folds.reset_stale(state, "2024-01-01 09:00:00", "1 hour").count() == 1
    assert {r.status for r in folds.reset_stale(state, "2024-01-01 09:00:00", "1 hour", keep_rows=True).collect()} == {"completed", "released"}


def test_no_message_is_claimed_twice(spark):
    log = spark.createDataFrame([(i, i, "store", at(i), None, None) for i in range(20)], "id bigint, seq bigint, op string, moment timestamp_ntz, worker string, error string")
    taken = []
    for k in range(5):
        state = folds.outbox_state(log).withColumn("priority", F.lit(0))
        rows = folds.claim(state, 6, f"w{k}", "2024-02-01 00:00:00", 100 + k)
        taken += [r.id for r in rows.collect()]
        log = spark.createDataFrame(log.unionByName(rows).collect(), log.schema)
    assert sorted(taken) == list(range(20)) and {r.claimed_by for r in folds.outbox_state(log).collect()} == {"w0", "w1", "w2", "w3"}


def test_inserts_replacements_and_deletes(spark):
    there = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "id int, v string")
    assert sorted(map(tuple, folds.insert_new(new, there, "id", "v").collect())) == [(3, "y")]
    once = new.where("v <> 'z'")
    assert sorted(map(tuple, folds.replace(once, there, "id").collect())) == [(1, "a"), (2, "x")]
    assert sorted(map(tuple, folds.upsert(once, there, "id").collect())) == [(1, "a"), (2, "x"), (3, "y")]
    assert [r.id for r in folds.missing(once, there, "id").collect()] == [3]
    odd = spark.createDataFrame([(1, None), (1, "gone")], "id int, v string")
    assert folds.delete(odd, F.col("v") == "gone").collect() == [(1, None)]  # a null predicate keeps the row, and only the row deleted goes


def test_worker_pool_completions_need_a_blank_subscription(spark):
    log = spark.createDataFrame(
        [("e", 1, "start", at(0), "s", "n", "worker_pool", None, None, None), ("e", 2, "start", at(1), "t", "n", "worker_pool", None, None, None), ("e", 3, "complete", at(2), "s", None, None, "failed", 5, "x"), ("f", 4, "complete", at(0), "s", None, None, "completed", 1, None), ("f", 5, "start", at(1), "s", "n", "broadcast", None, None, None)],
        "event_id string, seq bigint, op string, moment timestamp_ntz, subscription_id string, event_name string, delivery_mode string, status string, duration_ms bigint, error string",
    )
    got = {r.event_id: (r.subscription_id, r.status, r.started_at) for r in folds.lifecycle_state(log).collect()}
    assert got == {"e": ("", "pending", at(0)), "f": ("s", "pending", at(1))}
    done = log.unionByName(spark.createDataFrame([("e", 9, "complete", at(3), "", None, None, "completed", 7, None)], log.schema))
    assert folds.lifecycle_state(done).where("event_id = 'e'").first().status == "completed"


def test_listings_by_marks_join_to_the_full_order(spark):
    df = spark.createDataFrame([(at(i // 3), f"e{i:02d}") for i in range(25)], "updated_at timestamp_ntz, message_id string")
    mark = {"u": D.rfc3339(F.col("updated_at")), "i": F.col("message_id")}
    for down in (False, True):
        got, cursor = [], None
        while True:
            rows = monitor.listing(df, ["updated_at", "message_id"], 10, mark, cursor, down).collect()
            got += [r.message_id for r in rows]
            assert {r.has_more for r in rows} == {len(got) < 25}
            if not rows[0].has_more:
                break
            found = D.read_cursor(rows[0].next_cursor)
            cursor = [F.lit(found["u"].rstrip("Z")).cast("timestamp_ntz"), F.lit(found["i"])]
        assert got == sorted((f"e{i:02d}" for i in range(25)), reverse=down)
    assert monitor.listing(df.limit(0), ["updated_at"], 5, mark).count() == 0


def test_offsets_and_missing_rows(spark):
    df = spark.range(2000).select("id", F.col("id").alias("created_at"))
    rows = [r.id for r in monitor.offset_page(df, ["created_at", "id"], 5, 5000).collect()]
    assert len(rows) == 1000 and rows[0] == 1994 and monitor.offset_page(df, ["created_at"], 0, 0).count() == 100
    assert monitor.page(df, ["id"], 1500).count() == 1500  # only acknowledgement pages have a bound
    assert monitor.one(df, "id", -1).count() == 0
    with pytest.raises(KeyError):
        monitor.one(df, "id", -1, required=True)
