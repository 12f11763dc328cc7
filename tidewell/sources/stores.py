"""Durable stores as append-only tables: layout, atomic commits over several tables, and the relay over an outbox log.

A table is a folder of Parquet files, one set per transaction. What a transaction wrote counts once its mark is there, and
the mark of all its tables is one empty file: readers see all of it or nothing. Marks are made by one create of a file, which
fails if the transaction is there already; so a batch that runs again under its own id commits once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import folds

OUTBOX_LOG = "id bigint, seq bigint, op string, moment timestamp_ntz, worker string, error string, priority int, event_name string, payload string"


@dataclass(frozen=True)
class Layout:
    """What takes the place of indexes: folders by a column of few values, and files sorted so that scans skip row groups by range."""

    schema: str
    partition_by: tuple[str, ...] = ()
    sorted_by: tuple[str, ...] = ()


@dataclass
class Stores:
    """Tables under one root that commit together."""

    spark: SparkSession
    root: str
    layouts: dict[str, Layout] = field(default_factory=dict)
    _open: ContextVar = field(default_factory=lambda: ContextVar("transaction", default=None))

    def __post_init__(self) -> None:
        if not self.root:
            raise ValueError("stores need a root folder")

    def _files(self) -> tuple[object, Callable[[str], object]]:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def committed(self) -> list[str]:
        """The ids of transactions that count, in no order."""
        files, path = self._files()
        marks = path(f"{self.root}/_commits")
        return [s.getPath().getName() for s in files.listStatus(marks)] if files.exists(marks) else []

    def read(self, table: str) -> DataFrame:
        """The committed rows; none if there are no files yet."""
        layout, done = self.layouts[table], self.committed()
        files, path = self._files()
        there = [f"{self.root}/{table}/{tx}" for tx in done if files.exists(path(f"{self.root}/{table}/{tx}"))]
        if not there:
            return self.spark.createDataFrame([], layout.schema)
        return self.spark.read.schema(layout.schema).parquet(*there)

    def append(self, table: str, rows: DataFrame) -> None:
        """Rows that count when the transaction around commits; without one around, at once."""
        tx = self._open.get()
        if tx is None:
            with self.transaction():
                self.append(table, rows)
            return
        if tx in self.committed():  # this one has run before
            return
        layout = self.layouts[table]
        columns = self.spark.createDataFrame([], layout.schema).columns
        out = rows.select(*columns)
        if layout.sorted_by:
            out = out.sortWithinPartitions(*layout.partition_by, *layout.sorted_by)
        out.write.mode("append").partitionBy(*layout.partition_by).parquet(f"{self.root}/{table}/{tx}")

    @contextmanager
    def transaction(self, tx: str | None = None) -> Iterator[str]:
        """All appends within count together at its end, or not at all if it fails. One within another is part of it.

        tx names it: if one of that name is committed, or was begun and left, its rows are not written twice.
        """
        if (outer := self._open.get()) is not None:
            yield outer
            return
        tx = tx or uuid.uuid4().hex
        files, path = self._files()
        if tx not in self.committed():
            self._drop(tx)  # what an earlier try left
        token = self._open.set(tx)
        try:
            yield tx
            if tx not in self.committed():
                files.mkdirs(path(f"{self.root}/_commits"))
                files.create(path(f"{self.root}/_commits/{tx}"), False).close()
        except BaseException:
            if tx not in self.committed():
                self._drop(tx)
            raise
        finally:
            self._open.reset(token)

    def _drop(self, tx: str) -> None:
        files, path = self._files()
        for table in self.layouts:
            files.delete(path(f"{self.root}/{table}/{tx}"), True)


def time_ordered_id(clock: str, *seed: str) -> object:
    """Ids that sort by time: 8 hex digits of the second, 16 of a hash of the seed columns."""
    seconds = F.floor(F.unix_micros(F.col(clock).cast("timestamp")) / 1_000_000)
    return F.concat(F.lpad(F.lower(F.hex(seconds.cast("long"))), 8, "0"), F.substring(F.sha2(F.concat_ws("|", *seed), 256), 1, 16))


@dataclass
class Relay:
    """Takes batches of an outbox, hands them to a publisher, and notes what came of it. The only writer of claims in its stores."""

    stores: Stores
    worker: str
    publish: Callable[[DataFrame], None]
    batch: int = 100
    table: str = "outbox_log"

    def state(self) -> DataFrame:
        log = self.stores.read(self.table)
        kept = log.where(folds.op("store")).select("id", "priority", "event_name", "payload")
        return folds.outbox_state(log).join(kept, "id")

    def _note(self, rows: DataFrame) -> None:
        for name, kind in (("priority", "int"), ("event_name", "string"), ("payload", "string")):
            rows = rows.withColumn(name, F.lit(None).cast(kind)) if name not in rows.columns else rows
        self.stores.append(self.table, rows)

    def once(self, at: str) -> int:
        """One batch: claimed, published, then acknowledged or failed as a whole. How many messages it had."""
        log = self.stores.read(self.table)
        seq = (log.agg(F.max("seq")).first()[0] or 0) + 1
        self._note(folds.claim(self.state(), self.batch, self.worker, at, seq))
        mine = self.state().where((F.col("status") == "processing") & (F.col("claimed_by") == self.worker) & (F.col("claimed_at") == F.expr(f"timestamp_ntz '{at}'"))).persist()
        try:
            if n := mine.count():
                try:
                    self.publish(mine)
                    op, error = "ack", None
                except Exception as e:  # noqa: BLE001
                    op, error = "fail", str(e)[:1000]
                done = mine.select("id", F.lit(seq + 1).cast("long").alias("seq"), F.lit(op).alias("op"), F.expr(f"timestamp_ntz '{at}'").alias("moment"), F.lit(None).cast("string").alias("worker"), F.lit(error).cast("string").alias("error"))
                self._note(done)
            return n
        finally:
            mine.unpersist()

    def drain(self, at: str, most: int = 1_000) -> int:
        """Batches until one is empty or has failed messages only; how many were published."""
        published = 0
        for _ in range(most):
            before = self.state().where("status = 'published'").count()
            if not self.once(at) or (now := self.state().where("status = 'published'").count()) == before:
                break
            published += now - before
        return published
