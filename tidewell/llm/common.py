"""What the training-data operators share: tables in the cluster's shared folder, row ids, distributed naming."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with over a HOT_SHARE-th of all rows is hot: join_counted() broadcasts up to so many keys.
HOT_SHARE = 1_000
#: Words of the contracts: runs of anything but blanks and the controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one only where it is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """df written as a table in the shared folder and read again: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidewell_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_tidewell_path", None):
            jvm, sc = t.sparkSession._jvm, t.sparkSession.sparkContext
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """rows joined to groups, which holds each key once, and in n how many of rows have it. rows: a table, as it is read twice.

    Of keys that hold 1 / HOT_SHARE of all rows or more there are HOT_SHARE at most: these are broadcast, and their rows
    stay where they are. All others meet by shuffle, in which no key is hot. how is inner or left; a null key finds nothing.
    """
    groups = materialize(groups, "groups")
    total = groups.agg(F.sum(n)).first()[0] or 0
    hot = F.broadcast(groups.where(F.col(n) * HOT_SHARE >= total))
    cold = groups.where(F.col(n) * HOT_SHARE < total)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))


def rows_of(df: DataFrame, *columns: str) -> DataFrame:
    """The columns asked for, and _rid, a number of each row.

    Rows may repeat and ids may be null, so _rid tells rows apart. It depends on the order of rows in partitions: df
    must be a scan of files (or another plan that gives the same rows in the same order each time).
    """
    return df.select(*columns, F.monotonically_increasing_id().alias("_rid"))


def _brief(key: bytes) -> bytes:
    return key if len(key) <= 32 else hashlib.sha256(key).digest() + b"#"


def dense_names(df: DataFrame, key: str, ties: list[str], keep: list[str], near: str | None = None, tag: str = "names") -> DataFrame:
    """keep and `name`, the dense rank of the binary column key over all rows: equal keys, and only they, share a name.

    Rows are dealt out by ranges of (near or key, ties) and sorted, so a key that a third of the rows hold spreads over
    tasks. Each task numbers its runs of equal keys; one line per task (its first and last key, its number of runs)
    goes to the driver, which chains them to offsets. The lines grow with the tasks, not the rows, and are under 100 bytes:
    a key over 32 bytes is told there by its SHA-256 digest, as all that counts is whether two tasks' border keys are equal.

    near: a hash column of key; it makes the sampled bounds small. If keys with the same hash meet at a border, names
    could split, so that case (two keys of one 64-bit hash) is named again by ranges of the whole key.
    """
    spark = df.sparkSession
    lead = [near] if near else [key]
    cols = list(dict.fromkeys([key, *lead, *ties, *keep]))
    dealt = df.select(*cols).repartitionByRange(*lead, *ties).sortWithinPartitions(*dict.fromkeys([*lead, key, *ties]))
    fields = df.select(*keep).schema
    schema = fields
    for c, kind in (("_local", T.LongType()), ("_part", T.IntegerType()), ("_first", T.BinaryType()), ("_last", T.BinaryType()), ("_n", T.LongType()), ("_mixed", T.BooleanType())):
        schema = schema.add(c, kind)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, first, last, out = TaskContext.get().partitionId(), -1, None, None, None
        heads, last_head, mixed = None, None, False
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(b.schema.get_field_index(key)).cast(pa.binary())
            change = pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), False).to_numpy(zero_copy_only=False).astype("int64")
            head = keys[0].as_py()
            start = n + (head != last or n < 0)
            if near:  # distinct keys of the first and the last hash of the task; two show a collision there
                h = b.column(b.schema.get_field_index(near)).to_numpy()
                if heads is None:
                    heads = h[0]
                same = (h[1:] == h[:-1]) & (change > 0)
                mixed = mixed or bool((same & (h[1:] == heads)).any()) or bool((same & (h[1:] == h[-1])).any()) or (n >= 0 and head != last and last_head == h[0])
                last_head = h[-1]
            local = start + pa.array(change).to_numpy().cumsum() if len(change) else None
            ranks = [start, *local] if local is not None else [start]
            first = head if first is None else first
            last, n = keys[-1].as_py(), int(ranks[-1])
            m = b.num_rows
            out = [b.column(b.schema.get_field_index(f.name)) for f in fields.fields[: len(keep)]]
            nul = lambda t: pa.nulls(m, t)
            yield pa.RecordBatch.from_arrays([*out, pa.array(ranks, pa.int64()), pa.array([part] * m, pa.int32()), nul(pa.binary()), nul(pa.binary()), nul(pa.int64()), nul(pa.bool_())], names=[*keep, "_local", "_part", "_first", "_last", "_n", "_mixed"])
        if out is not None:
            own = [pa.nulls(1, c.type) for c in out]
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(1, pa.int64()), pa.array([part], pa.int32()), pa.array([_brief(first)], pa.binary()), pa.array([_brief(last)], pa.binary()), pa.array([n + 1], pa.int64()), pa.array([mixed])], names=[*keep, "_local", "_part", "_first", "_last", "_n", "_mixed"])

    for f in schema.fields:
        f.nullable = True
    table = materialize(dealt.mapInArrow(number, schema), tag)
    edges = table.where("_n is not null").select("_part", "_first", "_last", "_n", "_mixed").orderBy("_part").collect()
    if near and any(e["_mixed"] for e in edges):
        release(table)
        return dense_names(df, key, ties, keep, None, tag)
    offsets, total, before = [], 0, None
    for e in edges:
        first, last = bytes(e["_first"]), bytes(e["_last"])
        offsets.append((e["_part"], total - (first == before)))
        total, before = offsets[-1][1] + e["_n"], last
    base = spark.createDataFrame(offsets, "_part int, _base bigint")
    named = table.where("_n is null").join(F.broadcast(base), "_part").select(*keep, (F.col("_base") + F.col("_local")).alias("name"))
    named._tidewell_path = table._tidewell_path
    return named
