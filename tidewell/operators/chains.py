"""Chains along a key's entries without one task for the key: each entry's successor by slices of time, then pointer doubling.

An entry is at (us, seq), microseconds and number. next_after() finds the first target behind a point: within the point's slice
by a window over (key, slice), else from the first targets of later slices, of which a key has one for each slice. reached()
follows successor links from the heads: in each round what is reached grows by what the links lead to, and links double.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.sources.shared import folder

SLICES, HOT_ROWS, MOST_HOT = 64, 100_000, 1_000
LAST = (1 << 63) - 1


def table(df: DataFrame) -> DataFrame:
    """df written in the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{folder(df.sparkSession)}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def point(us: Column, seq: Column) -> Column:
    return F.struct(us.alias("us"), seq.cast("long").alias("seq"))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with hot_rows or more, and a MOST_HOT-th of all rows, so that there are MOST_HOT at most; None if there is none."""
    counts = table(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.col("n") >= hot_rows) & (F.col("n") * MOST_HOT >= total)).select(key)
    return found if found.limit(1).count() else None


def split(df: DataFrame, key: str, moment: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that one task may walk, and those of hot keys as a table of key, at, row (None if there are none). A time that is null is the last."""
    hot = hot_keys(df, key, hot_rows)
    if hot is None:
        return df, None
    same = df[key].eqNullSafe(hot[key])
    own = df.join(F.broadcast(hot), same, "left_semi")
    named = F.when(F.col(key).isNull(), "n").otherwise(F.concat(F.lit("k"), F.col(key).cast("string"))).alias("key")
    at = point(F.coalesce(F.unix_micros(F.col(moment).cast("timestamp")), F.lit(LAST)), F.col("seq")).alias("at")
    return df.join(F.broadcast(hot), same, "left_anti"), table(own.select(named, at, F.struct("*").alias("row")))


def after(ttl_micros: Column) -> Column:
    """The point behind which an entry has run out: later than its time and ttl_micros."""
    return point(F.col("at.us") + ttl_micros, F.lit(LAST))


def next_after(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """queries (key, at, and more columns) with to, the first target (key, at) of the key behind at; null if there is none.

    Keys must be few (hot_keys()): a line for each key and slice is broadcast.
    """
    cuts = targets.agg(F.percentile_approx(F.col("at.us"), [i / SLICES for i in range(1, SLICES)], 10_000).alias("c")).first()["c"] or []
    bounds = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    slice_ = F.size(F.filter(bounds, lambda b: F.col("at.us") > b)).alias("slice")
    more = [c for c in queries.columns if c not in ("key", "at")]
    asked = queries.select("key", "at", slice_, F.struct(*more).alias("own") if more else F.lit(None).alias("own"), F.lit(None).cast(targets.schema["at"].dataType).alias("to"), F.lit(0).alias("kind"))
    there = targets.select("key", "at", slice_, F.lit(None).cast(asked.schema["own"].dataType).alias("own"), F.col("at").alias("to"), F.lit(1).alias("kind"))
    near = F.last("to", ignorenulls=True).over(Window.partitionBy("key", "slice").orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = asked.unionByName(there).withColumn("to", near).where("kind = 0")
    firsts = there.groupBy("key", "slice").agg(F.min("at").alias("first")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("slice", "first"))).alias("firsts"))
    far = F.try_element_at(F.filter("firsts", lambda x: x["slice"] > F.col("slice")), F.lit(1))["first"]
    return found.join(F.broadcast(firsts), "key", "left").select("key", "at", *(["own.*"] if more else []), F.coalesce("to", far).alias("to"))


def reached(heads: DataFrame, links: DataFrame) -> DataFrame:
    """The entries (key, at) that links (key, at, to) lead to from heads (key, at), heads included."""
    on = table(heads.select("key", "at").distinct())
    ends = links.select("key", F.col("to").alias("at")).unionByName(on).distinct()
    links = table(links.where("to is not null").join(ends, ["key", "at"], "left_semi").select("key", "at", "to").distinct())
    while links.limit(1).count():
        more = on.join(links, ["key", "at"]).select("key", F.col("to").alias("at"))
        on = table(on.unionByName(more).distinct())
        onward = links.select("key", F.col("at").alias("to"), F.col("to").alias("then"))
        links = table(links.join(onward, ["key", "to"]).select("key", "at", F.col("then").alias("to")))
    return on
