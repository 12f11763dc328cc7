"""Listings, summaries and histograms over delivery records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import documents as D

# Upper bounds in seconds of the lag and duration histograms.
LAG_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60)
DURATION_BOUNDS = LAG_BOUNDS[:12]
PAGE, MOST, STUCK_PAGE = 100, 1000, 10  # rows of a page, of a page of acknowledgements at most, of stuck entries


@dataclass(frozen=True)
class Filter:
    """Predicates of a listing; what is None or empty does not filter. Times are half-open: start <= t < end."""

    equal: dict[str, str] = field(default_factory=dict)
    statuses: Sequence[str] = ()
    has_error: bool | None = None
    start: str | None = None
    end: str | None = None
    min_duration_ms: int | None = None
    min_retries: int | None = None
    time_column: str = "started_at"

    def columns(self) -> list[Column]:
        out = [F.col(c) == v for c, v in self.equal.items()]
        if self.statuses:
            out.append(F.col("status").isin(*self.statuses))
        if self.has_error is not None:  # a missing error is unequal to "" and also counts as none
            out.append(~F.col("error").eqNullSafe("") if self.has_error else F.coalesce("error", F.lit("")) == "")
        for bound, test in ((self.start, Column.__ge__), (self.end, Column.__lt__)):
            if bound:
                out.append(test(F.col(self.time_column), F.expr(f"timestamp_ntz '{bound}'")))
        if self.min_duration_ms is not None:
            out.append(F.col("duration_ms") >= self.min_duration_ms)
        if self.min_retries is not None:
            out.append(F.col("retry_count") >= self.min_retries)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return reduce(DataFrame.where, self.columns(), df)


def after(keys: Sequence[str], cursor: Sequence[Column], descending: bool = False) -> Column:
    """Rows strictly past the cursor in lexicographic order; the first key alone bounds the scan too."""
    past = [(F.col(k) < c) if descending else (F.col(k) > c) for k, c in zip(keys, cursor, strict=True)]
    same = [F.col(k) == c for k, c in zip(keys, cursor, strict=True)]
    steps = [reduce(Column.__and__, [*same[:i], past[i]]) for i in range(len(keys))]
    lead = F.col(keys[0]) <= cursor[0] if descending else F.col(keys[0]) >= cursor[0]
    return lead & reduce(Column.__or__, steps)


def page(df: DataFrame, keys: Sequence[str], n: int = PAGE, cursor: Sequence[Column] | None = None, descending: bool = False) -> DataFrame:
    """One page of a listing: a top-k, not a sort of the whole table."""
    found = df.where(after(keys, cursor, descending)) if cursor else df
    return found.orderBy(*(F.desc(k) if descending else F.asc(k) for k in keys)).limit(n)


def offset_page(df: DataFrame, keys: Sequence[str], offset: int = 0, n: int = PAGE) -> DataFrame:
    """A page of acknowledgements, newest first, by offset: of PAGE rows if n is not positive, of MOST at most."""
    return df.orderBy(*map(F.desc, keys)).offset(offset).limit(min(n, MOST) if n > 0 else PAGE)


def listing(df: DataFrame, keys: Sequence[str], n: int, mark: dict[str, Column], cursor: Sequence[Column] | None = None, descending: bool = False) -> DataFrame:
    """page() with has_more and next_cursor (the mark of its last row, null on the last page) in each row; one row more is read to tell."""
    order = [F.desc(k) if descending else F.asc(k) for k in keys]
    numbered = page(df, keys, n + 1, cursor, descending).withColumn("_n", F.row_number().over(Window.orderBy(*order)))  # over n + 1 rows
    whole = Window.partitionBy(F.lit(1))
    more = F.max("_n").over(whole) > n
    found = numbered.withColumns({"has_more": more, "next_cursor": F.when(more, F.max(F.when(F.col("_n") == n, D.cursor(**mark))).over(whole))})
    return found.where(F.col("_n") <= n).drop("_n")


def one(df: DataFrame, key: str, value: object, required: bool = False) -> DataFrame:
    """The row of a key; none if it is missing, or with required a KeyError."""
    found = df.where(F.col(key) == F.lit(value)).limit(1)
    if required and found.isEmpty():
        raise KeyError(f"{key} {value!r} not found")
    return found


def worker_filter(df: DataFrame, as_of: str, stale: str | None = None, statuses: Sequence[str] = (), equal: dict[str, str] | None = None, after: str | None = None, before: str | None = None) -> DataFrame:
    """Leases by status, worker or event and time of creation; a stale timeout replaces the statuses by processing and not touched for so long."""
    if stale:
        df, statuses = df.where((F.col("status") == "processing") & (F.col("updated_at") < F.expr(f"timestamp_ntz '{as_of}' - interval {stale}"))), ()
    return Filter(equal or {}, statuses, start=after, end=before, time_column="created_at").apply(df)


def to_record(entries: DataFrame, micros: str) -> DataFrame:
    """Entries as they are kept: whole milliseconds, null for no duration, no subscription for a worker pool, no null error."""
    pool = F.col("delivery_mode") == "worker_pool"
    return entries.withColumns({"subscription_id": F.when(pool, "").otherwise(F.col("subscription_id")), "duration_ms": F.when(F.col(micros) > 0, F.floor(F.col(micros) / 1000).cast("long")), "error": F.coalesce("error", F.lit(""))})


def _counts() -> list[Column]:
    of = lambda s: F.count_if(F.col("status") == s)
    rate = F.try_divide(of("failed"), F.count(F.lit(1)))
    return [F.count(F.lit(1)).alias("total"), of("completed").alias("completed"), of("failed").alias("failed"), of("retrying").alias("retrying"), of("pending").alias("pending"), F.coalesce(F.avg("duration_ms").cast("long"), F.lit(0)).alias("avg_ms"), F.coalesce(F.round(rate, 6), F.lit(0.0)).alias("error_rate")]


def summary(df: DataFrame, *by: str) -> DataFrame:
    """Counts by status, mean duration (cut to whole ms) and error rate of each group."""
    return df.groupBy(*by).agg(*_counts())


def facets(df: DataFrame) -> DataFrame:
    """Four groupings in one scan; facet tells which: 3 status, 5 event, 6 instance, 7 all."""
    sets = [[F.col("status")], [F.col("event_name")], [F.col("instance_id")], []]
    out = df.groupingSets(sets, "status", "event_name", "instance_id").agg(F.grouping_id().cast("long").alias("facet"), F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "failed").alias("failed"))
    return out.where(~((F.col("facet") == 6) & F.col("instance_id").eqNullSafe(""))).select("facet", "status", "event_name", "instance_id", "total", "failed")


def full_summary(df: DataFrame, as_of: str, filter_: Filter = Filter()) -> DataFrame:
    """facets() with the counts, mean and error rate of each group; a filter without bounds means the last 24 hours."""
    if not filter_.start and not filter_.end:
        df = df.where(F.col(filter_.time_column) >= F.expr(f"timestamp_ntz '{as_of}' - interval 24 hours"))
    sets = [[F.col("status")], [F.col("event_name")], [F.col("instance_id")], []]
    wanted = [c for c, name in zip(_counts(), ("total", "completed", "failed", "retrying", "pending", "avg_ms", "error_rate"), strict=True) if name not in ("retrying", "pending")]
    out = filter_.apply(df).groupingSets(sets, "status", "event_name", "instance_id").agg(F.grouping_id().cast("long").alias("facet"), *wanted)
    return out.where(~((F.col("facet") == 6) & F.col("instance_id").eqNullSafe("")))


def bucket(seconds: Column, bounds: Sequence[float] = LAG_BOUNDS) -> Column:
    """The number of bounds below the value; negative values count as 0."""
    return F.size(F.filter(F.array(*(F.lit(float(b)) for b in bounds)), lambda b: F.greatest(seconds, F.lit(0.0)) > b))


def histogram(df: DataFrame, seconds: Column, bounds: Sequence[float] = LAG_BOUNDS, by: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """Rows per bucket()."""
    return df.groupBy(*by, bucket(seconds, bounds).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *more)
