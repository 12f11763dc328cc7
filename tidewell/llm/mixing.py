"""Mixing sources to target weights.

Word counts are summed per source; weights 5, 2, 1, repeating in code-point order (null last), share 150 % of all words,
and no source is asked for more than twice its words: what is above goes to the others by weight until none is above.
A source's repetition rate is its target over its words; each document is taken floor(rate) times, and once more when
a hash of its id, text digest and the seed falls below the fraction. Reruns agree.

Defined results: a null text has no words; a null source is a source of its own, last; repeated rows share one hash
and are taken alike; a source without words has target 0 and rate 0; a text of any
length is one document, counted whole; an empty table gives an empty result. mix() reads only
doc_id, source and text; mixed_documents() keeps all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, dense_names, materialize

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # 150 % of all words
MOST = 2
SEED = "mix-1"
#: Up to so many sources their rates are broadcast (about 100 bytes each); beyond, they are joined by shuffle.
BROADCAST_SOURCES = 50_000


def source_rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target for each source of sized (source, size)."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = sizes.withColumn("key", F.concat(F.when(F.col("source").isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), F.encode(F.coalesce("source", F.lit("")), "utf-8")))
    named = dense_names(keyed, "key", [], ["source", "source_size"], tag="sources")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("name") % len(weights) + 1).cast("int")).cast("long")
    table = materialize(named.withColumn("w", w), "rates")
    up, down = share
    cap, capped, num, den = F.col("source_size") * most, F.lit(False), None, None
    while True:  # each round caps at least one more source; weights of three kinds need few rounds
        r = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(~capped, F.col("w"))).alias("w"), F.sum(F.when(capped, cap)).alias("c"), F.count(F.when(capped, 1)).alias("n")).first()
        if not r["w"] or (num is not None and r["n"] == n_before):
            break
        num, den, n_before = up * r["all"] - down * (r["c"] or 0), down * r["w"], r["n"]
        capped = F.lit(num) * F.col("w") > cap * den
    target = F.lit(0.0) if num is None else F.least(cap.cast("double"), F.lit(num) * F.col("w") / F.lit(den))
    return table.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for each row of docs."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), F.sha2(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256)), 256).alias("coin"))
    rows = materialize(rows, "sized")  # texts are read once; the sums and the rows come from this
    return _with_copies(rows, rows.select("source", "size"))


def _with_copies(rows: DataFrame, sized: DataFrame) -> DataFrame:
    rates = source_rates(sized)
    small = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rates = rates.withColumnRenamed("source", "_source")
    joined = rows.join(F.broadcast(rates) if small else rates, rows["source"].eqNullSafe(rates["_source"])).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    coin = F.conv(F.substring("coin", 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    copies = (F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    return joined.withColumn("copies", copies).drop("coin")


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    coin = F.sha2(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256)), 256)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("source"), size.alias("size"), coin.alias("coin"))
    taken = _with_copies(rows, docs.select("source", size.alias("size"))).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
