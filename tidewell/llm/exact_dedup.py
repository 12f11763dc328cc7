"""Exact dedup by deterministic block naming.

A text is cut into blocks of BLOCK bytes. Blocks are sorted over the whole corpus and get integer names; then adjacent
names are paired and the pairs named, level by level, until each document has one name. Equal names at the last level
mean equal texts, byte for byte: names are ranks in a sort, not hashes, so nothing collides.

Defined results: a null text is an empty text; empty texts are equal to each other; rows that repeat a doc_id stay
separate rows, and of rows that tie for the largest doc_id the first of the scan stays (with all columns: of rows that agree
in doc_id and text too, the one whose columns have the smallest hash); a null doc_id counts as the smallest; long texts are cut in
blocks and named in as many rounds as it takes. An empty table gives an empty result. Other columns pass through drop_exact_duplicates(), whatever their names;
exact_duplicates() does not read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dense_names, join_counted, materialize, release, rows_of

BLOCK = 4096


def _pair(a: str, b: str) -> Column:
    """Two names as 16 bytes; a missing second name is -1."""
    return F.unhex(F.concat(*(F.lpad(F.hex(F.coalesce(F.col(x), F.lit(-1))), 16, "0") for x in (a, b))))


def identities(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """_rid, doc_id, other columns, sha (binary), n_blocks, name: (n_blocks, name) is the identity of a row's text; and the tables behind.

    docs: _rid, doc_id, text and small columns that go along.
    """
    also = [c for c in docs.columns if c not in ("_rid", "doc_id", "text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("_rid", "doc_id", *also, F.encode(text, "utf-8").alias("_b"), text.alias("_t"))
    n = F.greatest(F.lit(1), F.ceil(F.length("_b") / F.lit(block)).cast("long"))
    blocks = rows.withColumn("n_blocks", n).withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    blocks = blocks.select(
        "_rid", "doc_id", *also, "n_blocks", "pos", F.expr(f"substring(_b, cast(pos * {block} + 1 as int), {block})").alias("block"),
        F.when(F.col("pos") == 0, F.unhex(F.sha2("_t", 256))).alias("sha"),
    ).withColumn("near", F.xxhash64("block"))
    keep = ["_rid", "doc_id", *also, "n_blocks", "pos", "sha"]
    level = dense_names(blocks, "block", ["_rid", "pos"], keep, near="near", tag="blocks")
    width = level.agg(F.max("n_blocks")).first()[0] or 1
    cols, tables = ["_rid", "doc_id", *also, "sha", "n_blocks", "name"], [level]
    done = level.where("n_blocks = 1").select(*cols)
    open_, depth = level.where("n_blocks > 1"), 0
    while width > 1:
        half = F.shiftright("pos", 1)
        pairs = open_.groupBy("_rid", half.alias("pos")).agg(
            F.first("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in also), F.first("n_blocks").alias("n_blocks"), F.max("sha").alias("sha"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"),
        ).withColumn("pair", _pair("a", "b"))
        width = (width + 1) // 2
        named = dense_names(pairs, "pair", ["_rid", "pos"], keep, tag="pairs")
        tables.append(named)
        levels = F.ceil(F.log2(F.col("n_blocks"))).cast("int")
        depth += 1
        done = done.unionByName(named.where(levels == depth).select(*cols))
        open_ = named.where(levels > depth)
    return done, tables


def _decided(rows: DataFrame, block: int) -> DataFrame:
    """The result of exact_duplicates() for rows (_rid, doc_id, text and small columns), with all but the text."""
    named, tables = identities(rows, block)
    ids = materialize(named, "ids")
    release(*tables)
    best = F.max(F.struct(F.col("doc_id"), (-F.col("_rid")).alias("r")))
    groups = ids.groupBy("n_blocks", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    return join_counted(ids, groups, ["n_blocks", "name"], "group_size").select(
        *(c for c in rows.columns if c != "text"), F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("_rid") == -F.col("best.r")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. The largest doc_id of equal texts stays."""
    return _decided(rows_of(docs, "doc_id", "text"), block).drop("_rid")


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Rows that stay are found again by 128 bits of doc_id and text, the same in each scan: a second one may be cut into
    other partitions.
    """
    bits = [F.col("doc_id"), F.col("text"), F.col("text").isNull()]
    key = [F.xxhash64(*bits).alias("_r1"), F.xxhash64(F.lit(1), *bits[::-1]).alias("_r2")]
    kept = materialize(_decided(rows_of(docs, "doc_id", "text", *key), block).where("kept").select("_r1", "_r2"), "kept")
    rows = docs.select(*key, F.struct("*").alias("row")).join(kept, ["_r1", "_r2"])
    return rows.groupBy("_r1", "_r2").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*")
