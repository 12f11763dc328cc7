"""Source divergence audit: how far the sources of a language stand apart, and which words set each of them apart.

Words are runs of letters A-Z (lower-cased) and characters beyond ASCII. A language keeps the words that at least 10 of its
documents hold. Each group (language, source) and each language as a whole gives each kept word a smoothed share p in
billionths; two shares p and q are (p - q)^2 / (p + q) apart, floored. All of it is integer arithmetic.

A pair of sources would need a sum over all V kept words. It starts at V times the term of two zero counts instead, and the
inverted index (word -> sources that hold it) only corrects that baseline: a word that one source of the pair holds corrects
it by f(p, q0) - f(p0, q0), where p0 and q0 are the shares of a zero count, so words with the same count are corrected together;
a word that both hold adds f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). Words in neither cost nothing. Ranks are windows.

Documents are counted where they are read: a task sends one row for each word and group it has met (or, beyond HELD of
them, for those so far), so a hot source or a word in all texts is a few rows a task. Joins are on (language, word), where a key
has one row for each source; shares reach the postings through join_counted(), which broadcasts hot groups alone; the baseline's
join on the language is salted.

Defined results: null text, lang and source are ''; a group without kept words takes part with zero counts; a language without
kept words (V = 0) has value 0 for each pair and no word rows; a language of one source has no pairs; rows that repeat count
each; texts of any length are counted whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, materialize, release

#: A task sends its counts when it holds so many (group, word) entries.
HELD = 500_000
#: Over how many keys a language's postings meet its sources.
SALTS = 64
BILLION = 1_000_000_000
#: Letters to lower case, all other ASCII to blanks, the rest as it is.
_LETTERS = bytes(b | 32 if chr(b).isascii() and chr(b).isalpha() else b if b > 127 else 32 for b in range(256))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, tf (occurrences), df (documents) for each group and word; a row with null term for each group."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def sent(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (tf, df) in held.items():
            terms = [None, *tf]
            columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()), pa.array([0, *tf.values()], pa.int64()), pa.array([0, *(df[t] for t in tf)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "tf", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tf, df = held.setdefault((lang, source), (Counter(), Counter()))
                words = text.translate(_LETTERS).split()
                tf.update(words)
                df.update(set(words))
            if sum(len(tf) for tf, _ in held.values()) > HELD:
                yield from sent(held)
                held = {}
        yield from sent(held)

    found = rows.mapInArrow(run, "lang string, source string, term binary, tf bigint, df bigint")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _share(count: str, n: str, v: str) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)) in exact arithmetic; null if there are no words."""
    return F.expr(f"1 + (cast({BILLION} as decimal(10,0)) * ({count} + 2)) div nullif({n} + 2 * {v}, 0)")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item (other source or word), value, rank: all pairs, the top words of each group."""
    of_term = Window.partitionBy("lang", "term")
    counts = word_counts(docs).withColumns({"lang_tf": F.sum("tf").over(of_term), "lang_df": F.sum("df").over(of_term)})
    kept = materialize(counts.where(F.col("term").isNull() | (F.col("lang_df") >= least_docs)).drop("df", "lang_df"), "kept-words")
    langs = kept.where("term is not null").groupBy("lang", "term").agg(F.first("lang_tf").alias("tf")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("tf").alias("lang_n"))
    groups = kept.groupBy("lang", "source").agg(F.sum("tf").alias("n"), F.count("term").alias("terms")).join(langs, "lang", "left").fillna(0, ["v", "lang_n"])
    groups = materialize(groups.withColumn("p0", F.coalesce(_share("0", "n", "v"), F.lit(1))), "source-groups")

    rated = join_counted(kept.where("term is not null"), groups.where("terms > 0"), ["lang", "source"], "terms")
    rated = rated.select("lang", "source", "term", "tf", _share("tf", "n", "v").alias("p"), "p0", _share("lang_tf", "lang_n", "v").alias("q"))
    rated = materialize(rated, "shares")
    release(kept)

    words = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
    pairs = _pairs(groups, rated)
    both = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.lit("pair").alias("part"), F.col("a").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.withColumn("rank", rank).unionByName(words.withColumn("rank", rank).where(F.col("rank") <= top))


def _pairs(groups: DataFrame, rated: DataFrame) -> DataFrame:
    """lang, a, b, value for each two sources a < b of a language."""
    start = groups.select("lang", "source", F.lit(0).cast("long").alias("tf"), F.col("v").alias("words"), F.col("p0").alias("p"), "p0")
    alike = rated.groupBy("lang", "source", "tf").agg(F.count(F.lit(1)).alias("words"), F.first("p").alias("p"), F.first("p0").alias("p0"))
    salted = start.unionByName(alike).withColumn("salt", F.pmod(F.xxhash64("source", "tf"), F.lit(SALTS)).cast("int"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = salted.join(others, ["lang", "salt"]).where("source <> item and (tf > 0 or source < item)")
    zero = _apart("p0", "q0")
    one_sided = met.select("lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"), F.expr(f"words * if(tf = 0, {zero}, {_apart('p', 'q0')} - {zero})").alias("value"))

    left = rated.select("lang", "term", "source", "p", "p0")
    right = rated.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    shared = left.join(right, ["lang", "term"]).where("source < item")
    more = F.expr(f"{_apart('p', 'q')} - {_apart('p', 'q0')} - {_apart('p0', 'q')} + {zero}").alias("value")
    two_sided = shared.select("lang", F.col("source").alias("a"), F.col("item").alias("b"), more).where("value <> 0")
    return one_sided.unionByName(two_sided).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
