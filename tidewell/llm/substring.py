"""Substring dedup: compressed FM-indexes over shards of the corpus.

A window is WINDOW consecutive words. Of every window the smallest hash among its GRAM-word grams is its anchor, so equal
windows have equal anchors, and consecutive windows with the same anchor form one segment (at most 2 * WINDOW - GRAM
words). Segments are dealt to shards by anchor: an anchor that occurs for one doc_id only can't hold a repeat and goes no
further; equal segments are indexed once, with their smallest doc_id. A shard builds an FM-index over its segments: the
Burrows-Wheeler transform in a wavelet matrix of packed bits, the bounds of the suffixes that agree in WINDOW (and in
WINDOW - 1) words, and the smallest doc_id within each of the former. Segments stream against it from their last word to
their first: backward search carries one interval and the length matched, the matching statistic, from word to word. At
WINDOW words, the threshold, the window is reported with the smallest doc_id of its interval; before the next word the
interval is widened to the suffixes that agree in one word less.

An anchor with over HOT different segments would make a shard too large. Its segments are cut anew: grams in over HOT of
the segments come last in the order that chooses anchors, so windows meet at a rarer gram. What is still over HOT then
(windows of frequent grams only) is cut into its single windows, each its own anchor. All cuts end in FM-indexes of at
most HOT segments an anchor.

Rows are told apart by doc_id and a hash of their text, so nothing depends on the order of a scan. Defined results: null
texts have no words; texts under WINDOW words lose none; rows that repeat a doc_id do not count as smaller than each
other; a row with a null doc_id is neither smaller nor larger than any, keeps its words and takes none from others; long texts are
cut in segments that overlap by a window, so all their windows count; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, release

WINDOW, GRAM = 50, 20
SHARD_WORDS, HOT, ROWS = 300_000, 4_000, 256
#: Anchors and grams (8 bytes each) that are broadcast at most; more anchors are joined by shuffle, of grams the bar rises.
BROADCAST_ANCHORS, MOST_FREQUENT = 200_000, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Powers:
    """Powers of the gram hash's base and of its inverse modulo 2 ** 64."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            ones = np.ones(max(n, 4096), np.uint64)
            cls.up, cls.down = (np.cumprod(np.concatenate([ones[:1], ones[1:] * x])) for x in (_ODD, _BACK))
        return cls.up[:n], cls.down[:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A hash of each k consecutive words."""
    up, down = Powers.of(len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word_hashes(words) * up)])
    g = (sums[k:] - sums[:-k]) * down[: len(words) - k + 1]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(29))


def segments(words: list[bytes], window: int = WINDOW, k: int = GRAM, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word and number of words of each segment of one document. Grams in frequent (sorted) come last."""
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    g = gram_hashes(words, k)
    if frequent is not None:
        g >>= np.uint64(1)
        g |= _among(g, frequent).astype(np.uint64) << np.uint64(63)
    at = np.lib.stride_tricks.sliding_window_view(g, window - k + 1).argmin(1) + np.arange(len(words) - window + 1)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    ends = np.append(starts[1:], len(at)) - 1
    return g[at[starts]].view(np.int64), starts.astype(np.int32), (ends - starts + window).astype(np.int32)


def _among(g: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, g), len(known) - 1)] == g if len(known) else np.zeros(len(g), bool)


class Bits:
    """A packed bit vector with counts of the ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(np.append(bits, np.zeros(64 + -len(bits) % 64, np.uint8)), bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.bitwise_count(self.packed).cumsum()[:-1]]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        return self.before[word] + np.bitwise_count(self.packed[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))


class FMIndex:
    """Burrows-Wheeler transform of many sequences of words in a wavelet matrix, with the smallest document of each window.

    Neither the words nor the suffix array stay: n * (bits of a word's number + 2) bits, and a number for each run of
    suffixes that agree in window words (and its start, and that of each run that agrees in one word less).
    """

    def __init__(self, sequences: list[np.ndarray], documents: np.ndarray, window: int = WINDOW):
        self.window = window
        sizes = np.array([len(s) for s in sequences])
        ends = (sizes + 1).cumsum() - 1
        text = np.zeros(ends[-1] + 1, np.int64)  # each sequence ends in a 0
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.concatenate(sequences)
        n, owner = len(text), np.repeat(np.arange(len(sequences)), sizes + 1)
        rank = text + len(sequences)
        rank[ends] = np.arange(len(sequences))  # ends differ, so all suffixes do after a sequence's length
        step, half, part = 1, 1, rank
        while True:
            pair = rank * (n + len(sequences) + 2)
            pair[:-step] += rank[step:] + 1
            order = pair.argsort(kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.diff(pair[order], prepend=pair[order[0]]) != 0)
            step *= 2
            if step < window:
                half, part = step, rank  # part: ranks by the first half words, and window - 1 <= 2 * half
            if rank[order[-1]] == n - 1 or step > n:
                break
        self.n, last = n, text[order - 1]
        self.below = np.concatenate([[0], np.bincount(text).cumsum()])
        self._wavelet(last)

        def runs(length: int) -> tuple[Bits, np.ndarray]:
            """Where suffixes begin that differ from the one before in their first words."""
            a, b = part[order], part[np.minimum(order + length - half, n - 1)]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            return Bits(new.astype(np.uint8)), np.append(np.flatnonzero(new), n).astype(np.int32)

        self.windows, starts = runs(window)
        self.least = np.minimum.reduceat(documents[owner[order]], starts[:-1])
        self.shorter, self.starts = runs(window - 1)

    def _wavelet(self, last: np.ndarray) -> None:
        self.levels, symbols = [], np.arange(last.max() + 1)
        self.home, cur = np.zeros(len(symbols), np.int64), last
        for b in reversed(range(max(int(last.max()).bit_length(), 1))):
            bits = (cur >> b & 1).astype(np.uint8)
            self.levels.append((b, Bits(bits), len(bits) - int(bits.sum())))
            cur = np.concatenate([cur[bits == 0], cur[bits == 1]])
            self.home = self._down(self.levels[-1], symbols, self.home)

    @staticmethod
    def _down(level: tuple, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        b, bits, zeros = level
        ones = bits.ones(i)
        return np.where(c >> b & 1, zeros + ones, i - ones)

    def occurrences(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each c is among the first i symbols of the transform."""
        for level in self.levels:
            i = self._down(level, c, i)
        return i - self.home[c]

    def firsts(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The smallest document that holds each window of each sequence, in order, and where each sequence's begin.

        The sequences are among those indexed, so the running match never fails; it stays at window words once there.
        """
        sizes, w = np.array([len(s) for s in sequences]), self.window
        offsets = np.concatenate([[0], (sizes - w + 1).cumsum()])
        out, ends = np.empty(offsets[-1], np.int64), sizes.cumsum()
        words, by_size = np.concatenate(sequences), (-sizes).argsort(kind="stable")
        live = len(sizes)
        low, high = np.zeros(live, np.int64), np.full(live, self.n, np.int64)
        for s in range(int(sizes.max())):
            live = int(np.searchsorted(-sizes[by_size], -s))  # sequences of over s words
            own = by_size[:live]
            low, high = low[:live], high[:live]
            if s >= w:
                run = self.shorter.ones(low + 1) - 1
                low, high = self.starts[run].astype(np.int64), self.starts[run + 1].astype(np.int64)
            c = words[ends[own] - 1 - s]
            both = self.occurrences(np.concatenate([c, c]), np.concatenate([low, high]))
            low, high = self.below[c] + both[:live], self.below[c] + both[live:]
            if s >= w - 1:
                out[offsets[own] + sizes[own] - 1 - s] = self.least[self.windows.ones(low + 1) - 1]
        return out, offsets


def _anchored(docs: DataFrame, window: int, k: int) -> DataFrame:
    """doc_id, th (hash of the text), anchor, digest, start, len of every segment."""
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    names = ["doc_id", "th", "anchor", "digest", "start", "len"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                own, found, digests = [], [], []
                for i, text in enumerate(b.column(2).to_pylist()):
                    words = text.encode().split()
                    anchors, starts, sizes = segments(words, window, k)
                    if not len(anchors):
                        continue
                    joined, offsets = b" ".join(words), np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
                    digests += [xxhash.xxh3_64_intdigest(joined[x : y - 1]) for x, y in zip(offsets[starts].tolist(), offsets[starts + sizes].tolist(), strict=True)]
                    own.append(np.full(len(anchors), i))
                    found.append((anchors, starts, sizes))
                if own:
                    rows_ = np.concatenate(own)
                    anchors, starts, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows_)), b.column(1).take(pa.array(rows_)), pa.array(anchors), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(starts), pa.array(sizes)], names=names)

    return rows.mapInArrow(run, "doc_id bigint, th bigint, anchor bigint, digest bigint, start int, len int")


CUT = "anchor bigint, digest bigint, first_doc bigint, n bigint, words binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of numbers, but for words."""
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if c == "words" else pa.int64()) for c, v in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def _cut(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """anchor, digest, first_doc, n (how often it occurs), words of each distinct segment, taken from the document that stands for it."""
    wanted = distinct.groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.collect_list(F.struct("anchor", "digest", "first_doc", "n", "start", "len")).alias("segs"))
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    both = rows.join(wanted, (F.col("doc_id") == F.col("_d")) & (F.col("th") == F.col("_t"))).select("text", "segs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                out = []
                for text, segs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    words = text.encode().split()
                    out += [(s["anchor"], s["digest"], s["first_doc"], s["n"], b" ".join(words[s["start"] : s["start"] + s["len"]])) for s in segs]
                if out:
                    yield _batch(out, CUT)

    return both.mapInArrow(run, CUT).dropDuplicates(["anchor", "digest"])


def _indexed(cut: DataFrame, window: int) -> DataFrame:
    """anchor, digest, n, firsts: of each window of a segment the smallest doc_id of its shard that holds it."""
    size = cut.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // (SHARD_WORDS * 6)))

    def run(group: pa.Table) -> pa.Table:
        words = [w.split() for w in group["words"].to_pylist()]
        names = {w: i for i, w in enumerate(dict.fromkeys(w for s in words for w in s), 1)}
        sequences = [np.fromiter(map(names.__getitem__, s), np.int64, len(s)) for s in words]
        index = FMIndex(sequences, group["first_doc"].to_numpy(), window)
        found, offsets = [], [np.zeros(1, np.int64)]
        for at in range(0, len(sequences), 8192):
            f, o = index.firsts(sequences[at : at + 8192])
            found.append(f)
            offsets.append(o[1:] + offsets[-1][-1])
        firsts = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(found), pa.int64()))
        return pa.table([group["anchor"], group["digest"], group["n"], firsts], names=["anchor", "digest", "n", "firsts"])

    return cut.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(run, "anchor bigint, digest bigint, n bigint, firsts array<bigint>")


def _frequent_grams(cut: DataFrame, k: int, hot: int) -> np.ndarray:
    """Grams (hashes over 2) in more than hot segments, sorted: at most MOST_FREQUENT, as the bar rises until they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.unique(gram_hashes(w.split(), k)) >> np.uint64(1) for w in b.column(0).to_pylist()]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64))], names=["gram"])

    counts = materialize(cut.select("words").mapInArrow(run, "gram bigint").groupBy("gram").count().where(F.col("count") > hot), "grams")
    bar = hot
    while counts.where(F.col("count") > bar).count() > MOST_FREQUENT:
        bar = 2 * bar + 1
    found = counts.where(F.col("count") > bar).select("gram").toArrow()["gram"].to_numpy()
    release(counts)
    return np.sort(found.astype(np.int64).view(np.uint64))


def _pieces(cut: DataFrame, window: int, k: int, frequent: np.ndarray | None) -> DataFrame:
    """Segments cut anew, by anchors that avoid frequent grams or (None) into single windows: _a, _d and place of the whole, and the piece."""
    shared = cut.sparkSession.sparkContext.broadcast(frequent)
    schema = f"_a bigint, _d bigint, place bigint, {CUT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                out = []
                for r in whole.slice(at, ROWS).to_pylist():
                    words = r["words"].split()
                    if shared.value is None:
                        parts = [(None, i, window) for i in range(len(words) - window + 1)]
                    else:
                        parts = zip(*(x.tolist() for x in segments(words, window, k, shared.value)), strict=True)
                    for anchor, start, size in parts:
                        own = b" ".join(words[start : start + size])
                        digest = xxhash.xxh3_64_intdigest(own) - (1 << 63)
                        out.append((r["anchor"], r["digest"], start, digest if anchor is None else anchor, digest, r["first_doc"], 1, own))
                if out:
                    yield _batch(out, schema)

    return cut.select("anchor", "digest", "first_doc", "words").mapInArrow(run, schema)


def _firsts(cut: DataFrame, window: int, k: int, hot: int, level: int = 0) -> DataFrame:
    """What _indexed() gives, for segments with any number of them to an anchor."""
    if level == 2:  # single windows, each an anchor of its own
        return _indexed(cut, window)
    heavy = materialize(cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments")).where(F.col("segments") > hot), "heavy")
    n_heavy = heavy.count()
    if not n_heavy:
        return _indexed(cut, window)
    if n_heavy <= BROADCAST_ANCHORS:
        names = F.broadcast(heavy.select("anchor"))
        light, crowded = cut.join(names, "anchor", "left_anti"), cut.join(names, "anchor", "left_semi")
    else:
        light, crowded = cut.join(heavy, "anchor", "left_anti"), join_counted(cut, heavy, ["anchor"], "segments").select(*cut.columns)
    crowded = materialize(crowded, "crowded")
    frequent = None if level else _frequent_grams(crowded, k, hot)
    pieces = materialize(_pieces(crowded, window, k, frequent), "pieces")
    again = pieces.groupBy("anchor", "digest").agg(F.min("first_doc").alias("first_doc"), F.sum("n").alias("n"), F.min("words").alias("words"))
    found = _firsts(materialize(again.select("anchor", "digest", "first_doc", "n", "words"), "recut"), window, k, hot, level + 1)
    each = join_counted(pieces.select("_a", "_d", "place", "anchor", "digest"), found, ["anchor", "digest"], "n")
    whole = each.groupBy("_a", "_d").agg(F.flatten(F.sort_array(F.collect_list(F.struct("place", "firsts"))).getField("firsts")).alias("firsts"))
    back = crowded.select("anchor", "digest", "n").join(whole, (F.col("anchor") == F.col("_a")) & (F.col("digest") == F.col("_d"))).select("anchor", "digest", "n", "firsts")
    return _indexed(light, window).unionByName(back)


def repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, th, runs (array of start and mask: bit i says that the window at start + i occurs for a smaller doc_id)."""
    segs = materialize(_anchored(docs, window, k), "segments")
    shared = segs.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).where("a < b").select("anchor", "n")
    occ = materialize(join_counted(segs, shared, ["anchor"], "n").drop("n"), "repeated")
    release(segs)
    spot = F.struct("doc_id", "th", "start", "len")
    distinct = occ.groupBy("anchor", "digest").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"), F.min(spot).alias("spot")).select("anchor", "digest", "first_doc", "n", "spot.*")
    cut = materialize(_cut(docs, distinct), "cut")
    firsts = _firsts(cut, window, k, hot)
    # Segments hold at most WINDOW - GRAM + 1 windows, which fit the bits of a long.
    bits = F.aggregate(F.sequence(F.lit(0), F.size("firsts") - 1), F.lit(0).cast("long"), lambda acc, i: F.when(F.element_at("firsts", i + 1) < F.col("doc_id"), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))).otherwise(acc))
    hits = join_counted(occ, firsts, ["anchor", "digest"], "n").select("doc_id", "th", "start", bits.alias("mask")).where("mask <> 0")
    return materialize(hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "mask")).alias("runs")), "runs")


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) for each row of docs."""
    runs = repeats(docs, window, k, hot).withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    both = rows.join(runs, (F.col("doc_id") == F.col("_d")) & (F.col("th") == F.col("_t")), "left").select("doc_id", "text", "runs")
    schema = both.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                n_words, n_removed, kept = [], [], []
                for text, runs_ in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    words = text.encode().split()
                    n_words.append(len(words))
                    if runs_:
                        marks = np.zeros(len(words) + 1, np.int64)
                        starts = np.unique([r["start"] + i for r in runs_ for i in range(r["mask"].bit_length()) if r["mask"] >> i & 1])
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + window, -1)
                        stays = marks[:-1].cumsum() == 0
                        words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return both.mapInArrow(run, schema)
