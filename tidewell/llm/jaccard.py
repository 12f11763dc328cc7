"""N-gram Jaccard join over prefixes of tokens and token combinations.

A document is the set of its distinct n-word shingles; two link when the intersection is at least num / den of the union.
Equal sets are one class, so copies never meet in pairs. Tokens are shingle hashes; rare ones come first, frequent ones (in
over FREQUENT rows, counted over all rows) after them, each by hash. A set of s tokens misses at most e of its tokens in
a partner. Frequent tokens fall in parts by hash; a prefix is extended until e + 1 mismatches cannot use it up, where a
rare token counts 1 and a part of c frequent tokens c - 1. Rare tokens of the prefix are indexed alone, frequent ones as
pairs within their part: similar sets share a key. The number of parts grows with the size range of a pair's larger set;
a set is indexed in each range that it may meet. Tokens in the upper half of the hashes come after all others. Only sets
too small to fill a prefix from the lower half ever reach them, so they are counted over those sets, as only these index them.

Candidates whose prefixes share too few tokens for a link go; the rest are verified on the texts' whole sets. Within a key,
each class is first tried against one class of the key, the hub (then another), so a key of any size gives one pair per member,
and classes already connected are not tried again. A hub's text is sent once for each PER_HUB of its pairs, not with each. What
is left, pairs of one key in different components, is tried whole, in blocks, but for pairs whose bits (parities of the
tokens that fall on each) differ in more places than linked sets differ in tokens. Component labels spread over the verified
links with pointer jumping until nothing changes.

Defined results: null texts, and texts without words, have an empty set, link with nothing and are their own component;
under n words the whole sequence is one shingle; rows that repeat a doc_id count as one node if their texts link and keep
their row each; a null doc_id is never the smallest, unless all of a component are null; an empty table gives an empty
result. component_ids() reads only doc_id and text; keep_one() keeps all columns, whatever their names, and of rows that agree
in doc_id and text the one whose columns have the smallest hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, join_counted, materialize, release

ROWS, FREQUENT, MOST_FREQUENT, BROADCAST_IDS, BLOCK, BITS, PER_HUB = 256, 32, 1 << 20, 200_000, 1_024, 512, 250
ONE_TASK = 1 << 19
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def tokens(text: str | None, n: int) -> np.ndarray:
    """The distinct shingles of a text as sorted unsigned 64-bit hashes."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out, m = np.zeros(len(h) - n + 1, np.uint64), len(h) - n + 1
    for i in range(n):
        out = _mix(out * _M[0] + h[i : i + m])
    return np.unique(out)


def parities(all_tokens: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of the tokens that fall on it: two sets differ in as many tokens as bits, or more."""
    odd = np.bincount((all_tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def size_range(s: int) -> int:
    return s.bit_length()


def parts_of(size_range_: int) -> int:
    return max(1, (1 << size_range_ >> 1) // 32)


def missed(s: int, num: int, den: int) -> int:
    """How many tokens of a set of s any partner may lack."""
    return s + (-num * s // den)  # s - ceil(num * s / den)


def ranges_met(s: int, num: int, den: int) -> range:
    """The size ranges of the larger set of any pair with this set."""
    return range(size_range(s), size_range(s * den // num) + 1)


def needed(s: int, num: int, den: int) -> int:
    """The most tokens that any prefix of a set of s has."""
    return missed(s, num, den) + 1 + max(map(parts_of, ranges_met(s, num, den)))


def counted(all_tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """The tokens of a set that its prefixes may hold: those in the lower half of the hashes, or all if these are too few."""
    low = all_tokens[: np.searchsorted(all_tokens, np.uint64(1 << 63))]
    return all_tokens if len(all_tokens) and len(low) < needed(len(all_tokens), num, den) else low


def ordered(all_tokens: np.ndarray, frequent: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set in the corpus's order, as many as any prefix of it needs, and the class of each.

    Classes: 0 rare, 1 frequent; 2 and 3 the same for hashes from 2 ** 63. The order is by class, then hash.
    """
    need = needed(len(all_tokens), num, den)
    at = np.minimum(np.searchsorted(frequent, all_tokens), max(len(frequent) - 1, 0))
    kind = (all_tokens >> np.uint64(62) & np.uint64(2)).astype(np.uint8)
    if len(frequent):
        kind[frequent[at] == all_tokens] |= 1
    order = kind.argsort(kind="stable")[:need]
    return all_tokens[order], kind[order]


def keys(prefix: np.ndarray, kind: np.ndarray, s: int, num: int, den: int) -> np.ndarray:
    """The keys of a set of s tokens, of which prefix and kind are ordered()."""
    e, out, common = missed(s, num, den), [], kind & 1 == 1
    for r in ranges_met(s, num, den):
        parts = _mix(prefix ^ _M[0]) % np.uint64(parts_of(r))
        seen, left = set(), e + 1
        for i, (often, part) in enumerate(zip(common.tolist(), parts.tolist(), strict=True)):
            if often and part not in seen:
                seen.add(part)
            else:
                left -= 1
            if not left:
                break
        head, often, part = prefix[: i + 1], common[: i + 1], parts[: i + 1]
        salt = np.array([r], np.uint64)
        out.append(_mix(head[~often] ^ _mix(salt + _M[1])))
        for p in seen:
            own = head[often & (part == np.uint64(p))]
            a, b = np.triu_indices(len(own), 1)
            out.append(_mix(_mix(own[a] + salt) * _M[0] + own[b]))
    return np.unique(np.concatenate(out))


def _row_key(docs: DataFrame) -> DataFrame:
    """docs with _r1 and _r2, 128 bits that tell doc_id and text: the same in each scan, whatever its partitions."""
    return docs.withColumns({"_r1": F.xxhash64("doc_id", "text"), "_r2": F.xxhash64("text", F.lit(1), "doc_id")})


def _sets(docs: DataFrame, frequent: np.ndarray, n: int, num: int, den: int) -> DataFrame:
    """doc_id, _r1, _r2, _rid, n_shingles, sig (identity of the set), bits (parities), prefix and kind for each row of docs."""
    keep = ["doc_id", "_r1", "_r2", "_rid"]
    rows = _row_key(docs.select("doc_id", "text")).withColumn("_rid", F.monotonically_increasing_id()).select(*keep, "text")
    empty = F.lit(b"")
    schema = rows.select(*keep, F.lit(0).cast("long").alias("n_shingles"), empty.alias("sig"), F.array(F.lit(0).cast("long")).alias("bits"), F.array(F.lit(0).cast("long")).alias("prefix"), empty.alias("kind")).schema
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                sets = [tokens(t, n) for t in b.column(4).to_pylist()]
                sizes = [len(s) for s in sets]
                sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                none = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
                heads = [ordered(s, shared.value, num, den) if len(s) else none for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(p) for p, _ in heads])])
                prefix = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([p for p, _ in heads]).view(np.int64)))
                width = BITS // 64
                bits = pa.ListArray.from_arrays(pa.array(range(0, width * len(sets) + 1, width), pa.int32()), pa.array(np.concatenate([parities(s) for s in sets])))
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), bits, prefix, pa.array([k.tobytes() for _, k in heads], pa.binary())], names=[*keep, "n_shingles", "sig", "bits", "prefix", "kind"])

    return rows.mapInArrow(run, schema)


def _frequent_tokens(docs: DataFrame, n: int, num: int, den: int, at_least: int) -> np.ndarray:
    """The tokens in over at_least rows of docs whose prefixes may hold them, sorted.

    The bar rises until there are at most MOST_FREQUENT of them (8 MB). It only decides how well keys tell sets apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                flat = np.concatenate([np.zeros(0, np.uint64), *(counted(tokens(t, n), num, den) for t in whole.column(0).slice(at, ROWS).to_pylist())])
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["token"])

    found = docs.select("text").where("text is not null").mapInArrow(run, "token bigint")
    counts = materialize(found.groupBy("token").count().where(F.col("count") > at_least), "frequent")
    while counts.where(F.col("count") > at_least).count() > MOST_FREQUENT:
        at_least *= 2
    often = counts.where(F.col("count") > at_least).select("token").toArrow()["token"].to_numpy()
    release(counts)
    return np.sort(often.astype(np.int64).view(np.uint64))


def _keyed(classes: DataFrame, num: int, den: int) -> DataFrame:
    """key, id, size, rare (rare tokens among its first ones): a row for each key of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                found = [keys(p.values.to_numpy().view(np.uint64), np.frombuffer(k, np.uint8), s, num, den) for s, p, k in zip(b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True)]
                own = pa.array(np.repeat(np.arange(b.num_rows), [len(k) for k in found]))
                flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                rare = pa.array([k.count(0) for k in b.column(3).to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(flat), b.column(0).take(own), b.column(1).take(own), rare.take(own)], names=["key", "id", "size", "rare"])

    return classes.select("id", "size", "prefix", "kind").mapInArrow(run, "key bigint, id bigint, size bigint, rare int")


def _near_sizes(a: str, b: str, num: int, den: int) -> Column:
    """Sets of these sizes can link at all."""
    return (F.col(a) * den >= F.col(b) * num) & (F.col(b) * den >= F.col(a) * num)


def _near_bits(num: int, den: int) -> Column:
    """The sets (size, bits and size_o, bits_o) may link: their parities differ in no more bits than linked sets differ in tokens."""
    apart = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("bits_o")[i])) for i in range(BITS // 64)), F.lit(0))
    return apart * (num + den) <= (F.col("size") + F.col("size_o")) * (den - num)


def _pairs(left: DataFrame, hub: str = "other") -> DataFrame:
    """Distinct pairs (a, b), smaller id first; from_a: a is the one that many pairs share."""
    found = left.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), (F.col(hub) == F.least("id", "other")).alias("from_a"))
    return found.groupBy("a", "b").agg(F.max("from_a").alias("from_a"))


def _likely(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose prefixes share as many tokens as a link needs.

    Of the prefix that ends first every shared token is in the other prefix too, and at most size - overlap may be missing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                keep = []
                for s, t, x, y, i, j in zip(*(b.column(i).to_pylist() for i in (2, 3)), *(b.column(i) for i in (4, 5)), *(b.column(i).to_pylist() for i in (6, 7)), strict=True):
                    x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                    overlap = -(-num * (s + t) // (num + den))
                    least = len(x) - (s - overlap) if (i[-1], x[-1]) <= (j[-1], y[-1]) else len(y) - (t - overlap)
                    keep.append(least <= 0 or len(np.intersect1d(x, y, assume_unique=True)) >= least)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(8)], names=["a", "b", "from_a"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(reps.select(F.col("id").alias("a"), F.col("size").alias("s"), F.col("prefix").alias("x"), F.col("kind").alias("i")), "a")
    both = one.join(reps.select(F.col("id").alias("b"), F.col("size").alias("t"), F.col("prefix").alias("y"), F.col("kind").alias("j")), "b")
    return both.select("a", "b", "s", "t", "x", "y", "i", "j", "from_a").mapInArrow(run, "a bigint, b bigint, from_a boolean")


def _texts(docs: DataFrame, sets: DataFrame, ids: DataFrame) -> DataFrame:
    """id, text of the classes ids. Up to BROADCAST_IDS of them (32 bytes each) are broadcast; more are joined by shuffle."""
    met = sets.select(F.col("_rid").alias("id"), "_r1", "_r2").join(ids, "id", "left_semi")
    met = materialize(met, "met")
    small = met.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    whole = _row_key(docs.where("text is not null").select("doc_id", "text")).drop("doc_id")
    out = materialize(whole.join(F.broadcast(met) if small else met, ["_r1", "_r2"]).select("id", "text").dropDuplicates(["id"]), "texts")
    release(met)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a table: a, b, from_a) whose texts (id, text) link.

    Rows are dealt by hub and slice of PER_HUB members and sorted: the hub's text comes first, then its members' texts stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, hub = None, None
        for b in batches:
            hubs, members = [], []
            for i in range(b.num_rows):
                own, member = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                if member is None:
                    x, hub = tokens(b.column(2)[i].as_py(), n), own
                elif own == hub:
                    y = tokens(b.column(2)[i].as_py(), n)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if den * common >= num * (len(x) + len(y) - common):
                        hubs.append(own)
                        members.append(member)
            low, high = np.minimum(hubs, members).astype(np.int64), np.maximum(hubs, members).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

    hub = F.when(F.col("from_a"), F.col("a")).otherwise(F.col("b")).alias("hub")
    turned = pairs.select(hub, F.when(F.col("from_a"), F.col("b")).otherwise(F.col("a")).alias("member"))
    slices = join_counted(turned, turned.groupBy("hub").agg(F.count(F.lit(1)).alias("members")), ["hub"], "members")
    slices = slices.withColumn("slice", F.pmod(F.xxhash64("member"), F.ceil(F.col("members") / PER_HUB)).cast("int")).drop("members")
    slices = materialize(slices, "slices")
    of_members = slices.join(texts.withColumnRenamed("id", "member"), "member").select("hub", "slice", "member", "text")
    of_hubs = slices.select("hub", "slice").distinct().join(texts.withColumnRenamed("id", "hub"), "hub").select("hub", "slice", F.lit(None).cast("long").alias("member"), "text")
    rows = of_hubs.unionByName(of_members).repartition("hub", "slice").sortWithinPartitions("hub", "slice", F.col("member").isNotNull())
    found = materialize(rows.select("hub", "member", "text").mapInArrow(run, "a bigint, b bigint"), "links")
    release(slices)
    return found


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, comp of each id in the links of all batches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    ids = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], names=["id", "comp"])


def components(links: DataFrame) -> DataFrame:
    """id, comp (the smallest id it reaches) of each id in links (a, b): labels spread and pointers jump until stable.

    Up to ONE_TASK links (8 MB) are joined by one task instead, which gives the same rows.
    """
    if links.limit(ONE_TASK + 1).count() <= ONE_TASK:
        return materialize(links.select("a", "b").coalesce(1).mapInArrow(_joined, "id bigint, comp bigint"), "labels")
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = materialize(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        around = edges.join(state.select(F.col("id").alias("b"), F.col("comp").alias("near")), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        lower = state.join(around, "id").select("id", "comp", F.least("comp", "near").alias("low"))
        # What a label's own node has learnt goes to all that carry the label.
        told = lower.groupBy(F.col("comp").alias("root")).agg(F.min("low").alias("least"))
        hop = materialize(lower.join(told, F.col("comp") == F.col("root")).select("id", F.col("comp").alias("was"), F.least("low", "least").alias("comp")), "labels")
        changed = hop.where("comp <> was").limit(1).count()
        release(state)
        state = hop.select("id", "comp")
        state._tidewell_path = hop._tidewell_path
        if not changed:
            release(edges)
            return state


def _labelled(keyed: DataFrame, comps: DataFrame | None) -> DataFrame:
    """keyed with comp and n, members of the key, for keys whose members are in more than one component."""
    n = F.count(F.lit(1)).alias("n")
    if comps is None:
        with_comp = keyed.drop("n").withColumn("comp", F.col("id"))
        mixed = keyed.groupBy("key").agg(n).where("n > 1")
    else:
        with_comp = keyed.drop("comp", "n").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        mixed = with_comp.groupBy("key").agg(F.min("comp").alias("p"), F.max("comp").alias("q"), n).where("p <> q").select("key", "n")
    # A table, so that both sides of the join shuffle and a hot key can be split.
    return with_comp.drop("n").join(materialize(mixed, "mixed-keys"), "key")


def _hub_pairs(keyed: DataFrame, last: bool, num: int, den: int, near: Column | None = None) -> DataFrame:
    """Each member of a key with one member of it: the one with the fewest rare tokens, as it is near the most, or the largest id.

    near: what else must hold of bits and bits_o, the members' and the hub's.
    """
    more = ["bits"] if near is not None else []
    hub = F.max(F.struct("id", "size", "comp", *more)) if last else F.min(F.struct("rare", "id", "size", "comp", *more))
    hubs = keyed.groupBy("key").agg(hub.alias("hub")).select("key", F.col("hub.id").alias("other"), *(F.col(f"hub.{c}").alias(f"{c}_o") for c in ("size", "comp", *more)))
    apart = (F.col("comp") != F.col("comp_o")) & _near_sizes("size", "size_o", num, den)
    return _pairs(keyed.join(materialize(hubs, "hubs"), "key").where(apart if near is None else apart & near))


def _rest_pairs(keyed: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs within a key whose components differ, but those whose sizes or bits rule a link out.

    Members of the key's first component take no part among themselves: the others, in blocks, meet everyone.
    """
    main = keyed.groupBy("key").agg(F.min("comp").alias("main"))
    marked = keyed.join(main, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).cast("int"))
    asking = marked.where("comp <> main").select("key", "block", "id", "size", "bits", "comp")
    blocks = asking.select("key", F.col("block").alias("asked_by")).distinct()
    facing = marked.join(blocks, "key").select("key", F.col("asked_by"), "block", F.col("id").alias("other"), F.col("size").alias("size_o"), F.col("bits").alias("bits_o"), F.col("comp").alias("comp_o"))
    met = asking.withColumnRenamed("block", "asked_by").join(facing, ["key", "asked_by"])
    return _pairs(met.where((F.col("comp") != F.col("comp_o")) & _near_sizes("size", "size_o", num, den) & _near_bits(num, den)), "id")


def linked(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, _r1, _r2, _rid, n_shingles, comp (same in a component, null for empty sets) for each row of docs."""
    sets = materialize(_sets(docs, _frequent_tokens(docs, n, num, den, frequent), n, num, den), "sets")
    classes = materialize(sets.where("n_shingles > 0").groupBy("sig").agg(F.min("_rid").alias("id"), F.count(F.lit(1)).alias("copies")), "sigs")
    reps = sets.select("_rid", "n_shingles", "bits", "prefix", "kind").join(classes, F.col("_rid") == F.col("id")).select("id", F.col("n_shingles").alias("size"), "bits", "prefix", "kind")
    reps = materialize(reps, "classes")
    slim = materialize(sets.drop("bits", "prefix", "kind"), "rows")  # the classes have the rest
    release(sets)
    sets = slim
    keyed = materialize(_keyed(reps, num, den), "keys")
    links, tried, comps, texts, passing = None, None, None, None, []
    for step in ("first", "last", "rest"):
        mixed = materialize(_labelled(keyed, comps), "mixed")
        release(keyed)  # keys of one component never come back
        keyed = mixed
        pairs = _rest_pairs(mixed.where("n > 2").join(reps.select("id", "bits"), "id"), num, den) if step == "rest" else _hub_pairs(mixed, step == "last", num, den)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        likely = materialize(_likely(pairs, reps, num, den), "likely")
        ids = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct()
        more = _texts(docs, sets, ids if texts is None else ids.join(texts.select("id"), "id", "left_anti"))
        texts = more if texts is None else texts.unionByName(more)
        found = _verified(likely, texts, n, num, den)
        release(likely)
        tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
        links = found if links is None else links.unionByName(found)
        passing += [pairs, more, found]
        if found.limit(1).count():
            if comps is not None:
                release(comps)
            comps = components(links)
    release(keyed, reps, *passing)
    return _labels(sets, classes, comps)


def _labels(sets: DataFrame, classes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """sets with comp in place of sig, as a table; what it is made of goes."""
    of_class = classes.withColumn("comp", F.col("id")) if comps is None else classes.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    out = materialize(join_counted(sets, of_class.select("sig", "comp", "copies"), ["sig"], "copies", "left").drop("sig", "copies"), "linked")
    release(sets, classes, *([comps] if comps is not None else []))
    return out


def component_ids(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) for each row of docs."""
    return smallest_ids(linked(docs, n, num, den))


def smallest_ids(found: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of linked()."""
    found = found.select("doc_id", "n_shingles", "comp")
    smallest = found.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    return join_counted(found, smallest, ["comp"], "rows", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs, one of each component (that with the smallest doc_id), and all without words."""
    found = linked(docs, n, num, den).where("comp is not null")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), "_r1", "_r2")
    first = found.groupBy("comp").agg(F.min(order).alias("first")).select("first._r1", "first._r2")
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = _row_key(docs.where(worded).select("doc_id", "text", F.struct("*").alias("row"))).select("_r1", "_r2", "row")
    kept = rows.join(materialize(first, "kept"), ["_r1", "_r2"]).groupBy("_r1", "_r2").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return kept.select("row.*").unionByName(docs.where(~worded))
