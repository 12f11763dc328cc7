"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct n-word shingles; two link when the intersection is at least num / den of the union.
Equal sets are one class. A class has COORDINATES minwise tokens: for each of so many hash functions the least hash of its shingles.
Two sets agree in a coordinate with their similarity as probability.

Independent trees: tree t's root deals all classes by coordinate t, so a node holds the classes that chose the same token. A node
is done when its classes are one component, or when few of them (SMALL) are outside its main component: those are compared with
all others of the node. A node that isn't branches: a hash of the node selects one coordinate, or two with the probability that
makes den / num children on average, and its classes go to a child for each token they choose. Classes that only share a common
passage part ways, similar ones stay together; after DEEPEST levels, or as soon as its blocks hold no more than one row for each
FEW classes, what is left is compared in blocks, whatever its size. A class is sent to SIDE blocks of a node at most, which
bounds the rows; comparisons of what is left after DEEPEST levels grow with the square of its nodes.

Each node's classes are first verified against one of them, the hub: the class that meets the most others over all nodes, so
near copies have the same hub in all trees, give one pair a member and are one component then. Compared pairs are only formed if their sketches (4 bits of each coordinate) agree in
so many places as all but one in 10^5 linked pairs at the bar do, and their parities (BITS bits, as in the n-gram join) differ in no
more bits than linked sets differ in tokens: of sets under a few hundred tokens that leaves little but links, however many of
them nearly link. All formed pairs are verified on the whole texts' sets.

Recall: a pair of similarity s stays together through k branchings with probability q(k), q(0) = 1, q(k) = 1 - E[(1 - s q(k - 1))^c] for c
children, so the number of trees is the least that finds a pair at the bar with probability RECALL even on the deepest level.
Pairs that part on a shallow level, nearly all, are missed with probability (1 - s)^trees: under 10^-8 with 11 trees.

Defined results: as of the n-gram Jaccard join: null texts and texts without words have an empty set, link with nothing and
are their own component; under n words the whole sequence is one shingle; rows that repeat a doc_id count as one node if their
texts link and keep their row each; a null doc_id is the smallest of a component only if all are null; texts of any length are
read whole; an empty table gives an empty result. Only doc_id and text are read. Reruns agree: all choices are hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release
from .jaccard import BITS, ROWS, _hub_pairs, _labelled, _labels, _near_bits, _near_sizes, _pairs, _row_key, _texts, _verified, components, parities, smallest_ids, tokens

COORDINATES, SMALL, DEEPEST, RECALL, BLOCK, SIDE, FEW = 64, 128, 3, 0.9999, 1_024, 16, 16
#: Chance that a pair at the bar is apart in more places of its sketch than most_apart() allows.
SKETCH_MISS = 1e-5
_SEEDS = np.random.default_rng(13).integers(1 << 63, size=(2, COORDINATES), dtype=np.uint64) | np.uint64(1)


def minwise(all_tokens: np.ndarray) -> np.ndarray:
    """COORDINATES 32-bit hashes: the least of each hash function over the set."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(all_tokens), 4_096):
        x = all_tokens[at : at + 4_096, None] * _SEEDS[0] + _SEEDS[1]
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
    # The least hash of a large set has leading zeros: its middle bits tell it apart.
    return (least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def sketch(coordinates: np.ndarray) -> np.ndarray:
    """4 bits of each coordinate, 16 coordinates a 64-bit number."""
    bits = (coordinates.astype(np.uint64) >> np.uint64(28)).reshape(-1, 16)
    return (bits << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


@lru_cache(maxsize=8)
def most_apart(num: int, den: int) -> int:
    """In how many coordinates a linked pair's sketches differ at most, but once in 1 / SKETCH_MISS pairs at the bar."""
    p, below = (1 - num / den) * 15 / 16, 0.0
    for k in range(COORDINATES + 1):
        below += comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if 1 - below < SKETCH_MISS:
            return k
    return COORDINATES


def kept_together(similarity: float, levels: int) -> float:
    """Probability that two classes of this similarity share a node after so many branchings of one that they share."""
    q, two = 1.0, 1 / similarity - 1
    for _ in range(levels):
        apart = 1 - similarity * q
        q = 1 - ((1 - two) * apart + two * apart * apart)
    return q


def trees(num: int, den: int, levels: int = DEEPEST, recall: float = RECALL) -> int:
    """The least number of trees that finds a pair at the bar with probability recall when nodes branch so often."""
    s, n = num / den, 1
    found = s * kept_together(s, levels)
    while (1 - found) ** n > 1 - recall:
        n += 1
    return n


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, _r1, _r2, _rid, n_shingles, sig (identity of the set), chosen (minwise tokens), bits (parities, then the sketch) of each row."""
    keep = ["doc_id", "_r1", "_r2", "_rid"]
    rows = _row_key(docs.select("doc_id", "text")).withColumn("_rid", F.monotonically_increasing_id()).select(*keep, "text")
    schema = rows.select(*keep, F.lit(0).cast("long").alias("n_shingles"), F.lit(b"").alias("sig"), F.array(F.lit(0)).alias("chosen"), F.array(F.lit(0).cast("long")).alias("bits")).schema
    words = (BITS + 4 * COORDINATES) // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                sets = [tokens(t, n) for t in b.column(4).to_pylist()]
                chosen = [minwise(s) for s in sets]
                lists = [pa.ListArray.from_arrays(pa.array(range(0, k * len(sets) + 1, k), pa.int32()), pa.array(np.concatenate(x))) for k, x in ((COORDINATES, [c.view(np.int32) for c in chosen]), (words, [x for s, c in zip(sets, chosen, strict=True) for x in (parities(s), sketch(c))]))]
                sigs = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([len(s) for s in sets], pa.int64()), sigs, *lists], names=[*keep, "n_shingles", "sig", "chosen", "bits"])

    return rows.mapInArrow(run, schema)


def _near_sketches(num: int, den: int) -> Column:
    """The sets (size, bits and size_o, bits_o) may link: no more coordinates differ than most_apart(), and no more parities than tokens may."""
    apart = F.lit(0)
    for i in range(BITS // 64, (BITS + 4 * COORDINATES) // 64):
        x = F.col("bits")[i].bitwiseXOR(F.col("bits_o")[i])
        half = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        apart = apart + F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(F.lit(0x1111111111111111)))
    return (apart <= most_apart(num, den)) & _near_bits(num, den)


def _roots(reps: DataFrame, n_trees: int) -> DataFrame:
    """key, id, size: the nodes below the roots of all trees."""
    each = [F.struct(F.xxhash64(F.lit(t), F.col("chosen")[t]).alias("key")) for t in range(n_trees)]
    return reps.select(F.explode(F.array(*each)).alias("node"), "id", "size").select("node.key", "id", "size")


def _children(nodes: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """The children of nodes (key, id, size): one coordinate each, or two so often that there are den / num on average."""
    first = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(COORDINATES)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("key", F.lit(2)), F.lit(COORDINATES - 1)), F.lit(COORDINATES)).cast("int")
    both = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1_000_000)) < round(1_000_000 * (den / num - 1))
    paths = nodes.withColumn("coordinate", F.explode(F.when(both, F.array(first, second)).otherwise(F.array(first))))
    met = paths.join(reps.select("id", "chosen"), "id")
    return met.select(F.xxhash64("key", "coordinate", F.col("chosen")[F.col("coordinate")]).alias("key"), "id", "size")


def _settled(nodes: DataFrame) -> DataFrame:
    """nodes (key, id, size, comp, n) with main, the component that most of the node's classes are in, and outside, how many aren't."""
    of_comp = nodes.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("members"))
    main = of_comp.groupBy("key").agg(F.max(F.struct("members", "comp")).alias("top"), F.sum("members").alias("all"))
    main = main.select("key", F.col("top.comp").alias("main"), (F.col("all") - F.col("top.members")).alias("outside"))
    return nodes.join(materialize(main, "mains"), "key")


def near_pairs(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in x and y (size, comp, bits by row) of the pairs of different components that sizes, parities and sketches allow a link."""
    (s, of, u), (t, to, v), words = x, y, BITS // 64
    apart, by_word = np.zeros((len(s), len(t)), np.uint16), np.ascontiguousarray(v[:, :words].T)
    for at in range(0, len(s), 64):  # so few that they stay in the processor's cache
        for w in range(words):
            apart[at : at + 64] += np.bitwise_count(u[at : at + 64, w, None] ^ by_word[w])
    may = apart <= (s[:, None] + t) * (den - num) // (num + den)
    may &= (s[:, None] * den >= t * num) & (t * den >= s[:, None] * num) & (of[:, None] != to)
    i, j = np.nonzero(may)
    differ = u[i, words:] ^ v[j, words:]
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    few = np.bitwise_count(differ & np.uint64(0x1111111111111111)).sum(axis=1) <= most_apart(num, den)
    return i[few], j[few]


def _blocks(rows: str) -> Column:
    """In how many blocks so many rows of a node are dealt: of BLOCK rows, but SIDE blocks at most."""
    return F.least(F.ceil(F.col(rows) / BLOCK), F.lit(SIDE)).cast("int")


def _compared(nodes: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of each class outside its node's main component with all other components of the node, if sizes and bits allow a link.

    A node's classes are dealt in blocks, and each block of asking classes meets each block of all classes: the asking ones come first.
    Within a task BLOCK rows meet BLOCK rows at a time; only the asking block is held.
    """
    marked = nodes.join(reps.select("id", "bits"), "id")
    asks, faces = _blocks("outside"), _blocks("n")
    own = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    asking = marked.where("comp <> main").select("key", own(asks, 0).alias("asked"), each(faces).alias("faced"), F.lit(0).alias("faces"), "id", "size", "comp", "bits")
    facing = marked.select("key", each(asks).alias("asked"), own(faces, 1).alias("faced"), F.lit(1).alias("faces"), "id", "size", "comp", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first = None, []
        for b in batches:
            group = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(4)], 1)
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist(), len(group)]
            ids, size, comp = (b.column(i).to_numpy() for i in (4, 5, 6))
            bits = b.column(7).flatten().to_numpy().view(np.uint64).reshape(len(group), -1)
            left, right = [ids[:0]], [ids[:0]]
            for i, j in zip(edges[:-1], edges[1:], strict=True) if len(group) else ():
                *node, faces = group[i].tolist()
                if node != at:
                    at, first = node, []
                for cut in (slice(row, min(row + BLOCK, j)) for row in range(i, j, BLOCK)):
                    met, *rest = ids[cut], size[cut], comp[cut], bits[cut]
                    if not faces:
                        first.append((met, *rest))
                    for asked, *x in first if faces else ():
                        m, k = near_pairs(tuple(x), tuple(rest), num, den)
                        left.append(asked[m])
                        right.append(met[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["id", "other"])

    rows = asking.unionByName(facing).repartition("key", "asked", "faced").sortWithinPartitions("key", "asked", "faced", "faces")
    return _pairs(rows.mapInArrow(run, "id bigint, other bigint"), "id")


def linked(docs: DataFrame, n: int = 5, num: int = 85, den: int = 100, n_trees: int | None = None, small: int = SMALL, deepest: int = DEEPEST) -> DataFrame:
    """doc_id, _r1, _r2, _rid, n_shingles, comp (same in a component, null for empty sets) for each row of docs, as a table."""
    sets = materialize(_sets(docs, n), "sets")
    classes = materialize(sets.where("n_shingles > 0").groupBy("sig").agg(F.min("_rid").alias("id"), F.count(F.lit(1)).alias("copies")), "sigs")
    # Different sets link only if a set can lack a shingle: num <= den * (u - 1) / u for the union's size u, and a class has u - 1 at least.
    smallest = -(-den // (den - num)) - 1 if num < den else 1 << 62
    reps = sets.select("_rid", "n_shingles", "chosen", "bits").join(classes, F.col("_rid") == F.col("id")).where(F.col("n_shingles") >= smallest)
    reps = materialize(reps.select("id", F.col("n_shingles").alias("size"), "chosen", "bits"), "classes")
    rows = materialize(sets.drop("chosen", "bits"), "rows")
    release(sets)

    n_trees = n_trees or trees(num, den, deepest)
    nodes = materialize(_roots(reps, n_trees), "nodes")
    links, tried, comps, texts, passing = None, None, None, None, []

    def verify(pairs: DataFrame) -> None:
        nonlocal links, tried, comps, texts
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if not pairs.limit(1).count():
            release(pairs)
            return
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        more = _texts(docs, rows, ids if texts is None else ids.join(texts.select("id"), "id", "left_anti"))
        texts = more if texts is None else texts.unionByName(more)
        found = _verified(pairs, texts, n, num, den)
        tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
        links = found if links is None else links.unionByName(found)
        passing.extend([pairs, more, found])
        if found.limit(1).count():
            if comps is not None:
                release(comps)
            comps = components(links)

    def still_mixed() -> DataFrame:
        nonlocal nodes
        mixed = materialize(_labelled(nodes, comps), "mixed")
        release(nodes)
        nodes = mixed
        return mixed

    def of_hubs(mixed: DataFrame) -> DataFrame:
        # The class that meets the most others over all nodes is each of its nodes' hub: near copies share one hub, and its pairs.
        central = mixed.groupBy("id").agg((-F.sum("n")).alias("rare"))
        return _hub_pairs(mixed.join(central, "id").join(reps.select("id", "bits"), "id"), False, num, den, _near_sketches(num, den))

    verify(of_hubs(still_mixed()))
    classes_ = reps.count()
    for level in range(deepest + 1):
        settled = materialize(_settled(still_mixed()), "settled")
        deep = settled.where(F.col("outside") > small)
        in_blocks = F.max(F.col("n") * _blocks("outside") + F.col("outside") * _blocks("n"))
        left = deep.groupBy("key").agg(in_blocks.alias("rows")).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if level == deepest or left * FEW <= classes_:  # the last, whatever its size
            if left:  # near copies that no hub has connected yet: one pair a member first
                verify(of_hubs(deep))
                release(settled)
                settled = materialize(_settled(still_mixed()), "settled")
            verify(_compared(settled, reps, num, den))
            release(settled)
            break
        verify(of_hubs(deep).unionByName(_compared(settled.where(F.col("outside") <= small), reps, num, den)).groupBy("a", "b").agg(F.max("from_a").alias("from_a")))
        release(nodes)
        nodes = materialize(_children(deep, reps, num, den), "nodes")
        release(settled)
    release(nodes, reps, *passing)
    return _labels(rows, classes, comps)


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component), kept (doc_id is that one) for each row of docs."""
    found = smallest_ids(linked(docs, n, num, den))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
