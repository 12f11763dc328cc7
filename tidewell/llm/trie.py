"""Conversation prefix trie by LCP-aware external mergesort.

A conversation is a sequence of turns, and a turn here is SYMBOL bytes: 16 of the SHA-256 of role and text, 4 of the text's
length. Sequences are sorted as bytes; which order turns have among each other doesn't matter for a trie, only that equal
prefixes stand together. All prefixes of a depth that a set of conversations share are one node.

Sort: each task sorts what it reads in runs of bounded size. A run carries the LCP (in turns) of each sequence with the one
before and only the turns behind it, so shared turns are neither sent nor compared again. Splitters, drawn from a sample of
sequences with their ids, cut runs into ranges of about RANGE_BYTES; a group of equal conversations is cut by its ids, so no
range is hot. A task merges the runs of its range by a loser tree that compares LCPs first and turns only where LCPs tie.

Trie: the merged stream, with its LCPs, keeps the open path on a stack. A node is finished when the stream leaves it: it then
knows its members, leaves and tokens, goes out, and is added to its parent. Nodes on the first and the last path of a range
may go on in its neighbours: of these only what lies strictly inside the range goes out, one row a turn, and one small
task (two paths a range, whatever the number of conversations) runs the same stack over them. Ids of conversations that end
in a node are hashed where the node is finished; ids of a node that several ranges share, or of one with many, go out in
blocks as text and are hashed in order, streaming. Parents' ids are found by a join on node numbers in which a parent of very
many children is broadcast.

Defined results: rows without conv_id belong to no conversation; null role and text are ''; turns of a conversation
without number come first; equal turn numbers are ordered by the turn's hash, and repeated rows are turns of their own; a
conversation of any length is one record of SYMBOL bytes a turn, texts of any length are only hashed; a table without
conversations has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, release

SYMBOL, HASH = 20, 16
#: Bytes of sequences in a run, in a range of the merge; sampled sequences for each range; ids in a block of ends.
RUN_BYTES, RANGE_BYTES, SAMPLE, BLOCK = 16 << 20, 8 << 20, 16, 8_192
#: Conversations of a family share up to so many turns.
FAMILY, MOST_SHARED = 5, 8


# ---- sequences


def sequences(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """conv_id and seq (SYMBOL bytes a turn) of each conversation.

    rebuild: conversation c starts with the first h turns of conversation c - c % 5, then come its own behind its first h;
    h = crc32(c) % 9. Rows of a family are sorted with that conversation first, of which only 8 turns are held.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * HASH)
    symbol = F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 2 * (SYMBOL - HASH), "0")))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", symbol.alias("symbol"))
    rows = rows.withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}")).repartition("base")
    rows = rows.sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "symbol").select("base", "conv_id", "symbol")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, conv, own, head = None, None, [], []
        ids, seqs, size = [], [], 0

        def ended() -> None:
            nonlocal size
            shared = zlib.crc32(str(conv).encode()) % (MOST_SHARED + 1) if rebuild else 0
            if conv == base:
                head[:] = own[:MOST_SHARED]
            ids.append(conv)
            seqs.append(b"".join([*head[:shared], *own[shared:]]))
            size += len(seqs[-1])

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seqs, pa.binary())], names=["conv_id", "seq"])

        for b in batches:
            for family, c, symbol in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != conv:
                    if conv is not None:
                        ended()
                        if size > RUN_BYTES or len(ids) >= 50_000:
                            yield sent()
                            ids, seqs, size = [], [], 0
                    own = []
                    if family != base:
                        base, head = family, []
                    conv = c
                own.append(symbol)
        if conv is not None:
            ended()
        yield sent()

    return rows.mapInArrow(run, "conv_id bigint, seq binary")


# ---- sort


def lcp(a: bytes, b: bytes, at: int = 0) -> int:
    """Turns that a and b have in common from the start; at: so many are known to be equal."""
    most = min(len(a), len(b)) // SYMBOL
    step = 1
    while at < most:  # doubling steps while equal, then halving ones
        end = min(at + step, most)
        if a[at * SYMBOL : end * SYMBOL] == b[at * SYMBOL : end * SYMBOL]:
            at, step = end, 2 * step
        elif step == 1:
            return at
        else:
            step = max(1, min(step, most - at) // 2)
            most = end - 1 if end - at == 1 else most
    return at


class Run:
    """A sorted run as it was sent: ids, LCPs, lengths in turns, and the turns behind each LCP."""

    def __init__(self, ids: list[int], lcps: list[int], sizes: list[int], tail: bytes) -> None:
        self.ids, self.lcps, self.sizes, self.tail, self.i, self.at, self.seq = ids, lcps, sizes, tail, -1, 0, b""

    def step(self) -> tuple[bytes, int, int] | None:
        """The next sequence, its id, and its LCP with the one before in this run."""
        self.i += 1
        if self.i == len(self.ids):
            return None
        h, size = self.lcps[self.i], self.sizes[self.i]
        end = self.at + (size - h) * SYMBOL
        self.seq, self.at = self.seq[: h * SYMBOL] + self.tail[self.at : end], end
        return self.seq, self.ids[self.i], h


def front_coded(rows: list[tuple[bytes, int]]) -> tuple[list[int], list[int], list[int], bytes]:
    """What Run takes, for sorted rows."""
    lcps, before = [], b""
    for seq, _ in rows:
        lcps.append(lcp(before, seq))
        before = seq
    return [i for _, i in rows], lcps, [len(s) // SYMBOL for s, _ in rows], b"".join(s[h * SYMBOL :] for (s, _), h in zip(rows, lcps, strict=True))


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, int]]:
    """Sequences of all runs in order, each with its id and its LCP with the sequence before.

    A loser tree: inner nodes 1..k-1 hold the run that lost there and its LCP with the winner. A run steps on after its
    sequence went out, so its LCP and those on its way to the root are all with that sequence: the larger LCP wins, and only
    equal ones make sequences be compared, behind the LCP.
    """
    k = len(runs)
    now = [r.step() for r in runs]
    h = [0] * k

    def beats(a: int, b: int) -> bool:
        x, y = now[a], now[b]
        if x is None or y is None:
            return x is not None
        if h[a] != h[b]:
            return h[a] > h[b]
        at = lcp(x[0], y[0], h[a])
        mine, other = x[0][at * SYMBOL : (at + 1) * SYMBOL], y[0][at * SYMBOL : (at + 1) * SYMBOL]
        wins = mine < other if mine != other else x[1] < y[1]
        h[b if wins else a] = at
        return wins

    tree = [0] * k
    level = {k + i: i for i in range(k)}
    for node in range(k - 1, 0, -1):  # leaves are nodes k..2k-1
        a, b = level.pop(2 * node), level.pop(2 * node + 1)
        level[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    winner = level[1] if k > 1 else 0
    while k and now[winner] is not None:
        seq, own, _ = now[winner]
        yield seq, own, h[winner]
        now[winner] = runs[winner].step()
        if now[winner]:
            h[winner] = now[winner][2]
        node = (k + winner) // 2
        while node:
            if not beats(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2


def _sorted_runs(seqs: DataFrame, splitters: list[tuple[bytes, int]]) -> DataFrame:
    """range, ids, lcps, sizes, tail: the sorted runs of each task, cut at the splitters."""
    shared = seqs.sparkSession.sparkContext.broadcast(splitters)

    def sent(rows: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
        rows.sort()
        start = 0
        while start < len(rows):
            r = bisect_right(shared.value, rows[start])
            end = len(rows) if r == len(shared.value) else _first_from(rows, shared.value[r], start)
            ids, lcps, sizes, tail = front_coded(rows[start:end])
            columns = [pa.array([r], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([lcps], pa.list_(pa.int32())), pa.array([sizes], pa.list_(pa.int32())), pa.array([tail], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "ids", "lcps", "sizes", "tail"])
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for own, seq in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows.append((seq, own))
                size += len(seq) + 64
                if size > RUN_BYTES:
                    yield from sent(rows)
                    rows, size = [], 0
        yield from sent(rows)

    return seqs.select("conv_id", "seq").mapInArrow(run, "range int, ids array<bigint>, lcps array<int>, sizes array<int>, tail binary")


def _first_from(rows: list[tuple[bytes, int]], splitter: tuple[bytes, int], start: int) -> int:
    low, high = start, len(rows)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if rows[mid] >= splitter else (mid + 1, high)
    return low


# ---- trie


class _Open:
    """A node on the open path: its number, and what is known of it so far. edge: it may go on in another range."""

    __slots__ = ("blocks", "conv", "edge", "ends", "kids", "leaves", "n", "no", "saved", "symbol")

    def __init__(self, symbol: bytes, no: int, edge: bool) -> None:
        self.symbol, self.no, self.edge = symbol, no, edge
        self.conv, self.n, self.kids, self.leaves, self.saved, self.ends, self.blocks = None, 0, 0, 0, 0, [], 0

    def take(self, conv: int | None, n: int, kids: int, leaves: int, saved: int) -> None:
        self.conv = conv if self.conv is None else self.conv if conv is None else min(self.conv, conv)
        self.n, self.kids, self.leaves, self.saved = self.n + n, self.kids + kids, self.leaves + leaves, self.saved + saved

    def finish(self) -> None:
        """All members are known: counts itself."""
        self.leaves += not self.kids
        self.saved += (self.n - 1) * int.from_bytes(self.symbol[HASH:])

    def passed(self) -> tuple[int | None, int, int, int, int]:
        return self.conv, self.n, 1, self.leaves, self.saved


#: kind: a finished node ('node'), a node of a range's first or last path ('edge'; side), a block of ids ('ends').
_ROWS = "kind string, range int, side int, no bigint, parent bigint, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, bytes binary"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
_TYPES = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in _ROWS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else [pa.array([], t) for t in _TYPES], names=_NAMES)


def _ids(ends: list[int], first: bool) -> bytes:
    return (b"" if first else b",") + ",".join(map(str, ends)).encode()


def _of_range(r: int, stream: Iterable[tuple[bytes, int, int]]) -> Iterator[tuple]:
    """The rows of _ROWS that a range's sorted sequences give."""
    path, made, first = [_Open(b"", 0, True)], 1, True

    def ends(node: _Open) -> tuple:
        row = ("ends", r, node.blocks, node.no, None, None, None, None, None, None, None, None, _ids(node.ends, not node.blocks))
        node.blocks, node.ends = node.blocks + 1, []
        return row

    def edge(node: _Open, depth: int, side: int) -> Iterator[tuple]:
        if node.ends:
            yield ends(node)
        yield ("edge", r, side, node.no, None, node.conv, depth, node.n, node.kids, node.leaves, node.saved, None, node.symbol)

    def close() -> Iterator[tuple]:
        node, depth = path.pop(), len(path)
        if node.edge:
            yield from edge(node, depth, 0)
            return
        node.finish()
        digest = hashlib.sha256(_ids(node.ends, True)).hexdigest() if not node.blocks else None
        if node.blocks and node.ends:
            yield ends(node)
        yield ("node", r, None, node.no, path[-1].no, node.conv, depth, node.n, node.kids, node.leaves, node.saved, digest, None)
        path[-1].take(*node.passed())

    for seq, conv, h in stream:
        while len(path) - 1 > h:
            yield from close()
        for at in range(len(path) - 1, len(seq) // SYMBOL):
            path.append(_Open(seq[at * SYMBOL : (at + 1) * SYMBOL], made, first))
            made += 1
        first = False
        top = path[-1]
        top.take(conv, 1, 0, 0, 0)
        top.ends.append(conv)
        if len(top.ends) >= BLOCK:
            yield ends(top)
    for depth, node in enumerate(path):  # the last path; what it shares with the first one goes with that
        if node.edge:
            yield from edge(node, depth, 0)
        yield from edge(node, depth, 1) if not node.edge else [("edge", r, 1, None, None, None, depth, 0, 0, 0, 0, None, node.symbol)]


def _of_edges(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Finished nodes, in range -1, and for each (range, no) of an edge row which of them it is (kind 'alias', parent: its number).

    rows: (range, no, conv, depth, n, kids, leaves, saved, symbol) by range, side and depth, so that paths are in order.
    """
    path: list[_Open] = []
    aliases: dict[int, list[tuple[int, int, int]]] = {}
    made = 0

    def close() -> Iterator[tuple]:
        node, depth = path.pop(), len(path)
        inner = node.kids
        node.finish()
        yield ("node", -1, None, node.no, path[-1].no if path else None, node.conv, depth, node.n, inner, node.leaves, node.saved, None, None)
        for r, no, kids in aliases.pop(node.no, []):
            yield ("alias", r, None, no, node.no, node.conv, None, None, kids, None, None, None, None)
        if path:
            path[-1].take(*node.passed())

    for r, no, conv, depth, n, kids, leaves, saved, symbol in rows:
        if depth < len(path) and path[depth].symbol != symbol:
            while len(path) > depth:
                yield from close()
        if depth == len(path):
            path.append(_Open(symbol, made, True))
            made += 1
        path[depth].take(conv, n, kids, leaves, saved)
        if no is not None:
            aliases.setdefault(path[depth].no, []).append((r, no, kids))
    while path:
        yield from close()


def _in_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= 8_192:
            yield _batch(held)
            held = []
    yield _batch(held)


def _merge_ranges(runs: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def rows() -> Iterator[tuple]:
            yield from _of_range(now, merged(held))

        for b in batches:
            for r, *coded in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r != now:
                    if held:
                        yield from _in_batches(rows())
                    now, held = r, []
                held.append(Run(*coded))
        if held:
            yield from _in_batches(rows())

    return runs.repartitionById(ranges, "range").sortWithinPartitions("range").mapInArrow(run, _ROWS)


def _hashed_ends(blocks: DataFrame) -> DataFrame:
    """range, no, sha of the ids in blocks (range, no; from_range, side: their order), each in order of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        for b in batches:
            for r, no, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (r, no) != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (r, no), hashlib.sha256()
                    text = text.lstrip(b",")
                elif not text.startswith(b","):
                    text = b"," + text
                digest.update(text)
        if now:
            out.append((*now, digest.hexdigest()))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.string()), strict=True)], names=["range", "no", "sha"])

    return blocks.repartition("range", "no").sortWithinPartitions("range", "no", "from_range", "side").select("range", "no", "bytes").mapInArrow(run, "range int, no bigint, sha string")


def prefix_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """The nodes of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    seqs = materialize(sequences(turns, rebuild), "sequences")
    n, size = seqs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("seq")), F.lit(0))).first()
    ranges = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))))
    every = max(1, n // (SAMPLE * ranges))
    sample = sorted((bytes(r.seq), r.conv_id) for r in seqs.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select("seq", "conv_id").toLocalIterator())
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []

    found = materialize(_merge_ranges(_sorted_runs(seqs, splitters), len(splitters) + 1), "trie")
    release(seqs)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(_of_edges(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)))

    rows = found.where("kind = 'edge'").repartition(1).sortWithinPartitions("range", "side", "depth")
    rows = rows.select("range", "no", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes")
    joint = materialize(rows.mapInArrow(edges, _ROWS), "trie-edges")
    columns = ["range", "no", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    aliases = joint.where("kind = 'alias'")

    blocks = found.where("kind = 'ends'").select("range", "no", "side", "bytes")
    to = aliases.select("range", "no", F.col("parent").alias("joint"))
    of_node = blocks.join(to, ["range", "no"], "left").select(
        F.when(F.col("joint").isNull(), F.col("range")).otherwise(F.lit(-1)).alias("range"), F.coalesce("joint", "no").alias("no"), F.col("range").alias("from_range"), "side", "bytes")
    nodes = found.where("kind = 'node'").select(*columns).unionByName(joint.where("kind = 'node'").select(*columns))
    none = hashlib.sha256(b"").hexdigest()
    nodes = nodes.join(_hashed_ends(of_node), ["range", "no"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha", F.lit(none))).drop("sha")
    nodes = materialize(nodes, "nodes")

    # What children call their parent: a node of their own range, an edge of it, or a joint node.
    kin = nodes.where("parent is not null").groupBy("range", "parent").agg(F.count(F.lit(1)).alias("children"))
    called = nodes.select("range", F.col("no").alias("parent"), F.col("conv_id").alias("parent_conv_id")).unionByName(aliases.select("range", F.col("no").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    out = join_counted(nodes, kin.join(called, ["range", "parent"]), ["range", "parent"], "children", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
