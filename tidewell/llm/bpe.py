"""BPE encoding and decoding over a contiguous rank array.

A text is cut by the vocabulary's split pattern. Each piece holds its parts in one array and the ranks of adjacent
parts in another; the smallest rank is found by a scan, its boundary deleted, and the two neighbouring ranks refreshed,
until no adjacent pair is in the merge table. The scan is quadratic, so pieces over LONG bytes use a heap over the same
ranks with the same result. Results per unit (a run of white space and the run of text after it; no piece crosses
units) are kept per task, up to MEMO units.

Defined results: a null text is an empty one: no ids, empty decoded text. Special tokens inside a text become their id.
Rows that repeat are encoded each. Texts of any length are encoded whole, piece by piece.
An empty table gives an empty result. Extra columns pass through untouched.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG, MEMO, ROWS, NONE = 256, 600_000, 256, 1 << 62
# The split pattern of the vocabulary, with Unicode's White_Space spelled out.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
RARE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.first = [0] * 256
        for c, b in letters.items():
            self.first[b] = vocab[c]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks, self.made = {}, []  # both ids in one integer -> rank; rank -> merged id
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *special.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in special.items():
            spelled[i] = token.encode()
        self.special = special
        self.first_ids, self.made_ids = np.array(self.first), np.array(self.made)
        keys = np.array([*self.ranks], np.int64)
        self.pair_ranks = keys.argsort()
        self.pair_keys = keys[self.pair_ranks]
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.concatenate([[0], self.lengths.cumsum()[:-1]])
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.units, self.pieces = re.compile(UNITS), regex.compile(PIECES)
        self.memo: dict = {}
        self.before: dict = {}  # the half of the memo filled before this one: what is met again moves over, the rest goes

    def merge(self, word: bytes) -> list[int]:
        """The ids of one piece, by scans of its rank array."""
        parts = [self.first[b] for b in word]
        if len(parts) > LONG:
            return self._merge_long(parts)
        get, made = self.ranks.get, self.made
        ranks = [get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < NONE:
            i = ranks.index(least)
            parts[i : i + 2] = [new] = [made[least]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | new, NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, live = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (rank := self.ranks.get(parts[i] << 32 | parts[after[i]], NONE)) < NONE:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if live[i] else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], live[j], after[i] = self.made[rank], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p, alive in zip(parts, live, strict=True) if alive]

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """merge() of many pieces at once: a row of parts and a row of ranks for each, side by side."""
        out: list = [None] * len(words)
        sizes = np.array([len(w) for w in words])
        for low, high in ((0, 8), (8, 12), (12, 18), (18, 32), (32, 64)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(rows), 8192):
                self._merge_rows([words[i] for i in rows[at : at + 8192]], rows[at : at + 8192], high, out)
        for i in np.flatnonzero((sizes > 64) | (sizes == 0)):
            out[i] = np.array(self.merge(words[i]), "<u4")
        return out

    def _merge_rows(self, words: list[bytes], at: np.ndarray, width: int, out: list) -> None:
        n = np.array([len(w) for w in words])
        parts = np.full((len(words), width + 1), -1, np.int64)
        parts[np.arange(width + 1) < n[:, None]] = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.rank_of(parts[:, :-1], parts[:, 1:])
        cols = np.arange(width)
        while len(at):
            i = ranks.argmin(1)
            least = ranks[np.arange(len(at)), i]
            over = least == NONE
            if over.any():
                for k in np.flatnonzero(over):
                    out[at[k]] = parts[k, : n[k]].astype("<u4")
                go = ~over
                parts, ranks, at, n, i, least = parts[go], ranks[go], at[go], n[go], i[go], least[go]
                if not len(at):
                    return
            each = np.arange(len(at))
            new = self.made_ids[least]
            parts[each, i] = new
            left = cols + (cols > i[:, None])  # the boundary after i goes
            parts[:, :-1] = np.take_along_axis(parts, left, 1)
            parts[:, -1] = -1
            ranks[:, :-1] = np.take_along_axis(ranks, left[:, :-1], 1)
            ranks[:, -1] = NONE
            n -= 1
            ranks[each, i] = self.rank_of(new, parts[each, i + 1])
            back = np.flatnonzero(i)
            ranks[back, i[back] - 1] = self.rank_of(parts[back, i[back] - 1], new[back])

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == pair) & (b >= 0), self.pair_ranks[at], NONE)

    def _learn(self, units: set[str]) -> None:
        """Put the ids of units into the memo."""
        units_, pieces = list(units), [self.pieces.findall(u) for u in units]
        words = list({p for own in pieces for p in own})
        ids = dict(zip(words, (x.tobytes() for x in self.merge_many([w.encode() for w in words])), strict=True))
        self.memo.update(zip(units_, (b"".join([ids[p] for p in own]) for own in pieces), strict=True))

    def _cut(self, text: str) -> list[str]:
        """Units of a text: cut before each white space that follows text."""
        if "\0" in text or any(c in text for c in RARE) or any(c in text for c in ("  ", " \n", "\n ", "\n\n")):
            return self.units.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        cut = []
        for text in texts:
            own: list = []
            for k, part in enumerate(self.splits.split(text) if self.splits else [text]):
                own += [self.special[part]] if k % 2 else self._cut(part)
            cut.append(own)
        seen = set().union(*cut)
        fixed = {x: np.array([x], "<u4").tobytes() for x in seen if isinstance(x, int)}
        seen -= fixed.keys()
        if len(self.memo) + len(seen) > MEMO // 2:
            self.before, self.memo = self.memo, {}
        new = seen - self.memo.keys()
        again = new & self.before.keys()
        self.memo.update((u, self.before[u]) for u in again)
        new -= again
        self._learn(new)
        self.memo.update(fixed)
        return [b"".join(map(self.memo.__getitem__, own)) for own in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        n = self.lengths[ids]
        ends = n.cumsum()
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + n, n)
        return self.bytes[at].tobytes().decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The columns of docs but its text, and n_tokens, token_ids (binary: little-endian uint32), decoded (string).

    path: the vocabulary file, which each executor opens; a column of docs with one of the new names is replaced.
    """
    new = ("n_tokens", "token_ids", "decoded")
    keep = [c for c in docs.columns if c != "text" and c not in new]
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    schema = rows.select(*keep, F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("token_ids"), F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                packed = v.encode_many(b.column(b.num_columns - 1).to_pylist())
                out = [*b.columns[:-1], pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()), pa.array([v.decode(p) for p in packed], pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, *new])

    return rows.mapInArrow(run, schema)
