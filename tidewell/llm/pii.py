"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions, trained in numpy.

Rules give the base spans of four kinds; these always stay. The network adds spans that the rules do not form. It is trained
on the driver from labelled spans (labelled_texts(), a fixed seed) and reads every character of every text, in windows that
overlap. The scores of tags that two windows give a character are blended, the more weight the farther from its window's
edge, so that each text has one row of scores; one Viterbi path over that whole row, by the CRF's transitions, gives its
spans. An added span overlaps no base span, passes the exact test of its kind (holds()), and its confidence (the mean lead of its tags over the next best) reaches a bar
that is set on labelled texts held out of the training, where spans above it are right in PRECISION of the cases.

The path is exact although most characters are never searched. The transitions can be moved into
the scores so that none gains over no span; a span of the best path then can neither begin nor end with characters over which
no span leads in sum. Two running extrema over a text tell what can be in a span at all, and of that only stretches are
decoded that hold an @ or the digits of an ip, without which holds() lets nothing pass.

A character enters the network as the sum of two learned vectors: one of its class, one of the code point itself (ASCII: its
own; others: of a bucket of code points of its class). The weights are trained once and kept in the shared folder, by a
hash of this module's parameters and generator. A text takes about 40 bytes a character while it is read.

Defined results: a null or empty text has no spans (base_sha256 is that of no bytes); rows that repeat are read each; an
empty table gives an empty result; offsets count code points, ends exclusive; long texts are read in blocks of windows. Extra
columns pass through; a column named like one of the results gives way to it.
"""

from __future__ import annotations

import hashlib
import inspect
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import shared_dir

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract. The two that could rescan a run only start where a run starts.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_HERE, EMAIL_NEXT = re.compile(EMAIL), re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL)
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Characters a window and from one to the next in reading, characters a window in training; windows read at once; most texts at once.
WINDOW, STRIDE, CUT, BLOCK, ROWS = 512, 480, 64, 1_024, 256
#: Characters of texts read at once (a longer text is read alone), and characters by rows of stretches searched at once.
CHARS, AREA = 1 << 18, 1 << 17
HIDDEN, STEPS, BATCH, SEED, EXAMPLES, PRECISION = 10, 700, 48, 7, 3_000, 0.97
TAGS = 1 + 2 * len(KINDS)  # 0: none; 1 + 2k: begin of kind k; 2 + 2k: inside of kind k
# Punctuation marks with a class of their own; then digit, lower, upper, space, line break, other, pad.
MARKS = "@.-+()_%/:=,'\"#"
DIGIT, LOWER, UPPER, SPACE, BREAK, OTHER, PAD = range(len(MARKS), len(MARKS) + 7)
CLASSES = PAD + 1
#: Codes of characters: ASCII, then BUCKETS for each class of the others, then pad.
ASCII, BUCKETS = 128, 16
ALPHABET = ASCII + BUCKETS * len((DIGIT, LOWER, UPPER, SPACE, BREAK, OTHER)) + 1
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[Span]:
    """The spans of the rules, by start and kind."""
    out: list[Span] = []
    at = 0
    while "@" in text and (m := EMAIL_HERE.match(text, at) or EMAIL_NEXT.search(text, at)):
        out.append((m.start(), 0, m.end()))
        at = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def holds(kind: int, s: str) -> bool:
    """The exact test of a kind, whatever its form: the parts of an address, the digits and check digit of a card, the digits of a phone."""
    d = _digits(s)
    if kind == 0:
        return s.count("@") == 1 and "." in s.split("@")[1]
    if kind == 1:
        parts = re.findall("[0-9]+", s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 14 <= len(d) <= 19 and luhn(d) if kind == 2 else 10 <= len(d) <= 15


def labelled_texts(n: int, seed: int = SEED) -> list[tuple[str, list[Span]]]:
    """Texts with labelled spans of the four kinds in many forms, among words and numbers that are none of them."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("etaoinshrdluéèöñcmfw") for _ in range(r.randint(1, 11)))

    def card() -> str:
        d = r.choice("3456") + num(r.choice((13, 14, 14, 14, 15)))
        d += next(c for c in "0123456789" if luhn(d + c))
        gap = r.choice(("", "", " ", "-", "."))
        return gap.join(d[i : i + 4] for i in range(0, len(d), 4))

    def make(kind: int) -> str:
        if kind == 0:
            at = r.choice(("@", "@", "@", " @ "))
            return f"{word()}{r.choice(('.', '_', '', '+'))}{num(r.randint(0, 2))}{word()}{at}{word()}{num(r.randint(0, 1))}.{r.choice(('com', 'org', 'example.com', 'co.uk'))}"
        if kind == 1:
            return r.choice((".", ".", ".", " . ")).join(str(r.randint(0, 255)) for _ in range(4))
        if kind == 2:
            return card()
        a, b, c = num(3), num(3), num(4)
        return r.choice((f"+1 ({a}) {b}-{c}", f"+{num(2)} {a} {b} {c}", f"+{num(11)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0049 {a} {b}{c}"))

    def other() -> str:
        return r.choice((num(r.randint(1, 6)), f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}:{num(2)}", f"v{num(1)}.{num(1)}.{num(1)}", f"${num(2)}.{num(2)}", "password=" + "".join(r.choice("0123456789abcdef") for _ in range(18)), "AKIA" + "".join(r.choice("ABCDEFGHIJ234567") for _ in range(16)), f"@{word()}", f"{num(1)},{num(3)}", f"#{num(3)}", num(r.randint(7, 24)), "".join(r.choice("%&$#*=-+/@._()") for _ in range(r.randint(2, 6))), word() + r.choice("%&$#*@.") * 3, f"{word()}.{word()}.{word()}", f"{num(2)}.{num(2)}.{num(4)}", f"{num(4)} {num(4)}", f"www.{word()}.com", f"{word()}_{num(3)}", word().upper()))

    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < CUT + 20:
            what = r.random()
            if what < 0.25:
                kind = r.randrange(4)
                s = make(kind)
                spans.append((len(text), kind, len(text) + len(s)))
                text += s
            else:
                text += other() if what < 0.4 else word()
            text += r.choice((" ", " ", " ", " ", ", ", ". ", "\n"))
        more = [b for b in base_spans(text) if all(b[2] <= s or e <= b[0] for s, _, e in spans)]  # chance forms of the rules
        out.append((text, sorted(spans + more)))
    return out


def _class(ch: str) -> int:
    return MARKS.index(ch) if ch in MARKS else DIGIT if ch.isdigit() else UPPER if ch.isupper() else LOWER if ch.isalpha() else BREAK if ch in "\r\n" else SPACE if ch.isspace() else OTHER


#: The code of each character of the basic plane; those beyond are OTHER.
TABLE = np.array([c if c < ASCII else ASCII + BUCKETS * (_class(chr(c)) - DIGIT) + c * 31 % 251 % BUCKETS for c in range(1 << 16)], np.int64)
#: The class of each code.
CLASS_OF = np.array([_class(chr(c)) for c in range(ASCII)] + [DIGIT + k // BUCKETS for k in range(ALPHABET - 1 - ASCII)] + [PAD])
END = ALPHABET - 1


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 1 << 16, TABLE[np.minimum(points, (1 << 16) - 1)], ASCII + BUCKETS * (OTHER - DIGIT) + points % BUCKETS).astype(np.int64)


def tags_of(spans: list[Span], n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for start, kind, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid."""
    return np.clip(x * 0.25 + 0.5, 0, 1)


def _bend(x: np.ndarray) -> np.ndarray:
    """A rational curve like tanh: -1 and 1 from -3 and 3 on."""
    u = np.clip(x, -3, 3)
    v = u * u
    u *= v + 27
    v *= 9
    v += 27
    u /= v
    return u


def _bend_slope(x: np.ndarray) -> np.ndarray:
    v = np.minimum(x * x, 9)
    return np.where(v < 9, ((27 + 3 * v) * (27 + 9 * v) - 18 * v * (27 + v)) / (27 + 9 * v) ** 2, 0)


class Tagger:
    """Two LSTMs, one in each direction, over character classes; their states give scores of tags to a CRF."""

    bar = 0.0

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN, kind: type = np.float32):
        g, h = np.random.default_rng(seed), hidden
        self.hidden, self.kind = h, kind
        self.p = {f"{d}{k}": g.normal(0, s, shape).astype(kind) for d in "fb" for k, s, shape in (("x", 0.3, (CLASSES, 4 * h)), ("e", 0.05, (ALPHABET, 4 * h)), ("h", 0.25, (h, 4 * h)))}
        self.p |= {"o": g.normal(0, 0.2, (2 * h, TAGS)).astype(kind), "c": np.zeros(TAGS, kind), "t": np.zeros((TAGS, TAGS), kind), "s": np.zeros(TAGS, kind)}
        for d in "fb":
            self.p[d + "x"][:, h : 2 * h] += 1  # forget gates start open

    def table(self, d: str) -> np.ndarray:
        """What each code adds to the gates: its class's vector and its own."""
        return self.p[d + "x"][CLASS_OF] + self.p[d + "e"]

    def _lstm(self, d: str, x: np.ndarray, keep: list) -> np.ndarray:
        """States (time, rows, hidden) of x (rows, time) read in the order given, with what the way back needs."""
        h, rows, table = self.hidden, len(x), self.table(d)
        state, cell = np.zeros((rows, h), self.kind), np.zeros((rows, h), self.kind)
        out = np.empty((x.shape[1], rows, h), self.kind)
        for t in range(x.shape[1]):
            z = table[x[:, t]] + state @ self.p[d + "h"]
            gates = _gate(z[:, : 3 * h])
            raw = z[:, 3 * h :]
            new = _bend(raw)
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, cell = cell, f * cell + i * new
            bent = _bend(cell)
            keep.append((state, before, i, f, o, new, bent, raw, cell))
            state = o * bent
            out[t] = state
        return out

    def _lstm_back(self, d: str, x: np.ndarray, kept: list, dout: np.ndarray, grad: dict) -> None:
        gx, gh = np.zeros_like(self.p[d + "e"]), np.zeros_like(self.p[d + "h"])
        dstate, dcell = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        for t in reversed(range(x.shape[1])):
            state, before, i, f, o, new, bent, raw, cell = kept[t]
            dh = dout[t] + dstate
            dc = dcell + dh * o * _bend_slope(cell)
            slope = [0.25 * ((g > 0) & (g < 1)) for g in (i, f, o)]
            dz = np.concatenate([dc * new * slope[0], dc * before * slope[1], dh * bent * slope[2], dc * i * _bend_slope(raw)], 1)
            gx += np.eye(ALPHABET, dtype=self.kind)[x[:, t]].T @ dz
            gh += state.T @ dz
            dstate, dcell = dz @ self.p[d + "h"].T, dc * f
        grad[d + "e"], grad[d + "h"] = gx, gh
        grad[d + "x"] = np.eye(CLASSES, dtype=self.kind)[CLASS_OF].T @ gx

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of tags y (rows, time) under the CRF, and its gradient."""
        kept: tuple[list, list] = ([], [])
        f = self._lstm("f", x, kept[0])
        b = self._lstm("b", x[:, ::-1], kept[1])[::-1]
        both = np.concatenate([f, b], 2)
        e = both @ self.p["o"] + self.p["c"]
        n, rows, _ = e.shape
        t, lse = self.p["t"], lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + self.p["s"]
        for i in range(1, n):
            alpha[i] = lse(alpha[i - 1][:, :, None] + t, 1) + e[i]
        for i in reversed(range(n - 1)):
            beta[i] = lse(t + (e[i + 1] + beta[i + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        de = np.exp(alpha + beta - z[:, None])
        gt = np.zeros_like(t)
        for i in range(n - 1):
            gt += np.exp(alpha[i][:, :, None] + t + (e[i + 1] + beta[i + 1])[:, None, :] - z[:, None, None]).sum(0)
        each = np.arange(rows)
        gold = self.p["s"][y[:, 0]] + sum(e[i, each, y[:, i]] for i in range(n)) + sum(t[y[:, i], y[:, i + 1]] for i in range(n - 1))
        for i in range(n):
            de[i, each, y[:, i]] -= 1
        np.subtract.at(gt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        grad = {"t": gt, "s": de[0].sum(0), "c": de.sum((0, 1)), "o": np.tensordot(both, de, ([0, 1], [0, 1]))}
        dboth = de @ self.p["o"].T
        self._lstm_back("f", x, kept[0], dboth[:, :, : self.hidden], grad)
        self._lstm_back("b", x[:, ::-1], kept[1], dboth[::-1, :, self.hidden :], grad)
        return float((z - gold).mean()), {k: v / rows for k, v in grad.items()}

    def fit(self, examples: list[tuple[str, list[Span]]], steps: int = STEPS, seed: int = SEED) -> float:
        """Adam over windows cut from labelled texts, a few of them padded; the last loss."""
        r = np.random.default_rng(seed)
        coded = [(codes_of(t), tags_of(s, len(t))) for t, s in examples]
        m, v, loss = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0.0
        for step in range(1, steps + 1):
            x, y = np.full((BATCH, CUT), END), np.zeros((BATCH, CUT), np.int64)
            for row, k in enumerate(r.integers(0, len(coded), BATCH)):
                c, tags = coded[k]
                o, n = int(r.integers(0, max(1, len(c) - CUT + 1))), CUT if r.random() < 0.85 else int(r.integers(1, CUT))
                x[row, :n], y[row, :n] = c[o : o + n], tags[o : o + n]
            loss, grad = self.loss(x, y)
            rate = 0.03 * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                g = np.clip(g, -5, 5)
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(self.kind)
        return loss

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of tags (rows, time, TAGS) of windows x (rows, time), both directions side by side."""
        h, (rows, time) = self.hidden, x.shape
        # Gates first, then directions: (gate, direction, row, unit), so that each gate lies in one piece.
        scale, shift = (np.array(v, self.kind)[:, None, None, None] for v in ((0.25, 0.25, 0.25, 1), (0.5, 0.5, 0.5, 0)))
        by_gate = lambda f, b, n: np.stack([f, b]).reshape(2, n, 4, h).transpose(2, 0, 1, 3) * scale
        inner, table = by_gate(self.p["fh"], self.p["bh"], h), (by_gate(self.table("f"), self.table("b"), ALPHABET) + shift).reshape(4, 2 * ALPHABET, h)
        state, cell = np.zeros((2, rows, h), self.kind), np.zeros((2, rows, h), self.kind)
        out, z, own = np.empty((2, time, rows, h), self.kind), np.empty((4, 2, rows, h), self.kind), np.empty((4, 2, rows, h), self.kind)
        codes = np.stack([x.T, x.T[::-1] + ALPHABET], 1)
        for t in range(time):
            np.matmul(state, inner, out=z)
            z += table.take(codes[t], axis=1, out=own, mode="clip")
            np.clip(z[:3], 0, 1, out=z[:3])
            new = _bend(z[3])
            new *= z[0]
            cell *= z[1]
            cell += new
            np.multiply(z[2], _bend(cell), out=state)
            out[0, t], out[1, time - 1 - t] = state[0], state[1]
        return (out[0] @ self.p["o"][:h] + out[1] @ self.p["o"][h:] + self.p["c"]).transpose(1, 0, 2)

    def possible(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where in texts of these lengths, with scores e (time, TAGS) one after the other, a span of the best path can be at all.

        Scores of transitions can be moved along a path (shift, by tag) and into the tags' scores (into) so that none gains over
        no span. In one way leaving a span is free: then the rest of a span, from any of its characters on, must not be
        outscored by no span in sum, or it would end before. In another way entering is free: then the same holds from its
        start up to any of its characters. A character at which either fails is in no span of the best path.
        """
        t, s = self.p["t"].astype(float), self.p["s"].astype(float)
        ends = np.cumsum(lengths[lengths > 0])
        firsts, lasts, gaps = ends - lengths[lengths > 0], ends - 1, ends[:-1]

        def lead(into: np.ndarray) -> np.ndarray:
            best = e[:, 1] + into[1]
            for b in range(2, TAGS):
                np.maximum(best, e[:, b] + into[b], out=best)
            return (e[:, 0] + into[0] - best).astype(float)

        def sums(x: np.ndarray) -> np.ndarray:  # a long lead between texts keeps their sums apart
            return np.cumsum(np.insert(x, gaps, 1e6))

        if not len(e):
            return np.zeros(0, bool)
        shift = t[0, 0] - t[:, 0]  # leaving is free
        into = np.maximum((t + shift[:, None] - shift).max(0), s - shift - s[0] + t[0, 0])
        into[0] = t[0, 0]
        x = lead(into)
        x[lasts] -= max(0.0, float(shift.max()))
        total = sums(x)
        on = np.minimum.accumulate(total[::-1])[::-1] <= np.concatenate([[0.0], total[:-1]]) + 1e-3

        shift = np.minimum(0, (t[0] - t).min(1))  # entering is free
        into = t[0] - shift
        into[0] = t[0, 0]
        x = lead(into)
        x[firsts] -= max(0.0, float((s - shift - into)[1:].max() - s[0] + t[0, 0]))
        total = sums(x)
        on &= total <= np.maximum.accumulate(np.concatenate([[0.0], total[:-1]])) + 1e-3
        return np.delete(on, gaps + np.arange(len(gaps)))

    def paths(self, stretches: list[np.ndarray], first: list[bool], last: list[bool]) -> list[np.ndarray]:
        """The best tags of stretches of scores. Where a stretch is not at the text's start or end, no span stands before or behind it."""
        t, s = self.p["t"].astype(float), self.p["s"].astype(float)
        out: list = [None] * len(stretches)
        order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
        at = 0
        while at < len(order):  # all rows are as long as the first one: the longer it is, the fewer go with it
            own = order[at : at + max(1, min(1024, AREA // len(stretches[order[at]])))]
            at += len(own)
            sizes = np.array([len(stretches[i]) for i in own])
            e = np.zeros((sizes[0], len(own), TAGS))
            for k, i in enumerate(own):
                e[: sizes[k], k] = stretches[i]
            best, back = e[0] + np.where(np.array([first[i] for i in own])[:, None], s, t[0]), np.zeros((sizes[0], len(own), TAGS), np.int8)
            for j in range(1, sizes[0]):
                live = int((sizes > j).sum())
                now, most, by = best[:live], best[:live, :1] + t[0], back[j, :live]
                for a in range(1, TAGS):
                    to = now[:, a : a + 1] + t[a]
                    by[to > most] = a
                    np.maximum(most, to, out=most)
                best[:live] = most + e[j, :live]
            end = (best + np.where(np.array([last[i] for i in own])[:, None], 0, t[:, 0])).argmax(1)
            tags, each = np.zeros((sizes[0], len(own)), np.int64), np.arange(len(own))
            tags[sizes - 1, each] = end
            for j in range(sizes[0] - 1, 0, -1):
                live = int((sizes > j).sum())
                tags[j - 1, :live] = back[j, each[:live], tags[j, :live]]
            for k, i in enumerate(own):
                out[i] = tags[: sizes[k], k].copy()
        return out

    def undecided(self, texts: list[str], tested: bool = False) -> list[tuple[int, int, bool, bool, np.ndarray]]:
        """Of each text the stretches that may hold spans: text, start, whether at its start or end, scores.

        tested: but those with neither an @ nor four digits, in which no span passes holds().
        """
        owners, starts, chunks, codes = [], [], [], [np.zeros(0, np.int64)]
        for k, text in enumerate(texts):
            coded = codes_of(text)
            codes.append(coded)
            for at in range(0, max(len(coded) - (WINDOW - STRIDE), 1), STRIDE) if len(coded) else ():
                owners.append(k)
                starts.append(at)
                chunks.append(coded[at : at + WINDOW])
        start, lengths, owner = np.array(starts), np.array(list(map(len, texts))), np.array(owners)
        over = WINDOW - STRIDE
        ramp = (np.arange(1, over + 1) / (over + 1)).astype(self.kind)[:, None]
        whole: list = []
        tail = np.zeros((1, over, TAGS), self.kind)  # the scores beyond the stride of the window before
        for b in range(0, len(chunks), BLOCK):
            own, k, at = chunks[b : b + BLOCK], owner[b : b + BLOCK], start[b : b + BLOCK]
            sizes = np.array([len(c) for c in own])
            e = np.zeros((len(own), WINDOW, TAGS), self.kind)
            for rows in np.array_split((-sizes).argsort(kind="stable"), -(-len(own) // 1024)):
                x = np.full((len(rows), int(sizes[rows].max())), END)
                for i, r in enumerate(rows):
                    x[i, : sizes[r]] = own[r]
                e[rows, : x.shape[1]] = self.scores(x)
            before = np.concatenate([tail, e[:-1, STRIDE:]])
            tail = e[-1:, STRIDE:].copy()
            inner = np.flatnonzero(at > 0)
            e[inner, :over] = ramp * e[inner, :over] + (1 - ramp) * before[inner]
            reach = np.where(at + sizes == lengths[k], sizes, STRIDE)
            whole.append(e[np.arange(WINDOW) < reach[:, None]])
        scores, ends = np.concatenate([np.zeros((0, TAGS), self.kind), *whole]), np.cumsum(lengths)
        place = np.flatnonzero(self.possible(scores, lengths))
        text = np.searchsorted(ends, place, side="right")
        cuts = np.flatnonzero((np.diff(place) != 1) | (np.diff(text) != 0)) + 1
        out = []
        if not len(place):
            return out
        i, j = np.append(0, cuts), np.append(cuts, len(place))
        if tested:
            found = np.concatenate(codes)[place]
            some = lambda x: np.add.reduceat(x, i, dtype=np.int64)
            may = (some(found == ord("@")) >= 1) | (some((found >= ord("0")) & (found <= ord("9"))) >= 4)
            i, j = i[may], j[may]
        k, a, b = text[i], place[i], place[j - 1] + 1
        begin = ends[k] - lengths[k]
        for own in zip(k.tolist(), (a - begin).tolist(), (a == begin).tolist(), (b == ends[k]).tolist(), a.tolist(), b.tolist(), strict=True):
            out.append((*own[:4], scores[own[4] : own[5]]))
        return out

    def spans(self, texts: list[str], tested: bool = False) -> list[list[tuple[int, int, int, float]]]:
        """start, kind, end, confidence of the spans of each text; tested: some that don't pass holds() are left out."""
        out: list = [[] for _ in texts]
        found = self.undecided(texts, tested)
        if not found:
            return out
        tags = np.concatenate(self.paths([f[4] for f in found], [f[2] for f in found], [f[3] for f in found]))
        e, starts = np.concatenate([f[4] for f in found]), np.cumsum([0, *(len(f[4]) for f in found)])
        lead = e[np.arange(len(e)), tags] - np.where(np.arange(TAGS) == tags[:, None], -np.inf, e).max(1)
        kinds = np.where(tags > 0, (tags - 1) // 2, -1)
        new = np.append(True, (kinds[1:] != kinds[:-1]) | (tags[1:] % 2 == 1))
        new[starts[:-1]] = True
        edges = np.append(np.flatnonzero(new), len(tags))
        held = np.flatnonzero(kinds[edges[:-1]] >= 0)
        for r, f in zip(held.tolist(), (np.searchsorted(starts, edges[held], side="right") - 1).tolist(), strict=True):
            i, j, (k, at) = int(edges[r]), int(edges[r + 1]), found[f][:2]
            at -= int(starts[f])
            piece = texts[k][at + i : at + j]
            if piece.strip():
                lo = at + i + len(piece) - len(piece.lstrip())  # white space at the ends is no part of it
                out[k].append((lo, int(kinds[i]), lo + len(piece.strip()), float(lead[i:j].mean())))
        return out


@lru_cache(maxsize=1)
def trained() -> Tagger:
    """The network, and the bar of confidence from labelled texts that it was not trained on."""
    tagger = Tagger()
    tagger.fit(labelled_texts(EXAMPLES))
    held = labelled_texts(1_000, SEED + 1)
    found = tagger.spans([t for t, _ in held])
    rated = []
    for (text, own), spans in zip(held, found, strict=True):
        sure = {(s, e): c for s, _, e, c in spans}
        rated += [(sure[s, e], (s, k, e) in set(own)) for s, k, e in _added(text, base_spans(text), spans, -np.inf)]
    rated.sort(reverse=True)
    right = np.cumsum([ok for _, ok in rated])
    good = np.flatnonzero(right >= PRECISION * np.arange(1, len(rated) + 1))
    tagger.bar = rated[good[-1]][0] if len(good) else np.inf
    return tagger


def kept(spark: SparkSession) -> Tagger:
    """trained(), from the weights in the shared folder if a run before has left them there; else they are trained and left there."""
    made_by = "".join(map(inspect.getsource, (Tagger, labelled_texts, _class, codes_of, holds))) + repr((HIDDEN, STEPS, BATCH, SEED, EXAMPLES, PRECISION, CUT, WINDOW, STRIDE, BUCKETS))
    path = f"{shared_dir(spark)}/pii-weights-{hashlib.sha256(made_by.encode()).hexdigest()[:24]}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
        tagger = Tagger()
        for r in spark.read.parquet(path).collect():
            if r["name"] == "bar":
                tagger.bar = r["values"][0]
            else:
                tagger.p[r["name"]] = np.array(r["values"], tagger.kind).reshape(r["shape"])
        return tagger
    tagger = trained()
    rows = [(name, list(v.shape), v.astype(float).ravel().tolist()) for name, v in tagger.p.items()]
    spark.createDataFrame([*rows, ("bar", [1], [float(tagger.bar)])], "name string, shape array<int>, values array<double>").coalesce(1).write.mode("overwrite").parquet(path)
    return tagger


def _added(text: str, base: list[Span], found: list[tuple[int, int, int, float]], bar: float) -> list[Span]:
    """The spans found that overlap none of base and are sure enough."""
    taken = sorted((s, e) for s, _, e in base)
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else starts
    out = []
    for s, kind, e, sure in found:
        i = int(np.searchsorted(starts, e)) if taken else 0
        if sure >= bar and not (i and reach[i - 1] > s) and holds(kind, text[s:e]):
            out.append((s, kind, e))
    return out


def portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Begin and end of the runs of texts of these sizes that are read at once: ROWS texts and CHARS characters at most, or one text."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and (i - begin == ROWS or total + n > CHARS):
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame, column: str = "text") -> DataFrame:
    """The columns of docs but its text, and n_<kind> of the base spans, base_sha256, spans, n_added."""
    new = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    keep = [c for c in docs.columns if c != column and c not in new]
    rows = docs.select(*keep, column)
    schema = rows.selectExpr(*[f"`{c}`" for c in keep], *[f"0L as n_{k}" for k in KINDS], "'' as base_sha256", "'' as spans", "0L as n_added").schema
    tagger = kept(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, end in portions(pc.fill_null(pc.binary_length(whole.column(whole.num_columns - 1)), 0).to_pylist()):
                b = whole.slice(at, end - at)
                texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
                base = [base_spans(t) for t in texts]
                added = [_added(text, own, found, tagger.bar) for text, own, found in zip(texts, base, tagger.spans(texts, tested=True), strict=True)]
                counts = [pa.array([sum(k == kind for _, k, _ in s) for s in base], pa.int64()) for kind in range(len(KINDS))]
                digests = pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base])
                spans = pa.array([written([*s, *a]) for s, a in zip(base, added, strict=True)])
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *counts, digests, spans, pa.array(map(len, added), pa.int64())], names=[*keep, *new])

    return rows.mapInArrow(run, schema)
