"""Quality classifier by positive-unlabelled learning.

The non-negative unbiased risk  pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))  is minimised for a linear model under
squared loss, for which the risk of the unlabelled text is a quadratic form of its first and second moments. So the
unlabelled side is every text of the corpus, gathered in one pass to one small matrix. Trusted positives are labelled
documents of quality 1; a label of 0 is never read. The labelled documents used are a sample of at most LABEL_ROWS, by a
hash of doc_id; rows that repeat a doc_id count as one with the mean of their inputs. All of the sample, whatever its
labels, is the unlabelled sample on which two things are estimated: the class prior pi, as the smallest ratio over margins
t of the unlabelled share above t to that of the positives (where no negative is left above t, it is pi), and the logistic
scale from margin to score, by the unbiased logistic risk  E_u log(1 + exp m) - pi E_p m  with a ridge.

Rows whose crc32(doc_id as text) mod 4 is 2 are held out: their labels are never read. Inputs of a score are counts over
the whole text: characters by class, punctuation, hashed byte trigrams, and word and line repetition.

Defined results: a null text is an empty one and gets the score of its (empty) counts; a null doc_id is not held out;
rows that repeat score alike; of labels of one doc_id that differ the largest counts; without a usable label of 1 every
score is 0.5; texts of any length are read
whole; an empty table gives an empty result. Columns other than doc_id and text are not read. Sums are added in the
order of the tasks, so reruns over the same splits agree to the last bit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_ROWS = 20_000
HASHED, RIDGE, CUT = 64, 1e-3, 0.7
PUNCTUATION = np.array([b for b in range(33, 127) if not chr(b).isalnum()])
WIDTH = len(PUNCTUATION) + HASHED + 12


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def features(text: str) -> np.ndarray:
    out = np.zeros(WIDTH)
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        out[-1] = 1
        return out
    n, hist = len(raw), np.bincount(raw, minlength=256)
    p = len(PUNCTUATION)
    out[:p] = np.sqrt(hist[PUNCTUATION] / n)
    if n > 2:
        x = raw.astype(np.uint32)
        mixed = (x[:-2] * 0x9E3779B1 + x[1:-1] * 0x85EBCA6B + x[2:] * 0xC2B2AE35).astype(np.uint32) >> 26
        out[p : p + HASHED] = np.sqrt(np.bincount(mixed, minlength=HASHED) / n)
    words, lines = text.split(), text.split("\n")
    w = max(len(words), 1)
    common = Counter(words).most_common(1)
    share = [hist[65:91].sum() / n, hist[97:123].sum() / n, hist[48:58].sum() / n, hist[128:].sum() / n, (hist[9:14].sum() + hist[32]) / n]
    share += [len(set(words)) / w, len(set(lines)) / len(lines), (common[0][1] if common else 0) / w, sum(map(str.isupper, words)) / w, np.log1p(w) / 10, min(n / w, 60) / 60]
    out[p + HASHED : -1] = share
    return out


def matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(t or "") for t in texts.to_pylist()]).reshape(-1, WIDTH)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the bias
    slope: float
    shift: float
    prior: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(x) + self.shift, -30, 30)))


def _gather(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moments of all texts (with a constant 1 as last input), and inputs and labels of the labelled sample, one per doc_id."""
    sample = labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("q"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABEL_ROWS)
    parts = max(1, docs.rdd.getNumPartitions())
    slots = isqrt(parts)
    bucket = (-1 - F.pmod(F.xxhash64("doc_id"), F.lit(parts))).cast("int")  # labelled documents have slots below 0
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "q", F.when(F.col("q").isNotNull(), F.col("doc_id").cast("string")), bucket)
    schema, names = "slot int, q int, id string, n bigint, x binary", ["slot", "q", "id", "n", "x"]

    def table(own: dict) -> pa.Table:
        """Labelled documents, with the sums of their rows' inputs."""
        columns = [(pa.int32(), 0), (pa.int32(), 1), (pa.string(), None), (pa.int64(), 2)]
        filled = [pa.array([i if at is None else v[at] for i, v in own.items()], kind) for kind, at in columns]
        return pa.table([*filled, pa.array([v[3].tobytes() for v in own.values()], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WIDTH + 1, WIDTH + 1))
        own: dict = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                x = np.hstack([matrix(b.column(0)), np.ones((b.num_rows, 1))])
                total += x.T @ x
                for i, (q, key, its) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                    if q is not None:
                        before = own.get(key, (0, 0, 0, 0))
                        own[key] = its, q, before[2] + 1, before[3] + x[i, :-1]
        yield from table(own).to_batches(2048)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part % slots], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=names)

    def merge(group: pa.Table) -> pa.Table:
        if group["slot"][0].as_py() < 0:
            own: dict = {}
            for its, q, key, n, x in sorted(zip(*(c.to_pylist() for c in group.columns), strict=True), key=lambda r: r[2:]):
                before = own.get(key, (0, 0, 0, 0))
                own[key] = its, q, before[2] + n, before[3] + np.frombuffer(x)
            return table(own).cast(group.schema)
        total = sum(np.frombuffer(x) for _, x in sorted(zip(group["n"].to_pylist(), group["x"].to_pylist(), strict=True)))
        return pa.table([group["slot"][:1], group["q"][:1], group["id"][:1], group["n"][:1], pa.array([total.tobytes()], pa.binary())], schema=group.schema)

    # The driver gets a matrix per slot, and at most LABEL_ROWS rows of WIDTH numbers, however often a doc_id repeats.
    dealt = rows.mapInArrow(run, schema)
    found = dealt.groupBy("slot").applyInArrow(merge, schema).collect()
    total = sum((np.frombuffer(r["x"]).reshape(WIDTH + 1, WIDTH + 1) for r in sorted(found, key=lambda r: r["slot"]) if r["slot"] >= 0), np.zeros((WIDTH + 1, WIDTH + 1)))
    labelled = [r for r in found if r["slot"] < 0]
    x = np.array([(np.frombuffer(r["x"]) / r["n"]).astype(np.float32) for r in labelled], float).reshape(-1, WIDTH)
    order = np.lexsort((*x.T, [r["q"] for r in labelled])) if len(x) else []
    return total, x[order], np.array([r["q"] for r in labelled])[order] if len(x) else np.zeros(0)


def _minimise(uu: np.ndarray, u: np.ndarray, p: np.ndarray, pp: np.ndarray, prior: float) -> np.ndarray:
    """Weights for the moments of unlabelled (uu, u) and positive (pp, p) inputs."""
    d = len(u)
    ridge = RIDGE * np.eye(d)
    w = np.linalg.solve(uu / 2 + ridge, prior * p - u / 2)
    negative = lambda w: (1 + 2 * w @ u + w @ uu @ w) / 4 - prior * (1 + 2 * w @ p + w @ pp @ w) / 4
    if negative(w) >= 0:
        return w
    # The plain solution overfits: go down the whole risk where its negative part is not below 0, and up that part where
    # it is, in ever shorter steps; of the points that keep it the best counts.
    risk = lambda w: prior * (1 - 2 * w @ p + w @ pp @ w) / 4 + negative(w) + RIDGE * w @ w / 2
    w, step = np.zeros(d), 1 / (np.linalg.eigvalsh(uu + prior * pp)[-1] / 2 + RIDGE)
    best, least = w, risk(w)
    for k in range(2000):
        back = (u + uu @ w) / 2 - prior * (p + pp @ w) / 2
        w = w - step / (1 + k / 50) * ((-prior * (p - pp @ w) / 2 + back + ridge @ w) if negative(w) >= 0 else -back)
        if negative(w) >= 0 and risk(w) < least:
            best, least = w, risk(w)
    return best


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives, from margins of positives and of unlabelled texts: the smallest ratio of their tails.

    Tails hold at least half of the positives, so that no ratio rests on a few texts.
    """
    at = np.unique(np.quantile(p, np.linspace(0, 0.5, 101)))
    fp, fu = (1 - np.searchsorted(np.sort(m), at) / len(m) for m in (p, u))
    return float(np.clip((fu / fp).min(), 0.02, 0.98))


def _scale(p: np.ndarray, u: np.ndarray, prior: float, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and shift that minimise the unbiased logistic risk of the margins, by Newton's method (it is convex)."""
    a, b = 1.0, 0.0
    for _ in range(100):
        s = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        v = s * (1 - s)
        g = np.array([(s * u).mean() - prior * p.mean() + ridge * a, s.mean() - prior])
        h = np.array([[(v * u * u).mean() + ridge, (v * u).mean()], [(v * u).mean(), v.mean() + 1e-6]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    total, x, y = _gather(docs, labels)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    scale = np.sqrt(np.maximum(np.diag(total)[:-1] / n - mean**2, 1e-8)) + 1e-3
    to = np.eye(WIDTH + 1)
    to[:-1, :-1] = np.diag(1 / scale)
    to[:-1, -1] = -mean / scale
    uu = to @ (total / n) @ to.T
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    pos = z[y == 1]
    if not len(pos):
        return Model(mean, scale, np.zeros(WIDTH + 1), 1.0, 0.0, 0.5)
    prior = 0.5
    for _ in range(2):  # margins of a first model estimate the prior that the second one needs
        w = _minimise(uu, uu[-1], pos.mean(0), pos.T @ pos / len(pos), prior)
        prior = class_prior(pos @ w, z @ w)
    w = _minimise(uu, uu[-1], pos.mean(0), pos.T @ pos / len(pos), prior)
    return Model(mean, scale, w, *_scale(pos @ w, z @ w, prior), prior)


def score_column(model: Model) -> Column:
    @F.pandas_udf("double")
    def score(text):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(model.scores(np.array([features(t or "") for t in text]).reshape(-1, WIDTH)))

    return score(F.col("text"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs predicted to be good, with all their columns."""
    return docs.where(score_column(fit(docs, labels)) >= CUT)
