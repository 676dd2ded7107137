"""Quality classifier: Naive Bayes support vectors (NB-SVM).

Features are indicators of the text's byte 2-, 3- and 4-grams, and of a word
said twice or three times running, hashed into ``2 ** BITS`` places.  Over all
labelled training rows the share of documents of each class that have a
feature gives the class log-count ratio, by which the indicator is scaled; the
counts are summed in Spark.  A linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent on at most ``SAMPLE`` training
rows (taken by a hash of the id).  Their features reach the driver packed, a
bit for each place at most, so ``SAMPLE * 5 / 4`` rows take 160 MB however long
the texts are.  A logistic curve fitted to the margins of
other training rows (at most ``SAMPLE // 4``) turns margins into scores.

Only the text is an input of a score.  Rows held out of training are picked by
crc32 of the id.

Cases: null and empty texts have no feature and get the score of the bias;
without rows of both classes every score is the training share of label 1
(0.5 without rows); repeated rows score alike; null ids are scored and never
trained on; texts are read whole; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import arrow_batches, keep, text_of

BITS = 18
SIZES = (2, 3, 4)
SAMPLE = 4_000
FOLDS = 5
THRESHOLD = 0.3


def features(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Places of a text's features, each once; ``seen``: 2 ** BITS False."""
    b = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint64) if text else np.zeros(0, np.uint64)
    h = np.zeros(len(b), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(b) < n:
            break
        h = h[:len(b) - n + 1] * np.uint64(257) + b[n - 1:]
        if n in SIZES:
            seen[((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)] = True
    words = text.split()
    same = [x == y for x, y in zip(words[:-1], words[1:], strict=True)]
    if any(same):
        seen[0] = True
        if any(x and y for x, y in zip(same[:-1], same[1:], strict=True)):
            seen[1] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def pack_places(at: np.ndarray) -> bytes:
    """Few places as numbers, many as a bit each: at most 2 ** BITS bits."""
    if len(at) * 32 < 1 << BITS:
        return at.astype("<i4").tobytes()
    bits = np.zeros(1 << BITS, np.uint8)
    bits[at] = 1
    return np.packbits(bits).tobytes()


class Rows(Sequence):
    """Packed features of documents, unpacked one by one when read."""

    def __init__(self, packed: Sequence[bytes]):
        self.packed = packed

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, i):
        if isinstance(i, slice):
            return Rows(self.packed[i])
        b = self.packed[i]
        return np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8))) if len(b) * 8 == 1 << BITS else np.frombuffer(b, "<i4")


def descend(rows: Sequence[np.ndarray], y: np.ndarray, ratio: np.ndarray, c: float = 1.0, rounds: int = 10,
            seed: int = 11) -> tuple[np.ndarray, float]:
    """(weights of the indicators, bias) of the hinge-loss model, by dual
    coordinate descent; a row's scaled indicators are brought to length 1."""
    rng = np.random.default_rng(seed)
    scaled = lambda v: v / np.sqrt((v * v).sum() + 1e-12)
    square = np.array([(scaled(ratio[r]) ** 2).sum() + 1.0 for r in rows])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            value = scaled(ratio[at])
            slope = y[i] * (w[at] @ value + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), c)
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * value
                bias += step
                alpha[i] = new
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))) by Newton's method on smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hess, x.T @ (p - t)), -5, 5)
    return float(max(ab[0], 1e-3)), float(ab[1])


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    a: float
    b: float

    def margin(self, rows: np.ndarray) -> float:
        if not len(rows):
            return self.bias
        v = self.ratio[rows]
        return float(self.weights[rows] @ v / np.sqrt((v * v).sum() + 1e-12)) + self.bias

    def score(self, rows: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.a * self.margin(rows) + self.b, -700, 700))))


def fold(name: str = "id"):
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of the other folds than 0."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    known = known.dropDuplicates(["id"]).where(fold() != 0)
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).where(fold() != 0)
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=6)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [z.compress(t) for t in b.column(1).cast(pa.binary()).to_pylist()], pa.binary())], ["id", "text"])

    def to_features(batches):
        import zstandard

        z, seen = zstandard.ZstdDecompressor(), np.zeros(1 << BITS, bool)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(
                [features(z.decompress(t), seen) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], ["id", "y", "f"])

    def to_packed(batches):
        for b in to_features(batches):
            at = [pack_places(x.values.to_numpy()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.binary())], ["id", "y", "f"])

    arrow_batches(docs.sparkSession)
    # the labels grow with the documents, so texts meet them in a shuffle at every size, packed;
    # the labelled texts are kept, not their features, which are larger
    d = d.mapInArrow(pack, f"id {kind}, text binary").join(known.hint("merge"), "id")
    d = keep(d.select("id", "text", "y"), "labelled")
    as_features = lambda x: x.select("id", "text", "y").mapInArrow(to_features, f"id {kind}, y int, f array<int>")
    n = dict(d.groupBy("y").count().collect())
    if len(n) < 2:
        share = 0.5 if not n else float(next(iter(n)))
        zero = np.zeros(1 << BITS)
        return Model(zero, zero, 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    # documents of each class that have a feature, over all training rows
    counts = as_features(d).select("y", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).toArrow()  # <= 2 ** BITS rows
    pos, neg = np.ones(1 << BITS), np.ones(1 << BITS)
    at = counts.column("f").to_numpy()
    pos[at] += counts.column("pos").to_numpy()
    neg[at] += counts.column("neg").to_numpy()
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    # a bounded sample, in the order of a hash: the last fifth fits the curve
    most = sample + sample // 4
    # a little more than the sample by the hash itself, so that no task gets many rows to sort
    share = min(1.0, 1.2 * most / sum(n.values()) + 1e-4)
    near = d.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    taken = (near.select("id", "text", "y").mapInArrow(to_packed, f"id {kind}, y int, f binary")
             .orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(most).select("y", "f").toArrow())
    y = np.where(taken.column("y").to_numpy() > 0, 1.0, -1.0)
    rows = Rows(taken.column("f").to_pylist())
    m = max(1, len(rows) * 4 // 5)
    w, bias = descend(rows[:m], y[:m], ratio)
    model = Model(ratio, w, bias, 1.0, 0.0)
    part = slice(m, None) if len({*y[m:]}) == 2 else slice(None)
    model.a, model.b = logistic(np.array([model.margin(r) for r in rows[part]]), y[part])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # two vectors of 2 ** BITS numbers

    def run(batches):
        seen, m = np.zeros(1 << BITS, bool), held.value
        for b in batches:
            s = np.array([m.score(features(t, seen)) for t in b.column(1).cast(pa.binary()).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["id", "score"])

    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return d.select(F.col("id").alias(id_col), F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
