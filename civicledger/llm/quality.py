"""Quality classifier: learned hashed word and character n-gram vectors, averaged, softmax.

A document's features are its words, pairs of neighbouring words (a repeated
word is a feature of its own) and the character n-grams inside words, hashed
into buckets. The model averages the buckets' learned vectors and applies a
softmax layer; both are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows. Scoring reads every byte of every text; the
output layer is folded into the bucket vectors, which gives the same scores.

Defined cases: null and empty texts have no features and get the score of the
bias; a document whose label rows disagree, or are null, is not learned from;
without labels every score is 0.5; repeated rows score alike; long texts are
read whole, in blocks whose sums add up exactly as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (2, 3, 4)

#: A fixed odd multiplier for each place of an n-gram, made by a rule.
PLACE = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1 for k in range(1, 8)], dtype=np.uint64)
BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) ^ np.uint64(0x5851F42D4C957F2D)
SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def _bucket(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - 17)).astype(np.int32)


def feature_blocks(texts: list[bytes]):
    """Yields (document number, bucket) arrays that together hold every feature of ``texts``."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    doc = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes)]).astype(np.int32)
    blank = SPACE[raw]
    val = BYTE[raw]
    # words: hash of all bytes by running sums, place by place modulo 2^64
    edge = np.diff(blank.view(np.int8))
    first, last = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    power = np.ones(len(raw) + 1, np.uint64)
    power[1:] = np.uint64(0x9E3779B97F4A7C15)
    power = np.multiply.accumulate(power)
    total = np.concatenate([[np.uint64(0)], np.add.accumulate(val * power[:-1])])
    # the same word at another place has its sum multiplied by a known power: bring all to one place
    inverse = np.full(len(raw) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    word = (total[last] - total[first]) * inverse[first]
    word ^= word >> np.uint64(29)
    word *= np.uint64(0xBF58476D1CE4E5B9)
    owner = doc[first]
    yield owner, _bucket(word.copy())
    near = owner[1:] == owner[:-1]
    pair = word[:-1] * np.uint64(3) + word[1:] * np.uint64(0x94D049BB133111EB)
    pair[word[:-1] == word[1:]] = np.uint64(12345)
    yield owner[1:][near], _bucket(pair[near])
    near = owner[2:] == owner[:-2]
    again = np.where(word[2:] == word[:-2], np.uint64(54321), np.uint64(54322))
    yield owner[2:][near], _bucket(again[near])
    # character n-grams inside words
    inside = ~blank
    for n in range(1, max(NGRAMS) + 1):
        if n == 1:
            h = val * PLACE[0]
            ok = inside
        else:
            h = h[:-1] + val[n - 1:] * PLACE[n - 1]
            ok = ok[:-1] & inside[n - 1:]
        if n in NGRAMS:
            at = np.flatnonzero(ok)
            yield doc[at], _bucket(h[at] + np.uint64(n))


def blocks_of(texts: list[bytes], most: int = 400_000):
    """(first document, texts) in blocks of bounded bytes; a longer text is a block of its own."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > most:
            yield start, held
            start, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield start, held


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    all_ = np.concatenate([b for _, b in feature_blocks([text])])
    return np.unique(all_, return_counts=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int, float]], classes: int, epochs: int = 2, rate: float = 0.5,
          seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts, class, weight) per document -> folded vectors (BUCKETS x classes) and bias.

    Plain stochastic gradient descent, one document a step, the rate falling to
    zero; gradients of the bucket vectors are scaled by the bucket's share.
    """
    rng = np.random.default_rng(seed)
    vec = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    out = np.zeros((classes, DIM), np.float32)
    bias = np.zeros(classes, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, cnt, y, weight = rows[k]
            now = rate * (1 - done / steps) * weight
            done += 1
            if not len(ids):
                h = np.zeros(DIM, np.float32)
                share = cnt
            else:
                share = (cnt / cnt.sum()).astype(np.float32)
                h = share @ vec[ids]
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= now * 4 * np.outer(p, h)
            bias -= now * 0.1 * p
            if len(ids):
                vec[ids] -= (now * 40 * np.sqrt(share))[:, None] * back / np.sqrt(len(ids))
    return (vec @ out.T).astype(np.float64), bias.astype(np.float64)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def score_texts(texts: list[bytes], folded: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Class probabilities of each text."""
    out = np.empty((len(texts), len(bias)))
    for start, block in blocks_of(texts):
        total = np.zeros((len(block), len(bias)))
        n = np.zeros(len(block))
        for doc, bucket in feature_blocks(block):
            n += np.bincount(doc, minlength=len(block))
            for c in range(1, len(bias)):
                total[:, c] += np.bincount(doc, weights=folded[bucket, c] - folded[bucket, 0], minlength=len(block))
        total[:, 1:] += bias[1:] - bias[0]
        total[:, 1:] = np.where(n[:, None] > 0, (total[:, 1:] - (bias[1:] - bias[0])) / np.maximum(n, 1)[:, None], 0) + (
            bias[1:] - bias[0])
        out[start:start + len(block)] = softmax(total)
    return out


class Model:
    def __init__(self, classes: list[int], folded: np.ndarray, bias: np.ndarray):
        self.classes, self.folded, self.bias = classes, folded, bias


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str, per_class: int = 2000,
        id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Learns from at most ``per_class`` labelled documents of each class, in the order of a hash of the id.

    Classes are weighted back to their shares among all labelled rows. The
    sample's size is the documented bound: it, not the corpus, reaches the driver.
    """
    known = (labels.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2"))
             .where("id is not null and y = y2").select("id", "y"))
    shares = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not shares:
        return None
    classes = sorted(shares)
    sample = None
    for c in classes:
        some = known.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class)
        sample = some if sample is None else sample.unionByName(some)

    def featurise(batches):
        for b in batches:
            got = [counts(t if t is not None else b"") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("y"), pa.array([i.astype("<i4").tobytes() for i, _ in got], pa.binary()),
                 pa.array([np.minimum(n, 65535).astype("<u2").tobytes() for _, n in got], pa.binary())],
                ["id", "y", "buckets", "counts"])

    # the sample's bound makes it safe to broadcast
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
            .join(F.broadcast(sample.withColumn("y", F.col("y").cast("int"))), "id")
            .select("id", "y", "text").mapInArrow(featurise, "id bigint, y int, buckets binary, counts binary").toArrow())
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    y = rows.column("y").to_numpy()
    size = {c: max(1, int((y == c).sum())) for c in classes}
    every = sum(shares.values())
    b, n = rows.column("buckets"), rows.column("counts")
    weight = {c: shares[c] / every * len(y) / size[c] for c in classes}
    top = max(weight.values(), default=1)
    data = [(np.frombuffer(b[int(i)].as_buffer(), "<i4"), np.frombuffer(n[int(i)].as_buffer(), "<u2").astype(np.float32),
             classes.index(int(y[i])), weight[int(y[i])] / top) for i in order]
    folded, bias = train(data, len(classes))
    return Model(classes, folded, bias)


def score(spark: SparkSession, docs: DataFrame, model: Model | None, good: int = 1, id_col: str = "doc_id",
          text_col: str = "text", keep: tuple[str, ...] = (), into: str = "score") -> DataFrame:
    """``id_col``, the columns ``keep`` and ``into``: the probability of the class ``good``."""
    cols = list(dict.fromkeys([id_col, *keep]))
    if model is None or good not in model.classes:
        return docs.select(*cols, F.lit(0.5 if model is None else 0.0).alias(into))
    shared = spark.sparkContext.broadcast((model.folded, model.bias, model.classes.index(good)))
    schema = docs.select(*cols, F.lit(0.0).alias(into)).schema

    def run(batches):
        folded, bias, at = shared.value
        for b in batches:
            texts = [t if t is not None else b"" for t in b.column(text_col).cast(pa.binary()).to_pylist()]
            p = score_texts(texts, folded, bias)[:, at] if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(p, pa.float64())], [*cols, into])

    return docs.select(*dict.fromkeys([*cols, text_col])).mapInArrow(run, schema)
