"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads windows of consecutive bytes forwards and backwards, labels
every position, and a document's probabilities are the mean over all its
positions. It is trained in numpy by backpropagation through time (Adam) on
windows of a bounded sample of labelled documents. Prediction runs through every
byte of every text: windows of many documents advance together, one numpy step
for all.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows with a null language are not learned from; without learned rows every
document is ``und``; ties go to the language that sorts first; repeated rows
are predicted alike; long texts are read whole, in blocks of windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WINDOW = 96
HIDDEN = 8
UNDEFINED = "und"
LETTER = regex.compile(r"\p{L}")
#: Windows that advance together: bounds the memory of a task.
TOGETHER = 4096


def init(classes: int, rng) -> dict[str, np.ndarray]:
    p = {}
    for way in "fb":
        p[way + "in"] = rng.normal(0, 0.3, (257, 3 * HIDDEN))            # row 256: padding
        p[way + "rec"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        p[way + "new"] = np.zeros(HIDDEN)
    p["out"] = rng.normal(0, 0.3, (2 * HIDDEN, classes))
    p["bias"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def run_way(x: np.ndarray, p: dict, way: str, tape: list | None = None) -> np.ndarray:
    """States (steps x windows x HIDDEN) of one direction; ``x`` holds bytes, steps x windows.

    ``tape`` collects what backpropagation needs.
    """
    steps, n = x.shape
    table, rec, new = p[way + "in"], p[way + "rec"], p[way + "new"]
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
        given = table[x[t]]
        own = h @ rec
        gate = _sigmoid(given[:, :2 * HIDDEN] + own[:, :2 * HIDDEN])
        z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
        cand = own[:, 2 * HIDDEN:] + new
        c = r * cand
        c += given[:, 2 * HIDDEN:]
        np.tanh(c, out=c)
        if tape is not None:
            tape.append((t, h, z, r, cand, c))
        np.subtract(h, c, out=out[t])
        out[t] *= z
        out[t] += c
        h = out[t]
    return out


def position_probabilities(x: np.ndarray, p: dict) -> np.ndarray:
    """Steps x windows x classes."""
    z = run_way(x, p, "f") @ p["out"][:HIDDEN]
    z += run_way(x, p, "b") @ p["out"][HIDDEN:]
    z += p["bias"]
    np.exp(z, out=z)                                 # states lie within -1 and 1: no overflow
    z /= z.sum(axis=2, keepdims=True)
    return z


def gradients(x: np.ndarray, y: np.ndarray, mask: np.ndarray, p: dict) -> tuple[float, dict]:
    """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
    g = {k: np.zeros_like(v) for k, v in p.items()}
    tapes = {w: [] for w in "fb"}
    states = {w: run_way(x, p, w, tapes[w]) for w in "fb"}
    z = states["f"] @ p["out"][:HIDDEN] + states["b"] @ p["out"][HIDDEN:] + p["bias"]
    z = np.exp(z - z.max(axis=2, keepdims=True))
    z /= z.sum(axis=2, keepdims=True)
    every = mask.sum()
    loss = float(-(np.log(z[:, np.arange(len(y)), y] + 1e-9) * mask).sum() / every)
    z[:, np.arange(len(y)), y] -= 1
    z *= (mask / every)[:, :, None]
    g["bias"] = z.sum(axis=(0, 1))
    for k, w in enumerate("fb"):
        rows = slice(k * HIDDEN, (k + 1) * HIDDEN)
        g["out"][rows] = np.tensordot(states[w], z, ((0, 1), (0, 1)))
        back = z @ p["out"][rows].T
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        rec = p[w + "rec"]
        for t, h, zg, r, cand, c in reversed(tapes[w]):
            dh = dh + back[t]
            dc = dh * (1 - zg) * (1 - c * c)
            dz = dh * (h - c) * zg * (1 - zg)
            dr = dc * cand * r * (1 - r)
            dcand = dc * r
            own = np.concatenate([dz, dr, dcand], axis=1)
            np.add.at(g[w + "in"], x[t], np.concatenate([dz, dr, dc], axis=1))
            g[w + "rec"] += h.T @ own
            g[w + "new"] += dcand.sum(axis=0)
            dh = dh * zg + own @ rec.T
    return loss, g


def train(windows: np.ndarray, y: np.ndarray, classes: int, epochs: int = 8, batch: int = 64, rate: float = 0.02,
          seed: int = 11) -> dict:
    """``windows`` (n x WINDOW, 256 pads) and their classes -> parameters; Adam with a falling rate."""
    rng = np.random.default_rng(seed)
    p = init(classes, rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    steps, step = epochs * -(-len(y) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            some = order[at:at + batch]
            x = np.ascontiguousarray(windows[some].T)
            _, g = gradients(x, y[some], (x < 256).astype(np.float32), p)
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            now, step = rate * (1 - step / steps) / max(1, norm), step + 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                p[k] -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
    return p


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, n x WINDOW, the last one padded with 256."""
    n = -(-len(text) // WINDOW)
    out = np.full(n * WINDOW, 256, np.int16)
    out[:len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def document_probabilities(texts: list[bytes], p: dict) -> np.ndarray:
    """Mean of the position probabilities of each text; zeros for an empty one."""
    total = np.zeros((len(texts), len(p["bias"])))
    held, owners, n = [], [], 0

    def flush():
        x = np.ascontiguousarray(np.concatenate(held).T)
        z = position_probabilities(x, p)
        z *= (x < 256)[:, :, None]
        np.add.at(total, np.concatenate(owners), z.sum(axis=0, dtype=np.float64))

    for i, t in enumerate(texts):
        w = windows_of(t)
        for at in range(0, len(w), TOGETHER):
            some = w[at:at + TOGETHER]
            held.append(some)
            owners.append(np.full(len(some), i))
            n += len(some)
            if n >= TOGETHER:
                flush()
                held, owners, n = [], [], 0
    if held:
        flush()
    return total / np.maximum([[len(t)] for t in texts], 1)


class Model:
    def __init__(self, languages: list[str], params: dict):
        self.languages, self.params = languages, params


def fit(spark: SparkSession, docs: DataFrame, per_language: int = 500, per_document: int = 3,
        text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learns from ``per_document`` windows of at most ``per_language`` documents of each language.

    The documents are those with the smallest hashes of their texts; the
    windows lie spread over the whole text. Both numbers bound what reaches
    the driver. The number of languages is that of the table.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "lang is not null and text is not null")
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    # ranked by hash alone, then joined: texts are not sorted; equal texts rank alike. Only hashes in the lowest
    # part, about twice the sample, are ranked, whatever a language's share
    hashes = known.select("lang", F.xxhash64("text").alias("h")).distinct()
    counts = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    low = (F.col("h") / F.lit(2.0 ** 64) + 0.5) * F.col("n") <= 2 * per_language + 50
    ranks = (hashes.join(counts, "lang").where(low)
             .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
             .where(F.col("k") <= per_language).select(F.col("lang").alias("l"), F.col("h").alias("hh")))

    def cut(batches):
        for b in batches:
            rows = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = windows_of(text)
                for k in range(min(per_document, len(w))):
                    some = w[(2 * k + 1) * len(w) // (2 * min(per_document, len(w)))]
                    rows.append((lang, some.astype("<i2").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["lang", "window"])

    # the sample's bound makes it safe to broadcast
    got = (known.withColumn("h", F.xxhash64("text"))
           .join(F.broadcast(ranks), (F.col("lang") == F.col("l")) & (F.col("h") == F.col("hh")))
           .select("lang", F.col("text").cast("binary").alias("text"))
           .mapInArrow(cut, "lang string, window binary").distinct().collect())
    rows = sorted((r["lang"], bytes(r["window"])) for r in got)
    if not rows:
        return None
    x = np.stack([np.frombuffer(w, "<i2") for _, w in rows])
    y = np.array([languages.index(k) for k, _ in rows])
    return Model(languages, train(x, y, len(languages)))


def predict(spark: SparkSession, docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text", keep: tuple[str, ...] = (), into: tuple[str, str] = ("lang_pred", "score")
            ) -> DataFrame:
    """``id_col``, the columns ``keep``, and ``into``: language and its probability, for every row of ``docs``."""
    cols = list(dict.fromkeys([id_col, *keep]))
    if model is None:
        return docs.select(*cols, F.lit(UNDEFINED).alias(into[0]), F.lit(0.0).alias(into[1]))
    shared = spark.sparkContext.broadcast((model.languages, model.params))
    schema = docs.select(*cols, F.lit("").alias(into[0]), F.lit(0.0).alias(into[1])).schema

    def run(batches):
        languages, params = shared.value
        for b in batches:
            texts = [t if t is not None and LETTER.search(t.decode()) else b""
                     for t in b.column(text_col).cast(pa.binary()).to_pylist()]
            p = document_probabilities(texts, params) if texts else np.zeros((0, len(languages)))
            names = [languages[k] if t else UNDEFINED for k, t in zip(p.argmax(axis=1), texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(names, pa.string()),
                 pa.array(p.max(axis=1) if len(p) else [], pa.float64())], [*cols, *into])

    return docs.select(*dict.fromkeys([*cols, text_col])).mapInArrow(run, schema)
