"""The trained classifiers: gradients, held-out accuracy, whole texts, edge cases."""

import copy
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicledger.llm import language, quality, queries

SF = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def fold(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in language.init(3, rng).items()}
    x = rng.integers(0, 6, (9, 4))
    x[7:, 1] = 256
    y, mask = np.array([0, 1, 2, 1]), (x < 256).astype(float)
    _, g = language.gradients(x, y, mask, {k: v.astype(np.float32) for k, v in p.items()})
    for k in p:
        at = (int(x[2, 1]), 5) if k[1:] == "in" else tuple(int(rng.integers(0, n)) for n in p[k].shape)
        moved = []
        for e in (1e-2, -1e-2):
            q = copy.deepcopy(p)
            q[k][at] += e
            moved.append(language.gradients(x, y, mask, {a: b.astype(np.float32) for a, b in q.items()})[0])
        assert abs((moved[0] - moved[1]) / 2e-2 - g[k][at]) < 2e-3, k


def test_every_byte_of_a_long_text_counts():
    p = language.init(2, np.random.default_rng(2))
    a = b"abc " * 40000
    whole = language.document_probabilities([a], p)[0]
    parts = language.position_probabilities(np.ascontiguousarray(language.windows_of(a).T), p)
    mask = (language.windows_of(a).T < 256)[:, :, None]
    assert np.allclose(whole, (parts * mask).sum(axis=(0, 1), dtype=np.float64) / len(a), atol=1e-5)
    assert not np.allclose(whole, language.document_probabilities([a + b"zzzz" * 9000], p)[0], atol=1e-4)


@data
def test_language_of_held_out_documents(spark):
    got = queries.op10_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in rows) and len(rows) == 1000
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


@data
def test_quality_of_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op3_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if fold(r.doc_id, 5) == 0]
    assert len(got) == 1000 and all(r.held_out == (fold(r.doc_id, 5) == 0) for r in got.values())
    good = [got[r.doc_id].predicted for r in held if r.quality == 1]
    junk = [got[r.doc_id].predicted for r in held if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.2


def test_scores_do_not_depend_on_blocks():
    rng = np.random.default_rng(4)
    folded, bias = rng.normal(size=(quality.BUCKETS, 2)), np.array([0.1, -0.2])
    texts = [b"some words here " * k for k in (1, 50, 3000)] + [b"", b"one"]
    alone = np.concatenate([quality.score_texts([t], folded, bias) for t in texts])
    assert np.allclose(alone, quality.score_texts(texts, folded, bias))
    assert np.allclose(alone[3], quality.softmax(bias[None])[0])


def test_edge_cases_on_spark(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, 0), (7, 0), (8, 0), (8, 1), (9, None), (None, 1)],
                                   "doc_id long, quality int")
    model = quality.fit(spark, docs, labels, "quality")
    keep = tuple(docs.columns)
    got = quality.score(spark, docs, model, keep=keep, into="__q").collect()
    assert len(got) == docs.count() and all(0 <= r["__q"] <= 1 for r in got)
    empty = {r["__q"] for r in got if not r.text}
    assert len(empty) == 1
    assert quality.fit(spark, docs, labels.where("false"), "quality") is None
    assert {r.score for r in quality.score(spark, docs, None).collect()} == {0.5}
    assert quality.score(spark, none, model).collect() == []
    lang = language.fit(spark, docs)
    assert lang.languages == ["de", "en", "fr"]
    got = language.predict(spark, docs, lang, keep=keep, into=("__l", "__s")).collect()
    assert len(got) == docs.count()
    assert all((r["__l"] == "und") == (r.doc_id in (2, 3, 4, 7)) for r in got)
    assert language.fit(spark, none) is None
    assert {r.lang_pred for r in language.predict(spark, docs, None).collect()} == {"und"}
    assert language.predict(spark, none, lang).collect() == []


def test_training_sample_is_bounded(spark):
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string"))
                                   .alias("text"), F.lit("en").alias("lang"))
    assert language.fit(spark, many, per_language=5, per_document=1) is not None
