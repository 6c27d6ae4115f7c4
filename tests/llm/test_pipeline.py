"""The pipeline end to end against a plain version of its stages."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from civicledger.llm import pii, quality, queries

from test_joins import brute_components
from test_tokens_packing import check_places

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = queries.quality_model(spark, SF, docs)
    ids = list(rows)
    p = quality.score_texts([(rows[i].text or "").encode() for i in ids], model.folded, model.bias)
    good = {i for i, s in zip(ids, p[:, model.classes.index(1)]) if s >= P.LEAST_QUALITY}
    kept = P.good_quality(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == docs.columns
    clear = sorted(r.doc_id for r in P.clear_language(spark, kept, SF).collect())
    assert set(clear) <= good and len(clear) >= 0.95 * len(good)
    first = sorted({int(s.split(", ")[2].rstrip(")")) for s in brute_components([(i, rows[i].text) for i in clear])})
    masked = {r.doc_id: r.text for r in pii.pseudonymise(docs, queries.PII_KEY).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i in first:
        enc = [*tok.encode(masked[i], add_special_tokens=False).ids, 1]
        want += [(i, k, a, len(enc[a:a + 4096]), zlib.crc32(np.array(enc[a:a + 4096], "<u4").tobytes()))
                 for k, a in enumerate(range(0, len(enc), 4096))]
    got = P.run(spark, SF).collect()
    assert sorted(want) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    total = sum(r.length for r in got)
    assert check_places(got, 4096) <= -(-total // 4096) + 2


def test_stages_are_the_registered_ones():
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run and len(P.STAGES) == 5
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.QUERIES}
