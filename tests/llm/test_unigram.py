"""Unigram search against full enumeration and the library's lattice; exact round trips."""

import itertools

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from civicledger.llm import unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return unigram.Codec(unigram.Pieces.load(PATH))


def ids(codec, text):
    return np.frombuffer(codec.encode([text.encode()])[0], "<u4").tolist()


def enumerate_best(codec, part: bytes) -> float:
    keys = {codec_piece: s for codec_piece, s in KEYS.items()}
    best = -np.inf
    for cuts in itertools.product([0, 1], repeat=len(part) - 1):
        edges = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(part)]
        some = [part[a:b] for a, b in itertools.pairwise(edges)]
        if all(s in keys for s in some):
            best = max(best, sum(keys[s] for s in some))
    return best


KEYS = {"▁".encode(): -5.0, b"a": -3.0, b"b": -3.5, b"ab": -5.0, b"ba": -5.5, b"aba": -7.5, "▁a".encode(): -6.0,
        b"bb": -8.0, "é".encode(): -4.0}


def test_search_is_the_best_of_all_segmentations():
    names = [b"<unk>", *KEYS, *(f"<0x{k:02X}>".encode() for k in range(256))]
    byte_ids = {k: 1 + len(KEYS) + k for k in range(256)}
    c = unigram.Codec(unigram.Pieces(names, [0.0, *KEYS.values(), *[0.0] * 256], byte_ids, {0}))
    for n in range(1, 7):
        for word in itertools.product("ab", repeat=n):
            part = ("▁" + "".join(word)).encode()
            got = c._one(part)
            assert got == c._many([part])[0]
            assert sum(c.scores[i] for i in got) == enumerate_best(c, part)
    assert c._many(["▁aéz".encode()])[0] == c._one("▁aéz".encode())
    assert c._one("▁z".encode())[-1] == byte_ids[ord("z")]


def test_scores_equal_the_librarys_lattice(codec):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1                   # the same pieces and scores, searched as a unigram model
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    words = "the theroution erlyeaat Ouwhea Größe ciónmente understanding internationalisation élève x".split()
    for w in words:
        best = lib.nbest_encode(w, nbest_size=4)[0]     # its lattice; plain encode takes another route
        got = ids(codec, w)
        assert sum(codec.scores[i] for i in got) == sum(codec.scores[i] for i in best), w


@pytest.mark.parametrize("text", ["Hello  world \n tab\tÉé 漢字 😀", "  lead", "trail  ", " ", "", "a" * 300, "x\n\ny",
                                  "퟿ end", "one two  three   four"])
def test_round_trip(codec, text):
    assert codec.decode(np.array(ids(codec, text))) == text


def test_parts_equal_one_search_over_the_whole_text(codec):
    text = "The theroution of 漢字 in  élève\nand so on"
    whole = codec._one("▁".encode() + text.replace(" ", "▁").encode())
    assert ids(codec, text) == whole


def test_broken_bytes_decode_to_replacement(codec):
    assert codec.decode(codec.byte_ids[[0xE6, 0x41]]) == "�A"


def test_edge_cases_on_spark(spark, docs, none):
    got = unigram.encode(spark, docs, PATH)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    back = {(r.doc_id, r.text) for r in unigram.decode(spark, got, PATH).collect()}
    assert back == {(r.doc_id, r.text or "") for r in docs.collect()}
    assert unigram.encode(spark, none, PATH).collect() == []
    marked = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert [r.round_trip for r in unigram.encode(spark, marked, PATH).collect()] == [False]
