"""Digest cache and packing: against the library, and against their definitions."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicledger.llm import packing, tokens
from civicledger.llm.common import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["it's Straße, Größe!! ÿ «x» µ a-b c_d (x) don't, 5th x2 é²", "Ab..cd ,x", "a <|endoftext|>  b",
         "<|ENDOFTEXT|> <|endoftext|>x<|startoftext|>", "É́ é́  x y", "Σας ΣΑΣ İi",
         "it's DON'T 123abc", "", "  ", "x\x1cy \x85 z\xa0w", "́ a", "a" * 500, "😀 ok. OK! the,the The"]


def library(texts):
    tok = Tokenizer.from_file(PATH)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_parts_encode_as_whole_texts():
    enc = tokens.Encoder(tokens.load_spec(PATH))
    assert enc.by_part and enc.by_word
    for _ in range(2):                          # the second time from memory
        got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode([t.encode() for t in TEXTS])]
        assert got == library(TEXTS)


def test_tokenizers_that_keep_white_space_encode_whole_texts():
    spec = tokens.load_spec(public_tokenizers.path("byte_bpe_50k.json"))
    assert not tokens.drops_white_space(spec) and not tokens.lower_words(spec)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = [np.frombuffer(b, "<u4").tolist() for b in tokens.Encoder(spec).encode([t.encode() for t in TEXTS])]
    assert got == [e.ids for e in tok.encode_batch(TEXTS, add_special_tokens=False)]


def test_memory_bound_does_not_change_results(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 3)
    enc = tokens.Encoder(tokens.load_spec(PATH))
    got = [np.frombuffer(enc.encode([t.encode()])[0], "<u4").tolist() for t in TEXTS * 2]
    assert got == library(TEXTS * 2)


def test_counts_of_edge_cases(spark, docs, none):
    cache = Scratch(spark, "t").path("cache")
    got = tokens.token_counts(spark, docs, PATH, cache)
    want = docs.select("doc_id", "text").collect()
    n = library([r.text or "" for r in want])
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r.doc_id, len((r.text or "").encode()), len(i)) for r, i in zip(want, n)), key=key) == \
        sorted((tuple(r) for r in got.collect()), key=key)
    assert tokens.token_counts(spark, none, PATH, cache).collect() == []


def test_cache_is_appended_once_per_text_and_read(spark, docs):
    cache = Scratch(spark, "t").path("cache")
    first = sorted(map(str, tokens.token_counts(spark, docs, PATH, cache).collect()))
    stored = spark.read.parquet(cache)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("t")).collect()
    assert stored.count() == len({" ".join(r.t.split()) for r in texts})
    # a stored count is used as it stands: a changed one shows up
    stored.select("digest", (F.col("n_tokens") + 1000).alias("n_tokens")).write.mode("append").parquet(cache)
    again = tokens.token_counts(spark, docs, PATH, cache).collect()
    assert all(r.n_tokens >= 1000 for r in again)
    assert len(again) == len(first)


@pytest.mark.parametrize("capacity", [7, 64])
def test_pieces_and_places(spark, docs, capacity):
    got = packing.pack_documents(spark, docs, PATH, capacity=capacity).collect()
    want = docs.select("doc_id", "text").collect()
    expected = []
    for r, ids in zip(want, library([r.text or "" for r in want])):
        ids = ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            some = ids[a:a + capacity]
            expected.append((r.doc_id or 0, k, a, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    assert sorted(expected) == sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    check_places(got, capacity)


def check_places(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in bins.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_tight_and_repeatable(spark, none):
    rng = np.random.default_rng(3)
    lengths = np.minimum(4095, rng.lognormal(6.5, 1, 5000).astype(int) + 1).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "id long, length int")
    runs = [sorted(map(tuple, packing.pack(spark, items, 4096, problem_size=700).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    bins = {}
    for i, level, problem, b, offset in runs[0]:
        bins.setdefault((level, problem, b), []).append(lengths[i])
    assert sorted(i for i, *_ in runs[0]) == list(range(5000))
    assert max(map(sum, bins.values())) <= 4096
    assert len(bins) <= 1.005 * -(-sum(lengths) // 4096) + 1
    assert packing.pack_documents(spark, none, PATH).collect() == []


@pytest.mark.parametrize("others", [0, 10000])
def test_small_pieces_come_to_an_end(spark, others):
    """One-token pieces alone, and as a third of a table: their bins must not be opened for ever."""
    rng = np.random.default_rng(4)
    lengths = [1] * 5000 + np.minimum(4095, rng.lognormal(5, 1, others).astype(int) + 1).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "id long, length int")
    got = packing.pack(spark, items, 4096, generations=1).collect()
    assert sorted(r.id for r in got) == list(range(len(lengths)))
    bins = {}
    for r in got:
        bins.setdefault((r.level, r.problem, r.bin), []).append(lengths[r.id])
    assert max(map(sum, bins.values())) <= 4096
    assert len(bins) <= 1.005 * -(-sum(lengths) // 4096) + 1


def test_every_level_has_fewer_problems():
    n, levels = packing.problem_count(10 ** 12, 10 ** 12, 4096, 1536, None), 1
    while n > 1:                                # nothing gets settled: the worst case
        now = packing.problem_count(10 ** 12, 10 ** 15, 4096, 1536, n)
        assert now < n
        n, levels = now, levels + 1
    assert levels < 64                          # the bits of a level in sequence_id


def test_genetic_steps_keep_groupings_valid():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 60, 300)
    people = packing.first_population(lengths, 100, 4, rng)
    before = max(packing.fitness(lengths, p, 100) for p in people)
    child = packing.mutate(lengths, packing.crossover(lengths, people[0], people[1], 100, rng), 100, rng)
    assert np.bincount(child, weights=lengths).max() <= 100 and len(child) == 300
    after = packing.evolve(lengths, people, 100, 6, rng)
    assert packing.fitness(lengths, after[0], 100) >= before


def hard_cases():
    """Pieces that fit by threes at most, and triplets that fill a sequence exactly."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(900, 1500, 500), rng.integers(900, 1500, 500)
    return [rng.integers(1000, 2049, 1500), np.concatenate([a, b, 4096 - a - b])]


@pytest.mark.parametrize("case, gain", [(0, 0.01), (1, 0.015)])
def test_the_search_packs_hard_cases_tighter_than_best_fit(spark, case, gain):
    lengths = hard_cases()[case]
    plain = packing.first_population(lengths, 4096, 1, np.random.default_rng(0))[0].max() + 1
    items = spark.createDataFrame(list(enumerate(lengths.tolist())), "id long, length int")
    got = packing.pack(spark, items, 4096).collect()
    bins = {}
    for r in got:
        bins.setdefault((r.level, r.problem, r.bin), []).append(int(lengths[r.id]))
    assert sorted(r.id for r in got) == list(range(1500)) and max(map(sum, bins.values())) <= 4096
    assert len(bins) <= (1 - gain) * plain


def test_a_best_fit_that_needs_the_fewest_bins_is_not_searched_on():
    lengths = np.array([4000, 96, 2048, 2048, 1])
    people = packing.starters(lengths, 4096, 16, np.random.default_rng(0))
    assert len(people) == 1 and people[0].max() + 1 == 3
    assert packing.evolve(lengths, people, 4096, 16, None)[0].tolist() == people[0].tolist()
