"""Token counts with a digest cache.

A text's digest covers the tokenizer's version and the normalised content.
Counts stored under a digest are joined; only distinct texts without a stored
count are encoded, and their counts are appended to the cache.

Defined cases: null text counts as empty (0 bytes, 0 tokens); a null or
repeated document id keeps one output row per input row; an empty table gives
an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, worker_state

#: Parts that a worker remembers at most; beyond it the memory starts anew.
MEMO_ENTRIES = 800_000
#: Longer parts are encoded but not remembered (bounds the memory, not the result).
MEMO_PART_BYTES = 64


def load_spec(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def drops_white_space(spec: bytes) -> bool:
    """Whether encoding a text equals encoding its parts between ASCII white space.

    True for a tokenizer file whose pre-tokenizer removes white space and whose
    added tokens neither hold white space nor strip it.
    """
    if spec[:1] != b"{":
        return False
    j = json.loads(spec)
    steps = (j.get("pre_tokenizer") or {}).get("pretokenizers") or [j.get("pre_tokenizer") or {}]
    first = steps[0]
    removes = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
               and "\\s" not in first["pattern"].get("Regex", "\\s").replace("[^\\s", "[^"))
    rest = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
    clean = all(t["content"].split() == [t["content"]] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                for t in j.get("added_tokens", []))
    return bool(removes and rest and clean and j.get("post_processor") is None)


def lower_words(spec: bytes) -> bool:
    """Whether a lower-cased Latin word is one pre-token of the file, and a run of punctuation another."""
    if not drops_white_space(spec):
        return False
    j = json.loads(spec)
    steps = [s["type"] for s in (j.get("normalizer") or {}).get("normalizers", [])]
    pattern = j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if "pretokenizers" in j["pre_tokenizer"] else ""
    return (steps == ["NFC", "Replace", "Lowercase"] and j["model"]["type"] == "BPE"
            and "[\\p{L}]+" in pattern and pattern.endswith("[^\\s\\p{L}\\p{N}]+")
            and all(a.startswith(("'", "[")) for a in pattern.split("|")))


#: A lower-case Latin-1 word and the ASCII punctuation (no apostrophe) behind it.
WORD = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit integers.

    For tokenizers that drop white space a text is encoded part by part, each
    distinct part once. A part of one Latin word and punctuation goes straight
    to the library's model, as the library would hand it over; any other part
    goes through the whole library. Other tokenizers encode whole texts.
    """

    def __init__(self, spec: bytes):
        self.raw: dict[bytes, bytes] = {}      # parts as they stand
        self.lower: dict[bytes, bytes] = {}    # parts of lower-cased Latin-1 texts
        self.words: dict[str, bytes] = {}
        self.by_part, self.by_word = drops_white_space(spec), lower_words(spec)
        self.piece = None
        if spec[:1] == b"{":
            from tokenizers import Tokenizer, pre_tokenizers
            self.tok = Tokenizer.from_str(spec.decode())
            self.tok.no_truncation()
            self.tok.no_padding()
            self.model = self.tok.model
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            # what the library's byte level makes of each character that WORD can match
            self.level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in [*range(33, 127), *range(0xDF, 0x100)]}
        else:
            import sentencepiece
            self.piece = sentencepiece.SentencePieceProcessor(model_proto=spec)

    def _word(self, w: str) -> bytes:
        got = self.words.get(w)
        if got is None:
            ids = [t.id for t in self.model.tokenize(w.translate(self.level))]
            got = self.words[w] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def _learn(self, memo: dict, parts, words: bool) -> None:
        import numpy as np
        odd = []
        for p in parts:
            m = WORD.fullmatch(p.decode()) if words and len(p) <= MEMO_PART_BYTES else None
            if m is None:
                odd.append(p)
            else:
                memo[p] = self._word(m[1]) + (self._word(m[2]) if m[2] else b"")
        for i in range(0, len(odd), 4000):
            some = odd[i:i + 4000]
            e = self.tok.encode([p.decode() for p in some], is_pretokenized=True, add_special_tokens=False)
            cuts = np.searchsorted(np.asarray(e.word_ids, dtype=np.int64), np.arange(len(some) + 1)).tolist()
            raw = np.asarray(e.ids, dtype="<u4").tobytes()
            for k, p in enumerate(some):
                memo[p] = raw[4 * cuts[k]:4 * cuts[k + 1]]

    def _by_part(self, split: list[list[bytes]], name: str, words: bool) -> list[bytes]:
        memo = getattr(self, name)
        need = set().union(*split)
        new = need - memo.keys()
        if len(memo) + len(new) > MEMO_ENTRIES:
            setattr(self, name, memo := {})
            new = need
        if len(self.words) > MEMO_ENTRIES:
            self.words = {}
        self._learn(memo, new, words)
        out = [b"".join(map(memo.__getitem__, parts)) for parts in split]
        for p in new:
            if len(p) > MEMO_PART_BYTES:
                del memo[p]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.by_part:
            low, raw = [], []
            for i, t in enumerate(texts):
                s = t.decode()
                try:
                    if not self.by_word or "<|" in s:
                        raise ValueError
                    s.encode("latin-1")
                    low.append((i, s.lower().encode().split()))
                except ValueError:
                    raw.append((i, t.split()))
            out: list = [b""] * len(texts)
            for some, name, words in ((low, "lower", True), (raw, "raw", False)):
                if some:
                    for (i, _), v in zip(some, self._by_part([p for _, p in some], name, words), strict=True):
                        out[i] = v
            return out
        import numpy as np
        if self.piece is not None:
            ids = self.piece.encode([t.decode() for t in texts], num_threads=1)
        else:
            ids = [e.ids for e in self.tok.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
        return [np.asarray(x, dtype="<u4").tobytes() for x in ids]


def encoder(spec: bytes) -> Encoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_state(("encoder", hashlib.sha256(spec).digest()), lambda: Encoder(spec))


def text_blocks(batch: pa.RecordBatch, column: str, most: int = 4_000_000):
    """(first row, texts as bytes) in blocks of bounded size; null is empty."""
    block, size, start = [], 0, 0
    for i, v in enumerate(batch.column(column)):
        raw = v.as_buffer()
        t = raw.to_pybytes() if raw is not None else b""
        block.append(t)
        size += len(t)
        if size >= most:
            yield start, block
            block, size, start = [], 0, i + 1
    if block:
        yield start, block


def normalised(text, spec: bytes):
    """Content on which the count depends: white-space runs as one space where the tokenizer drops them."""
    text = F.coalesce(text, F.lit(""))
    if drops_white_space(spec):
        return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    return text


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer_path: str, cache_path: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row of ``docs``; new counts are appended to ``cache_path``.

    ``cache_path`` is a folder on shared storage; it may not exist yet.  A run
    that fails leaves the cache as it was: the append is committed as one job.
    """
    spec = load_spec(tokenizer_path)
    version = hashlib.sha256(spec).hexdigest()
    scratch = Scratch(spark, "tokens")
    digest = F.unhex(F.sha2(F.concat(F.lit(version + "\n"), normalised(F.col(text_col), spec)).cast("binary"), 256))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = scratch.stage(
        docs.select("id", digest.alias("digest"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
                    .alias("n_bytes")), "keyed")
    stored = _stored(spark, cache_path)
    holders = keyed.groupBy("digest").agg(F.min("id").alias("id"))
    misses = holders.join(stored, "digest", "left_anti")
    # the holder's text; the key has the id too, so a hot digest does not meet in one task
    texts = docs.select("id", digest.alias("digest"), "text").alias("d").join(
        misses.hint("shuffle_hash").alias("m"),
        F.col("d.digest").eqNullSafe(F.col("m.digest")) & F.col("d.id").eqNullSafe(F.col("m.id")), "left_semi")
    shared = spark.sparkContext.broadcast(spec)

    def count(batches):
        enc = encoder(shared.value)
        for b in batches:
            digests = b.column("digest")
            for start, block in text_blocks(b, "text"):
                n = [len(x) // 4 for x in enc.encode(block)]
                yield pa.RecordBatch.from_arrays(
                    [digests.slice(start, len(block)).cast(pa.binary()), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    new = texts.select("digest", F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "digest binary, n_tokens bigint")
    (new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
     .write.mode("append").option("compression", "zstd").parquet(cache_path))
    counts = _stored(spark, cache_path)
    return (keyed.join(counts, "digest", "left")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens"))


def _stored(spark: SparkSession, cache_path: str) -> DataFrame:
    """The cache, one row per digest (two jobs may have appended the same text)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    schema = "digest binary, n_tokens bigint"
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cache_path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
