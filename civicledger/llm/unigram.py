"""SentencePiece encoding and decoding by a unigram Viterbi search.

The pieces of a model file and their stored scores, taken as log scores, are
kept in a double-array trie over UTF-8 bytes. The best segmentation of a text
has the highest sum of scores; of equal sums the one whose last piece starts
earlier. A character that is no piece costs ten less than the worst piece and is
written as byte pieces. Blanks become the marker U+2581, and one is put in front.

Where no piece holds the marker behind another character, a text falls apart
before every blank, and equal parts are searched once: many short parts advance
through the trie together, long parts one by one. The result is the same as that
of one search over the whole text.

Defined cases: null and empty texts have no ids and decode to the empty text; a
text that itself holds the marker decodes to a blank there (``round_trip`` is
false); repeated rows are encoded alike; texts of any length are searched whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import worker_state
from .tokens import text_blocks

MARK = "▁".encode()
#: Parts of a worker's memory at most; beyond it the memory starts anew.
MEMO_ENTRIES = 400_000
#: Longer parts are searched one by one and not remembered.
TOGETHER_BYTES = 48


LEADING = re.compile(rb"^(?:\xe2\x96\x81)+")


class Pieces:
    """Pieces with log scores; byte pieces and control pieces are known by id."""

    def __init__(self, pieces: list[bytes], scores: list[float], byte_ids: dict[int, int], control: set[int]):
        self.pieces, self.scores, self.byte_ids, self.control = pieces, scores, byte_ids, control

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        names = [m.id_to_piece(i) for i in range(n)]
        byte_ids = {int(names[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        control = {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
        return Pieces([p.encode() for p in names], [m.get_score(i) for i in range(n)], byte_ids, control)

    def searched(self) -> list[int]:
        hidden = self.control | set(self.byte_ids.values())
        return [i for i in range(len(self.pieces)) if i not in hidden and self.pieces[i]]


class DoubleArray:
    """Trie in two arrays: the child of s by byte c is t = base[s] + c + 1 where check[t] = s."""

    def __init__(self, keys: dict[bytes, int]):
        items = sorted(keys.items())
        used = bytearray(1 << 16)
        used[0] = 1
        base, check, value = {}, {0: 0}, {}
        lowest, top = 1, 1
        stack = [(0, 0, len(items), 0)]
        while stack:
            state, a, b, depth = stack.pop()
            if len(items[a][0]) == depth:
                value[state] = items[a][1]
                a += 1
            children = []
            while a < b:
                c, first = items[a][0][depth], a
                while a < b and items[a][0][depth] == c:
                    a += 1
                children.append((c + 1, first, a))
            if not children:
                continue
            while used[lowest]:
                lowest += 1
            # a free place near the front is tried a few times, then the end is taken; gaps serve small nodes later
            at = max(0, lowest - children[0][0])
            for _ in range(100):
                if not any(used[at + c] for c, _, _ in children):
                    break
                at += 1
            else:
                at = max(0, top + 1 - children[0][0])
            base[state] = at
            for c, first, last in children:
                used[at + c] = 1
                check[at + c] = state
                top = max(top, at + c)
                stack.append((at + c, first, last, depth + 1))
            if top + 1000 > len(used):
                used.extend(bytes(len(used)))
        self.base, self.check, self.value = (np.full(top + 300, x, np.int32) for x in (0, -1, -1))
        for out, some in ((self.base, base), (self.check, check), (self.value, value)):
            out[list(some)] = list(some.values())


class Codec:
    def __init__(self, pieces: Pieces):
        ids = pieces.searched()
        self.trie = DoubleArray({pieces.pieces[i]: i for i in ids})
        self.scores = np.array(pieces.scores, np.float64)
        self.unknown = min(self.scores[i] for i in ids) - 10
        self.longest = max(len(pieces.pieces[i]) for i in ids)
        self.byte_ids = np.array([pieces.byte_ids.get(b, -1) for b in range(256)])
        self.text = [b"" if i in pieces.control else p.replace(MARK, b" ") for i, p in enumerate(pieces.pieces)]
        for b, i in pieces.byte_ids.items():
            self.text[i] = bytes([b])
        self.is_byte = np.zeros(len(self.text), bool)
        self.is_byte[list(pieces.byte_ids.values())] = True
        #: Whether texts fall apart before blanks.
        self.apart = not any(MARK in LEADING.sub(b"", pieces.pieces[i]) for i in ids)
        self.memo: dict[bytes, bytes] = {}

    # --- search

    def _one(self, part: bytes) -> list[int]:
        base, check, value = self.lists()
        scores, n = self.score_list, len(part)
        best, start, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == -np.inf:
                continue
            b0 = part[i]
            width = 1 if b0 < 0x80 else 2 if b0 < 0xE0 else 3 if b0 < 0xF0 else 4
            state, single = 0, False
            for j in range(i, n):
                nxt = base[state] + part[j] + 1
                if check[nxt] != state:
                    break
                state = nxt
                v = value[state]
                if v >= 0:
                    single |= j + 1 - i == width
                    if here + scores[v] > best[j + 1]:
                        best[j + 1], start[j + 1], piece[j + 1] = here + scores[v], i, v
            if not single and here + self.unknown > best[i + width]:
                best[i + width], start[i + width], piece[i + width] = here + self.unknown, i, -1
        return self._back(part, start, piece)

    def lists(self):
        if not hasattr(self, "_lists"):
            self._lists = self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()
            self.score_list = self.scores.tolist()
        return self._lists

    def _back(self, part, start, piece) -> list[int]:
        out, at = [], len(part)
        while at:
            i = start[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [int(self.byte_ids[b]) for b in reversed(part[i:at])]
            at = i
        return out[::-1]

    def _many(self, parts: list[bytes]) -> list[list[int]]:
        """The searches of short parts, all at once."""
        n = len(parts)
        size = np.array([len(p) for p in parts])
        wide = int(size.max())
        text = np.full((wide + 4, n), -1, np.int32)
        for k in range(wide):
            some = np.flatnonzero(size > k)
            text[k, some] = [parts[i][k] for i in some]
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        best = np.full((wide + 5, n), -np.inf)
        best[0] = 0
        start, piece = np.zeros((wide + 5, n), np.int32), np.full((wide + 5, n), -1, np.int32)
        for i in range(wide):
            col = np.flatnonzero((best[i] > -np.inf) & (size > i))
            if not len(col):
                continue
            here = best[i, col]
            b0 = text[i, col]
            width = np.where(b0 < 0x80, 1, np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4)))
            single = np.zeros(len(col), bool)
            k, state = np.arange(len(col)), np.zeros(len(col), np.int32)
            for j in range(i, min(wide, i + self.longest)):
                c = text[j, col[k]]
                nxt = base[state] + c + 1
                ok = (c >= 0) & (check[nxt] == state)
                k, state = k[ok], nxt[ok]
                if not len(k):
                    break
                v = value[state]
                end = v >= 0
                ke, ve = k[end], v[end]
                single[ke] |= j + 1 - i == width[ke]
                score = here[ke] + self.scores[ve]
                better = score > best[j + 1, col[ke]]
                at = col[ke[better]]
                best[j + 1, at], start[j + 1, at], piece[j + 1, at] = score[better], i, ve[better]
            odd = np.flatnonzero(~single)
            score, to, at = here[odd] + self.unknown, i + width[odd], col[odd]
            better = score > best[to, at]
            to, at = to[better], at[better]
            best[to, at], start[to, at], piece[to, at] = score[better], i, -1
        return [self._back(p, start[:, i], piece[:, i]) for i, p in enumerate(parts)]

    def parts(self, text: bytes) -> list[bytes]:
        """What a text falls apart into; without markers inside pieces each part is searched alone."""
        if not text:
            return []
        marked = MARK + text.replace(b" ", MARK)
        if not self.apart:
            return [marked]
        return PART.findall(marked)

    def learn(self, parts: set[bytes]) -> None:
        short = [p for p in parts if len(p) <= TOGETHER_BYTES]
        short.sort(key=len)
        for a in range(0, len(short), 8192):
            some = short[a:a + 8192]
            for p, ids in zip(some, self._many(some), strict=True):
                self.memo[p] = np.array(ids, "<u4").tobytes()
        for p in parts:
            if len(p) > TOGETHER_BYTES:
                self.memo[p] = np.array(self._one(p), "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.parts(t) for t in texts]
        need = set().union(*split)
        new = need - self.memo.keys()
        if len(self.memo) + len(new) > MEMO_ENTRIES:
            self.memo, new = {}, need
        self.learn(new)
        out = [b"".join(map(self.memo.__getitem__, p)) for p in split]
        for p in new:
            if len(p) > TOGETHER_BYTES:
                del self.memo[p]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, markers as blanks, byte pieces as their bytes (invalid ones as U+FFFD); the first blank goes."""
        raw = b"".join(map(self.text.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


PART = re.compile(rb"(?:\xe2\x96\x81)+(?:(?!\xe2\x96\x81).)*", re.S)

ENCODED = "n_pieces bigint, n_byte_pieces bigint, ids_crc32 bigint, round_trip boolean, ids array<int>"


def encode(spark: SparkSession, docs: DataFrame, model_path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_pieces, n_byte_pieces, ids_crc32, round_trip, ids) per row; round_trip: the ids decode to the text."""
    shared = spark.sparkContext.broadcast(Pieces.load(model_path))
    key = zlib.crc32(repr(model_path).encode())

    def run(batches):
        codec = worker_state(("unigram", key, len(shared.value.pieces)), lambda: Codec(shared.value))
        for b in batches:
            for first, block in text_blocks(b, "text"):
                raw = codec.encode(block)
                ids = [np.frombuffer(r, "<u4") for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(first, len(block)), pa.array([len(i) for i in ids], pa.int64()),
                     pa.array([int(codec.is_byte[i].sum()) for i in ids], pa.int64()),
                     pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                     pa.array([codec.decode(i) == t.decode() for i, t in zip(ids, block, strict=True)]),
                     pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(i) for i in ids]), pa.int32()), pa.array(
                         np.concatenate(ids).astype(np.int32)))],
                    ["id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id bigint, {ENCODED}").withColumnRenamed("id", id_col)


def decode(spark: SparkSession, encoded: DataFrame, model_path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows with an array of ids; null ids decode to a null text."""
    shared = spark.sparkContext.broadcast(Pieces.load(model_path))

    def run(batches):
        codec = Codec(shared.value)
        for b in batches:
            texts = [None if x is None else codec.decode(np.array(x, np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return (encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "id bigint, text string").withColumnRenamed("id", id_col))
