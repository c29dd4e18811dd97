"""Encoding of texts by a public byte-level BPE vocabulary, with a rank queue that suits pre-tokens of any length."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

#: Fixed values of the vocabulary: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries of a worker's cache of encoded pieces, which is emptied when full, and the longest piece kept in it.
CACHE, PIECE = 200_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


def load_merges(path: str = VOCABULARY) -> tuple[list[int], np.ndarray]:
    """Id of each byte; merges as rows (left id, right id, id) in the order of their ranks."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return [vocab[c] for c in byte_letters()], np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int32)


class RankQueue:
    """Buckets of linked-list positions by merge rank under a bitmap of two levels of 256 bits: push, and pop of the bucket
    of least rank by two find-first-sets. Positions are not taken out when their pair changes; the reader skips stale ones."""

    def __init__(self):
        self.top, self.low, self.buckets = 0, {}, {}

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(at)
            return
        self.buckets[rank] = [at]
        word = rank >> 8
        self.top |= 1 << word
        self.low[word] = self.low.get(word, 0) | 1 << (rank & 255)

    def pop(self) -> tuple[int, list[int]] | None:
        """Least rank and its positions from left to right; None if empty."""
        if not self.top:
            return None
        word = (self.top & -self.top).bit_length() - 1
        bits = self.low[word]
        first = bits & -bits
        if bits == first:
            self.top &= self.top - 1
            del self.low[word]
        else:
            self.low[word] = bits ^ first
        rank = word << 8 | first.bit_length() - 1
        return rank, sorted(self.buckets.pop(rank))


class Pieces(dict):
    """Ids of a piece of text and the blank before it, found when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> list[int]:
        found = self.encode(" " + piece)
        if len(piece) <= PIECE:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """Ids of a text. Text that looks like a special token is plain text; the text is encoded as it is."""

    def __init__(self, byte_ids: list[int], merges: np.ndarray):
        self.byte_ids = byte_ids
        self.ranks = {(a, b): r for r, (a, b, _) in enumerate(merges.tolist())}
        self.ids = merges[:, 2].tolist()
        self.split = regex.compile(PATTERN).findall
        # Two blanks in one run of white space: such a text may not be cut at every blank.
        self.tangled = re.compile(r" \s* ").search
        self.words: dict[str, list[int]] = {}
        self.pieces = Pieces(self.whole)

    def merge(self, ids: list[int]) -> list[int]:
        """Ids after all merges, least rank first and leftmost first within it."""
        n, get = len(ids), self.ranks.get
        if n < 2:
            return ids
        after, before, rank_at = [*range(1, n), -1], [*range(-1, n - 1)], [-1] * n
        queue = RankQueue()
        for i in range(n - 1):
            r = get((ids[i], ids[i + 1]))
            if r is not None:
                rank_at[i] = r
                queue.push(r, i)
        while (least := queue.pop()) is not None:
            rank, places = least
            for i in places:
                if rank_at[i] != rank:
                    continue  # stale: a merge beside it has changed the pair
                j = after[i]
                k = after[j]
                ids[i], ids[j], rank_at[j], rank_at[i] = self.ids[rank], -1, -1, -1
                after[i] = k
                if k >= 0:
                    before[k] = i
                    r = get((ids[i], ids[k]))
                    if r is not None:
                        rank_at[i] = r
                        queue.push(r, i)
                h = before[i]
                if h >= 0:
                    r = get((ids[h], ids[i]))
                    if r is None:
                        rank_at[h] = -1
                    elif r != rank_at[h]:
                        rank_at[h] = r
                        queue.push(r, h)
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        found = self.words.get(word)
        if found is None:
            of = self.byte_ids
            found = self.merge([of[b] for b in word.encode("utf-8", "surrogatepass")])
            if len(word) <= PIECE:
                if len(self.words) >= CACHE:
                    self.words.clear()
                self.words[word] = found
        return found

    def whole(self, text: str) -> list[int]:
        out: list[int] = []
        for w in self.split(text):
            out += self.word(w)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; the empty list for an empty or null one.

        A pre-token never goes on over a blank that follows something else than white space, so the text between such
        blanks can be encoded by itself and looked up; only texts with several blanks in one run are split as a whole.
        """
        if not text:
            return []
        if self.tangled(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        out = self.whole(first)
        out.extend(chain.from_iterable(map(self.pieces.__getitem__, rest)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(key: str, packed) -> Encoder:
    """The worker's encoder, kept between tasks of a process so that its cache stays warm."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        byte_ids, merges = packed.value
        _ENCODERS[key] = Encoder(byte_ids, merges)
    return _ENCODERS[key]


def encoded(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY, counts: bool = False) -> DataFrame:
    """`keep` and `ids` (array<int>) of each row, or with counts only `n_tokens` (int) in their place.

    Empty and null texts have the empty list (0 tokens); repeated rows stay; texts are never cut. The driver reads the
    vocabulary (of fixed size, 50,000 merges) and sends it to the workers. Other columns of df are not read.
    """
    spark = df.sparkSession
    packed = spark.sparkContext.broadcast(load_merges(vocabulary))
    some = df.select(*keep, F.col(text).alias("__text"))
    fields = [some.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("n_tokens", T.IntegerType()) if counts else T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    names = [*keep, schema.fields[-1].name]
    small = 1_500_000  # ids in a batch that is sent back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(vocabulary, packed).encode
        for batch in batches:
            texts = batch.column(len(keep))
            at, ends, chunks, total = 0, [0], [], 0
            for i in range(len(texts)):
                ids = encode(texts[i].as_py())
                total += len(ids)
                ends.append(total)
                if not counts:
                    chunks.append(np.array(ids, np.int32))
                if total >= small or i == len(texts) - 1:
                    kept = [batch.column(c).slice(at, i + 1 - at) for c in range(len(keep))]
                    if counts:
                        last = pa.array(np.diff(np.array(ends, np.int64)).astype(np.int32))
                    else:
                        last = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.concatenate(chunks)))
                    yield pa.RecordBatch.from_arrays([*kept, last], names=names)
                    at, ends, chunks, total = i + 1, [0], [], 0

    return some.mapInArrow(run, schema)
