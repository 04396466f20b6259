"""Byte-level BPE encoding and decoding with public rank files.

A text is split by the pre-split pattern; pieces that are no token themselves
go, bucketed by length, into padded matrices of token ids. Each round every
row merges its leftmost pair of least rank, found by a hashed pair lookup over
whole matrix columns, and closes the gap; rows without a mergeable pair leave
the matrix. Pieces longer than LONG_PIECE bytes are rows of their own, where
all occurrences of the least pair merge in one round whenever that equals
merging them one by one. Encodings of pieces are remembered per Python worker
up to a fixed number of pieces, so memory does not grow with the corpus.

Defined cases: null text gives the ids of the empty text (none); texts of any
length are encoded whole; special tokens' strings are ordinary text; rows are
independent, so ties, repeated rows and empty tables need no rule; other
columns pass through and a clashing ``ids`` / ``decoded`` column is replaced.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.llm.common import table

CACHE_PIECES = 400_000
LONG_PIECE = 64
CELLS = 1 << 20  # matrix cells handled at once
NONE = np.int32(2**31 - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def process_memo(key, build):
    """``build()`` once per Python worker process, also across tasks."""
    memo = sys.modules.setdefault("_basketlab_llm_memo", types.ModuleType("_basketlab_llm_memo")).__dict__
    if key not in memo:
        memo[key] = build()
    return memo[key]


class PairTable:
    """Open-addressing hash table (left id, right id) -> merged id, looked up by whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(left) * 3).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            at = slot[todo]
            free = todo[self.keys[at] == -1]
            self.keys[slot[free]] = key[free]  # of those that want one slot the last written gets it
            won = self.keys[at] == key[todo]
            self.values[at[won]] = merged[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where there is none (ids below 0 are padding)."""
        key = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], NONE)
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class Codec:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = {i: t for t, i in self.ranks.items()}
        found = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, merged = np.array(found, np.int32).reshape(-1, 3).T
        self.pairs = PairTable(left, right, merged)
        # ids whose pairs can rank below themselves: their merges go one at a time
        self.early = np.zeros(max(self.tokens) + 1, bool)
        self.early[left[merged < left]] = True
        self.early[right[merged < right]] = True
        self.memo: dict[str, bytes] = {}

    # -- merging ------------------------------------------------------------
    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Rows of ids padded with -1, merged and padded again."""
        n, width = ids.shape
        done = np.empty_like(ids)
        rows = np.arange(n)
        rank = np.where(ids[:, 1:] >= 0, self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1), NONE)
        while len(rows):
            at = rank.argmin(axis=1)  # leftmost of the least
            least = rank[np.arange(len(rows)), at]
            over = least == NONE
            if over.any():
                done[rows[over]] = ids[over]
                go = ~over
                rows, ids, rank, at, least = rows[go], ids[go], rank[go], at[go], least[go]
                if not len(rows):
                    break
            k = np.arange(len(rows))
            ids[k, at] = least
            pad = np.full((len(rows), 1), -1, np.int32)
            column = np.arange(ids.shape[1])
            ids = np.take_along_axis(np.hstack([ids, pad]), column + (column > at[:, None]), axis=1)
            column = np.arange(rank.shape[1])
            rank = np.take_along_axis(np.hstack([rank, pad * 0 + NONE]), column + (column >= at[:, None]), axis=1)
            for left in (at - 1, at):  # only the two pairs beside the merged id are new
                ok = (left >= 0) & (left < rank.shape[1])
                kk, ll = k[ok], left[ok]
                right = ids[kk, ll + 1]
                rank[kk, ll] = np.where(right >= 0, self.pairs(ids[kk, ll], right), NONE)
        return done

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        while len(ids) > 1:
            rank = self.pairs(ids[:-1], ids[1:])
            least = rank.min()
            if least == NONE:
                break
            at = np.flatnonzero(rank == least)
            if self.early[least]:
                at = at[:1]
            else:  # of overlapping occurrences every other one, from the left
                new_run = np.r_[True, np.diff(at) > 1]
                start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            ids = ids.copy()
            ids[at] = least
            ids = np.delete(ids, at + 1)
        return ids

    def _encode_pieces(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        rest = []
        for p, b in zip(pieces, raw, strict=True):
            i = self.ranks.get(b)
            if i is not None:
                self.memo[p] = np.uint32(i).tobytes()
            elif len(b) > LONG_PIECE:
                self.memo[p] = self._merge_long(self.byte_ids[np.frombuffer(b, np.uint8)]).astype("<u4").tobytes()
            else:
                rest.append((p, b))
        rest.sort(key=lambda x: len(x[1]))
        k = 0
        while k < len(rest):
            width = 4
            while width < len(rest[k][1]):
                width *= 2
            top = k
            most = k + max(1, CELLS // width)
            while top < min(most, len(rest)) and len(rest[top][1]) <= width:
                top += 1
            part = rest[k:top]
            sizes = np.array([len(b) for _, b in part])
            ids = np.full((len(part), width), -1, np.int32)
            ids[np.arange(width) < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(b for _, b in part), np.uint8)]
            merged = self._merge_rows(ids)
            left = merged >= 0
            flat = merged[left].astype("<u4").tobytes()
            ends = (4 * left.sum(axis=1).cumsum()).tolist()
            for (p, _), a, b in zip(part, [0, *ends], ends, strict=False):
                self.memo[p] = flat[a:b]
            k = top

    # -- texts --------------------------------------------------------------
    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for k in _chunks(texts):
            split = [self.split(t) for t in k]
            new: set[str] = set()
            for pieces in split:
                new.update(pieces)
            new = new.difference(self.memo)
            if len(self.memo) + len(new) > CACHE_PIECES:
                self.memo.clear()
                new = set().union(*split)
            self._encode_pieces(list(new))
            out += [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        get = self.tokens.__getitem__
        return [b"".join(map(get, np.frombuffer(x, "<u4").tolist())) for x in ids]


def _chunks(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def codec(path: str, pattern: str) -> Codec:
    return process_memo(("bpe", path, pattern), lambda: Codec(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and, if asked for,
    ``decoded`` (binary), which is made from those ids in the same pass."""
    fields = [T.StructField("ids", T.BinaryType())] + [T.StructField("decoded", T.BinaryType())] * decode

    @F.pandas_udf(T.StructType(fields))
    def bpe(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for s in texts:
            ids = c.encode([t if t is not None else "" for t in s])
            yield pd.DataFrame({"ids": ids} | ({"decoded": c.decode(ids)} if decode else {}))

    base = docs.drop("ids", *["decoded"] * decode)
    kept = [c for c in base.columns if c != "_bpe"]
    return base.withColumn("_bpe", bpe(F.col(text_col))).select(*kept, "_bpe.*")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary); null ids decode to null."""

    @F.pandas_udf(T.BinaryType())
    def back(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, "")
        for s in ids:
            yield pd.Series([None if x is None else c.decode([x])[0] for x in s], dtype=object)

    return encoded.withColumn("decoded", back(F.col(ids_col)))


# -- registered query -------------------------------------------------------
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, decode=True)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
