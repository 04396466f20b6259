"""Token-id files with a minimal perfect hash index.

A shard is two files. ``.ids`` holds the raw ids of its documents, one after
the other in ascending key order, as little-endian unsigned integers (16 bits
if the vocabulary fits, else 32). ``.idx`` maps a key to its place there:

* levels of a minimal perfect hash: at each level every remaining key hashes
  to a bit; bits hit by one key are set, the other keys go to the next level.
  A key's slot is the number of set bits before its own;
* per slot a 32-bit fingerprint of the key, its first record and its number of
  records (a repeated key has several, next to each other);
* the offset of every record.

A look-up costs a few hashes and one read of the payload, however large the
shard. Documents are range-partitioned by key and content, so a key that a
third of the rows share spreads over shards, each with its part; every shard
is written by one task in one pass and holds only its index in memory.

Defined cases: null texts are empty; a document without tokens still has its
end id; null keys come first and are looked up like any other; repeated rows
are separate records; an empty table makes no shard and an empty result;
columns other than key and text play no part. Keys are integers.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlab.llm import files
from basketlab.llm.byte_bpe import _chunks, process_memo
from basketlab.llm.common import new_folder, table, written
from basketlab.llm.near_dedup import mix

MAGIC = b"TOKIDX1\n"
CACHE_PIECES, CACHE_CHARS = 800_000, 1 << 24
GAMMA = 2
#: Letters that lower-case to one of them, marks, quotes and dashes, white space: composed already, and no normaliser or
#: splitter rule looks beyond them. Without U+0130, U+023A, U+023E, whose lower case is elsewhere.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u02af\u0400-\u0481\u048a-\u04ff"
_MARKS = "!-/:-@\\[-`{-~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027"
_OTHER = re.compile(f"[^{_LETTERS}{_MARKS}0-9 \t\n\r]")
#: the splitter's pieces of lower-case texts without such others
_PIECE = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_MARKS}]+|[0-9]")
#: Texts of Latin letters, full stops, commas and white space only; splitting these needs no pattern.
_MORE = re.compile("[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff .,\t\n\r]")
_U = np.uint64


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, as bit levels."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        sizes = [int(b.sum()) for b in bits]
        self.before = [np.cumsum(b, dtype=np.int64) - b for b in bits]
        self.base = np.cumsum([0, *sizes])[:-1].tolist()
        self.n = sum(sizes)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(np.array([level * 2 + 1], _U))) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, rest = [], keys
        while len(rest):
            size = GAMMA * len(rest)
            at = cls.place(rest, len(bits), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            rest = rest[~alone[at]]
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that reach no set bit (they are not in the set)."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, before, base) in enumerate(zip(self.bits, self.before, self.base, strict=True)):
            at = self.place(keys[todo], level, len(bits))
            hit = bits[at]
            out[todo[hit]] = base + before[at[hit]]
            todo = todo[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _U(0xA0761D6478BD642F)) >> _U(32)).astype(np.uint32)


def write_index(out, keys: np.ndarray, counts: np.ndarray, sizes: np.ndarray, width: int, nulls: int = 0) -> None:
    """Index of a shard: distinct ``keys`` in order with their ``counts`` of records; ``sizes`` in ids of all records.

    The first ``nulls`` records have no key.
    """
    first = nulls + np.cumsum(counts) - counts
    hashed = PerfectHash.build(keys)
    slot = hashed.slots(keys)
    by_slot = np.empty(len(keys), np.int64)
    by_slot[slot] = np.arange(len(keys))
    head = {"width": width, "keys": len(keys), "records": len(sizes), "nulls": nulls, "levels": [len(b) for b in hashed.bits]}
    raw = json.dumps(head).encode()
    out.write(MAGIC + struct.pack("<I", len(raw)) + raw)
    for b in hashed.bits:
        out.write(np.packbits(b, bitorder="little").tobytes())
    for x in (fingerprint(keys)[by_slot], first[by_slot].astype("<u4"), counts[by_slot].astype("<u4"), np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")):
        out.write(x.tobytes())


class Shard:
    """Keyed reads of one shard."""

    def __init__(self, folder: str, name: str):
        with files.open_in(folder, name + ".idx") as f:
            if f.read(8) != MAGIC:
                raise ValueError(f"{name}.idx is not a token index")
            head = json.loads(f.read(struct.unpack("<I", f.read(4))[0]))
            bits = [np.unpackbits(np.frombuffer(f.read((n + 7) // 8), np.uint8), count=n, bitorder="little").astype(bool) for n in head["levels"]]
            take = lambda kind, n: np.frombuffer(f.read(n * np.dtype(kind).itemsize), kind)
            n = head["keys"]
            self.hash, self.nulls = PerfectHash(bits), head["nulls"]
            self.prints, self.first, self.count = take("<u4", n), take("<u4", n), take("<u4", n)
            self.offsets = take("<u8", head["records"] + 1).astype(np.int64)
        self.kind = np.dtype(f"<u{head['width']}")
        self.payload = files.open_in(folder, name + ".ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first record, number of records) of each key; 0 records if the shard lacks it."""
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.hash.slots(keys)
        ok = (slot >= 0) & (self.prints[slot] == fingerprint(keys))
        return np.where(ok, self.first[slot], 0).astype(np.int64), np.where(ok, self.count[slot], 0).astype(np.int64)

    def ids(self, record: int) -> np.ndarray:
        a, b = int(self.offsets[record]), int(self.offsets[record + 1])
        self.payload.seek(a * self.kind.itemsize)
        return np.frombuffer(self.payload.read((b - a) * self.kind.itemsize), self.kind)


class WordCodec:
    """Encoder of the tokenizers library with a memory of the splitter's pieces.

    A text whose characters all have plain rules is lower-cased and split here,
    as the splitter does. In other texts this is done between spaces, which the
    normaliser and the splitter never look across; only runs that hold another
    character are left whole. Each piece or run has a number; new ones are
    encoded by the library, and the ids of many texts are gathered by number at
    once. The memory has a fixed size, apart from what one round adds.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)  # in the order of their numbers
        self.ids = np.empty(0, self.kind)
        self.first = np.empty(0, np.int64)  # where the ids of each number begin
        self.size = np.empty(0, np.int64)
        self.chars = 0

    @staticmethod
    def split(text: str) -> list[str]:
        """Pieces of the splitter, lower-case, and runs without spaces that hold other characters."""
        if _MORE.search(text) is None and not (".." in text or ".," in text or ",." in text or ",," in text):
            return text.lower().replace(".", " . ").replace(",", " , ").split()
        if _OTHER.search(text) is None:
            return _PIECE.findall(text.lower())
        return [x for c in text.replace("\n", " ").split(" ") for x in ((c,) if _OTHER.search(c) else _PIECE.findall(c.lower()))]

    def _learn(self, new: list[str]) -> None:
        """Adds the ids of the newly numbered. Many pieces are encoded as one text and parted by word number."""
        other = np.zeros(len(new), bool)
        if _OTHER.search(" ".join(new)) is not None:
            other[:] = [_OTHER.search(x) is not None for x in new]
        size, ids = np.empty(len(new), np.int64), [self.ids]
        pieces, runs = np.flatnonzero(~other), np.flatnonzero(other)
        for k in range(0, len(pieces), 1000):
            part = pieces[k : k + 1000]
            e = self.tokenizer.encode(" ".join([new[i] for i in part.tolist()]), add_special_tokens=False)
            n = np.bincount(e.word_ids, minlength=len(part))
            if len(n) != len(part):
                raise ValueError("a piece is several to the splitter")
            size[part] = n
            ids.append(np.array(e.ids, self.kind))
        if len(runs):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([new[i] for i in runs.tolist()], add_special_tokens=False)]
            size[runs] = [len(x) for x in found]
            ids += [np.array(x, self.kind) for x in found]
        order = np.concatenate([pieces, runs])
        first = np.empty(len(new), np.int64)
        first[order] = len(self.ids) + np.cumsum(size[order]) - size[order]
        self.ids = np.concatenate(ids)
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for part in _chunks(texts):
            if len(self.number) > CACHE_PIECES or self.chars > CACHE_CHARS:
                self._forget()
            known = len(self.number)
            split = [self.split(t) for t in part]
            ends = np.cumsum([0, *map(len, split)])
            piece = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, ends[-1])
            if len(self.number) > known:
                try:
                    self._learn(list(islice(reversed(self.number), len(self.number) - known))[::-1])
                except BaseException:
                    self._forget()  # the process lives on, and numbers without ids must not
                    raise
            size = self.size[piece]
            upto = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(self.first[piece] - upto[:-1], size) + np.arange(upto[-1])
            raw = self.ids[at].tobytes()
            cut = (upto[ends] * self.width).tolist()
            out += [raw[a:b] for a, b in pairwise(cut)]
        return out


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards; returns their catalog: (name, key, first_of_shard, shard_tokens), a row for each key of a shard."""
    rows = docs.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    parts = rows.withColumn("h", F.xxhash64("text")).withColumn("i", F.monotonically_increasing_id())
    parts = parts.repartitionByRange(F.col("key").asc_nulls_first(), "h", "i").sortWithinPartitions(F.col("key").asc_nulls_first(), "h", "i")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = process_memo(("words", tokenizer), lambda: WordCodec(tokenizer))
        end = np.array([end_id], codec.kind).tobytes()
        name, out = files.own_name("shard"), None
        keys, nulls, sizes = [], [], []
        for b in batches:
            if not len(b):
                continue
            out = out or files.open_out(folder, name + ".ids")
            for part in codec.encode([t if t is not None else "" for t in b["text"]]):
                out.write(part + end)
                sizes.append(len(part) // codec.width + 1)
            nulls.append(b["key"].isna().to_numpy())
            keys.append(b["key"].fillna(0).astype("int64").to_numpy())
        if out is None:
            return
        out.close()
        key, null, size = np.concatenate(keys), np.concatenate(nulls), np.array(sizes, np.int64)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(key)))
        known = ~null[at]
        with files.open_out(folder, name + ".idx") as f:
            write_index(f, hashable(key[at][known]), count[known], size, codec.width, int(null.sum()))
        yield pd.DataFrame({"name": name, "key": pd.arrays.IntegerArray(key[at], null[at]), "first_of_shard": np.arange(len(at)) == 0, "shard_tokens": int(size.sum())})

    made = parts.select("key", "text").mapInPandas(write, "name string, key long, first_of_shard boolean, shard_tokens long")
    return written(made, "token-catalog")


def hashable(key: np.ndarray) -> np.ndarray:
    """64-bit form of an integer key (a bijection: distinct keys stay distinct)."""
    return mix(np.ascontiguousarray(key, np.int64).view(_U))


def shard_starts(catalog: DataFrame) -> DataFrame:
    """(name, start): ids of all shards before, in key order. One row a shard."""
    shards = catalog.where("first_of_shard").select("name", "key", "shard_tokens")
    # a key that several shards share starts them all: the one that only continues it comes first or between
    last = catalog.groupBy("name").agg(F.max("key").alias("top"))
    order = Window.orderBy(F.col("key").asc_nulls_first(), F.col("top").asc_nulls_first(), "name")
    return shards.join(last, "name").select("name", (F.sum("shard_tokens").over(order) - F.col("shard_tokens")).alias("start"))


def read_records(catalog: DataFrame, folder: str) -> DataFrame:
    """Looks every key of the catalog up in its shard: (name, key, at, ids).

    ``at``: ids before it in the shard; ``ids``: its ids, little-endian unsigned 32-bit.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, shard = None, None
        for b in batches:
            for n, part in b.groupby("name", sort=False):
                if n != name:
                    name, shard = n, Shard(folder, n)
                null = part["key"].isna().to_numpy()
                key = part["key"].fillna(0).astype("int64").to_numpy()
                first, count = shard.find(hashable(key))
                first, count = np.where(null, 0, first), np.where(null, shard.nulls, count)
                if (count == 0).any():
                    raise ValueError(f"{name}: a key of the catalog is not in the index")
                ends = np.cumsum(count)
                record = np.repeat(first - (ends - count), count) + np.arange(ends[-1])
                keys, nulls = np.repeat(key, count), np.repeat(null, count)
                for k in range(0, len(record), 1000):
                    r = record[k : k + 1000]
                    ids = [shard.ids(x).astype("<u4").tobytes() for x in r.tolist()]
                    yield pd.DataFrame({"name": name, "key": pd.arrays.IntegerArray(keys[k : k + 1000], nulls[k : k + 1000]), "at": shard.offsets[r], "ids": ids})

    return catalog.select("name", "key").mapInPandas(read, "name string, key long, at long, ids binary")


# -- registered query -------------------------------------------------------
END_ID = 2


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = new_folder(spark, "tokens")
    catalog = write_shards(docs, P.path("word_bpe_49k.json"), END_ID, folder)
    found = read_records(catalog, folder).select("name", "key", "at", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return found.join(shard_starts(catalog), "name").select(F.col("key").alias("doc_id"), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
