"""Packing of token ids into windows by the sum-of-squares rule.

Every document's ids, with its end id, are cut into whole windows of SIZE and a
rest. Rests are packed online: a level array holds how many open windows are
filled to each level, and a rest goes to the level (or a new window) that
leaves the sum of squares of that array least, so no level gathers windows
that nothing fits on top of. Ties go to the fullest window. A window that is
full is closed at once.

Tasks pack the documents of their input partition in order, so documents are
never shuffled or gathered. When open windows hold over OPEN tokens, and at the
end of the partition, those that are left are closed: the fullest ones are
filled up with pieces cut off the emptiest ones, in order. The single window
that remains at the end is cut at powers of two, which need no padding. So all
other windows are full and nothing is padded; documents shorter than a window
stay whole but for those pieces. Window numbers are those of the partition
followed by a running number; a repeated task makes the same windows again.

Ids come from the tokenizers library. Plain texts (Latin letters, digits, ASCII
punctuation, single spaces and line breaks) are split into its splitter's
pieces, others where a space or line break stands alone, which no piece spans;
pieces and chunks are encoded once and remembered, in memories of fixed size.
Tests compare with whole-text encoding.

Defined cases: null and empty texts are their end id alone; special tokens'
strings are ordinary text; a document of any length is cut into windows;
repeated rows and null ids are packed like any other; an empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from basketlab.llm.byte_bpe import process_memo
from basketlab.llm.common import table

SIZE = 2048
OPEN = 1 << 22  # tokens that open windows may hold
CACHE_PIECES, CACHE_CHUNKS = 1_200_000, 100_000
#: anything but letters up to U+024F, digits, ASCII punctuation, spaces and line breaks
_OTHER = re.compile("[^A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f!-~ \n]")
#: the splitter's pieces of texts that hold nothing else, where spaces and line breaks stand alone
_PIECE = re.compile("'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+| ?[0-9]+| ?[!-/:-@\\[-`{-~]+|\n")
#: a space or line break that stands alone; the splitter never joins what lies before and after it
_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _plain(text: str) -> bool:
    if _OTHER.search(text) is not None or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    return text[0] not in " \n" and text[-1] not in " \n"


class ChunkCodec:
    """Ids of whole texts, through a memory of the splitter's pieces.

    Of plain texts the pieces are words, numbers, runs of punctuation and line
    breaks; other texts are cut where a space or line break stands alone. Only
    new pieces and chunks are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _learn(self, wanted: set[str], held: dict[str, bytes], most: int) -> None:
        new = wanted.difference(held)
        if len(held) + len(new) > most:
            held.clear()
            new = wanted
        spaced = [x for x in new if x[0] == " " and x[1:].isalpha()] if held is self.pieces else []
        other = list(new.difference(spaced))
        for x, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            held[x] = np.array(e.ids, "<u4").tobytes()
        for k in range(0, len(spaced), 1000):  # many words, each with its space, as one text, parted by word number
            part = spaced[k : k + 1000]
            e = self.tokenizer.encode("".join(part), add_special_tokens=False)
            flat = np.array(e.ids, "<u4").tobytes()
            ends = (np.bincount(e.word_ids, minlength=len(part)).cumsum() * 4).tolist()
            if len(ends) != len(part):
                raise ValueError("a word is several pieces")
            for x, a, b in zip(part, [0, *ends], ends, strict=False):
                held[x] = flat[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        cut, pieces, chunks = [], set(), set()
        for t in texts:
            plain = not t or _plain(t)
            x = _PIECE.findall(t) if plain else _SAFE.split(t)
            (pieces if plain else chunks).update(x)
            cut.append((plain, x))
        self._learn(pieces, self.pieces, CACHE_PIECES)
        self._learn(chunks, self.chunks, CACHE_CHUNKS)
        piece, chunk = self.pieces.__getitem__, self.chunks.__getitem__
        return [b"".join(map(piece if plain else chunk, x)) for plain, x in cut]


class Packer:
    """Sum-of-squares packing of one partition; finished pieces gather in ``out``.

    A piece is (document, start, ids); an open window is the list of its pieces.
    """

    def __init__(self, size: int = SIZE, most: int = OPEN):
        self.size, self.most = size, most
        self.count = np.zeros(size + 1, np.int64)  # open windows by level; none at 0 and at size
        self.windows: list[list[list[tuple[int, int, bytes]]]] = [[] for _ in range(size + 1)]
        self.held, self.number = 0, 0
        self.out: list[tuple[int, int, int, int, int, int]] = []  # document, start, length, crc, window, offset

    def add(self, doc: int, ids: bytes) -> None:
        n, whole = len(ids) // 4, len(ids) // 4 // self.size * self.size
        for a in range(0, whole, self.size):
            self._close([(doc, a, ids[4 * a : 4 * (a + self.size)])])
        if n > whole:
            self._place(doc, whole, ids[4 * whole :])
            if self.held > self.most:
                self._fill_up()

    def level(self, s: int) -> int:
        """The level whose windows take a piece of ``s`` ids: the change of the sum of squares is least; 0 is a new window."""
        top = self.size - s
        # twice the change, halved: moving a window from h to h + s; one that gets full leaves the array
        change = 2.0 * (self.count[s + 1 :] - self.count[1 : top + 1]) + 2.0
        if top:
            change[-1] -= 1.0
            change[self.count[1 : top + 1] == 0] = np.inf
            h = top - int(change[::-1].argmin())
            if change[h - 1] <= 2.0 * self.count[s] + 1.0:
                return h
        return 0

    def _place(self, doc: int, start: int, ids: bytes) -> None:
        s = len(ids) // 4
        h = self.level(s)
        window = self.windows[h].pop() if h else []
        self.count[h] -= 1 if h else 0
        window.append((doc, start, ids))
        if h + s == self.size:
            self._close(window)
            self.held -= h
        else:
            self.windows[h + s].append(window)
            self.count[h + s] += 1
            self.held += s

    def _close(self, window: list[tuple[int, int, bytes]]) -> None:
        offset = 0
        for doc, start, ids in window:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), self.number, offset))
            offset += n
        self.number += 1

    def _fill_up(self) -> None:
        """Closes open windows, fullest first, with pieces cut off the emptiest; one stays open."""
        every = [(level, w) for level in range(1, self.size) for w in self.windows[level]]
        self.windows = [[] for _ in range(self.size + 1)]
        self.count[:] = 0
        self.held = 0
        low, high = 0, len(every) - 1
        spare = list(every[0][1]) if every else []
        left = every[0][0] if every else 0
        while high > low:
            level, window = every[high]
            window = list(window)
            gap = self.size - level
            while gap and high > low:
                if not left:
                    low += 1
                    if low == high:
                        break
                    left, spare = every[low][0], list(every[low][1])
                doc, start, ids = spare.pop()
                n = len(ids) // 4
                if n > gap:  # its end goes, its start stays
                    keep = n - gap
                    spare.append((doc, start, ids[: 4 * keep]))
                    doc, start, ids, n = doc, start + keep, ids[4 * keep :], gap
                window.append((doc, start, ids))
                gap -= n
                left -= n
            if gap:
                left, spare = self.size - gap, window
                low = high
                break
            self._close(window)
            high -= 1
        if left:
            self.windows[left].append(spare)
            self.count[left] = 1
            self.held = left

    def finish(self) -> None:
        """Closes what is open: the last window at powers of two."""
        self._fill_up()
        for level in range(1, self.size):
            for window in self.windows[level]:
                self._cut(window, level)
            self.windows[level] = []
        self.count[:] = 0
        self.held = 0

    def _cut(self, window: list[tuple[int, int, bytes]], level: int) -> None:
        todo = window[::-1]
        while level:
            size = 1 << (level.bit_length() - 1)
            level -= size
            part: list[tuple[int, int, bytes]] = []
            while size:
                doc, start, ids = todo.pop()
                n = len(ids) // 4
                if n > size:
                    todo.append((doc, start + size, ids[4 * size :]))
                    ids, n = ids[: 4 * size], size
                part.append((doc, start, ids))
                size -= n
            self._close(part)


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where each piece of each document lies."""
    if size & (size - 1):
        raise ValueError("the window size must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = process_memo(("chunks", tokenizer), lambda: ChunkCodec(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 40
        packer, ids, tokens, known = Packer(size), {}, {}, 0

        def done() -> pa.RecordBatch:
            doc, *columns = zip(*packer.out, strict=True)
            packer.out = []
            start, length, crc, window, offset = (np.array(c, np.int64) for c in columns)
            out = [pa.array([ids[d] for d in doc], id_type), *map(pa.array, (start, length, crc, np.array([tokens[d] for d in doc], np.int64), first + window, offset))]
            held = {p[0] for level in packer.windows for w in level for p in w}
            for old in set(ids) - held:
                del ids[old], tokens[old]
            return pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        id_type = None
        for b in batches:
            id_type = b.column(0).type
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            a = 0
            while a < len(texts):
                z, room = a, 1 << 22
                while z < len(texts) and (z == a or room > 0):
                    room -= len(texts[z] or "")
                    z += 1
                for k, part in enumerate(codec.encode([t or "" for t in texts[a:z]])):
                    ids[known], tokens[known] = keys[a + k], len(part) // 4 + 1
                    packer.add(known, part + end)
                    known += 1
                a = z
                if packer.out:
                    yield done()
        packer.finish()
        if packer.out:
            yield done()

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, {PIECES}")


# -- registered query -------------------------------------------------------
END_ID = 1


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), P.path("byte_bpe_50k.json"), END_ID)
