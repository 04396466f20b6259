"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words. A node is a pair of
neighbouring words, an edge a triple: it leads from its first pair to its
second, and its weight is how often the triple occurs. Where a piece ends, the
missing words are an end mark, so every word of a text starts exactly one edge.
Only edges are counted over the corpus; the shorter counts follow from them:

* a pair occurs as often as flow leaves its node, the edges to the end mark
  (the piece-end correction) included;
* a word occurs as often as flow leaves the nodes that it starts;
* a node with a single edge is unary: the pair occurs as often as the triple,
  so the two are one path and one row until the counts are read.

Tasks build the graph of each CHUNK of text with numpy and send it on in
compressed blocks, one for each bucket of nodes. A bucket holds all edges of
its nodes, so flows are complete there, and what occurs fewer than ``least``
times ends there. Buckets grow in number with the text, not in size. Nodes that
hold over one in HOT of the pairs of a sample are dealt by their third word as
well, and their flows added up at the end; the sample decides about balance
only, never about a count.

Defined cases: null and empty texts have no words; a null language is ``und``;
repeated rows count each; phrases of equal score and count rank by their UTF-8
bytes; texts are read whole, whatever their length; an empty table gives an
empty result; other columns play no part. Scores are exact: quotients of
38-digit whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlab.llm.common import table, written
from basketlab.llm.near_dedup import _powers, mix

LEAST, KEPT_SHARE, TOP = 10, 50, 2000
CHUNK = 1 << 22  # bytes of text whose graph is built at once
BUCKET = 1 << 23  # bytes of text for each bucket of nodes
HOT, SAMPLE = 1000, 2000  # share of a hot node (one in HOT), texts of the sample that finds them
_U = np.uint64
#: 0: part of a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(raw: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(words in order, whether each ends its piece)."""
    buf = _LOWER[np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)]
    kind = _KIND[buf]
    part = kind == 0
    start = np.flatnonzero(part[1:] & ~part[:-1]) + 1
    end = np.flatnonzero(part[:-1] & ~part[1:]) + 1
    breaks = np.cumsum(kind == 2, dtype=np.int32 if len(kind) < 1 << 31 else np.int64)
    at = breaks[start]
    last = np.ones(len(start), bool)
    last[:-1] = at[1:] != at[:-1]
    return _strings(buf[part], end - start), last


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_binary array."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def hashes_of(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each string, the same in every task."""
    data, offsets = _bytes_of(strings)
    up, down = _powers(int(offsets[-1]) + 1 if len(offsets) else 1)
    total = np.zeros(len(up), _U)
    np.cumsum((data[: len(up) - 1].astype(_U) + _U(1)) * up[:-1], dtype=_U, out=total[1:])
    a, b = offsets[:-1], offsets[1:]
    return mix((total[b] - total[a]) * down[a] + (b - a).astype(_U))


class Graph:
    """Distinct edges (first, second, third: places in ``names``; 0 is the end mark) with weights, by node."""

    def __init__(self, names: pa.Array, first: np.ndarray, second: np.ndarray, third: np.ndarray, weight: np.ndarray):
        v = _U(len(names))
        node, self.of = np.unique(first.astype(_U) * v + second.astype(_U), return_inverse=True)
        edge, which = np.unique(self.of.astype(_U) * v + third.astype(_U), return_inverse=True)
        self.names = names
        self.weight = np.bincount(which, weights=weight, minlength=len(edge)).astype(np.int64)
        self.of, self.third = (edge // v).astype(np.int64), (edge % v).astype(np.int64)
        self.first, self.second = (node // v).astype(np.int64), (node % v).astype(np.int64)

    @classmethod
    def of_words(cls, words: pa.Array, last: np.ndarray) -> Graph:
        coded = words.dictionary_encode()
        names = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary])
        one = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        two = np.where(last, 0, np.append(one[1:], 0))
        three = np.where(two == 0, 0, np.append(two[1:], 0))
        return cls(names, one, two, three, np.ones(len(one)))

    def flow(self) -> np.ndarray:
        """How often each node's pair occurs."""
        return np.bincount(self.of, weights=self.weight, minlength=len(self.first)).astype(np.int64)

    def word_flow(self) -> np.ndarray:
        """How often each word starts an edge, that is, occurs."""
        return np.bincount(self.first, weights=self.flow(), minlength=len(self.names)).astype(np.int64)


def _joined(columns: list[pa.Array], rows: np.ndarray) -> bytes:
    """Lines of the columns' words with a space between."""
    import pyarrow.compute as pc

    parts = [c.take(pa.array(rows)) for c in columns]
    sizes = sum(np.diff(_bytes_of(p)[1]) for p in parts) + len(parts)
    line = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
    data, offsets = _bytes_of(line)
    out = np.full(int(sizes.sum()), 10, np.uint8)
    ends = np.cumsum(sizes) - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = data[offsets[0] : offsets[-1]]
    return out.tobytes()


def _cells(g: Graph, buckets: int, hot: np.ndarray) -> Iterator[tuple[int, bytes, bytes, int]]:
    """(bucket, lines, weights, words a line) of a chunk's graph: edges, and the flow of single words."""
    h = hashes_of(g.names)
    node = mix(h[g.first] * _U(0x9E3779B97F4A7C15) + h[g.second])
    spread = np.isin(node, hot)[g.of]
    edge = np.where(spread, mix(node[g.of] + h[g.third]), node[g.of])
    name = lambda at: g.names.take(pa.array(at))
    columns = [name(g.first[g.of]), name(g.second[g.of]), name(g.third)]
    yield from _dealt((edge % _U(buckets)).astype(np.int64), columns, g.weight)
    flow = g.word_flow()
    some = np.flatnonzero(flow)
    yield from _dealt((h[some] % _U(buckets)).astype(np.int64), [name(some)], flow[some])


def _dealt(bucket: np.ndarray, columns: list[pa.Array], weight: np.ndarray) -> Iterator[tuple[int, bytes, bytes, int]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(bucket[order])) + 1, len(order)) if len(order) else []
    a = 0
    for b in ends:
        rows = order[a:b]
        yield int(bucket[rows[0]]), _joined(columns, rows), weight[rows].astype("<u4").tobytes(), len(columns)
        a = b


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _full(raw: bytes) -> bytes:
    return pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True)


BLOCKS = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("width", pa.int32()), ("lines", pa.binary()), ("weights", pa.binary())])


def _chunk_blocks(lang: str, texts: list[bytes], buckets: int, hot: np.ndarray) -> pa.RecordBatch:
    words, last = words_of(texts)
    rows = list(_cells(Graph.of_words(words, last), buckets, hot)) if len(words) else []
    cols = [[r[0] for r in rows], [lang] * len(rows), [r[3] for r in rows], [_squeezed(r[1]) for r in rows], [_squeezed(r[2]) for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, BLOCKS, strict=True)], schema=BLOCKS)


def blocks(docs: DataFrame, buckets: int, hot: list[int], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The graphs of all chunks, cut by bucket."""
    spread = np.array(hot, np.int64).view(_U)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= CHUNK:
                    yield _chunk_blocks(lang, held.pop(lang), buckets, spread)
                    del size[lang]
                elif sum(size.values()) >= 2 * CHUNK:  # many languages: all that is held
                    for k in list(held):
                        yield _chunk_blocks(k, held.pop(k), buckets, spread)
                    size.clear()
        for k in held:
            yield _chunk_blocks(k, held[k], buckets, spread)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("text"))
    return rows.mapInArrow(build, "bucket int, lang string, width int, lines binary, weights binary")


COUNTS = "lang string, w1 string, w2 string, w3 string, n long, unary boolean"


class _Held:
    """The blocks of one language in a task, added up whenever they have doubled."""

    def __init__(self):
        self.lines: list[bytes] = []
        self.weights: list[bytes] = []
        self.size, self.before = 0, 1 << 25

    def add(self, lines: bytes, weights: bytes, width: int) -> None:
        self.lines.append(lines)
        self.weights.append(weights)
        self.size += len(lines)
        if self.size > 2 * self.before:
            g = self.graph(width)
            name = lambda at: g.names.take(pa.array(at))
            columns = [name(g.first[g.of]), name(g.second[g.of]), name(g.third)][:width]
            self.lines, self.weights = [_joined(columns, np.arange(len(g.of)))], [g.weight.astype("<u8").tobytes()]
            self.wide = True
            self.size = self.before = len(self.lines[0])

    wide = False

    def graph(self, width: int) -> Graph:
        buf = np.frombuffer(b"".join(self.lines), np.uint8)
        cut = np.flatnonzero((buf == 32) | (buf == 10))
        sizes = np.diff(np.concatenate([[-1], cut])) - 1
        coded = _strings(buf[(buf != 32) & (buf != 10)], sizes).dictionary_encode()
        names, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = pa.concat_arrays([pa.array([b""], pa.large_binary()), names])  # the end mark has place 0
        empty = np.flatnonzero(np.diff(_bytes_of(coded.dictionary)[1]) == 0)
        ids = np.where(np.isin(ids, empty), 0, ids + 1).reshape(-1, width)
        kinds = ["<u8" if self.wide and i == 0 else "<u4" for i in range(len(self.weights))]
        weight = np.concatenate([np.frombuffer(w, k).astype(np.int64) for w, k in zip(self.weights, kinds, strict=True)])
        none = np.zeros(len(ids), np.int64)
        return Graph(names, *[ids[:, k] if k < width else none for k in range(3)], weight)


def flows(found: DataFrame, buckets: int, hot: list[int], least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, n, unary) of words, pairs and triples that occur ``least`` times or more.

    A unary pair has no row of its own. A row without words holds how many words a task has seen
    of a language. Pairs of hot nodes are parts: rows of one pair add up.
    """
    spread = np.array(hot, np.int64).view(_U)

    def batch(lang: str, g: Graph, firsts, seconds, thirds, n, unary) -> pa.RecordBatch:
        words = [g.names.take(pa.array(np.asarray(x, np.int64))).cast(pa.binary()).cast(pa.string()) for x in (firsts, seconds, thirds)]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), *words, pa.array(n, pa.int64()), pa.array(unary, pa.bool_())], names=["lang", "w1", "w2", "w3", "n", "unary"]
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], _Held] = {}
        now = None
        for b in batches:
            for bucket, lang, width, lines, weights in zip(*[b.column(k).to_pylist() for k in range(5)], strict=True):
                if bucket != now:  # a task holds one bucket at a time
                    yield from whole(held)
                    held, now = {}, bucket
                held.setdefault((lang, width), _Held()).add(_full(lines), _full(weights), width)
        yield from whole(held)

    def whole(held: dict[tuple[str, int], _Held]) -> Iterator[pa.RecordBatch]:
        for (lang, width), h in held.items():
            g = h.graph(width)
            if width == 1:
                n = g.word_flow()
                at = np.flatnonzero(n >= least)
                yield batch(lang, g, at, 0 * at, 0 * at, n[at], np.zeros(len(at), bool))
                yield batch(lang, g, [0], [0], [0], [int(n.sum())], [False])
                continue
            flow = g.flow()
            degree = np.bincount(g.of, minlength=len(flow))
            h_names = hashes_of(g.names)
            part = np.isin(mix(h_names[g.first] * _U(0x9E3779B97F4A7C15) + h_names[g.second]), spread)
            single = (degree == 1) & ~part
            e = np.flatnonzero((g.weight >= least) & (g.third > 0))
            yield batch(lang, g, g.first[g.of[e]], g.second[g.of[e]], g.third[e], g.weight[e], single[g.of[e]])
            in_path = np.zeros(len(flow), bool)
            in_path[g.of[e]] = single[g.of[e]]
            p = np.flatnonzero(((flow >= least) | part) & (g.second > 0) & ~in_path)
            yield batch(lang, g, g.first[p], g.second[p], 0 * p, flow[p], np.zeros(len(p), bool))

    dealt = found.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "lang", "width", "lines", "weights").mapInArrow(read, COUNTS)


def hot_nodes(docs: DataFrame, text_col: str = "text") -> list[int]:
    """Hashes of pairs that hold over one in HOT of the pairs of a sample: at most HOT. For balance only."""
    step = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(step)) == 0).select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, last = words_of(b.column(0).to_pylist())
            if len(words):
                g = Graph.of_words(words, last)
                h = hashes_of(g.names)
                keep = g.second > 0
                node = mix(h[g.first] * _U(0x9E3779B97F4A7C15) + h[g.second])[keep]
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(g.flow()[keep])], names=["node", "n"])

    counted = written(some.mapInArrow(pairs, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")), "pairs")
    total = counted.agg(F.sum("n")).first()[0] or 0
    return [r.node for r in counted.where(F.col("n") > F.lit(max(total // HOT, 1))).collect()]


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, n) of all words, pairs and triples that occur ``least`` times or more in
    their language (missing words are empty), and a row without words: how many words there are."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets, hot = max(16, size // BUCKET), hot_nodes(docs, text_col)
    found = written(flows(blocks(docs, buckets, hot, text_col, lang_col), buckets, hot, least), "flows")
    pair = found.where("unary").select("lang", "w1", "w2", F.lit("").alias("w3"), "n")
    found = found.drop("unary").unionByName(pair).groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    return written(found.where((F.col("n") >= least) | (F.col("w1") == "")), "counts")


def _score(a: Column, left: Column, right: Column) -> Column:
    big = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", big(a) * big(a) * F.lit(1_000_000), big(left) * big(right)).cast("long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, kept_share: int = KEPT_SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of each language."""
    c = counts(docs, text_col, lang_col, least)
    word = c.where("w1 != '' and w2 = ''").select("lang", "w1", "n")
    pair = c.where("w2 != '' and w3 = ''").select("lang", "w1", "w2", "n")
    triple = c.where("w3 != ''").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    one = lambda to, count: word.select("lang", F.col("w1").alias(to), F.col("n").alias(count))
    two = lambda x, y, count: pair.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("n").alias(count))

    three = triple.join(one("w1", "l1"), ["lang", "w1"]).join(one("w3", "r2"), ["lang", "w3"]).join(two("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(two("w1", "w2", "l2"), ["lang", "w1", "w2"])
    three = three.withColumns({"s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    early = F.col("s1") <= F.col("s2")
    pick = lambda x, y: F.when(early, F.col(x)).otherwise(F.col(y))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))

    # a pair lies in the triples that leave its node and in those that enter it
    around = triple.select("lang", "w1", "w2", "a").unionByName(triple.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    kept = pair.join(around, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * kept_share))
    both = kept.withColumnRenamed("n", "a").join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"])
    both = both.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    every = both.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    best = every.withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("k") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    sizes = c.where("w1 = ''").select("lang", F.col("n").alias("words"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


# -- registered query -------------------------------------------------------
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))
