"""Resampling towards a target distribution by hashed n-gram importance weights.

The features of a text are its words and pairs of neighbouring words, each
hashed into one of BUCKETS buckets. A bucket's gain is the scaled logarithm of
its smoothed frequency in the target over that in the source; a text's weight
is the mean gain of its features. Gumbel noise, fixed by the document's id, is
added to the weight, and the highest scores are drawn: a sample without
replacement whose odds follow the weights.

The features are made by Arrow kernels in batches: ``ascii_lower``,
``split_pattern_regex`` and ``list_flatten`` give the words in order,
``dictionary_encode`` numbers them; a word's number and its right neighbour's
(the same array shifted by one) are a pair, whose distinct values are hashed
once. The CRC of a pair follows from those of its words: that of the first
word and a space is moved over the length of the second, a linear map of 32
bits. ``take`` fetches the gains of all features and running sums reduce them
by document.

Counting needs one pass over the texts and sends at most BUCKETS rows a task;
the gains are BUCKETS numbers, a bound that no data change. Scoring is a second
pass. Scores are ranked in ranges of one global order, never in one task.

Defined cases: null and empty texts have no features and weight 0; null ids
hash as ``7:`` alone and rank after all others of one score; repeated rows are
rows of their own and rank next to each other; texts are read whole; without
any target or any source text every gain still is a number; an empty table gives
an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm.common import table, written
from basketlab.operators.baskets import numbered

BUCKETS, LEAST_WORDS, DRAWN_PCT, SEED = 10_000, 20, 25, 7
CHUNK = 1 << 22  # bytes of text whose features are made at once
#: all but a-z, 0-9 and what lies beyond ASCII
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about CHUNK bytes; a longer text is a run of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + CHUNK, side="right")))
        yield texts.take(pa.array(np.arange(a, b)))  # a copy: kernels misread some slices
        a = b


@lru_cache(maxsize=4096)
def _mover(length: int) -> np.ndarray:
    """Four tables of 256: what a CRC-32 register becomes, byte by byte of it, when ``length`` zero bytes follow."""
    one = np.array([zlib.crc32(b"\0", 1 << k) ^ zlib.crc32(b"\0", 0) for k in range(32)], np.uint64)
    step, total, n = one, np.array([1 << k for k in range(32)], np.uint64), length
    while n:
        if n & 1:
            total = _apply(step, total)
        step = _apply(step, step)
        n >>= 1
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    table_ = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for b in range(8):
            table_[k] ^= np.where(bits[:, b] == 1, total[8 * k + b], 0).astype(np.uint32)
    return table_


def _apply(matrix: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each bit."""
    out = np.zeros_like(x)
    for b in range(32):
        out ^= np.where((x >> np.uint64(b)) & np.uint64(1), matrix[b], np.uint64(0))
    return out


def pair_crcs(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC of (a + b) from the CRCs of a and b and the length of b in bytes."""
    out = second.copy()
    order = np.argsort(size, kind="stable")
    ends = np.flatnonzero(np.diff(size[order])) + 1
    for at in np.split(order, ends):
        if len(at):
            t, x = _mover(int(size[at[0]])), first[at]
            out[at] ^= t[0][x & 255] ^ t[1][(x >> 8) & 255] ^ t[2][(x >> 16) & 255] ^ t[3][x >> 24]
    return out


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, bucket of each word, bucket of each pair, text of each pair); all in text order."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")), APART)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(flat, "")
    flat, owner = flat.filter(some), owner.filter(some).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(owner, minlength=len(texts))
    coded = flat.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    raw = coded.dictionary.cast(pa.large_binary()).to_pylist()
    crc = np.array([zlib.crc32(w) for w in raw], np.uint32)
    spaced = np.array([zlib.crc32(b" ", c) for c in crc.tolist()], np.uint32)
    size = np.array([len(w) for w in raw], np.int64)
    near = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = pa.array(word[near] * max(len(raw), 1) + word[near + 1]).dictionary_encode()  # the word numbers against themselves, shifted by one
    distinct = pairs.dictionary.to_numpy(zero_copy_only=False)
    a, b = distinct // max(len(raw), 1), distinct % max(len(raw), 1)
    pair = pair_crcs(spaced[a], crc[b], size[b]) % np.uint32(buckets)
    pair = pc.take(pa.array(pair), pairs.indices).to_numpy(zero_copy_only=False)
    return n_words, (crc % np.uint32(buckets)).astype(np.int64)[word], pair.astype(np.int64), owner[near]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in _chunks(b.column(0)):
                _, words, pairs, _ = features(part, buckets)
                total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    return docs.select(text_col).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, source_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of all buckets: floor(1000 * log of target over source frequency), each count plus one."""
    found = bucket_counts(source, source_col, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    found = found.unionByName(bucket_counts(target, target_col, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    c = written(found.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "buckets")
    total = c.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = ((F.col("t") + 1).cast("double") * F.lit(float(total.S + buckets))) / ((F.col("s") + 1).cast("double") * F.lit(float(total.T + buckets)))
    return c.select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))


def weights(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of a text's gains."""
    gain_of = np.array(gain, np.int64)
    kind = docs.schema[id_col].dataType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = pa.array(gain_of)
        for b in batches:
            done = []
            for part in _chunks(b.column(1)):
                n_words, words, pairs, owner = features(part, len(gain_of))
                n_pairs = np.bincount(owner, minlength=len(part))
                total = np.zeros(len(part), np.int64)
                for at, n in ((words, n_words), (pairs, n_pairs)):
                    run = np.concatenate([[0], np.cumsum(pc.take(table_, pa.array(at)).to_numpy(zero_copy_only=False))])
                    ends = np.cumsum(n)
                    total += run[ends] - run[ends - n]
                n = n_words + n_pairs
                done.append((n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*done, strict=True)] if done else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(score, f"doc_id {kind.simpleString()}, n_words long, n_features long, weight long")


def noise(id_: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) of an id: the first 32 bits of its hash as a uniform number."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / F.lit(4294967296.0))) * -1000).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", pct: int = DRAWN_PCT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every row's (doc_id, n_features, weight, score, rank): rank 1, 2, ... of the ``pct`` percent of
    the rows with ``least_words`` words that have the highest scores; null for the others."""
    gain = [r.gain for r in gains(docs, target, text_col, target_col).orderBy("bucket").collect()]  # BUCKETS numbers
    scored = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = fit.count() * pct // 100
    order = fit.select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("no_id"), "row")
    ranked = numbered(order, "down", "no_id", "doc_id", "row").withColumn("rank", F.when(F.col("number") <= drawn, F.col("number")).cast("long"))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*out).unionByName(rest.select(*out))


# -- registered query -------------------------------------------------------
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"))
