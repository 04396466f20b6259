"""Near-duplicate classes by DartMinHash signatures and banded joining.

A text is a weighted set: its five-word shingles (lower-cased words), weighted
by how often they occur; a text of one to four words is one shingle. Darts are
hashed: every unit of weight of every element owns cells along the rank axis,
and a cell's hash fixes how many darts it holds (Poisson), their ranks and
their coordinates. A text keeps the darts inside its own weights; of each
coordinate the dart of least rank is the signature's entry. Two texts agree in
a coordinate with probability equal to their weighted Jaccard similarity, and
about ``k ln k`` darts are thrown whatever the text's length. Coordinates still
empty get darts of higher rank until all are filled.

Signatures are cut into bands; texts that agree in a band share a bucket, and
equal texts are one node from the start. A bucket never yields all its pairs as
rows. First every text meets one leader: of its buckets' most central members
(those that share most bucket places) the one it shares most buckets with. The
classes that makes settle nearly all buckets. The classes of buckets that still
hold several are gathered by overlapping buckets, each class as one node, and
their texts compared in blocks of BLOCK texts: a task holds two blocks,
compares signatures as byte arrays, and checks the pairs of different classes
that agree in at least AGREE places. The largest class meets the others but
never itself, so a few outliers beside a large class cost one pass over it.
Every comparison that makes a link is exact on the weighted sets. Classes are
the connected components of the links of at least the threshold.

With 25 bands of 4, a pair of similarity 0.8 shares a bucket with probability
0.999998 and agrees in 60 of 100 places with probability 0.999999.

Defined cases: null and empty texts have no shingles and are similar to
nothing, but equal texts (also empty ones, not null ones) are one class; ties
and repeated rows fall into one class, whose id is the least id in it (null
ids only count if there is no other); an empty table gives an empty result;
other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.llm.common import table, whole_row, written
from basketlab.llm.graph import components

BANDS, ROWS = 25, 4
SHINGLE, THRESHOLD = 5, 0.8
BLOCK, AGREE = 512, 0.6
CHUNK = 1 << 19  # characters hashed at once
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: rank axis: a first cell, then cells twice as far out each
_EDGES = [0.0] + [2.0**e for e in range(-3, 40)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    up, down = np.full(n, _BASE, _U), np.full(n, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, place of the first byte) of every word, in order, and the bytes those places are in."""
    buf = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    ends_of = np.cumsum([len(r) + 1 for r in raw])
    blank = ((buf >= 9) & (buf <= 13)) | (buf == 32)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum((buf.astype(_U) + _U(1)) * up[:-1], dtype=_U, out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))
    return np.searchsorted(ends_of, start, side="right"), hashes, start, buf


def elements(texts: list[str | None], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of the distinct shingles, by text and hash."""
    doc, word, _, _ = word_hashes([(t or "").lower().encode() for t in texts])
    m = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(m) - m
    made = np.zeros(len(word), _U)
    place = np.arange(len(word)) - first[doc]
    whole = np.minimum(m[doc], width)  # words in each shingle of the text
    for k in range(width):
        factor = _U(mix(np.array([k + 1], _U))[0] | _U(1))
        at = np.minimum(np.arange(len(word)) + k, max(len(word) - 1, 0))
        made += np.where(k < whole, word[at] * factor, _U(0)) if len(word) else made
    ok = place <= m[doc] - whole
    doc, made = doc[ok], mix(made[ok])
    order = np.lexsort((made, doc))
    doc, made = doc[order], made[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (made[1:] != made[:-1])
    at = np.flatnonzero(new)
    return doc[at], made[at], np.diff(np.append(at, len(doc))).astype(np.float64)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(n_docs, k) dart hashes, and which texts have any weight. Weights are positive reals."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    some = total > 0
    reach = np.where(some, (k * math.log(k) + 2 * k) / np.where(some, total, 1), 0.0)
    out, empty = np.zeros((n_docs, k), _U), np.repeat(some[:, None], k, axis=1)
    # a cell for each begun unit of weight
    units = np.ceil(weight).astype(np.int64)
    cell = np.repeat(np.arange(len(doc)), units)
    level = (np.arange(len(cell)) - np.repeat(np.cumsum(units) - units, units)).astype(np.float64)
    low = np.zeros(n_docs)
    while empty.any():
        todo = empty.any(axis=1)
        high = np.where(todo, np.where(low > 0, low * 2, reach), low)
        darts = _throw(doc, element, weight, cell, level, low, high, todo)
        d, rank, dart = darts
        slot = d * k + (mix(dart ^ _U(0x5851F42D4C957F2D)) % _U(k)).astype(np.int64)
        free = empty.ravel()[slot]
        slot, rank, dart = slot[free], rank[free], dart[free]
        least = np.full(n_docs * k, np.inf)
        np.minimum.at(least, slot, rank)
        won = rank == least[slot]
        out.ravel()[slot[won]] = dart[won]
        empty.ravel()[slot] = False
        low = high
    return out, some


def _throw(doc, element, weight, cell, level, low, high, todo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts (text, rank, hash) with ranks in [low, high) of their text."""
    found = []
    keep = todo[doc[cell]]
    cell, level = cell[keep], level[keep]
    owner = doc[cell]
    top, bottom = high[owner], low[owner]
    furthest = top.max(initial=0.0)
    for band, (a, b) in enumerate(zip(_EDGES, _EDGES[1:], strict=False)):
        if a >= furthest:
            break
        on = (top > a) & (bottom < b)
        c, lv, o = cell[on], level[on], owner[on]
        seed = mix(element[c] ^ mix(lv.astype(_U) * _U(0xD1342543DE82EF95) + _U(band + 1)))
        counts = np.searchsorted(_poisson(b - a), unit(seed), side="right")
        hit = np.flatnonzero(counts)
        n = counts[hit]
        q = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(hit, n)
        dart = mix(seed[at] + (q.astype(_U) + _U(1)) * _U(_BASE))
        rank = a + (b - a) * unit(mix(dart ^ _U(0x2545F4914F6CDD1D)))
        height = lv[at] + unit(mix(dart ^ _U(0xDA942042E4DD58B5)))
        o, c = o[at], c[at]
        ok = (rank < high[o]) & (rank >= low[o]) & (height < weight[c])
        found.append((o[ok], rank[ok], dart[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, _U)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _poisson(rate: float) -> np.ndarray:
    """Cumulative Poisson probabilities up to where they reach 1 in floating point."""
    most = int(rate + 12 * math.sqrt(rate) + 24)
    logs = np.arange(most) * math.log(rate) - rate - np.array([math.lgamma(i + 1) for i in range(most)])
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held >= CHUNK:
            yield part
            part, held = [], 0
    if part:
        yield part


def signed(texts: list[str | None], bands: int = BANDS, rows: int = ROWS) -> tuple[list[np.ndarray], list[bytes]]:
    """Bucket keys of each text (one for each band, none for a text without words), and a byte of each signature entry."""
    keys: list[np.ndarray] = []
    marks: list[bytes] = []
    for part in _chunks(texts):
        sig, some = signatures(*elements(part), len(part), bands * rows)
        key = np.zeros((len(part), bands), _U)
        for r in range(rows):
            key = mix(key + sig[:, r::rows])
        key = mix(key + np.arange(1, bands + 1, dtype=_U)).view(np.int64)
        keys += [key[i] if some[i] else key[i, :0] for i in range(len(part))]
        marks += [row.tobytes() for row in (sig >> _U(56)).astype(np.uint8)]
    return keys, marks


def packed_elements(texts: list[str | None]) -> list[bytes]:
    """Each text's weighted set as sorted unsigned 64-bit integers, one for each unit of weight."""
    out: list[bytes] = []
    for part in _chunks(texts):
        doc, made, weight = elements(part)
        units = weight.astype(np.int64)
        level = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
        doc, made = np.repeat(doc, units), mix(np.repeat(made, units) + level.astype(_U) * _U(_BASE))
        order = np.lexsort((made, doc))
        ends = np.searchsorted(doc, np.arange(len(part)), side="right")
        made = made[order]
        out += [made[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return out


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard of two packed sets; 0 if either is empty."""
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if not len(x) or not len(y):
        return 0.0
    both = np.sort(np.concatenate([x, y]), kind="stable")
    n = int((both[1:] == both[:-1]).sum())
    return n / (len(x) + len(y) - n)


@F.pandas_udf(T.StructType([T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("marks", T.BinaryType())]))
def _signed_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in texts:
        keys, marks = signed(s.tolist())
        yield pd.DataFrame({"bands": pd.Series(keys, dtype=object), "marks": pd.Series(marks, dtype=object)})


@F.pandas_udf(T.BinaryType())
def _packed_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield pd.Series(packed_elements(s.tolist()), dtype=object)


@F.pandas_udf(T.DoubleType())
def _similarity_udf(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def links_within(group: np.ndarray, label: np.ndarray, marks: np.ndarray, sets: list[bytes], side: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links between texts of one group and different classes, enough to join all classes that any link joins.

    ``side``: 0 compares only with 1, 1 only with 0, 2 with all of its group.
    Classes that a link has joined are not compared again.
    """
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out: list[tuple[int, int]] = []
    least = AGREE * marks.shape[1]
    order = np.argsort(group, kind="stable")
    ends = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, ends):
        for k in range(len(part) - 1):
            i, rest = part[k], part[k + 1 :]
            rest = rest[(label[rest] != label[i]) & ((side[rest] != side[i]) | (side[rest] == 2))]
            agree = (marks[rest] == marks[i]).sum(axis=1)
            for j in rest[agree >= least].tolist():
                a, b = top(int(label[i])), top(int(label[j]))
                if a != b and similarity(sets[i], sets[j]) >= threshold:
                    up[a] = b
                    out.append((int(i), j))
    return out


def _unit_sizes(placed: DataFrame) -> DataFrame:
    """(g, bucket, largest, n, small, few, many, work) of each unit of comparison.

    ``largest``: the label with most texts; ``many`` and ``few``: blocks of its
    texts and of all others; ``work``: rows that the unit's cells take.
    """
    classes_ = placed.groupBy("g", "bucket", "label").agg(F.count(F.lit(1)).alias("c"))
    sizes = classes_.groupBy("g", "bucket").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("n"))
    sizes = sizes.select("g", "bucket", F.col("m.label").alias("largest"), "n", F.col("m.c").alias("top"), (F.col("n") <= BLOCK).alias("small"))
    blocks = lambda c: F.greatest(F.ceil(c / BLOCK), F.lit(1))
    rest = F.col("n") - F.col("top")
    sizes = sizes.withColumns({"few": blocks(rest), "many": blocks(F.col("top"))})
    work = F.when(F.col("small"), F.col("n")).otherwise(rest * (F.col("few") + F.col("many")) + F.col("top") * F.col("few"))
    return sizes.select("g", "bucket", "largest", "n", "small", "few", "many", work.alias("work"))


def row_key(id_col: str, text_col: str):
    """Equal only for rows of equal id and text."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")), F.when(F.col(text_col).isNull(), F.lit("\0")).otherwise("")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(row_key, id, class_id, is_representative) for each row of ``docs``.

    ``is_representative`` marks one (id, text) of each class; rows repeating it
    share its row_key.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row_key"))
    rows = rows.withColumn("key", F.coalesce(F.md5("text"), F.concat(F.lit("null:"), "row_key")))
    signs = rows.withColumn("s", _signed_udf("text")).select("id", "row_key", "key", "s.*").withColumn("rid", F.monotonically_increasing_id())
    signs = written(signs, "signatures")
    texts = written(signs.groupBy("key").agg(F.min("rid").alias("rid")), "texts")  # equal texts are one node
    node = signs.join(texts, ["key", "rid"], "left_semi")
    member = node.select(F.explode("bands").alias("bucket"), "rid")
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = written(member.join(shared, "bucket"), "buckets")
    central = written(member.groupBy("rid").agg(F.sum("n").alias("places")), "central")
    # a node's text is fetched by its own row, not by content, so copies meet in no task
    wanted = node.select("rid", "row_key").join(central.select("rid"), "rid")
    sets = rows.select("row_key", "text").join(wanted, "row_key").dropDuplicates(["row_key"])
    sets = written(sets.select("rid", _packed_udf("text").alias("set")), "sets")

    # each text meets one leader
    ranked = member.join(central, "rid")
    leader = ranked.groupBy("bucket").agg(F.max(F.struct("places", "rid")).alias("l")).select("bucket", F.col("l.places").alias("places"), F.col("l.rid").alias("b"))
    met = member.select("bucket", F.col("rid").alias("a")).join(leader, "bucket").where("a != b")
    met = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.first("places").alias("places"))
    met = met.groupBy("a").agg(F.max(F.struct("n", "places", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    left, right = sets.select(F.col("rid").alias("a"), F.col("set").alias("sa")), sets.select(F.col("rid").alias("b"), F.col("set").alias("sb"))
    links = met.join(left, "a").join(right, "b").where(_similarity_udf("sa", "sb") >= threshold).select("a", "b")
    links = written(links, "links")

    # what that leaves open: buckets of several classes, whose classes are gathered where buckets overlap
    label = components(links).withColumnRenamed("node", "rid")
    classed = written(member.select("bucket", "rid").join(label, "rid", "left").withColumn("label", F.coalesce("label", "rid")), "classed")
    mixed = classed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket", "lo")
    open_ = written(classed.join(mixed, "bucket"), "open")
    # a class is one node, whatever its size; a bucket's classes are joined through its least one
    gathered = components(open_.where("label != lo").select(F.col("label").alias("a"), F.col("lo").alias("b")).distinct())
    gathered = written(open_.select("rid", "label").distinct().join(gathered.select(F.col("node").alias("label"), F.col("label").alias("g")), "label"), "gathered")
    # a unit's largest class is never compared with itself, only with the others
    # a group is one unit, unless its buckets one by one are less work (as in long chains of small buckets)
    placed = open_.select("bucket", "rid").join(gathered, "rid")
    whole = _unit_sizes(gathered.withColumn("bucket", F.lit(0).cast("long")))
    apart = _unit_sizes(placed)
    better = apart.groupBy("g").agg(F.sum("work").alias("a")).join(whole.select("g", "work"), "g").select("g", (F.col("a") < F.col("work")).alias("split"))
    better = written(better, "split")
    sizes = whole.join(better.where("not split"), "g").unionByName(apart.join(better.where("split"), "g"))
    sizes = sizes.select("g", "bucket", "largest", "n", "small", "few", "many")
    units = gathered.withColumn("bucket", F.lit(0).cast("long")).unionByName(placed.select("rid", "label", "g", "bucket")).join(sizes, ["g", "bucket"])
    shared_cells = gathered.count() // BLOCK + 1
    major = F.col("label") == F.col("largest")
    at = F.pmod(F.xxhash64("rid"), F.when(major, F.col("many")).otherwise(F.col("few"))).cast("int")
    block = F.when(F.col("small"), 0).when(major, F.col("few") + at).otherwise(at).cast("int")
    last = F.when(F.col("small"), 0).when(major, F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1).cast("int")
    cells = units.withColumn("u", F.xxhash64("g", "bucket")).withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), last)))
    cells = cells.select(
        "u", "rid", "label",
        F.when(F.col("small"), -1).otherwise(F.least("i", "j")).alias("lo"),
        F.greatest("i", "j").alias("hi"),
        F.when(F.col("i") == F.col("j"), 2).otherwise((F.col("i") > F.col("j")).cast("int")).alias("side"),
        F.when(F.col("small"), F.pmod(F.xxhash64("u"), F.lit(shared_cells))).otherwise(F.col("u")).alias("cell"),  # small units share tasks
    )
    cells = cells.join(sets, "rid").join(node.select("rid", "marks"), "rid")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        marks = np.frombuffer(b"".join(part["marks"]), np.uint8).reshape(len(part), -1)
        label = part["label"].to_numpy()
        found = links_within(part["u"].to_numpy(), label, marks, part["set"].tolist(), part["side"].to_numpy(), threshold)
        return pd.DataFrame({"a": [label[i] for i, _ in found], "b": [label[j] for _, j in found]}, dtype="int64")

    more = written(cells.groupBy("cell", "lo", "hi").applyInPandas(compare, "a long, b long"), "links")
    final = components(more).select(F.col("node").alias("label"), F.col("label").alias("top"))
    label = label.join(final, "label", "full").select(F.coalesce("rid", "label").alias("rid"), F.coalesce("top", "label").alias("label"))

    named = signs.select("id", "row_key", "key").join(texts, "key").join(label, "rid", "left")
    named = named.select("id", "row_key", F.coalesce("label", "rid").alias("label"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key"))  # known ids first
    best = named.groupBy("label").agg(first.alias("m")).select("label", F.col("m.id").alias("class_id"), F.col("m.row_key").alias("best"))
    return named.join(best, "label").select("row_key", "id", "class_id", (F.col("row_key") == F.col("best")).alias("is_representative"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` from each class, all columns."""
    best = written(classes(docs, id_col, text_col, threshold).where("is_representative").select(F.col("row_key").alias("key")).distinct(), "kept")
    rows = docs.select(whole_row(docs).alias("row"), row_key(id_col, text_col).alias("key"))
    return rows.join(best, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


# -- registered query -------------------------------------------------------
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "is_representative")
