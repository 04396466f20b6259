"""Benchmark decontamination by winnowing (native: DataFrame functions only).

Texts become words; the hash of every K neighbouring words is a gram. Of each
run of WINDOW - K + 1 neighbouring grams the least is kept (winnowing), on both
sides alike, so any WINDOW shared words share a kept gram. Joining the kept
grams finds the documents worth a second look; in those, every place of a
shared gram is a seed, seeds on one diagonal are one comparison, and the
diagonal is extended word by word over the passage, which settles exactly which
words lie in a shared window. An item with fewer than WINDOW words is a single
window; winnowing promises nothing for it, so grams as long as such items are
all kept (winnowing with a run of one), once for each length that occurs.

Joins are on gram hashes: the benchmark's side is one row for each gram and
passage, Spark broadcasts it only if its measured size allows and otherwise
splits hot grams as skewed joins. Items with the same words are one passage.

Defined cases: null and empty texts have no words and are clean; a benchmark
row without words has no window; repeated document rows get equal results each
(rows are told apart by id and text); null ids are ordinary values; other
columns pass through and clashing result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm.common import let, table, whole_row, windows, words, written

# fixed values: what separates words after lower-casing A-Z, and the window
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 5
RESULT = ("n_words", "n_hit", "items", "spans")


def text_words(text: Column) -> Column:
    return words(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), SEPARATORS)


def grams(items: Column, width: int = K) -> Column:
    """Hash of every ``width`` neighbouring words; null if there are fewer."""
    return windows(items, F.size(items), width, F.xxhash64)


def winnowed(hashes: Column, run: int = WINDOW - K + 1) -> Column:
    """Distinct least hashes of each ``run`` neighbouring ones."""
    return F.array_distinct(let(hashes, lambda h: windows(h, F.size(h), run, F.array_min)))


def passages(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(passage, words) and (passage, item): one passage for each distinct word sequence."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), text_words(F.col(text_col)).alias("pw")).where(F.size("pw") > 0)
    rows = written(rows.withColumn("passage", F.md5(F.concat_ws(" ", "pw"))), "benchmark")
    return rows.groupBy("passage").agg(F.first("pw").alias("pw")), rows.select("passage", "item").distinct()


def _kept_grams(pw: Column, short: list[int]) -> Column:
    """Grams of a text with which it takes part in the join, tagged by length."""
    tag = lambda h, width: F.transform(F.coalesce(h, F.array().cast("array<bigint>")), lambda x: F.xxhash64(x, F.lit(width)))
    kept = [tag(winnowed(grams(pw)), K)] + [tag(F.array_distinct(grams(pw, n)), -n) for n in short]
    return F.concat(*kept)


def hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each distinct document (``_key``) with a hit: n_hit, items (sorted strings), spans
    (starts and ends in words of its covered stretches).

    ``docs`` must carry ``_key``, which tells its rows apart.
    """
    texts, names = passages(benchmark, item_col, item_text_col)
    n = F.size("pw")
    short = [r[0] for r in texts.where(n < WINDOW).select(n).distinct().collect()]  # at most nine lengths
    short.sort()
    keep = F.when(n >= WINDOW, winnowed(grams(F.col("pw"))))
    kept_here = F.transform(F.coalesce(keep, F.array().cast("array<bigint>")), lambda x: F.xxhash64(x, F.lit(K)))
    for w in short:
        whole = F.when(n == w, F.transform(grams(F.col("pw"), w), lambda x: F.xxhash64(x, F.lit(-w))))
        kept_here = F.concat(kept_here, F.coalesce(whole, F.array().cast("array<bigint>")))
    marks = written(texts.select(F.explode(kept_here).alias("g")).distinct(), "marks")

    # documents that share a kept gram
    doc_words = docs.select("_key", text_words(F.col(text_col)).alias("dw"))
    near = doc_words.select("_key", F.explode(_kept_grams(F.col("dw"), short)).alias("g")).join(marks, "g", "left_semi")
    near = written(near.select("_key").distinct(), "near")
    some = doc_words.join(near, "_key", "left_semi").dropDuplicates(["_key"])
    some = written(some, "near-words")

    # every place of a shared gram is a seed; a diagonal is (passage, offset)
    place = lambda side, name, w: side.select("*", F.posexplode(grams(F.col(name), w)).alias("at", "h"))
    diagonals = None
    for w in [K, *[s for s in short if s < K]]:  # a passage shorter than a gram is one gram of its own length
        own = texts.where(n >= K) if w == K else texts.where(n == w)
        p = written(place(own, "pw", w).select("passage", F.col("at").alias("p"), "h"), "seeds")
        d = place(some, "dw", w).select("_key", F.col("at").alias("d"), "h")
        found = d.join(p, "h").select("_key", "passage", (F.col("d") - F.col("p")).alias("off")).distinct()
        diagonals = found if diagonals is None else diagonals.unionByName(found)
    diagonals = written(diagonals, "diagonals")

    # extension: compare the words on each diagonal, keep the windows that agree throughout
    low = F.greatest(F.col("off"), F.lit(0))
    long = F.least(F.size("dw") - low, n - (low - F.col("off")))
    width = F.least(n, F.lit(WINDOW))
    same = F.zip_with(F.slice("dw", low + 1, long), F.slice("pw", low - F.col("off") + 1, long), lambda x, y: x == y)
    starts = let(same, lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - width), lambda i: ~F.array_contains(F.slice(s, i + 1, width), False)))
    on = diagonals.join(texts, "passage").join(some, "_key").where(long >= width)
    found = on.select("_key", "passage", F.explode(starts).alias("i"), low.alias("low"), width.cast("int").alias("w"))
    found = written(found.select("_key", "passage", (F.col("i") + F.col("low")).cast("int").alias("start"), "w"), "windows")

    cover = found.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("start", "w"))).alias("s"))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def join_up(s: Column, x: Column) -> Column:
        a, b = x["start"], x["start"] + x["w"]
        more = a <= s["end"]
        closed = F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        return F.struct(
            F.when(more, s["start"]).otherwise(a).alias("start"),
            F.greatest(s["end"], b).alias("end"),
            F.when(more | (s["end"] < 0), s["out"]).otherwise(closed).alias("out"),
        )

    begin = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), empty.alias("out"))
    spans = F.aggregate("s", begin, join_up, lambda s: F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    cover = cover.select("_key", spans.alias("spans"))
    cover = cover.withColumn("n_hit", F.aggregate(F.transform("spans", lambda s: s["end"] - s["start"]), F.lit(0), lambda a, x: a + x).cast("long"))
    items = found.select("_key", "passage").distinct().join(names, "passage").groupBy("_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return cover.join(items, "_key", "left")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, _key): the whole row as a struct; keys are equal only for rows of equal id and text."""
    sep = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"), F.md5(sep).alias("_key"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, items and spans (word positions of the covered stretches)."""
    base = keyed(docs.drop(*RESULT), id_col, text_col)
    found = written(hits(base, benchmark, "text", item_col, item_text_col), "hits")
    counted = base.withColumn("n_words", F.size(text_words(F.col("text"))).cast("long"))
    full = counted.join(found, "_key", "left")
    return full.select(
        "row.*",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a window of the benchmark; all columns as they were."""
    base = keyed(docs, id_col, text_col)
    found = written(hits(base, benchmark, "text").select("_key"), "hits")
    return base.join(found, "_key", "left_anti").select("row.*")


# -- registered query -------------------------------------------------------
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
