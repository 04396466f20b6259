"""Secret scan (native: DataFrame functions only).

Three patterns find assigned values, access keys and hex strings. Beyond them,
a window slides over every candidate string (a long run of key characters);
the Shannon entropy of the window is kept by incremental counts: of each step
only the entering and the leaving character change their counts. A stretch of
windows whose entropy reaches the bound of the string's character class is a
span of kind ``entropy``, unless the allow-list knows the string or a pattern
match covers it. Entropies are whole numbers (millionths of a bit), so results
do not depend on rounding.

Defined cases: null texts are empty and hold no secret; texts are scanned
whole; rows are independent, so ties and repeated rows need no rule and an
empty table gives an empty result; other columns pass through and clashing
result columns are replaced. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm.common import let, table

# fixed values: the patterns of the contract
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"  # characters of a candidate
WIDTH = 20
UNIT = 1_000_000
_NAME = r"[A-Za-z_-]*(?:[0-9]{0,6}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"  # a step of a path: words, a short number or a UUID


def _one_case(case: str, other: str) -> str:
    """Strings with a stretch of whole parts (between + / _ -) in one letter case with digits, unless they are paths of names."""
    run = f"[{case}0-9+/_-]"
    inside = lambda c, rest: f"(?=[{rest}+/_-]*+[{c}][{case}0-9]*+(?![A-Za-z0-9]))"  # noqa: E731  a part that ends within the stretch holds one of c
    stretch = f"(?:^|(?<=[{other}])[{case}0-9]*+){inside('0-9', case)}{inside(case, '0-9')}{run}{{20,}}(?![A-Za-z0-9])"
    return rf"^(?=.*[0-9])(?=.*[{case}])(?=.*(?:^|/)(?!{_NAME}(?:/|$)))(?=.*?{stretch})"


def _hex_part(letters: str) -> str:
    return f"(?=[0-9{letters}]*[0-9])(?=[0-9{letters}]*[{letters}])[0-9{letters}]{{20,}}"


#: Least entropy in bits of a window, by the first class that fits the candidate; candidates that fit none are never secrets.
#: A candidate gets the bound of its most telling part, so nothing written beside a secret hides it.
CLASSES = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", 2.9),
    ("hex_part", rf"(?<![A-Za-z0-9])(?:{_hex_part('a-f')}|{_hex_part('A-F')})(?![A-Za-z0-9])", 2.9),
    ("upper_digit", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.4),
    ("lower_digit", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", 3.4),
    ("upper_part", _one_case("A-Z", "a-z"), 3.4),
    ("lower_part", _one_case("a-z", "A-Z"), 3.4),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", 3.7),
)
#: Strings that are no secrets: UUIDs, paths of words, numbered names, documentation examples.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^(?!.*[/_-]{2})(?!.*[_-]$)/?[A-Za-z][A-Za-z/_-]*[0-9]{0,6}/?$",  # no repeated group: those recurse in Java and end the JVM on long strings
    r"EXAMPLE",
    r"^[0-9-]+$",
)


def weight(c: int) -> int:
    """c * log2(c) in millionths, a whole number."""
    return round(c * math.log2(c) * UNIT) if c > 1 else 0


def bound(bits: float, width: int = WIDTH) -> int:
    """Largest sum of weights of a window whose entropy is at least ``bits``."""
    return weight(width) - round(bits * width * UNIT)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches: array of (start, end, value of the group), in order."""

    def place(pieces: Column, whole: Column, part: Column) -> Column:
        empty = F.lit(None).cast("array<struct<start:int,end:int,value:string>>")
        start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array()).alias("out"))

        def step(s: Column, i: Column) -> Column:
            a = s["at"] + F.char_length(F.get(pieces, i))
            b = a + F.char_length(F.get(whole, i))
            hit = F.struct(a.alias("start"), b.alias("end"), F.get(part, i).alias("value"))
            return F.struct(b.alias("at"), F.concat(s["out"], F.array(hit)).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(whole) - 1), start, step, lambda s: s["out"])

    every = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    found = let(F.split(text, pattern, -1), lambda p: let(every(0), lambda w: place(p, w, w if group == 0 else every(group))))
    return F.when(text.rlike(pattern), found)


def _spans(hits: Column, kind: str, least: int) -> Column:
    kept = F.filter(hits, lambda h: F.char_length(h["value"]) >= least)
    made = F.transform(kept, lambda h: F.struct(h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), h["end"].alias("end")))
    return F.coalesce(made, F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _hot_stretches(value: Column, most: Column) -> Column:
    """Stretches (start, end) of windows whose summed weights are at most ``most``, within one string."""
    table_ = F.lit([weight(c) for c in range(WIDTH + 1)]).cast("array<bigint>")
    none = F.lit([0] * len(ALPHABET)).cast("array<tinyint>")

    def scan(codes: Column) -> Column:
        span = "struct<start:int,end:int>"
        begin = F.struct(
            F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(f"array<{span}>").alias("out"), none.alias("counts")
        )

        def step(s: Column, i: Column) -> Column:
            rest = F.greatest(i - WIDTH + 1, F.lit(0))
            new = F.get(codes, i)
            old = F.when(i >= WIDTH, F.get(codes, F.greatest(i - WIDTH, F.lit(0)))).otherwise(F.lit(-1))
            had = F.get(s["counts"], F.greatest(old, F.lit(0)))
            gone = F.when(old >= 0, F.get(table_, had - 1) - F.get(table_, had)).otherwise(F.lit(0).cast("bigint"))
            come = let(F.get(s["counts"], new) - (new == old).cast("tinyint"), lambda c: F.get(table_, c + 1) - F.get(table_, c))
            # only the counts of the entering and the leaving character change
            counts = F.transform(s["counts"], lambda c, k: (c + (k == new).cast("tinyint") - (k == old).cast("tinyint")).cast("tinyint"))
            return let(
                s["sum"] + gone + come,
                lambda total: let(
                    (i >= WIDTH - 1) & (total <= most),
                    lambda hot: let(
                        hot & (s["start"] >= 0) & (rest <= s["end"]),
                        lambda more: F.struct(
                            total.alias("sum"),
                            F.when(hot & ~more, rest).otherwise(s["start"]).alias("start"),
                            F.when(hot, i + 1).otherwise(s["end"]).alias("end"),
                            F.when(hot & ~more & (s["start"] >= 0), F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["out"]).alias("out"),
                            counts.alias("counts"),
                        ),
                    ),
                ),
            )

        last = lambda s: F.when(s["start"] >= 0, F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["out"])
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), begin, step, last)

    return let(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1), scan)


def _entropy_spans(text: Column, base: Column) -> Column:
    def of(h: Column) -> Column:
        value = h["value"]
        known = F.lit(False)
        for p in ALLOW:
            known = known | value.rlike(p)
        most = F.lit(None).cast("bigint")
        for _, p, bits in reversed(CLASSES):
            most = F.when(value.rlike(p), F.lit(bound(bits)).cast("bigint")).otherwise(most)
        most = F.when(~known, most)
        found = let(most, lambda m: F.when(m.isNotNull(), _hot_stretches(value, m)).otherwise(F.array().cast("array<struct<start:int,end:int>>")))
        return F.transform(found, lambda x: F.struct((x["start"] + h["start"]).alias("start"), F.lit(3).alias("kind"), (x["end"] + h["start"]).alias("end")))

    every = F.flatten(F.transform(matches(text, CANDIDATE), of))
    covered = lambda s: F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    return F.coalesce(F.filter(every, lambda s: ~covered(s)), F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end) by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(
        _spans(matches(text, ASSIGN, 2), "assign", LEAST["assign"]),
        _spans(matches(text, ACCESS), "access", LEAST["access"]),
        _spans(matches(text, HEX[:-1] + "{24,}"), "hex", LEAST["hex"]),  # maximal runs: the same matches as of HEX, less the short ones
    )
    df = docs.drop("base", "spans").withColumn("base", F.array_sort(base))
    return df.withColumn("spans", F.array_sort(F.concat("base", _entropy_spans(text, F.col("base")))))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.lit(list(KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch of overlapping spans (ordered by start) replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        inside = x["start"] < s["at"]
        more = F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(inside, s["out"]).otherwise(more).alias("out"))

    full = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, full).otherwise(text)


# -- registered query -------------------------------------------------------
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
