"""Quality rules as weak supervision (native: DataFrame functions only).

Each rule votes good (+1), bad (-1) or abstains (0) on a document. No rule has
to pass: expectation-maximisation estimates, without labels, how often each
rule is right about good and about bad documents, and the verdict is the
posterior probability of good quality given all votes. EM needs only how often
each vote pattern occurs, at most ``3 ** len(RULES)`` rows whatever the number
of documents; each round is one aggregate over that small table and only the
parameters (four numbers a rule) reach the driver.

Defined cases: null and empty texts have no words and fail the base test;
repeated rows and ties are judged alike, each on its own; an empty table gives
an empty result (the model then keeps its prior); other columns pass through,
and columns whose names clash with the result's are replaced.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm.common import SPACE, count_of, let, table, windows, words, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 20, 30, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_loud", "n_digits", "n_distinct", "n_ended")


def covered_words(hashes: Column, width: int) -> Column:
    """Words inside windows (given by hash, in text order) that occur twice or more."""

    def cover(h: Column) -> Column:
        in_order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            twin = lambda e, i: (F.get(s, i - 1)["h"].eqNullSafe(e["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(e["h"]))
            return F.array_sort(F.transform(F.filter(s, twin), lambda e: e["p"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(in_order, lambda s: let(starts(s), total))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(cover(h)))


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text, computed within the row (no shuffle).

    Windows of eight words are compared by a 64-bit hash within one document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.drop(*COUNTS, "_words", "_lines")
    df = df.withColumn("_words", words(F.col(text_col)))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != ""))
    n = F.size("_words")
    repeated = F.coalesce(covered_words(windows(F.col("_words"), n, WINDOW, F.xxhash64), WINDOW), F.lit(0))
    ended = F.filter(F.col("_lines"), lambda x: F.rtrim(x).rlike(r"[.?;:…]$"))
    made = {
        "n_words": n,
        "word_chars": F.char_length(F.translate(text, BLANKS, "")),
        "n_symbols": count_of(text, SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
        "n_lines": F.size("_lines"),
        "n_upper": count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑÓÍÁÚ"),
        "n_loud": count_of(text, "!"),
        "n_digits": count_of(text, "0123456789"),
        "n_distinct": F.size(F.array_distinct("_words")),
        "n_ended": F.size(ended),
    }
    return df.withColumns({k: v.cast("long") for k, v in made.items()}).drop("_words", "_lines")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _rules() -> dict[str, Column]:
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    return {
        "length": _vote(n < 20, n >= 50),
        "noise": _vote((F.col("n_symbols") + F.col("n_loud")) * 5 > n, (F.col("n_symbols") + F.col("n_loud")) * 50 <= n),
        "marks": _vote((F.col("n_symbols") + F.col("n_loud")) * 30 > chars, (F.col("n_symbols") + F.col("n_loud")) * 300 <= chars),
        "shouting": _vote(F.col("n_upper") * 3 > chars, F.col("n_upper") * 8 <= chars),
        "copied_lines": _vote(F.col("n_dup_lines") * 10 > lines * 3, F.col("n_dup_lines") * 10 <= lines),
        "repetition": _vote(F.col("n_repeat_words") * 100 > n * 20, F.col("n_repeat_words") * 100 <= n * 5),
        "word_length": _vote((chars < n * 2) | (chars > n * 14), (chars >= n * 3) & (chars <= n * 10)),
        "sentences": _vote(F.col("n_ended") * 5 < lines, F.col("n_ended") * 2 >= lines),
        "digits": _vote(F.col("n_digits") * 5 > chars, F.col("n_digits") * 20 <= chars),
    }


RULES = ("length", "noise", "marks", "shouting", "copied_lines", "repetition", "word_length", "sentences", "digits")


def with_votes(counted: DataFrame) -> DataFrame:
    """Adds ``votes``: one of -1, 0, 1 for each of RULES, in that order."""
    return counted.withColumn("votes", F.array(*[_rules()[r].cast("byte") for r in RULES]))


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and, for each rule, how often its votes are right.

    ``good[r]``: share of up-votes among the rule's votes on good documents;
    ``bad[r]``: share of down-votes among its votes on bad ones.
    """

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]
    rounds: int = 0

    def posterior(self) -> Column:
        """Probability of good quality given ``votes``.

        The weights are array values, not numbers in the expression, so every
        round of ``fit`` has the same plan and runs the same compiled code.
        """
        both = list(zip(self.good, self.bad, strict=True))
        up = F.lit([math.log(g / (1 - b)) for g, b in both])
        down = F.lit([math.log((1 - g) / b) for g, b in both])
        start = F.get(F.lit([math.log(self.prior / (1 - self.prior))]), F.lit(0))
        weights = F.transform("votes", lambda v, i: F.when(v == 1, F.get(up, i)).when(v == -1, F.get(down, i)).otherwise(0.0))
        return 1 / (1 + F.exp(-F.aggregate(weights, start, lambda a, x: a + x)))


START = VoteModel(0.9, (0.998,) * len(RULES), (0.2,) * len(RULES))


def vote_patterns(voted: DataFrame) -> DataFrame:
    """How often each pattern of votes occurs: at most 3 ** rules rows, counted map-side first."""
    return written(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("docs")), "votes").coalesce(1)


def fit(patterns: DataFrame, tol: float = 1e-4, strength: float = 20.0) -> VoteModel:
    """Expectation-maximisation over the counted patterns.

    ``strength`` pseudo-votes of the starting model keep every accuracy inside
    (0, 1) and its side of the label (good stays good). EM raises the
    likelihood every round; it goes on until no parameter moves by more than
    ``tol``.
    """
    model = START
    for k in itertools.count(1):
        # one vote in the last place makes that place's sums those of all documents
        each = patterns.withColumn("_p", model.posterior()).select("docs", "_p", F.posexplode(F.concat("votes", F.array(F.lit(1).cast("byte")))).alias("rule", "vote"))
        sums = each.where("vote != 0").groupBy("rule", "vote").agg(F.sum(F.col("docs") * F.col("_p")).alias("good"), F.sum(F.col("docs") * (1 - F.col("_p"))).alias("bad"))
        s = {(r.rule, r.vote): (r.good, r.bad) for r in sums.collect()}  # at most two rows a rule
        at = lambda i, v, k: s.get((i, v), (0.0, 0.0))[k]
        share = lambda right, wrong, start: (right + strength * start) / (right + wrong + strength)
        every = range(len(RULES))
        new = VoteModel(
            share(at(len(RULES), 1, 0), at(len(RULES), 1, 1), START.prior),
            tuple(share(at(i, 1, 0), at(i, -1, 0), START.good[i]) for i in every),
            tuple(share(at(i, -1, 1), at(i, 1, 1), START.bad[i]) for i in every),
            k,
        )
        moved = max(abs(a - b) for a, b in zip((new.prior, *new.good, *new.bad), (model.prior, *model.good, *model.bad), strict=True))
        model = new
        if moved <= tol:
            return model


def judge(votes: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Adds base_failed, quality (posterior) and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    df = votes.withColumns({"base_failed": failed, "quality": model.posterior()})
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def judged(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with votes, posterior and verdict. The texts are counted once: rows are written with their votes, then judged."""
    votes = written(with_votes(text_counts(docs, text_col)), "votes")
    return judge(votes, fit(vote_patterns(votes)), threshold)


# -- registered query -------------------------------------------------------
RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    votes = written(with_votes(text_counts(docs)).drop("text"), "quality")
    return judge(votes, fit(vote_patterns(votes))).select(*RESULT)
