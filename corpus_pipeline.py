"""Training-corpus pipeline over ``documents``; each stage is one operator of ``basketlab.llm``.

Defined cases, for every stage: the columns of ``docs`` come out as they went
in, whatever their names (``secrets`` changes ``text`` and ``n_chars`` only,
``tokens`` has columns of its own). A null or empty text has no words, so
``quality`` drops it; the later stages, given one, keep it: null texts are no
copies of each other, empty ones are, neither holds benchmark passages or
secrets, both have no tokens. Null ids are allowed; of a near-duplicate class
the least known id stays, of rows repeating one id and text one. Ties in a
verdict's bound count as kept. Texts of any length are read whole, and an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from basketlab.llm import byte_bpe, decontaminate, near_dedup, quality_rules, secret_scan
from basketlab.llm.common import table, whole_row, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The texts are counted once: rows are written with their votes, then judged."""
    rows = docs.select(whole_row(docs).alias("row"), "text")
    votes = quality_rules.with_votes(quality_rules.text_counts(rows)).select("row", "n_words", "n_repeat_words", "votes")
    votes = written(votes, "votes")
    kept = quality_rules.judge(votes, quality_rules.fit(quality_rules.vote_patterns(votes))).where("kept")
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id."""
    return near_dedup.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars, if there, follows the new text."""
    found = secret_scan.scan(docs.select(whole_row(docs).alias("row"), "text"))
    text = F.when(F.col("text").isNotNull(), secret_scan.redacted(F.col("text"), F.col("spans")))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length(text).cast("long"))
    return found.select(row.alias("row")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids (little-endian unsigned 32-bit) and whether they decode to the text."""
    import public_tokenizers  # only this stage needs the vocabulary files

    both = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decode=True)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return both.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: The vote model, the signatures and the merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
