import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F


import corpus_pipeline as C
from brute import contaminated, near_classes as classes, secrets

from basketlab.llm.byte_bpe import codec
from basketlab.llm.common import table, written


def test_every_stage_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    columns, seen = docs.columns, {}
    for name, stage in C.STAGES:
        seen[name] = docs
        docs = written(stage(spark, docs, d), name)
        assert name == "tokens" or docs.columns == columns
    seen["end"] = docs
    rows = {k: {r.doc_id: r for r in v.collect()} for k, v in seen.items()}
    text = lambda k: [(i, r.text) for i, r in sorted(rows[k].items())]

    marked = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    lost = rows["quality"].keys() - rows["near_duplicates"].keys()
    long_enough = {i for i, t in text("quality") if len(t.split()) >= 20}
    assert lost and not [i for i in lost & long_enough if marked.get(i) == 1]
    assert set(rows["decontamination"]) == {c for _, c in classes(text("near_duplicates"))}
    bench = [(r.item_id, r.text) for r in table(spark, d, "benchmark").collect()]
    assert set(rows["secrets"]) == {i for i, _, n, _ in contaminated(text("decontamination"), bench) if n == 0}
    assert set(rows["tokens"]) == set(rows["secrets"])
    for i, r in rows["tokens"].items():
        before = rows["secrets"][i].text
        assert (r.text == before) == (not secrets(before)) and r.n_chars == len(r.text)
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec(path, P.PATTERN).ranks, special_tokens={})
    for i, r in rows["end"].items():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.round_trip and r.n_tokens == len(ids) and ids == enc.encode_ordinary(rows["tokens"][i].text)


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    d, calls = "/root/testdata/sf0.001", []
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]

    def noted(name, stage):
        return name, lambda s, docs, sf_dir: calls.append((name, docs.count(), sf_dir)) or stage(s, docs, sf_dir)

    monkeypatch.setattr(C, "STAGES", [noted(n, f) for n, f in C.STAGES if n in ("quality", "secrets", "tokens")])
    out = C.run(spark, d)
    assert [n for n, _, _ in calls] == ["quality", "secrets", "tokens"] and {f for _, _, f in calls} == {d}
    assert calls[0][1] > calls[1][1] == calls[2][1] == out.count()


def test_stages_take_empty_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents").limit(0)
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, d), name)
        assert docs.count() == 0


def test_stages_pass_clashing_columns_and_odd_rows(spark):
    """Columns named like anything an operator makes, null and repeated rows, ties, very long texts."""
    d = "/root/testdata/sf0.001"
    good = table(spark, d, "documents").where("length(text) > 400").orderBy("doc_id").limit(30)
    odd = [(None, good.first().text), (9001, None), (9002, ""), (9003, ""), (9004, None), (9005, "a-" * 500_000 + "x"), (9006, "lorem ipsum dolor " * 60_000), (9007, ">" * 200_000 + " quoted")]
    odd += [(9008, "same id and text, twice in the table"), (9008, "same id and text, twice in the table")]
    docs = good.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    names = ["row", "key", "_key", "base", "spans", "quality", "kept", "n_words", "votes", "base_failed", "items", "n_hit", "class_id", "label", "rid", "n_repeat_words"]
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    docs = written(docs.withColumns({n: F.concat(F.lit(n + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in names}), "odd")
    sizes = []
    for name, stage in C.STAGES[:-1]:
        out = written(stage(spark, docs, d), name)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[n] == f"{n}:{'-' if r.doc_id is None else r.doc_id}" for n in names)
        if name == "near_duplicates":  # null texts are no copies, empty ones are; the null id yields to the known one
            assert sorted(r.doc_id for r in out.where("doc_id > 9000").collect()) == [9001, 9002, 9004, 9005, 9006, 9007, 9008]
            assert out.where("doc_id is null").count() == 0
        sizes.append(out.count())
    assert sizes[0] > 0 and sizes[2] > 0 and sizes[3] == docs.count()
    assert C.tokens(spark, docs, d).where("round_trip").count() == docs.count()
