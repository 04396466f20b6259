import random

import pytest

from basketlab.llm import license_scan as L

# fixed values: the licence lines planted in the test corpus
TRUTH = {
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "GNU General Public License, version 3": "gpl-3.0",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "Released under the MIT License": "mit",
}


@pytest.fixture(scope="module")
def corpus(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]


@pytest.fixture(scope="module")
def model(corpus):
    rng = random.Random(1)
    lines = [p for t in corpus for p in t.split("\n") if p.strip()]
    return L.train(rng.sample(lines, 3000))


def test_planted_licences(model, corpus):
    wrong = total = false = 0
    for text, (n, hits) in zip(corpus, model.scan(corpus), strict=True):
        lines = text.split("\n")
        assert n == sum(any(c.isalnum() for c in x) for x in lines)
        found = {k: f for k, f, _, _ in hits}
        for k, line in enumerate(lines):
            want = next((f for t, f in TRUTH.items() if t in line), None)
            total += want is not None
            wrong += want is not None and found.get(k) != want
            false += want is None and k in found and "reserved" not in line
    assert total > 100 and wrong == 0 and false <= 0.002 * sum(t.count("\n") + 1 for t in corpus)


def test_families_and_unknown(model):
    def one(text):
        _, hits = model.scan([text])[0]
        return hits[0][1] if hits else None

    for family, templates in L.TEMPLATES.items():
        assert [one(t) for t in templates] == [family] * len(templates)
    assert one("Released under the terms of the Banana License") == "unknown"
    assert one("the cat sat on the mat and slept") is None
    assert one("word " * 3000 + "Licensed under CC BY-SA 4.0. " + "word " * 2000) == "cc-by-sa-4.0"


def test_edge_cases(make, model):
    df = make([(1, None), (2, ""), (3, "\n \n"), (4, "Released under the MIT License."), (4, "Released under the MIT License.")], clash=("found", "family"))
    got = sorted((r.doc_id, r.n_paragraphs, [(f.paragraph, f.family, f.confirmed) for f in r.found]) for r in L.scan(df, model).collect())
    assert got == [(1, 0, []), (2, 0, []), (3, 0, [])] + [(4, 1, [(0, "mit", True)])] * 2
    assert L.scan(make([]), model).count() == 0
    assert L.train(L.sample_paragraphs(make([]))).scan(["SPDX-License-Identifier: MIT"])[0][1][0][1] == "mit"


def test_training_sample_is_bounded_and_the_same_for_any_partitioning(spark):
    from pyspark.sql import functions as F

    from basketlab.llm.common import bounded_sample

    df = spark.range(5000).select(F.xxhash64("id").alias("h"), "id")
    one = [r.id for r in bounded_sample(df.repartition(3), 100, "h").collect()]
    assert len(one) == 100 and one == [r.id for r in bounded_sample(df.repartition(7), 100, "h").collect()]
    assert bounded_sample(df.limit(7), 100, "h").count() == 7


def test_wrapped_notices(model):
    import textwrap

    prose = "the old mill by the river was sold to a family from the next town who painted it white"
    for family, templates in L.TEMPLATES.items():
        for t in templates:
            for width in (25, 60, 72, 80):
                for mark in ("", "# ", " * ", "// "):
                    text = f"{prose}\n\n" + "\n".join(mark + x for x in textwrap.wrap(t, width)) + f"\n\n{prose}"
                    assert [(k, f, sure) for k, f, _, sure in model.scan([text])[0][1]] == [(2, family, True)], text


def test_every_family_of_a_line(model):
    def families(text):
        return [(k, f) for k, f, _, sure in model.scan([text])[0][1] if sure]

    assert families("SPDX-License-Identifier: MIT OR Apache-2.0") == [(0, "apache-2.0"), (0, "mit")]
    assert families("# SPDX-License-Identifier: (GPL-3.0-only OR BSD-3-Clause) AND MPL-2.0") == [(0, "bsd"), (0, "gpl-3.0"), (0, "mpl-2.0")]
    assert families("Licensed under the MIT license or the Apache License, Version 2.0") == [(0, "apache-2.0"), (0, "mit")]
    ends = L.TEMPLATES["mit"][1] + " word" * 6000 + " " + L.TEMPLATES["gpl-3.0"][1]
    assert families(ends) == [(0, "gpl-3.0"), (0, "mit")]
    assert families("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License") == [(0, "cc-by-sa-4.0")]
    assert families(L.TEMPLATES["gpl-3.0"][1].replace("program", "library").replace("GNU General", "GNU Lesser General")) == [(0, "lgpl-3.0")]
    many = "\n".join([L.TEMPLATES["mit"][0], "plain words of no import", L.TEMPLATES["mit"][0], L.TEMPLATES["bsd"][0]])
    assert families(many) == [(0, "mit"), (2, "mit"), (3, "bsd")]


def test_copies_of_a_paragraph_count_once_in_the_sample(make):
    df = make([(i, f"line number {i % 400} of the text") for i in range(4000)])
    got = L.sample_paragraphs(df, most=50)
    assert len(got) == len(set(got)) == 50


def confirmed(model, text):
    return sorted({f for _, f, _, sure in model.scan([text])[0][1] if sure})


@pytest.mark.parametrize(
    "text, family",
    [
        ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2.0"),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1"),
        ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License)", "mpl-1.1"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "cc-by-nd-4.0"),
        ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"),
        ("This is free and unencumbered software released into the public domain.", "unlicense"),
        ("MIT License", "mit"),
    ],
)
def test_versions_and_variants_are_told_apart(model, text, family):
    assert confirmed(model, text) == [family]
    assert confirmed(model, f"the old mill by the river\n{text}\nwas sold to a family") == [family]


@pytest.mark.parametrize(
    "text",
    [
        "This work is licensed under the GNU General Public License, version 1",
        "Licensed under the Apache License, Version 1.1",
        "Licensed under the Mozilla Public License, version 1.0",
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
        "Licensed under CC BY 3.0",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
)
def test_versions_without_a_template_are_unknown(model, text):
    assert [(f, sure) for _, f, _, sure in model.scan([text])[0][1]] == [("unknown", False)]


def test_notices_against_a_plain_search(model):
    """Every template found by comparing word lists, and no other, in wrapped mixtures of notices and prose."""
    import re

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    wanted = {f: [words(t) for t in ts if len(words(t)) > 2] for f, ts in L.TEMPLATES.items()}
    prose = "the old mill by the river was sold to a family from the next town who painted it white and grew beans".split()
    rng = random.Random(5)
    notices = [t for ts in L.TEMPLATES.values() for t in ts if len(words(t)) > 2]
    for _ in range(150):
        parts = []
        for t in rng.sample(notices, rng.randint(0, 3)):
            parts += [rng.choice(prose) for _ in range(rng.randint(60, 90))] + t.split()
        parts += [rng.choice(prose) for _ in range(70)]
        text = "".join(p + rng.choice(["\n", " ", " ", " ", " "]) for p in parts)
        w = words(text)
        there = {tuple(w[i : i + n]) for n in {len(t) for ts in wanted.values() for t in ts} for i in range(len(w) - n + 1)}
        assert confirmed(model, text) == sorted(f for f, ts in wanted.items() if any(tuple(t) in there for t in ts)), text


def test_operands_far_into_an_expression(model):
    many = " OR ".join(f"LicenseRef-Custom-{i}" for i in range(40))
    assert confirmed(model, f"SPDX-License-Identifier: {many} OR MIT") == ["mit"]
    assert confirmed(model, "SPDX-License-Identifier: LicenseRef-Custom\nthis or MIT") == []


def test_families_left_out_of_training_are_unknown(corpus):
    """The calibrated class holds for families that a model never saw: their notices are licence wording of no known family."""
    rng = random.Random(2)
    lines = [p for t in corpus for p in t.split("\n") if p.strip()]
    negatives, fresh = rng.sample(lines, 1500), rng.sample(lines, 1500)
    texts, y, wording = L.examples(negatives)
    design = [L.left_out(y, wording, k) for k in range(L.FOLDS)]
    assert all((true[~out] == y[~out]).all() for out, true in design)
    assert all((true[(y > 1) & (y % L.FOLDS == k)] == 1).all() for k, (_, true) in enumerate(design))
    model = L.train(negatives)
    strange = ["Licensed under the Artistic License 2.0", "This code is distributed under the Eclipse Public License, version 2.0", "Licensed under the Boost Software License, Version 1.0", "Released under the zlib license"]
    hits = [model.scan([t])[0][1] for t in strange]
    assert sum([f for _, f, _, _ in h] == ["unknown"] for h in hits) >= 3 and not any(sure for h in hits for *_, sure in h)
    flagged = sum(any(f == "unknown" for _, f, _, _ in h) and "icens" not in t and "reserved" not in t for t, (_, h) in zip(fresh, model.scan(fresh), strict=True))
    assert flagged <= 0.005 * len(fresh)
    few = L.train([])  # without any paragraph to learn from, plain text still is none
    assert few.scan(["Haanth ndenon.", "plain words of no import " * 100]) == [(1, []), (1, [])]
