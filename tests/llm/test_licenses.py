from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import licenses
from tidegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3 or later", "mit license mit license",
    "MIT\nLicense and the Apache   license, version 2.0; bsd 3-clause license", "MİT license mit licenſe MaKe mit licence",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software", " the MIT license " * 300,
    "no word of it", "committed licenses gplus", "This work is licensed under the GNU General Public License, version 3.",
]


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = lowered(text)
    return sorted(
        (i, label) for label, phrase in licenses.BASE.items() for i in range(len(w))
        if w[i:i + len(phrase.split())] == phrase.split()
    )


def detections(text):
    """Every rule on every text, without keyword gate; then pairwise suppression."""
    joined = " " + " ".join(lowered(text)) + " "
    found = []
    for order, rule in enumerate(licenses.rules()):
        for m in re.finditer(rule.pattern, joined):
            start = joined[:m.start()].count(" ") - 1
            found.append((start, start + m.group().count(" ") + 1, rule.label, rule.tier, order))

    def inside(a, b):
        return b[0] <= a[0] and a[1] <= b[1] and (b[3] > a[3] or b[3] == a[3] and (a[:2] != b[:2] or b[4] < a[4]))

    return sorted(f[:4] for f in found if not any(inside(f, g) for g in found if g != f))


def check(rows, texts):
    for r in rows:
        places = base(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(lowered(texts[r.doc_id])), len(places)), texts[r.doc_id]
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op10_licenses"](spark, SF_DIR).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows)
    check(rows, texts)


def test_odd_texts(spark, tmp_path):
    data = [(100 + i, t, None, "a", 1) for i, t in enumerate(TEXTS)] + odd_documents()
    docs = spark.createDataFrame(data, DOCUMENT).withColumn("words", F.lit("x")).withColumn("base", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] for r in data}
    rows = QUERIES["op10_licenses"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    labels = {r.doc_id - 100: r.labels for r in rows if r.doc_id}
    assert labels[0] == "cc-by-nc-4.0" and labels[1] == "gpl,gpl-3.0-or-later" and labels[7] == "" and labels[8] == ""
    for r in licenses.scan(docs).where("doc_id >= 100").collect():
        got = sorted((d.start, d.end, d.label, d.tier) for d in r.detections)
        assert got == detections(texts[r.doc_id]), texts[r.doc_id]


def test_hundreds_of_distinct_rules():
    made = licenses.rules()
    assert len(made) > 300 and [r.tier for r in made] == sorted((r.tier for r in made), reverse=True)
    assert all(re.compile(r.pattern) for r in made)


SHORT = [
    "Licensed under GPLv3.", "GNU GPLv2 or later", "gpl3", "LGPLv3 and LGPLv2.1", "AGPLv3", "MPLv2", "EPLv2", "0BSD", "zero clause BSD",
    "zlib/libpng licence", "Apache Software License 2.0", "creative commons by-sa 4.0", "the MIT licence", "GNU General Public Licencev3",
    "Apache Licensev2", "example complete translate account",
]


def test_short_forms(spark):
    docs = spark.createDataFrame(list(enumerate(SHORT)), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        got = sorted((d.start, d.end, d.label, d.tier) for d in r.detections)
        assert got == detections(SHORT[r.doc_id]), SHORT[r.doc_id]
        assert bool(got) == (r.doc_id < len(SHORT) - 1), SHORT[r.doc_id]


def examples(parts):
    """Strings of a parsed pattern: every branch, and every option taken and left; of sets and runs the first."""
    out = [""]
    for op, arg in parts:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            more = [chr(a[0] if isinstance(a, tuple) else a) for o, a in arg if str(o) in ("LITERAL", "RANGE")] or ["x"]
        elif name in ("ANY", "NOT_LITERAL"):
            more = ["x"]
        elif name == "BRANCH":
            more = [e for branch in arg[1] for e in examples(branch)]
        elif name == "SUBPATTERN":
            more = examples(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            one = examples(arg[2])
            more = [e * n for n in {arg[0], max(1, arg[0])} for e in one]
        else:
            assert name == "ASSERT", name
            more = [""]
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_match_passes_its_gate():
    for rule in licenses.rules():
        for text in examples(re._parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern.replace("(?<= )", "").replace("(?= )", ""), text), (rule.pattern, text)
            plain = f" {text} ".replace("licence", "license")
            assert any(f" {k}" in plain for k in rule.keyword.split("|")), (rule.keyword, text)


def test_long_repeats_do_not_overflow(spark):
    """Every part of a rule that may repeat, 100,000 times over, in one text."""
    n = 100_000
    texts = ["copyright c " + "1999 2024 " * (n // 2), "released under the " + "very " * n + "license", "copyright " * n,
             "spdx license identifier " * (n // 10), "neither the name of " + "x" * n, "x" * n]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [(d.label, d.start, d.end) for d in got[0].detections] == [("copyright", 0, n + 2)]
    assert got[1].n_words == n + 4 and got[5].n_words == 1


def test_very_many_detections_in_one_text(spark):
    """50,000 detections, each with one that lies inside it and goes."""
    n = 50_000
    docs = spark.createDataFrame([(1, "gnu gpl v3 or later mit license x " * n)], "doc_id long, text string")
    got = licenses.scan(docs).first()
    assert got.n_words == 8 * n and len(got.base) == n
    assert [(d.label, d.start, d.end) for d in got.detections] == [
        x for i in range(n) for x in (("gpl-3.0-or-later", 8 * i, 8 * i + 5), ("mit", 8 * i + 5, 8 * i + 7))
    ]
