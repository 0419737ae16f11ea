from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import pii
from tidegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
GIVEN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
TRICKY = [
    "a@b.c%x@d.e a@b@c.d x@y. @z.q ..@..a@b.c.d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.00255.3.4 1.2.3 9.9.9.9",
    "4845168114407329 4845-1681-1440-7329 4845 1681 1440 7329 1 4845  1681", "12 4845168114407329", "0" * 14 + " " + "0" * 20,
    "+1 (017) 555-7713 +1+12 345 678 90x +12345678901234567890 +1 .", " é +49 30 1234567  a@b.c", "é" * 50 + "a@é.b 1.1.1.1",
    "a" * 30_000 + "@", "1" * 30_000, "1 " * 10_000 + "x", "a@b.c " * 400, "+1" + " " * 20_000,
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not GB83WEST12345698765432", "my ssn 123-45-6789 or 123-45-6789x",
]


def plain(text):
    spans = []
    for rank, (kind, pattern) in enumerate(GIVEN):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1]))
                if not 14 <= len(d) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            spans.append((m.start(), rank, m.end(), kind))
    return sorted(spans)


def check(rows, texts):
    for r in rows:
        expected = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in expected)
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE)
        assert base == joined
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(e[3] == k for e in expected) for k, _ in GIVEN]


def test_table_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op4_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pii"))
    rows = [(100 + i, t, None, "a", 1) for i, t in enumerate(TRICKY)] + odd_documents()
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("found", F.lit(1)).withColumn("value", F.lit("x"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder, {r[0]: r[1] for r in rows}


def test_odd_texts(spark, odd):
    folder, texts = odd
    rows = QUERIES["op4_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    more = {r.doc_id: [s for s in r.spans.split(",") if s.startswith(("iban", "ssn"))] for r in rows}
    iban, ssn = TRICKY[-2], TRICKY[-1]
    assert more[100 + len(TRICKY) - 2] == ["iban:5:32", f"iban:{iban.index('GB82')}:{iban.index(', not')}"]
    assert more[100 + len(TRICKY) - 1] == [f"ssn:7:{ssn.index(' or')}"]


def test_redaction(spark, odd):
    folder, texts = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[106] == " é [PHONE]  [EMAIL]" and got[1] is None and got[8] == texts[8]
    assert all(not plain(t) or t != texts[d] for d, t in got.items() if texts[d] is not None and plain(texts[d]))


def test_account_numbers_before_other_words(spark):
    """The number's length is its country's, whatever upper-case words or digits come next."""
    numbers = [
        "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201",
        "PL61 1090 1014 0000 0712 1981 2874", "HU42 1177 3016 1111 1018 0000 0000", "CZ65 0800 0000 1920 0014 5399", "NO93 8601 1117 947",
        "DE89 3704 0044 0532 0130 00", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606", "GB82WEST12345698765432",
    ]
    words = ["", " BIC CAIXESBB", " EUR 500", " 2024", " A 1", " GB82 WEST 1234 5698 7654 32", ". And"]
    texts = [f"IBAN {n}{w}" for n in numbers for w in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        number, word = numbers[r.doc_id // len(words)], words[r.doc_id % len(words)]
        second = [word[1:]] if "WEST" in word else []
        assert [s.value for s in r.found if s.kind == "iban"] == [number, *second], texts[r.doc_id]


def test_very_many_spans_in_one_text(spark):
    """100,000 spans, whose places, context and replacements are found in time about linear in them."""
    n = 50_000
    text = "".join(f"é u{i}@x.org +1 (017) 555-{i % 10_000:04d}\n" for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = pii.find(docs).first().found
    assert [(s.kind, s.start, s.end) for s in found] == [(k, a, b) for a, _, b, k in plain(text)]
    assert len(found) == 2 * n and all(text[s.start:s.end] == s.value for s in found)
    assert pii.redacted(docs).first().text == "é [EMAIL] [PHONE]\n" * n


def test_context_at_every_distance(spark):
    """A context word counts if it lies whole in the 48 code points before the span, wherever pieces of the text end."""
    texts = [("é" * before + " ssn" + " " * gap + "123-45-6789") for before in (0, 1, 50, 61, 64, 127) for gap in range(1, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        start = texts[r.doc_id].index("123")
        near = texts[r.doc_id][max(0, start - pii.CONTEXT):start]
        assert [s.start for s in r.found] == ([start] if "ssn" in near else []), (r.doc_id, near)


def test_redaction_of_overlapping_spans(spark):
    """Overlapping spans give the first one's kind; nothing of the others stays."""
    texts = ["+1 4845168114407329 x", "a@1.2.3.4 b 1.2.3.4@c.de 5.6.7.8", "é 1.2.3.4@c.de", "1.2.3.4", "no span", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.found for r in pii.find(docs).collect()}
    for r in pii.redacted(docs).collect():
        text, out, at = texts[r.doc_id], "", 0
        for s in found[r.doc_id]:
            if s.start >= at:
                out += text[at:s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        assert r.text == out + text[at:]
