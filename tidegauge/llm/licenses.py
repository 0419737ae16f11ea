"""License scan: ordered signature rules over normalised words, gated by keywords.

A text becomes its lower-cased words with single spaces, so signatures need no care for punctuation
or line breaks. Each rule names a keyword phrase, or several divided by "|"; its pattern is tried only
where a word and what follows begin with one of them, which every match of the pattern holds.
Detections are ranked by the rule's tier; one that lies inside another of the same or a higher tier
is suppressed. Everything is column expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import text_or_empty
from tidegauge.llm.marks import let, matches, running, unmarked

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words

# The phrases whose places are the base detections.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
BASE_CONFIDENCE = 0.6


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    tier: int  # 4 notice or header text, 3 name with version, 2 name alone, 1 hint
    confidence: float


# Versioned families: label, keyword, pattern of the name, versions.
FAMILIES = (
    ("gpl", "general public license", r"(?:gnu )?general public licen[sc]e", "1.0 2.0 3.0"),
    ("gpl", "gpl", r"(?:gnu )?gpl", "1.0 2.0 3.0"),
    ("lgpl", "lesser general public license", r"(?:gnu )?lesser general public licen[sc]e", "2.1 3.0"),
    ("lgpl", "library general public license", r"(?:gnu )?library general public licen[sc]e", "2.0"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", "2.0 2.1 3.0"),
    ("agpl", "affero general public license", r"(?:gnu )?affero general public licen[sc]e", "1.0 3.0"),
    ("agpl", "agpl", r"(?:gnu )?agpl", "1.0 3.0"),
    ("gfdl", "free documentation license", r"(?:gnu )?free documentation licen[sc]e", "1.1 1.2 1.3"),
    ("apache", "apache license|apache software license", r"apache(?: software)? licen[sc]e", "1.0 1.1 2.0"),
    ("apache", "asl", r"(?:apache )?asl", "1.1 2.0"),
    ("mpl", "mozilla public license", r"mozilla public licen[sc]e", "1.0 1.1 2.0"),
    ("mpl", "mpl", r"mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public license", r"eclipse public licen[sc]e", "1.0 2.0"),
    ("epl", "epl", r"epl", "1.0 2.0"),
    ("cddl", "cddl", r"cddl", "1.0 1.1"),
    ("cddl", "common development and distribution license", r"common development and distribution licen[sc]e", "1.0 1.1"),
    ("cpl", "common public license", r"common public licen[sc]e", "1.0"),
    ("ipl", "ibm public license", r"ibm public licen[sc]e", "1.0"),
    ("eupl", "eupl", r"eupl", "1.0 1.1 1.2"),
    ("eupl", "european union public license", r"european union public licen[sc]e", "1.0 1.1 1.2"),
    ("artistic", "artistic license", r"(?:perl )?artistic licen[sc]e", "1.0 2.0"),
    ("bsl", "boost software license", r"boost software licen[sc]e", "1.0"),
    ("afl", "academic free license", r"academic free licen[sc]e", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open software license", r"open software licen[sc]e", "1.0 1.1 2.0 2.1 3.0"),
    ("ofl", "open font license", r"(?:sil )?open font licen[sc]e", "1.0 1.1"),
    ("lppl", "latex project public license", r"latex project public licen[sc]e", "1.0 1.1 1.2 1.3"),
    ("qpl", "q public license", r"q public licen[sc]e", "1.0"),
    ("zpl", "zope public license", r"zope public licen[sc]e", "1.1 2.0 2.1"),
    ("php", "php license", r"php licen[sc]e", "3.0 3.01"),
    ("python", "python software foundation license", r"python software foundation licen[sc]e", "2.0"),
    ("odbl", "open database license", r"open database licen[sc]e", "1.0"),
    ("busl", "business source license", r"business source licen[sc]e", "1.0 1.1"),
    ("sspl", "server side public license", r"server side public licen[sc]e", "1.0"),
    ("elastic", "elastic license", r"elastic licen[sc]e", "1.0 2.0"),
    ("upl", "universal permissive license", r"universal permissive licen[sc]e", "1.0"),
    ("ms-pl", "microsoft public license", r"microsoft public licen[sc]e", "1.0"),
    ("ms-rl", "microsoft reciprocal license", r"microsoft reciprocal licen[sc]e", "1.0"),
)
CC_PARTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_NAMES = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s(?: works)?", "nc": "non ?commercial"}

# Names without versions, and sentences of notices: label, keyword, pattern, tier. A repeated group
# without a bound must be possessive: otherwise it is matched by recursion, which long runs overflow.
SIGNATURES = (
    ("mit", "mit license", r"(?:the )?mit licen[sc]e", 2),
    ("mit", "mit licensed", r"mit licensed", 2),
    ("mit", "expat license", r"(?:the )?expat licen[sc]e", 2),
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 4),
    ("mit", "deal in the software without restriction", r"deal in the software without restriction including without limitation", 4),
    ("bsd", "bsd license", r"(?:the )?(?:modified |new |simplified |revised )?bsd licen[sc]e", 2),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?", 3),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?", 3),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", 3),
    ("bsd-0-clause", "bsd|0bsd", r"(?:0bsd|zero clause bsd)(?: licen[sc]e)?", 3),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted", 4),
    ("bsd-3-clause", "endorse or promote products", r"neither the name of .{0,160}? may be used to endorse or promote products", 4),
    ("isc", "isc license", r"(?:the )?isc licen[sc]e", 2),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 4),
    ("zlib", "zlib license|zlib libpng license", r"(?:the )?zlib(?: libpng)? licen[sc]e", 2),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such", 4),
    ("unlicense", "unlicense", r"(?:the )?unlicense", 2),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain", 4),
    ("wtfpl", "wtfpl", r"wtfpl", 2),
    ("beerware", "beer ware license", r"beer ware licen[sc]e", 2),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 3),
    ("public-domain", "public domain|inpublic domain|intopublic domain|topublic domain", r"(?:released |placed |dedicated )?(?:in|into|to)? ?(?:the )?public domain", 2),
    ("apache-2.0", "licensed under the apache license", r"licensed under the apache licen[sc]e version 2 0", 4),
    ("gpl", "free software you can redistribute it", r"free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", 4),
    ("lgpl", "free software you can redistribute it", r"free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e", 4),
    ("proprietary", "all rights reserved", r"all rights reserved", 1),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", 3),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*+", 1),
    ("unknown-license", "this work is licensed under", r"this work is licensed under", 1),
    ("unknown-license", "released under", r"released under the [^ ]+(?: [^ ]+){0,3} licen[sc]e", 1),
    ("commercial", "end user license agreement", r"end user licen[sc]e agreement", 2),
)
CONFIDENCE = {4: 0.99, 3: 0.9, 2: 0.7, 1: 0.4}


def rules() -> list[Rule]:
    """All rules, in order: by tier, then as they stand above; about 420."""
    made = []

    def add(label, keyword, pattern, tier):
        made.append(Rule(label, keyword, rf"(?<= ){pattern}(?= )", tier, CONFIDENCE[tier]))

    for label, keyword, name, versions in FAMILIES:
        add(label, keyword, name, 2)
        for version in versions.split():
            major, minor = version.split(".")
            number = rf"{major} {minor}" if minor != "0" else rf"{major}(?: 0)?"
            add(f"{label}-{version}", keyword, rf"{name}(?: version| v)? ?v?{number}", 3)
            add(f"{label}-{version}-or-later", keyword, rf"{name}(?: version| v)? ?v?{number} or (?:any )?(?:later|newer)", 3)
            add(f"{label}-{version}", keyword, rf"version {number} of the {name}", 3)
    for parts in CC_PARTS:
        short = f"(?:cc|creative commons) {parts.replace('-', ' ')}"
        full = "creative commons " + " ".join(CC_NAMES[p] for p in parts.split("-"))
        for keyword, name in (("cc by|creative commons by", short), ("creative commons", full)):
            add(f"cc-{parts}", keyword, name, 2)
            for version in CC_VERSIONS:
                number = version.replace(".", " ")
                add(f"cc-{parts}-{version}", keyword, rf"{name}(?: licen[sc]e)? {number}(?: international| unported)?", 3)
    for label, keyword, pattern, tier in SIGNATURES:
        add(label, keyword, pattern, tier)
    spdx = "mit isc zlib unlicense wtfpl 0bsd bsd-2-clause bsd-3-clause apache-2.0 mpl-2.0 epl-2.0 gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 cc0-1.0 cc-by-4.0 cc-by-sa-4.0"
    for name in spdx.split():
        add(name, "spdx license identifier", "spdx license identifier " + name.replace("-", " ").replace(".", " "), 4)
    return sorted(made, key=lambda r: -r.tier)


def normalised(text: Column) -> Column:
    """Lower-cased words with one space before, between and after them; only A-Z change the words' ASCII letters."""
    # lower() would turn these two letters into ASCII ones
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("ſ")), F.lit("İ"), F.lit("ſ"))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(plain), GAP, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, pattern: Column) -> Column:
    """Word positions (start, end) of a pattern's matches; a match starts behind as many spaces as words, and one."""
    return F.transform(matches(words, pattern, _spaces), lambda m: F.struct(
        (m.start - 1).cast("long").alias("start"), m.end.cast("long").alias("end")
    ))


_SPAN = "array<struct<start:bigint,inside:bigint,order:int,end:bigint,label:string,tier:int,confidence:double>>"


def _detections(words: Column, keywords: Column) -> Column:
    """Spans of all rules whose keyword phrase occurs, widest first at a start, then in rule order."""
    table = F.array(*[
        F.struct(F.lit(i).alias("order"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                 F.lit(r.pattern).alias("pattern"), F.lit(r.tier).alias("tier"), F.lit(r.confidence).alias("confidence"))
        for i, r in enumerate(rules())
    ])
    due = F.filter(table, lambda r: F.array_contains(keywords, r.keyword))
    found = F.flatten(F.transform(due, lambda r: F.transform(_places(words, r.pattern), lambda m: F.struct(
        m.start.alias("start"), (-m.end).alias("inside"), r.order.alias("order"), m.end.alias("end"),
        r.label.alias("label"), r.tier.alias("tier"), r.confidence.alias("confidence"),
    ))))
    return F.array_sort(found.cast(_SPAN))


def _kept(found: Column) -> Column:
    """Without spans that lie in another of the same or a higher tier.

    In the order of ``_detections`` whatever contains a span comes before it, so the furthest end
    of the spans before it, per tier, tells the suppressed ones.
    """
    tiers = sorted(CONFIDENCE)
    none = F.lit(-1).cast("long")

    def furthest(spans: Column, tier: int) -> Column:
        return running(F.transform(spans, lambda s: F.when(s.tier >= tier, s.end).otherwise(none)), F.greatest)

    def kept(spans: Column, upto: Column) -> Column:
        def outside(s: Column, i: Column) -> Column:
            own = F.get(F.element_at(upto, s.tier), i - 1)  # a span's own tier and all higher ones
            return (i == 0) | (own < s.end)

        return F.filter(spans, outside)

    assert tiers == list(range(1, len(tiers) + 1))  # places in the array of furthest ends
    return let(found, lambda spans: let(F.array(*[furthest(spans, t) for t in tiers]), lambda upto: kept(spans, upto)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, base, detections.

    ``base`` holds (label, start, end) of every place of a base phrase, ``detections`` the rules'
    spans left after suppression, each (start, end, label, tier, confidence); positions count words
    from 0, ends are exclusive. Null and empty texts have no words and no spans. Repeated rows give
    repeated rows, an empty table none; other columns are not read.
    """
    words = unmarked(normalised(text_or_empty()))
    rows = docs.select("doc_id", words.alias("words"))
    # keyword phrases are written with "license"; a version may be glued to it
    rows = rows.withColumn("one_spelling", F.replace("words", F.lit("licence"), F.lit("license")))
    phrases = sorted({r.keyword for r in rules()})
    has = lambda phrase: F.contains(F.col("words"), F.lit(f" {phrase} "))
    begins = lambda phrase: F.contains(F.col("one_spelling"), F.lit(f" {phrase}"))
    keywords = F.array_compact(F.array(*[F.when(reduce(or_, map(begins, p.split("|"))), F.lit(p)) for p in phrases]))
    base = F.concat(*[_base(label, phrase, has(phrase)) for label, phrase in BASE.items()])
    n_words = F.when(F.length("words") > 2, _spaces(F.col("words")) - 1).otherwise(0).cast("long")
    rows = rows.select("doc_id", "words", n_words.alias("n_words"), keywords.alias("keywords"), base.alias("base"))
    found = F.when(F.size("keywords") > 0, _kept(_detections(F.col("words"), F.col("keywords")))).otherwise(F.array().cast(_SPAN))
    return rows.select("doc_id", "n_words", "base", found.alias("detections"))


def _base(label: str, phrase: str, present: Column) -> Column:
    places = F.transform(_places(F.col("words"), F.lit(f"(?<= ){phrase}(?= )")), lambda m: F.struct(
        F.lit(label).alias("label"), m.start.alias("start"), m.end.alias("end")
    ))
    return F.when(present, places).otherwise(F.array()).cast("array<struct<label:string,start:bigint,end:bigint>>")
