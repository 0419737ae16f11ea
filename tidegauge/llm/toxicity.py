"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon has a fixed part and terms learned from the labelled texts: words and word beginnings
that toxic documents hold far more often than others. Both, and the trees, are fitted on at most
``TRAIN_ROWS`` labelled rows, drawn by a hash of the id, so that fitting costs the same at any size;
every row of the table is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import held_out, saved
from tidegauge.session import bound_batches

TRAIN_ROWS = 20_000  # bound of the labelled rows that are fitted on
TERMS_HELD = 100_000  # terms that a task counts before it hands them over
CANDIDATES = 20_000  # bound of the terms whose counts go to the driver
TERMS = 4_000  # bound of the learned lexicon
LEAST_DOCS, LEAST_ODDS = 5, 8.0
TREES, DEPTH, STEP, SEED = 30, 3, 0.3, 11
NEAR = 4  # words between an insult and a second person

# Insults, and second persons of the tables' languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash clown clowns pathetic worthless disgusting dumb fool fools "
    "garbage filth filthy vermin coward jerk bastard imbecile dimwit retard ugly hate despise disgrace".split()
)
SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch euer tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
_LEET = str.maketrans("013457@$!|", "oieastasii")
_EDGE = ".,;:!?\"'()[]{}<>|*#%&$@~`-_/\\+="
_RUN = re.compile(r"(.)\1+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){3,}[^\W\d_](?!\S)")
PREFIXES = (4, 5, 6)

FEATURES = (
    "words", "lexicon", "weighted", "strongest", "kinds", "hits", "insults", "obfuscated", "spaced", "near_second",
    "second", "capitals", "exclaims", "punctuation", "symbols", "digits", "repeats",
)


def _terms(token: str) -> Iterator[str]:
    """A word of at least four letters, and its beginnings, marked by a star."""
    if len(token) >= 4 and token.isalpha():
        yield token
        for n in PREFIXES:
            if len(token) > n:
                yield token[:n] + "*"


def _tokens(text: str | None) -> list[str]:
    return [t.strip(_EDGE) for t in (text or "").lower().split()]


class Features:
    """Dense features of a text under a lexicon, term to weight. Words seen before are looked up."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.seen = lexicon, {}
        plain = INSULTS | {t for t in lexicon if t[-1] != "*"}
        self.plain = plain
        self.squeezed = {_RUN.sub(r"\1", w) for w in plain}
        self.by_shape: dict[tuple[int, str], list[str]] = {}
        for w in plain:
            self.by_shape.setdefault((len(w), w[0]), []).append(w)

    def _hidden(self, raw: str) -> bool:
        """Whether symbols, digits or repeated letters hide a word of the lexicon."""
        plain = raw.translate(_LEET)
        if plain != raw and plain.strip(_EDGE) in self.plain:
            return True
        bare = re.sub(r"[^\w]|_", "", raw)
        if bare != raw.strip(_EDGE) and bare in self.plain:
            return True
        masked = raw.strip(".,;:!?\"'()")
        if "*" in masked[1:-1]:
            near = self.by_shape.get((len(masked), masked[0]), ())
            if any(all(a in (b, "*") for a, b in zip(masked, w, strict=True)) for w in near):
                return True
        squeezed = _RUN.sub(r"\1", bare)
        return squeezed != bare and bare not in self.plain and squeezed in self.squeezed

    def _word(self, raw: str) -> tuple[float, bool, bool, bool]:
        """Weight, insult, hidden, second person of one white-space separated piece in lower case."""
        word = raw.strip(_EDGE)
        weight = max((self.lexicon.get(t, 0.0) for t in _terms(word)), default=0.0)
        insult = word in INSULTS
        hidden = not insult and not weight and len(raw) > 3 and self._hidden(raw)
        return weight, insult, hidden, word in SECOND

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        raw, seen = text.lower().split(), self.seen
        if len(seen) > 300_000:
            seen.clear()
        n = max(1, len(raw))
        total = strongest = 0.0
        hits = insults = hidden = second = near = 0
        kinds, last_second, waiting = set(), -NEAR - 1, []
        for i, w in enumerate(raw):
            known = seen.get(w)
            if known is None:
                found = self._word(w)
                known = seen[w] = found if any(found) else False
            if not known:
                continue
            weight, insult, masked, person = known
            if person:
                second += 1
                last_second = i
                near += sum(i - j <= NEAR for j in waiting)
                waiting = []
            if weight or insult or masked:
                hits += 1
                total += weight
                strongest = max(strongest, weight)
                insults += insult
                hidden += masked
                kinds.add(w)
                if i - last_second <= NEAR:
                    near += 1
                else:
                    waiting = [j for j in waiting if i - j <= NEAR] + [i]
        spaced = sum(m.group().replace(" ", "") in self.plain for m in _SPACED.finditer(text.lower())) if " " in text else 0
        data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        count = np.bincount(data, minlength=256)
        size = max(1, len(data))
        upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
        symbols = int(count[[35, 36, 37, 38, 42, 64, 94, 126]].sum())
        marks = int(count[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
        repeats = int((data[2:] == data[1:-1])[data[1:-1] == data[:-2]].sum()) if len(data) > 2 else 0
        return [float(v) for v in (
            np.log1p(len(raw)), hits / n, total / n, strongest, np.log1p(len(kinds)), np.log1p(hits), insults / n,
            (hidden + spaced) / n, spaced, near / n, second / n, upper / max(1, upper + lower), (count[33] + count[63]) / size,
            marks / size, symbols / size, count[48:58].sum() / size, repeats / size,
        )]


def _features(lexicon: dict[str, float]):
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(lexicon)
        for texts in batches:
            yield pd.Series([features(t) for t in texts])

    return run


@dataclass
class Model:
    """``trees`` and ``calibration`` are None where the labels have one class or none; then ``rate`` is the score."""

    lexicon: dict[str, float]
    rate: float
    trees: object = None
    calibration: object = None

    def score(self, docs: DataFrame) -> DataFrame:
        """Rows (row, score): all columns of ``docs`` as a struct, and the calibrated score from 0 to 1.

        Only the text is looked at; null texts are empty, empty texts are scored like others.
        """
        bound_batches(docs.sparkSession)
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        if self.trees is None:
            return rows.select("row", F.lit(float(self.rate)).alias("score"))
        vector = array_to_vector(_features(self.lexicon)(F.col("row.text").cast("string")))
        scored = self.calibration.transform(_with_margin(self.trees.transform(rows.withColumn("features", vector))))
        return scored.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))).alias("score"))


def _with_margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("margin", vector_to_array("rawPrediction")[1])


def train_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Rows (doc_id, text, toxic) with labels outside the held-out fold, at most about ``most``.

    Rows without a label are left out; of several labels of an id the largest counts.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, most / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1_000_000)) < int(share * 1_000_000)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where(drawn)
    return saved(texts.join(known.where(drawn), "id").withColumnRenamed("id", "doc_id"), "toxicity-train")


def _document_counts(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """Rows (term, docs): in how many texts each term occurs; summed in each task before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()

        def summed() -> pd.DataFrame:
            return pd.DataFrame({"term": list(counts), "docs": list(counts.values())}).astype({"term": "str", "docs": "int64"})

        for batch in batches:
            for text in batch["text"]:
                found = {t for token in set(_tokens(text)) for t in _terms(token)}
                counts.update(found if only is None else found & only)
                if len(counts) > TERMS_HELD:
                    yield summed()
                    counts.clear()
        yield summed()

    return rows.select("text").mapInPandas(run, "term string, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


def learn_lexicon(rows: DataFrame, toxic: int, others: int) -> dict[str, float]:
    """Terms with their log odds: those of toxic texts that others hold at most an eighth as often."""
    least = max(LEAST_DOCS, toxic // 100)
    often = _document_counts(rows.where("toxic = 1")).where(F.col("docs") >= least)
    often = {r.term: r.docs for r in often.orderBy(F.desc("docs"), "term").limit(CANDIDATES).collect()}
    seen = {r.term: r.docs for r in _document_counts(rows.where("toxic = 0"), frozenset(often)).collect()}
    odds = {t: ((n + 0.5) / (toxic + 1)) / ((seen.get(t, 0) + 0.5) / (others + 1)) for t, n in often.items()}
    best = sorted((t for t in odds if odds[t] >= LEAST_ODDS), key=lambda t: (-odds[t], t))[:TERMS]
    return {t: float(min(8.0, np.log(odds[t]))) for t in best}


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows outside the held-out fold: trees on three quarters, calibration on the rest.

    The lexicon is learned from the trees' rows alone, so that the calibration rows are new to both.
    """
    bound_batches(docs.sparkSession)
    rows = train_rows(docs, labels, most)
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(4)) == 0
    grown, kept = rows.where(~part), rows.where(part)
    count = {r.toxic: r.n for r in grown.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, others = count.get(1, 0), count.get(0, 0)
    if not toxic or not others or len({r.toxic for r in kept.select("toxic").distinct().collect()}) < 2:
        return Model({}, toxic / max(1, toxic + others))
    lexicon = learn_lexicon(grown, toxic, others)
    table = saved(rows.select(
        "doc_id", F.col("toxic").cast("double").alias("label"), _features(lexicon)(F.col("text")).alias("features")
    ), "toxicity-features").withColumn("features", array_to_vector("features"))
    # the same order whatever the partitions, so that reruns grow the same trees
    fitted = table.where(~part).repartition(4, "doc_id").sortWithinPartitions("doc_id", "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, featuresCol="features", labelCol="label").fit(fitted)
    margins = _with_margin(trees.transform(table.where(part))).select("label", "margin")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(margins)
    return Model(lexicon, toxic / (toxic + others), trees, calibration)


def scores(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from a score of 0.5).

    Null and empty texts are scored; rows with a null id are not held out; repeated rows score alike.
    Without labels of both classes every score is the share of toxic labels, 0 without any.
    """
    scored = fit(docs, labels, most).score(docs.select("doc_id", "text"))
    doc_id = F.col("row.doc_id").cast("long")
    return scored.select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5, most: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows whose score is ``least`` or more."""
    scored = fit(docs, labels, most).score(docs)
    return scored.where(F.col("score") < least).select(*[F.col(f"row.`{c}`") for c in docs.columns])
