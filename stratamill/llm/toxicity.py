"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon of words and word beginnings is learnt from labelled documents by their log odds; features are its densities,
how near second-person words stand, capitals, punctuation, and words written to hide (digits or signs among letters, drawn-out
letters) that match the lexicon once restored. The trees are fitted on one part of a bounded sample of labelled rows (``most_rows``,
chosen by a hash of the identifier) and calibrated on the other; scoring covers all documents.
Labels, language, source and identifier are no inputs of a score.

Defined results: null text is empty text and gets a score as well. Rows are scored each; of repeated labels the highest counts,
null ones do not. Without labels of both classes every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices, stored, unnamed

#: Labelled rows that the lexicon and the trees are fitted on at most, and terms of the lexicon at most.
MOST_ROWS, MOST_TERMS = 20_000, 2_000
#: Beginnings of words that are terms, besides whole words.
PREFIXES = (4, 5, 6)
#: A term needs this share of the toxic documents (and ``LEAST_DOCS`` of them) and these log odds.
LEAST_SHARE, LEAST_DOCS, LEAST_ODDS = 0.005, 3, 2.5
THRESHOLD = 0.3
FEATURES = (
    "_density", "_hits", "_strongest", "_weight", "_near_second_person", "_second_person", "_capitals", "_exclamations",
    "_punctuation", "_hidden", "_hidden_hits", "_drawn_out",
)
#: Second-person words of four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes tú ti tus vosotros"
    .split())
#: Signs that stand for letters.
_RESTORE = str.maketrans("013457@$!|€", "oieastasiie")

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][\d@$!|€*.\-_]+[^\W\d_]|^[\d@$!|€]+[^\W\d_]{2}|[^\W\d_]{2}[\d@$!|€]+$")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")

HIT, SECOND, HIDDEN, HIDDEN_HIT, DRAWN = 1, 2, 4, 8, 16


def terms(text: Column) -> Column:
    """The different terms of a text: lower-case words without signs at their ends, and their beginnings."""
    words = F.array_distinct(F.split(F.lower(text), r"[\x20\x09-\x0D]+"))
    words = F.transform(words, lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))

    def begun(n: int) -> Column:
        return F.transform(F.filter(words, lambda w: F.char_length(w) > n), lambda w: F.concat(F.left(w, F.lit(n)), F.lit("~")))

    parts = [begun(n) for n in PREFIXES]
    return F.filter(F.array_distinct(F.concat(F.filter(words, lambda w: F.char_length(w) > 2), *parts)), lambda w: w != "")


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Terms with their log odds (at most ``MOST_TERMS``); ``labelled`` is the bounded sample with ``text`` and ``toxic``."""
    counts = {bool(r[0]): r[1] for r in labelled.groupBy(F.col("toxic") == 1).count().collect()}
    n_bad, n_good = counts.get(True, 0), counts.get(False, 0)
    if not n_bad or not n_good:
        return {}
    least = max(LEAST_DOCS, int(LEAST_SHARE * n_bad))
    each = labelled.select("toxic", F.explode(terms(F.coalesce("text", F.lit("")))).alias("term"))
    bad = each.filter("toxic = 1").groupBy("term").agg(F.count("*").alias("bad")).filter(F.col("bad") >= least)
    good = each.filter("toxic = 0").groupBy("term").agg(F.count("*").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.coalesce("good", F.lit(0)) + 0.5) / (n_good + 1))
    found = bad.join(good, "term", "left").select("term", "bad", odds.alias("odds")).filter(F.col("odds") >= LEAST_ODDS)
    top = found.orderBy((F.col("odds") * F.col("bad")).desc(), "term").limit(MOST_TERMS)
    return {r["term"]: r["odds"] for r in top.collect()}


class Marks(dict):
    """What is known of a word as written: flag bits, and above them its weight in hundredths. Bounded."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def odds(self, word: str) -> float:
        get = self.lexicon.get
        return max(get(word, 0.0), *(get(f"{word[:n]}~", 0.0) for n in PREFIXES if len(word) > n), 0.0)

    def __missing__(self, raw: str) -> int:
        word = _EDGE.sub("", raw.lower())
        flags, weight = 0, self.odds(word)
        if weight:
            flags |= HIT
        if word in SECOND_PERSON:
            flags |= SECOND
        if _DRAWN.search(word):
            flags |= DRAWN
        hidden = bool(_INNER.search(raw))
        if hidden:
            flags |= HIDDEN
        if not weight and (hidden or flags & DRAWN):
            plain = re.sub(r"[\W\d_]+", "", raw.lower().translate(_RESTORE))
            weight = max(self.odds(plain), self.odds(_DRAWN.sub(r"\1", plain)))
            if weight:
                flags |= HIDDEN_HIT
        value = flags | int(weight * 100) << 8
        if len(self) < 500_000:
            self[raw] = value
        return value


def text_features(text: str, marks: Marks) -> list[float]:
    words = text.split()
    n = max(1, len(words))
    got = np.fromiter(map(marks.__getitem__, words), dtype=np.int64, count=len(words))
    weights = got >> 8
    hit, second = (got & (HIT | HIDDEN_HIT)) > 0, (got & SECOND) > 0
    near = 0
    if hit.any() and second.any():
        around = np.convolve(second, np.ones(11), "same")[:len(words)] if len(words) >= 11 else np.full(len(words), second.sum())
        near = int((around[hit] > 0).sum())
    letters = max(1, len(text))
    upper = sum(map(str.isupper, words))
    marks_of = text.count
    return [
        hit.sum() / n, np.log1p(hit.sum()), weights.max(initial=0) / 100, weights.sum() / 100 / n ** 0.5, near / n, second.sum() / n,
        upper / n, marks_of("!") / n, sum(map(marks_of, "!?.,;:*#$%&")) / letters, ((got & HIDDEN) > 0).sum() / n,
        ((got & HIDDEN_HIT) > 0).sum() / n, ((got & DRAWN) > 0).sum() / n,
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], text_col: str = "text") -> DataFrame:
    """``docs``, none of whose columns may have the name of a feature, with the columns ``FEATURES``."""
    at = docs.columns.index(text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(lexicon)
        for part in slices(batches, text_col):
            rows = [text_features(t or "", marks) for t in part.column(at).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *FEATURES])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(f, T.DoubleType()) for f in FEATURES)])
    return map_batches(docs, measure, schema)


def held_out(doc: Column) -> Column:
    """The rows that no label is learnt from: CRC-32 of the identifier as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def with_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    score_col: str = "score", most_rows: int = MOST_ROWS,
) -> DataFrame:
    """``docs`` with ``score_col``; ``labels`` has the identifier and 1 for toxic, 0 for not."""
    marks = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter("_id is not null and toxic is not null").filter(~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    )
    marks = stored(marks, "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The sample is bounded by ``most_rows``, whatever the number of labels and however often a labelled row repeats.
    sample = texts.join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).drop("_id")
    sample = stored(sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")), "labelled")
    sample = sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)))
    shares = sample.agg(F.avg("toxic"), F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not shares[1] or not shares[2]:
        return docs.withColumn(score_col, F.lit(float(shares[0] or 0.0)))
    kinds = {(r["part"] > 0, r["toxic"]) for r in sample.select("part", "toxic").distinct().collect()}
    split = len(kinds) == 4
    # What is calibrated on must not have been learnt from, neither by the lexicon nor by the trees.
    lexicon = learn_lexicon(sample.filter("part > 0").drop("part") if split else sample.drop("part"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    fitted = assembler.transform(stored(with_features(sample, lexicon).drop("text").coalesce(4), "features"))
    fold, rest = (fitted.filter("part > 0"), fitted.filter("part = 0")) if split else (fitted, fitted)
    boosting = GBTClassifier(
        featuresCol="_features", labelCol="toxic", predictionCol="_predicted", maxIter=15, maxDepth=3, stepSize=0.2, seed=1,
        minInstancesPerNode=2)
    trees = boosting.setProbabilityCol("_probability").setRawPredictionCol("_raw").fit(fold)

    def chance(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("_chance", vector_to_array("_probability")[1])

    curve = IsotonicRegression(featuresCol="_chance", labelCol="toxic", predictionCol="_score").fit(
        chance(rest).select("_chance", F.col("toxic").cast("double").alias("toxic")))
    rows, names = unnamed(docs)
    scored = curve.transform(chance(assembler.transform(with_features(rows, lexicon, names[text_col]))))
    score = F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0))
    return scored.select(*names.values(), score).toDF(*docs.columns, score_col)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, held_out, score`` of every row of ``docs``."""
    chosen = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    scored = with_scores(chosen, labels, id_col, text_col, label_col, "score", most_rows)
    return scored.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), "score")


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    free = next(name for name in (f"score_{i}" for i in range(len(docs.columns) + 1)) if name not in docs.columns)
    return with_scores(docs, labels, id_col, text_col, score_col=free).filter(F.col(free) < threshold).select(*docs.columns)


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
