"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule compares one rate of a document with a cutoff of its stratum. Labelled documents are split in two. One half
proposes joint cutoffs of all rules (high quantiles of the good documents' rates, without the rules that do more harm than
good there) and orders them by the good documents they lose, the fewest first. The other half, the holdout, certifies them in
this order (fixed-sequence testing): one is certified when the exact binomial test rejects "the rules together lose more than
the allowed share of good documents", and the first that is not ends the sequence, so no test needs a correction for the ones
before; the risk is divided by the number of strata only. Of the certified joint cutoffs the one that turns away most more bad than
good documents in the proposing half is used; a stratum without one rejects nothing.

Defined results: null text has no words and fails the base rule. Rows are judged each, repeated rows too; labels that
are null or whose document is missing are not used, of repeated labels the lowest counts. A null stratum is a stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import stored

#: Largest share of good documents that the rules may reject per stratum, and the chance of exceeding it.
MOST_LOST, RISK = 0.05, 0.05
#: Quantiles of the good documents' rates that are proposed as cutoffs.
QUANTILES = (0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 1.0)
#: Rule name -> rate, over the columns of ``features``; larger is worse.
RULES = {
    "symbols": "n_symbols / n_words",
    "long_words": "word_chars / n_words",
    "repeated_words": "n_repeat_words / n_words",
    "repeated_lines": "n_dup_lines / n_lines",
    "capitals": "n_capitals / word_chars",
    "exclamations": "n_exclamations / n_words",
}

_SPACE = r"[\\x20\\x09-\\x0D]+"
# Lambda variables hold what is computed once per text: its words, its windows' hashes, and those sorted.
_WORDS = f"""transform(array(array_remove(split(_text, '{_SPACE}'), '')), w -> named_struct(
  'n_words', size(w),
  'windows', if(size(w) < 5, cast(array() as array<bigint>),
                transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])))))[0]"""
# Places of windows that occur twice or more, then the words they cover: a window adds what the one before left.
_REPEATED = """transform(array(_words.windows), h -> if(size(array_distinct(h)) = size(h), 0,
  transform(array(array_sort(transform(h, (x, i) -> struct(x as x, i as i)))), p ->
    aggregate(
      array_sort(transform(
        filter(transform(p, (e, k) -> struct(e.i as i,
                 (k > 0 and p[greatest(k - 1, 0)].x = e.x) or (k < size(p) - 1 and p[least(k + 1, size(p) - 1)].x = e.x) as again)),
               e -> e.again), e -> e.i)),
      struct(0 as covered, -5 as last),
      (a, s) -> struct(a.covered + least(5, s - a.last) as covered, s as last),
      a -> a.covered))[0]))[0]"""


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts of every document: ``doc_id, stratum`` and the columns the rules use."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("_text"))
    df = df.withColumn("_words", F.expr(_WORDS))
    lines = F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')")
    chars = F.translate("_text", " \t\n\x0b\x0c\r", "")
    return df.select(
        "doc_id", "stratum",
        F.col("_words.n_words").cast("long").alias("n_words"),
        F.char_length(chars).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.expr(r"""transform(array(filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')),
                   l -> size(l) - size(array_distinct(l)))[0]""").cast("long").alias("n_dup_lines"),
        F.expr(_REPEATED).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        (F.char_length("_text") - F.char_length(F.translate("_text", "!", ""))).cast("long").alias("n_exclamations"),
    )


def _rates() -> Column:
    """The rules as an array of (rule, rate); a rate without a denominator is 0."""
    each = []
    for rule, rate in RULES.items():
        top, bottom = rate.split(" / ")
        value = F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)
        each.append(F.struct(F.lit(rule).alias("rule"), value.alias("rate")))
    return F.array(*each)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed from the logarithms of its terms; 1 where k is beyond the mean."""
    n = n.cast("double")
    start = F.struct((n * F.log1p(F.lit(-p))).alias("term"), F.exp(n * F.log1p(F.lit(-p))).alias("sum"))

    def add(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j * F.lit(p / (1 - p)))
        return F.struct(term.alias("term"), (a["sum"] + F.exp(term)).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, 1.0).otherwise(F.aggregate(steps, start, add, lambda a: a["sum"]))


def certified_cutoffs(
    labelled: DataFrame, most_lost: float = MOST_LOST, risk: float = RISK, quantiles: tuple[float, ...] = QUANTILES,
) -> DataFrame:
    """Per stratum and rule the chosen cutoff with the counts of the stratum's rules together; ``labelled`` has ``features`` and ``good`` (boolean)."""
    rules = list(RULES)
    rated = labelled.select(
        "stratum", "good", (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 1).alias("held_out"),
        F.transform(_rates(), lambda r: r["rate"]).alias("rates"))
    each = [F.percentile_approx(F.col("rates")[i], list(quantiles), 10_000) for i in range(len(rules))]
    proposed = rated.filter("good and not held_out").groupBy("stratum").agg(F.arrays_zip(*[
        e.alias(f"r{i}") for i, e in enumerate(each)]).alias("joint"))
    proposed = proposed.select(
        F.col("stratum").alias("_stratum"), F.posexplode("joint").alias("_nth", "joint")).select(
        "_stratum", "_nth", F.array(*[F.col("joint")[f"r{i}"] for i in range(len(rules))]).alias("cuts"))

    def met(rows: DataFrame, cuts: DataFrame) -> DataFrame:
        # Broadcast by Spark as long as the cutoffs, a few rows a stratum, are few.
        return rows.join(cuts, F.col("stratum").eqNullSafe(F.col("_stratum")))

    # A rule stays in a joint cutoff if it turns away more bad than good documents of the proposing half by itself.
    alone = met(rated.filter("not held_out"), proposed).groupBy("_stratum", "_nth", "cuts").agg(F.array(*[
        F.sum(F.when(F.col("rates")[i] > F.col("cuts")[i], F.when(F.col("good"), -1).otherwise(1)).otherwise(0))
        for i in range(len(rules))]).alias("gains"))
    joint = stored(alone.select(
        "_stratum", "_nth", F.transform("cuts", lambda c, i: F.when(F.get("gains", i) > 0, c)).alias("cuts")
    ).filter(F.exists("cuts", lambda c: c.isNotNull())), "joint")  # a few rows per stratum
    # A cutoff that is null rejects nothing.
    rejected = F.exists(F.arrays_zip("rates", "cuts"), lambda x: F.coalesce(x["rates"] > x["cuts"], F.lit(False)))
    tested = met(rated, joint).withColumn("rejected", rejected).groupBy("stratum", "_nth", "cuts").agg(
        F.count_if(F.expr("good and held_out")).alias("n_good"),
        F.count_if(F.expr("good and held_out and rejected")).alias("n_lost"),
        F.count_if(F.expr("good and not held_out and rejected")).alias("cost"),
        F.count_if(F.expr("not good and not held_out and rejected")).alias("caught"),
    )
    level = risk / max(1, joint.select("_stratum").distinct().count())
    order = Window.partitionBy("stratum").orderBy("cost", F.desc("_nth"))
    passed = tested.withColumn("p_value", binomial_tail(F.col("n_lost"), F.col("n_good"), most_lost))
    passed = passed.withColumn("certified", F.min(F.col("p_value") <= level).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max(F.struct((F.col("caught") - F.col("cost")).alias("gain"), "_nth", "cuts", "n_good", "n_lost", "p_value")).alias("best")
    chosen = passed.filter(F.col("certified") & (F.col("caught") > F.col("cost"))).groupBy("stratum").agg(best)
    named = F.arrays_zip(F.array(*map(F.lit, rules)).alias("rule"), F.col("best.cuts").alias("cutoff"))
    return chosen.select("stratum", "best.gain", F.inline(named), "best.n_good", "best.n_lost", "best.p_value").toDF(
        "stratum", "gain", "rule", "cutoff", "n_good", "n_lost", "p_value").filter("cutoff is not null").select(
        "stratum", "rule", "gain", "cutoff", "n_good", "n_lost", "p_value")


def judge(feats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``feats`` with ``base_failed`` and ``kept``."""
    wide = cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    joined = feats.join(wide.withColumnRenamed("stratum", "_stratum"), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rates = {r: (top, bottom) for r, rate in RULES.items() for top, bottom in [rate.split(" / ")]}
    rejected = F.lit(False)
    for rule, (top, bottom) in rates.items():
        over = F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0) > F.col(f"cut_{rule}")
        rejected = rejected | F.coalesce(over, F.lit(False))
    return joined.select(*[feats[c] for c in feats.columns], failed.alias("base_failed"), (~failed & ~rejected).alias("kept"))


def judge_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    label_col: str = "quality", most_lost: float = MOST_LOST, risk: float = RISK,
) -> DataFrame:
    """Every document's counts, ``base_failed`` and ``kept``; ``labels`` has the identifier and 1 for good, 0 for bad."""
    feats = stored(features(docs, id_col, text_col, stratum_col), "quality")
    marks = (
        labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg((F.min(label_col) == 1).alias("good"))
    )
    labelled = feats.join(marks, feats["doc_id"] == marks["_id"]).drop("_id")
    return judge(feats, stored(certified_cutoffs(labelled, most_lost, risk), "cutoffs"))


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
