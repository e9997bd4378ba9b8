"""Line deduplication within a small edit distance, in DataFrame functions only.

A line of length l is split into ``distance + 1`` segments of nearly equal length. Two lines within the distance share one
segment of the shorter line, at places that length difference and segment number confine; so every different line is put into an
index under its segments, and probes the index with those of its substrings. What meets, and does not differ in the parities of too
many characters' numbers, is verified by a banded bit-parallel edit distance:
a column of the band is a few bits of one integer, and each character moves it by a handful of bit operations.

A line is dropped if it is equal to an earlier line, or within the distance of one (lines are judged on the input, so a
dropped line also drops others). Earlier is by identifier, then place. Where very many lines share a segment they are
compared with the earliest few first; only lines that this does not drop are compared with all earlier ones, and of these only
with lines that also agree in one of a few groups of parities, by which such segments are split.

Defined results: lines end at ``\\n``. Equal lines are found whatever their length; only blank lines of fewer than ``least``
characters stay, as they part paragraphs. The edit distance is for lines of ``least`` characters or more on both sides: in
shorter ones the distance would be too large a part of the line. Null text has no lines. A null identifier is later than
all others. Repeated rows have the same places, none of which is earlier, and are treated alike.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import stored, unnamed

DISTANCE, LEAST = 2, 20
#: Lines that share a segment from which on they are first compared with the earliest ``FIRST`` alone.
MANY, FIRST = 200, 8
#: Size of the bitmap of the lines that pairs need (4 MiB).
BITS = 1 << 25
_PLACE = "decimal(30,0)"


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, at, line, place``: every line with its number and a number that orders all lines."""
    each = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("at", "line"))
    doc = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("decimal(20,0)")
    return each.withColumn("place", (doc * F.lit(1_000_000_000).cast("decimal(10,0)") + F.col("at")).cast(_PLACE))


def with_keys(df: DataFrame, line: str, distance: int = DISTANCE) -> DataFrame:
    """``df`` with ``keys``: the hashes of a line's ``distance + 1`` segments, then of the substrings by which it finds shorter or
    equally long lines, as one array; null where a substring would reach over the line's end.

    Lengths and starts of the segments are laid out in columns first: they are computed once for a line, not once for a key."""
    parts = distance + 1
    totals, numbers = range(distance + 1), range(1, parts + 1)
    laid = df.withColumn("_size", F.char_length(line))
    rest = lambda k: F.pmod(F.col("_size") - k, F.lit(parts))
    laid = laid.withColumns(
        {f"_rest{k}": rest(k) for k in totals} | {f"_short{k}": ((F.col("_size") - k - rest(k)) / parts).cast("int") for k in totals})
    laid = laid.withColumns({
        f"_length{k}_{i}": F.col(f"_short{k}") + (F.lit(i) > parts - F.col(f"_rest{k}")).cast("int") for k in totals for i in numbers
    } | {
        f"_start{k}_{i}": F.lit(i - 1) * F.col(f"_short{k}") + F.greatest(F.lit(0), F.lit(i - 1 - parts) + F.col(f"_rest{k}")) + 1
        for k in totals for i in numbers})

    def key(shorter: int, i: int, move: int = 0) -> Column:
        at, length = F.col(f"_start{shorter}_{i}") + move, F.col(f"_length{shorter}_{i}")
        piece = F.substring(F.col(line), at, length)
        return F.when((at >= 1) & (at + length - 1 <= F.col("_size")), F.xxhash64(F.col("_size") - shorter, F.lit(i), piece))

    found = [key(0, i) for i in numbers]
    for shorter in totals:
        for i in numbers:
            low, high = max(1 - i, shorter - (parts - i)), min(i - 1, shorter + (parts - i))
            found += [key(shorter, i, move) for move in range(low, high + 1)]
    return laid.select(*[F.col(f"`{c}`") for c in df.columns], F.array(*found).alias("keys"))


def letter_parities(line: str) -> Column:
    """One bit for each of 64 kinds of characters: is their number odd? An edit changes the numbers of two kinds at most, so the
    bits of lines within a distance differ in twice as many places at most."""
    # A shift goes by the last six bits of its count.
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return F.aggregate(F.split(F.col(line), ""), zero, lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", one, F.ascii(c))))


def parity_groups(distance: int = DISTANCE) -> list[int]:
    """Masks that deal the parities out to one group more than can differ: near lines agree in one group at least."""
    n = 2 * distance + 1
    masks = [sum(1 << i for i in range(k, 64, n)) for k in range(n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within(a: str, b: str, distance: int = DISTANCE) -> Column:
    """Is the edit distance of the columns ``a`` and ``b`` (more than ``distance`` characters each) at most ``distance``?"""
    k, width = distance, 2 * distance + 1
    full, top = (1 << width) - 1, 1 << width - 1
    pad = f"concat(array_repeat('', {k}), split({a}, ''), array_repeat('', {width + k}))"
    # The band's matches of each character of b, one bit for each diagonal.
    equal = " + ".join(f"if(p[j + {d}] = c, {1 << d}L, 0L)" for d in range(width))
    matches = f"transform(array({pad}), p -> transform(split({b}, ''), (c, j) -> {equal}))[0]"
    d0 = "(((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn) & %d)" % full
    hp, hn = f"((s.vn | ~({d0} | s.vp)) & {full})", f"({d0} & s.vp)"
    # On the band's last diagonal until the last row, then along that row, whose bit moves down by one each time.
    row = f"cast(greatest({width - 2} - (s.j - (s.m - {k})), 0) as int)"
    moved = f"""if(s.j < s.m - {k}, if(({d0} & {top}) = 0, 1, 0),
      cast((shiftright({hp}, {row}) & 1) - (shiftright({hn}, {row}) & 1) as int))"""
    step = f"""named_struct('vp', ({hn} | ~(shiftright({d0}, 1) | {hp})) & {full}, 'vn', shiftright({d0}, 1) & {hp},
      'd', s.d + {moved}, 'j', s.j + 1, 'm', s.m)"""
    begin = f"named_struct('vp', {full ^ ((1 << k) - 1)}L, 'vn', 0L, 'd', {k}, 'j', 0, 'm', char_length({a}))"
    return F.expr(f"aggregate({matches}, {begin}, (s, x) -> {step}, s -> s.d) <= {k}")


def among(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """``rows`` whose ``ref`` may be one of ``refs``: a bitmap of fixed size keeps most others from being shuffled."""
    at = F.pmod(F.col("ref"), F.lit(BITS)) + 1
    word, bit = F.bitmap_bucket_number(at), F.bitmap_bit_position(at)
    bits = refs.groupBy(word.alias("_word")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    found = rows.join(F.broadcast(bits), word == F.col("_word"))  # BITS in all
    byte = F.ascii(F.decode(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    return found.filter(F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1).select(*rows.columns)


def near_earlier(different: DataFrame, every: DataFrame, distance: int = DISTANCE, many: int = MANY) -> DataFrame:
    """``ref, place`` of lines that are near an earlier one.

    ``different`` has each line once (``ref``, its hash, ``place``, ``letters`` and ``keys``), ``every`` all lines with their text.
    """
    parts = distance + 1
    index = different.select("ref", "letters", F.explode(F.slice("keys", 1, parts)).alias("key")).filter("key is not null")
    probes = different.select("ref", "letters", F.explode(F.slice("keys", parts + 1, 1 << 20)).alias("key")).filter("key is not null")
    hot = stored(index.groupBy("key").count().filter(F.col("count") > many).select("key"), "hot")
    some_hot = not hot.isEmpty()

    def verified(pairs: DataFrame) -> DataFrame:
        """The later lines of the pairs of refs that are within the distance."""
        pairs = stored(pairs.filter("ref_a <> ref_b").select(
            F.least("ref_a", "ref_b").alias("ref_a"), F.greatest("ref_a", "ref_b").alias("ref_b")).distinct(), "pairs")
        needed = pairs.select(F.col("ref_a").alias("ref")).union(pairs.select("ref_b")).distinct()
        # Not a semi join: Spark would push it below the bitmap's.
        texts = among(every.withColumn("ref", F.xxhash64("line")), needed).join(needed, "ref")
        texts = stored(texts.groupBy("line").agg(F.min("place").alias("place"), F.first("ref").alias("ref")), "texts")
        side = lambda x: texts.select(F.col("ref").alias(f"ref_{x}"), F.col("place").alias(f"place_{x}"), F.col("line").alias(x))
        both = pairs.join(side("a"), "ref_a").join(side("b"), "ref_b")
        close = both.filter(F.abs(F.char_length("a") - F.char_length("b")) <= distance).filter(within("a", "b", distance))
        later = F.when(F.col("place_a") > F.col("place_b"), F.struct(F.col("ref_a").alias("ref"), F.col("place_a").alias("place")))
        later = later.otherwise(F.struct(F.col("ref_b").alias("ref"), F.col("place_b").alias("place")))
        return close.select(later.alias("l")).select("l.*").distinct()

    alike = F.bit_count(F.col("letters_a").bitwiseXOR(F.col("letters_b"))) <= 2 * distance

    def cold(rows: DataFrame) -> DataFrame:
        return rows.join(hot, "key", "left_anti") if some_hot else rows

    met = cold(index).withColumnsRenamed({"ref": "ref_a", "letters": "letters_a"}).join(
        cold(probes).withColumnsRenamed({"ref": "ref_b", "letters": "letters_b"}), "key")
    pairs = met.filter((F.col("ref_a") != F.col("ref_b")) & alike).select("ref_a", "ref_b")
    if not some_hot:
        return stored(verified(pairs), "near")
    place = different.select("ref", "place")
    lots = index.withColumn("probes", F.lit(False)).unionByName(probes.withColumn("probes", F.lit(True)))
    lots = stored(lots.join(hot, "key", "left_semi").join(place, "ref"), "lots")

    def meeting(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        """Pairs of an earlier and a later line of which one probes the other's segment."""
        a, b = left.toDF(*[f"{c}_a" for c in left.columns]), right.toDF(*[f"{c}_b" for c in right.columns])
        same = functools.reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in ("key", *on)])
        return a.join(b, same & F.expr("place_a < place_b and probes_a <> probes_b") & alike).select("ref_a", "ref_b")

    def split(rows: DataFrame) -> DataFrame:
        """The rows once for each group of parities, with the group's bits."""
        groups = [F.struct(F.lit(i).alias("group"), F.col("letters").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(parity_groups(distance))]
        return rows.withColumn("g", F.explode(F.array(*groups))).select("*", "g.group", "g.bits").drop("g")

    order = Window.partitionBy("key", "probes").orderBy("place")
    first = lots.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= FIRST).drop("_nth")
    near = stored(verified(pairs.unionByName(meeting(first, lots))), "near")
    rest = lots.join(near, ["ref", "place"], "left_anti").select(*lots.columns)
    return stored(near.unionByName(verified(meeting(split(lots), split(rest), "group", "bits"))).distinct(), "near")


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, least: int = LEAST,
                many: int = MANY) -> DataFrame:
    """``doc_id, at, chars, dropped`` for every line: ``dropped`` is null, 'equal' or 'near'."""
    every = lines_of(docs, id_col, text_col)
    long = F.char_length("line") >= least
    compared = long | F.col("line").rlike(r"[^\x20\x09-\x0D]")
    different = every.filter(compared).groupBy("line").agg(F.min("place").alias("place"))
    different = stored(with_keys(different, "line", distance).select(
        F.xxhash64("line").alias("ref"), "place", F.md5(F.col("line").cast("binary")).alias("digest"), long.alias("long"),
        F.when(long, letter_parities("line")).alias("letters"), F.when(long, F.col("keys")).alias("keys")), "lines")
    near = near_earlier(different.filter("long"), every.filter(long), distance, many).withColumn("near", F.lit(True))
    firsts = different.select("ref", "digest", "place").join(near, ["ref", "place"], "left").select(
        "digest", F.col("place").alias("first"), "near")
    narrow = every.select(
        "doc_id", "at", "place", F.char_length("line").alias("chars"),
        F.when(compared, F.md5(F.col("line").cast("binary"))).alias("digest"))
    return narrow.join(firsts, "digest", "left").select(
        "doc_id", "at", "chars",
        F.when(F.col("place") > F.col("first"), "equal").when(F.col("near"), "near").alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, least: int = LEAST) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text_col``."""
    lost = judge_lines(docs, id_col, text_col, distance, least).filter("dropped is not null")
    lost = lost.groupBy("doc_id").agg(F.collect_set("at").alias("lost"))
    rows, names = unnamed(docs)
    text = names[text_col]
    kept = F.array_join(F.filter(
        F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.coalesce("lost", F.array().cast("array<int>")), i)), "\n")
    joined = rows.join(lost, F.col(names[id_col]).cast("long").eqNullSafe(F.col("doc_id")), "left")
    return joined.select(*[kept.alias(c) if c == text else F.col(c) for c in names.values()]).toDF(*docs.columns)


@register("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = judge_lines(docs).groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if(F.col("dropped") == "equal").alias("n_equal"),
        F.count_if(F.col("dropped") == "near").alias("n_near"),
        F.coalesce(F.sum(F.when(F.col("dropped").isNull(), F.col("chars"))), F.lit(0)).cast("long").alias("kept_chars"))
    ids = docs.select(F.col("doc_id").alias("_id")).distinct()
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return ids.join(judged, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("_id").alias("doc_id"), count("n_lines"), count("n_equal"), count("n_near"), count("kept_chars"))
