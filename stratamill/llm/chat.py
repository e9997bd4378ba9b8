"""Chat formatting in budgeted windows, in DataFrame functions only.

Each turn costs its words and its marks. The fresh budget of a conversation is what its system turn and the history leave.
Prefix sums of the costs choose the windows: turns of at most half the fresh budget share a window by the half their
start falls into, so that a window's own turns never exceed the fresh budget; longer turns stand alone. A window begins
with the conversation's system turn and a stretch of the turns before it, as long as the history's limit and the rest of the
budget allow; both are repeats, and only the window's own assistant turns lie under the loss mask, so each is trained on
once. A window exceeds the budget only where the system turn and one turn alone do, as turns are not cut.

A turn is written ``<turn>role<says>text</turn>``. A backslash or ``<`` within role or text is escaped, so control
strings of this or any other template that begin with ``<`` cannot be forged, and the text can be read back exactly.

Defined results: null role or text is empty. Turns are ordered by number (nulls first), then role, then text; repeated rows are turns
of their own. A null conversation identifier is one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import WORDS

#: Tokens (words and marks) of a window, of which so many are for history; the system turn is part of the budget too.
BUDGET, HISTORY = 1024, 128
#: Tokens that a turn's marks take.
MARKS = 4

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"


def escaped(text: Column) -> Column:
    """``text`` without ``<``; every backslash in the result is followed by 0 (backslash) or 1 (``<``)."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per window: ``conv_id, window, text, fresh_from`` (code points of ``text`` that are repeats) and ``loss``,
    the spans of ``text`` (start, end) to train on."""
    df = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("said"))
    df = df.withColumn("cost", F.regexp_count("said", F.lit(WORDS)) + MARKS)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        "at": F.row_number().over(order),
        "start": F.coalesce(F.sum("cost").over(before), F.lit(0)),
        "head": F.first(F.when(F.col("role") == "system", F.col("cost")).otherwise(0)).over(order),
    })
    df = df.withColumn("half", F.greatest(F.floor((F.lit(budget - history) - F.col("head")) / 2), F.lit(1)))
    df = df.withColumn("long", F.col("cost") > F.col("half"))
    by_place = Window.partitionBy("conv_id").orderBy("at")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        # Long turns break the row of shared windows; starts are counted over the short turns alone.
        "stretch": F.coalesce(F.sum(F.col("long").cast("int")).over(before), F.lit(0)),
        "part": F.floor(F.coalesce(F.sum(F.when(F.col("long"), 0).otherwise(F.col("cost"))).over(before), F.lit(0)) / F.col("half")),
    })
    by_start = Window.partitionBy("conv_id").orderBy("start")
    last = F.struct("stretch", "part", "long")
    df = df.withColumn("first", F.coalesce(F.lag(last).over(by_place) != last, F.lit(True)))
    df = df.withColumn("window", F.sum(F.col("first").cast("int")).over(by_place) - 1)
    own = F.sum("cost").over(Window.partitionBy("conv_id", "window"))
    df = df.withColumn("limit", F.least(F.lit(history), F.lit(budget) - F.col("head") - own))
    # A turn is history of the windows that begin within so many tokens after its start, as far as their own limits go.
    opened = F.when(F.col("first"), F.struct("window", "start", "limit"))
    later = F.collect_set(opened).over(by_start.rangeBetween(1, history))
    df = df.withColumn("later", F.transform(
        F.filter(later, lambda w: (w["window"] > F.col("window")) & (w["start"] - F.col("start") <= w["limit"])), lambda w: w["window"]))
    system = df.filter((F.col("at") == 1) & (F.col("role") == "system"))
    heads = system.select("conv_id", "role", "said", F.col("window").alias("own_window"))
    starts = df.filter("first").select("conv_id", "window")
    rows = df.select(
        "conv_id", "at", "role", "said",
        F.inline(F.concat(F.array(F.struct(F.col("window"), F.lit(True).alias("fresh"))),
                          F.transform("later", lambda w: F.struct(w.alias("window"), F.lit(False).alias("fresh"))))))
    # The system turn comes through the join below, not as history.
    rows = rows.filter("fresh or not (at = 1 and role = 'system')")
    h = heads.alias("h")
    repeated = starts.alias("s").join(
        h, F.col("s.conv_id").eqNullSafe(F.col("h.conv_id")) & (F.col("s.window") > F.col("h.own_window"))
    ).select("s.conv_id", F.lit(1).alias("at"), "h.role", "h.said", "s.window", F.lit(False).alias("fresh"))
    rows = rows.unionByName(repeated)
    role, said = escaped(F.col("role")), escaped(F.col("said"))
    head = F.concat(F.lit(OPEN), role, F.lit(SAYS))
    rows = rows.select(
        "conv_id", "window", "at", "fresh", F.concat(head, said, F.lit(CLOSE)).alias("piece"),
        F.char_length(head).alias("lead"), F.char_length(said).alias("size"),
        (F.col("fresh") & (F.col("role") == "assistant")).alias("target"))
    turn_list = F.array_sort(F.collect_list(F.struct("at", "piece", "lead", "size", "fresh", "target")))
    packed = rows.groupBy("conv_id", "window").agg(turn_list.alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(a: Column, p: Column) -> Column:
        start = a["at"] + p["lead"]
        span = F.struct(start.cast("long").alias("start"), (start + p["size"]).cast("long").alias("end"))
        return F.struct(
            (a["at"] + F.char_length(p["piece"])).cast("long").alias("at"),
            F.when(p["target"], F.array_append(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    old = F.filter("parts", lambda p: ~p["fresh"])
    return packed.select(
        "conv_id", F.col("window").cast("long").alias("window"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"),
        F.coalesce(F.char_length(F.array_join(F.transform(old, lambda p: p["piece"]), "")), F.lit(0)).cast("long").alias("fresh_from"),
        F.aggregate("parts", zero, add, lambda a: a["spans"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation ``turns`` (array of role and said, each turn once) and ``loss`` (the text under the mask)."""
    # Every turn is written as OPEN role SAYS text CLOSE, and "<" stands nowhere else.
    own = F.split(F.expr("substring(text, cast(fresh_from as int) + 1)"), CLOSE)
    turns = F.transform(F.filter(own, lambda t: t != ""), lambda t: F.struct(
        unescaped(F.substring_index(F.substring(t, len(OPEN) + 1, 1 << 30), SAYS, 1)).alias("role"),
        unescaped(F.substring_index(t, SAYS, -1)).alias("said")))
    masked = F.transform("loss", lambda s: F.call_function(
        "substring", F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    each = formatted.select(
        "conv_id", F.struct("window", turns.alias("turns"), unescaped(F.array_join(masked, "")).alias("loss"),
                            F.char_length("text").alias("chars")).alias("w"))
    gathered = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return gathered.select(
        "conv_id", F.flatten(F.col("w.turns")).alias("turns"), F.array_join(F.col("w.loss"), "").alias("loss"),
        F.aggregate("w.chars", F.lit(0).cast("long"), lambda a, c: a + c).alias("formatted_chars"))


OP7_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, 19 + length(replace(replace(role, '\\', '\\0'), '<', '\\1')) + length(replace(replace(said, '\\', '\\0'), '<', '\\1')) AS chars,
    len(regexp_extract_all(said, '[^\\x20\\x09-\\x0D]+')) + 4 AS cost, row_number() OVER t AS place
  FROM c WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, said)
), h AS (
  SELECT *, first_value(CASE WHEN role = 'system' THEN cost ELSE 0 END) OVER o AS head,
    greatest((1024 - 128 - first_value(CASE WHEN role = 'system' THEN cost ELSE 0 END) OVER o) // 2, 1) AS half
  FROM e WINDOW o AS (PARTITION BY conv_id ORDER BY place)
), s AS (
  SELECT *, sum(cost) OVER o - cost AS start, sum((cost > half)::INT) OVER o - (cost > half)::INT AS stretch,
    (sum(CASE WHEN cost > half THEN 0 ELSE cost END) OVER o - CASE WHEN cost > half THEN 0 ELSE cost END) // half AS part
  FROM h WINDOW o AS (PARTITION BY conv_id ORDER BY place)
), f AS (
  SELECT *, coalesce((lag(stretch) OVER o, lag(part) OVER o, lag(cost > half) OVER o) <> (stretch, part, cost > half), true)
    OR place = 1 AS opens FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY place)
), n AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY place) - 1 AS win FROM f),
w AS (SELECT *, sum(cost) OVER (PARTITION BY conv_id, win) AS own FROM n),
repeats AS (
  SELECT b.conv_id, sum(a.chars) AS chars FROM w b JOIN w a ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.win < b.win
    AND (a.start >= b.start - least(128, 1024 - b.head - b.own) OR a.place = 1 AND a.role = 'system')
  WHERE b.opens GROUP BY b.conv_id
), own AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(said, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM w GROUP BY conv_id
)
SELECT own.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  (own.chars + coalesce(repeats.chars, 0))::BIGINT AS formatted_chars
FROM own LEFT JOIN repeats ON own.conv_id IS NOT DISTINCT FROM repeats.conv_id
"""


@register("op7_chat_windows", OP7_SQL)
def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    forged = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", forged), (-1, 1, "assistant", forged)], "conv_id long, turn long, role string, text string")
    back = read_back(windows(told.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["said"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
