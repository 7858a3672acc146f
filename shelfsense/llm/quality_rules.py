"""Quality rules with adaptive thresholds, in DataFrame and SQL functions only.

Every document gets integer measures of its whole text. Per language and
source, a quantile sketch of each measure gives the fence beyond which a
document is rejected, so a source with long words or many symbols is judged
by its own habits instead of one fixed cutoff.

The sketch is a histogram over log-linear buckets: a value keeps its seven top
bits, so a bucket is at most 1/64 of its value wide and 64 bit lengths bound the
number of buckets whatever the number of rows. Sketches merge by adding
counts: partial sums in every task before the shuffle (a hot source is one row
per bucket and task). Every group has a sketch of its own, merged with its language's one scaled to
``PRIOR_ROWS`` rows, which in turn is merged with that of all rows in the same way. So a source of few
documents is judged nearly as its language is, a large one by itself, and nothing
switches at some size. The result does not depend on the order or partitioning of the rows.

Fence of measure m: ``q75 + SPREAD * (q75 - q25) + slack``; the mean word
length also has a lower one, ``q25 - SPREAD * (q75 - q25) - slack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import materialise

#: Rows that the sketch of the level above counts as in a group's own; counts are kept in parts of 1 / ``SCALE``.
PRIOR_ROWS, SCALE = 50, 100
SPREAD = 3
#: Measure -> slack in its unit: per mille of word characters, of lines, of words, of word characters; tenths of a character.
SLACK = {"symbols": 30, "dup_lines": 500, "repeats": 500, "capitals": 200, "word_length": 20}
TWO_SIDED = ("word_length",)
#: Sketch tables of up to so many (language, source) groups are broadcast; larger ones are joined by shuffle.
BROADCAST_GROUPS = 20_000

BLANKS = " \\u0009\\u000A\\u000B\\u000C\\u000D"  # as escapes of SQL text
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#*$%&|<>"

# Lambda variables bind each array once: w = words, h = hashes of its 3-word windows,
# s = (hash, position) sorted, d = sorted starts of windows found twice or more.
_REPEATED = """
get(transform(array(w), w ->
  get(transform(array(if(size(w) < 3, array(), transform(sequence(0, size(w) - 3),
      i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))), h ->
    if(size(array_distinct(h)) = size(h), 0L,
      get(transform(array(sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))), s ->
        get(transform(array(sort_array(filter(transform(s, (e, j) ->
            if(e.x <=> get(s, j + 1).x OR (j > 0 AND e.x <=> get(s, j - 1).x), e.i, -1)), p -> p >= 0))), d ->
          aggregate(transform(d, (p, j) -> cast(least(3, coalesce(get(d, j + 1), p + 3) - p) AS bigint)),
                    0L, (a, b) -> a + b)), 0)), 0))), 0)), 0)
"""


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Counts of every whole text; null or empty texts have zeros throughout.

    Words are runs of anything but ASCII white space, kept as they are. All
    lists stay inside their row; nothing is exploded or shuffled.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(source_col).cast("string").alias("source"), t.alias("t"))
    blanks = "'" + BLANKS + "'"
    solid = d.select("*", F.expr(f"translate(t, {blanks}, '')").alias("solid"),
                     F.expr("array_remove(split(t, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), '')").alias("w"),
                     F.expr(f"filter(split(t, '\\n'), x -> translate(x, {blanks}, '') != '')").alias("lines"))
    return solid.select(
        "doc_id", "lang", "source",
        F.expr("cast(size(w) AS bigint)").alias("n_words"),
        F.expr("cast(char_length(solid) AS bigint)").alias("word_chars"),
        F.expr(f"cast(char_length(solid) - char_length(translate(solid, '{SYMBOLS}', '')) AS bigint)").alias("n_symbols"),
        F.expr("cast(size(lines) AS bigint)").alias("n_lines"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) AS bigint)").alias("n_dup_lines"),
        F.expr(_REPEATED).alias("n_repeat_words"),
        F.expr(f"cast(char_length(solid) - char_length(translate(solid, '{CAPITALS}', '')) AS bigint)").alias("n_capitals"),
    ).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


#: Integer values of the rules (numerator, denominator, scale).
RATIOS = {"symbols": ("n_symbols", "word_chars", 1000), "dup_lines": ("n_dup_lines", "n_lines", 1000),
          "repeats": ("n_repeat_words", "n_words", 1000), "capitals": ("n_capitals", "word_chars", 1000),
          "word_length": ("word_chars", "n_words", 10)}


def ratio_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({f"r_{m}": F.expr(f"{scale} * {a} DIV greatest({b}, 1)") for m, (a, b, scale) in RATIOS.items()})


def bucket(value: str) -> str:
    """SQL of a value's sketch bucket: its seven top bits."""
    return f"if({value} < 128, {value}, {value} - {value} % shiftleft(1L, length(bin({value})) - 7))"


def fences(rated: DataFrame) -> DataFrame:
    """Per (lang, source): one fence column per rule, from the merged sketches."""
    pairs = ", ".join(f"'{m}', r_{m}" for m in SLACK)
    long = rated.select("lang", "source", F.expr(f"stack({len(SLACK)}, {pairs}) AS (rule, v)"))
    sketch = long.groupBy("lang", "source", "rule", F.expr(bucket("v")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sketch = materialise(sketch, "sketch")
    whole = sketch.groupBy("rule", "b").agg((SCALE * F.sum("n")).alias("n"))
    by_lang = _merged(sketch.groupBy("lang", "rule", "b").agg(F.sum("n").alias("n")), ["lang"], whole, [])
    merged = _merged(sketch, ["lang", "source"], materialise(by_lang, "sketch-lang"), ["lang"])
    # A group's buckets are bounded in number, so these windows are too.
    from pyspark.sql import Window
    own = Window.partitionBy("lang", "source", "rule")
    ranked = merged.select("*", F.sum("n").over(own.orderBy("b")).alias("c"), F.sum("n").over(own).alias("total"))
    q = ranked.groupBy("lang", "source", "rule").agg(
        F.min(F.expr("CASE WHEN 4 * c >= total THEN b END")).alias("q25"),
        F.min(F.expr("CASE WHEN 4 * c >= 3 * total THEN b END")).alias("q75"))
    slack = F.expr("CASE rule " + " ".join(f"WHEN '{m}' THEN {s}" for m, s in SLACK.items()) + " END")
    q = q.withColumn("hi", F.expr(f"q75 + {SPREAD} * (q75 - q25)") + slack).withColumn(
        "lo", F.expr(f"q25 - {SPREAD} * (q75 - q25)") - slack)
    return q.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == m, F.col("hi"))).alias(f"hi_{m}") for m in SLACK],
        *[F.max(F.when(F.col("rule") == m, F.col("lo"))).alias(f"lo_{m}") for m in TWO_SIDED])


def _merged(own: DataFrame, keys: list[str], above: DataFrame, above_keys: list[str]) -> DataFrame:
    """Sketches of ``keys`` with ``PRIOR_ROWS`` rows of the level above in the same proportions as there.

    ``own`` counts rows, ``above`` and the result parts of 1 / ``SCALE``. Every group gets a
    row per bucket of its level above, and those are bounded in number.
    """
    total = above.groupBy(*above_keys, "rule").agg(F.sum("n").alias("total"))
    same = lambda a, b, names: F.expr(" AND ".join(f"{a}.{c} <=> {b}.{c}" for c in names))
    share = above.alias("a").join(total.alias("t"), same("a", "t", [*above_keys, "rule"])).select(
        "a.*", F.expr(f"{SCALE * PRIOR_ROWS} * a.n DIV t.total").alias("prior")).drop("n")
    groups = own.select(*keys, "rule").distinct()
    prior = groups.alias("g").join(share.alias("s"), same("g", "s", [*above_keys, "rule"])).select(
        *[f"g.{c}" for c in [*keys, "rule"]], "s.b", F.col("s.prior").alias("n"))
    return (own.select(*keys, "rule", "b", (SCALE * F.col("n")).alias("n")).unionAll(prior)
            .groupBy(*keys, "rule", "b").agg(F.sum("n").alias("n")))


def quality_rules(docs: DataFrame, **columns: str) -> DataFrame:
    """One row per row of ``docs``: its measures, ``base_failed``, the rules broken, ``kept``.

    Null texts count as empty (and fail the base rule); null languages and
    sources are groups of their own; repeated rows are judged one by one and
    all count in the sketches. An empty table gives an empty result. Columns
    beyond id, text, language and source are not read.
    """
    rated = ratio_columns(materialise(measures(docs, **columns), "measures"))
    limit = materialise(fences(rated), "fences")
    r, f = rated.alias("r"), limit.alias("f")
    if limit.count() <= BROADCAST_GROUPS:
        f = F.broadcast(f)
    joined = r.join(f, F.expr("r.lang <=> f.lang AND r.source <=> f.source"), "left")
    broken = [F.when(F.col(f"r_{m}") > F.col(f"hi_{m}"), F.lit(f"high_{m}")) for m in SLACK]
    broken += [F.when(F.col(f"r_{m}") < F.col(f"lo_{m}"), F.lit(f"low_{m}")) for m in TWO_SIDED]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.array_compact(F.array(*broken)).alias("broken"),
    ).select("*", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "broken").alias("broken"))
