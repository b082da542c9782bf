"""Mixing sources to target weights by iterative proportional fitting. Native only.

Tokens are summed per cell (source, language, topic). The cells' weights are raked:
scaled to the source targets, then to the language targets, then to the topic
targets, ROUNDS times over; ``marginals`` tells what error is left. The sample holds
BUDGET times the tokens of the input: a cell that the targets ask for less than it has
is drawn from, one that they ask for more is repeated, at most MAX_COPIES times. No
cell's shortage shrinks the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.batches import unused
from adloom.operators.joins import lookup_join
from adloom.storage import materialize

ROUNDS = 25
# Targets not given are the observed shares to this power, scaled to 1.
TEMPER = 0.7
# Tokens of the sample per token of the input.
BUDGET = 1.0
# A document stands in the sample at most so often.
MAX_COPIES = 16
LANG_TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
DIMENSIONS = ("source", "lang", "topic")
# Up to so many cells are raked in one partition, which spares every exchange.
CELLS_TOGETHER = 100_000
NO_VALUE = "(none)"
# The first rule that holds names the topic; the table has no such column.
TOPICS = [
    ("listing", "text LIKE '%|%'"),
    ("legal", "lower(text) LIKE '%licen%' OR lower(text) LIKE '%rights reserved%'"),
    ("shouting", "text LIKE '%!!%'"),
    ("brief", "length(text) < 800"),
]
OTHER_TOPIC = "prose"


def topic_sql() -> str:
    rules = " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in TOPICS)
    return f"CASE WHEN text IS NULL THEN '{NO_VALUE}' {rules} ELSE '{OTHER_TOPIC}' END"


def tokens(text: Column) -> Column:
    """Words between ASCII spaces; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def draw(id_col: Column) -> Column:
    """A number in [0, 1) that depends on the id alone; the same on every run."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _with_targets(cells: DataFrame, dimension: str, given: dict[str, float] | None) -> DataFrame:
    """Adds target_<dimension>: the share of all tokens this value shall get.

    Values without a given share, null's group among them, keep their tempered observed
    shares of the whole; the given shares divide what these leave."""
    totals = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("_n")).where("_n > 0")
    pairs = [x for name, share in (given or {}).items() for x in (F.lit(name), F.lit(float(share)))]
    listed = F.create_map(*pairs)[F.col(dimension)] if pairs else F.lit(None).cast("double")
    totals = totals.withColumns({"_t": F.pow("_n", F.lit(TEMPER)), "_g": listed})
    open_ = F.sum(F.when(F.col("_g").isNull(), F.col("_t")).otherwise(0.0))
    whole = totals.agg(F.sum("_t").alias("_all"), open_.alias("_open"), F.coalesce(F.sum("_g"), F.lit(0.0)).alias("_given"))
    # Where all given shares are 0 the others divide the whole.
    left = F.when(F.col("_given") > 0, F.col("_all") - F.col("_open")).otherwise(0.0)
    share = F.coalesce(F.when(F.col("_given") > 0, F.col("_g") / F.col("_given")).otherwise(F.col("_g")) * left, F.col("_t"))
    scale = F.when(F.col("_given") > 0, F.col("_all")).otherwise(F.col("_open"))
    shares = totals.join(F.broadcast(whole)).select(dimension, (share / scale).alias(f"target_{dimension}"))
    return cells.join(shares, dimension, "left")


def rake(cells: DataFrame, targets: dict[str, dict[str, float] | None], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, the raked share of each, and
    the targets. A weight stops where its cell would be repeated MAX_COPIES times.

    Cells without tokens get null. A value whose target is given as 0, or all of whose
    cells are forced to 0 by another target, has weight 0.
    """
    for dimension in DIMENSIONS:
        cells = _with_targets(cells, dimension, targets.get(dimension))
    cells = materialize(cells, "cells")
    if cells.count() <= CELLS_TOGETHER:
        cells = cells.coalesce(1)
    most = F.col("tokens") * F.lit(MAX_COPIES / BUDGET) / F.sum("tokens").over(Window.partitionBy())
    now = cells.withColumns({"weight": F.when(F.col("tokens") > 0, F.col("tokens").cast("double")), "_most": most})
    for _ in range(rounds):
        for dimension in DIMENSIONS:
            have = F.sum("weight").over(Window.partitionBy(dimension))
            scaled = F.least(F.col("weight") * F.col(f"target_{dimension}") / have, F.col("_most"))
            now = now.withColumn("weight", F.when(have > 0, scaled).otherwise(F.col("weight")))
    return materialize(now.select(*DIMENSIONS, "tokens", "weight", *(f"target_{d}" for d in DIMENSIONS)), "raked")


def marginals(docs: DataFrame, targets: dict[str, dict[str, float] | None] | None = None) -> DataFrame:
    """(dimension, value, target, share): what was asked for and what the raked cells give."""
    cells = described(docs).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    raked = rake(cells, targets or {"lang": LANG_TARGETS}).where("weight is not null")
    raked = raked.withColumn("_share", F.col("weight") / F.sum("weight").over(Window.partitionBy()))
    parts = [
        raked.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value")).agg(
            F.max(f"target_{d}").alias("target"), F.sum("_share").alias("share")
        )
        for d in DIMENSIONS
    ]
    return parts[0].union(parts[1]).union(parts[2])


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, topic, tokens) of every row; null values are a group of
    their own, ``(none)``."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        *(F.coalesce(F.col(c), F.lit(NO_VALUE)).alias(c) for c in ("source", "lang")),
        text.alias("text"),
    ).select("doc_id", "source", "lang", F.expr(topic_sql()).alias("topic"), tokens(F.col("text")).alias("tokens"))


def probabilities(rows: DataFrame, targets: dict[str, dict[str, float] | None]) -> DataFrame:
    """Cells with ``expected``, the copies of a document on average, and ``probability``, that
    of being in the sample at all. A cell without tokens keeps its rows, which cost nothing."""
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    raked = rake(cells, targets)
    whole = raked.agg(F.sum("tokens").alias("_tokens"), F.sum("weight").alias("_weight"))
    asked = F.when(F.col("weight") > 0, F.col("weight") / F.col("_weight") * F.lit(BUDGET) * F.col("_tokens") / F.col("tokens")).otherwise(F.col("weight"))
    expected = F.round(F.coalesce(F.least(asked, F.lit(float(MAX_COPIES))), F.lit(1.0)), 9).alias("expected")
    found = raked.join(F.broadcast(whole)).select(*DIMENSIONS, expected)
    return found.withColumn("probability", F.least("expected", F.lit(1.0)))


def copies(id_col: Column, expected: Column) -> Column:
    """Whole copies, and one more if the draw falls into the rest."""
    return (F.floor(expected) + (draw(id_col) < expected - F.floor(expected)).cast("long")).cast("int")


def mixed(
    docs: DataFrame,
    targets: dict[str, dict[str, float] | None] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, expected, probability, copies, sampled) of every
    row: how often the sample holds it on average and in fact.

    Null source or language is the group ``(none)``; null and empty texts have no
    tokens. Rows that repeat an id are drawn alike; a null id counts as the empty id.
    No rows give no rows; other columns are ignored.
    """
    rows = materialize(described(docs, id_col, text_col), "described")
    chances = probabilities(rows, targets or {"lang": LANG_TARGETS})
    joined = lookup_join(rows, materialize(chances, "chances"), list(DIMENSIONS))
    return joined.select(
        "doc_id", *DIMENSIONS, "tokens", "expected", "probability", copies(F.col("doc_id"), F.col("expected")).alias("copies")
    ).withColumn("sampled", F.col("copies") > 0)


def sample(
    docs: DataFrame,
    targets: dict[str, dict[str, float] | None] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns, each as often as it has copies;
    as ``mixed``, without moving texts."""
    chances = materialize(probabilities(described(docs, id_col, text_col), targets or {"lang": LANG_TARGETS}), "chances")
    *keys, expected, copy = unused(docs, *(f"_mix_{c}" for c in DIMENSIONS), "_mix_expected", "_mix_copy")
    topic = F.expr(topic_sql().replace("text", f"`{text_col}`"))
    values = [F.coalesce(F.col(c), F.lit(NO_VALUE)) for c in DIMENSIONS[:2]] + [topic]
    marked = docs.withColumns(dict(zip(keys, values, strict=True)))
    chances = chances.select(*(F.col(c).alias(k) for c, k in zip(DIMENSIONS, keys, strict=True)), F.col("expected").alias(expected))
    joined = lookup_join(marked, chances, keys, spread_by=[id_col])
    times = F.array_repeat(F.lit(1), copies(F.col(id_col), F.col(expected)))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(times).alias(copy)).drop(copy)


def oracle() -> str:
    """The same in SQL: every rake step is a common table."""
    steps, last = [], "w0"
    for k in range(ROUNDS * len(DIMENSIONS)):
        d = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(
            f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {d}) > 0 "
            f"THEN least(weight * target_{d} / sum(weight) OVER (PARTITION BY {d}), most) ELSE weight END AS weight) FROM {last})"
        )
        last = f"w{k + 1}"
    given = "CASE lang " + " ".join(f"WHEN '{name}' THEN {float(share)}" for name, share in LANG_TARGETS.items()) + " END"
    # Given shares divide what the tempered shares of the other values leave.
    shares = ", ".join(
        f"share_{d} AS (SELECT {d}, coalesce(g / sum(g) OVER () * (1 - coalesce(sum(t) FILTER (g IS NULL) OVER (), 0) / sum(t) OVER ()), "
        f"t / sum(t) OVER ()) AS target_{d} FROM "
        f"(SELECT {d}, pow(sum(tokens), {TEMPER}) AS t, {given if d == 'lang' else 'CAST(NULL AS DOUBLE)'} AS g "
        f"FROM cells GROUP BY {d} HAVING sum(tokens) > 0))"
        for d in DIMENSIONS
    )
    keys = ", ".join(DIMENSIONS)
    return f"""
WITH described AS (
  SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source, coalesce(lang, '{NO_VALUE}') AS lang, {topic_sql()} AS topic,
         CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS BIGINT) AS tokens
  FROM documents),
cells AS (SELECT {keys}, CAST(sum(tokens) AS BIGINT) AS tokens FROM described GROUP BY ALL),
{shares},
w0 AS MATERIALIZED (
  SELECT *, CASE WHEN tokens > 0 THEN CAST(tokens AS DOUBLE) END AS weight,
         tokens * {MAX_COPIES / BUDGET} / sum(tokens) OVER () AS most
  FROM cells {" ".join(f"LEFT JOIN share_{d} USING ({d})" for d in DIMENSIONS)}),
{", ".join(steps)},
chances AS (
  SELECT {keys}, round(coalesce(least(weight / sum(weight) OVER () * {BUDGET} * sum(tokens) OVER () / tokens, {float(MAX_COPIES)}), 1.0), 9)
         AS expected FROM {last}),
drawn AS (
  SELECT *, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM described JOIN chances USING ({keys}))
SELECT doc_id, {keys}, tokens, expected, least(expected, 1.0) AS probability,
       CAST(floor(expected) + CASE WHEN u < expected - floor(expected) THEN 1 ELSE 0 END AS INTEGER) AS copies,
       floor(expected) + CASE WHEN u < expected - floor(expected) THEN 1 ELSE 0 END > 0 AS sampled
FROM drawn"""
