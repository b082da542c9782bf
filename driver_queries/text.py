"""Cleaning, tokens, stopwords and n-grams over the document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import clean_text, distinct_known
from adloom.operators.dedupe import latest_row, merge_rows
from adloom.operators.tokens import (
    drop_stopwords,
    ngram_rows,
    ngrams,
    phrase_counts,
    reassembled_text,
    word_rows,
)
from driver_queries.registry import load, load_spread, query

# Frequent words of the four languages of the documents.
STOPWORDS = ["the", "and", "de", "la", "le", "et", "der", "die", "und", "en", "el", "que"]

CLEAN_SQL = r"""regexp_replace(regexp_replace(lower(text), '[|!?:;./\-%&]', ' ', 'g'), '[\t\n\f\r ]+', ' ', 'g')"""
STOPWORDS_SQL = "stopwords AS (SELECT unnest(['" + "','".join(STOPWORDS) + "']) AS stopword)"
KEPT_SQL = rf"""
    ads AS (SELECT CAST(doc_id AS VARCHAR) AS ad_id, source, {CLEAN_SQL} AS article_content FROM documents),
    {STOPWORDS_SQL},
    tokens AS (
        SELECT ad_id, source, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
        FROM (SELECT ad_id, source, regexp_extract_all(article_content, '\w+') AS w FROM ads)),
    kept AS (SELECT * FROM tokens ANTI JOIN stopwords ON word = stopword),
    combined AS (SELECT ad_id, source, string_agg(word, ' ' ORDER BY pos) AS words FROM kept GROUP BY ad_id, source)"""


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOPWORDS], "stopword string")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_spread(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("ad_id"), "source", clean_text(F.col("text")).alias("article_content")
    )


@query("clean_text", f"SELECT doc_id, {CLEAN_SQL} AS cleaned FROM documents")
def clean(spark, sf_dir):
    return load_spread(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", clean_text(F.col("text")).alias("cleaned")
    )


@query("tokens_no_stopwords", f"WITH {KEPT_SQL} SELECT ad_id, CAST(pos AS INTEGER) AS pos, word FROM kept")
def tokens_no_stopwords(spark, sf_dir):
    return drop_stopwords(word_rows(documents(spark, sf_dir)), stopwords(spark))


@query("reassembled_text", f"WITH {KEPT_SQL} SELECT ad_id, words FROM combined")
def reassembled(spark, sf_dir):
    return reassembled_text(documents(spark, sf_dir), stopwords(spark))


_BIGRAMS_SQL = rf"""{KEPT_SQL},
    bigrams AS (
        SELECT ad_id, source, unnest(list_distinct(regexp_extract_all(words, '(\w+)\s+(\w+)'))) AS words FROM combined)"""


@query("bigrams", f"WITH {_BIGRAMS_SQL} SELECT ad_id, words, 2 AS ngram_size FROM bigrams")
def bigrams(spark, sf_dir):
    return ngram_rows(documents(spark, sf_dir), stopwords(spark), sizes=(2,))


@query(
    "trigrams",
    rf"""WITH {KEPT_SQL} SELECT ad_id, 3 AS ngram_size,
         unnest(list_distinct(regexp_extract_all(words, '\w+\s+\w+\s+\w+'))) AS words FROM combined""",
)
def trigrams(spark, sf_dir):
    return ngram_rows(documents(spark, sf_dir), stopwords(spark), sizes=(3,))


NGRAMS_SQL = rf"""{_BIGRAMS_SQL},
    grams AS (SELECT word AS words, 1 AS ngram_size, ad_id FROM kept
              UNION ALL SELECT words, 2, ad_id FROM bigrams),
    ngrams AS (SELECT row_number() OVER (ORDER BY words, ngram_size, ad_id) AS id, * FROM grams)"""


@query("ngrams", f"WITH {NGRAMS_SQL} SELECT id, words, ngram_size, ad_id FROM ngrams")
def ngram_table(spark, sf_dir):
    return ngrams(documents(spark, sf_dir), stopwords(spark))


@query(
    "top_phrases",
    f"""WITH {_BIGRAMS_SQL},
        counts AS (SELECT source, words, count(*) AS n FROM bigrams GROUP BY source, words),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, words) AS INTEGER) AS rank
                   FROM counts)
        SELECT source, words, n, rank FROM ranked WHERE rank <= 10""",
)
def top_phrases(spark, sf_dir):
    grams = ngram_rows(documents(spark, sf_dir), stopwords(spark), sizes=(2,), carry=["ad_id", "source"])
    return phrase_counts(grams, ["source"], 10)


@query(
    "distinct_words",
    rf"""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all({CLEAN_SQL}, '\w+'))), ' ') AS words
         FROM documents""",
)
def distinct_words(spark, sf_dir):
    found = F.regexp_extract_all(clean_text(F.col("text")), F.lit(r"\w+"), F.lit(0))
    return load_spread(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.array_join(F.array_sort(distinct_known(found)), " ").alias("words")
    )


@query(
    "dedupe_latest",
    """SELECT conv_id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
       FROM conversations GROUP BY conv_id""",
)
def dedupe_latest(spark, sf_dir):
    return latest_row(load(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])


@query(
    "dedupe_merge",
    """SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text,
              arg_max(text, turn) FILTER (role = 'user') AS question
       FROM conversations GROUP BY conv_id""",
)
def dedupe_merge(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "text", F.when(F.col("role") == "user", F.col("text")).alias("question")
    )
    return merge_rows(turns, ["conv_id"], ["turn"])
