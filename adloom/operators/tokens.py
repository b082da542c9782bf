"""Words, stopword removal and n-grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions.text import distinct_known, without_words, word_groups, words
from adloom.operators.ids import dense_ids
from adloom.operators.joins import fits_broadcast, salted_join, shuffled
from adloom.storage import materialize

# A stopword list up to this size is written into the plan; the outcome is the same.
STOPWORD_LIMIT = 20_000


def word_rows(ads: DataFrame, text: str = "article_content", carry: list[str] | None = None) -> DataFrame:
    """One row per word occurrence, with its position in the text."""
    return ads.select(*(carry or ["ad_id"]), F.posexplode(words(F.col(text))).alias("pos", "word"))


def drop_stopwords(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Tokens that are no stopword. A frequent word may hold a third of all
    tokens: a small list is broadcast, for a large one the word is split."""
    listed = stopwords.select(F.col("stopword").alias("word")).where("word is not null").distinct()
    if fits_broadcast(listed):
        return tokens.join(F.broadcast(listed), "word", "left_anti").select(*tokens.columns)
    return salted_join(tokens, listed, ["word"], "left_anti").select(*tokens.columns)


def kept_words(ads: DataFrame, stopwords: DataFrame, text: str = "article_content") -> DataFrame:
    """``ads`` with a ``words`` list: the tokens left after stopword removal, in order;
    empty when none is left, NULL for a NULL text.

    With a list of ordinary size this happens inside the row, with no shuffle at all.
    For a longer one each row first learns which of its distinct words are listed, over
    a number that tells rows apart even when they share an ad, and is then filtered in
    the same way.
    """
    listed = (
        stopwords.select("stopword").where("stopword is not null").distinct().limit(STOPWORD_LIMIT + 1).collect()
    )
    if len(listed) <= STOPWORD_LIMIT:
        excluded = [row.stopword for row in listed]
        return ads.withColumn("words", without_words(words(F.col(text)), excluded))
    # Written once, so that the numbers stay with their rows.
    rows = materialize(ads.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    own = rows.select("_row", F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
    every = stopwords.select(F.col("stopword").alias("word")).where("word is not null").distinct()
    if fits_broadcast(every):
        met = own.join(F.broadcast(every), "word")
    else:
        met = salted_join(own, every, ["word"], "left_semi")
    per_row = met.groupBy("_row").agg(F.collect_list("word").alias("_stop"))
    joined = rows.join(per_row, "_row", "left").withColumn("_stop", F.coalesce("_stop", F.array().cast("array<string>")))
    kept = F.filter(words(F.col(text)), lambda word: ~F.array_contains("_stop", word))
    return joined.select(*ads.columns, kept.alias("words"))


def reassembled_text(ads: DataFrame, stopwords: DataFrame, text: str = "article_content") -> DataFrame:
    """The remaining words of each ad as one string, in text order. Ads with no
    remaining word give no row."""
    kept = kept_words(ads, stopwords, text).where(F.size("words") > 0)
    return kept.select("ad_id", F.array_join("words", " ").alias("words"))


def ngram_rows(
    ads: DataFrame,
    stopwords: DataFrame,
    sizes: tuple[int, ...] = (1, 2),
    text: str = "article_content",
    carry: list[str] | None = None,
) -> DataFrame:
    """Single words, every occurrence; larger groups once per ad.

    Groups are formed after stopword removal and do not overlap. The text is
    tokenised once and each row emits the groups of all sizes.
    """
    carry = carry or ["ad_id"]
    kept = kept_words(ads, stopwords, text).select(*carry, "words")

    def found(size: int):
        groups = word_groups(F.col("words"), size)
        return groups if size == 1 else distinct_known(groups)

    per_size = F.array(*[F.struct(F.lit(n).alias("ngram_size"), found(n).alias("words")) for n in sizes])
    lists = kept.select(*carry, F.explode(per_size).alias("_g"))
    return lists.select(F.explode("_g.words").alias("words"), "_g.ngram_size", *carry)


def ngrams(
    ads: DataFrame,
    stopwords: DataFrame,
    sizes: tuple[int, ...] = (1, 2),
    text: str = "article_content",
    carry: list[str] | None = None,
) -> DataFrame:
    """N-gram table keyed by ad, numbered in word order. ``carry`` may add columns
    that depend on the ad.

    The rows are written before they are numbered: range partitioning reads its
    input once for a sample and once for the rows, and reading narrow columns
    twice is cheaper than tokenising every text twice.
    """
    grams = materialize(ngram_rows(ads, stopwords, sizes, text, carry), "ngrams")
    return dense_ids(grams, ["words", "ngram_size", "ad_id"])


def ngrams_with_bridges(
    ads: DataFrame,
    ads_with_ids: DataFrame,
    stopwords: DataFrame,
    sizes: tuple[int, ...] = (1, 2),
    text: str = "article_content",
) -> DataFrame:
    """N-grams repeated once per keyword x function row of the ad.

    The text is tokenised once per ad; the repetition is a join of the finished
    n-grams to the narrow id columns instead of tokenising copies of the text.
    """
    ids = ["keyword_bridge_id", "stillingsfunksjon_bridge_id", "employer_id"]
    grams = ngram_rows(ads, stopwords, sizes, text)
    fanned = grams.join(shuffled(ads_with_ids.select("ad_id", *ids)), "ad_id")
    columns = ["words", "ngram_size", "ad_id", *ids]
    return dense_ids(materialize(fanned.select(*columns), "ngrams"), columns)


def phrase_counts(grams: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent phrases per group, ties by phrase."""
    counts = grams.groupBy(*by, "words").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, by, [F.desc("n"), F.asc("words")], k)


def top_per_group(df: DataFrame, by: list[str], order, k: int) -> DataFrame:
    """Spark limits each group to k rows before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Append by column name; a column missing in one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
