"""Cleaning, tokens, n-grams, ids, skewed joins."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adloom.functions import text as X
from adloom.operators import joins, tokens
from adloom.operators.ids import dense_ids
from adloom.operators.joins import salted_join

STOP = ["the", "og"]
TEXTS = {
    "1": "the red the blue green og the yellow red",
    "2": "the og the",
    "3": "",
    "4": None,
    "5": "a b a b a b c",
    "6": "blåbær og ørret",
}


def reference_bigrams(text):
    kept = [w for w in re.findall(r"\w+", text or "", re.ASCII) if w not in STOP]
    return {" ".join(kept[i : i + 2]) for i in range(0, len(kept) - 1, 2)}


@pytest.fixture
def ads(spark):
    return spark.createDataFrame(list(TEXTS.items()), "ad_id string, article_content string")


@pytest.fixture
def stop(spark):
    return spark.createDataFrame([(w,) for w in [*STOP, "og", None]], "stopword string")


def test_clean_text(spark):
    cases = {
        "A|b!c?d:e;f.g/h-i%j&k": "a b c d e f g h i j k",
        "x \t\n y": "x y",
        "a. - b": "a b",
        "back\\slash": "back\\slash",
        "v\x0bt": "v\x0bt",
        " lead": " lead",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.withColumn("c", X.clean_text(F.col("t"))).collect()} == cases


def test_small_functions(spark):
    row = spark.sql("select 1").select(
        X.slash_list(F.lit("IT/Salg/")).alias("a"),
        X.keyword_list(F.lit("Java, SQL; blåbær")).alias("b"),
        X.replace_nul(F.lit("a\x00b")).alias("c"),
        X.drop_nbsp(F.lit("a\u00a0b")).alias("d"),
        X.label_key(F.lit(" Sektor: ")).alias("e"),
        F.sort_array(X.distinct_known(F.array(F.lit("b"), F.lit(None), F.lit("a"), F.lit("b")))).alias("f"),
    ).first()
    assert row.a == ["it", "salg", ""] and row.b == ["java", "sql", "bl", "b", "r"]
    assert (row.c, row.d, row.e, row.f) == ("a\ufffdb", "ab", "sektor", ["a", "b"])


def test_bigrams_pair_after_stopwords(ads, stop):
    found = {}
    for r in tokens.ngram_rows(ads, stop, (2,)).collect():
        found.setdefault(r.ad_id, []).append(r.words)
    for ad, text in TEXTS.items():
        assert len(found.get(ad, [])) == len(set(found.get(ad, [])))
        assert set(found.get(ad, [])) == reference_bigrams(text), ad


def test_large_stopword_list_gives_the_same(monkeypatch, ads, stop, rows):
    expected = rows(tokens.ngram_rows(ads, stop, (1, 2, 3)))
    expected_tokens = rows(tokens.drop_stopwords(tokens.word_rows(ads), stop))
    monkeypatch.setattr(tokens, "STOPWORD_LIMIT", 1)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(tokens, "fits_broadcast", lambda df: False)
    assert rows(tokens.ngram_rows(ads, stop, (1, 2, 3))) == expected
    assert rows(tokens.drop_stopwords(tokens.word_rows(ads), stop)) == expected_tokens


def test_reassembled_text(ads, stop, rows):
    assert rows(tokens.reassembled_text(ads, stop))[:2] == [("1", "red blue green yellow red"), ("5", "a b a b a b c")]


def test_ngrams_are_numbered_densely(ads, stop):
    out = tokens.ngrams(ads, stop).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, len(out) + 1))
    keys = [(r.words, r.ngram_size, r.ad_id) for r in out]
    assert keys == sorted(keys)


def test_dense_ids_equal_row_number(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(
            F.when(F.col("id") % 97 != 0, F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(100000)))).alias("v"), "id"
        ).withColumnRenamed("id", "n")
        literal = df.withColumn("e", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_last(), "n")))
        joined = dense_ids(df, ["v", "n"]).join(literal.select("n", "e"), "n")
        assert joined.where("id != e").count() == 0 and joined.count() == 5000
        assert "SinglePartition" not in dense_ids(df, ["v", "n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.createDataFrame([], "v string"), ["v"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_exact_with_a_hot_key(spark, rows, how):
    # One key holds over a third of the rows, some keys are NULL, some unmatched.
    facts = spark.range(3000).select(
        F.when(F.col("id") % 5 < 2, "hot").when(F.col("id") % 5 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id",
    )
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", 3), ("k4", 4), (None, 5)], "k string, v int")
    got = salted_join(facts, lookup, ["k"], how, spread_by=["id"], rows_per_cell=100)
    want = facts.join(lookup, ["k"], how)
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))


def test_salted_join_splits_the_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(4000).select(F.lit("hot").alias("k"), "id")
        lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
        out = salted_join(facts, lookup, ["k"], "inner", spread_by=["id"], rows_per_cell=100)
        tasks = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == 8 and max(r["count"] for r in tasks) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_with_condition(spark, rows):
    facts = spark.range(500).select((F.col("id") % 2).alias("k"), "id")
    lookup = spark.createDataFrame([(0, 100), (0, 400), (1, 250)], "k bigint, top int")
    got = salted_join(facts, lookup, ["k"], "inner", rows_per_cell=50, condition=F.expr("f.id < l.top"))
    want = facts.join(lookup, "k").where("id < top")
    assert rows(got.select("k", "id", "top")) == rows(want.select("k", "id", "top"))


def test_plans_have_no_nested_loops_and_no_shuffle_for_ngrams(spark, ads, stop):
    plan = tokens.ngram_rows(ads, stop)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    counted = tokens.phrase_counts(tokens.ngram_rows(ads, stop), ["ad_id"], 3)
    assert "WindowGroupLimit" in counted._jdf.queryExecution().executedPlan().toString()


def test_prefix_sums_over_groups(spark, monkeypatch):
    from adloom.operators import ids

    monkeypatch.setattr(ids, "_SUMMED_TOGETHER", 7)
    sizes = [(i, (i * 37) % 11) for i in range(100) if i % 9]
    got = {r.at: r.start for r in ids.prefix_sums(spark.createDataFrame(sizes, "at int, n long"), "at", "n", "start").collect()}
    total = 0
    for at, n in sizes:
        assert got[at] == total
        total += n


def test_plan_does_not_grow_with_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 900).alias("v"), "id")
    plans = []
    for n in (4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            found = dense_ids(df, ["v", "id"], "number")
            plans.append(found._jdf.queryExecution().logical().toString().count("\n"))
            assert found.agg(F.min("number").alias("a"), F.max("number").alias("b")).first() == (1, 5000)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert plans[0] == plans[1]


def test_merging_leaves_single_rows_alone(spark, monkeypatch):
    from adloom.operators import dedupe

    rows = [(None, 1, "n"), ("1", 1, "old"), ("1", 2, None), ("2", 5, "only"), ("3", 3, "a"), ("3", 3, "b"), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    expected = [("1", 2, "old"), ("2", 5, "only"), ("3", 3, "b"), (None, 2, "n")]
    for few in (True, False):
        monkeypatch.setattr(dedupe, "fits_broadcast", lambda *_, few=few: few)
        assert sorted(map(tuple, dedupe.merge_rows(df, ["k"], ["t"]).collect()), key=repr) == sorted(expected, key=repr)
    single = dedupe.merge_rows(df.where("k = '2'"), ["k"], ["t"])
    assert "Aggregate" not in single._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_sorted_where_ads_are_single(spark, sf_dir):
    from driver_queries import QUERIES

    plan = QUERIES["join_meta_content"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_sketches_merge(spark):
    from adloom.operators.sketches import merged_counts, period_sketches

    rows = spark.range(60_000).select((F.col("id") % 6).alias("m"), (F.col("id") % 20_000).alias("v"), F.lit(None).cast("string").alias("none"))
    kept = period_sketches(rows, ["m"], {"v": F.col("v"), "none": F.col("none")})
    whole = merged_counts(kept, ["v", "none"]).first()
    assert whole.rows == 60_000 and abs(whole.v - 20_000) < 400 and whole.none == 0
    nothing = merged_counts(kept.where("false"), ["v"]).first()
    assert (nothing.rows, nothing.v) == (0, 0)
