import numpy as np

from adloom.llm import mixing
from adloom.llm.mixing import DIMENSIONS, described, mixed, probabilities, rake, sample


def brute_force(cells, targets, rounds=mixing.ROUNDS):
    tokens = np.zeros([len({c[d] for c in cells}) for d in range(3)])
    names = [sorted({c[d] for c in cells}) for d in range(3)]
    for *key, n in cells:
        tokens[tuple(names[d].index(k) for d, k in enumerate(key))] = n
    want = []
    for d in range(3):
        have = tokens.sum(tuple(x for x in range(3) if x != d))
        given = targets.get(DIMENSIONS[d])
        t = have**mixing.TEMPER / (have**mixing.TEMPER).sum()
        if given is not None:
            listed = np.array([n in given for n in names[d]])
            asked = np.array([given.get(n, 0.0) for n in names[d]])
            t = np.where(listed, asked / asked.sum() * t[listed].sum(), t)
        want.append(t)
    w = tokens.copy()
    for _ in range(rounds):
        for d in range(3):
            have = w.sum(tuple(x for x in range(3) if x != d))
            shape = [-1 if x == d else 1 for x in range(3)]
            w = w * np.where(have > 0, want[d] / np.where(have > 0, have, 1), 1).reshape(shape)
    return {tuple(key): w[tuple(names[d].index(k) for d, k in enumerate(key))] for *key, _ in cells}, want, names


def test_raking_against_numpy(spark):
    rng = np.random.default_rng(2)
    cells = [(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(1, 5000))) for a in range(5) for b in range(3) for c in range(4) if rng.random() < 0.8]
    targets = {"lang": {"l0": 1.0, "l1": 2.0, "l2": 1.0, "l9": 5.0}}
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    got = {(r.source, r.lang, r.topic): r.weight for r in rake(df, targets).collect()}
    want, shares, names = brute_force(cells, targets)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    for d in range(3):
        sums = [sum(v for k, v in got.items() if k[d] == n) for n in names[d]]
        assert np.allclose(sums, shares[d], atol=1e-4)


def test_cells_in_many_partitions_give_the_same(spark, monkeypatch):
    cells = [(f"s{a}", f"l{a % 3}", f"t{a % 4}", 100 + a) for a in range(24)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    one = {tuple(r)[:3]: r.weight for r in rake(df, {}, 3).collect()}
    monkeypatch.setattr(mixing, "CELLS_TOGETHER", 0)
    many = {tuple(r)[:3]: r.weight for r in rake(df, {}, 3).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-12 for k in one)


def test_sample_meets_the_marginals(spark):
    rows = [(i, "word " * 5, "en" if i % 10 else "de", f"s{min(i % 7, 2)}", 0) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    targets = {"lang": {"en": 0.6, "de": 0.4}, "source": {"s0": 1.0, "s1": 1.0, "s2": 1.0}}
    got = mixed(docs, targets).where("sampled").toPandas()
    # Every copy counts.
    got.tokens *= got.copies
    assert abs(got.tokens.sum() / 100_000 - mixing.BUDGET) < 0.02
    shares = got.groupby("lang").tokens.sum() / got.tokens.sum()
    assert abs(shares["de"] - 0.4) < 0.02
    assert abs(got.groupby("source").tokens.sum() / got.tokens.sum() - 1 / 3).max() < 0.03
    chances = probabilities(described(docs), targets).toPandas().probability
    assert chances.max() == 1.0 and chances.min() > 0
    kept = sample(docs, targets)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(got.doc_id)


def test_awkward_rows(awkward, no_docs):
    rows = mixed(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.probability <= 1 for r in rows)
    assert {r.lang for r in rows} == {"en", mixing.NO_VALUE}
    assert {r.tokens for r in rows if r.doc_id in (4, 5, 6)} == {0}
    assert sample(awkward).columns == awkward.columns
    assert mixed(no_docs).count() == 0 and sample(no_docs).count() == 0


def test_values_without_a_target_keep_a_share(spark):
    langs = ["en", "en", "de", "xx", None]
    rows = [(i, "a b c", langs[i % 5], "s", 0) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    shares = {r.value: (r.target, r.share) for r in mixing.marginals(docs).where("dimension = 'lang'").collect()}
    weight = {"en": 2**mixing.TEMPER, "de": 1, "xx": 1, "(none)": 1}
    whole = sum(weight.values())
    assert abs(shares["xx"][0] - 1 / whole) < 1e-9 and abs(shares["(none)"][0] - 1 / whole) < 1e-9
    listed = 1 - 2 / whole
    assert abs(shares["en"][0] - listed * 0.55 / 0.70) < 1e-9
    assert all(abs(target - share) < 0.01 for target, share in shares.values())
    got = {r.lang for r in mixed(docs).where("sampled").collect()}
    assert got == {"en", "de", "xx", "(none)"}
    # No target can be met by no rows; one given as 0 takes its rows out.
    none = mixed(docs, {"lang": {"en": 1.0, "xx": 0.0, "absent": 3.0}})
    assert {r.lang: r.expected > 0 for r in none.collect()} == {"en": True, "de": True, "xx": False, "(none)": True}


def test_copies_are_bounded_and_the_rest_is_kept(spark):
    rows = [(i, "a b c d", "de" if i == 0 else "en", "s", 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: r for r in mixed(docs, {"lang": {"en": 0.5, "de": 0.5}}).collect()}
    assert got[0].copies == mixing.MAX_COPIES
    # One rare document does not set the size of the sample.
    assert sum(r.copies for r in got.values()) > 1900
    drawn = sample(docs, {"lang": {"en": 0.5, "de": 0.5}}).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in drawn} == {i: r.copies for i, r in got.items() if r.copies}


def test_whole_table_meets_the_marginals(documents):
    assert all(abs(r.target - r.share) < 0.01 for r in mixing.marginals(documents).collect())


def test_draw_is_uniform_and_fixed(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    u = df.select(mixing.draw(df.doc_id).alias("u")).toPandas().u
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01


def test_no_python_in_the_plan(documents):
    plan = mixed(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
