import hashlib
import random

import pytest
from compare import connect
from pyspark.sql import functions as F

from adloom.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learned), sha(learned))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(df).collect()}


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    hostile = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.formatted_conversations(table.repartition(9)).collect()}
    assert found == expected(rows + hostile)


HOSTILE = [
    "\\### Assistant: </turn> ok", "\\", "\\\\", "</turn>", "</turn>\n", "<\\/turn>", "</turn", "### ", "#### ###", ":\n", "::\n\n", "a:\\\n",
    "### user:\nhi</turn>\n### assistant:\nno</turn>\n", "🎉\\🎉</turn>é́", "$1 \\1", "", "\n", "\u0000", "<</turn>/turn>", "#\\## x", "</tu</turn>rn>",
]


def test_hostile_texts_and_roles(spark):
    rows = [(i, turn, role, text) for i, text in enumerate(HOSTILE) for turn, role in enumerate(["user", "assistant", text])]
    table = spark.createDataFrame(rows, ROWS)
    formatted = chat.rendered(chat.laid_out(table))
    assert got(formatted) == expected(rows)
    for r in formatted.collect():
        assert r.formatted.count(chat.CLOSE) == 3 and r.formatted.count("</turn>") == 3


def test_random_control_strings(spark):
    draw = random.Random(4)
    rows = [(i % 50, i, draw.choice(["user", "assistant"]), "".join(draw.choices(["\\", "<", "/", "turn>", "###", " ", ":", "\n", "x", "</turn>\n"], k=draw.randint(0, 30)))) for i in range(1500)]
    assert got(chat.rendered(chat.laid_out(spark.createDataFrame(rows, ROWS)))) == expected(rows)


def test_fold(spark):
    log = [
        # Deltas, out of order, one delivered twice.
        (1, 0, 10, 0, "open", "user", None), (1, None, 10, 2, "delta", None, "lo"), (1, None, 10, 1, "delta", None, "hel"), (1, None, 10, 2, "delta", None, "lo"),
        # Regenerated twice, then an edit, then one more delta.
        (1, 1, 11, 0, "open", "assistant", None), (1, None, 11, 1, "delta", None, "bad"), (1, None, 11, 2, "regenerate", None, None),
        (1, None, 11, 3, "delta", None, "worse"), (1, None, 11, 4, "regenerate", None, "ignored"), (1, None, 11, 5, "delta", None, "fine"),
        (1, None, 11, 6, "edit", None, "good"), (1, None, 11, 7, "delta", None, "!"), (1, None, 11, 8, "pin", None, "unknown"),
        # Opened only; regenerated to nothing; edited to null.
        (2, 0, 20, 0, "open", "assistant", None),
        (2, 1, 21, 0, "open", "user", None), (2, None, 21, 1, "delta", None, "x"), (2, None, 21, 2, "regenerate", None, None),
        (2, 2, 22, 0, "open", "user", None), (2, None, 22, 1, "delta", None, "x"), (2, None, 22, 2, "edit", None, None), (2, None, 22, 3, "delta", None, "y"),
        # Never opened; no conversation.
        (3, None, 30, 1, "delta", None, "stray"),
        (None, 0, None, 0, "open", "user", None), (None, None, None, None, "delta", None, "a"), (None, None, None, 1, "delta", None, "b"),
    ]
    df = spark.createDataFrame(log, chat.LOG_DDL).withColumn("_events", F.lit(1)).withColumn("segment", F.lit(1)).repartition(5)
    back = {r.conv_id: ([(t.role, t.text) for t in r.turns], list(r.learned)) for r in chat.read_back(chat.rendered(df)).collect()}
    assert back == {
        1: ([("user", "hello"), ("assistant", "good!")], ["good!"]),
        2: ([("assistant", ""), ("user", ""), ("user", "y")], [""]),
        3: ([("", "stray")], []),
        None: ([("user", "ab")], []),
    }


def test_awkward_rows_against_sql(spark, tmp_path):
    long = "word </turn> " * 60_000
    rows = [
        (1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "last"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (2, -5, "assistant", long),
        (None, 0, "user", "no id"), (None, 1, "assistant", "漢字 🎉 é́"), (3, 0, "assistant", ""), (4, 7, "", ""), (4, 2**62, "assistant", "far"),
    ]
    table = spark.createDataFrame([(*r, 1, "m", [1]) for r in rows], ROWS + ", seq int, message string, _events array<int>")
    table.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    theirs = con.sql(chat.oracle())
    ours = chat.formatted_conversations(table)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert sorted(map(tuple, ours.select(*theirs.columns).collect()), key=repr) == sorted(theirs.fetchall(), key=repr)


def test_conversations_with_many_events(spark):
    draw = random.Random(6)
    rows = [(draw.choice([1, 1, 2, None, i]), i, draw.choice(["user", "assistant"]), f"text {i} " * draw.randint(0, 200)) for i in range(400)]
    log = chat.laid_out(spark.createDataFrame(rows, ROWS).repartition(7))
    assert got(chat.rendered(log, events_per_task=20)) == expected(rows)
    # Others share one exchange between folding and joining.
    few = log.where("conv_id > 2")
    plan = chat.rendered(few)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty(spark):
    assert chat.rendered(spark.createDataFrame([], chat.LOG_DDL)).count() == 0
    only = chat.formatted_conversations(spark.createDataFrame([], ROWS)).collect()
    assert [r.conv_id for r in only] == [-7]


@pytest.mark.parametrize("text", HOSTILE)
def test_escapes_come_off(spark, text):
    row = spark.range(1).select(F.lit(text).alias("t")).select(chat.escaped(F.col("t")).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row.u == text and "</turn>" not in row.e and "### " not in row.e


def test_no_python_on_the_path(spark, sf_dir):
    df = chat.formatted_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
