"""Line dedup against a plain version, the levels of its runs, and its SQL."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import lines, queries
from starmart.sources import files
from starmart.sources.scratch import scratch_path

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def plain(texts, least=10):
    """(lines, dropped, text) of each text."""
    split = [(text or "").split("\n") for text in texts]
    seen = Counter(key for one in split for key in {key_of(line) for line in one} if key)
    kept = [[line for line in one if seen[key_of(line)] < least] for one in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept)]


def texts_of(spark, texts):
    rows = [(i, text, 7, "x") for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_lines int, h string")


def result(df):
    return [(r["n_lines"], r["n_dropped"], r["text"]) for r in df.orderBy("doc_id").collect()]


def some_texts(seed, count=160):
    chance = random.Random(seed)
    ends = ["", " ", "\t", "\r", " ", "."]
    words = ["Menu", "menu", "ÉTÉ", "été", "", " ", "\x0b\f", "Home | Shop", "a", "日本", "l" * 300]

    def line():
        word = chance.choice(words) if chance.random() < 0.4 else f"own {chance.randint(0, 90)}"
        return chance.choice(ends) + word + chance.choice(ends)

    texts = ["\n".join(line() for _ in range(chance.randint(0, 9))) for _ in range(count)]
    return [*texts, None, "", "\n", "\n\n", *texts[:12]]


@pytest.mark.parametrize("seed", range(3))
def test_lines_equal_plain(spark, seed):
    texts = some_texts(seed)
    assert result(lines.drop_common_lines(texts_of(spark, texts), batches=3)) == plain(texts)


def test_number_of_batches_and_levels_changes_nothing(spark):
    texts = some_texts(9)
    docs = texts_of(spark, texts)
    for batches, fanout in ((1, 2), (7, 2), (5, 9)):
        assert result(lines.drop_common_lines(docs, batches=batches, fanout=fanout)) == plain(texts)


def test_runs_are_levelled_and_merged_in_place(spark):
    path = scratch_path(spark, "runs")
    runs = lines.LineRuns(spark, path, fanout=2, buckets=4)
    for number in range(7):
        keys = spark.range(number * 10, number * 10 + 30).select(F.col("id").alias("h"), F.lit(0).cast("long").alias("g"))
        runs.add(keys, number)
        runs.add(keys, number)  # A batch that comes again is not counted again.
    assert sorted(level for level, _ in runs.runs) == [0, 1, 2]
    assert {f"run={run}" for _, run in runs.runs} == {n for n in files.names(spark, f"{path}/runs") if "=" in n}
    assert "Exchange" not in runs.counts()._jdf.queryExecution().executedPlan().toString()
    counts = {r["h"]: r["n"] for r in runs.counts().collect()}
    assert counts == Counter(h for number in range(7) for h in range(number * 10, number * 10 + 30))
    runs.close()
    again = lines.LineRuns(spark, path, fanout=2)
    assert again.last == 6 and {r["h"]: r["n"] for r in again.counts().collect()} == counts


def test_batches_see_what_came_before(spark):
    runs = lines.LineRuns(spark, scratch_path(spark, "runs"), fanout=2)
    seen = []
    for number in range(5):
        texts = [f"Shared line\nown {number} {i}" for i in range(3)]
        found = result(lines.drop_batch_lines(runs, texts_of(spark, texts), number, min_documents=7))
        seen.append([n for _, n, _ in found])
    assert seen == [[0, 0, 0], [0, 0, 0], [1, 1, 1], [1, 1, 1], [1, 1, 1]]


def test_one_line_and_one_text_on_most_rows(spark):
    texts = ["Top\nsame text\nBottom"] * 3000 + [f"Top\nnumber {i}" for i in range(1500)]
    assert result(lines.drop_common_lines(texts_of(spark, texts))) == plain(texts)


def test_odd_rows(spark, odd_docs, no_docs):
    found = lines.drop_common_lines(odd_docs.withColumn("n_dropped", F.lit("x")), min_documents=3)
    assert found.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    given = [r["text"] for r in odd_docs.collect()]
    assert Counter((r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()) == Counter(plain(given, 3))
    assert lines.drop_common_lines(no_docs).count() == 0
    long = texts_of(spark, ["\n".join(f"line {i % 1000}" for i in range(200_000)), *["line 7"] * 9])
    assert result(lines.drop_common_lines(long))[0][:2] == (200_000, 200)


def test_query_equals_sql_and_hashes(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(duck.execute(queries.ORACLES["op11_line_dedup"]).fetchall())
    found = queries.op11_line_dedup(spark, SF)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == want
    assert sum(r[2] for r in want) > 300
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    texts = plain([docs[r[0]] for r in want])
    assert [r[3] for r in want] == [hashlib.sha256(t.encode()).hexdigest() for _, _, t in texts]
