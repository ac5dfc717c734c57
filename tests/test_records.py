"""CSV read in splits: the rows of a plain reader, and malformed records kept apart."""

import csv
import io
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

import starmart as sm
from starmart.operators.quality import require_clean
from starmart.sources.records import csv_records, read_csv_checked, read_csv_records

SCHEMA = T.StructType().add("a", "string").add("n", "integer").add("b", "string")


@pytest.fixture
def small_blocks(spark):
    """Blocks of 200 bytes, so that a short file is read by many tasks."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def some_rows(seed, count=120):
    chance = random.Random(seed)
    cells = ["x", 'say "hi"', "two\nlines", '\n"\n', ",", '""', "a\n\nb", "é日本", " pad ", "long " * 30, "1\n2\n3\n4\n5"]
    return [(chance.choice(cells), chance.randint(-9, 9), chance.choice(cells)) for _ in range(count)]


def text_of(table, names=("a", "n", "b"), **options):
    file = io.StringIO()
    writer = csv.writer(file, lineterminator="\n", **options)
    writer.writerows([names, *table])
    return file.getvalue()


@pytest.mark.parametrize("seed, sep, end", [(1, ",", "\n"), (2, ";", "\n"), (3, ",", "\r\n")])
def test_rows_are_those_of_one_task(spark, small_blocks, tmp_path, seed, sep, end):
    table = some_rows(seed)
    path = tmp_path / "t.csv"
    path.write_bytes(text_of(table, delimiter=sep).replace("\n", end).encode())
    found = read_csv_records(spark, str(path), SCHEMA, sep)
    assert rows(found) == sorted(((a.replace("\n", end), n, b.replace("\n", end)) for a, n, b in table), key=repr)
    if end == "\n":
        assert rows(found) == rows(sm.read_csv(spark, str(path), SCHEMA, sep, multiLine=True))


def test_one_file_is_read_by_many_tasks(spark, small_blocks, tmp_path):
    table = some_rows(4)
    (tmp_path / "t.csv").write_text(text_of(table))
    assert spark.read.text(str(tmp_path / "t.csv")).rdd.getNumPartitions() >= 8
    lines = {(r["line"], r["record"]) for r in csv_records(spark, str(tmp_path / "t.csv")).collect()}
    at, want = 1, set()
    for row in [("a", "n", "b"), *table]:
        record = text_of([], row)[:-1]
        want.add((at, record))
        at += record.count("\n") + 1
    assert lines == want


def test_several_files(spark, small_blocks, tmp_path):
    first, second = some_rows(5, 30), some_rows(6, 40)
    (tmp_path / "1.csv").write_text(text_of(first))
    (tmp_path / "2.csv").write_text(text_of(second))
    assert rows(read_csv_records(spark, str(tmp_path), SCHEMA)) == sorted(first + second, key=repr)


def test_without_header_and_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x,1,y\n\n  \n"p\nq",2,\n')
    found = read_csv_records(spark, str(tmp_path), SCHEMA, header=False)
    assert rows(found) == sorted([("x", 1, "y"), ("p\nq", 2, None)], key=repr)
    with pytest.raises(ValueError, match="need a schema"):
        read_csv_records(spark, str(tmp_path), header=False)
    text = read_csv_records(spark, str(tmp_path))
    assert text.columns == ["x", "1", "y"] and rows(text) == [("p\nq", "2", None)]
    with pytest.raises(ValueError, match="missing"):
        read_csv_checked(spark, str(tmp_path), SCHEMA)


def test_malformed_records_are_kept_apart(spark, small_blocks, tmp_path):
    lines = ["a,n,b", "x,1,y", "short,2", 'more,3,"with\nbreak",4', "bad,five,y", '"ok\nok",6,', "x,7.5,y", ",,"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = read_csv_checked(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert good.schema["n"].dataType == T.IntegerType()
    assert rows(good) == sorted([("x", 1, "y"), ("ok\nok", 6, None), (None, None, None)], key=repr)
    found = [(r["line"], r["reason"], r["record"]) for r in bad.orderBy("line").collect()]
    assert found == [
        (3, "cells", "short,2"),
        (4, "cells", 'more,3,"with\nbreak",4'),
        (6, "type: n", "bad,five,y"),
        (9, "type: n", "x,7.5,y"),
    ]
    assert bad.select("path").distinct().first()[0].endswith("t.csv")
    assert good.count() + bad.count() == csv_records(spark, str(tmp_path / "t.csv")).count() - 1


def test_a_lost_quote_gathers_nothing(spark, small_blocks, tmp_path):
    body = "".join(f"x{i},{i},y\n" for i in range(300))
    (tmp_path / "t.csv").write_text("a,n,b\nu,1,v\n" + '"lost,2,w\n' + body)
    good, bad = read_csv_checked(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert rows(good) == [("u", 1, "v")]
    assert rows(bad.groupBy("reason").count()) == [("unclosed quote", 301)]


def test_empty_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,n,b\n")
    good, bad = read_csv_checked(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert good.columns == ["a", "n", "b"] and good.count() == bad.count() == 0
    require_clean(good, bad, "t", 0.0)


def test_gate_of_the_quarantine(spark):
    good = spark.range(90)
    bad = spark.createDataFrame([("f", i, "cells" if i % 3 else "type: n", "r") for i in range(10)], "path string, line long, reason string, record string")
    report = require_clean(good, bad, "t", 0.1)
    assert rows(report) == [("cells", 6), ("type: n", 4)]
    with pytest.raises(AssertionError, match="t: 10 of 100 records are malformed, at most 5%: 6 cells, 4 type: n"):
        require_clean(good, bad, "t", 0.05)
    assert require_clean(good, bad.filter("line < 0"), "t", 0.0).count() == 0


def test_written_tables_come_back(spark, small_blocks, tmp_path):
    df = spark.range(300).select(
        F.col("id").alias("n"), F.concat(F.lit('q"\n'), F.repeat(F.lit("x\n"), (F.col("id") % 7).cast("int")), F.lit("z")).alias("a")
    )
    sm.write_csv(df.coalesce(1), str(tmp_path / "t"))
    assert rows(read_csv_records(spark, str(tmp_path / "t"), df.schema)) == rows(df)
