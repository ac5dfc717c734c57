"""Manifests: every way in which the content of an output can differ from what was written."""

import shutil

import pytest
from conftest import rows

import starmart as sm
from starmart.operators.manifests import measure
from starmart.operators.quality import write_gated

WHERE = "id long, name string, size long, tags map<string,int>, kind string"


@pytest.fixture
def output(spark, tmp_path):
    made = [(n, f"n{n}" if n % 4 else None, n if n % 3 else None, {"a": n, "b": 1}, f"k {n % 3}") for n in range(60)]
    df = spark.createDataFrame(made, WHERE).repartition(3)
    path = str(tmp_path / "odd = name %20")
    write = sm.sealed(lambda df, to: sm.write_parquet(df, to, partition_by=["kind"]))
    assert write_gated(df, "out", path, write) == 60
    return path


def _parts(tmp_path):
    return sorted((tmp_path / "odd = name %20").glob("kind=*/*.parquet"))


def _status(spark, path):
    return {(row.status): row["count"] for row in sm.content_report(spark, path).groupBy("status").count().collect()}


def test_an_output_as_written(spark, output, tmp_path):
    assert _status(spark, output) == {"same": len(_parts(tmp_path))}
    assert rows(sm.require_contents(spark, {"out": ("parquet", output)})) == [("out", "same", len(_parts(tmp_path)), 60)]
    assert spark.read.parquet(output).count() == 60
    moved = str(tmp_path / "moved")
    shutil.copytree(output, moved)
    assert _status(spark, moved) == {"same": len(_parts(tmp_path))}


def test_a_doubled_and_a_removed_file(spark, output, tmp_path):
    first, *others = _parts(tmp_path)
    shutil.copy(first, first.with_name("copy.parquet"))
    assert _status(spark, output) == {"same": 1 + len(others), "added": 1}
    first.unlink()
    (first.parent / f".{first.name}.crc").unlink()
    assert _status(spark, output) == {"same": len(others), "added": 1, "missing": 1}
    with pytest.raises(AssertionError, match="copy.parquet added.*missing|missing.*copy.parquet added"):
        sm.require_contents(spark, {"out": ("parquet", output)})


def test_other_rows_in_a_file(spark, output, tmp_path):
    first, second, *_ = _parts(tmp_path)
    (second.parent / f".{second.name}.crc").unlink()
    shutil.copy(first, second)
    assert _status(spark, output)["changed"] == 1


def test_hash_tells_places_of_nulls_and_counts_repeats(spark, tmp_path):
    def hashed(name, data):
        path = str(tmp_path / name)
        spark.createDataFrame(data, "a string, b string").coalesce(1).write.parquet(path)
        return measure(spark, path).first()["hash"]

    one = hashed("one", [("x", None), ("y", "z")])
    assert hashed("order", [("y", "z"), ("x", None)]) == one
    assert hashed("null", [(None, "x"), ("y", "z")]) != one
    assert hashed("twice", [("x", None), ("x", None), ("y", "z"), ("y", "z")]) != one


def test_csv_output(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(30).selectExpr("id", "concat('a,', id) AS name")
    write_gated(df, "csv", path, sm.sealed(sm.write_csv, "csv"))
    report = sm.require_contents(spark, {"csv": ("csv", path)})
    assert report.first()["rows"] == 30
