"""The gate of outputs: one run of the plan, and an old output that survives whatever happens."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import starmart as sm
from starmart.operators.quality import write_gated
from starmart.sources import files, staging


def _count_rows(spark, df):
    """``df`` with an accumulator that counts how often its rows are produced."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(look, df.schema), seen


def _left(folder):
    return sorted(p.name for p in folder.iterdir())


def test_the_fact_is_scanned_once(spark, tmp_path):
    """A plan with a shuffle join and an aggregate: a probe before the write would run both again."""
    fact, seen = _count_rows(spark, spark.range(0, 5000, numPartitions=6).withColumn("k", F.col("id") % 700))
    names = spark.range(700).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    joined = fact.join(names.hint("merge"), "k").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    assert write_gated(joined, "fact", str(tmp_path / "t"), sm.write_parquet, min_rows=700) == 700
    assert seen.value == 5000
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("n")).first()[0] == 5000
    assert _left(tmp_path) == ["t"]


@pytest.mark.parametrize("write", [sm.write_parquet, sm.write_csv])
def test_a_failed_gate_changes_nothing(spark, tmp_path, write):
    path = str(tmp_path / "t")
    write_gated(spark.range(5), "t", path, write)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").iterdir()}
    for empty in (spark.range(0), spark.range(9).filter("id > 10"), spark.range(9).filter("1 = 0")):
        with pytest.raises(AssertionError, match="t: 0 rows, at least 1"):
            write_gated(empty, "t", path, write)
    with pytest.raises(AssertionError, match="t: 4 rows, at least 5"):
        write_gated(spark.range(4), "t", path, write, min_rows=5)
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").iterdir()} == before
    assert _left(tmp_path) == ["t"]


def test_a_first_write_that_fails_leaves_no_output(spark, tmp_path):
    with pytest.raises(AssertionError):
        write_gated(spark.range(0), "t", str(tmp_path / "t"), sm.write_parquet)
    assert _left(tmp_path) == []
    assert write_gated(spark.range(0), "t", str(tmp_path / "t"), sm.write_parquet, min_rows=0) == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def test_an_error_in_the_job_keeps_the_old_output(spark, tmp_path):
    path = str(tmp_path / "t")
    write_gated(spark.range(5), "t", path, sm.write_parquet)
    broken = spark.range(0, 100, numPartitions=4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        write_gated(broken, "t", path, sm.write_parquet)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(5)]
    assert _left(tmp_path) == ["t"]


def test_an_output_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_gated(spark.range(5), "t", path, sm.write_parquet)
    more = spark.read.parquet(path).unionAll(spark.range(5, 8))
    assert write_gated(more, "t", path, sm.write_parquet) == 8
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(8)]


def test_a_lost_commit_is_recovered(spark, tmp_path):
    """Lost before the commit, and between its two moves."""
    path = str(tmp_path / "t")
    write_gated(spark.range(5), "t", path, sm.write_parquet)
    spark.range(9).write.parquet(staging.stage(spark, path))
    assert spark.read.parquet(path).count() == 5
    # Listings of the folder pass over the staged one.
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path)).count() == 5
    files.move(spark, path, str(tmp_path / "_t.previous"))
    assert staging.recover(spark, path) and not staging.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    files.move(spark, path, str(tmp_path / "_t.previous"))
    with pytest.raises(AssertionError):
        write_gated(spark.range(0), "t", path, sm.write_parquet)
    assert spark.read.parquet(path).count() == 5
    assert write_gated(spark.range(3), "t", path, sm.write_parquet) == 3
    assert _left(tmp_path) == ["t"]


def test_commit_needs_a_staged_output(spark, tmp_path):
    path = str(tmp_path / "t")
    write_gated(spark.range(5), "t", path, sm.write_parquet)
    with pytest.raises(FileNotFoundError):
        staging.commit(spark, path)
    assert spark.read.parquet(path).count() == 5


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "b.txt")
    files.write_text(spark, path, "über\n")
    files.write_text(spark, path, "zwei")
    assert files.read_text(spark, path) == "zwei"
    assert [n for n in files.names(spark, str(tmp_path / "a")) if not n.startswith(".")] == ["b.txt"]
    assert files.names(spark, str(tmp_path / "none")) == []
    with pytest.raises(FileExistsError):
        files.move(spark, path, str(tmp_path / "a"))
