import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import starmart as sm
from starmart.operators.quality import write_checked
from starmart.sources.readers import read_code_maps, read_csv_by_position


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a;b", 1.5), (2, 'quote "q", comma', None), (3, None, -0.25)],
        "id int, text string, x double",
    )


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv(spark, table, tmp_path, sep):
    path = str(tmp_path / "t")
    sm.write_csv(table, path, sep=sep)
    assert rows(sm.read_csv(spark, path, table.schema, sep=sep)) == rows(table)
    text = sm.read_csv(spark, path, sep=sep)
    assert [kind for _, kind in text.dtypes] == ["string"] * 3


def test_csv_types_go_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,extra,a\n1,x,2\nbad,y,3\n")
    schema = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())
    df = sm.read_csv(spark, str(tmp_path / "t.csv"), schema)
    assert rows(df.select("a", "b", "extra")) == [(2, 1, "x"), (3, None, "y")]
    with pytest.raises(ValueError, match="missing"):
        sm.read_csv(spark, str(tmp_path / "t.csv"), schema.add("c", T.IntegerType()))


def test_csv_without_header(spark, table, tmp_path):
    path = str(tmp_path / "t")
    sm.write_csv(table, path, header=False)
    assert rows(read_csv_by_position(spark, path, table.schema)) == rows(table)


def test_csv_overwrites(spark, table, tmp_path):
    path = str(tmp_path / "t")
    sm.write_csv(table, path)
    sm.write_csv(table.limit(1), path)
    assert sm.read_csv(spark, path).count() == 1


def test_parquet_glob_and_partitions(spark, table, tmp_path):
    sm.write_parquet(table, str(tmp_path / "one.parquet"))
    sm.write_parquet(table, str(tmp_path / "two.parquet"), partition_by=["id"])
    assert sm.read_parquet(spark, str(tmp_path / "one*")).count() == 3
    assert (tmp_path / "two.parquet" / "id=1").is_dir()
    assert rows(sm.read_parquet(spark, str(tmp_path / "one*"), table.schema)) == rows(table)


def test_single_csv_appends_one_file_each(spark, table, tmp_path):
    path = tmp_path / "t"
    many = table.repartition(3)
    sm.write_single_csv(many, str(path))
    sm.write_single_csv(many, str(path))
    assert len(list(path.glob("part-*"))) == 2
    assert sm.read_csv(spark, str(path)).count() == 6


def test_single_csv_is_one_file_at_any_size(spark, tmp_path):
    path = tmp_path / "t"
    sm.write_single_csv(spark.range(0, 1000, numPartitions=4), str(path))
    assert len(list(path.glob("part-*"))) == 1
    assert sm.read_csv(spark, str(path)).count() == 1000


def test_csv_quotes_of_others(spark, tmp_path):
    (tmp_path / "t.csv").write_text('name,n\n"Lowell ""Field"", x",5\n"two\nlines",6\n')
    schema = T.StructType().add("name", "string").add("n", "integer")
    found = sm.read_csv(spark, str(tmp_path / "t.csv"), schema, multiLine=True)
    assert rows(found) == [('Lowell "Field", x', 5), ("two\nlines", 6)]


def test_write_if_absent(spark, table, tmp_path):
    path = str(tmp_path / "t")
    sm.write_if_absent(table, path)
    sm.write_if_absent(table.limit(1), path)
    assert spark.read.parquet(path).count() == 3


def test_code_maps(spark, tmp_path):
    port, mode = {"NYC": "NEW YORK, NY", ".GA": "dot"}, {"1 ": " Air", "9 ": None}
    (tmp_path / "port.json").write_text(json.dumps(port))
    (tmp_path / "mode.json").write_text(json.dumps(mode, indent=2))
    found = sm.read_code_map(spark, str(tmp_path / "port.json"))
    assert rows(found) == sorted(port.items())
    found = sm.read_code_map(spark, str(tmp_path / "mode.json"), "c", "l", multi_line=True)
    assert found.columns == ["c", "l"] and rows(found) == sorted(mode.items())
    both = read_code_maps(spark, {"port": str(tmp_path / "port.json")})
    assert both.columns == ["section", "code", "label", "line_no"] and both.count() == 2


def test_malformed_code_maps_are_errors(spark, tmp_path):
    (tmp_path / "pretty.json").write_text(json.dumps({"1": "Air", "2": "Sea"}, indent=2))
    with pytest.raises(Exception, match="(?i)malformed|corrupt|parse"):
        sm.read_code_map(spark, str(tmp_path / "pretty.json")).collect()
    assert sm.read_code_map(spark, str(tmp_path / "pretty.json"), multi_line=True).count() == 2


def test_last_of_a_repeated_code_counts(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"1": "Zed", "2": "Sea"}\n\n{"2": "Lake", "1": "Air"}\n')
    found = read_code_maps(spark, {"m": str(tmp_path / "m.json")})
    facts = spark.createDataFrame([("1",), ("2",)], "code string")
    lookup = sm.Lookup(found, "code", "code", {"label": "name"}, order="line_no")
    assert rows(sm.decode(facts, [lookup])) == [("1", "Air"), ("2", "Lake")]


def test_partitioned_write_has_few_files(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=8).selectExpr("id", "id % 3 AS `a.b`")
    sm.write_parquet(df, str(tmp_path / "t"), partition_by=["a.b"])
    assert len(list((tmp_path / "t").rglob("part-*.parquet"))) <= 6
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_unreadable_output_is_no_missing_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    with pytest.raises(AnalysisException):
        sm.output_report(spark, {"t": ("parquet", str(tmp_path / "t"))})


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return "spark://host:7077" if key == "spark.master" else None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sm.scratch_path(Cluster, "x")


def test_dictionary_formats(spark, tmp_path):
    dictionary = spark.createDataFrame(
        [("port", "NYC", 'NEW "YORK"', 1), ("mode", "1", "Air", 2)],
        "section string, code string, label string, line_no int",
    )
    wanted = rows(dictionary.drop("line_no"))
    sm.write_dictionary(dictionary, str(tmp_path / "p"))
    back = sm.read_parquet(spark, str(tmp_path / "p"))
    assert rows(back.select("section", "code", "label")) == wanted
    sm.write_dictionary(dictionary, str(tmp_path / "j"), "json")
    back = sm.read_code_map(spark, str(tmp_path / "j"))
    assert rows(back.select("section", "code", "label")) == wanted
    with pytest.raises(ValueError):
        sm.write_dictionary(dictionary, str(tmp_path / "x"), "xml")


def test_scratch_follows_the_session_setting(spark, table):
    path = sm.scratch_path(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or path.startswith(shared)
    assert path != sm.scratch_path(spark, "x")
    copy = sm.materialize(table, "t")
    assert rows(copy) == rows(table) and copy.columns == table.columns
    assert "ExistingRDD" not in copy._jdf.queryExecution().executedPlan().toString()


def test_require_rows(spark):
    df = spark.range(5)
    assert sm.require_rows(df, "t", 5) is df
    sm.require_rows(spark.range(3000), "t", 2000)
    for low, needed in ((df, 6), (df.filter("id < 0"), 1), (spark.range(10), 2000)):
        with pytest.raises(AssertionError, match="required"):
            sm.require_rows(low, "t", needed)


@pytest.mark.parametrize("cache", [True, False])
def test_nothing_is_written_when_the_gate_fails(spark, tmp_path, cache):
    path = tmp_path / "t"
    with pytest.raises(AssertionError):
        write_checked(
            spark.range(0), "empty", lambda df: sm.write_parquet(df, str(path)), cache=cache
        )
    assert not path.exists()
    written = write_checked(
        spark.range(3), "t", lambda df: sm.write_parquet(df, str(path)), cache=cache
    )
    assert written == 3
    assert spark.read.parquet(str(path)).count() == 3
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_profiles(spark, table):
    assert rows(sm.null_audit(table)) == [("id", 3, 0), ("text", 3, 1), ("x", 3, 1)]
    assert rows(sm.null_audit(table, ["x"])) == [("x", 3, 1)]
    profile = sm.value_profile(table.withColumn("x", F.lit(None).cast("string")), "x")
    assert rows(profile) == [(None, 3)]
    report = sm.row_counts({"a": table, "b": table.limit(0)})
    assert rows(report) == [("a", 3, True), ("b", 0, False)]
    assert rows(sm.match_shares(table, {"text": "share"})) == [(pytest.approx(2 / 3),)]


def test_outputs(spark, table, tmp_path):
    sm.write_csv(table, str(tmp_path / "csv"))
    sm.write_parquet(table, str(tmp_path / "pq"))
    outputs = {"c": ("csv", str(tmp_path / "csv")), "p": ("parquet", str(tmp_path / "pq"))}
    assert rows(sm.require_outputs(spark, outputs, min_rows=3).select("output", "exists", "rows")) == [
        ("c", True, 3),
        ("p", True, 3),
    ]
    assert rows(sm.output_report(spark, outputs, count=False)) == [("c", True, None), ("p", True, None)]
    with pytest.raises(AssertionError, match="c, p"):
        sm.require_outputs(spark, outputs, min_rows=4)
    # Each output is checked for itself: an earlier one does not stand in for a later one.
    missing = {**outputs, "late": ("csv", str(tmp_path / "none"))}
    assert ("late", False, 0) in rows(sm.output_report(spark, missing))
    with pytest.raises(AssertionError, match="late"):
        sm.require_outputs(spark, missing)
