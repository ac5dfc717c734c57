"""Label documents read in splits: the dictionary of the in-row form, whatever the blocks."""

import random

import pytest
from conftest import rows
from test_labels import DEFAULT, DOCUMENT, _random_document

import starmart as sm
from starmart.operators.label_splits import split_label_entries
from starmart.operators.labels import label_entries


@pytest.fixture(params=["40b", "150b", "1m"])
def blocks(request, spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    spark.conf.set(keys[0], request.param)
    spark.conf.set(keys[1], "0b")
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def both(spark, path):
    """Entries and dictionaries of both forms."""
    docs = sm.read_documents(spark, str(path))
    columns = ["path", "section", "section_no", "code", "label", "line_no"]
    found = rows(split_label_entries(spark, str(path)).select(*columns))
    assert found == rows(label_entries(docs).select(*columns))
    columns.remove("section_no")
    return rows(sm.split_label_dictionary(spark, str(path)).select(*columns)), rows(sm.label_dictionary(docs).select(*columns))


def test_the_known_document(spark, blocks, tmp_path):
    (tmp_path / "a.txt").write_text(DOCUMENT)
    found, want = both(spark, tmp_path)
    assert found == want and {row[1:] for row in found} == DEFAULT


ODD_LINES = [
    "value one", " VALUE $two ;", "value x /* c */", "/* c */ value y", "/*", "*/", "/* a", "b */ 3 = 'c'", "x = 'a /* b'",
    "'a */ b' = 1", "k = 'v'", "k = 'w' /* to", "= '*/ = '/*'", "= */ '/*", "1 = '*/' /* = 'x'", "/*/", "**//**", "",
    "9 = 'it''s' ;", "a /* b */ c /* d", "é = 'ü' */ z", "\x01\x02 = 'c'", "/* value three", "value four", "2 = /* x", "'' */",
]


def test_random_lines(spark, blocks, tmp_path):
    """Comment signs, quotes and sections in any order."""
    rng = random.Random(blocks)
    for number in range(25):
        lines = rng.choices(ODD_LINES, k=rng.randint(1, 40))
        end = rng.choice(["\n", "\n", "\r\n", "\r"])
        (tmp_path / f"{number}.txt").write_bytes(end.join(lines).encode() + rng.choice([b"", end.encode()]))
    found, want = both(spark, tmp_path)
    assert found == want and len(found) > 30


def test_random_documents(spark, blocks, tmp_path):
    rng = random.Random(3)
    for number in range(12):
        (tmp_path / f"{number:03}.txt").write_text(_random_document(rng)[0])
    found, want = both(spark, tmp_path)
    assert found == want and len(found) > 30


def test_one_large_document_and_a_comment_over_blocks(spark, tmp_path):
    keys = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(keys)
    lines = [f"'k{n}' = 'label {n} / x'" for n in range(12_000)]
    lines[3000] = "'k3000' = /* long"
    lines[3001:9000] = ["out = 'of order' "] * 5999
    lines[9000] = "*/ 'late'"
    (tmp_path / "a.txt").write_text("value $big\n" + "\n".join(lines) + "\n")
    spark.conf.set(keys, "20k")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 8
        found = {r["code"]: (r["label"], r["line_no"]) for r in sm.split_label_dictionary(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set(keys, before)
    want = {f"k{n}": (f"label {n} / x", n + 2) for n in (*range(3000), *range(9001, 12_000))}
    assert found == want | {"k3000": ("late", 3002)}


def test_files_without_entries(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "b.txt").write_text("1 = 'no section'\n")
    assert sm.split_label_dictionary(spark, str(tmp_path)).count() == 0
