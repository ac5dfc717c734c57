"""Label texts with very many quotes."""

import pytest
from conftest import rows

import starmart as sm


@pytest.mark.parametrize("count", [1, 1000, 100_000])
def test_labels_of_many_quotes(spark, count):
    """Doubled quotes are apostrophes, in any number, and shield a comment sign among them."""
    text = "value q\n1 = '" + "''" * count + "/* no comment */" + "''" * count + "'\n2 = 'b' /* gone */\n"
    docs = spark.createDataFrame([("d", text)], "path string, value string")
    found = rows(sm.label_dictionary(docs).select("code", "label"))
    assert found == [("1", "'" * count + "/* no comment */" + "'" * count), ("2", "b")]
