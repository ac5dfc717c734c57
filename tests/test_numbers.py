"""Numbers as join keys: equal if and only if their values are."""

from decimal import Decimal, InvalidOperation
from itertools import product

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import starmart as sm
from starmart.operators.lookup import number_key


def keys_of(spark, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = df.select("i", number_key(F.col("v"), df.schema["v"].dataType).alias("k")).orderBy("i")
    return [row["k"] for row in found.collect()]


def value_of(text):
    if "_" in text:  # Python's own form
        return None
    try:
        number = Decimal(text.strip(" \t\n\x0b\f\r"))
    except InvalidOperation:
        return None
    return number if number.is_finite() else None


def test_texts_in_all_forms(spark):
    heads = ["", "+", "-", " ", "0", "-00", "1", "10", "-1", "120.", ".", "."]
    tails = ["", "0", "5", "50", ".5", ".05", ".50", "e1", "E-1", "e+01", ".e1", "  ", "\n", "x", "_1", "e", ".0.0", "00"]
    texts = [head + tail for head, tail in product(heads, tails)]
    values = [value_of(text) for text in texts]
    keys = keys_of(spark, texts)
    for text, value, key in zip(texts, values, keys):
        assert (key is None) == (value is None), text
    known = [(v, k, t) for v, k, t in zip(values, keys, texts) if v is not None]
    for (a, key_a, text_a), (b, key_b, text_b) in product(known, known):
        assert (a == b) == (key_a == key_b), (text_a, text_b)


digits = st.text("0123456789", max_size=40)
numbers = st.builds(
    lambda sign, whole, tail, power: f"{sign}{whole}.{tail}" + ("" if power is None else f"e{power}"),
    st.sampled_from(["", "-", "+"]),
    digits,
    digits,
    st.none() | st.integers(-60, 60),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(numbers, min_size=60, max_size=60))
def test_random_numbers(spark, texts):
    # Each number again in another form.
    texts = texts + [str(value) for value in map(value_of, texts) if value is not None]
    values = [value_of(text) for text in texts]
    keys = keys_of(spark, texts)
    assert len({v for v in values if v is not None}) == len({k for k in keys if k is not None})
    by_value = {}
    for value, key in zip(values, keys):
        assert by_value.setdefault(value, key) == key


def test_types(spark):
    same = keys_of(spark, ["-120", "0", "7"])
    for kind in ("byte", "short", "int", "long"):
        assert keys_of(spark, [-120, 0, 7], kind) == same
    for kind in ("float", "double"):
        assert keys_of(spark, [-120.0, -0.0, 7.0], kind) == same
    assert keys_of(spark, [Decimal("-120.000"), Decimal("0"), Decimal("7.0")], "decimal(20,3)") == same
    assert keys_of(spark, [float("nan"), float("inf"), -float("inf"), None], "double") == [None] * 4
    assert keys_of(spark, [0.1, 1e300, 5e-324], "double") == keys_of(spark, ["0.1", "1e300", "4.9E-324"])
    assert keys_of(spark, [-(2**63), 2**63 - 1], "long") == keys_of(spark, ["-9223372036854775808", "9223372036854775807"])
    assert keys_of(spark, ["1e99999999999999999999", "1e999999999999999999"])[0] is None


@pytest.mark.parametrize("limit", [sm.BROADCAST_BYTES, 0])
def test_nothing_is_rounded_in_a_lookup(spark, limit):
    codes = spark.createDataFrame(
        [("0", "zero"), ("1.0000000001", "over one"), ("123456789012345678901234567890", "long"), ("1e40", "large")],
        "code string, label string",
    )
    facts = [(0.0, "zero"), (4e-10, None), (1.0, None), (1.0000000001, "over one"), (1e40, "large"), (None, None)]
    df = spark.createDataFrame([(value,) for value, _ in facts], "x double")
    found = sm.decode(df, [sm.Lookup(codes, "x", "code", {"label": "found"}, numeric=True)], limit)
    assert rows(found) == sorted(facts, key=repr)
    texts = spark.createDataFrame([("123456789012345678901234567890",), ("123456789012345678901234567891",)], "x string")
    found = sm.decode(texts, [sm.Lookup(codes, "x", "code", {"label": "found"}, numeric=True)], limit)
    assert [r[1] for r in rows(found)] == ["long", None]
