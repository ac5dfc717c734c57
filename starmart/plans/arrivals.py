"""The fact table: arrivals decoded, cleaned of invalid labels, with the city of arrival."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import city_of
from starmart.operators.clean import LabelRule, drop_columns, drop_invalid_labels
from starmart.operators.lookup import Lookup, decode
from starmart.operators.quality import write_gated
from starmart.sources.readers import read_parquet
from starmart.sources.writers import write_parquet

# Dictionary section, code column, label column, whether codes are numbers.
LOOKUPS = (
    ("i94prtl", "i94port", "Port", False),
    ("i94cntyl", "i94cit", "Origin_Country", True),
    ("i94model", "i94mode", "Travelmode", True),
    ("i94addrl", "i94addr", "Destination", False),
    ("i94visa", "i94visa", "Visa", True),
)

# Columns that are not kept.
DROPPED = (
    "visapost",
    "occup",
    "entdepu",
    "count",
    "admnum",
    "matflag",
    "dtaddto",
    "insnum",
    "fltno",
    "i94cit",
    "i94mode",
    "i94addr",
    "i94visa",
)

# Labels that make a record invalid.
RULES = (
    LabelRule("Port", ("No PORT Code", "Collapsed")),
    LabelRule("Origin_Country", ("INVALID", "Collapsed")),
    LabelRule("Travelmode"),
    LabelRule("Destination"),
)


def lookups(dictionary: DataFrame, rules: Sequence[LabelRule] = ()) -> list[Lookup]:
    """The five lookups from a dictionary ``section, code, label`` (and ``line_no``).

    Those whose labels a rule would not let pass without an entry are required.
    """
    needed = {rule.column for rule in rules if rule.required or rule.markers}
    order = "line_no" if "line_no" in dictionary.columns else None
    return [
        Lookup(
            dictionary.filter(F.col("section") == section),
            column,
            "code",
            {"label": label},
            numeric=numeric,
            order=order,
            required=label in needed,
        )
        for section, column, label, numeric in LOOKUPS
    ]


def arrivals(
    raw: DataFrame, dictionary: DataFrame, rules: Sequence[LabelRule] = RULES
) -> DataFrame:
    decoded = drop_columns(decode(raw, lookups(dictionary, rules)), DROPPED)
    valid = drop_invalid_labels(decoded, rules)
    return valid.withColumn("City", city_of("Port")).drop("Port")


def run(
    spark: SparkSession,
    source: str,
    dictionary: DataFrame,
    out: str,
    partition_by: Sequence[str] = (),
) -> int:
    result = arrivals(read_parquet(spark, source), dictionary)
    return write_gated(
        result, "arrivals", out, lambda df, path: write_parquet(df, path, partition_by=partition_by)
    )
