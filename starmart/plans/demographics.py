"""City demographics with one column per race."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.pivot import MAX_CATEGORIES, attach_pivot
from starmart.operators.quality import write_gated
from starmart.schemas import DEMOGRAPHICS
from starmart.sources.readers import read_csv
from starmart.sources.writers import write_csv

KEYS = ("City", "State")


def demographics(
    raw: DataFrame,
    races: Sequence[str] | None = None,
    distinct: bool = True,
    parity: bool = False,
    max_categories: int = MAX_CATEGORIES,
) -> DataFrame:
    """``races`` names the columns; without it the races found in the data are used.

    ``parity`` keeps one row per source row, leaves the cells of a NULL city or state NULL and has
    cells of 32 bits.
    """
    return attach_pivot(
        raw,
        KEYS,
        "Race",
        "Count",
        races,
        distinct=distinct and not parity,
        null_safe=not parity,
        cell_type="int" if parity else "bigint",
        max_categories=max_categories,
    )


def run(
    spark: SparkSession,
    source: str,
    out: str,
    races: Sequence[str] | None = None,
    parity: bool = False,
    max_categories: int = MAX_CATEGORIES,
) -> int:
    raw = read_csv(spark, source, DEMOGRAPHICS, sep=";")
    result = demographics(raw, races, parity=parity, max_categories=max_categories)
    return write_gated(result, "demographics", out, write_csv)
