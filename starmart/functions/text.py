"""Text and date expressions. All are built-in Spark functions, so they stay in codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` alone removes blanks only)."""
    return F.trim(text, F.lit(" \t\n\x0b\f\r"))


def remove_characters(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character))
    return text


def first_part(text: Column, separator: str) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def last_part(text: Column, separator: str) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(-1))


def city_of(label: str | Column) -> Column:
    """City name from a place label: ``"  NEW YORK, NY "`` gives ``"New York"``.

    A label without a comma is used whole, so ``"WASHINGTON DC"`` gives ``"Washington Dc"``.
    """
    text = F.col(f"`{label}`") if isinstance(label, str) else label
    return F.initcap(F.split(F.trim(text), ",").getItem(0))


def joined_key(*columns: str, separator: str = "_") -> Column:
    """One text key from several columns; NULL as soon as one of them is NULL."""
    parts = [F.col(f"`{columns[0]}`")]
    for name in columns[1:]:
        parts += [F.lit(separator), F.col(f"`{name}`")]
    return F.concat(*parts)


def as_date(value: str | Column) -> Column:
    """Date of a date, timestamp or text column; malformed text gives NULL."""
    column = F.col(f"`{value}`") if isinstance(value, str) else value
    return column.try_cast("date")


def year_of(value: str | Column) -> Column:
    return F.year(as_date(value))


def month_of(value: str | Column) -> Column:
    return F.month(as_date(value))
