"""Decoding of a fact table through code dictionaries."""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import strip
from starmart.operators.joins import (
    BROADCAST_BYTES,
    broadcast_join,
    measured_within,
    skew_join,
    within_limit,
)
from starmart.operators.trailing import latest_per_key


@dataclass(frozen=True)
class Lookup:
    """One dictionary and how the fact table refers to it.

    ``column`` is the code column of the fact table (or of an earlier lookup's labels), ``code``
    the one of ``table``; ``labels`` maps label columns of ``table`` to their names in the result.

    ``numeric`` compares codes as numbers, for text codes such as ``"582 "`` against ``582.0``, to
    the last digit (see ``number_key``); text that is no number matches nothing. Otherwise codes must
    be equal in their own type.

    ``required`` drops the rows whose code is not in the dictionary, as a rule on its labels would do
    later; with a large dictionary most of them go before they are shuffled. A required dictionary of
    dictionary labels makes that one required too.

    A code found several times gives one row: the one with the largest ``order`` value (then the
    largest labels), so the fact table keeps its row count. ``unique`` states that codes are not
    repeated and saves that step.
    """

    table: DataFrame
    column: str
    code: str
    labels: Mapping[str, str]
    numeric: bool = False
    order: str | None = None
    unique: bool = False
    required: bool = False

    def entries(self) -> DataFrame:
        """The dictionary as ``column``, the label columns and ``__order``; codes may repeat."""
        code = F.col(f"`{self.code}`")
        key = number_key(code, self.table.schema[self.code].dataType) if self.numeric else code
        labels = [F.col(f"`{name}`").alias(new) for name, new in self.labels.items()]
        order = [F.col(f"`{self.order}`").alias("__order")] if self.order else []
        return self.table.filter(key.isNotNull()).select(key.alias(self.column), *order, *labels)

    def rows(self, entries: DataFrame) -> DataFrame:
        """``column`` and the label columns of the entries, one row per code."""
        if self.unique:
            return entries.drop("__order")
        order = ["__order"] if self.order else []
        return latest_per_key(entries, [self.column], order, list(self.labels.values()))


def decode(
    fact: DataFrame,
    lookups: Iterable[Lookup],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join every lookup to the fact table; unknown codes give NULL labels, or drop the row if required.

    A lookup by a label of an earlier one is joined to the dictionary of that one, so the fact
    table is joined once for each of its own code columns.

    Dictionaries whose files are not much larger than ``broadcast_bytes`` are measured in one small
    job, with their repeated codes, so that measuring shuffles nothing; others are large without a look. Those within ``broadcast_bytes`` together are broadcast and the fact table is
    not shuffled; a larger one is joined by a shuffle that deals the rows of hot codes over several
    partitions. Hot codes are looked for in the table that has them, before it is joined to any
    other. With ``broadcast_bytes=0`` every join is a shuffle.
    """
    lookups = list(lookups)
    entries = [lookup.entries() for lookup in lookups]
    sizes = measured_within(entries, broadcast_bytes)
    required = [lookup.required for lookup in lookups]
    tables = [lookup.rows(table) for lookup, table in zip(lookups, entries)]
    roots = []
    for number in reversed(range(len(lookups))):
        column = lookups[number].column
        parent = _parent(lookups[:number], column) if column not in fact.columns else None
        if parent is None:
            roots.append(number)
            continue
        small = sizes[number].bytes <= broadcast_bytes
        how = "inner" if required[number] else "left"
        tables[parent] = _join(
            tables[parent], tables[number], lookups[number], small, entries[parent], broadcast_bytes, how
        )
        required[parent] |= required[number]
        sizes[parent] = sizes[parent].with_labels(sizes[number])
    roots.reverse()
    decoded = fact
    fits = within_limit([sizes[number].bytes for number in roots], broadcast_bytes)
    for number, small in zip(roots, fits):
        how = "inner" if required[number] else "left"
        decoded = _join(decoded, tables[number], lookups[number], small, fact, broadcast_bytes, how)
    labels = [new for lookup in lookups for new in lookup.labels.values()]
    return decoded.select(*[F.col(f"`{name}`") for name in [*fact.columns, *labels]])


def _parent(lookups: Sequence[Lookup], column: str) -> int | None:
    """The lookup whose labels include the code column."""
    found = [n for n, lookup in enumerate(lookups) if column in lookup.labels.values()]
    return found[-1] if found else None


def _join(
    left: DataFrame,
    table: DataFrame,
    lookup: Lookup,
    small: bool,
    probe: DataFrame,
    broadcast_bytes: int,
    how: str,
) -> DataFrame:
    key = lookup.column
    if lookup.numeric:
        key = f"__key_{lookup.column}"
        number = number_key(F.col(f"`{lookup.column}`"), left.schema[lookup.column].dataType)
        table = table.withColumnRenamed(lookup.column, key)
        left, probe = left.withColumn(key, number), probe.withColumn(key, number)
    if small:
        joined = broadcast_join(left, table, [key], how)
    else:
        strategy = "merge" if broadcast_bytes <= 0 else None
        joined = skew_join(
            left, table, [key], how, probe=probe, strategy=strategy, key_filter=lookup.required
        )
    return joined.drop(key) if lookup.numeric else joined


# Sign, digits before and after the point, and exponent; no part can match in two ways.
_NUMBER = r"^([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d+))?\z"
_PARTS = "$1:$2:$3:$4:"


def number_key(code: Column, kind: T.DataType) -> Column:
    """Numbers as texts that are equal if and only if the numbers are, whatever their size.

    The text is the sign, the digits without zeros at either end, and the place of the point:
    ``"582 "``, ``582.0``, ``"+5.82E2"`` and ``"0582."`` all give ``582e3``; 4e-10 and 0 differ.
    Floating point numbers count as the decimal number that Spark writes for them. NULL, NaN, infinite
    numbers, text that is no number, and exponents beyond 64 bits give NULL.
    """
    text = code.cast("string")
    if kind.typeName() in ("byte", "short", "integer", "long"):
        sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        whole = F.ltrim(text, F.lit("-"))
        return _number_text(sign, F.rtrim(whole, F.lit("0")), F.length(whole))
    parts = F.split(F.regexp_replace(strip(text), _NUMBER, _PARTS), ":")
    # As a bound variable the parts are found once and stand once in the plan.
    return F.transform(F.array(parts), _number_of_parts).getItem(0)


def _number_of_parts(parts: Column) -> Column:
    sign, whole, tail, power = (F.get(parts, F.lit(n)) for n in range(4))
    digits = F.concat(whole, tail)
    significant = F.ltrim(digits, F.lit("0"))
    place = F.length(whole) - F.length(digits) + F.length(significant)
    power = F.when(power == "", F.lit(0)).otherwise(power.try_cast("long"))
    number = _number_text(F.replace(sign, F.lit("+")), F.rtrim(significant, F.lit("0")), place + power)
    # What the pattern did not match is not in five parts.
    return F.when((F.size(parts) == 5) & (digits != ""), number)


def _number_text(sign: Column, digits: Column, place: Column) -> Column:
    number = F.concat(sign, digits, F.lit("e"), place.cast("string"))
    return F.when(digits == "", F.lit("0")).otherwise(number)
