"""Join of a large table to a table with one row per key, safe for hot keys."""

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024

#: Tables whose scans are estimated above so many times the limit are not measured.
MEASURED_TIMES = 32

_SKETCH_GROUPS = 256
# What a frequent-items sketch can track.
_MOST_TRACKED = 1_000_000

# Words of 64 bits in a key filter: at least, at most (8 MB).
_FILTER_WORDS = (1 << 12, 1 << 20)

_SALT = "__salt"
_RIGHT = "__right_"


@dataclass(frozen=True)
class Size:
    """Bytes of all values of a table, its rows, and the bytes of its widest row."""

    bytes: int
    rows: int
    widest: int

    def with_labels(self, other: "Size") -> "Size":
        """At most so large is this table with at most one row of ``other`` joined to each row."""
        widest = self.widest + other.widest
        return Size(min(self.bytes + self.rows * other.widest, self.rows * widest), self.rows, widest)


def measured(tables: Sequence[DataFrame]) -> list[Size]:
    """Size of the values of each table, measured in ONE job that returns a row per table."""

    def size(number: int, df: DataFrame) -> DataFrame:
        widths: list[Column] = [F.lit(16)]
        for field in df.schema:
            column = F.col(f"`{field.name}`")
            kind = field.dataType.typeName()
            if kind in ("string", "binary", "varchar", "char"):
                widths.append(F.coalesce(F.octet_length(column), F.lit(0)))
            elif kind in ("array", "map", "struct", "variant"):
                widths.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
            else:
                widths.append(F.lit(16))
        row = sum(widths[1:], widths[0])
        return df.agg(
            F.lit(number).alias("n"),
            F.coalesce(F.sum(row), F.lit(0)).alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.max(row), F.lit(0)).alias("widest"),
        )

    if not tables:
        return []
    report = size(0, tables[0])
    for number, df in enumerate(tables[1:], start=1):
        report = report.unionAll(size(number, df))
    rows = sorted(report.collect(), key=lambda row: row["n"])
    return [Size(row["bytes"], row["rows"], row["widest"]) for row in rows]


def measured_bytes(tables: Sequence[DataFrame]) -> list[int]:
    return [size.bytes for size in measured(tables)]


def scanned_bytes(df: DataFrame) -> int | None:
    """What reading a table takes, by Spark's own estimate of the files it scans; None if unknown.

    No job runs for it. Filters and aggregates above the scans do not lower it: it is the work of
    measuring the table, not the size of its result.
    """
    session = df.sparkSession
    unknown = session._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size())]
    return None if any(size >= unknown for size in sizes) else sum(sizes)


def measured_within(tables: Sequence[DataFrame], limit: int) -> list[Size]:
    """The sizes of the tables that may be within ``limit`` bytes; others come with an estimate.

    A table whose scans are estimated above ``MEASURED_TIMES`` times the limit is not read: with
    any width and compression it is taken for one that is too large. With a limit of 0 no job runs.
    """
    estimates = [scanned_bytes(df) if limit > 0 else limit + 1 for df in tables]
    near = [n for n, size in enumerate(estimates) if size is None or 0 < limit and size <= MEASURED_TIMES * limit]
    found = dict(zip(near, measured([tables[n] for n in near])))
    large = [max(limit + 1, size or 0) for size in estimates]
    return [found.get(n, Size(large[n], large[n], large[n])) for n in range(len(tables))]


def fits_broadcast(tables: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> list[bool]:
    """Which tables may be broadcast: the smaller ones, as long as all of them stay within ``limit``."""
    return within_limit([size.bytes for size in measured_within(tables, limit)], limit)


def within_limit(sizes: Sequence[int], limit: int) -> list[bool]:
    fits, total = [False] * len(sizes), 0
    for number in sorted(range(len(sizes)), key=lambda n: sizes[n]):
        total += sizes[number]
        fits[number] = total <= limit
    return fits


def hot_keys(df: DataFrame, hashed: Column, partitions: int) -> dict[int, int]:
    """Hashes of the hot keys, each with the number of partitions its rows are dealt over.

    A key is hot when it fills at least two of ``partitions`` evenly filled partitions, or of 200,000
    if there are more. It gets as many partitions as it would fill. There are at most half as many hot
    keys as partitions.

    Every task reduces its rows to a frequent-items sketch of fixed size; sketches are merged in
    groups, then the groups, and one row comes back: at most a few entries per ``1 / share``. The
    error of the sketch is about a quarter of the share, so no hot key is missed.
    """
    share = min(max(2 / partitions, 10 / _MOST_TRACKED), 0.25)
    tracked, listed = ceil(10 / share), ceil(2 / share)
    sketches = (
        df.select(
            hashed.alias("h"), F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("g")
        )
        .groupBy("g")
        .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count("h").alias("n"))
    )
    # Grouped by a constant: a partial sketch cannot be merged from a partition without rows.
    total = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n")
    )
    row = total.select(F.expr(f"approx_top_k_estimate(sketch, {listed})").alias("top"), "n").first()
    if row is None:
        return {}
    even = row["n"] / partitions
    return {
        top["item"]: max(2, ceil(top["count"] / even))
        for top in row["top"]
        if top["count"] > 0.7 * share * row["n"]
    }


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Iterable[str],
    how: str = "left",
    null_safe: bool = False,
    partitions: int | None = None,
    probe: DataFrame | None = None,
    strategy: str | None = None,
    key_filter: bool = False,
) -> DataFrame:
    """Equi-join whose right side has at most one row per key, neither side broadcast by hint.

    Spark may still broadcast a side that turns out small; ``strategy="merge"`` or
    ``"shuffle_hash"`` asks for a shuffle in any case.

    Hot keys, NULL included, are looked for first, in one job that reads the key columns of
    ``probe``: ``left`` itself, or a table that is cheaper to read and has its key distribution,
    such as ``left`` before other joins. Without hot keys this is a plain join. Otherwise the rows
    of a hot key are dealt over as many shuffle partitions as they would fill (``partitions`` is
    the number in all, by default ``spark.sql.shuffle.partitions``), and only the right rows of
    hot keys are repeated as often. Both sides use the one list found, so the list only decides
    where rows go; a key listed without need, or not listed, changes nothing in the result.

    The salt of a row is a hash of its other columns (of the number of its partition if it has
    none): a task that is run again deals its rows in the same way, in whatever order they arrive,
    and filters on the left side and on what is joined later still reach the scans.

    ``key_filter`` drops left rows before the shuffle whose key is surely not on the right side, for
    inner and semi joins (see ``with_possible_keys``).

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Key columns have the same names
    on both sides and are compared in the type that holds both; the result holds the left ones.
    """
    keys = list(on)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"join type not supported: {how}")
    right, left_keys, right_keys = _join_keys(left, right, keys, how)
    if partitions is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    hashed = F.xxhash64(*left_keys)
    if key_filter and how in ("inner", "left_semi"):
        left = with_possible_keys(left, left_keys, right, right_keys)
    hot = hot_keys(left if probe is None else probe, hashed, partitions)
    condition = _equal(left_keys, right_keys, null_safe)
    if hot:
        dealt = _deal_hash(left, keys)
        left = left.withColumn(_SALT, _when_hot(hashed, hot, lambda n: F.pmod(dealt, n).cast("int"), F.lit(0)))
        salts = _when_hot(F.xxhash64(*right_keys), hot, lambda n: F.sequence(F.lit(0), n - 1), F.array(F.lit(0)))
        right = right.withColumn(_RIGHT + _SALT, F.explode(salts))
        condition.append(F.col(_SALT) == F.col(_RIGHT + _SALT))
    if strategy:
        right = right.hint(strategy)
    joined = left.join(right, condition, how)
    return joined.drop(_SALT, _RIGHT + _SALT, *[_RIGHT + key for key in keys])


def _when_hot(hashed: Column, hot: dict[int, int], value: Callable[[Column], Column], other: Column) -> Column:
    """``value`` of the number of parts for rows of a hot key, ``other`` for the rest.

    Both tests take constant time: membership is a hash set, and the numbers are in small maps, one
    for the keys of each remainder, since a literal map is searched from its start.
    """
    groups: list[list[Column]] = [[] for _ in range(len(hot))]
    for key, parts in hot.items():
        groups[key % len(hot)] += [F.lit(key), F.lit(parts)]
    none = F.create_map().cast("map<bigint,int>")
    maps = F.array(*[F.create_map(*group).cast("map<bigint,int>") if group else none for group in groups])
    parts = F.get(maps, F.pmod(hashed, F.lit(len(hot))))[hashed]
    return F.when(hashed.isin(*hot), value(parts)).otherwise(other)


def with_possible_keys(
    left: DataFrame,
    left_keys: Sequence[Column],
    right: DataFrame,
    right_keys: Sequence[Column],
    words: int | None = None,
) -> DataFrame:
    """The left rows whose key may be on the right side: all that are, and few of the others.

    A Bloom filter of the right keys, two bits a key, is made by one aggregation: tasks combine the
    words of their rows, the words of all tasks are combined by shuffle, and one row of ``words``
    numbers results. It follows the estimated size of the right side up to 8 MB and no further, so
    with many more keys than bits fewer rows are dropped and the result stays right. It is a scalar
    subquery: one plan, and left rows are tested where they are scanned.
    """
    if words is None:
        # Some 8 bits for each 16 bytes of the scanned files.
        wanted = max((scanned_bytes(right) or 0) // 128, 1)
        words = min(max(1 << (wanted - 1).bit_length(), _FILTER_WORDS[0]), _FILTER_WORDS[1])

    def places(keys: Sequence[Column]) -> list[tuple[Column, Column]]:
        """Word and bit of a key, twice: the low and the high end of its hashes."""
        hashes = [F.xxhash64(F.lit(seed), *keys) for seed in (1, 2)]
        return [(F.pmod(h, F.lit(words)).cast("int"), F.shiftrightunsigned(h, 58).cast("int")) for h in hashes]

    marks = F.array(*[
        F.struct(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mask"))
        for word, bit in places(right_keys)
    ])
    known = right.filter(reduce(lambda a, b: a & b, (key.isNotNull() for key in right_keys)))
    found = known.select(F.inline(marks))
    # Every word is there, so its place in the sorted array is its number.
    empty = right.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    whole = found.unionAll(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    row = F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"])
    bits = whole.agg(row.alias("bits")).scalar()
    tests = [F.bit_get(F.get(bits, word), bit) == 1 for word, bit in places(left_keys)]
    return left.filter(reduce(lambda a, b: a & b, tests))


def broadcast_join(
    left: DataFrame, right: DataFrame, on: Iterable[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """The same join with the right side broadcast; only for a right side of checked size."""
    keys = list(on)
    right, left_keys, right_keys = _join_keys(left, right, keys, how)
    joined = left.join(F.broadcast(right), _equal(left_keys, right_keys, null_safe), how)
    return joined.drop(*[_RIGHT + key for key in keys])


def new_keys_only(
    df: DataFrame, existing: DataFrame, on: Iterable[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``, which may repeat its keys.

    The keys of ``existing`` are measured: small ones are broadcast, others joined by a shuffle.
    """
    keys = list(on)
    listed = existing.select(*[F.col(f"`{key}`") for key in keys])
    if fits_broadcast([listed], broadcast_bytes)[0]:
        return broadcast_join(df, listed.distinct(), keys, "left_anti")
    return skew_join(df, listed.distinct(), keys, "left_anti")


def _deal_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Something to deal rows of one key by: the columns that are no keys and can be hashed."""
    others = [
        F.col(f"`{field.name}`")
        for field in df.schema
        if field.name not in keys and not _holds_map(field.dataType)
    ]
    return F.xxhash64(*others) if others else F.spark_partition_id()


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def _join_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> tuple[DataFrame, list[Column], list[Column]]:
    """The right side with its keys renamed, and the keys to compare, alike in type."""
    taken = {name.lower() for name in left.columns}
    clash = [name for name in right.columns if name not in keys and name.lower() in taken]
    if clash and how in ("left", "inner"):
        raise ValueError(f"columns on both sides: {clash}")
    left_keys, right_keys = [], []
    for key in keys:
        ours, theirs = F.col(f"`{key}`"), F.col(f"`{_RIGHT}{key}`")
        kind = left.schema[key].dataType
        if kind != right.schema[key].dataType:
            both = left.select(f"`{key}`").unionAll(right.select(f"`{key}`"))
            kind = both.schema[key].dataType
            ours, theirs = ours.cast(kind), theirs.cast(kind)
        if kind.typeName() in ("float", "double"):
            # -0.0 and 0.0 are equal as join keys, so they must hash alike.
            ours, theirs = ours + F.lit(0.0), theirs + F.lit(0.0)
        left_keys.append(ours)
        right_keys.append(theirs)
    return right.withColumnsRenamed({key: _RIGHT + key for key in keys}), left_keys, right_keys


def _equal(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> list[Column]:
    return [a.eqNullSafe(b) if null_safe else a == b for a, b in zip(left, right)]
