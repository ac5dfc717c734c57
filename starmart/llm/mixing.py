"""Mixing sources to target weights by Pfair scheduling.

The stream is cut into slots of one block (``block_rows`` rows of one source). A source of weight w
owes a block every 1/w slots: its block k is released at slot floor(k/w) and due before slot
ceil((k+1)/w). In each slot, of the released blocks the one with the earliest deadline goes next
(ties by source name). Weights add to 1, so no slot is idle, no deadline is missed, and after every
slot each source has had its share of blocks to within less than one block.

Weights are exact (ratios of whole numbers) and the windows are those of the whole stream: nothing is
rounded, and there may be any number of sources. The schedule is made by one task that keeps one
block of each source at a time and gets no rows, only their counts; its slots are written as a
scratch table and joined to the rows by source and block. It takes time for each block of
``block_rows`` rows of the stream and memory for each source.

A source that has given all its rows starts over, so that the weights hold to the end; the stream
ends with the slot in which the last source has given all its rows. So every row is in the stream
at least once. ``repeats`` can be read off the result (``epoch``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starmart.llm.ordinals import with_ordinals
from starmart.llm.tables import materialize, name

BLOCK_ROWS = 64
#: Weights in proportion to this power of the rows of a source, if none are given: between the
#: natural mix (1) and equal shares (0). A hot source shrinks, and small ones are repeated a little.
FLATTEN = 0.8

#: Slots of at most so many blocks are sent to every executor; more are joined by shuffle.
_SENT_BLOCKS = 1 << 19
#: So many sources, those with the most rows, are joined without a shuffle.
_SENT_SOURCES = 10_000
_BATCH_ROWS = 1 << 16


def whole_weights(weights: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Shares of ``period`` slots that add to ``period``, at least one each, by largest remainders."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources do not fit in a period of {period} slots")
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    total = float(sum(weights.values()))
    exact = {s: w / total * period for s, w in weights.items()}
    shares = {s: max(1, int(e)) for s, e in exact.items()}
    rank = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is not None, s or ""))
    left = period - sum(shares.values())
    for s in rank[: max(0, left)]:
        shares[s] += 1
    while sum(shares.values()) > period:
        shares[max(shares, key=lambda s: (shares[s], s is not None, s or ""))] -= 1
    return shares


def exact_shares(weights: Sequence[float | Fraction]) -> list[int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = lcm(*(w.denominator for w in exact))
    return [int(w * scale) for w in exact]


def stream_slots(shares: Sequence[int], needed: Sequence[int]) -> Iterator[int]:
    """The source of each slot until every one has given ``needed`` blocks, at least one each.

    Earliest deadline first among released blocks, ties by the order of the sources.
    """
    total = sum(shares)
    given = [0] * len(shares)
    ready = [(-(-total // share), source) for source, share in enumerate(shares)]
    heapq.heapify(ready)
    waiting: list[tuple[int, int]] = []
    slot, unfinished = 0, len(shares)
    while unfinished:
        while waiting and waiting[0][0] <= slot:
            source = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(given[source] + 1) * total // shares[source]), source))
        due, source = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline is missed")
        yield source
        given[source] += 1
        slot += 1
        unfinished -= given[source] == needed[source]
        heapq.heappush(waiting, (given[source] * total // shares[source], source))


def _in_order(sources: Sequence) -> list[int]:
    """Places of the sources by name, null first."""
    return sorted(range(len(sources)), key=lambda i: (sources[i] is not None, "" if sources[i] is None else sources[i]))


def pfair_slots(shares: Mapping[str | None, int]) -> list[tuple[str | None, int]]:
    """(source, block) of each slot until every source has given its share of blocks."""
    names = list(shares)
    names = [names[i] for i in _in_order(names)]
    sizes = [shares[s] for s in names]
    given = dict.fromkeys(names, -1)
    slots = []
    for source in stream_slots(sizes, sizes):
        given[names[source]] += 1
        slots.append((names[source], given[names[source]]))
    return slots


def _schedule(counted: DataFrame, weights: Mapping[str | None, float] | None, block_rows: int) -> DataFrame:
    """(__s, __rows, __block, __slot) of all blocks of the stream, from (__s, __rows) of the sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        sources = pa.chunked_array([b["__s"] for b in table]).combine_chunks()
        rows = pa.chunked_array([b["__rows"] for b in table]).combine_chunks()
        order = pa.array(_in_order(sources.to_pylist()), pa.int64())
        sources, rows = sources.take(order), rows.take(order)
        sizes = rows.to_pylist()
        if weights is None:
            chosen = [float(n) ** FLATTEN for n in sizes]
        else:
            chosen = [weights[s] for s in sources.to_pylist()]
        given = [0] * len(sizes)
        which: list[int] = []
        blocks: list[int] = []
        first = 0

        def batch() -> pa.RecordBatch:
            at = pa.array(which, pa.int64())
            slots = pa.array(range(first, first + len(which)), pa.int64())
            return pa.RecordBatch.from_arrays(
                [sources.take(at), rows.take(at), pa.array(blocks, pa.int64()), slots],
                names=["__s", "__rows", "__block", "__slot"],
            )

        for source in stream_slots(exact_shares(chosen), [-(-n // block_rows) for n in sizes]):
            which.append(source)
            blocks.append(given[source])
            given[source] += 1
            if len(which) == _BATCH_ROWS:
                yield batch()
                first += len(which)
                which.clear()
                blocks.clear()
        yield batch()

    new = [StructField(c, LongType()) for c in ("__rows", "__block", "__slot")]
    schema = StructType([counted.schema["__s"], *new])
    return counted.repartition(1).mapInArrow(run, schema)


def mix_sources(
    df: DataFrame,
    keys: Sequence[str],
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
) -> DataFrame:
    """Rows of ``df`` as often as the mix takes them, with their places in the stream.

    New columns (existing ones of these names are replaced): ``slot`` (block of the stream),
    ``position`` (row of the stream, gapless from 0), ``block`` (number among the blocks of the
    source), ``epoch`` (how often the source had been through before). Null is a source of its own.
    Rows of a source are dealt in an order of hashes of ``keys``. ``weights`` must name every source
    (others are not needed); without it they follow ``FLATTEN``. There may be any number of sources,
    and weights are exact. Only a ``period`` rounds them to multiples of 1/``period``, at least one
    each; then there may be at most so many sources. An empty table gives an empty stream.
    """
    df = df.drop("slot", "position", "block", "epoch")
    counted = df.groupBy(name(source).alias("__s")).agg(F.count(F.lit(1)).alias("__rows"))
    if weights is not None or period is not None:
        counted = materialize(counted, "mix-sources")
        known = counted if period is None else counted.limit(period + 1)
        rows = {row["__s"]: row["__rows"] for row in known.collect()}
        if weights is not None:
            missing = [s for s in rows if s not in weights]
            if missing:
                raise ValueError(f"no weight for sources {missing[:10]}")
            weights = {s: weights[s] for s in rows}
            if any(not w > 0 for w in weights.values()):
                raise ValueError("weights must be positive")
        if period is not None:
            chosen = weights or {s: float(n) ** FLATTEN for s, n in rows.items()}
            weights = whole_weights(chosen, period) if rows else {}
    slots = materialize(_schedule(counted, weights, block_rows), "mix-slots")
    plan = slots.groupBy("__s", "__rows").agg((F.count(F.lit(1)) * block_rows).alias("__given"))
    numbered = with_ordinals(df, source, [name(k) for k in keys], "__row")

    def planned(part: DataFrame) -> DataFrame:
        return numbered.join(part, name(source).eqNullSafe(F.col("__s"))).drop("__s")

    if plan.limit(_SENT_SOURCES + 1).count() <= _SENT_SOURCES:
        joined = planned(F.broadcast(plan))
    else:
        # No source of the rest has more than a ten thousandth of the rows.
        plan = materialize(plan, "mix-plan")
        large = materialize(plan.orderBy(F.desc("__rows"), "__s").limit(_SENT_SOURCES), "mix-large")
        others = large.select(F.col("__s").alias("__large"))
        rest = plan.join(F.broadcast(others), F.col("__s").eqNullSafe(F.col("__large")), "left_anti")
        joined = planned(F.broadcast(large)).unionByName(planned(rest))
    # A row far down the stream can be past its end, in the epoch that the end cuts.
    issued = joined.filter("__row < __given").withColumn(
        "__at", F.explode(F.expr("sequence(__row, __given - 1, __rows)"))
    )
    issued = issued.withColumn("block", F.expr(f"__at div {block_rows}"))
    places = slots.select("__s", "__block", F.col("__slot").alias("slot"))
    if slots.count() <= _SENT_BLOCKS:
        places = F.broadcast(places)
    found = issued.join(
        places, name(source).eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__block"))
    )
    position = F.col("slot") * block_rows + F.pmod(F.col("__at"), F.lit(block_rows))
    return (
        found.withColumn("position", position)
        .withColumn("epoch", F.expr("__at div __rows"))
        .select(*[name(c) for c in df.columns], "slot", "position", "block", "epoch")
    )
