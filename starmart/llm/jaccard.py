"""N-gram Jaccard join with token-combination prefixes.

The tokens of a document are its distinct shingles of five words. Two documents link when the
shingles they share are at least 80 % of those that either has.

Tokens have one order for all documents: rare ones first, then frequent ones, each by hash. A set of
n tokens shares at least ceil(0.8 n) with any partner, so two partners share a token among the first
n - ceil(0.8 n) + 1 of each, the prefix. Rare tokens of the prefix are indexed one by one. A prefix
that is longer by k - 1 holds k common tokens; so where it is rare throughout, it is extended by 5 %
of the set, and only pairs with that many common tokens in it are candidates.

Where a prefix reaches frequent tokens, single ones would bring together all documents with a common
passage. Then the prefix is extended by C tokens and the frequent ones are dealt by hash to C
classes. Partners without a common rare token share at least C + 1 frequent ones there, so two of one
class: the pairs of tokens within each class are indexed. C follows from the size of the sets; each
set is indexed for its own band of sizes and for the next one, so partners meet in one of them.

Frequent tokens are marked in a bitmap of bounded size. Every frequent one is found in it; where it
fills up, rare ones are taken for frequent as well. As all sets are marked alike no link is lost, and
a set has at most a few signatures for each of its tokens either way.

Candidates are verified on whole sets. Equal sets are one class throughout. Rare lists are bounded,
so all their pairs are candidates, as are those of short lists of token combinations. Long lists
overlap: sets that they connect form a crowd. It is dealt into parts of bounded size, and each part
is compared with itself and with a few representatives of the crowd. That joins a family of copies
to one component; only sets outside the largest one are then compared with other parts. Of a crowd,
links that join components come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import connected_components
from starmart.llm.shingles import WORDS, fingerprint, shingle_sets
from starmart.llm.tables import batches_of, materialize, name, pieces_of, shuffle_partitions
from starmart.llm.words import mix

PERCENT = 80
#: A token is frequent when more than so many sets have it.
FREQUENT_SETS = 64
#: Bits of the bitmap of frequent tokens: so many for each of them, between bounds.
MARK_BITS = 64
LEAST_MARKS = 1 << 20
MOST_MARKS = 1 << 28
#: A list of a token combination of more sets makes a crowd.
SHORT_LIST = 8
RANGE_TOKENS = 4_000_000

#: Bits of the sketch of a set, and of the filter that tells which sets a pair still needs.
SKETCH_BITS = 2048
FILTER_BITS = 1 << 26

_BATCH_BYTES = 16 << 20
_PART_BYTES = 4 << 20
_LOW = np.uint64(0xFFFFFFFF)
_EXTENSION_PERCENT = 5
#: At most about so many sets, and so many tokens of them, are in a part of a crowd.
PART_SETS = 512
PART_TOKENS = 400_000
REPRESENTATIVES = 8
_STEP = np.log(1.25)


def _distinct_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(class, tokens) of each distinct set that is not empty, once in a batch."""
    seen = set()
    for part in batches_of(batch, "text", _PART_BYTES):
        for tokens in shingle_sets(part["text"], words):
            key = fingerprint(tokens)
            if len(tokens) and key not in seen:
                seen.add(key)
                yield key, tokens


def _ranges(tokens: np.ndarray, ranges: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)


def _short(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """Range and low 32 bits: what stands for a token where being taken for another only costs time."""
    return (_ranges(tokens, ranges) << 32) | (tokens & _LOW).astype(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Bits of all tokens. Each bit that two sketches do not share is a token that the sets do not."""
    bits = np.zeros(SKETCH_BITS, bool)
    bits[(tokens >> np.uint64(20)) % np.uint64(SKETCH_BITS)] = True
    return np.packbits(bits).tobytes()


def set_table(docs: DataFrame, id_column: str, text: str, words: int = WORDS) -> DataFrame:
    """(id, n_shingles, class, sketch) of every row; an empty set has the class 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", _PART_BYTES):
                sets = list(shingle_sets(part["text"], words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([fingerprint(s) for s in sets], pa.int64()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                    ],
                    names=["id", "n_shingles", "class", "sketch"],
                )

    chosen = docs.select(name(id_column).cast("long").alias("id"), name(text).alias("text"))
    return chosen.mapInArrow(run, "id long, n_shingles long, class long, sketch binary")


def _spread(short: np.ndarray) -> np.ndarray:
    return mix(short.astype(np.uint64))


def is_marked(short: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which short tokens the bitmap of frequent ones marks."""
    at = _spread(short) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def frequent_marks(
    texts: DataFrame,
    ranges: int,
    least: int,
    words: int = WORDS,
    most_bits: int = MOST_MARKS,
) -> np.ndarray:
    """A bitmap that marks all short tokens that more than ``least`` sets have, counted over all texts.

    It has a power of two of bits, at most ``most_bits``, which bounds what the driver and the tasks
    hold. The tokens themselves stay on the executors.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for large in batches_of(batch, "text", _BATCH_BYTES):
                sets = [tokens for _, tokens in _distinct_sets(large, words)]
                if not sets:
                    continue
                short, counts = np.unique(_short(np.concatenate(sets), ranges), return_counts=True)
                number = short >> 32
                used, first = np.unique(number, return_index=True)
                low = (short & 0xFFFFFFFF).astype("<u4")
                counts = counts.astype("<u4")
                cut = [slice(a, b) for a, b in zip(first, np.append(first[1:], len(short)))]
                # Most tokens occur once and need no count.
                once = [low[c][counts[c] == 1].tobytes() for c in cut]
                more = [low[c][counts[c] > 1].tobytes() for c in cut]
                times = [counts[c][counts[c] > 1].tobytes() for c in cut]
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array(used),
                        "once": pa.array(once, pa.binary()),
                        "more": pa.array(more, pa.binary()),
                        "times": pa.array(times, pa.binary()),
                    }
                )

    def keep(group: pa.Table) -> pa.Table:
        number = group["range"][0].as_py()
        once, more, times = (
            np.frombuffer(b"".join(group[c].to_pylist()), "<u4") for c in ("once", "more", "times")
        )
        tokens = np.concatenate((once, more))
        counts = np.concatenate((np.ones(len(once), "<u4"), times))
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        found = tokens[first][total > least].astype(np.int64)
        return pa.table({"mark": pa.array(_spread((number << 32) | found).view(np.int64))})

    counted = texts.mapInArrow(count, "range long, once binary, more binary, times binary")
    marks = materialize(counted.groupBy("range").applyInArrow(keep, "mark long"), "jaccard-frequent")
    wanted = max(LEAST_MARKS, MARK_BITS * marks.count())
    bits = min(most_bits, 1 << (wanted - 1).bit_length())
    bitmap = np.zeros(bits // 8, np.uint8)
    for first, found in _bits_of(marks, "mark", bits):
        bitmap[first // 8 : first // 8 + len(found)] = found[: len(bitmap) - first // 8]
    return bitmap


def _bits_of(table: DataFrame, column: str, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first place, bytes) of the parts of a bitmap, of ``bits`` bits together, of a column's values."""
    # From 1 on, as the bitmap functions count.
    slot = F.pmod(F.col(column), F.lit(bits)) + 1
    rows = (
        table.select(
            F.call_function("bitmap_bucket_number", slot).alias("bucket"),
            F.call_function("bitmap_bit_position", slot).alias("place"),
        )
        .groupBy("bucket")
        .agg(F.call_function("bitmap_construct_agg", F.col("place")).alias("bits"))
        .collect()
    )
    for row in rows:
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        yield (row["bucket"] - 1) * 8 * len(part), part


def band_of(size: int | np.ndarray) -> np.ndarray:
    """Sets of which neither is more than 1.25 times as large as the other are at most one band apart."""
    return np.floor(np.log(size) / _STEP + 1e-9).astype(np.int64)


def classes_of_band(band: int) -> int:
    return max(1, int(np.ceil(0.05 * 1.25**band)))


def signatures(
    tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray, int]:
    """Rare tokens to index, signatures of token pairs, and how many rare ones a partner shares.

    ``tokens`` ascend, and ``frequent`` flags them. Partners have in common as many of their rare
    tokens as the smaller of their two numbers says, or one, or a token pair.
    """
    size = len(tokens)
    prefix = size - -(-percent * size // 100) + 1
    rare, common = tokens[~frequent], tokens[frequent]
    extension = size * _EXTENSION_PERCENT // 100
    need = 1 + extension if len(rare) >= prefix + extension else 1
    singles = rare[: prefix + extension]
    pairs: list[np.ndarray] = []
    if len(rare) < prefix:
        own = int(band_of(size))
        for band in (own, own + 1):
            classes = classes_of_band(band)
            reached = common[: prefix + classes - len(rare)]
            dealt = (mix(reached) % np.uint64(classes)).astype(np.int64)
            for number in np.unique(dealt):
                mine = reached[dealt == number]
                i, j = np.triu_indices(len(mine), 1)
                pairs.append(mix(mix(mine[i] + np.uint64(band)) * np.uint64(31) + mine[j]))
    return singles, np.concatenate(pairs) if pairs else np.empty(0, np.uint64), need


def _named_owners(
    owners: np.ndarray, cut: list[tuple[int, int]], keys: list[int], needs: list[int], bands: list
) -> tuple[list[bytes], list[bytes]]:
    """For each range the classes, needs and bands of its owners, and its owners as numbers of these."""
    key, need, band = np.array(keys, "<i8"), np.array(needs, "<u4"), np.array(bands, "u1")
    place = np.empty(len(keys), np.int64)
    named, numbered = [], []
    for a, b in cut:
        used = np.unique(owners[a:b])
        place[used] = np.arange(len(used))
        named.append(key[used].tobytes() + need[used].tobytes() + band[used].tobytes())
        # Few enough for 16 bits in general.
        kind = "<u2" if len(used) <= 1 << 16 else "<u4"
        numbered.append(place[owners[a:b]].astype(kind).tobytes())
    return named, numbered


def _index(
    texts: DataFrame, marks: np.ndarray, ranges: int, index_ranges: int, words: int, percent: int
) -> DataFrame:
    """Signatures of all sets: packed by range for single tokens, one row each for token pairs.

    A row of a range names only the sets that have tokens in it, so the index grows with the tokens
    whatever the number of ranges.
    """
    shared = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for large in batches_of(batch, "text", _BATCH_BYTES):
                keys, single, owner, bands, needs = [], [], [], [], []
                pair, pair_owner = [], []
                for key, tokens in _distinct_sets(large, words):
                    flags = is_marked(_short(tokens, ranges), known)
                    singles, pairs, need = signatures(tokens, flags, percent)
                    single.append(singles)
                    owner.append(np.full(len(singles), len(keys), "<u4"))
                    bands.append(band_of(len(tokens)))
                    needs.append(need)
                    keys.append(key)
                    pair.append(pairs)
                    pair_owner.append(np.full(len(pairs), key, np.int64))
                if not single:
                    continue
                short = _short(np.concatenate(single), index_ranges)
                order = np.argsort(short, kind="stable")
                short, owners = short[order], np.concatenate(owner)[order]
                used, first = np.unique(short >> 32, return_index=True)
                ends = np.append(first[1:], len(short))
                low = (short & 0xFFFFFFFF).astype("<u4")
                cut = list(zip(first.tolist(), ends.tolist()))
                named, numbered = _named_owners(owners, cut, keys, needs, bands)
                pairs, pair_owners = np.concatenate(pair).view(np.int64), np.concatenate(pair_owner)
                none = pa.nulls(len(pairs), pa.binary())
                packed = pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array(used),
                        "tokens": pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()),
                        "owners": pa.array(numbered, pa.binary()),
                        "classes": pa.array(named, pa.binary()),
                        "signature": pa.nulls(len(used), pa.int64()),
                        "owner": pa.nulls(len(used), pa.int64()),
                    }
                )
                yield packed
                if len(pairs):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "range": pa.nulls(len(pairs), pa.int64()),
                            "tokens": none,
                            "owners": none,
                            "classes": none,
                            "signature": pa.array(pairs),
                            "owner": pa.array(pair_owners),
                        }
                    )

    schema = "range long, tokens binary, owners binary, classes binary, signature long, owner long"
    return texts.mapInArrow(run, schema)


def _pairs_of_lists(group: pa.Table) -> pa.Table:
    """Pairs of owners of common tokens whose sizes are at most a band apart, with their number."""
    tokens, owners, known, needs, bands = [], [], [], [], []
    before = 0
    for token, owner, classes in zip(*(group[c] for c in ("tokens", "owners", "classes"))):
        token, owner = token.as_buffer(), owner.as_buffer()
        count = token.size // 4
        classes = classes.as_buffer()
        of_batch = classes.size // 13
        tokens.append(np.frombuffer(token, "<u4"))
        numbers = np.frombuffer(owner, "<u4" if owner.size == 4 * count else "<u2").astype(np.int64)
        owners.append(numbers + before)
        before += of_batch
        known.append(np.frombuffer(classes, "<i8", of_batch))
        needs.append(np.frombuffer(classes, "<u4", of_batch, 8 * of_batch))
        bands.append(np.frombuffer(classes, "u1", of_batch, 12 * of_batch))
    # A class of several batches is one owner; the owners of a list ascend.
    names, first, which = np.unique(np.concatenate(known), return_index=True, return_inverse=True)
    need = np.concatenate(needs)[first].astype(np.int64)
    band = np.concatenate(bands)[first].astype(np.int64)
    token, owner = np.concatenate(tokens).astype(np.int64), which[np.concatenate(owners)]
    token, owner = np.divmod(np.unique(token * len(names) + owner), len(names))

    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

    # Neighbours at distance 1, 2, ... in their list: as many steps as the longest list has rows.
    live, step = np.arange(len(token)), 1
    while len(live):
        live = live[live + step < len(token)]
        live = live[token[live] == token[live + step]]
        near = live[np.abs(band[owner[live]] - band[owner[live + step]]) <= 1]
        if len(near):
            held.append(np.unique(owner[near] * len(names) + owner[near + step], return_counts=True))
        step += 1
        if len(held) > 1 and sum(len(p) for p, _ in held) > 2_000_000:
            held = [merged()]
    pairs, shared = merged() if held else (np.empty(0, np.int64), np.empty(0, np.int64))
    a, b = np.divmod(pairs, max(1, len(names)))
    return pa.table(
        {
            "a": pa.array(names[a]),
            "b": pa.array(names[b]),
            "shared": pa.array(shared),
            "need": pa.array(np.minimum(need[a], need[b])),
        }
    )


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not rule out."""
    side = sets.select("class", F.col("n_shingles").alias("n"), "sketch")
    both = pairs.join(side.select(*[F.col(c).alias(f"{c}_a") for c in side.columns]), F.col("a") == F.col("class_a"))
    both = both.join(side.select(*[F.col(c).alias(f"{c}_b") for c in side.columns]), F.col("b") == F.col("class_b"))
    both = both.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8)
                for c in ("sketch_a", "sketch_b")
            )
            apart = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
            total = np.asarray(batch["n_a"]) + np.asarray(batch["n_b"])
            # shared <= (total - apart) / 2 and 100 shared >= percent (total - shared)
            ok = (100 + percent) * (total - apart) >= 2 * percent * total
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    wanted = both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return wanted.mapInArrow(run, "a long, b long")


def _sets_of(classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(class, tokens) of the classes of a table, and of a few others."""
    # A filter of fixed size: it saves the shuffle of sets that no pair needs, and misses none.
    bits = {first: part.tobytes() for first, part in _bits_of(classes, "class", FILTER_BITS)}
    shared = texts.sparkSession.sparkContext.broadcast(bits)
    per_part = 8 * len(next(iter(bits.values()))) if bits else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for large in batches_of(batch, "text", _BATCH_BYTES):
                keys, values = [], []
                for key, tokens in _distinct_sets(large, words):
                    part, place = divmod(key % FILTER_BITS, per_part)
                    found = shared.value.get(part * per_part)
                    if found is not None and found[place // 8] >> (place % 8) & 1:
                        keys.append(key)
                        values.append(tokens.tobytes())
                yield pa.RecordBatch.from_pydict(
                    {"class": pa.array(keys, pa.int64()), "tokens": pa.array(values, pa.binary())}
                )

    found = texts.mapInArrow(run, "class long, tokens binary")
    return materialize(found.groupBy("class").agg(F.first("tokens").alias("tokens")), "jaccard-sets")


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among distinct pairs (a, b), checked on whole sets."""
    left = materialize(_possible(pairs, sets, percent), "jaccard-pairs")
    found = _sets_of(left.select(F.explode(F.array("a", "b")).alias("class")), texts, words)
    both = left.join(
        found.select(F.col("class").alias("c"), F.col("tokens").alias("t")), F.col("a") == F.col("c")
    ).join(found.select(F.col("class").alias("d"), F.col("tokens").alias("u")), F.col("b") == F.col("d"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for one, two in zip(batch["t"], batch["u"]):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                together = np.sort(np.concatenate((x, y)))
                shared_tokens = int((together[1:] == together[:-1]).sum())
                ok.append(100 * shared_tokens >= percent * (len(together) - shared_tokens))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "t", "u").mapInArrow(check, "a long, b long")


def _parts_compared(percent: int):
    """Links between two parts, or inside one, that join components not joined so far."""

    def compare(members: pa.Table) -> pa.Table:
        # A representative comes with each part, its own one too.
        names, first = np.unique(np.asarray(members["class"]), return_index=True)
        members = members.take(pa.array(first))
        low, high = members["low"][0].as_py(), members["high"][0].as_py()
        part, joined = np.asarray(members["part"]), np.asarray(members["joined"])
        tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in members["tokens"]]
        sizes = np.array([len(t) for t in tokens])
        left = np.flatnonzero(part == low)
        right = np.flatnonzero(part == high)
        flat = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(tokens)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        column = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
        shared = np.zeros((len(left), len(right)), np.float32)
        # Sums of ones stay exact below 2^24; the tokens go through in slices of columns.
        for begin in range(0, len(starts), 4096):
            a, b = np.searchsorted(column, [begin, begin + 4096])
            ones = np.zeros((len(tokens), 4096), np.float32)
            ones[owner[a:b], column[a:b] - begin] = 1
            shared += ones[left] @ ones[right].T
        together = sizes[left][:, None] + sizes[right] - shared
        i, j = np.nonzero(100 * shared >= percent * together)
        i, j = left[i], right[j]
        apart = joined[i] != joined[j]
        i, j = i[apart], j[apart]
        _, root_of = np.unique(joined, return_inverse=True)
        parent = list(range(len(tokens)))
        kept = []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(i.tolist(), j.tolist()):
            a, b = root(root_of[x]), root(root_of[y])
            if a != b:
                parent[a] = b
                kept.append((min(names[x], names[y]), max(names[x], names[y])))
        pairs = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return compare


def _parts(number: str, tokens: str) -> Column:
    """How many parts so many sets with so many tokens make."""
    return F.greatest(F.ceil(F.col(number) / PART_SETS), F.ceil(F.col(tokens) / PART_TOKENS)).cast("int")


def _within_parts(members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links inside the parts of crowds, and between their sets and the crowd's representatives.

    ``members`` has (crowd, class, parts).
    """
    chosen = members.filter("parts > 1").groupBy("crowd").agg(
        F.first("parts").alias("parts"),
        F.array_distinct(
            F.array(*[F.min_by("class", F.xxhash64("class", F.lit(n))) for n in range(REPRESENTATIVES)])
        ).alias("class"),
    )
    every = F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    copies = chosen.select("crowd", "parts", F.explode("class").alias("class")).select("crowd", "class", every)
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part")
    dealt = members.select("crowd", "class", part).unionByName(copies)
    with_tokens = dealt.join(found, "class").select(
        "crowd", F.col("part").alias("low"), F.col("part").alias("high"), "part",
        "class", F.col("class").alias("joined"), "tokens",
    )
    return with_tokens.groupBy("crowd", "low").applyInArrow(_parts_compared(percent), "a long, b long")


def _between_parts(members: DataFrame, found: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links that join components of crowds of several parts beyond those that ``links`` join.

    The sets outside the largest component of a crowd are compared with all its parts; those inside
    it only with these.
    """
    large = members.filter("parts > 1")
    ends = large.select(F.col("class").alias("a"))
    joined = connected_components(links.join(ends, "a", "left_semi"))
    state = materialize(
        large.join(joined, F.col("class") == F.col("node"), "left").select(
            "crowd", "class", "n_shingles", F.coalesce("component", "class").alias("joined")
        ),
        "jaccard-joined",
    )
    pieces = state.groupBy("crowd", "joined").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens")
    )
    crowd = (
        pieces.groupBy("crowd")
        .agg(
            F.max(F.struct("n", "tokens", "joined")).alias("main"),
            F.sum("n").alias("n"),
            F.sum("tokens").alias("tokens"),
        )
        .select(
            "crowd", F.col("main.joined").alias("main"),
            F.col("main.n").alias("main_n"), F.col("main.tokens").alias("main_tokens"),
            (F.col("n") - F.col("main.n")).alias("rest_n"),
            (F.col("tokens") - F.col("main.tokens")).alias("rest_tokens"),
        )
        .filter("rest_n > 0")
        .select(
            "crowd", "main", _parts("main_n", "main_tokens").alias("mains"),
            _parts("rest_n", "rest_tokens").alias("rests"),
        )
    )
    # Parts of the rest come first.
    inside = F.col("joined") == F.col("main")
    hashed = F.xxhash64("class")
    part = F.when(inside, F.col("rests") + F.pmod(hashed, F.col("mains"))).otherwise(F.pmod(hashed, F.col("rests")))
    last = F.when(inside, F.col("rests") - 1).otherwise(F.col("rests") + F.col("mains") - 1)
    dealt = (
        state.join(crowd, "crowd")
        .withColumn("part", part.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(
            "crowd", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "part", "class", "joined",
        )
    )
    return (
        dealt.join(found, "class")
        .groupBy("crowd", "low", "high")
        .applyInArrow(_parts_compared(percent), "a long, b long")
    )


def _crowd_links(
    lists: DataFrame, sets: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links that join the components of all sets connected by long lists of token combinations."""
    star = lists.filter("signature IS NULL AND owner <> least").select(
        F.col("least").alias("a"), F.col("owner").alias("b")
    )
    crowds = connected_components(star.distinct())
    size = sets.select("class", "n_shingles")
    sized = materialize(
        crowds.join(size, F.col("node") == F.col("class")).select(
            F.col("component").alias("crowd"), "class", "n_shingles"
        ),
        "jaccard-crowds",
    )
    parts = (
        sized.groupBy("crowd")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens"))
        .select("crowd", _parts("n", "tokens").alias("parts"))
    )
    members = sized.join(parts, "crowd")
    found = _sets_of(sized.select("class"), texts, words)
    links = materialize(_within_parts(members, found, percent), "jaccard-crowd-links")
    if parts.filter("parts > 1").isEmpty():
        return links
    return links.unionByName(_between_parts(members, found, links, percent))


def _lists(index: DataFrame) -> DataFrame:
    """(signature, owner, least) of all lists of several sets; long ones without their signature.

    ``least`` is the smallest owner of the list, which stands for a long one.
    """
    rows = index.filter("signature IS NOT NULL").select("signature", "owner").distinct()
    several = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("least"))
    several = several.filter("n > 1")
    short = F.when(F.col("n") <= SHORT_LIST, F.col("signature"))
    # Long lists repeat the same (owner, least) for many signatures.
    return rows.join(several, "signature").select(short.alias("signature"), "owner", "least").distinct()


def jaccard_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    frequent_sets: int = FREQUENT_SETS,
    most_marks: int = MOST_MARKS,
) -> tuple[DataFrame, DataFrame]:
    """Sets of all rows (id, n_shingles, class, sketch), and links (a, b) between classes.

    The links join all classes that Jaccard links join, directly or through others: of a crowd in
    one list, links that add nothing to the components are not looked for.
    """
    if not 80 <= percent <= 100:
        raise ValueError("bands of sizes are made for shares from 80 % on")
    rows = materialize(set_table(docs, id_column, text, words), "jaccard-rows")
    texts = docs.select(name(text).alias("text"))
    total = rows.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    ranges = pieces_of(total, RANGE_TOKENS, shuffle_partitions(docs.sparkSession))
    marks = frequent_marks(texts, ranges, frequent_sets, words, most_marks)
    # A prefix is a fifth of a set, so a range of the index holds as many tokens as four of the counts.
    index_ranges = pieces_of(total, 4 * RANGE_TOKENS, shuffle_partitions(docs.sparkSession) // 4)
    index = materialize(_index(texts, marks, ranges, index_ranges, words, percent), "jaccard-index")
    sets = rows.filter("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    sets = materialize(sets, "jaccard-classes")

    packed = index.filter("range IS NOT NULL").select("range", "tokens", "owners", "classes")
    single = packed.groupBy("range").applyInArrow(_pairs_of_lists, "a long, b long, shared long, need long")
    single = single.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("need").alias("need"))
    single = single.filter("shared >= need").select("a", "b")
    lists = materialize(_lists(index), "jaccard-lists")
    short = lists.filter("signature IS NOT NULL").select("signature", "owner")
    combined = (
        short.withColumnRenamed("owner", "a").join(short.withColumnRenamed("owner", "b"), "signature")
        .filter("a < b").select("a", "b")
    )
    pairs = materialize(single.unionByName(combined).distinct(), "jaccard-candidates")
    links = _verified(pairs, sets, texts, words, percent)
    crowd = _crowd_links(lists, sets, texts, words, percent)
    return rows, materialize(links.unionAll(crowd).distinct(), "jaccard-links")


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    frequent_sets: int = FREQUENT_SETS,
    most_marks: int = MOST_MARKS,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    ``component_id`` is the smallest id reachable by links, the row's own included; a row without
    words or text is linked with nothing and is its own component. Ids are whole numbers; a row
    with a null id takes part, and its component has the smallest id of the others (null if none).
    """
    rows, links = jaccard_links(docs, id_column, text, words, percent, frequent_sets, most_marks)
    least = rows.filter("n_shingles > 0").groupBy("class").agg(F.min("id").alias("least"))
    placed = least.join(connected_components(links), F.col("class") == F.col("node"), "left").select(
        "class", "least", F.coalesce("component", "class").alias("component")
    )
    smallest = placed.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    of_class = placed.join(smallest, F.col("component") == F.col("c")).select(
        F.col("class").alias("k"), "component_id"
    )
    joined = rows.join(of_class, (F.col("n_shingles") > 0) & (F.col("class") == F.col("k")), "left")
    return joined.select(
        "id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
