"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, made from its code point. An n-gram of
three letters binds them: the product of the first rotated by two, the second by one, and the
third. A text bundles its n-grams: the sum of their vectors, each as often as it occurs. A language
prototype bundles texts of that language, each scaled to the same length. A text gets the language
whose prototype has the greatest cosine with it, after the part that all prototypes share has been
taken from both.

Runs of characters that are no letters count as one gap, which is a letter of its own, so n-grams
hold word starts and ends. Letters are compared in lower case.

Whether a text is in a learned language at all is told by a least cosine, which is derived from the
scores of the labelled rows learned from (``least_cosines``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from starmart.llm.tables import batches_of, name
from starmart.llm.words import mix

DIMENSIONS = 512
#: At most so many texts of each language are learned from, those with the smallest hashes of their id.
TRAIN_ROWS = 1000
UNKNOWN = "und"
#: Texts of fewer different n-grams are judged by the scores of their like.
SHORT_GRAMS = 32
#: Signs agree with a prototype by chance to 1 / sqrt(DIMENSIONS); so many times that is above chance.
CHANCE = 4 / DIMENSIONS**0.5
#: So many of the labelled rows, at most, may score below the least cosine, unless chance asks for more.
LEAST_SHARE = 0.002
#: Where more of the labelled rows than this score like chance, chance tells nothing about a text.
WEAK_SHARE = 0.1
#: Fewer scores give no least cosine.
LEAST_SCORES = 20

_BINS = 1000
_SCALE = 1 << 20
_BATCH_BYTES = 400_000
_SLICE = 1 << 20
# Texts times n-grams of a table of counts, and n-grams bound at once.
_CELLS, _GRAMS = 4 << 20, 1 << 15
_PARTS = 64


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _letter_vectors(letters: np.ndarray) -> np.ndarray:
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    seeds = (letters.astype(np.uint64)[:, None] << np.uint64(16)) + words + np.uint64(1)
    bits = np.unpackbits(mix(seeds * np.uint64(0x9E3779B97F4A7C15)).view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _letters(text: str) -> np.ndarray:
    """Code points of the letters, with a 0 for each gap, the two ends included."""
    parts = [np.zeros(1, np.int32)]
    for at in range(0, len(text), _SLICE):
        codes = np.frombuffer(text[at : at + _SLICE].lower().encode("utf-32-le", "replace"), np.int32)
        parts.append(np.where(_is_letter()[codes], codes, 0))
    parts.append(np.zeros(1, np.int32))
    codes = np.concatenate(parts)
    keep = codes != 0
    keep[0] = True
    keep[1:] |= codes[:-1] != 0
    return codes[keep]


def profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vectors of the texts, and whether each has a letter."""
    return _counted_profiles(texts)[:2]


def _counted_profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of ``profiles``, and how many different n-grams each text has."""
    return _bundled([_letters(text or "") for text in texts])


def _bundled(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for sequences of letters. Texts that have too many n-grams together are halved, so the
    table of texts by n-grams stays small however short and different they are."""
    sizes = np.array([len(s) for s in sequences])
    has_letter = sizes > 1
    bundled = np.zeros((len(sequences), DIMENSIONS), np.float32)
    if not has_letter.any():
        return bundled, has_letter, np.zeros(len(sequences), int)
    alphabet, code = np.unique(np.concatenate(sequences), return_inverse=True)
    doc = np.repeat(np.arange(len(sequences)), sizes)
    inside = (doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, bool)
    k = len(alphabet)
    grams = ((code[:-2] * k + code[1:-1]) * k + code[2:])[inside]
    distinct, which = np.unique(grams, return_inverse=True)
    if len(sequences) > 1 and len(sequences) * len(distinct) > _CELLS:
        half = len(sequences) // 2
        parts = _bundled(sequences[:half]), _bundled(sequences[half:])
        return tuple(np.concatenate(part) for part in zip(*parts))
    counts = np.bincount(
        doc[2:][inside] * len(distinct) + which, minlength=len(sequences) * len(distinct)
    ).reshape(len(sequences), len(distinct))
    vectors = _letter_vectors(alphabet)
    first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
    for at in range(0, len(distinct), _GRAMS):
        some = distinct[at : at + _GRAMS]
        bound = first[some // (k * k)] * second[some // k % k] * vectors[some % k]
        # Sums of whole numbers are exact in any order.
        bundled += counts[:, at : at + _GRAMS].astype(np.float32) @ bound.astype(np.float32)
    return bundled, has_letter, (counts > 0).sum(axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    shared: np.ndarray
    prototypes: np.ndarray
    #: The sums of the scaled texts of each language.
    sums: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self._scored(texts)[:2]

    def known(self, texts: list[str | None], least: tuple[float, float]) -> np.ndarray:
        """Whether each text has a letter and at least the cosine for short or other texts."""
        _, cosine, has_letter, grams = self._scored(texts)
        return has_letter & (cosine >= np.where(grams < SHORT_GRAMS, *least))

    def own_scores(self, texts: list[str | None], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of learned texts with their languages as if each had been left out, and n-grams.

        NaN for a text without a letter and for the only one of its language.
        """
        bundled, has_letter, grams = _counted_profiles(texts)
        units = _unit(bundled.astype(np.float64))
        own = np.array([self.languages.index(language) for language in languages], int)
        left = self.sums[own] - np.rint(units * _SCALE)
        raw = _unit(left)
        shared = self.shared
        if len(self.languages) > 1:
            shared = shared + (raw - _unit(self.sums)[own]) / len(self.languages)
        cosine = (_unit(units - shared) * _unit(raw - shared)).sum(axis=1)
        return np.where(has_letter & left.any(axis=1), cosine, np.nan), grams

    def _scored(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        bundled, has_letter, grams = _counted_profiles(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), has_letter, grams
        cosine = _unit(_unit(bundled.astype(np.float64)) - self.shared) @ self.prototypes.T
        best = cosine.argmax(axis=1)
        found = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
        return found, np.where(has_letter, np.clip(cosine.max(axis=1), 0, 1), 0.0), has_letter, grams


def held_out(id_column: Column) -> Column:
    """True for the fifth of ids that is never learned from; a null id is not held out."""
    text = id_column.cast("string")
    return F.coalesce(F.pmod(F.crc32(F.encode(text, "utf-8")), F.lit(5)) == 0, F.lit(False))


def _examples(docs: DataFrame, id_column: str, text: str, lang: str, rows: int | None) -> DataFrame:
    """(text, lang) of the texts to learn from: all that are not held out if ``rows`` is None."""
    if rows is None:
        return (
            docs.select(name(id_column).alias("id"), name(text).alias("text"), name(lang).alias("lang"))
            .filter("id IS NOT NULL AND lang IS NOT NULL")
            .filter(~held_out(F.col("id")))
            .select("text", "lang")
        )
    order = [F.xxhash64("id"), F.col("id")]
    # First within parts of a language, so that no task gets the candidates of all of a hot one.
    part = F.pmod(F.xxhash64("id"), F.lit(_PARTS))
    in_part, in_all = W.partitionBy("lang", part).orderBy(*order), W.partitionBy("lang").orderBy(*order)
    chosen = (
        docs.select(name(id_column).alias("id"), name(lang).alias("lang"))
        .filter("id IS NOT NULL AND lang IS NOT NULL")
        .filter(~held_out(F.col("id")))
        .withColumn("n", F.row_number().over(in_part))
        .filter(F.col("n") <= rows)
        .withColumn("n", F.row_number().over(in_all))
        .filter(F.col("n") <= rows)
        .select("id")
        .distinct()
    )
    return (
        docs.select(name(id_column).alias("id"), name(text).alias("text"), name(lang).alias("lang"))
        .filter("lang IS NOT NULL")
        .join(F.broadcast(chosen), "id")
        .select("text", "lang")
    )


def fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int | None = TRAIN_ROWS,
) -> LanguageModel:
    """Learn one prototype for each language from at most ``rows`` of its texts that are not held out
    (all of them if ``rows`` is None).

    Which texts is settled on ids and languages alone; then only their texts are read. Rows without
    id or language are no examples. The driver receives one vector for each language.
    """
    examples = _examples(docs, id_column, text, lang, rows)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in batches_of(batch, "text", _BATCH_BYTES):
                rows, ok = profiles(part["text"].to_pylist())
                # Whole numbers, so that the order of the sums changes nothing.
                scaled = np.rint(_unit(rows.astype(np.float64)) * _SCALE).astype(np.int64)
                for language, row, has_letter in zip(part["lang"].to_pylist(), scaled, ok):
                    if has_letter:
                        sums[language] = sums.get(language, 0) + row
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(list(sums), pa.string()),
                "sums": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64())),
            }
        )

    parts = examples.mapInArrow(bundle, "lang string, sums array<bigint>")
    total = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIMENSIONS)]
    found = sorted(parts.groupBy("lang").agg(*total).collect(), key=lambda row: row["lang"])
    if not found:
        return LanguageModel((), np.zeros(DIMENSIONS), *[np.zeros((0, DIMENSIONS))] * 2)
    sums = np.array([[row[f"s{i}"] for i in range(DIMENSIONS)] for row in found], np.float64)
    raw = _unit(sums)
    shared = raw.mean(axis=0) if len(found) > 1 else np.zeros(DIMENSIONS)
    return LanguageModel(tuple(row["lang"] for row in found), shared, _unit(raw - shared), sums)


def least_cosines(
    docs: DataFrame,
    model: LanguageModel,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int | None = TRAIN_ROWS,
) -> tuple[float, float]:
    """The cosines below which a text is in no learned language: of short texts, and of others.

    The arguments are those ``model`` was learned with. Each text learned from is scored as if it
    had been left out. The least cosine is one that 99.8 % of these scores reach, and at least
    ``CHANCE``. Where more than a tenth of them lies below ``CHANCE`` (short texts, or very few to
    learn from), clean texts cannot be told from chance; then it is that cosine alone, so that
    they stay. Below ``LEAST_SCORES`` scores it is 0. The driver receives counts of 1,000 steps.
    """
    if not model.languages:
        return 0.0, 0.0
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", _BATCH_BYTES):
                # A language without any letter has no prototype.
                part = part.filter(pc.is_in(part["lang"], pa.array(shared.value.languages, pa.string())))
                if not part.num_rows:
                    continue
                scores, grams = shared.value.own_scores(part["text"].to_pylist(), part["lang"].to_pylist())
                some = ~np.isnan(scores)
                steps = np.floor(np.clip(scores[some], 0, 1) * _BINS).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"short": grams[some] < SHORT_GRAMS, "step": steps})

    examples = _examples(docs, id_column, text, lang, rows)
    counted = examples.mapInArrow(measure, "short boolean, step int").groupBy("short", "step").count().collect()
    least = []
    for short in (True, False):
        counts = np.zeros(_BINS + 1, np.int64)
        for row in counted:
            if row["short"] == short:
                counts[row["step"]] = row["count"]
        n = counts.sum()
        if n < LEAST_SCORES:
            least.append(0.0)
            continue
        low = float(np.searchsorted(np.cumsum(counts), LEAST_SHARE * n, "right")) / _BINS
        weak = counts[: int(CHANCE * _BINS)].sum() > WEAK_SHARE * n
        least.append(low if weak else max(low, CHANCE))
    return least[0], least[1]


def keep_known(
    docs: DataFrame, model: LanguageModel, least: tuple[float, float], text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose whole text has a letter and is in a language that was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, text, _BATCH_BYTES):
                yield part.filter(pa.array(shared.value.known(part[text].to_pylist(), least)))

    return docs.mapInArrow(run, docs.schema)


def predict_language(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    lang_pred: str = "lang_pred",
    score: str = "score",
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default), the language of each whole text and its cosine, 0 to 1.

    ``und`` with score 0 for a text that is null or has no letter, and for all when nothing was
    learned. Columns that are already called like the two new ones are replaced.
    """
    kept = [c for c in (columns or docs.columns) if c not in (lang_pred, score)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, text, _BATCH_BYTES):
                found, cosine = shared.value.predict(part[text].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(found, pa.string()), pa.array(cosine, pa.float64())],
                    names=[*kept, lang_pred, score],
                )

    read = docs.select(*[name(c) for c in dict.fromkeys([*kept, text])])
    schema = StructType(
        [docs.schema[c] for c in kept]
        + [StructField(lang_pred, StringType()), StructField(score, DoubleType())]
    )
    return read.mapInArrow(run, schema)
