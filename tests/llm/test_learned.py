"""Quality classifier and language ID: held-out accuracy, the identity, odd rows."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import langid, quality, queries
from starmart.llm.words import hashed_words

SF = "/root/testdata/sf0.1"


def test_words_are_split_and_hashed_like_bytes():
    texts = ["A b\x0bC", None, "", "  x ", "a\x85b c", "w" * 3_000_000 + " tail", "é a"]
    hashes, counts = hashed_words(pa.array(texts))
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    assert counts.tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(set(hashes.tolist())) == len(set(words))
    assert {w: h for w, h in zip(words, hashes.tolist())} == {
        w: h for w, h in reversed(list(zip(words, hashes.tolist())))
    }


def test_sum_of_squares_is_the_sum_over_pairs():
    random = np.random.default_rng(1)
    model = quality.FactorisationMachine(
        0.3, random.normal(size=quality.FEATURES), random.normal(size=(quality.FEATURES, 3))
    )
    indices, values, ends = quality.features(pa.array(["to be or not to be", "", None, "a | b!!"]))
    begin = 0
    for end, logit in zip(ends, model.logits(indices, values, ends)):
        i, x = indices[begin:end], values[begin:end].astype(float)
        plain = model.bias + (model.weights[i] * x).sum()
        for a in range(len(i)):
            for b in range(a):
                plain += model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b]
        assert logit == pytest.approx(plain, rel=1e-6, abs=1e-6)
        begin = end


def test_quality_on_held_out_rows(spark):
    scored = queries.op1_quality_classifier(spark, SF)
    labels = queries.table(spark, SF, "labels").select("doc_id", "quality").distinct()
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98
    assert np.mean([r["score"] >= 0.7 for r in rows if r["quality"] == 1]) > 0.99
    assert scored.count() == queries.table(spark, SF, "documents").count()


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (4, 0), (None, 1), (6, None), (7, 1), (3, 5)], "doc_id long, quality int"
    )
    model = quality.fit(odd_docs, labels)
    found = quality.score_quality(odd_docs, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    rows = found.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row["text"], row["score"]) == row["score"]
    assert quality.score_quality(no_docs, quality.fit(no_docs, labels)).count() == 0


def test_quality_never_learns_from_held_out_rows(spark, odd_docs):
    out = odd_docs.filter(quality.held_out(F.col("doc_id"))).select("doc_id").distinct()
    labels = out.withColumn("quality", F.pmod("doc_id", F.lit(2)).cast("int"))
    assert quality.fit(odd_docs, labels).bias == 0.0


def test_language_on_held_out_rows(spark):
    found = queries.op7_language_id(spark, SF).filter("held_out")
    rows = found.join(queries.table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 1500
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.985


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs)
    assert model.languages == ("en",)
    rows = langid.predict_language(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert row["lang_pred"] == ("en" if letters else "und")
        assert 0 <= row["score"] <= 1 and (letters or row["score"] == 0)
    nothing = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.predict_language(odd_docs, nothing).collect()} == {"und"}
    assert langid.predict_language(no_docs, model).count() == 0


def test_ngrams_are_bound_and_bundled_as_said():
    bundled, ok = langid.profiles(["Ab", "", "a1b"])
    assert ok.tolist() == [True, False, True]
    gap, a, b = (langid._letter_vectors(np.array([c]))[0].astype(int) for c in (0, ord("a"), ord("b")))

    def bind(x, y, z):
        return np.roll(x, 2) * np.roll(y, 1) * z

    assert (bundled[0] == bind(gap, a, b) + bind(a, b, gap)).all()
    assert (bundled[2] == bind(gap, a, gap) + bind(a, gap, b) + bind(gap, b, gap)).all()


def test_texts_of_no_learned_language_go(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    random, rows = np.random.default_rng(3), []
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрсту"):
        for _ in range(100):
            words = ["".join(random.choice(list(alphabet), random.integers(2, 10))) for _ in range(40)]
            rows.append((" ".join(words),))
    rows += [
        ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",),
        ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",),
        ("Все люди рождаются свободными и равными в своем достоинстве и правах.",),
    ]
    model = langid.fit(docs)
    least = langid.least_cosines(docs, model)
    strange = spark.createDataFrame(rows, "text string")
    assert langid.keep_known(strange, model, least).count() <= 0.01 * len(rows)
    held = docs.filter(langid.held_out(F.col("doc_id")) & F.col("text").rlike("[a-z]"))
    assert langid.keep_known(held, model, least).count() >= 0.98 * held.count()
    short = docs.filter("length(text) BETWEEN 1 AND 40").filter(F.col("text").rlike("[a-z]"))
    assert langid.keep_known(short, model, least).count() >= 0.9 * short.count() > 0
    assert least[1] >= langid.CHANCE


def test_scores_of_learned_texts_leave_the_text_out(spark):
    rows = [(1, "the cat sat", "en"), (2, "the dog lay", "en"), (3, "le chat dort", "fr"), (4, "le chien", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = docs.filter(~langid.held_out(F.col("doc_id"))).collect()
    model = langid.fit(docs)
    found, _ = model.own_scores([r["text"] for r in learned], [r["lang"] for r in learned])
    for row, score in zip(learned, found):
        others = docs.filter(F.col("doc_id") != row["doc_id"])
        rest = langid.fit(others)
        if row["lang"] not in rest.languages:
            assert np.isnan(score)
            continue
        unit = langid._unit(langid.profiles([row["text"]])[0].astype(float))
        shared = rest.shared if len(rest.languages) > 1 else 0
        plain = langid._unit(unit - shared)[0] @ rest.prototypes[rest.languages.index(row["lang"])]
        assert score == pytest.approx(plain, abs=1e-4)


def test_many_short_texts_take_little_memory():
    """Short texts with hardly an n-gram in common: the table of counts must not grow with their square."""
    chance = random.Random(2)
    texts = ["".join(chr(chance.randrange(0x4E00, 0x9FA5)) for _ in range(13)) for _ in range(10_000)]
    tracemalloc.start()
    bundled, has_letter = langid.profiles(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert has_letter.all() and peak < 1 << 30
    alone = [langid.profiles([text])[0][0] for text in texts[::997]]
    assert (bundled[::997] == np.array(alone)).all()


def test_text_with_very_many_ngrams():
    chance = random.Random(3)
    text = "".join(chr(chance.randrange(0x4E00, 0x9FA5)) for _ in range(100_000))
    tracemalloc.start()
    bundled, _ = langid.profiles([text])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 600 << 20 and np.abs(bundled).max() > 0


def test_examples_of_repeated_ids(spark):
    """One id on a third of the rows, with many texts, is one example, the same in every order."""
    texts = [(i, f"good text number {i} of many words " * 3) for i in range(40)]
    texts += [(7, f"another text {n} of the same id") for n in range(20)] + [(7, None), (None, "no id")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 1)] * 5, "doc_id long, quality int")
    learned = []
    original = quality.train
    try:
        quality.train = lambda indices, values, given: learned.append(
            [(i.tobytes(), v.tobytes(), y) for i, v, y in zip(indices, values, given)]
        )
        quality.fit(docs, labels)
        quality.fit(docs.orderBy(F.desc("text")).repartition(7), labels)
        quality.fit(docs, labels, rows=10)
    finally:
        quality.train = original
    usable = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert [len(found) for found in learned] == [len(usable), len(usable), 10]
    assert learned[0] == learned[1]
