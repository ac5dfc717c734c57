"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import queries, variants

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=7):
    """The rows of (id, text) pairs, by word."""
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: c for w, c in n.items() if len(w) >= least and c >= 2}
    near, groups = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            groups[word[:i], word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in groups.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word, count in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * count:
            form[word] = best
    rows = {}
    for word, count in words.items():
        root = word
        while root in form:
            root = form[root]
        rows[word] = (count, len(near[word]), form.get(word), words.get(form.get(word)), root)
    return rows


def found(df, **options):
    return {
        r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
        for r in variants.group_variants(df, **options).collect()
    }


def frame(spark, docs):
    rows = [(i, text, 1, "x") for i, text in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, id int, word string")


def edited(word, chance, letters="abcdefgéßÿ×"):
    at = chance.randrange(len(word) + 1)
    return word[:at] + chance.choice(["", chance.choice(letters)]) + word[at + chance.choice([0, 1]) :]


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_plain(spark, seed):
    chance = random.Random(seed)
    base = ["".join(chance.choice("abcdeéß") for _ in range(chance.randint(6, 12))) for _ in range(25)]
    docs = []
    for i in range(120):
        words = [w for w in chance.sample(base, 8) for _ in range(chance.choice([1, 5, 40]))]
        words += [edited(w, chance) for w in words[:30]] + [edited(edited(w, chance), chance) for w in words[:9]]
        docs.append((i, " ".join(w.upper() if chance.random() < 0.1 and w.isascii() else w for w in words)))
    want = plain(docs)
    assert found(frame(spark, docs)) == want
    assert sum(row[2] is not None for row in want.values()) > 20


def test_roots_follow_all_forms(spark):
    """Chains of forms, each ten times as frequent; ties of count go to the smaller word."""
    chain = ["chainword" + "x" * k for k in range(5)]
    texts = [(k, " ".join([word] * (2 * 11**k))) for k, word in enumerate(chain)]
    texts += [(90, "zebrazz " * 40 + "zebrazy " * 40 + "zebrazx " * 4)]
    want = plain(texts)
    assert found(frame(spark, texts)) == want
    roots = {row[4] for word, row in want.items() if word in chain}
    assert len(roots) == 1 and want["zebrazx"][2] == "zebrazy"


def test_every_edit_is_in_one_neighbourhood():
    chance = random.Random(5)
    for _ in range(300):
        word = "".join(chance.choice("abcdefghijklmnopqrstuvwxyzàéîõü") for _ in range(chance.randint(1, 14)))
        other = edited(word, chance, "abcdefghijklmnopqrstuvwxyzàéîõü")
        if other in ("", word):
            continue
        keys, _ = variants.reduced_keys([word, other])
        pairs = Counter()
        for which, edits, same in variants.neighbourhoods([word, other]):
            for w, key in zip(which.tolist(), edits.tolist()):
                if key == keys[1 - w] and (not same or w == 0):
                    pairs[w] += 1
        assert sum(pairs.values()) == 1


def test_words_longer_than_a_block(spark, monkeypatch):
    long = "".join(random.Random(1).choice("abcdefghij") for _ in range(3000))
    docs = [(1, f"{long} {long} " * 30), (2, f"{long[:-1]} {long[:-1]}"), (3, f"{long[:1500]}zz {long[:1500]}zz")]
    assert found(frame(spark, docs)) == plain(docs)
    words = ["abcdefg", long, "hijklmn", "opqrstu"]
    whole = [np.concatenate(part) for part in zip(*((w, k) for w, k, _ in variants.neighbourhoods(words)))]
    monkeypatch.setattr(variants, "_BLOCK", 10)
    parts = [np.concatenate(part) for part in zip(*((w, k) for w, k, _ in variants.neighbourhoods(words)))]
    assert sorted(zip(*whole)) == sorted(zip(*parts))


def test_partial_counts_are_added(spark, monkeypatch):
    docs = [(i, "wordnumber" + "abcdefghij"[i % 10] + " samewords") for i in range(200)]
    monkeypatch.setattr(variants, "_HELD_WORDS", 3)
    assert found(frame(spark, docs)) == plain(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    given = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs, min_length=3) == plain(given, 3)
    assert variants.group_variants(no_docs).collect() == []
    assert variants.group_variants(frame(spark, [(None, None), (1, "")])).collect() == []


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    result = queries.op12_spelling_variants(spark, SF)
    assert set(result.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
    rows = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in result.collect()}
    assert rows == plain(docs) and len(rows) > 1000
