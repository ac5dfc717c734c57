"""Token ids, packing, token files and token counts against plain versions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import coder, packing, queries, tokens, viterbi
from starmart.sources.scratch import scratch_path

SF = "/root/testdata/sf0.001"


def test_ids_equal_those_of_whole_texts(spark, odd_docs, plain_ids):
    texts = [r["text"] for r in odd_docs.collect()] + [
        "á e. é. ́, x,y. 3. it's. !. <|endoftext|>y <|EndOfText|>",
        "\x1c\x1da\x85b​",
        "ẞ ΣΑΣ İ 'LL",
    ]
    texts += [r["text"] for r in queries.table(spark, SF, "documents").limit(150).collect()]
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    for _ in range(2):  # from the tokenizer, then from the cache
        ids, stops = encoder.encode(pa.array(texts))
        begins = [0, *stops[:-1]]
        for text, a, b in zip(texts, begins, stops):
            assert ids[a:b].tolist() == plain_ids(text)


def _plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    for seed in range(150):
        chance = random.Random(seed)
        capacity = chance.choice([1, 5, 17, 100])
        lengths = [chance.randint(1, capacity) for _ in range(chance.randint(0, 120))]
        lengths += [max(1, capacity // 3)] * chance.randint(0, 50)
        counts, numbers = {}, []
        for length in lengths:
            numbers.append(counts.get(length, 0))
            counts[length] = numbers[-1] + 1
        plan = packing.plan_best_fit(counts, capacity)
        bins, offsets = plan.place(np.array(lengths, np.int64), np.array(numbers, np.int64))
        used = {}
        for length, bin_, offset in zip(lengths, bins.tolist(), offsets.tolist()):
            used.setdefault(bin_, []).append((offset, length))
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
        rooms = sorted(capacity - sum(n for _, n in pieces) for pieces in used.values())
        assert rooms == _plain_best_fit(lengths, capacity)


def _check_packing(rows, texts, plain_ids, crc_of, capacity=packing.CAPACITY):
    pieces = {}
    for row in rows:
        pieces.setdefault(row["doc_id"], []).append(row)
    for doc_id, text in texts.items():
        ids, at = plain_ids(text), 0
        for number, row in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            assert (row["piece"], row["start"]) == (number, at)
            span = ids[at : at + row["length"]]
            assert row["ids_crc32"] == crc_of(span)
            at += row["length"]
            assert row["length"] == capacity or at == len(ids)
        assert at == len(ids)
    places = {}
    for row in rows:
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for sequence in places.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r["length"] for r in rows]
    assert len(places) == len(_plain_best_fit(lengths, capacity))


def test_packing_query(spark, plain_ids, crc_of):
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    _check_packing(queries.op5_best_fit_packing(spark, SF).collect(), docs, plain_ids, crc_of)


def test_packing_of_odd_rows(odd_docs, no_docs, plain_ids, crc_of):
    rows = packing.pack_documents(odd_docs, keep_ids=True).collect()
    assert all(crc_of(np.frombuffer(r["ids"], "<u4").tolist()) == r["ids_crc32"] for r in rows)
    once = [r for r in rows if r["doc_id"] is not None and r["doc_id"] != 4]
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] not in (None, 4)}
    assert {r["doc_id"] for r in once} == set(texts)
    assert sum(r["doc_id"] == 4 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack_documents(no_docs).count() == 0


@pytest.mark.parametrize(
    "lanes, length, ids", [(1, 1, 5), (3, 50, 10), (17, 300, 49_408), (5, 400, 2**32), (2, 0, 3), (4, 700, 1), (2, 4096, 2**32)]
)
def test_blocks_come_back(lanes, length, ids):
    values = np.random.default_rng(3).integers(0, ids, (lanes, length))
    coded = coder.encode_blocks(values)
    assert (coder.decode_blocks(coded, length) == values).all()
    # Blocks are independent: one alone gives the same bytes.
    assert coder.encode_blocks(values[:1])[0] == coded[0]


def test_repetition_is_predicted():
    values = np.tile(np.random.default_rng(5).integers(0, 49_408, 64), 64)[None, :]
    assert len(coder.encode_blocks(values)[0]) < values.size / 4


def test_damage_is_found():
    ids = np.arange(10_000)
    content = coder.pack_segment(np.array([7]), np.array([False]), ids, np.array([len(ids)]))
    assert (coder.unpack_segment(content)[2] == ids).all()
    broken = bytearray(content)
    broken[-5] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        coder.unpack_segment(bytes(broken))
    with pytest.raises(ValueError, match="not a token file"):
        coder.unpack_segment(b"other" + content)


def test_token_file_query(spark, plain_ids, crc_of):
    found = {r["doc_id"]: r for r in queries.op9_token_files(spark, SF).collect()}
    at = 0
    for row in queries.table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = plain_ids(row["text"])
        got = found.pop(row["doc_id"])
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (at, len(ids), crc_of(ids))
        at += len(ids)
    assert not found


def test_blocks_take_fewer_bits_than_deflate(spark):
    texts = [r["text"] for r in queries.table(spark, SF, "documents").collect()]
    ids, _ = tokens.encoder(tokens.default_tokenizer()).encode(pa.array(texts))
    blocks = ids[: len(ids) // coder.BLOCK_IDS * coder.BLOCK_IDS].reshape(-1, coder.BLOCK_IDS)
    assert len(blocks) >= 10
    coded = coder.encode_blocks(blocks)
    deflated = [zlib.compress(block.astype("<u2").tobytes(), 6) for block in blocks]
    assert sum(map(len, coded)) < 0.95 * sum(map(len, deflated))


def test_one_block_is_read_alone():
    ids = np.random.default_rng(5).zipf(1.3, 3 * coder.BLOCK_IDS + 100).astype(np.uint32) % 50_000
    content = coder.pack_segment(np.array([7]), np.array([False]), ids, np.array([len(ids)]))
    for number in range(4):
        part = ids[number * coder.BLOCK_IDS : (number + 1) * coder.BLOCK_IDS]
        assert (coder.unpack_block(content, number) == part).all()
    # Damage in the last block does not reach the others.
    broken = content[:-9] + bytes([content[-9] ^ 1]) + content[-8:]
    assert (coder.unpack_block(broken, 1) == ids[coder.BLOCK_IDS : 2 * coder.BLOCK_IDS]).all()
    with pytest.raises(ValueError, match="block 3"):
        coder.unpack_block(broken, 3)


def test_token_files_of_odd_rows(spark, odd_docs, no_docs, plain_ids):
    path = scratch_path(spark, "odd")
    coder.write_token_files(odd_docs, path)
    rows = sorted(coder.read_token_files(spark, path, keep_ids=True).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in rows] == sorted(
        [r["doc_id"] for r in odd_docs.collect()], key=lambda i: -1 if i is None else i
    )
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    for row in rows:
        assert np.frombuffer(row["ids"], "<u4").tolist() == plain_ids(texts[row["id"]])
    empty = scratch_path(spark, "empty")
    coder.write_token_files(no_docs, empty)
    assert coder.read_token_files(spark, empty).count() == 0
    with pytest.raises(ValueError, match="whole numbers"):
        coder.write_token_files(odd_docs.withColumn("doc_id", F.col("text")), scratch_path(spark, "bad"))


def _library(vocabulary):
    """The tokenizers library on the same pieces; byte pieces get the least score."""
    from tokenizers.models import Unigram

    least = min(vocabulary.values(), default=0.0)
    extra = [("<unk>", least)] + [(f"<0x{i:02X}>", least) for i in range(256)]
    model = Unigram(extra + list(vocabulary.items()), unk_id=0, byte_fallback=True)
    return lambda text: len(model.tokenize("▁" + text.replace(" ", "▁"))) if text else 0


def test_token_counts_with_ties():
    for seed in range(150):
        chance = random.Random(seed)
        pieces = {}
        for _ in range(chance.randint(1, 12)):
            piece = "▁" * chance.randint(0, 2) + "".join(chance.choices("abé", k=chance.randint(0, 4)))
            if piece:
                pieces[piece] = float(chance.randint(-6, -1))
        counter, library = viterbi.UnigramCounter(pieces), _library(pieces)
        for _ in range(15):
            text = "".join(chance.choices("ab é日", k=chance.randint(0, 14)))
            assert counter.count(text) == library(text)


def test_token_count_query(spark, odd_docs, no_docs):
    library = _library(viterbi.read_vocabulary(viterbi.default_vocabulary()))
    found = {r["doc_id"]: r["n_tokens"] for r in queries.op2_token_counts(spark, SF).collect()}
    for row in queries.table(spark, SF, "documents").collect():
        assert found[row["doc_id"]] == library(row["text"])
    rows = viterbi.count_tokens(odd_docs).collect()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (0, 1)] == [0, 0]
    assert all(r["n_tokens"] == library(r["text"]) for r in rows if r["text"])
    assert viterbi.count_tokens(no_docs).count() == 0


def test_vocabularies_that_cannot_be_counted_exactly():
    with pytest.raises(ValueError, match="space mark"):
        viterbi.UnigramCounter({"a▁b": -1.0})
    with pytest.raises(ValueError, match="whole numbers"):
        viterbi.UnigramCounter({"a": -1.5})


def test_new_words_are_encoded_4096_to_a_text_with_the_ids_they_get_alone():
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    real, texts = encoder._tokenizer, []

    class Counted:
        def encode(self, text, **options):
            texts.append(text)
            return real.encode(text, **options)

        def encode_batch_fast(self, batch, **options):
            texts.extend(batch)
            return real.encode_batch_fast(batch, **options)

    words = [f"w{n}ord" for n in range(5000)] + ["ΟΔΟΣ", "a b", "x<|endoftext|>", "it's", "é́,", "1.5"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    starts = ends - [len(w.encode()) for w in words]
    encoder._tokenizer = Counted()
    ids, sizes = encoder._encode_words(data, starts, ends)
    alone = [real.encode(w, add_special_tokens=False).ids for w in words]
    assert len(texts) == 2
    assert sizes.tolist() == [len(a) for a in alone]
    assert ids.tolist() == [i for a in alone for i in a]


def test_encoder_gives_freed_memory_back_after_each_call(monkeypatch, plain_ids):
    calls = []
    monkeypatch.setattr(tokens, "release_memory", lambda: calls.append(1))
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(40)] + [None, ""]
    for round_ in range(2):
        ids, stops = encoder.encode(pa.array(texts))
        assert len(calls) == round_ + 1
        begins = [0, *stops[:-1]]
        for text, a, b in zip(texts, begins, stops):
            assert ids[a:b].tolist() == plain_ids(text or "")
