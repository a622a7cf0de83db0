"""Token files and packing: exact round trips, and the plan against one-by-one best fit."""

import random
import zlib

from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from refinery.llm import packing, tokenfiles
from refinery.llm.encode import encoder

TEXTS = [None, "", " ", "a", "The quick, brown fox.\nJumps!! over\n\nthe lazy dog's 3.14", "  two  blanks \t tab", "é ñ 漢字 🙂 a b",
         "<|endoftext|> in a text", "don't 'tis we'll x's", "the&&& word$$$ it's'", "\0 nul \0", "long " * 3000, "x" * 9000]


@lru_cache
def fresh():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(text):
    """The contract's call, on the tokenizer as the library loads it."""
    return fresh().encode(text or "", add_special_tokens=False).ids + [0]


def ids_of(text):
    return np.frombuffer(encoder().encode(text), "<u4").tolist()


def test_encoder_equals_the_library_on_whole_texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice(["ab", "Zé", " ", "\n", ".", "'s", "!!", "12", "&", "\t", "ß", "'", "_"]) for _ in range(30))
            for _ in range(400)]
    for text in [*TEXTS, *made]:
        assert ids_of(text) == plain(text), text


@pytest.mark.parametrize("text", ["<|endoftext|>", "hi <|endoftext|> there", "in<|endoftext|>side", "<|endoftext|>first",
                                  "last<|endoftext|>", "a <|endoftext|><|endoftext|> b", "not <|endoftext| > one", "line\n<|endoftext|>\n"])
def test_added_tokens_in_a_text_as_the_library_takes_them(text):
    assert ids_of(text) == plain(text)
    ordinary = np.frombuffer(encoder(added=False).encode(text), "<u4")
    assert 50256 not in ordinary and fresh().decode(ordinary[:-1], skip_special_tokens=False) == text


def test_texts_of_a_unit_keep_their_order(monkeypatch):
    texts = [t for t in TEXTS for _ in range(3)]
    for unit in (1, 40, 1 << 20):
        monkeypatch.setattr("refinery.llm.encode.UNIT", unit)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder().encode_all(texts)] == [plain(t) for t in texts]


def test_stretches_change_nothing(monkeypatch):
    monkeypatch.setattr("refinery.llm.encode.STRETCH", 7)
    for text in ("one two three four five, six.\nSeven eight nine", " lead", "trail ", "w" * 50, "a b c d e f g h i j"):
        assert ids_of(text) == plain(text)


def test_memo_limit_changes_nothing():
    for memo in (1, 2, 6):
        e = encoder(memo=memo)
        for text in ("one two three four five six, seven.", "one one two, two. one!"):
            assert np.frombuffer(e.encode(text), "<u4").tolist() == plain(text)


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 24, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2 ** bits, 1000).astype("<u4")
    data = tokenfiles.pack_bits(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    assert (tokenfiles.unpack_bits(data, 1000, bits) == ids).all()


@pytest.mark.parametrize("bits", [16, 17])
def test_file_random_access(bits):
    texts = [np.arange(n, dtype="<u4").tobytes() for n in (3, 1, 5000, 0, 17)]
    data = tokenfiles.file_bytes([5, None, 7, 8, 9], texts, bits, block=64)
    f = tokenfiles.TokenFile(data)
    assert f.bits == bits and f.n_docs == 5 and f.n_ids == 5021 and len(f.offsets) == -(-5021 // 64) + 1
    assert [d for d, _, _ in f.documents()] == [5, None, 7, 8, 9]
    assert [x.astype("<u4").tobytes() for _, _, x in f.documents()] == texts
    whole = np.frombuffer(b"".join(texts), "<u4")
    for a, b in ((0, 1), (63, 65), (100, 4000), (5020, 9999), (4, 4)):
        assert (f.read(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        tokenfiles.file_bytes([1], [np.array([1 << bits], "<u4").tobytes()] if bits < 32 else [], bits)


def test_bits_for_a_vocabulary():
    assert [tokenfiles.bits_for(v) for v in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_files_hold_documents_in_order(spark, docs):
    rows = [(i * 7 % 13, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    got = tokenfiles.encode_to_files(docs(rows, start=1, name="x"), file_ids=500).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    want = sorted((d if d is not None else -1, len(plain(t)), zlib.crc32(np.array(plain(t), "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got) == want
    assert tokenfiles.encode_to_files(docs([])).collect() == []


def one_by_one(lengths, capacity):
    """Best-fit decreasing as the textbook has it."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b >= n]
        if fits:
            b = min(fits)
            bins[bins.index(b)] -= n
        else:
            bins.append(capacity - n)
    return len(bins), sorted(bins)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 7, 16, 50])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    filled: dict[int, list] = {}
    placed = {n: 0 for n in counts}
    for r in packing.best_fit_plan(counts, capacity):
        assert r.first_rank == placed[r.length]
        placed[r.length] += r.bins * r.per_bin
        for b in range(r.first_bin, r.first_bin + r.bins):
            spans = filled.setdefault(b, [])
            spans += [(r.offset + k * r.length, r.length) for k in range(r.per_bin)]
    assert placed == counts
    for spans in filled.values():
        assert [s for s, _ in sorted(spans)] == np.cumsum([0] + [n for _, n in sorted(spans)])[:-1].tolist()
    n, rest = one_by_one(lengths, capacity)
    assert sorted(filled) == list(range(n))
    assert sorted(capacity - sum(x for _, x in s) for s in filled.values()) == rest


def check_packed(rows, got, capacity):
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert sum(r.length for r in parts) <= capacity
    for doc_id, text in rows:
        ids, parts = plain(text), sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == capacity for r in parts[1:])
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    assert len(by_seq) == one_by_one([r.length for r in got], capacity)[0]


def test_packing_and_sequences(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "same") for i in range(40)]
    packed = packing.pack(docs(rows, piece=9, length="x"), capacity=64, keep_ids=True)
    check_packed(rows, packed.collect(), 64)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_without_rows_ids_or_text(spark, docs):
    assert packing.pack(docs([])).collect() == []
    got = packing.pack(docs([(None, None), (None, None), (1, "")])).collect()
    assert [(r.length, r.start) for r in got] == [(1, 0)] * 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


def test_packing_is_spread(spark, docs):
    """Equal lengths in many chunks get ranks that fit together."""
    rows = [(i, "w " * (i % 5)) for i in range(300)]
    got = packing.pack(docs(rows).repartition(7), capacity=32).collect()
    check_packed(rows, got, 32)
