import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.conftest import ODD, clashing
from nearfield.llm import packing


@pytest.fixture(scope="module")
def spec():
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def words(spec):
    return packing.WordTokenizer(spec)


@pytest.fixture(scope="module")
def whole(spec):
    return Tokenizer.from_str(spec)


def ids(whole, text):
    return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_are_the_tokenizers(spark, words, whole, testdata):
    texts = ["", " ", "it's we'll 'S don''t", "Ünï²³ ¼x½ 5_6__7 a.b,c!!'s", "İstanbul ǅ ŉ ß", "日本語 text", "a\0b", "x\x1cy\x85z\xa0w", "Σας ΟΔΟΣ",
             "<|endoftext|> </w> a</w>b", "!!!'sabc", "é ﬁ", "😀🏳️‍🌈 ok", "a" * 5000, "1234567890" * 50]
    rng = random.Random(4)
    texts += ["".join(chr(rng.randint(1, 0x24F)) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += [r.text for r in spark.read.parquet(f"{testdata}/documents.parquet").collect()]
    assert words.encode(texts) == [ids(whole, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40))
def test_ids_of_any_text(words, whole, text):
    assert words.encode([text]) == [ids(whole, text)]


def test_each_token_is_merged_from_its_parts(words, whole):
    """Why merging by rank of the merged bytes gives the same ids: every token, by itself, is one id."""
    end = {i: t for t, i in whole.get_vocab().items() if t.endswith("</w>") and len(t) > 4}
    plain = {t[:-4] for t in end.values() if t[:-4].isascii() and t[:-4].isalpha() and t[:-4].islower()}
    assert len(plain) > 20_000
    texts = sorted(plain)
    assert all(len(x) == 4 for x in words.encode(texts))


def test_forgetting_words_changes_nothing(words, whole, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    texts = [f"some new words {k} and {k * 7}x again" for k in range(50)]
    assert [x for t in texts for x in words.encode([t])] == [ids(whole, t) for t in texts]


def naive(lengths, capacity):
    """Best-fit decreasing, piece by piece: the number of sequences."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 60))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    taken: dict[int, list[tuple[int, int]]] = {}
    ranks: dict[int, list[int]] = {}
    for n, lo, hi, first, fits, base in packing.best_fit_plan(counts, capacity):
        for rank in range(lo, hi):
            ranks.setdefault(n, []).append(rank)
            taken.setdefault(first + (rank - lo) // fits, []).append((base + (rank - lo) % fits * n, n))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for places in taken.values():
        places.sort()
        assert [a for a, _ in places] == list(np.cumsum([0] + [n for _, n in places])[:-1])
        assert sum(n for _, n in places) <= capacity
    assert len(taken) == naive(lengths, capacity)
    assert sorted(taken) == list(range(len(taken)))


def check(docs, rows, whole, capacity):
    found = packing.pack_documents(docs, capacity=capacity, with_ids=True).collect()
    want = []
    for i, text in rows:
        raw = ids(whole, text or "") + b"\1\0\0\0"
        for k, at in enumerate(range(0, len(raw), 4 * capacity)):
            part = raw[at : at + 4 * capacity]
            want.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4").tolist()))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.token_ids) for r in found), key=repr) == sorted(want, key=repr)
    by_sequence: dict[int, list[tuple[int, int]]] = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [a for a, _ in places] == list(np.cumsum([0] + [n for _, n in places])[:-1])
        assert sum(n for _, n in places) <= capacity
    assert len(by_sequence) == naive([w[3] for w in want], capacity)


def test_documents_are_packed(documents, whole):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows, whole, 4096)
    check(documents, rows, whole, 300)


def test_odd_rows(odd, none, whole):
    check(clashing(odd), [r[:2] for r in ODD], whole, 128)
    assert packing.pack_documents(none).count() == 0


def test_lengths_out_of_range_are_refused(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 9, 1)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError, match="lengths must be 1 to 8"):
        packing.pack(pieces, 8)
