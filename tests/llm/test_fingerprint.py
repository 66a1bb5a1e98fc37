import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import DOCUMENTS, clashing, prose
from nearfield.llm import fingerprint as fp
from nearfield.llm.common import mixed


def by_definition(text):
    """Each slot from all elements: the PICKS that come first from the slot's start on the circle."""
    points = [ord(c) for c in text] + [0x110000] * max(0, fp.KMER - len(text))
    kmers = []
    for k in range(len(points) - fp.KMER + 1):
        value = 0
        for p in points[k : k + fp.KMER]:
            value = (value * 0x9E3779B97F4A7C15 + p) % 2**64
        kmers.append(int(mixed(np.array([value], np.uint64))[0]))
    seen, elements = {}, []
    for place, kmer in enumerate(kmers):
        n = seen[kmer] = seen.get(kmer, -1) + 1
        elements.append((int(mixed(np.array([(kmer + n * 0xD6E8FEB86659FD93) % 2**64], np.uint64))[0]), place))
    out = []
    for slot in range(fp.SLOTS):
        start = slot * 2**64 // fp.SLOTS
        near = sorted(elements, key=lambda e: (e[0] - start) % 2**64)[: fp.PICKS]
        value = 0
        for k, place in enumerate(sorted(place for _, place in near)):
            value = int(mixed(np.array([(value + kmers[place] + k + 1) % 2**64], np.uint64))[0])
        out.append(value >> 48)
    return out


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abé😀 ", max_size=80))
def test_slots_are_minima_in_text_order(text):
    assert fp.fingerprint(text).tolist() == by_definition(text)


def test_long_texts_take_the_short_way_to_the_same_slots():
    text = prose(1, 4000)
    assert len(text) > 64 * fp.SLOTS
    assert fp.fingerprint(text).tolist() == by_definition(text)


def test_order_matters():
    """Two texts with nearly the same k-mers in another order are less alike than a small edit."""
    parts = [prose(k, 40) for k in range(8)]
    text = " ".join(parts)
    moved = " ".join(parts[::-1])
    edit = text[:500] + "xyz" + text[503:]
    like = lambda other: fp.likeness(fp.fingerprint(text), fp.fingerprint(other))
    assert like(text) == 1 and like(edit) > 0.8 and like(moved) < 0.75 < like(edit)
    assert like(prose(77, 320)) < 0.1


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        changed = fp.edited(text, after)
        prints = [fp.fingerprint(t) for t in (text, changed, after)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), digest, fp.as_text(prints[0]), fp.as_text(prints[1]), fp.likeness(*prints[:2]), fp.likeness(prints[0], prints[2])))
    return sorted(out, key=repr)


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, fp.fingerprints(docs).collect()), key=repr) == expected(rows)


def test_next_rows_over_parts(spark, documents, monkeypatch):
    check(documents)
    monkeypatch.setattr(fp, "ROWS_PER_PART", 7)
    check(documents)


def test_odd_rows(spark, odd, none, monkeypatch):
    one = odd.where("doc_id = 6")
    check(one)
    distinct = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check(clashing(distinct))
    monkeypatch.setattr(fp, "ROWS_PER_PART", 1)
    check(distinct.unionByName(odd.where("doc_id IS NULL AND text IS NULL")))
    assert fp.fingerprints(none).count() == 0
    found = fp.fingerprints(odd).collect()
    assert len(found) == odd.count()
    assert len({r.fingerprint for r in found if r.doc_id == 5}) == 1


def test_equal_rows_at_the_ends_of_parts(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_PART", 2)
    docs = spark.createDataFrame([(3, "abc def ghi", None, None, None)] * 9 + [(2, "xyz uvw rst", None, None, None)] * 5, DOCUMENTS).repartition(4)
    check(docs)
