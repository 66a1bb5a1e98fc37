import re

import numpy as np
import pyarrow as pa
import pytest

from llm.conftest import DOCUMENTS, clashing, prose
from nearfield.llm import minhash
from nearfield.llm.common import components


def word_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def expected(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = word_sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for k in range(i):
            b = sets[k]
            shared = len(a & b)
            if a and b and 100 * shared >= 75 * (len(a) + len(b) - shared):
                parent[root(i)] = root(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), least.get(root(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=repr)


def test_equals_brute_force(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == expected(rows)


def test_odd_rows(odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert found(clashing(odd)) == expected(rows)
    assert found(none) == []
    kept = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert {(1, 1, True), (2, 2, True), (5, 5, True), (6, 5, False), (None, None, True)} <= kept


def near(seed, size, changed):
    """Copies of one text of ``size`` words with ever other words replaced."""
    words = prose(seed, size).split()
    return [" ".join(w if (k * 7 + c * 13) % size >= changed else f"x{c}y{k}" for k, w in enumerate(words)) for c in range(40)]


@pytest.mark.parametrize("limits", [{}, {"REGION_ROWS": 6}, {"FAMILY_SHINGLES": 900}, {"REGION_ROWS": 20, "FAMILY_SHINGLES": 500}])
def test_crowded_regions(spark, monkeypatch, limits):
    """Groups of near copies larger than a region or a family may be, an overlap that is no link, exact copies."""
    for name, value in limits.items():
        monkeypatch.setattr(minhash, name, value)
    texts = near(1, 120, 1) + near(2, 90, 2) + [prose(3, 60) + " " + prose(k, 60) for k in range(10, 40)] + [prose(4, 50)] * 30
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    assert found(docs) == expected(rows)


@pytest.mark.parametrize("limits", [{"REGION_ROWS": 32}, {"REGION_ROWS": 64, "FAMILY_SHINGLES": 6000}])
def test_links_inside_a_crowd_that_is_not_linked(spark, monkeypatch, limits):
    """Sets that are all alike below the threshold, in regions beyond the limit, with planted pairs just above it."""
    for name, value in limits.items():
        monkeypatch.setattr(minhash, name, value)
    passage = prose(1, 204)
    texts = [f"{passage} {prose(1000 + k, 47)}" for k in range(400)]
    texts += [f"{passage} {prose(1000 + k, 18)} {prose(5000 + k, 29)}" for k in range(40)]
    rows = list(enumerate(texts))
    want = expected(rows)
    assert len({c for _, _, c in want}) == 400  # the planted pairs are linked, and nothing else
    assert found(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)) == want


def test_deduplicated_keeps_one_of_each_group(odd):
    kept = minhash.deduplicated(clashing(odd))
    assert kept.columns == clashing(odd).columns
    assert sorted(((r.doc_id, len(r.text or "")) for r in kept.collect()), key=repr) == sorted(
        {(i, len(t or "")) for i, t in ((r.doc_id, r.text) for r in odd.collect()) if (i, t and t[:20]) not in {(6, prose(5, 80)[:20]), (9, prose(5, 80)[:20])}},
        key=repr,
    )


def test_signatures_estimate_similarity():
    a = np.unique(np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    b = a[:750]
    share = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(share - 0.75) < 0.12


def test_shingles_of_every_text():
    texts = ["a b c d e f", "A B\tC d\ne F", "a b", "b a", "", " \n", "a b c d e f a b c d e", "é è ê ë ē"]
    sets = minhash.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(s) for s in word_sets(texts)]
    assert (sets[0] == sets[1]).all() and sets[2] != sets[3]


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 11), (3, 1)] + [(100 + k, 101 + k) for k in range(60)] + [(500, 600 + k) for k in range(50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8, 11: 8, **{k: 100 for k in range(100, 161)}, 500: 500, **{600 + k: 500 for k in range(50)}}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
