import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import DOCUMENTS, clashing, prose
from nearfield.llm import decontam


def test_verbatim_items_are_found_and_nothing_else(documents, benchmark_items):
    found = decontam.contaminated_documents(documents, benchmark_items).collect()
    assert len(found) == documents.count()
    texts = {r.doc_id: (r.text or "").lower() for r in documents.collect()}
    items = {r.item_id: r.text.lower() for r in benchmark_items.collect()}
    verbatim = {i for i, t in texts.items() if any(x in t for x in items.values())}
    assert verbatim and {r.doc_id for r in found if r.contaminated} == verbatim
    for r in found:
        assert r.contaminated == (r.best_item is not None) == (r.n_items > 0)
        assert not r.contaminated or 0.5 <= r.coverage <= 1


def planted(spark):
    item = prose(1, 40)
    words = item.split()
    changed = " ".join(w if k % 7 else "other" for k, w in enumerate(words))
    half = " ".join(w if k < 12 or k >= 28 else f"else{k}" for k, w in enumerate(words))  # 60 %, with the answer
    first_half = " ".join(words[:20])
    shuffled = " ".join(sorted(words))
    long_item = prose(2, 150)
    around = [prose(100 + k, 90) for k in range(8)]
    texts = [
        f"{around[0]} {item} {around[1]}",
        f"{around[2]}\n{item.upper()}!",
        f"{around[3]} {changed} {around[3]}",
        f"{around[4]} {half} {around[4]}",
        f"{around[5]} {first_half} {around[5]}",
        f"{around[6]} {shuffled}",
        f"{around[7]} {long_item}",
        prose(99, 3000),
        item.replace(" ", " | "),
    ]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCUMENTS)
    items = spark.createDataFrame([(7, item), (8, long_item), (9, None), (10, ""), (11, item)], "item_id long, text string")
    return docs, items


def test_paraphrases(spark):
    docs, items = planted(spark)
    found = {r.doc_id: r for r in decontam.contaminated_documents(docs, items).collect()}
    assert sorted(k for k, r in found.items() if r.contaminated) == [0, 1, 2, 3, 6, 8]
    assert found[0].best_item == 7 and found[0].n_items == 2 and found[0].coverage == 1
    assert found[6].best_item == 8
    assert abs(found[3].coverage - 0.6) < 1e-9
    kept = decontam.clean_documents(clashing(docs), items)
    assert kept.columns == clashing(docs).columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7]


def test_more_items_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 2)
    docs, items = planted(spark)
    found = {r.doc_id for r in decontam.contaminated_documents(docs, items).where("contaminated").collect()}
    assert found == {0, 1, 2, 3, 6, 8}


def test_long_texts_in_rows_that_overlap(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ROW_STEPS", 3)
    item = prose(1, 40)
    texts = [" ".join([prose(50 + k, k * 16), item, prose(70 + k, 200)]).strip() for k in range(12)]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCUMENTS)
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert decontam.contaminated_documents(docs, items).where("contaminated").count() == 12
    _, own = decontam.items_of(items)
    vocabulary = np.unique(own[0].words)
    found = decontam.occurrences(docs, vocabulary)
    assert found.count() > 12
    monkeypatch.setattr(decontam, "ROW_STEPS", 2048)
    whole = decontam.occurrences(docs, vocabulary)
    assert (decontam.passage_counts(found, len(vocabulary)) >= decontam.passage_counts(whole, len(vocabulary))).all()
    sums = [f.selectExpr("sum(n_passages)").first()[0] for f in (found, whole)]
    assert sums[0] == sums[1] == sum(-(-len(t.split()) // 64) for t in texts)


def test_a_column_of_answers(spark):
    docs, items = planted(spark)
    items = items.selectExpr("item_id", "text", "'nowhere to be found' AS answer")
    found = {r.doc_id for r in decontam.contaminated_documents(docs, items, "answer").where("contaminated").collect()}
    assert found == {0, 1, 2, 6, 8}


def test_odd_rows(spark, odd, none, benchmark_items):
    found = decontam.contaminated_documents(clashing(odd), benchmark_items).collect()
    assert len(found) == odd.count() and not any(r.contaminated for r in found)
    assert decontam.contaminated_documents(none, benchmark_items).count() == 0
    assert not any(r.contaminated for r in decontam.contaminated_documents(odd, benchmark_items.limit(0)).collect())
    assert decontam.clean_documents(odd, benchmark_items).count() == odd.count()
    own = odd.where("doc_id = 9").selectExpr("doc_id AS item_id", "text")
    leaked = decontam.contaminated_documents(odd, own).where("contaminated").collect()
    assert sorted(r.doc_id for r in leaked) == [5, 5, 6, 9, 9]


def test_decomposition_finds_the_leading_directions(spark):
    """Against numpy's SVD of the matrix of all passages."""
    docs = spark.createDataFrame([(k, " ".join([f"w{k % 5}"] * 30 + [f"v{k % 3}"] * 8 + [prose(k, 20)]), None, None, None) for k in range(60)], DOCUMENTS)
    items = docs.selectExpr("doc_id AS item_id", "text")
    _, own = decontam.items_of(items)
    vocabulary = np.unique(np.concatenate([i.words for i in own]))
    found = decontam.occurrences(docs, vocabulary).persist()
    total = found.selectExpr("sum(n_passages)").first()[0]
    counts = decontam.passage_counts(found, len(vocabulary))
    assert total == 60
    weights = np.log((1 + total) / (1 + counts)) + 1
    matrix = np.zeros((60, len(vocabulary)))
    for k, item in enumerate(own):
        np.add.at(matrix[k], np.searchsorted(vocabulary, item.words), 1)
    assert (counts == (matrix > 0).sum(axis=0)).all()
    matrix *= weights
    basis = decontam.latent_basis(found, np.arange(len(vocabulary)), weights, np.zeros((0, len(vocabulary))), rank=8)
    _, values, _ = np.linalg.svd(matrix)
    kept = np.linalg.norm(matrix @ basis) ** 2
    assert kept >= 0.98 * (values[:8] ** 2).sum()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=200), st.integers(0, 300), st.integers(0, 2**32 - 1))
def test_sums_of_rows(sizes, longest, seed):
    rng = np.random.default_rng(seed)
    sizes = np.array([*sizes, *([longest] if longest else [])])
    table, which = rng.normal(size=(7, 5)).astype(np.float32), rng.integers(0, 7, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    assert np.allclose(decontam._row_sums(table, which, starts), np.add.reduceat(table[which], starts, axis=0), atol=1e-3)


def test_sums_of_rows_are_fast():
    """At least half as fast again as one run after another."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 18, 5000)
    table, which, starts = rng.normal(size=(3000, 272)).astype(np.float32), rng.integers(0, 3000, sizes.sum()), np.cumsum(sizes) - sizes

    def least(run):
        times = []
        for _ in range(5):
            begun = time.process_time()
            run()
            times.append(time.process_time() - begun)
        return min(times)

    slow = least(lambda: np.add.reduceat(table[which], starts, axis=0))
    assert least(lambda: decontam._row_sums(table, which, starts)) < slow / 1.5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=90), st.lists(st.integers(0, 5), max_size=90))
def test_subsequence_is_the_longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for k, y in enumerate(b):
            table[i + 1][k + 1] = table[i][k] + 1 if x == y else max(table[i][k + 1], table[i + 1][k])
    assert decontam.subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == table[-1][-1]
