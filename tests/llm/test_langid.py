import numpy as np
import pytest

from llm.conftest import DOCUMENTS, clashing
from nearfield.llm import langid
from nearfield.llm.common import fold


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identified_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)
    short = langid.identified_documents(docs.limit(50).selectExpr("doc_id", "substr(text, 1, 3) AS text", "lang"))
    assert np.mean([r.score for r in short.collect()]) < np.mean([r.score for r in found])


def test_odd_rows(spark, odd, none):
    model = langid.fit(odd.where("lang = 'en' OR lang = 'ja'"))
    assert set(model.languages) == {"en", "ja"}
    found = langid.predict(clashing(odd), model).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for k in (1, 2, 3):
        assert (by_id[k].lang_pred, by_id[k].score, by_id[k].accepted) == ("und", 0.0, False)
    assert by_id[4].lang_pred == "en" and by_id[4].score > 0.5
    assert langid.identified_documents(none).count() == 0
    nothing = langid.identified_documents(odd.where("lang IS NULL"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(k, f"abc def ghi jkl mno {k} pqr", "xx", "s", 1) for k in range(200)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    held = docs.where(fold("doc_id", 4) == 2).selectExpr("doc_id", "text", "'yy' AS lang", "source", "n_chars")
    mixed = docs.where(fold("doc_id", 4) != 2).unionByName(held)
    assert {r.lang_pred for r in langid.identified_documents(mixed).collect()} == {"xx"}


@pytest.fixture(scope="module")
def small():
    """Counts of two tiny languages."""
    texts = [["the cat sat on the mat", "the hat", "that cat"], ["le chat est la", "la le le chatte"]]
    rows = {}
    for lang, own in enumerate(texts):
        row, _ = langid.symbols(own)
        first, low = langid.grams(row)
        for a, b, keep in zip(first.tolist(), low.tolist(), (row != langid.PAD).tolist()):
            if keep:
                rows[lang, a, b] = rows.get((lang, a, b), 0) + 1
    table = np.array([(*k, n) for k, n in rows.items()], [("lang", np.int64), ("first", np.uint64), ("low", np.uint64), ("count", np.int64)])
    tables, floor = langid._estimate(["en", "fr"], table)
    return langid.LanguageModel(("en", "fr"), tables, floor, np.zeros(2), np.ones(2)), table


def test_probabilities_sum_to_one(small):
    """Over the alphabet and one share for every other character, after any context."""
    model, table = small
    alphabet = np.unique(table["low"] & np.uint64((1 << 21) - 1))
    for context in ("the", "cat", "zzz", "hat", "la ", " th", "xth"):
        a, b, c = (np.uint64(ord(x)) for x in context)
        low = b << np.uint64(42) | c << np.uint64(21) | np.append(alphabet, np.uint64(ord("ж")))
        p = np.exp(model.logp(np.full(len(low), a, np.uint64), low).astype(float))
        assert np.allclose(p.sum(axis=0), 1, atol=1e-4), context


def test_lookup_is_interpolated_kneser_ney(small):
    """Against the textbook recursion with dictionaries."""
    model, table = small
    mask = (1 << 21) - 1
    for lang in (0, 1):
        counts = {4: {(int(a), int(b) >> 42, int(b) >> 21 & mask, int(b) & mask): int(n) for x, a, b, n in table if x == lang}}
        for order in (3, 2, 1):
            counts[order] = {}
            for gram in counts[order + 1]:
                counts[order][gram[1:]] = counts[order].get(gram[1:], 0) + 1
        discount = {}
        for order, own in counts.items():
            once, twice = sum(n == 1 for n in own.values()), sum(n == 2 for n in own.values())
            discount[order] = min(0.95, max(0.1, once / max(1, once + 2 * twice)))

        def p(gram):
            if not gram:
                return float(np.exp(model.floor[lang]))
            order, context = len(gram), gram[:-1]
            after = {g: n for g, n in counts[order].items() if g[:-1] == context}
            if not after:
                return p(gram[1:])
            total = sum(after.values())
            return max(0, after.get(gram, 0) - discount[order]) / total + discount[order] * len(after) / total * p(gram[1:])

        for gram in [*list(counts[4])[:40], tuple(map(ord, "zzze")), tuple(map(ord, "thex")), tuple(map(ord, "chat"))]:
            first, low = np.array([gram[0]], np.uint64), np.array([gram[1] << 42 | gram[2] << 21 | gram[3]], np.uint64)
            assert np.isclose(np.exp(model.logp(first, low)[0, lang]), p(gram), rtol=1e-3), gram


def test_symbols():
    row, text = langid.symbols(["Ab, c!", "", "  É1é"])
    assert [chr(c) if c > 1 else "_" for c in row.tolist()] == list("___ab c ______é é")
    assert text.tolist() == [0] * 8 + [1] * 3 + [2] * 6


def test_a_rare_language_is_counted_whole(spark):
    """Three documents, all of which would be held back for the calibration."""
    held = [r.id for r in spark.range(2000).selectExpr("id", "pmod(xxhash64('calibrate', id), 8) AS k").where("k = 0").limit(3).collect()]
    rows = [(i, "zyx wvu tsr qpo zyxw vuts rqpo " * 8, "zz") for i in held]
    rows += [(3000 + k, f"the cat and the dog went home number {k} ", "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    found = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(found[i] == "zz" for i in held) and sum(found[3000 + k] == "en" for k in range(60)) == 60
