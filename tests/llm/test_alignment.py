import hashlib

import pytest

from llm.conftest import DOCUMENTS, clashing, prose
from nearfield.llm import alignment

ODD_TEXTS = [
    "  lead  and trail  ", "<|endoftext|> <s> </s> <unk> <0x41> a", "é ﬁ ½ 日本", "▁x", "don't  stop\n\nnow", "a" * 50_000,
    " " * 5_000, "\t" * 3_000 + "x", "\u0000",
]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    paths = alignment.default_tokenizers()
    first = Tokenizer.from_file(paths[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    left, right = alignment.ByteTokens(open(paths[0], encoding="utf-8").read()).bytes, alignment.PieceTokens(open(paths[1], "rb").read()).bytes

    def encode(text):
        """[(id, end)] of both tokenizers, or None."""
        if not text:
            return None
        out = []
        for ids, spelled in ((first.encode(" " + text, add_special_tokens=False).ids, left), (second.encode(text), right)):
            if b"".join(spelled[k] for k in ids) != (" " + text).encode():
                return None
            end, side = 0, []
            for k in ids:
                end += len(spelled[k])
                side.append((k, end))
            out.append(side)
        return out

    return encode


def expected(texts, encode):
    """All figures from the definition: cuts where tokens of both end, links of equal ends, counts over all."""
    sides, counts = [encode(t) for t in texts], {}
    links = []
    for s in sides:
        b_at = {end: k for k, end in s[1]} if s else {}
        links.append([(k, b_at[end]) for k, end in s[0] if end in b_at] if s else [])
        for pair in links[-1]:
            counts[pair] = counts.get(pair, 0) + 1
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for s, ls in zip(sides, links, strict=True):
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = {end for _, end in s[0]} & {end for _, end in s[1]}
        spelled, places = [], [0, 0]
        for cut in sorted(cuts):
            group = []
            for k in (0, 1):
                at = places[k]
                while s[k][places[k]][1] < cut:
                    places[k] += 1
                places[k] += 1
                group.append(",".join(str(i) for i, _ in s[k][at : places[k]]))
            spelled.append("|".join(group))
        digest = hashlib.sha256(";".join(spelled).encode()).hexdigest()
        best = sum(counts[p] == highest[p[1]] for p in ls)
        out.append((len(s[0]), len(s[1]), len(cuts), len(ls), best, sum(counts[p] for p in ls), digest))
    return out


def found(docs):
    rows = alignment.aligned(docs).collect()
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in rows), key=repr)


def compared(docs, encode):
    rows = docs.select("doc_id", "text").collect()
    return sorted(zip([r.doc_id for r in rows], expected([r.text for r in rows], encode), strict=True), key=repr)


def test_equals_definition(documents, tokenizers):
    assert found(documents) == compared(documents, tokenizers)


def test_odd_rows(spark, odd, none, tokenizers, monkeypatch):
    texts = spark.createDataFrame([(100 + k, t, None, None, None) for k, t in enumerate(ODD_TEXTS)], DOCUMENTS)
    docs = odd.unionByName(texts)
    monkeypatch.setattr(alignment, "BLOCK", 2_000)
    assert found(clashing(docs)) == compared(docs, tokenizers)
    assert found(none) == []
    assert {(1, (0, 0, 0, 0, 0, 0, "")), (2, (0, 0, 0, 0, 0, 0, ""))} <= set(found(odd))


def test_pieces_of_a_long_text_give_the_ids_of_the_whole(tokenizers):
    text = "  two  spaces, then\ttabs \n" * 30 + prose(3, 20_000) + "  end "
    pieces = list(alignment.pieces_of(text, 1_000))
    assert len(pieces) > 50 and " ".join(pieces) == text
    for side in (0, 1):
        cut = [k for p in pieces for k, _ in tokenizers(p)[side]]
        assert cut == [k for k, _ in tokenizers(text)[side]]


def test_long_chains_converge():
    import numpy as np

    # tokens of 2 bytes against tokens of 2 bytes shifted by one: one group
    n = 50_000
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    groups = alignment.groups(a, b)
    assert not groups[0].any() and not groups[1].any()
