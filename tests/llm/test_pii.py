import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import DOCUMENTS, clashing
from nearfield.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_definition(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def spans(text):
    return [(k, *s) for k, own in pii.base_spans(text).items() for s in own]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+1 2530()é%_", max_size=60))
def test_base_kinds_are_the_patterns(text):
    assert spans(text) == by_definition(text)


def test_known_spans():
    text = "é x.y+z@a-b.co.uk, 1.2.3.4.5 256.1.1.1 no 4539 1488 0343 6467; +1 (555) 123-4567 a@b @c.d e@@f.g"
    assert spans(text) == by_definition(text)
    assert [k for k, *_ in spans(text)] == ["email", "ip", "card", "phone"]
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")


def test_long_runs_take_no_quadratic_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "1-" * 150_000):
        spans(text)
        pii.candidates(text)


def test_query_over_documents(documents):
    found = {r.doc_id: r for r in pii.private_spans(documents).collect()}
    for r in documents.collect():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in by_definition(r.text or ""))
        own = found[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(base.encode()).hexdigest() == pii.base_digest(r.text)
        assert own.spans == base or own.spans.startswith(base + "," if base else "") and own.n_more
        assert own.n_email + own.n_ip + own.n_card + own.n_phone + own.n_more == len(list(filter(None, own.spans.split(","))))


def test_further_kinds_need_the_votes(spark):
    texts = [
        'token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" and',
        "commit 0b96a8c8d79c4a5085c919698889f59b72ab7bb7 fixes",
        "her social security number: 123-45-6789.",
        "order part 666-00-0000 was late",
        "IBAN: DE89 3704 0044 0532 0130 00 at the bank",
        "call 415-555-2671 my phone",
        "Dear Maria Lopez, regards",
        "in the morning, 12:30, nothing",
    ]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts * 12)]
    found = {r.doc_id: r.spans for r in pii.private_spans(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    kinds = [found[k].split(":")[0] for k in range(len(texts))]
    assert kinds == ["secret", "", "national_id", "", "iban", "local_phone", "name", ""]
    start, end = map(int, found[0].split(":")[1:])
    assert texts[0][start:end] == "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"


def test_reliabilities_are_recovered():
    """Votes drawn from known reliabilities: the better labelers get the better odds."""
    rng = np.random.default_rng(1)
    right = [0.95, 0.9, 0.85, 0.6, 0.55]
    patterns: dict[str, int] = {}
    truth: dict[str, list[int]] = {}
    for _ in range(4000):
        true = rng.random() < 0.4
        votes = "".join("y" if (rng.random() < r) == true else "n" for r in right)
        key = f"secret {votes} 2 1"
        patterns[key] = patterns.get(key, 0) + 1
        truth.setdefault(key, []).append(int(true))
    soft, chance = pii.reliabilities(patterns)
    found = [(chance[1, j, 2] + chance[0, j, 0]) / 2 for j in range(5)]
    assert np.allclose(found, right, atol=0.08)
    for key, labels in truth.items():
        if len(labels) > 100:
            assert abs(soft[key] - np.mean(labels)) < 0.15
    classify = pii.train(patterns)
    assert classify("secret yyyyy 2 1") > 0.9 and classify("secret nnnnn 2 1") < 0.1


def test_odd_rows(odd, none):
    found = pii.private_spans(clashing(odd)).collect()
    assert len(found) == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in found if r.doc_id in (1, 2, 3))
    assert pii.private_spans(none).count() == 0
