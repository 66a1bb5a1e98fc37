"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, and a
span classifier learns from the weighted votes.

Four base kinds (email, ip, card, phone) are fixed patterns and always stay. For further kinds, generous
patterns propose candidates, and labelers of three sorts vote yes, no or nothing on each: shapes (regex),
gazetteers and context words. Expectation-maximisation over how often each combination of votes occurs in
the corpus gives every labeler's reliability without labels; a logistic classifier trained on the
resulting probabilities, with votes and the span's form as features, decides.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import texts_of
from nearfield.scratch import stored

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("secret", "national_id", "iban", "local_phone", "name")
CONTEXT_CHARS = 48

# ---- base kinds

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at a run of digits: the lookbehind keeps failing runs from being tried at each digit.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` backwards, so that long runs without one cost nothing."""
    found, at, end = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Start and end (code points, end exclusive) of the base kinds, in order of the text."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdecimal() for c in m.group()) <= 15:
                out["phone"].append(m.span())
    return out


# ---- candidates and votes

# Given names and cue words.
GIVEN_NAMES = frozenset(
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph "
    "jessica thomas sarah charles karen anna maria peter hans klaus ursula jean marie pierre carlos jose juan ana "
    "carmen luis ahmed fatima wei li raj priya olga ivan".split()
)
CUES = {
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access key", "bearer", "private key"),
    "national_id": ("ssn", "social security", "national id", "tax id", "insurance number"),
    "iban": ("iban", "account", "bank"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "name": ("name is", "name:", "mr.", "mrs.", "ms.", "dr.", "contact", "dear", "signed", "regards"),
}
COUNTER_CUES = {
    "secret": ("commit", "checksum", "sha1", "sha256", "md5", "digest", "hash"),
    "national_id": ("order", "part", "isbn", "serial"),
    "iban": ("order", "part", "serial", "model"),
    "local_phone": ("order", "invoice", "isbn", "version"),
    "name": ("street", "avenue", "university", "river", "mount", "city"),
}
SECRET_PREFIXES = ("AKIA", "ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "AIza", "eyJ")
IBAN_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "CH": 21, "AT": 20}

_RUN = re.compile(r"[A-Za-z0-9_+/=-]{20,}")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NAME = re.compile(r"(?<=[ :,])([A-Z][a-z]{1,15}) ([A-Z][a-z]{1,20})(?![a-z])")
_TITLE = re.compile(r"\b(?:name is|name:|Mr\.|Mrs\.|Ms\.|Dr\.|Dear|Regards,|Signed)", re.IGNORECASE)


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s)))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Generously proposed spans of the further kinds."""
    found = []
    if _DIGIT.search(text):
        for m in _RUN.finditer(text):
            start, end = m.span()
            while start < end and text[start] in "=/+-":
                start += 1
            while end > start and text[end - 1] in "=/+-":
                end -= 1
            if end - start >= 20 and _DIGIT.search(text, start, end):
                found.append(("secret", start, end))
        found += [("national_id", *m.span()) for m in _NATIONAL.finditer(text)]
        found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
        found += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    if _TITLE.search(text):
        found += [("name", *m.span()) for m in _NAME.finditer(text)]
    return found


def _shape(kind: str, span: str, before: str, after: str) -> int:
    if kind == "secret":
        return 1 if _entropy(span) >= 3 else -1
    digits = [c for c in span if c.isdecimal()]
    if kind in ("national_id", "local_phone"):
        return -1 if len(set(digits)) <= 2 else 1
    if kind == "iban":
        return 1 if IBAN_LENGTHS.get(span[:2]) == len(span.replace(" ", "")) else -1
    return 0


def _gazetteer(kind: str, span: str, before: str, after: str) -> int:
    if kind == "secret":
        return 1 if span.startswith(SECRET_PREFIXES) or re.fullmatch("(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})", span) else 0
    if kind == "national_id":
        return -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 0
    if kind == "iban":
        compact = span.replace(" ", "")
        moved = "".join(str(int(c, 36)) for c in compact[4:] + compact[:4])
        return 1 if int(moved) % 97 == 1 else -1
    if kind == "name":
        return 1 if span.split()[0].lower() in GIVEN_NAMES else -1
    return 0


def _cue(kind: str, span: str, before: str, after: str) -> int:
    return 1 if any(c in before for c in CUES[kind]) else 0


def _counter_cue(kind: str, span: str, before: str, after: str) -> int:
    return -1 if any(c in before for c in COUNTER_CUES[kind]) else 0


def _assigned(kind: str, span: str, before: str, after: str) -> int:
    return 1 if before.rstrip(" \"'`")[-1:] in ("=", ":") else 0


LABELERS: tuple[Callable[[str, str, str, str], int], ...] = (_shape, _gazetteer, _cue, _counter_cue, _assigned)


def pattern_of(text: str, kind: str, start: int, end: int) -> str:
    """What the classifier sees of a span: kind, votes, length and share of digits, roughly."""
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT_CHARS) : start].lower(), text[end : end + CONTEXT_CHARS].lower()
    votes = "".join("n0y"[vote(kind, span, before, after) + 1] for vote in LABELERS)
    size = min(3, len(span) // 16)
    digits = min(3, 4 * sum(c.isdecimal() for c in span) // len(span))
    return f"{kind} {votes} {size} {digits}"


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def proposed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, counts and digest of the base spans, and the candidates that overlap none of them."""
    candidate = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("pattern", T.StringType())]
    )
    fields = [
        docs.schema[id],
        *(T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS),
        T.StructField("base", T.StringType()),
        T.StructField("candidates", T.ArrayType(candidate)),
    ]
    arrow_candidates = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = []
            bases, proposals = [], []
            for value in texts_of(batch.column(1)):
                text = value.as_py()
                spans = base_spans(text)
                base = [(k, *s) for k in BASE_KINDS for s in spans[k]]
                taken = sorted((a, b) for _, a, b in base)
                more, end = [], 0
                for kind, a, b in sorted(candidates(text), key=lambda c: (c[1], EXTRA_KINDS.index(c[0]))):
                    if a >= end and not any(x < b and a < y for x, y in taken):
                        more.append({"kind": kind, "start": a, "end": b, "pattern": pattern_of(text, kind, a, b)})
                        end = b
                counts.append([len(spans[k]) for k in BASE_KINDS])
                bases.append(_joined(base))
                more.sort(key=lambda c: (EXTRA_KINDS.index(c["kind"]), c["start"]))
                proposals.append(more)
            numbers = np.array(counts, np.int64).reshape(-1, len(BASE_KINDS))
            out = [batch.column(0), *(pa.array(numbers[:, k]) for k in range(len(BASE_KINDS)))]
            out += [pa.array(bases, pa.string()), pa.array(proposals, arrow_candidates)]
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return docs.select(F.col(id), F.col(text)).mapInArrow(run, T.StructType(fields))


# ---- reliabilities and classifier


def reliabilities(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """Probability that each pattern is personal data, and P(vote | class) by labeler, by expectation-maximisation.

    ``patterns``: how often each occurs. Starts from the votes' balance; labelers vote independently
    given the class, with the same reliabilities for all kinds and a share of true spans for each kind.
    """
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    kinds = [p.split()[0] for p in names]
    votes = np.array([["n0y".index(v) for v in p.split()[1]] for p in names]).reshape(len(names), len(LABELERS))
    true = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(axis=1)))
    chance = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        for c, weight in enumerate((1 - true, true)):
            for j in range(len(LABELERS)):
                seen = np.bincount(votes[:, j], weights=n * weight, minlength=3) + 0.5
                chance[c, j] = seen / seen.sum()
        logs = np.zeros((len(names), 2))
        for k in set(kinds):
            of = np.array([x == k for x in kinds])
            share = ((n * true)[of].sum() + 1) / (n[of].sum() + 2)
            logs[of] = np.log([1 - share, share])
        for c in (0, 1):
            logs[:, c] += sum(np.log(chance[c, j, votes[:, j]]) for j in range(len(LABELERS)))
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -30, 30)))
        if np.abs(new - true).max(initial=0) < 1e-9:
            break
        true = new
    return dict(zip(names, true.tolist(), strict=True)), chance


def _features(pattern: str) -> np.ndarray:
    kind, votes, size, digits = pattern.split()
    parts = [[kind == k for k in EXTRA_KINDS], *[[v == "y", v == "n"] for v in votes]]
    parts += [[size == str(k) for k in range(4)], [digits == str(k) for k in range(4)]]
    return np.array([1.0, *itertools.chain.from_iterable(parts)], float)


def train(patterns: dict[str, int], ridge: float = 0.1) -> Callable[[str], float]:
    """The span classifier: a logistic curve over a pattern's features, fitted to the estimated probabilities."""
    if not patterns:
        return lambda pattern: 0.0
    soft, _ = reliabilities(patterns)
    x = np.stack([_features(p) for p in soft])
    y, n = np.array(list(soft.values())), np.array([patterns[p] for p in soft], float)
    n /= n.mean()
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return lambda pattern: float(1 / (1 + np.exp(-np.clip(_features(pattern) @ w, -30, 30))))


def private_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", accept: float = 0.5) -> DataFrame:
    """For each row: id, n_email, n_ip, n_card, n_phone, n_more, base_sha256, spans.

    ``spans`` joins kind:start:end of the base kinds in their order, then of the accepted further spans, by
    kind and then start like those. Null and empty texts have none. Repeated rows get equal results.
    """
    found = stored(proposed(docs, id, text), "pii")
    each = found.select(F.explode("candidates.pattern").alias("pattern"))
    # a pattern has five votes and a few form classes: a few thousand rows whatever the corpus size
    patterns = {r["pattern"]: r["count"] for r in each.groupBy("pattern").count().collect()}
    classify = train(patterns)
    kept = sorted(p for p in patterns if classify(p) >= accept)
    more = F.filter("candidates", lambda c: c["pattern"].isin(kept)) if kept else F.filter("candidates", lambda c: F.lit(False))
    texts = F.transform(more, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string")))
    base = F.when(F.col("base") != "", F.col("base"))
    return found.select(
        id,
        *(f"n_{k}" for k in BASE_KINDS),
        F.size(more).cast("long").alias("n_more"),
        F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", base, F.when(F.size(more) > 0, F.array_join(texts, ","))).alias("spans"),
    )


def base_digest(text: str | None) -> str:
    spans = base_spans(text or "")
    return hashlib.sha256(_joined([(k, *s) for k in BASE_KINDS for s in spans[k]]).encode()).hexdigest()
