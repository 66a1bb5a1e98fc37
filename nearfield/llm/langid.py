"""Language identification by interpolated Kneser-Ney character models, one for each language.

The models' n-grams lie in arrays sorted by a hash of the n-gram, with the log probability under every
language beside it, so that a text is scored by one binary search for each character. The language of
the lowest cross-entropy per character wins. How far that entropy may lie above what texts of the
language usually have is calibrated on training documents that no count has seen; beyond, the
prediction is marked as not accepted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import blocks, fold, joined_points, mixed, texts_of

ORDER = 4
PAD, SPACE = 1, 32
_BITS = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)
#: Score of evidence: so many characters count at most, so that long texts don't all get 1.
EVIDENCE_CHARS = 60


#: Documents of a language in the sample from which on some are held back.
ENOUGH = 40
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point the lower-case letter that it counts as, else a space."""
    if not _LETTERS:
        table = np.full(0x110000, SPACE, np.uint32)
        for point in range(0x110000):
            if chr(point).isalpha():
                table[point] = ord(chr(point).lower()[0])
        _LETTERS.append(table)
    return _LETTERS[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts in a row, runs of anything else as one space, and each one's text number.

    Each text begins with ORDER - 1 pads.
    """
    points, offsets = joined_points(texts)
    which = np.repeat(np.arange(len(texts)), np.diff(offsets))
    row = np.full(len(points) + (ORDER - 1) * len(texts), PAD, np.uint32)
    row[np.arange(len(points)) + (ORDER - 1) * (which + 1)] = _letters()[points]
    text = np.repeat(np.arange(len(texts)), np.diff(offsets) + ORDER - 1)
    keep = row != SPACE
    keep[1:] |= (row[:-1] != SPACE) & (row[:-1] != PAD)
    return row[keep].astype(np.uint64), text[keep]


def grams(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the character three before, and the last three packed into one integer."""
    before = np.concatenate([np.full(ORDER - 1, PAD, np.uint64), row])
    low = before[1:-2] << (_BITS + _BITS) | before[2:-1] << _BITS | before[3:]
    return before[:-3], low


def hashed(first: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mixed(mixed(first + np.uint64(0x9E3779B97F4A7C15)) ^ low)


@dataclass(frozen=True)
class Table:
    """n-grams of one order: sorted keys; log probability of the n-gram, and log weight that it leaves to
    shorter ones as a context, under each language."""

    keys: np.ndarray
    logp: np.ndarray
    backoff_keys: np.ndarray
    backoff: np.ndarray

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass(frozen=True)
class LanguageModel:
    """languages; tables by order 1 to ORDER; log probability of an unseen character; each language's
    usual cross-entropy and its spread."""

    languages: tuple[str, ...]
    tables: tuple[Table, ...]
    floor: np.ndarray
    usual: np.ndarray
    spread: np.ndarray

    def logp(self, first: np.ndarray, low: np.ndarray) -> np.ndarray:
        return _logp(self.tables, self.floor, first, low, ORDER)


def _key(first: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """Of the last ``order`` characters."""
    if order == ORDER:
        return hashed(first, low)
    return mixed(low & ((np.uint64(1) << np.uint64(21 * order)) - np.uint64(1)))


def _context_key(first: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """Of the ``order - 1`` characters before the last."""
    packed = first << (_BITS + _BITS) | low >> _BITS if order == ORDER else low >> _BITS
    return mixed(packed & ((np.uint64(1) << np.uint64(21 * (order - 1))) - np.uint64(1)))


def _logp(tables: tuple, floor: np.ndarray, first: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """Log probability under every language (columns) of the last character after those before."""
    if not order:
        return np.broadcast_to(floor, (len(low), len(floor)))
    table = tables[order - 1]
    at, found = Table._at(table.keys, _key(first, low, order))
    out = table.logp[at] if len(table.keys) else np.zeros((len(low), len(floor)), np.float32)
    if not found.all():
        miss = ~found
        some_first, some_low = first[miss], low[miss]
        rest = _logp(tables, floor, some_first, some_low, order - 1)
        if order > 1 and len(table.backoff_keys):
            at, known = Table._at(table.backoff_keys, _context_key(some_first, some_low, order))
            rest = rest + np.where(known[:, None], table.backoff[at], 0)
        elif order == 1:
            rest = rest + table.backoff
        out[miss] = rest
    return out


def _estimate(languages: list[str], rows: np.ndarray) -> tuple[tuple[Table, ...], np.ndarray]:
    """Tables from rows (language, first, low, count) of the highest order."""
    n_languages, tables = len(languages), []
    lang, first, low, count = (rows[f] for f in ("lang", "first", "low", "count"))
    by_order = {ORDER: (lang, first, low, count.astype(float))}
    for order in range(ORDER - 1, 0, -1):  # the count of a shorter n-gram is the number of characters before it
        above_lang, _, above_low, _ = by_order[order + 1]
        short = above_low & ((np.uint64(1) << np.uint64(21 * order)) - np.uint64(1))
        pairs, n = np.unique(np.stack([above_lang.astype(np.uint64), short]), axis=1, return_counts=True)
        by_order[order] = (pairs[0].astype(np.int64), np.zeros(len(n), np.uint64), pairs[1], n.astype(float))
    alphabet = len(np.unique(by_order[1][2])) + 1
    floor = np.full(n_languages, -np.log(alphabet), np.float32)
    for order in range(1, ORDER + 1):
        lang, first, low, count = by_order[order]
        once = np.bincount(lang[count == 1], minlength=n_languages)
        twice = np.bincount(lang[count == 2], minlength=n_languages)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        if order == 1:
            context_keys, context_of = np.zeros(1, np.uint64), np.zeros(len(low), np.int64)
        else:
            context_keys, context_of = np.unique(_context_key(first, low, order), return_inverse=True)
        cell = context_of * n_languages + lang
        total = np.bincount(cell, weights=count, minlength=len(context_keys) * n_languages)
        kinds = np.bincount(cell, minlength=len(context_keys) * n_languages)
        weight = np.where(total > 0, np.tile(discount, len(context_keys)) * kinds / np.maximum(total, 1), 1.0)
        backoff = np.log(weight).reshape(-1, n_languages).astype(np.float32)
        keys, first_at, gram_of = np.unique(_key(first, low, order), return_index=True, return_inverse=True)
        shorter = _logp(tuple(tables), floor, first[first_at], low[first_at], order - 1).astype(np.float64)
        left = backoff[context_of[first_at]] + shorter
        seen = np.zeros((len(keys), n_languages))
        seen[gram_of, lang] = np.maximum(count - discount[lang], 0) / total[cell]
        logp = np.log(seen + np.exp(left)).astype(np.float32)
        tables.append(Table(keys, logp, context_keys, backoff if order > 1 else backoff[0]))
    return tuple(tables), floor


def _training(docs: DataFrame, per_language: int, max_chars: int) -> tuple[dict[str, float], DataFrame]:
    """A sample of about ``per_language`` documents and ``max_chars`` characters of each language, and how many
    documents of each language it should have."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    rows = {r["lang"]: r for r in sizes.collect()}
    found = {k: min(1.0, per_language / r["n"], max_chars / max(1, r["chars"])) for k, r in rows.items()}
    if not found:
        return {}, known.limit(0)
    share = F.create_map(*[F.lit(v) for pair in found.items() for v in pair])[F.col("lang")]
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000
    return {k: rows[k]["n"] * found[k] for k in sorted(found)}, known.where(drawn).select("doc_id", "text", "lang")


def fit(docs: DataFrame, per_language: int = 3000, max_chars: int = 6_000_000) -> LanguageModel:
    """Models of all languages in ``lang``, from a bounded sample of the labelled documents.

    The sample is drawn by a hash of doc_id; its n-grams are counted on the executors. One document in
    eight of the sample is kept for the calibration, of languages that have ENOUGH documents in it; of
    others all are counted. Null texts and languages are left out.
    """
    drawn, sample = _training(docs, per_language, max_chars)
    languages = list(drawn)
    number = {name: k for k, name in enumerate(languages)}
    if not languages:
        empty = np.zeros(0)
        return LanguageModel((), (), empty, empty, empty)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for lo, hi in blocks(texts):
                row, text = symbols(texts.slice(lo, hi - lo).to_pylist())
                lang = np.array([number[x] for x in batch.column(1).slice(lo, hi - lo).to_pylist()], np.int64)
                first, low = grams(row)
                some = row != PAD
                keys = np.stack([lang[text[some]].astype(np.uint64), first[some], low[some]])
                order = np.lexsort(keys)
                keys = keys[:, order]
                new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if keys.size else np.zeros(0, bool)
                starts = np.flatnonzero(new)
                n = np.diff(np.append(starts, keys.shape[1]))
                arrays = [pa.array(k[starts].astype(np.int64)) for k in keys] + [pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "first", "low", "count"])

    common = [name for name, n in drawn.items() if n >= ENOUGH]
    held = (F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(8)) == 0) & F.col("lang").isin(common)
    counted = sample.where(~held).select("text", "lang").mapInArrow(count, "lang long, first long, low long, count long")
    # as many rows as the bounded sample has distinct n-grams at most
    rows = counted.groupBy("lang", "first", "low").agg(F.sum("count").alias("count")).toArrow()
    columns = {c: rows.column(c).to_numpy() for c in rows.column_names}
    table = np.zeros(rows.num_rows, [("lang", np.int64), ("first", np.uint64), ("low", np.uint64), ("count", np.int64)])
    for c, values in columns.items():
        table[c] = values
    tables, floor = _estimate(languages, table)
    raw = LanguageModel(tuple(languages), tables, floor, np.zeros(len(languages)), np.ones(len(languages)))
    calibration = entropies(sample.where(held), raw).select("lang", "entropies", "n_symbols").where("n_symbols >= 40")
    usual, spread = np.full(len(languages), np.log(30)), np.ones(len(languages))
    by_lang: dict[int, list[float]] = {}
    for r in calibration.collect():
        by_lang.setdefault(number[r["lang"]], []).append(r["entropies"][number[r["lang"]]])
    for k, values in by_lang.items():
        usual[k], spread[k] = np.median(values), max(0.05, np.std(values))
    return LanguageModel(tuple(languages), tables, floor, usual, spread)


def entropies(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, and: n_symbols, has_letter, entropies (nats per character, in
    the order of the model's languages; empty without letters)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    at = docs.columns.index(text)
    kept = [k for k in range(len(docs.columns)) if k != at]
    fields = [docs.schema.fields[k] for k in kept]
    added = [("n_symbols", T.LongType()), ("entropies", T.ArrayType(T.DoubleType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        n_languages = len(model.languages)
        for batch in batches:
            texts = texts_of(batch.column(at))
            for lo, hi in blocks(texts):
                row, text = symbols(texts.slice(lo, hi - lo).to_pylist())
                first, low = grams(row)
                some = row != PAD
                n = np.bincount(text[some], minlength=hi - lo)
                letters = np.bincount(text[some & (row != SPACE)], minlength=hi - lo)
                sums = np.zeros((hi - lo, n_languages))
                if some.any():
                    logp, of = model.logp(first[some], low[some]), text[some]
                    for k in range(n_languages):
                        sums[:, k] = np.bincount(of, weights=logp[:, k], minlength=hi - lo)
                values = [(-s / m).tolist() if has else [] for s, m, has in zip(sums, n, letters, strict=True)]
                out = [batch.column(k).slice(lo, hi - lo) for k in kept]
                out += [pa.array(n, pa.int64()), pa.array(values, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(out, [*(f.name for f in fields), *(a for a, _ in added)])

    return docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(*a) for a in added)]))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, and: lang_pred, score (0 to 1), accepted.

    ``und``, 0 and false for a text that is null or has no letter, or if no language was learned. The
    score is the winner's share of the evidence times the chance that a text of that language has so
    high an entropy; ``accepted`` tells whether that entropy is usual for it. Ties go to the first
    language by name.
    """
    kept = [c for c in docs.columns if c != text]
    if not model.languages:
        return docs.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    found = entropies(docs, model, text)
    best = F.array_min("entropies")
    winner = F.array_position("entropies", best).cast("int")
    name = F.element_at(F.array(*[F.lit(x) for x in model.languages]), winner)
    usual = F.element_at(F.array(*[F.lit(float(x)) for x in model.usual]), winner)
    spread = F.element_at(F.array(*[F.lit(float(x)) for x in model.spread]), winner)
    evidence = F.least(F.col("n_symbols"), F.lit(EVIDENCE_CHARS))
    shares = F.aggregate("entropies", F.lit(0.0), lambda s, e: s + F.exp((best - e) * evidence))
    # the entropy of a short text varies more; beyond five spreads a text is unlike the language
    away = (best - usual) / (spread * F.sqrt(1 + F.lit(float(EVIDENCE_CHARS)) / F.col("n_symbols")))
    likely = 1 / (1 + F.exp(F.least(away - 5, F.lit(30.0))))
    has = F.size("entropies") > 0
    return found.select(
        *kept,
        F.when(has, name).otherwise("und").alias("lang_pred"),
        F.when(has, likely / shares).otherwise(0.0).alias("score"),
        F.coalesce(has & (away <= 5), F.lit(False)).alias("accepted"),
    )


def identified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every document; learned where crc32(doc_id)
    modulo 4 is not 2. Repeated rows are predicted alike."""
    model = fit(docs.where(fold("doc_id", 4) != 2))
    found = predict(docs.select("doc_id", "text"), model)
    return found.withColumn("held_out", fold("doc_id", 4) == 2)
