"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of WINDOW words. Their TF-IDF vectors, over the words of the benchmark that are not
everywhere, are projected on the leading right singular vectors of the matrix of all passages together
with the benchmark's own. A randomised SVD finds those: random directions are multiplied by the matrix
and its transpose in two distributed passes over all passages, whose partial sums have a fixed
size. Windows of high cosine with an item are candidates; a longest common subsequence of words, and for partial ones the item's
answer, decide. Benchmark items are searched in blocks; words are counted over all passages, and all are searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import blocks, fresh, marked, mixed, texts_of, without, word_hashes
from nearfield.scratch import stored

#: Words of a passage and of its steps; longer items are searched in parts of at most SEGMENT words.
WINDOW, STEP, SEGMENT = 64, 32, 48
#: Words in more than this share of all passages are no evidence, but each part keeps its rarest KEPT words.
COMMON, KEPT = 0.02, 8
#: Parts of items searched at once, and dimensions of their latent space.
ITEM_BLOCK, RANK, OVERSAMPLE = 256, 256, 16
#: Steps of a text in one row of occurrences.
ROW_STEPS = 2048
#: Weight of the benchmark's own rows in the decomposition, against the weight of all passages.
OWN_WEIGHT = 3.0
#: Cosine from which a passage is a candidate.
COSINE = 0.35
#: Share of an item's words, in order, that a span must have; or less, with so much of the answer.
COVERED, PARTLY, ANSWERED = 0.75, 0.5, 0.8

_OF_WORD = np.zeros(256, bool)
_OF_WORD[128:] = True
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _OF_WORD[ord(_first) : ord(_last) + 1] = True


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, in lower case; a word is ASCII letters and digits and any other letters."""
    return word_hashes(pc.utf8_lower(texts), _OF_WORD)


@dataclass(frozen=True)
class Item:
    """A benchmark item: hashes of its words, and of its answer's."""

    number: int
    words: np.ndarray
    answer: np.ndarray


def items_of(benchmark: DataFrame, answer: str | None = None) -> tuple[list, list[Item]]:
    """The item_ids and the items with any words, in order of item_id and text.

    Without a column of answers, an item's last quarter counts as its answer. The benchmark is the stated
    query set; the driver holds it.
    """
    columns = ["item_id", "text", *([answer] if answer else [])]
    rows = benchmark.select(*columns).where("text IS NOT NULL").orderBy("item_id", "text").collect()
    texts = pa.array([r["text"] for r in rows], pa.string())
    hashes, bounds = _words(texts)
    answers, ends = _words(pa.array([r[answer] or "" if answer else "" for r in rows], pa.string()))
    items = []
    for k in range(len(rows)):
        words = hashes[bounds[k] : bounds[k + 1]]
        own = answers[ends[k] : ends[k + 1]]
        if len(words):
            items.append(Item(k, words, own if len(own) else words[-math.ceil(len(words) / 4) :]))
    return [r["item_id"] for r in rows], items


class _Vocabulary:
    """Finds the places of word hashes in a sorted array."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(hashes >> np.uint64(48)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in it, and their places."""
        some = np.flatnonzero(self.maybe[(words >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.hashes, words[some])
        at[at == len(self.hashes)] = 0
        found = self.hashes[at] == words[some] if len(self.hashes) else np.zeros(len(some), bool)
        return some[found], at[found]


def occurrences(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Where the vocabulary's words are in each text: doc_id, text_hash, until, and arrays step and word.

    A long text has a row for each ROW_STEPS steps, and one row for each text has n_passages, else 0. Rows
    overlap by the steps from ``until`` on, which belong to the next row as well.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the benchmark's words
    fields = [
        docs.schema["doc_id"],
        T.StructField("text_hash", T.LongType()),
        T.StructField("n_passages", T.LongType()),
        T.StructField("until", T.IntegerType()),
        T.StructField("step", T.ArrayType(T.IntegerType())),
        T.StructField("word", T.ArrayType(T.IntegerType())),
    ]
    reach = WINDOW // STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Vocabulary(sent.value)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                words, bounds = _words(texts.slice(lo, hi - lo))
                at, which = known.find(words)
                ends = np.searchsorted(at, bounds)
                sizes = np.diff(bounds)
                step = ((at - np.repeat(bounds[:-1], np.diff(ends))) // STEP).astype(np.int32)
                n_rows = np.maximum(1, -(-sizes // (STEP * ROW_STEPS)))
                row = np.repeat(np.arange(hi - lo), n_rows)  # the text of each row
                part = np.arange(len(row)) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows)
                until = ((part + 1) * ROW_STEPS).astype(np.int32)
                passages = np.where(part == 0, -(-sizes[row] // WINDOW), 0)
                if len(row) == hi - lo:
                    offsets, chosen = ends, slice(None)
                else:
                    first = ends[row] + [int(np.searchsorted(step[ends[r] : ends[r + 1]], p * ROW_STEPS)) for r, p in zip(row, part, strict=True)]
                    after = ends[row] + [
                        int(np.searchsorted(step[ends[r] : ends[r + 1]], u + reach - 1)) for r, u in zip(row, until, strict=True)
                    ]
                    offsets = np.concatenate([[0], np.cumsum(after - first)])
                    chosen = np.concatenate([np.arange(a, b) for a, b in zip(first, after, strict=True)])
                offsets = pa.array(offsets.astype(np.int32))
                arrays = [batch.column(k).take(pa.array(row + lo)) for k in (0, 2)]
                arrays += [pa.array(passages, pa.int64()), pa.array(until)]
                arrays += [pa.ListArray.from_arrays(offsets, pa.array(v[chosen], pa.int32())) for v in (step, which.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return docs.select("doc_id", "text", _text_hash()).mapInArrow(run, T.StructType(fields))


def passage_counts(found: DataFrame, n: int) -> np.ndarray:
    """In how many of all passages (here side by side) each of ``n`` words is, from ``occurrences``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n, np.int64)
        for batch in batches:
            for part in _slices(batch):
                text, step, word = _flat(part, 0)
                passage = np.cumsum(_changes(text, step // (WINDOW // STEP))) - 1
                counts += np.bincount(np.unique(passage * n + word) % n, minlength=n)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["word", "n"])

    rows = found.select("step", "word", "until").mapInArrow(run, "word long, n long")
    out = np.zeros(n, np.int64)
    for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[r["word"]] = r["n"]
    return out


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def _slices(batch: pa.RecordBatch, most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose last list columns have about ``most`` values."""
    ends = batch.column(batch.schema.get_field_index("step")).offsets.to_numpy()
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _flat(part: pa.RecordBatch, at: int, overlap: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, step and word of each occurrence, from the columns at, at + 1 and at + 2 (step, word, until);
    without those that the next row has as well, unless ``overlap``."""
    steps, words, until = (part.column(at + k) for k in range(3))
    sizes = np.diff(steps.offsets.to_numpy())
    row, step, word = np.repeat(np.arange(len(sizes)), sizes), steps.flatten().to_numpy(), words.flatten().to_numpy()
    if overlap:
        return row, step, word
    own = step < until.to_numpy()[row]
    return row[own], step[own], word[own]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row of the columns differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _row_sums(table: np.ndarray, which: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of the rows ``which`` of a table over the runs that begin at ``starts``.

    Runs are added side by side, the first row of each, then the second, and so on, longest runs first, which is
    several times as fast as one run after another; the few longest ones are ended by themselves.
    """
    sizes = np.diff(starts, append=len(which))
    order = np.argsort(-sizes, kind="stable")
    begin, size = starts[order], sizes[order]
    sums, at = table[which[begin]], 1
    while n := int(np.searchsorted(-size, -at)):  # runs of more than ``at`` rows
        if n < 64:
            for k in range(n):
                sums[k] += table[which[begin[k] + at : begin[k] + size[k]]].sum(axis=0)
            break
        sums[:n] += table[which[begin[:n] + at]]
        at += 1
    out = np.empty_like(sums)
    out[order] = sums
    return out


# ---- randomised SVD


def _gram_times(found: DataFrame, place: np.ndarray, weights: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Transposed matrix of the passages times that matrix times ``directions`` (words x columns).

    ``place``: the row of ``directions`` for each word of the occurrences, or -1. A passage's row is its words' weights, each occurrence by itself; passages lie side by side, WINDOW words
    each. Tasks return sums of the size of ``directions``, which are added by parts of 256 words.
    """
    spark = found.sparkSession
    sent = spark.sparkContext.broadcast((place, weights, directions))
    per_passage, part = WINDOW // STEP, 256
    n, columns = directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights, directions = sent.value
        scaled = (directions * weights[:, None]).astype(np.float32)
        total = np.zeros((n, columns), np.float32)
        for batch in batches:
            for some in _slices(batch, 50_000):
                text, step, word = _flat(some, 0)
                text, step, word = (v[place[word] >= 0] for v in (text, step, word))
                if not len(word):
                    continue
                word = place[word]
                new = _changes(text, step // per_passage)
                rows = _row_sums(scaled, word, np.flatnonzero(new))
                order = np.argsort(word, kind="stable")
                of = (np.cumsum(new) - 1)[order]
                starts = np.flatnonzero(np.diff(word[order], prepend=-1))
                total[word[order][starts]] += _row_sums(rows, of, starts)
        total *= weights[:, None]
        for lo in range(0, n, part):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lo]), pa.array([total[lo : lo + part].tobytes()], pa.binary())], ["part", "sums"]
            )

    def add(group: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(s.as_py(), np.float32).astype(np.float64) for s in group.column("sums"))
        return pa.table({"part": group.column("part")[:1], "sums": pa.array([sums.astype(np.float32).tobytes()], pa.binary())})

    sums = found.select("step", "word", "until").mapInArrow(run, "part long, sums binary")
    out = np.zeros((n, columns))
    for r in sums.groupBy("part").applyInArrow(add, "part long, sums binary").collect():
        values = np.frombuffer(r["sums"], np.float32).reshape(-1, columns)
        out[r["part"] : r["part"] + len(values)] = values
    return out


def latent_basis(found: DataFrame, place: np.ndarray, weights: np.ndarray, own: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors (words x rank) of the passages' rows and of the rows ``own``.

    The latter are scaled so that each counts as OWN_WEIGHT times the strongest direction of the passages,
    lest items that the corpus never cites vanish from the space.
    """
    n = len(weights)
    columns = min(n, rank + OVERSAMPLE)
    directions = mixed(np.arange(n * columns, dtype=np.uint64) + np.uint64(1)).reshape(n, columns)
    directions = np.where(directions >> np.uint64(63), 1.0, -1.0)
    first = _gram_times(found, place, weights, directions)
    # each random column keeps about the square of the strongest singular value times its share
    strongest = math.sqrt(np.linalg.norm(first, axis=0).max() / max(1.0, math.sqrt(n)))
    scale = OWN_WEIGHT * max(1.0, strongest)
    basis, _ = np.linalg.qr(first + scale**2 * (own.T @ (own @ directions)))
    second = _gram_times(found, place, weights, basis) + scale**2 * (own.T @ (own @ basis))
    small = basis.T @ second
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, np.argsort(-values)[:rank]]


# ---- search


def candidates(
    found: DataFrame, place: np.ndarray, weights: np.ndarray, queries: np.ndarray, numbers: list[int], cosine: float
) -> DataFrame:
    """doc_id, text_hash, item, start: windows of WINDOW words, at every STEP words, whose cosine with a query
    reaches ``cosine``. ``queries``: latent rows times basis, so that a word's share of each inner product
    is one row; the norms are those of the whole vectors.
    """
    spark = found.sparkSession
    shares = (queries * weights[:, None]).astype(np.float32)
    sent = spark.sparkContext.broadcast((place, (weights**2).astype(np.float32), shares, np.array(numbers)))
    fields = [
        found.schema["doc_id"],
        T.StructField("text_hash", T.LongType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, squared, shares, item_of = sent.value
        reach = WINDOW // STEP
        for batch in batches:
            for part in _slices(batch, 50_000):
                text, step, word = _flat(part, 2, overlap=True)
                some = place[word] >= 0
                text, step, word = text[some], step[some], place[word[some]]
                if not len(word):
                    continue
                new = np.flatnonzero(_changes(text, step))
                total = _row_sums(shares, word, new)
                norm = np.add.reduceat(squared[word], new)
                text, step = text[new], step[new]
                # a window begins at a step that has words and takes the next steps of the same text
                sums, squares = total.copy(), norm.copy()
                for k in range(1, reach):
                    same = (text[k:] == text[:-k]) & (step[k:] - step[:-k] < reach)
                    total[:-k] += sums[k:] * same[:, None]
                    norm[:-k] += squares[k:] * same
                hit, query = np.nonzero(total >= cosine * np.sqrt(norm)[:, None])
                arrays = [part.column(k).take(pa.array(text[hit])) for k in (0, 1)]
                arrays += [pa.array(item_of[query], pa.int32()), pa.array(step[hit] * STEP, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return found.select("doc_id", "text_hash", "step", "word", "until").mapInArrow(run, T.StructType(fields))


def subsequence(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one integer (Hyyrö's form)."""
    places: dict[int, int] = {}
    for k, word in enumerate(pattern.tolist()):
        places[word] = places.get(word, 0) | 1 << k
    full = (1 << len(pattern)) - 1
    row = full
    for word in text.tolist():
        both = row & places.get(word, 0)
        if both:
            row = (row + both | row - both) & full
    return len(pattern) - row.bit_count()


def confirmed(docs: DataFrame, hits: DataFrame, items: list[Item]) -> DataFrame:
    """doc_id, text_hash, item, coverage: candidates that hold, the best span of each document and item."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast({i.number: i for i in items})
    wanted = stored(hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("item", "start")).alias("hits")), "hits")
    rows = marked(docs.select("doc_id", _text_hash(), "text"), wanted, {"doc_id": "doc_id", "text_hash": "text_hash"})
    named = wanted.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "hits")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = rows.where("_set").join(named, same).select("doc_id", "text_hash", "text", "hits")
    fields = [
        docs.schema["doc_id"],
        T.StructField("text_hash", T.LongType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("coverage", T.DoubleType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            texts = texts_of(batch.column(2))
            rows, numbers, coverages = [], [], []
            for k, hits in enumerate(batch.column(3)):
                words, _ = _words(texts.slice(k, 1))
                best: dict[int, float] = {}
                for hit in hits.as_py():
                    item = items[hit["item"]]
                    n = len(item.words)
                    span = words[max(0, hit["start"] - n) : hit["start"] + WINDOW + n]
                    covered = subsequence(item.words, span) / n
                    whole = covered >= COVERED
                    if whole or covered >= PARTLY and subsequence(item.answer, span) >= ANSWERED * len(item.answer):
                        best[item.number] = max(best.get(item.number, 0.0), covered)
                rows += [k] * len(best)
                numbers += best.keys()
                coverages += best.values()
            arrays = [batch.column(c).take(pa.array(rows, pa.int64())) for c in (0, 1)]
            arrays += [pa.array(numbers, pa.int32()), pa.array(coverages, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields))


def leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None, cosine: float = COSINE) -> DataFrame:
    """doc_id, text_hash, item_id, coverage of the documents that contain benchmark items.

    Null and empty texts and items match nothing; repeated rows of docs are one document, repeated items one
    each. Rare words are found over all passages of all documents.
    """
    ids, items = items_of(benchmark, answer)
    empty = docs.sparkSession.createDataFrame([], T.StructType([docs.schema["doc_id"]])).limit(0)
    empty = empty.select("doc_id", F.lit(0).cast("long").alias("text_hash"), F.lit(0).alias("item"), F.lit(0.0).alias("coverage"))
    out = empty
    if items:
        words = np.unique(np.concatenate([i.words for i in items]))
        found = stored(occurrences(docs, words), "occurrences")
        total = found.agg(F.coalesce(F.sum("n_passages"), F.lit(0))).first()[0]
        counts = passage_counts(found, len(words))
        parts = []  # (item, its part's places in the vocabulary)
        for item in items:
            size = math.ceil(len(item.words) / math.ceil(len(item.words) / SEGMENT))
            for at in range(0, len(item.words), size):
                own = np.unique(np.searchsorted(words, item.words[at : at + size]))
                few = own[np.argsort(counts[own], kind="stable")[:KEPT]]
                parts.append((item.number, np.union1d(few, own[counts[own] <= COMMON * total])))
        hits = None
        for lo in range(0, len(parts), ITEM_BLOCK):
            some = parts[lo : lo + ITEM_BLOCK]
            used = np.unique(np.concatenate([p for _, p in some]))
            place = np.full(len(words), -1)
            place[used] = np.arange(len(used))
            weights = np.log((1 + total) / (1 + counts[used])) + 1
            own = np.zeros((len(some), len(used)))
            for k, (_, p) in enumerate(some):
                own[k, place[p]] = weights[place[p]]
            own /= np.linalg.norm(own, axis=1, keepdims=True)
            basis = latent_basis(found, place, weights, own)
            latent = basis.T @ own.T
            queries = basis @ (latent / np.linalg.norm(latent, axis=0))
            block = candidates(found, place, weights, queries, [i for i, _ in some], cosine)
            hits = block if hits is None else hits.unionByName(block)
        out = confirmed(docs, stored(hits.distinct(), "candidates"), items)
    names = docs.sparkSession.createDataFrame(
        [(k, i) for k, i in enumerate(ids)], T.StructType([T.StructField("item", T.IntegerType()), benchmark.schema["item_id"]])
    )
    return out.join(names, "item").groupBy("doc_id", "text_hash", "item_id").agg(F.max("coverage").alias("coverage"))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """doc_id, contaminated, n_items, best_item and coverage (null if none) of every row of docs."""
    found = stored(leaks(docs, benchmark, answer), "leaks")
    best = F.max(F.struct("coverage", F.bitwise_not("item_id").alias("down")))
    each = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), best.alias("best"))
    named = each.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n", "best")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    rows = docs.select("doc_id", _text_hash()).join(named, same, "left")
    return rows.select(
        "doc_id",
        F.col("n").isNotNull().alias("contaminated"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.bitwise_not("best.down").alias("best_item"),
        F.col("best.coverage").alias("coverage"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark item was found."""
    found = stored(leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaked")
    name = fresh(docs, "text_hash")
    hashed = docs.withColumn(name, _text_hash())
    return without(hashed, found, {"doc_id": "doc_id", name: "text_hash"}).drop(name)
