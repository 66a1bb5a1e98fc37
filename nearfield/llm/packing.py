"""Best-fit packing of tokenized documents into sequences of one length, in bulk-synchronous steps.

Documents are range-sorted by token length, sequences by the gap that is left in them. A step takes the
documents of one length, longest first, sweeps the gaps upwards from their successor (the smallest gap
that fits), gives the k-th document of that length the k-th place, and updates the gaps. As documents of
one length are alike, a step needs only how many documents and gaps of each length there are: at most
``capacity`` counts whatever the corpus size. The counts are summed on the executors, the steps run over
them, and each document finds its place by its rank among those of its length, again on the executors.
The result is that of sequential best-fit decreasing over all pieces.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import blocks, texts_of
from nearfield.scratch import stored

#: Words that a task remembers; then it forgets them all and starts anew.
MEMO = 150_000
#: Stands for the end of a word. Texts that contain it are not split into words.
END = b"\0"
#: Rows of one length are ranked in at most so many independent parts.
MAX_PARTS, PART_ROWS = 1024, 1_000_000

_UNUSUAL = re.compile("[^\x01-\x1b\x20-ɏ]")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")


class WordTokenizer:
    """Ids of whole texts by a word-end byte-level BPE tokenizer, remembering the words it has met.

    Such a tokenizer never merges across white space, so a text's ids are its words' ids in a row. New
    words are merged by tiktoken's faster code: the word's end is written as a byte of its own that
    merges first, then the vocabulary's merges follow by rank. Texts with characters outside Latin
    letters and punctuation go through the tokenizer itself.
    """

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import pre_tokenizers

        self.spec, self.tokenizer = spec, None
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # every byte that UTF-8 has occurs in these; the vocabulary writes each byte as a letter
        points = "".join(map(chr, [*range(0x800), *range(0x800, 0xD800, 0x800), *range(0x10000, 0x110000, 0x10000)]))
        letters = level.pre_tokenize_str(points)[0][0]
        byte_of = dict(zip(letters, points.encode(), strict=True))

        def plain(token: str) -> bytes | None:
            stem, end = (token[:-4], END) if token.endswith("</w>") and len(token) > 4 else (token, b"")
            return bytes(byte_of[c] for c in stem) + end if all(c in byte_of for c in stem) else None

        model = json.loads(spec)["model"]
        order = [bytes([b]) for b in range(256)] + [bytes([b]) + END for b in range(256)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order += [t for a, b in pairs if (t := plain(a + b)) is not None]
        ranks = {t: rank for rank, t in enumerate(dict.fromkeys(order))}
        self.merge = tiktoken.Encoding("words", pat_str="[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.ids, self.ends = np.zeros(len(ranks), "<u4"), np.zeros(len(ranks), bool)
        for token, at in model["vocab"].items():
            if (t := plain(token)) in ranks:
                self.ids[ranks[t]], self.ends[ranks[t]] = at, token.endswith("</w>")
        self.special = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """The ids by the tokenizer itself, which is loaded when a text needs it."""
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.spec)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, missing: list[str]) -> None:
        for at in range(0, len(missing), 4000):
            some = missing[at : at + 4000]
            parts = [_PIECES.findall(w) for w in " ".join(some).lower().split(" ")]
            ranks = np.array(self.merge("\0".join([p for ps in parts for p in ps]) + "\0"), np.int64)
            after = np.concatenate([[0], np.flatnonzero(self.ends[ranks]) + 1])  # where each piece begins
            stops = (4 * after[np.cumsum([len(ps) for ps in parts])]).tolist()
            raw, start = self.ids[ranks].tobytes(), 0
            for word, stop in zip(some, stops, strict=True):
                self.words[word] = raw[start:stop]
                start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list = []
        for text in texts:
            if _UNUSUAL.search(text) or any(t in text for t in self.special):
                out.append(self.whole(text))
            else:
                out.append(text.split())
        if len(self.words) > MEMO:
            self.words.clear()
        missing: set[str] = set()
        for words in out:
            if type(words) is list:
                missing.update(words)
        self._learn(list(missing - self.words.keys()))
        ids_of = self.words.__getitem__
        return [w if type(w) is bytes else b"".join(map(ids_of, w)) for w in out]


_TOKENIZERS: dict[int, WordTokenizer] = {}


def _tokenizer(spec: str) -> WordTokenizer:
    """One per Python worker, as its tables take a while to build."""
    key = hash(spec)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordTokenizer(spec)
    return _TOKENIZERS[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = 4096,
    end_id: int = 1,
    text: str = "text",
    id: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, piece, start, length, ids_crc32 (and token_ids).

    Each text's ids are followed by ``end_id``; only longer documents are cut. A null or empty text is
    the end id alone. Rows repeat as they do in ``docs``; other columns are ignored.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        spec = file.read()
    sent = docs.sparkSession.sparkContext.broadcast(spec)  # the vocabulary file, of fixed size
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = docs.schema[id].dataType
    fields = [
        T.StructField(id, id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(sent.value)
        encode = tokenizer.encode
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, raw in enumerate(encode(texts.slice(lo, hi - lo).to_pylist()), lo):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, dtype="<i4"))
                out = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])
        tokenizer.words.clear()  # the worker may go on with other work

    return docs.select(F.col(id), F.col(text)).mapInArrow(run, T.StructType(fields))


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places of all pieces by length: (length, first rank, rank after the last, first sequence, pieces in
    each sequence, offset of the first).

    ``counts`` has the number of pieces of each length. Best-fit decreasing: as the gap that a piece
    leaves is a tighter fit for the next of that length, a sequence takes as many as fit.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, how many)
    plan, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def place(gap: int, first: int, many: int) -> int:
            """Fills up to ``many`` sequences with this gap; returns how many got any."""
            nonlocal rank, left
            fits = gap // length
            full = min(many, left // fits)
            if full:
                plan.append((length, rank, rank + full * fits, first, fits, capacity - gap))
                gaps[gap - fits * length].append((first, full))
                rank, left = rank + full * fits, left - full * fits
            if not left or full == many:
                return full
            plan.append((length, rank, rank + left, first + full, left, capacity - gap))
            gaps[gap - left * length].append((first + full, 1))
            rank, left = rank + left, 0
            return full + 1

        for gap in range(length, capacity + 1):
            if not left:
                break
            if not gaps[gap]:
                continue
            waiting, gaps[gap] = gaps[gap], []
            for first, many in waiting:
                used = place(gap, first, many) if left else 0
                if used < many:
                    gaps[gap].append((first + used, many - used))
        if left:
            sequences += place(capacity, sequences, -(-left // (capacity // length)))
    return plan


def pack(pieces: DataFrame, capacity: int = 4096, id: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    ``pieces`` must be a stored table (it is read twice). Ranks are taken inside parts of a length, by a
    hash of the row, so that one very common length doesn't meet in one task; equal rows may swap
    places, which changes nothing. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    total = pieces.count()
    parts = min(MAX_PARTS, max(16, total // PART_ROWS))
    order = [F.col(id), F.col("piece"), F.col("ids_crc32")]
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = stored(salted.groupBy("length", "_part").agg(F.count("*").alias("_rows")), "pack-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_rows").alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}, not {min(counts)} to {max(counts)}")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1
    ranked = (
        salted.withColumn("_within", within)
        .join(starts, ["length", "_part"])
        .withColumn("_rank", F.col("_before") + F.col("_within"))
    )
    plan = spark.createDataFrame(
        best_fit_plan(counts, capacity),
        "_length long, _lo long, _hi long, _first long, _fits long, _base long",
    )
    at = F.col("_rank") - F.col("_lo")
    # the plan has a few rows for each of at most `capacity` lengths, whatever the corpus size
    placed = ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")),
    )
    return placed.select(
        *pieces.columns,
        (F.col("_first") + F.expr("(_rank - _lo) div _fits")).alias("sequence_id"),
        (F.col("_base") + at % F.col("_fits") * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Tokenizes and packs ``doc_id, text``; see ``token_pieces`` and ``pack``."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids)
    return pack(stored(pieces, "pack-pieces"), capacity)
