"""Alignment of two tokenizers' tokens by pointer jumping over byte ranges.

A text's tokens under both tokenizers lie on the same bytes. Every token points to the overlapping token that
reaches farthest right: the other tokenizer's token on its last byte, if that ends later. Doubling all
pointers at once converges, in as many steps as the logarithm of the longest chain, to the last token of each
connected component, which labels the component's group. Groups therefore end where tokens of both end.

A task aligns a block of texts at a time. What the corpus says of a linked pair of ids is summed from counts by
block; a block then gets the figures of its own pairs only, by a join, and so no table of pairs is broadcast
and no shuffle carries a row for every link.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import blocks, skewed_join, texts_of
from nearfield.scratch import stored

#: Bytes of text in a block (a longer text is a block of its own) and of a piece that is encoded at once.
BLOCK, PIECE = 2 << 20, 1 << 18
#: Longer runs without or of white space are left to the tokenizer's own code, which doesn't recurse over them.
_LONG_RUN = re.compile(r"\s{2000}|\S{20000}")
# How a byte-level vocabulary splits text before merging, and the bytes it writes as themselves.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_of_letter() -> dict[str, int]:
    rest = [b for b in range(256) if b not in _PLAIN]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """A byte-level BPE tokenizer, by tiktoken's code where its merges follow the order of ids."""

    def __init__(self, spec: str):
        import tiktoken

        parsed = json.loads(spec)
        byte, model = _byte_of_letter(), parsed["model"]
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        ids = {t: k for t, k in model["vocab"].items() if t not in special}
        self.bytes = {k: bytes(byte[c] for c in t) for t, k in ids.items()} | {k: t.encode() for t, k in special.items()}
        self.spec, self.tokenizer = spec, None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [ids.get(a + b) for a, b in merges]
        self.quick = None
        if len(ids) == 256 + len(made) and made == list(range(256, 256 + len(made))):
            ranks = {self.bytes[k]: k for k in ids.values()}
            self.quick = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.spec)
            self.tokenizer.encode_special_tokens = True
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if self.quick is None or _LONG_RUN.search(text):
            return self.whole(text)
        return self.quick.encode_ordinary(text)


class PieceTokens:
    """A sentence-piece tokenizer that writes a space before the text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = {}
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            single = _BYTE.fullmatch(piece)
            self.bytes[k] = bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def pieces_of(text: str, limit: int = PIECE) -> Iterator[str]:
    """The text cut at spaces that follow another character; these spaces are left out.

    Neither tokenizer has a token across such a place, and both put the space before what follows.
    """
    while len(text) > limit:
        at = limit
        while (at := text.find(" ", at)) >= 0 and text[at - 1].isspace():
            at += 1
        if at < 0 or at + 1 >= len(text):
            break
        yield text[:at]
        text = text[at + 1 :]
    yield text


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, from the ends of the byte ranges of both tokenizers' tokens in order.

    Both must end at the same byte, and no token be empty.
    """
    n = len(ends_a)
    # the other side's token on the last byte: the first that ends there or later
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    to = np.empty(n + len(ends_b), np.int64)
    to[:n] = np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)) if n else 0
    to[n:] = over_b  # of tokens that end together the first tokenizer's is last
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    number = np.zeros(n, np.int64)
    last = np.flatnonzero(to[:n] == np.arange(n))
    number[last] = np.arange(len(last))
    return number[to[:n]], number[to[n:]]


class Aligner:
    """Both tokenizers with tables of their tokens."""

    def __init__(self, spec: str, model: bytes):
        self.a, self.b = ByteTokens(spec), PieceTokens(model)
        self.shift = max(self.a.bytes) + 1
        self.size = self.shift + max(self.b.bytes) + 1
        self.raw = np.full(self.size, b"", object)
        spelled = [""] * self.size
        for shift, tokens in ((0, self.a.bytes), (self.shift, self.b.bytes)):
            for k, raw in tokens.items():
                self.raw[shift + k], spelled[shift + k] = raw, str(k)
        self.length = np.array([len(r) for r in self.raw], np.int64)
        # a token as it is spelled within, at the end of its side and at the end of its group
        self.spelled = np.array([s + mark for mark in ",|;" for s in spelled], object)

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both tokenizers; None without text or if a side doesn't spell the text."""
        if not text:
            return None
        left, right = [], []
        for piece in pieces_of(text):
            a = np.array(self.a.encode(" " + piece), np.int64)
            b = np.array(self.b.encode(piece), np.int64) + self.shift
            raw = (" " + piece).encode("utf-8", "surrogatepass")
            if b"".join(self.raw[a].tolist()) != raw or b"".join(self.raw[b].tolist()) != raw:
                return None
            left.append(a)
            right.append(b)
        return np.concatenate(left), np.concatenate(right)

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray]:
        """Columns with a row for each text, and the linked pairs (a id, b id) of all texts in a row."""
        found = [self.encoded(t) for t in texts]
        none = (np.zeros(0, np.int64),) * 2
        sides = [np.concatenate([(f or none)[k] for f in found] or [none[0]]) for k in (0, 1)]
        ends = [np.cumsum(self.length[s]) for s in sides]
        group = groups(*ends)
        # groups and tokens are in order, so counts by group give each token's place in the spelling
        n_groups = int(group[0][-1]) + 1 if len(group[0]) else 0
        upto = [np.cumsum(np.bincount(g, minlength=n_groups)) for g in group]
        before_b = np.concatenate([[0], upto[1][:-1]]) if n_groups else upto[1]
        order = np.empty(len(sides[0]) + len(sides[1]), np.int64)
        places = np.arange(len(sides[0])) + before_b[group[0]], np.arange(len(sides[1])) + upto[0][group[1]]
        for side, place, last, mark in zip(sides, places, upto, (1, 2), strict=True):
            marked = side.copy()
            marked[last - 1] += mark * self.size
            order[place] = marked
        words = self.spelled[order].tolist()
        links = np.stack([sides[0][upto[0] - 1], sides[1][upto[1] - 1] - self.shift], axis=1)
        out: dict[str, list] = {"n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": []}
        at_a = at = 0
        for f in found:
            a, b = (len(s) for s in (f or none))
            first = int(group[0][at_a]) if a else 0
            count = int(group[0][at_a + a - 1]) + 1 - first if a else 0
            spelled = "".join(words[at : at + a + b])[:-1]
            out["n_a"].append(a)
            out["n_b"].append(b)
            out["n_groups"].append(count)
            out["n_links"].append(count)
            out["groups_sha256"].append(hashlib.sha256(spelled.encode()).hexdigest() if spelled else "")
            at_a, at = at_a + a, at + a + b
        return out, links


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(spec: str, model: bytes) -> Aligner:
    """One per Python worker, as its tables take a while to build."""
    key = hash((spec, model))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(spec, model)
    return _ALIGNERS[key]


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned_blocks(docs: DataFrame, id: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """A table with a row for each text, with its links as numbers of the block's pairs, and one more for each block, with
    the pairs and how often they occur in it."""
    with open(paths[0], encoding="utf-8") as a, open(paths[1], "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # two vocabulary files
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("block", T.LongType()), T.StructField("id", docs.schema[id].dataType)]
    fields += [T.StructField(n, T.LongType()) for n in _COUNTS] + [T.StructField("groups_sha256", T.StringType())]
    fields += [T.StructField(n, ints) for n in ("links", "a", "b", "n")]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*sent.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in blocks(texts, BLOCK):
                out, links = aligner.align(texts[lo:hi].to_pylist())
                code, slot, n = np.unique(links[:, 0] << 32 | links[:, 1], return_inverse=True, return_counts=True)
                rows = hi - lo
                lists = lambda values, of=pa.int32(): pa.array(values, pa.list_(of))
                offsets = np.concatenate([[0], np.cumsum(out["n_links"])]).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(offsets), pa.array(slot.astype(np.int32)))
                nothing = lists([None] * rows)
                columns = [pa.array(np.full(rows, number)), batch.column(0).slice(lo, rows)]
                columns += [pa.array(out[c], pa.int64()) for c in _COUNTS] + [pa.array(out["groups_sha256"], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, own, nothing, nothing, nothing], names=schema.names)
                if len(code):
                    pairs = [[(code >> 32).astype(np.int32)], [(code & 0xFFFFFFFF).astype(np.int32)], [n.astype(np.int32)]]
                    blank = [pa.nulls(1, c.type) for c in columns[1:]]
                    row = [pa.array([number]), *blank, lists([None]), *[lists(p) for p in pairs]]
                    yield pa.RecordBatch.from_arrays(row, names=schema.names)
                number += 1

    rows = stored(docs.select(id, text).mapInArrow(run, schema), "aligned")
    sent.destroy()
    return rows


def aligned(
    docs: DataFrame, id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None
) -> DataFrame:
    """A row for each document: its id, n_a and n_b (tokens), n_groups, n_links (pairs of tokens that end
    together), n_best (links whose pair of ids is the most frequent one in the corpus of its b id, ties
    included), count_sum (the corpus counts of its links' pairs) and groups_sha256 (of the groups spelled as
    ``a1,a2|b1;a3|b2,b3``).

    ``paths`` name the two tokenizers' files. A text that is null, empty, or that one of the tokenizers does
    not spell byte by byte has no tokens: zeros and the empty string. Rows of equal or null ids are documents
    of their own, equal texts count as often as they occur, and only the two columns are read.
    """
    rows = _aligned_blocks(docs, id, text, paths or default_tokenizers())
    listed = rows.where("a IS NOT NULL").select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("slot", "p"))
    pairs = listed.select("block", "slot", "p.a", "p.b", "p.n")
    counts = pairs.groupBy("a", "b").agg(F.sum(F.col("n").cast("bigint")).alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    figures = skewed_join(pairs.drop("n"), known, ["a", "b"]).select(F.col("block").alias("of"), "slot", "count", "best")
    texts = rows.where("a IS NULL").drop("a", "b", "n")
    schema = T.StructType(
        [T.StructField(id, docs.schema[id].dataType)]
        + [T.StructField(n, T.LongType()) for n in (*_COUNTS, "n_best", "count_sum")]
        + [T.StructField("groups_sha256", T.StringType())]
    )

    def summed(texts: pa.Table, figures: pa.Table) -> pa.Table:
        slot = figures["slot"].to_numpy()
        count, best = np.zeros((2, len(slot)), np.int64)
        count[slot], best[slot] = figures["count"].to_numpy(), figures["best"].to_numpy()
        links = texts["links"].combine_chunks()
        taken = links.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(texts["n_links"].to_numpy())])
        sums = [np.concatenate([[0], np.cumsum(values[taken])]) for values in (best, count)]
        n_best, count_sum = (s[ends[1:]] - s[ends[:-1]] for s in sums)
        columns = [texts["id"], *[texts[c] for c in _COUNTS], pa.array(n_best), pa.array(count_sum), texts["groups_sha256"]]
        return pa.table(columns, names=schema.names)

    return texts.groupBy("block").cogroup(figures.groupBy("of")).applyInArrow(summed, schema)
