"""N-gram Jaccard join: size-banded tiles with bitmap signatures, then exact intersection of sorted arrays.

Sets are banded by size, so that linked sets lie in one band or in two adjacent ones. A tile holds sets of two
such bands that agree on a part of the hash range: the range is cut into more parts than linked sets of the
bands can have differing shingles, so two linked sets are equal on some part, and no link is missed. (For the
smallest bands a key takes several parts at once, which keeps it selective. Sets with so many empty parts that
they might agree on empty ones only, one in thousands, share a tile of their own.)

Inside a tile, block meets block. Bitmaps are compared first: each set has a bit for each shingle's hash, and
every bit that only one of two bitmaps has is a shingle that the other set lacks. So the bits that differ bound
the overlap from above, and only pairs that can still reach the threshold have their sorted arrays intersected.

Three things keep the work down without losing a link. Equal sets are one set. Keys travel packed, 16 bytes
each, and only once; those that one set alone has end there. And since components are wanted, each set first
meets the least set of its tiles; then tiles whose sets are not all in one component yet are searched block by
block. A tile with very many candidates first proposes stars only, which join most of a crowd; what is still
apart then is proposed in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import blocks, components, fresh, groups_of, marked, mixed, skewed_join, texts_of, word_hashes
from nearfield.scratch import stored

#: Words of a shingle, and the least similarity of linked sets as a fraction.
WORDS, SHARE = 4, (85, 100)
#: Bytes of text in a block, keys of one part of the shuffle, sets of a block in a tile.
TEXT, PART_KEYS, TILE_SETS = 8 << 20, 1 << 20, 1024
#: A key that more sets of a block of text have is not left to one task.
LOCAL = 8
#: Bits of a bitmap for each shingle, about, and of the shortest and longest bitmaps.
DENSITY, BITS = 16, (256, 1 << 18)
#: A tile with more candidate pairs than so many for each set is crowded. In the first rounds a crowded tile in
#: so many proposes stars, of so many hubs, and the others wait; in the last one all propose all their pairs.
CROWDED, TURNS, STARS = 4, (8, 2, 1), 64
#: Halvings of bitmaps before the first comparison.
FOLDS = 2
#: Words compared at once in a tile.
COMPARED = 1 << 21

_OF_WORD = np.ones(256, bool)
_OF_WORD[[9, 10, 11, 12, 13, 32]] = False
_WEIGHTS = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def _salted(x: np.ndarray | int, salt: int) -> np.ndarray:
    return mixed(np.asarray(x, np.uint64) + np.uint64((salt * _WEIGHTS[1] + _WEIGHTS[4]) % 2**64))


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; a text of fewer words has one, of all its words."""
    hashes, bounds = word_hashes(column, _OF_WORD)
    n = len(hashes)
    runs = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        runs += mixed(hashes[k : k + len(runs)] + np.uint64(_WEIGHTS[0] * (k + 1) % 2**64)) * np.uint64(_WEIGHTS[k % 5] | 1)
    runs = mixed(runs)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(runs[lo : hi - words + 1]))
        elif hi > lo:
            few = np.array([hi - lo], np.uint64)
            for h in hashes[lo:hi]:
                few = mixed(few * np.uint64(_WEIGHTS[2]) + h)
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(values: np.ndarray) -> int:
    """A 64-bit hash of the whole set."""
    total = np.add.reduce(_salted(values, 1), keepdims=True) + np.uint64(len(values) * _WEIGHTS[3] % 2**64)
    return int(mixed(total)[0].astype(np.int64))


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int] = SHARE) -> bool:
    """Whether two sets reach the similarity, by intersecting their sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.searchsorted(b, a)
    common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return share[1] * common >= share[0] * (len(a) + len(b) - common)


@lru_cache(None)
def _lows(share: tuple[int, int]) -> np.ndarray:
    """The least size of every band. A linked set of at least a band's size lies below the second next band."""
    lows = [1]
    while lows[-1] < 1 << 31:
        lows.append(lows[-1] * share[1] // share[0] + 1)
    return np.array(lows)


@lru_cache(None)
def _tiling(band: int, share: tuple[int, int]) -> tuple[int, np.ndarray, list[tuple[int, ...]]] | None:
    """How keys are made for a band and the next one: the parts that may differ and the borders of all, and the
    choices of parts that make a key. None if no two different sets can be linked."""
    low, high = share
    size = int(_lows(share)[band + 1]) - 1
    differ = (size + size * high // low) * (high - low) // (high + low)
    if not differ:
        return None
    if differ <= 4:
        parts, taken = 6, 6 - differ
    else:
        parts, taken = differ + 3 + differ // 20, 1
    borders = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    return differ, borders, list(combinations(range(parts), taken)) if taken > 1 else []


def tile_keys(values: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray:
    """The tiles of a set: two linked sets that differ share one."""
    band = int(np.searchsorted(_lows(share), len(values), side="right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_salted(values, 2))])
    out = []
    for low in (band - 1, band):
        tiling = _tiling(low, share) if low >= 0 else None
        if tiling is None:
            continue
        differ, borders, choices = tiling
        at = np.concatenate([[0], np.searchsorted(values, borders), [len(values)]])
        filled = at[1:] > at[:-1]
        places = np.arange(len(filled)).astype(np.uint64) + np.uint64(low << 32)
        content = _salted((sums[at[1:]] - sums[at[:-1]]) ^ _salted(places, 3), 4)
        if choices:
            chosen = np.array(choices)
            some = filled[chosen].any(axis=1)
            key = _salted(np.add.reduce(content[chosen], axis=1) + np.uint64(low), 5)[some]
        else:
            key = content[filled]
        out.append(key)
        if len(filled) - np.count_nonzero(filled) >= len(filled) - differ:
            out.append(_salted(np.array([low], np.uint64), 6))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def bitmap_of(values: np.ndarray) -> bytes:
    """A bit for every shingle, in a width that is a power of two."""
    width = min(max(BITS[0], 1 << (DENSITY * len(values) - 1).bit_length() - 1), BITS[1])
    bits = np.zeros(width, bool)
    bits[(values & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _close(
    sizes: tuple[np.ndarray, np.ndarray], bits: tuple[np.ndarray, np.ndarray], share: tuple[int, int]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs (left, right) that sizes and bitmaps don't rule out."""
    low, high = share
    right = np.argsort(sizes[1], kind="stable")
    n_right, of_right = sizes[1][right], np.ascontiguousarray(bits[1][right].T)
    left = np.argsort(sizes[0], kind="stable")
    words = bits[0].shape[1]
    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        n = sizes[0][some]
        lo = int(np.searchsorted(n_right * high, n[0] * low))
        hi = int(np.searchsorted(n_right * low, n[-1] * high, side="right"))
        run = max(1, COMPARED // len(some))
        for first in range(lo, hi, run):
            part = slice(first, min(first + run, hi))
            differ = np.zeros((len(some), part.stop - part.start), np.int32)
            for w in range(words):
                differ += np.bitwise_count(bits[0][some, w][:, None] ^ of_right[w, part][None, :])
            both = n[:, None] + n_right[part][None, :]
            a, b = np.nonzero((high - low) * both >= (high + low) * differ.astype(np.int64))
            yield some[a], right[part][b]


def _stars(a: np.ndarray, b: np.ndarray, roots: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Places in a list of pairs that make up stars: from the component with most pairs to all components it
    has pairs with, one pair each, then from the next one to those that are left."""
    ends = np.concatenate([roots[a], roots[b]])
    names, codes = np.unique(ends, return_inverse=True)
    at, to = codes[: len(a)], codes[len(a) :]
    # the most similar pair of two components
    first = np.lexsort((differ, np.maximum(at, to), np.minimum(at, to)))
    new = np.ones(len(first), bool)
    x, y = np.minimum(at, to)[first], np.maximum(at, to)[first]
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    edges, x, y = first[new], x[new], y[new]
    uncovered, taken = np.ones(len(names), bool), []
    for _ in range(STARS):
        live = uncovered[x] & uncovered[y]
        if not live.any():
            break
        hub = int(np.argmax(np.bincount(np.concatenate([x[live], y[live]]), minlength=len(names))))
        mine = live & ((x == hub) | (y == hub))
        taken.append(edges[mine])
        uncovered[x[mine]] = uncovered[y[mine]] = False
    return np.concatenate(taken) if taken else np.zeros(0, np.int64)


def _folded(bits: np.ndarray, times: int) -> np.ndarray:
    """Bitmaps (rows) with their halves laid on each other, so many times."""
    for _ in range(times):
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _tile_pairs(tile: pa.Table, share: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """(a, b, differ): places of sets in different components that may be linked, of one tile's two blocks, and
    the bits that differ. Bitmaps are compared folded first, and the pairs that are left whole."""
    low, high = share
    roots, n = (tile[c].to_numpy() for c in ("root", "n"))
    block, ends = tile["block"].to_numpy(), (tile["i"][0].as_py(), tile["j"][0].as_py())
    raw = tile["bits"].to_pylist()
    widths = np.array([len(r) for r in raw])
    found = [(np.zeros(0, np.int64),) * 3]
    for width in np.unique(widths).tolist():
        for other in (width, 2 * width):
            of = lambda w, end: np.flatnonzero((widths == w) & (block == end))
            sides = [(of(width, ends[0]), of(other, ends[1]))]
            if ends[0] != ends[1] and other != width:
                sides.append((of(width, ends[1]), of(other, ends[0])))
            for small, large in sides:
                if not len(small) or not len(large):
                    continue
                x = np.frombuffer(b"".join(raw[k] for k in small), np.uint64).reshape(len(small), -1)
                y = np.frombuffer(b"".join(raw[k] for k in large), np.uint64).reshape(len(large), -1)
                y = _folded(y, int(other != width))
                folds = min(FOLDS, x.shape[1].bit_length() - 1)
                for a, b in _close((n[small], n[large]), (_folded(x, folds), _folded(y, folds)), share):
                    apart = roots[small[a]] != roots[large[b]]
                    a, b = a[apart], b[apart]
                    for at in range(0, len(a), run := max(1, COMPARED // x.shape[1])):
                        some = slice(at, at + run)
                        differ = np.bitwise_count(x[a[some]] ^ y[b[some]]).sum(axis=1, dtype=np.int64)
                        p, q = small[a[some]], large[b[some]]
                        good = (high - low) * (n[p] + n[q]) >= (high + low) * differ
                        found.append((p[good], q[good], differ[good]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _proposed(tile: pa.Table, share: tuple[int, int], turn: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(a, b, waiting): the pairs of ids, a < b, that a tile proposes, and whether it has others. ``turn`` 0
    asks for all; else a crowded tile proposes stars if its key is divisible by it, and otherwise nothing."""
    a, b, differ = _tile_pairs(tile, share)
    waiting = bool(turn and len(a) > CROWDED * len(tile))
    if waiting:
        roots = tile["root"].to_numpy()
        some = _stars(a, b, roots, differ) if tile["key"][0].as_py() % turn == 0 else np.zeros(0, np.int64)
        a, b = a[some], b[some]
    ids = tile["sid"].to_numpy()
    a, b = ids[a], ids[b]
    return np.minimum(a, b), np.maximum(a, b), waiting


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def document_sets(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(id, n, sid) of every row; sid is null for an empty set."""
    schema = T.StructType([docs.schema[id], *_fields(n=T.LongType(), sid=T.LongType()).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts_of(batch.column(1))
            for lo, hi in blocks(column, TEXT):
                sets = shingle_sets(column[lo:hi], words)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sizes, ids], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def _packed_keys(docs: DataFrame, text: str, words: int, share: tuple[int, int], parts: int) -> DataFrame:
    """(part, keys, sids, whole): the tiles of all sets, packed for each part of the keys' range. Where ``whole``,
    the rows are members as they are and need not meet others of their part."""
    schema = _fields(part=T.LongType(), keys=T.BinaryType(), sids=T.BinaryType(), whole=T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets of a task count once
        for batch in batches:
            column = texts_of(batch.column(0))
            for lo, hi in blocks(column, TEXT):
                keys, sids = [], []
                for values in shingle_sets(column[lo:hi], words):
                    sid = set_id(values)
                    if sid not in seen:
                        seen.add(sid)
                        keys.append(tile_keys(values, share))
                        sids.append(np.full(len(keys[-1]), sid))
                if not sum(map(len, keys)):
                    continue
                key, sid = np.concatenate(keys), np.concatenate(sids)
                order = np.lexsort((sid, key))
                key, sid = key[order], sid[order]
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                sizes = np.diff(np.concatenate([starts, [len(key)]]))
                crowded = np.repeat(sizes > LOCAL, sizes)
                # of a key that many sets here have, two go to its part, which tells that it is shared
                sent = ~crowded | (np.arange(len(key)) - np.repeat(starts, sizes) < 2)
                rows = []
                if crowded.any():
                    rows.append((parts + (int(sid[0]) & 0xFFFFFFFF), key[crowded], sid[crowded], True))
                part = (key % np.uint64(parts)).astype(np.int64)
                part_order = np.argsort(part[sent], kind="stable")
                key, sid, part = (x[sent][part_order] for x in (key, sid, part))
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                rows += [(int(part[s]), key[s:e], sid[s:e], False) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1].tobytes() for r in rows], pa.binary()),
                        pa.array([r[2].tobytes() for r in rows], pa.binary()),
                        pa.array([r[3] for r in rows], pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.select(text).mapInArrow(run, schema)


def tile_members(docs: DataFrame, sets: DataFrame, text: str, words: int, share: tuple[int, int]) -> DataFrame:
    """(key, sid, lead): the tiles that several sets have, with their sets; lead is one of the least."""
    shingles = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(1, shingles * 4 // 10 // PART_KEYS)  # about 0.4 keys a shingle
    schema = _fields(key=T.LongType(), sid=T.LongType(), lead=T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups_of(batches, 1):
            whole = rows["whole"].to_pylist()
            joined = lambda name, kind: np.frombuffer(b"".join(rows[name].to_pylist()), kind)
            key, sid = joined("keys", np.int64), joined("sids", np.int64)
            order = np.lexsort((sid, key))
            key, sid = key[order], sid[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            least, most = sid[starts], sid[starts + sizes - 1]
            lead = np.repeat(least, sizes)
            shared = np.ones(len(key), bool) if whole[0] else np.repeat(least != most, sizes)
            # copies of a set from several tasks are one member
            shared[1:] &= (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[shared]) for x in (key, sid, lead)], names=schema.names)

    packed = _packed_keys(docs, text, words, share, parts)
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def _arrays(docs: DataFrame, id: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """(sid, n, bits, hashes) of the sets in ``wanted`` (sid, holder: the id of a row that has it)."""
    schema = _fields(sid=T.LongType(), n=T.LongType(), bits=T.BinaryType(), hashes=T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            column = texts_of(batch.column(0))
            for lo, hi in blocks(column, TEXT):
                new = {}
                for values in shingle_sets(column[lo:hi], words):
                    if len(values) and (sid := set_id(values)) not in seen:
                        seen.add(sid)
                        new[sid] = values
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(new), pa.int64()),
                        pa.array([len(v) for v in new.values()], pa.int64()),
                        pa.array([bitmap_of(v) for v in new.values()], pa.binary()),
                        pa.array([v.tobytes() for v in new.values()], pa.binary()),
                    ],
                    names=schema.names,
                )

    mark = fresh(docs.select(id, text), "_wanted")
    held = marked(docs.select(id, text), wanted, {id: "holder"}, mark).where(mark).select(text)
    # an id may stand on several rows, so the set decides, not the id
    found = held.mapInArrow(run, schema).join(wanted.select("sid"), "sid", "left_semi")
    return found.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "bits", "hashes")])


def _confirmed(pairs: DataFrame, arrays: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of sets that reach the similarity."""
    schema = _fields(a=T.LongType(), b=T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(h, np.uint64) for h in batch.column(k).to_pylist()] for k in (2, 3)]
            good = pa.array([linked(a, b, share) for a, b in zip(*sides, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=schema.names).filter(good)

    side = lambda name: arrays.select(F.col("sid").alias(name), F.col("hashes").alias(f"{name}_hashes"))
    both = skewed_join(skewed_join(pairs, side("a"), ["a"]), side("b"), ["b"])
    return both.select("a", "b", "a_hashes", "b_hashes").mapInArrow(run, schema)


def _open_tiles(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, sid, root, sets): the members of tiles whose sets are in several components. ``members`` may have
    ``sets``, which stays then."""
    roots = roots.select(F.col("node").alias("sid"), "root")
    size = ["sets"] if "sets" in members.columns else []
    placed = skewed_join(members.select("key", "sid", *size), roots, ["sid"], "left")
    placed = stored(placed.select("key", "sid", F.coalesce("root", "sid").alias("root"), *size), "members")
    of_tile = [F.max("sets").alias("sets") if size else F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high")]
    # tiles of the same sets are one
    of_tile += [F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("content")]
    tiles = placed.groupBy("key").agg(*of_tile).where("low <> high")
    tiles = tiles.groupBy("sets", "low", "high", "content").agg(F.min("key").alias("key")).select("key", "sets")
    return stored(skewed_join(placed.drop("sets"), tiles, ["key"]).select("key", "sid", "root", "sets"), "open")


_TILE = ["key", "i", "j"]


def _proposals(members: DataFrame, waiting: DataFrame | None, arrays: DataFrame, share: tuple[int, int], turn: int) -> DataFrame:
    """(key, i, j, waiting, a, b): what the open tiles' pairs of blocks propose; of the ``waiting`` ones only, if
    given. Pairs (a, b) are of different components and not ruled out by bitmaps; those that have others wait
    for the next round, and say so in a row without a pair."""
    schema = _fields(key=T.LongType(), i=T.LongType(), j=T.LongType(), waiting=T.BooleanType(), a=T.LongType(), b=T.LongType())
    dealt = members.withColumn("blocks", F.ceil(F.col("sets") / F.lit(TILE_SETS)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "root")
    if waiting is not None:
        dealt = skewed_join(dealt, waiting, _TILE, "left_semi")
    with_bits = skewed_join(dealt, arrays.select("sid", "n", "bits"), ["sid"]).select(*_TILE, "block", "sid", "root", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups_of(batches, 3):
            a, b, more = _proposed(tile, share, turn)
            for at in range(0, len(a) + more, 1 << 20):
                x, y = (pa.array(s[at : at + (1 << 20)], pa.int64()) for s in (a, b))
                if more and not at:
                    x, y = (pa.concat_arrays([pa.nulls(1, pa.int64()), s]) for s in (x, y))
                names = [pa.array(np.full(len(x), tile[c][0].as_py()), pa.int64()) for c in _TILE]
                told = pa.array([bool(more and not at), *[False] * (len(x) - 1)], pa.bool_())
                yield pa.RecordBatch.from_arrays([*names, told, x, y], names=schema.names)

    return with_bits.repartition(*_TILE).sortWithinPartitions(*_TILE).mapInArrow(run, schema)


def linked_sets(
    docs: DataFrame, sets: DataFrame, id: str, text: str, words: int = WORDS, share: tuple[int, int] = SHARE
) -> DataFrame:
    """(node, root): the sets that are linked to another one, with the least set of their component.

    The first links are those to the least set of a set's tiles. Then open tiles propose the pairs that are left
    between different components; crowded ones propose stars first, and all pairs in the last round.
    """
    members = stored(tile_members(docs, sets, text, words, share), "tiles")
    holders = sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min(id).alias("holder"))
    wanted = stored(holders.join(members.select("sid").distinct(), "sid", "left_semi"), "wanted")
    arrays = stored(_arrays(docs, id, text, words, wanted), "sets")
    first = members.groupBy("sid").agg(F.min("lead").alias("b")).where("sid <> b").select(F.col("sid").alias("a"), "b")
    roots = components(_confirmed(first, arrays, share))
    waiting = None
    for turn in (*TURNS, 0):
        members = _open_tiles(members, roots)
        proposed = stored(_proposals(members, waiting, arrays, share, turn), "proposed")
        pairs = proposed.where("a IS NOT NULL").select("a", "b").distinct()
        more = stored(_confirmed(pairs, arrays, share), "links")
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        waiting = proposed.where("waiting").select(*_TILE)
        if waiting.isEmpty():
            break
        # the tiles that wait keep their blocks
        members = members.join(waiting.select("key").distinct(), "key", "left_semi")
    return roots


def joined_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, share: tuple[int, int] = SHARE
) -> DataFrame:
    """doc id, n_shingles, component_id: the components of documents whose sets of word shingles have a
    Jaccard similarity of at least ``share`` (a fraction), as the smallest id that links reach.

    A-Z count as a-z; words end at space and at bytes 9 to 13. A text of fewer words has one shingle, of all
    its words; a null or blank text has none and links with nothing. Equal texts, and rows of equal ids, are
    documents of their own. Null ids are never the smallest; where all ids of a component are null, component_id
    is null. Sets are compared by 64-bit hashes of their shingles and told apart by a 64-bit hash of the whole.
    """
    sets = stored(document_sets(docs, id, text, words), "documents")
    roots = linked_sets(docs, sets, id, text, words, share)
    named = sets.toDF("id", "n", "sid")
    classes = named.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("least"))
    placed = classes.join(roots.toDF("sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    placed = stored(placed, "classes")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = skewed_join(placed.select("sid", "root"), smallest, ["root"]).select("sid", "component_id")
    full = skewed_join(named.where("sid IS NOT NULL"), of_set, ["sid"]).select("id", "n", "component_id")
    empty = named.where("sid IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).toDF(id, "n_shingles", "component_id")
