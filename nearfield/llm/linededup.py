"""Line deduplication with fuzzy matches: of lines that are nearly equal, only the first stays.

DataFrame functions only. Equal lines are one by two hashes. Distinct lines get a MinHash signature of
their character shingles: of short lines the SHORT characters from each character on; of long ones the first
SHINGLE characters of each three words in a row (in text that hardly has spaces, the SHINGLE bytes from each byte
on), which one changed letter in many words hardly touches. Each band hashes the shingles anew and keeps the
least and the greatest of one half of the hashes and the least of the other. Lines that agree in a band are
candidates: of a small bucket all pairs, of a larger one each line with the first. Candidates are confirmed by
the exact Jaccard similarity of their shingle sets. Lines of larger buckets that this leaves apart meet their
neighbours in order of a hash, and those still apart meet once more by an exact prefix filter: two sets that are
similar enough share one of their rarest shingles. Components of confirmed links are found by distributed union-find,
and each component keeps its first occurrence in order of doc_id and place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfield.llm.common import components, fresh, marked, skewed_join
from nearfield.operators.skew import join_close
from nearfield.scratch import stored, stored_alone

#: Two lines of fewer words and bytes together are short: compared by characters. Lines of up to LINE_WORDS[1]
#: words and LINE_BYTES[1] bytes have such signatures, lines from LINE_WORDS[0] or LINE_BYTES[0] on the others
#: (those between have both: similar lines differ by a quarter in size at most).
SHORT, PAIR_WORDS, PAIR_BYTES = 5, 40, 800
LINE_WORDS, LINE_BYTES = (16, 24), (350, 500)
#: 12 characters reach over two words: lines of one language share few of them by chance.
SHINGLE, BANDS, ROWS = 12, 8, 3  # the three values of a band are fixed in signatures()
#: Lines of so many bytes a word have signatures from words, and from so many on, from bytes; those between
#: have either. Two lines are compared by bytes if together they have more than their mean a word.
WORDS_TO, BYTES_FROM = 20, 16
_WORDS, _BYTES, _CHARS = 0, 1, 2
#: Each line of a bucket meets so many before it, so that buckets up to one more are compared pair by pair; in
#: larger ones only those that aren't in one component by then.
NEIGHBOURS = 16
#: A bucket that shows in this share of the band rows of every SAMPLED-th line, and there at least so
#: often, is dealt into parts of about PART_ROWS lines, each of which meets the bucket's first line.
HOT_SHARE, SAMPLED, HOT_ROWS, PART_ROWS = 1e-4, 64, 64, 4096
#: Odd bits of a set of shingles, in words of 64 (a power of two): more tell more sets apart before they are compared.
ODD_BITS = 4


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos and line, without outer white space, of the lines that aren't blank."""
    text = F.coalesce("text", F.lit(""))
    each = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    trimmed = each.select("doc_id", "text_hash", "pos", F.trim("line", F.lit(" \t\r")).alias("line"))
    return trimmed.where("line <> ''")


def _from_word(words: str, at: Column) -> Column:
    """The first SHINGLE characters of a word and the two after it."""
    parts = [F.get(words, at), *[F.coalesce(F.get(words, at + k), F.lit("")) for k in (1, 2)]]
    return F.substring(F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2]), 1, SHINGLE)


def _from_byte(line: str, at: Column) -> Column:
    return F.substring(F.col(line).cast("binary"), at + 1, F.lit(SHINGLE))


def _from_char(line: str, at: Column) -> Column:
    return F.substring(F.col(line), at + 1, F.lit(SHORT))


def _last_char(line: str) -> Column:
    """Where the last shingle by characters begins; a line of fewer has one, itself."""
    return F.greatest(F.char_length(line) - SHORT, F.lit(0))


def _split(line: str) -> Column:
    return F.split(line, " ", -1)


def _is_short(size: Column, n_words: Column) -> Column:
    return (n_words <= LINE_WORDS[1]) & (size <= LINE_BYTES[1])


def _is_long(size: Column, n_words: Column) -> Column:
    return (n_words >= LINE_WORDS[0]) | (size >= LINE_BYTES[0])


def signatures(lines: DataFrame) -> DataFrame:
    """h1, kind, n and v0, v1, ...: the signatures of the distinct lines (those of h1, line); n is how often
    the line occurs."""
    split = lines.select("h1", "line", _split("line").alias("words"))
    size, n_words = F.octet_length("line"), F.size("words")
    some, other = F.lit(_WORDS), F.lit(_BYTES)
    kinds = F.when(~_is_long(size, n_words), F.array().cast("array<int>")).when(size < BYTES_FROM * n_words, F.array(some))
    kinds = kinds.when(size <= WORDS_TO * n_words, F.array(some, other)).otherwise(F.array(other))
    kinds = F.when(_is_short(size, n_words), F.array_append(kinds, F.lit(_CHARS))).otherwise(kinds)
    each = split.select("h1", "line", "words", F.explode(kinds).alias("kind"))
    last = F.when(F.col("kind") == _CHARS, _last_char("line")).when(F.col("kind") == _WORDS, F.size("words") - 1)
    last = last.otherwise(F.octet_length("line") - SHINGLE)
    placed = each.select("h1", "line", "words", "kind", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    at = F.col("at")
    by_word, by_byte = F.xxhash64(_from_word("words", at)), F.xxhash64(_from_byte("line", at))
    value = F.when(F.col("kind") == _CHARS, F.xxhash64(_from_char("line", at))).when(F.col("kind") == _WORDS, by_word)
    hashed = placed.select("h1", "kind", "at", value.otherwise(by_byte).alias("hash"))
    # a hash of its own for each band; its two halves and two points give the band's three values
    owns = [F.xxhash64("hash", F.lit(band)).alias(f"own{band}") for band in range(BANDS)]
    hashed = hashed.select("h1", "kind", "at", *owns)
    closest = []
    for band in range(BANDS):
        own = F.col(f"own{band}")
        high, low = F.shiftright(own, 32).cast("int"), (own.bitwiseAND(0xFFFFFFFF) - 2**31).cast("int")
        closest += [F.min(high), F.min(low), F.max(high)]
    closest = [c.alias(f"v{k}") for k, c in enumerate(closest)]
    return hashed.groupBy("h1", "kind").agg(F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("n"), *closest)


def bands(sig: DataFrame) -> DataFrame:
    """h1, n and the hashes of its bands: BANDS of ROWS values each; of signatures by characters, which lines of
    one language share more of by chance, bands of one value more (so fewer of them)."""

    def keys(rows: int) -> Column:
        return F.array(*[F.hash("kind", *[f"v{k + j}" for j in range(rows)]) for k in range(0, BANDS * ROWS, rows)])

    return sig.select("h1", "n", F.when(F.col("kind") == _CHARS, keys(ROWS + 1)).otherwise(keys(ROWS)).alias("bands"))


def meetings(banded: DataFrame) -> DataFrame:
    """h1, band, part, crowded and others: for each line of a bucket (those that have a band in common, in parts if
    they are many) the lines that it meets there; crowded tells whether there are more than those.

    ``banded`` should be a stored table of ``bands``.
    """
    each = banded.select("h1", F.posexplode("bands").alias("no", "key"))
    band = F.shiftleft(F.col("no").cast("long"), 32).bitwiseOR(F.col("key").cast("long").bitwiseAND(0xFFFFFFFF))
    rows = each.select("h1", band.alias("band"))
    seen = rows.where(F.pmod("h1", F.lit(SAMPLED)) == 0)
    least = max(HOT_ROWS, HOT_SHARE * BANDS * banded.count() / SAMPLED)
    # at most 1 / HOT_SHARE rows, as each has that share of them
    hot = seen.groupBy("band").agg(F.count("*").alias("n"), F.min("h1").alias("lead")).where(F.col("n") >= least)
    dealt = rows.join(F.broadcast(hot), "band", "left")
    parts = F.coalesce(F.ceil(F.col("n") * SAMPLED / PART_ROWS), F.lit(1))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("h1"), parts))
    bucket = Window.partitionBy("band", "part")
    dealt = dealt.withColumn("size", F.count("*").over(bucket)).where("size > 1 OR lead IS NOT NULL")
    order = bucket.orderBy("h1")
    before = [F.lag("h1", k).over(order) for k in range(1, NEIGHBOURS + 1)]
    first = F.first("h1").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crowded = (F.col("size") > NEIGHBOURS + 1) | F.col("lead").isNotNull()
    others = F.when(crowded, F.array(first, "lead")).otherwise(F.array(*before))
    return dealt.select("h1", "band", "part", crowded.alias("crowded"), others.alias("others"))


def _pairs_of(met: DataFrame) -> DataFrame:
    """(a, b) with a < b: each line h1 with its others."""
    pairs = met.select("h1", F.explode("others").alias("other")).where("other <> h1")
    return pairs.select(F.least("h1", "other").alias("a"), F.greatest("h1", "other").alias("b")).distinct()


def candidate_pairs(met: DataFrame) -> DataFrame:
    """(a, b) with a < b: lines that meet in a bucket (a stored table of ``meetings``)."""
    return _pairs_of(met.withColumn("others", F.array_distinct(F.filter("others", lambda other: other.isNotNull()))))


def neighbour_pairs(met: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) with a < b: lines of crowded buckets (those of ``meetings``) and their neighbours there that are in
    different components of ``found`` (node, root)."""
    rows = met.where("crowded").select("h1", "band", "part")
    roots = found.select(F.col("node").alias("h1"), "root")
    named = skewed_join(rows, roots, ["h1"], "left").withColumn("root", F.coalesce("root", "h1"))
    order = Window.partitionBy("band", "part").orderBy("h1")
    before = F.array(*[F.lag(F.struct("h1", "root"), k).over(order) for k in range(1, NEIGHBOURS + 1)])
    apart = F.filter(F.col("before"), lambda other: other["root"] != F.col("root"))
    met = named.select("h1", "root", before.alias("before")).where(F.size(apart) > 0)
    return _pairs_of(met.select("h1", F.transform(apart, lambda other: other["h1"]).alias("others")))


def crowd_pairs(crowd: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of the lines ``crowd`` (h1) that may be similar enough and are in different
    components of ``found`` (node, root).

    Shingles are put in order of how many of the lines have them, rarest first. Of two sets of n <= m shingles
    with 100 * intersection >= percent * union, one of the first n - 2 * percent * n / (100 + percent) + 1
    of the smaller is among the first m - percent * m / 100 + 1 of the larger. A shared shingle at places i and j
    leaves room for min(i, j) common ones before it and as many after it as the shorter rest has; pairs for
    which that isn't enough don't leave the join. Nor do those whose sets differ in too many shingles: each odd
    bit of a set tells whether it has an odd number of the shingles that fall there, so two sets differ in as many
    shingles as in odd bits, or more.
    """
    weights = found.groupBy("root").agg(F.count("*").alias("weight"))
    roots = skewed_join(found, weights, ["root"]).withColumnRenamed("node", "h1")
    known = sets.join(crowd, "h1", "left_semi").join(roots, "h1", "left")
    by_word = F.when((F.col("size") <= WORDS_TO * F.col("n_words")) & _is_long(F.col("size"), F.col("n_words")), F.col("by_word"))
    by_kind = ((_WORDS, by_word), (_BYTES, F.col("by_byte")), (_CHARS, F.col("by_char")))
    kinds = [F.struct(F.lit(kind).alias("kind"), c.alias("shingles")) for kind, c in by_kind]
    root, weight = F.coalesce("root", "h1").alias("root"), F.coalesce("weight", F.lit(1)).alias("weight")
    each = known.select("h1", root, weight, F.explode(F.array(*kinds)).alias("of")).select("h1", "root", "weight", "of.*")
    placed = stored(each.select("h1", "root", "weight", "kind", F.explode("shingles").alias("shingle")), "shingles")
    counts = placed.groupBy("kind", "shingle").agg(F.count("*").alias("n"))
    counted = skewed_join(placed, counts, ["kind", "shingle"])
    rarest = F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("rarest")
    odds = [f"odd{k}" for k in range(ODD_BITS)]
    bit = F.expr("shiftleft(1L, cast(shingle & 63 AS INT))")
    word = F.shiftright("shingle", 6).bitwiseAND(ODD_BITS - 1)
    odd = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(o) for k, o in enumerate(odds)]
    ordered = counted.groupBy("h1", "root", "weight", "kind").agg(rarest, *odd).withColumn("m", F.size("rarest"))
    probed = F.expr(f"m - ({percent} * m + 99) div 100 + 1").cast("int")
    indexed = F.expr(f"m - ({2 * percent} * m + {99 + percent}) div {100 + percent} + 1")
    first = ordered.select("*", F.posexplode(F.slice("rarest", F.lit(1), probed)).alias("at", "one"))
    first = first.select("h1", "root", "weight", "kind", "m", *odds, F.col("one.shingle").alias("shingle"), "at", (F.col("at") < indexed).alias("short"))
    first = stored(first, "prefixes")
    # lines of one component needn't meet, so of each shingle's lines those of the largest one don't
    lists = first.groupBy("kind", "shingle").agg(
        F.max(F.struct("weight", "root")).alias("most"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("short").alias("any")
    )
    lists = lists.where("any AND lo < hi").select("kind", "shingle", F.col("most.root").alias("most"))
    rows = stored(skewed_join(first, lists, ["kind", "shingle"]).withColumn("main", F.col("root") == F.col("most")), "lists")
    keys = ["kind", "shingle"]
    short = rows.where("short").select(*keys, F.col("h1").alias("a"), F.col("root").alias("root_a"), F.col("m").alias("m_a"), F.col("at").alias("at_a"), "main", *[F.col(o).alias(f"{o}_a") for o in odds])
    long = rows.select(*keys, F.col("h1").alias("b"), F.col("root").alias("root_b"), F.col("m").alias("m_b"), F.col("at").alias("at_b"), F.col("main").alias("main_b"), *[F.col(o).alias(f"{o}_b") for o in odds])
    order = F.struct("m_a", "a") < F.struct("m_b", "b")
    test = (F.col("root_a") != F.col("root_b")) & order & (100 * F.col("m_a") >= percent * F.col("m_b"))
    room = F.least("at_a", "at_b") + F.least(F.col("m_a") - F.col("at_a"), F.col("m_b") - F.col("at_b"))
    test = test & ((100 + percent) * room >= percent * (F.col("m_a") + F.col("m_b")))
    differ = sum(F.bit_count(F.col(f"{o}_a").bitwiseXOR(F.col(f"{o}_b"))) for o in odds)
    test = test & ((100 - percent) * (F.col("m_a") + F.col("m_b")) >= (100 + percent) * differ)
    met = join_close(short.where("NOT main"), long, keys, test)
    met = met.unionByName(join_close(short.where("main"), long.where("NOT main_b"), keys, test))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shingle_sets(lines: DataFrame) -> DataFrame:
    """h1, size, n_words, by_word, by_byte and by_char: the sets of shingle hashes of the lines (h1, line); null
    for kinds that the line is not compared by."""
    # stored split: words that were computed here would be split anew for each shingle
    split = stored(lines.select("h1", "line", _split("line").alias("words")), "split")
    size, n_words = F.octet_length("line"), F.size("words")
    each_word = F.transform(F.sequence(F.lit(0), n_words - 1), lambda at: F.xxhash64(_from_word("words", at)))
    each_byte = F.transform(F.sequence(F.lit(0), size - SHINGLE), lambda at: F.xxhash64(_from_byte("line", at)))
    each_char = F.transform(F.sequence(F.lit(0), _last_char("line")), lambda at: F.xxhash64(_from_char("line", at)))
    long = _is_long(size, n_words)
    return split.select(
        "h1",
        size.alias("size"),
        n_words.alias("n_words"),
        F.when(long, F.array_distinct(each_word)).alias("by_word"),
        F.when(long & (size >= BYTES_FROM * n_words), F.array_distinct(each_byte)).alias("by_byte"),
        F.when(_is_short(size, n_words), F.array_distinct(each_char)).alias("by_char"),
    )


def confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their shingle sets (``shingle_sets``); the sizes are
    looked at first."""
    sizes = sets.select("h1", "size", "n_words", *[F.size(c).alias(f"m_{c}") for c in ("by_word", "by_byte", "by_char")])
    return similar_pairs(_of_similar_size(pairs, stored(sizes, "sizes"), percent), sets, percent)


def similar_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``confirmed_pairs`` of pairs that are hardly fewer by size alone, such as those of ``crowd_pairs``."""
    first, second = (sets.toDF(*[c if c == e else f"{c}_{e}" for c in (e, *sets.columns[1:])]) for e in ("a", "b"))
    both = skewed_join(skewed_join(pairs, first, ["a"]), second, ["b"])
    found = both.select("a", "b", *_compared("by"))
    # n >= percent / 100 of the union, in a form that takes the intersection once
    n = F.size(F.array_intersect("sa", "sb"))
    return found.where((100 + percent) * n >= percent * (F.size("sa") + F.size("sb"))).select("a", "b")


def _compared(prefix: str) -> list[Column]:
    """sa and sb: of two lines' columns by kind those of the kind that the pair is compared by."""
    by_bytes = (F.col("size_a") + F.col("size_b")) * 2 > (WORDS_TO + BYTES_FROM) * (F.col("n_words_a") + F.col("n_words_b"))
    short = (F.col("n_words_a") + F.col("n_words_b") < PAIR_WORDS) & (F.col("size_a") + F.col("size_b") <= PAIR_BYTES)
    long = [F.when(by_bytes, F.col(f"{prefix}_byte_{e}")).otherwise(F.col(f"{prefix}_word_{e}")) for e in ("a", "b")]
    return [F.when(short, F.col(f"{prefix}_char_{e}")).otherwise(c).alias(f"s{e}") for e, c in zip(("a", "b"), long, strict=True)]


def _of_similar_size(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets differ so little in size that they can be similar enough."""
    first, second = (sizes.toDF(*[c if c == e else f"{c}_{e}" for c in (e, *sizes.columns[1:])]) for e in ("a", "b"))
    both = skewed_join(skewed_join(pairs, first, ["a"]), second, ["b"]).select("a", "b", *_compared("m_by"))
    return both.where(100 * F.least("sa", "sb") >= percent * F.greatest("sa", "sb")).select("a", "b")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` (node, root) after more links (a, b)."""
    if links.isEmpty():
        return found
    return components(links.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def dropped_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, text_hash and dropped: the places (from 0) of the lines that go, for documents that have any."""
    lines = _lines(docs).withColumn("h1", F.xxhash64("line"))
    banded = stored(bands(signatures(lines.select("h1", "line"))), "bands")
    met = stored(meetings(banded), "meetings")
    pairs = stored(candidate_pairs(met), "pairs")

    # the lines that occur more than once or have a candidate, and a few others
    ends = pairs.select(F.col("a").alias("h1")).unionByName(pairs.select(F.col("b").alias("h1")))
    wanted = stored(ends.unionByName(banded.where("n > 1").select("h1")).distinct(), "wanted")
    seen = marked(lines, wanted, {"h1": "h1"}).where("_set").drop("_set")
    seen = stored(seen.withColumn("h2", F.xxhash64(F.lit(1), "line")), "seen")

    # one of equal lines first, so that no common line meets itself in the join
    compared = seen.groupBy("h1").agg(F.min("line").alias("line"))
    compared = skewed_join(compared, stored(ends.distinct(), "ends"), ["h1"], "left_semi")
    sets = stored(shingle_sets(compared), "sets")
    links = stored(confirmed_pairs(pairs, sets, percent), "links")
    found = components(links)
    crowd = stored(met.where("crowded").select("h1").distinct(), "crowd")
    if not crowd.isEmpty():
        near = stored(neighbour_pairs(met, found), "pairs")
        found = _joined(found, stored(confirmed_pairs(near, sets, percent), "links"))
        rest = stored(crowd_pairs(crowd, sets, found, percent), "pairs")
        found = _joined(found, stored(similar_pairs(rest, sets, percent), "links"))
    found = found.select(F.col("node").alias("h1"), "root")

    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "pos")
    named = seen.drop("line").join(found, "h1", "left")
    # two lines of one h1 are told apart by h2 unless near ones tie them
    other = F.when(F.col("root").isNull(), F.col("h2")).otherwise(0).alias("other")
    grouped = stored(named.select("doc_id", "text_hash", "pos", other, F.coalesce("root", "h1").alias("root")), "grouped")
    keeper = grouped.groupBy("root", "other").agg(F.min(here).alias("keeper"))
    lost = skewed_join(grouped, keeper, ["root", "other"]).where(here != F.col("keeper"))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))


def without_repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with ``text`` shortened by the lines that ``dropped_lines`` names, and n_dropped.

    Null and empty texts stay as they are, as do blank lines. Rows of equal doc_id and text are one document. Columns that are named like the new ones are replaced.
    """
    lost = stored_alone(lambda: dropped_lines(docs, percent), "dropped")
    hash_name, array_name = fresh(docs, "text_hash"), fresh(docs, "dropped")
    hashed = docs.withColumn(hash_name, F.xxhash64(F.coalesce("text", F.lit(""))))
    seen = marked(hashed, lost, {"doc_id": "doc_id", hash_name: "text_hash"}, name := fresh(docs, "set"))
    same = F.col("doc_id").eqNullSafe(F.col("_lost_id")) & (F.col(hash_name) == F.col("_lost_hash"))
    found = lost.select(F.col("doc_id").alias("_lost_id"), F.col("text_hash").alias("_lost_hash"), F.col("dropped").alias(array_name))
    joined = seen.where(F.col(name)).join(found, same, "left")
    kept = F.filter(F.split("text", "\n", -1), lambda line, at: ~F.array_contains(array_name, at))
    gone = F.col(array_name).isNotNull()
    text = F.when(gone, F.array_join(kept, "\n")).otherwise(F.col("text"))
    columns = [c for c in docs.columns if c != "n_dropped"]
    cut = joined.withColumn("n_dropped", F.when(gone, F.size(array_name)).otherwise(0).cast("long")).withColumn("text", text)
    whole = seen.where(~F.col(name)).withColumn("n_dropped", F.lit(0).cast("long"))
    return whole.select(*columns, "n_dropped").unionByName(cut.select(*columns, "n_dropped"))


def documents_without_repeats(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``without_repeated_lines`` but for the documents of which nothing but white space is left."""
    blank = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\r\n"))) == 0
    out = without_repeated_lines(docs, percent)
    return out.where((F.col("n_dropped") == 0) | ~blank("text")).select(*[c for c in docs.columns if c in out.columns])
