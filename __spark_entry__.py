"""Queries for the driver, and the SQL they are checked against."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from nearfield.functions.display import hits_json  # noqa: E402
from nearfield.functions.records import FIELDS, SEPARATOR, bad_messages, encode_hits, good_hits, message_of, parse_hits  # noqa: E402
from nearfield.operators import (  # noqa: E402
    distance_pairs,
    exact_pairs,
    latest,
    lsh_semi_join,
    projections,
    range_anti_join,
    range_pairs,
    range_semi_join,
    scaled_features,
    wide_semi_join,
    with_hashes,
)
from nearfield.operators.distance import HIT_WEIGHTS  # noqa: E402
from nearfield.plans import detect, lookups  # noqa: E402
from nearfield.schema import HIT_KEY, HITS  # noqa: E402
from nearfield.scratch import scratch_dir  # noqa: E402
from nearfield.sources.messages import text_messages  # noqa: E402
from nearfield.sources.tables import append_groups, append_hits, compact_hits, read_groups, read_hits  # noqa: E402
from nearfield.streaming import job  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from nearfield.llm import queries as llm  # noqa: E402
except ImportError:  # the corpus operators are an addition that can be left out
    llm = corpus_pipeline = None

RADIUS = 100
DISTANCE, BUCKET_LENGTH, TABLES = 0.05, 0.5, 4
#: Of the embeddings: the distance, and the share of near pairs to be found.
NEAR, RECALL = 1.1, 0.98
LOOKUP_GROUP, LOOKUP_ORDER, LOOKUP_SOURCE = 3, 2, "NATION_3"
RULE = detect.BATCH_RULE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items seen as hits: the supplier is the group, the line number the observation.

    How many hits a group has doesn't depend on the size of the data.
    """
    frequency = F.col("l_extendedprice") / 10
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("observationgroup"),
        F.col("l_linenumber").cast("int").alias("observationorder"),
        frequency.alias("frequency"),
        (F.col("l_quantity") * 2).alias("snr"),
        (F.col("l_discount") - F.col("l_tax")).alias("driftrate"),
        (frequency + F.col("l_tax") - F.col("l_discount")).alias("uncorrectedfrequency"),
    )


def of_order(spark: SparkSession, sf_dir: str, order: int) -> DataFrame:
    return hits(spark, sf_dir).where(F.col("observationorder") == order)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations of suppliers as the sources of groups."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    named = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return named.select(F.col("s_suppkey").cast("int").alias("observationgroup"), F.col("n_name").alias("source"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.group_results(hits(spark, sf_dir), RULE, metadata(spark, sf_dir))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results as a stored group table, which lookups scan."""
    path = scratch_dir(spark, "groups")
    append_groups(results(spark, sf_dir), path)
    return read_groups(spark, path)


def symbol():
    return F.concat(F.lit("S"), F.col("observationgroup").cast("string"))


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message that is cut, garbled or endless for each order whose key ends with 7, and its group."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 10 == 7)
    group = (F.col("o_custkey") % 100).cast("string")
    cut = F.concat_ws(SEPARATOR, F.lit("S"), group, F.lit("1"))
    garbled = F.concat_ws(SEPARATOR, F.lit("S"), group, *[F.lit("x")] * 5)
    endless = F.concat_ws(SEPARATOR, F.lit("S"), group, F.lit("1"), F.lit("1.5"), F.lit("Infinity"), F.lit("1"), F.lit("1"))
    kind = F.floor(F.col("o_orderkey") / 10) % 3
    value = F.when(kind == 0, cut).when(kind == 1, garbled).otherwise(endless)
    return orders.select(F.lit("S").alias("key"), value.alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as messages, and the bad ones."""
    return encode_hits(hits(spark, sf_dir), symbol()).unionByName(bad_values(spark, sf_dir))


def messages_by_group(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """The messages in ranges of groups. The ends of ranges are sampled in a pass of its own, so hits are dealt
    first and encoded then."""
    bad = bad_values(spark, sf_dir).select("value", F.split("value", SEPARATOR)[1].try_cast("int").alias("observationgroup"))
    sent = hits(spark, sf_dir).withColumn("value", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)
    dealt = sent.repartitionByRange(files, "observationgroup", F.xxhash64(*sent.columns))
    return dealt.select(F.coalesce("value", message_of(symbol())).alias("value"))


def early_and_late(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages without those whose third field, the order, is 2, and those. Fields that are null leave no
    place in a message, so it has no order there without a group."""
    late = F.coalesce((F.col("observationorder") == 2) & F.col("observationgroup").isNotNull(), F.lit(False))
    first, second = (encode_hits(hits(spark, sf_dir).where(test), symbol()) for test in (~late, late))
    return [part.select("value") for part in (first.unionByName(bad_values(spark, sf_dir)), second)]


def events_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return events.select("event_id", "ts", "value")


def pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("observationgroup_left").alias("observationgroup"),
        F.col("frequency_left").alias("frequency_1"),
        F.col("snr_left").alias("snr_1"),
        F.col("driftrate_left").alias("driftrate_1"),
        F.col("frequency_right").alias("frequency_3"),
        F.col("snr_right").alias("snr_3"),
        F.col("driftrate_right").alias("driftrate_3"),
    )


# ---- queries


def detect_anomalies(spark, sf_dir):
    return detect.detect_anomalies(hits(spark, sf_dir), RULE)


def detect_two_radii(spark, sf_dir):
    rule = detect.Rule(r_on=RADIUS, r_off=RADIUS / 2, abs_drift=True)
    return detect.detect_anomalies(hits(spark, sf_dir), rule)


def range_semi_numeric(spark, sf_dir):
    left, right = of_order(spark, sf_dir, 1), of_order(spark, sf_dir, 3)
    return range_semi_join(left, right, "frequency", RADIUS, by=["observationgroup"])


def range_anti_numeric(spark, sf_dir):
    left, right = of_order(spark, sf_dir, 1), of_order(spark, sf_dir, 2)
    return range_anti_join(left, right, "frequency", RADIUS, by=["observationgroup"])


def range_semi_fraction(spark, sf_dir):
    found = range_semi_join(events_of(spark, sf_dir, "error"), events_of(spark, sf_dir, "purchase"), "value", 0.01)
    return found.select("event_id", "value")


def range_semi_time(spark, sf_dir):
    found = range_semi_join(events_of(spark, sf_dir, "error"), events_of(spark, sf_dir, "click"), "ts", "10 minutes")
    return found.select("event_id", "value")


def range_anti_time(spark, sf_dir):
    errors, clicks = events_of(spark, sf_dir, "error"), events_of(spark, sf_dir, "click")
    return range_anti_join(errors, clicks, "ts", "interval 10 minutes").select("event_id", "value")


def totals(spark, sf_dir, status: str):
    """Orders of a status as points on a line that reaches far beyond the precision of small radii."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    factor = F.pow(F.lit(10.0), (F.col("o_orderkey") % 5 * 3).cast("double"))
    return orders.select("o_orderkey", (F.floor("o_totalprice") * factor).alias("value"))


def range_semi_large(spark, sf_dir):
    return range_semi_join(totals(spark, sf_dir, "O"), totals(spark, sf_dir, "F"), "value", 50)


def range_anti_large(spark, sf_dir):
    return range_anti_join(totals(spark, sf_dir, "O"), totals(spark, sf_dir, "F"), "value", 50)


def range_pairs_large(spark, sf_dir):
    pairs = range_pairs(totals(spark, sf_dir, "P"), totals(spark, sf_dir, "F"), "value", 50)
    return pairs.select("o_orderkey_left", "o_orderkey_right")


def range_pairs_query(spark, sf_dir):
    left, right = of_order(spark, sf_dir, 1), of_order(spark, sf_dir, 3)
    return pair_columns(range_pairs(left, right, "frequency", RADIUS, by=["observationgroup"], closed="left"))


def distance_pairs_exact(spark, sf_dir):
    left, right = of_order(spark, sf_dir, 1), of_order(spark, sf_dir, 3)
    return pair_columns(distance_pairs(left, right, HIT_WEIGHTS, DISTANCE, by=["observationgroup"]))


def distance_pairs_arrays(spark, sf_dir):
    def points(order):
        scaled = scaled_features(of_order(spark, sf_dir, order), HIT_WEIGHTS)
        return scaled.withColumn("point", F.array(*["n" + name for name in HIT_WEIGHTS]))

    return pair_columns(distance_pairs(points(1), points(3), "point", DISTANCE, by=["observationgroup"]))


def distance_semi_lsh(spark, sf_dir):
    left, right = of_order(spark, sf_dir, 1), of_order(spark, sf_dir, 3)
    return lsh_semi_join(left, right, HIT_WEIGHTS, DISTANCE, BUCKET_LENGTH, TABLES, by=["observationgroup"])


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


def distance_semi_lsh_arrays(spark, sf_dir):
    """All embeddings that have another one near, by hashing their 64 dimensions; those for which hashing finds
    none are compared with all."""
    points = embeddings(spark, sf_dir)
    found = wide_semi_join(points, points, "embedding", NEAR, RECALL, other="vec_id", exact=True)
    return found.select("vec_id", "label")


def distance_pairs_embeddings(spark, sf_dir):
    """All embeddings near one whose number is divisible by 20, exactly, with their distances."""
    points = embeddings(spark, sf_dir)
    pairs = exact_pairs(points.where("vec_id % 20 = 0"), points, "embedding", NEAR, "vec_id")
    return pairs.withColumn("distance", F.round("distance", 9))


def lsh_hashes(spark, sf_dir):
    hashed = with_hashes(of_order(spark, sf_dir, 1), HIT_WEIGHTS, BUCKET_LENGTH, TABLES)
    return hashed.select(*[f.name for f in HITS.fields], *[F.col("hashes")[t].alias(f"bucket_{t}") for t in range(TABLES)])


def encode_hits_query(spark, sf_dir):
    sent = encode_hits(hits(spark, sf_dir), symbol())
    tokens = F.split("value", SEPARATOR)
    fields = {f.name: tokens[i].cast(f.dataType) for i, f in enumerate(HITS.fields, start=1)}
    return sent.select("key", F.size(tokens).alias("n_fields"), *[c.alias(name) for name, c in fields.items()])


def parse_hits_query(spark, sf_dir):
    return good_hits(parse_hits(messages(spark, sf_dir)))


def quarantined_messages(spark, sf_dir):
    rejected = bad_messages(parse_hits(messages(spark, sf_dir)))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


def rewritten(spark, sf_dir):
    """The hits of ON observations again, with another payload."""
    second = hits(spark, sf_dir).where(detect.is_on(F.col("observationorder")))
    return second.withColumn("uncorrectedfrequency", F.col("uncorrectedfrequency") + 1)


def upsert_latest(spark, sf_dir):
    first, second = hits(spark, sf_dir), rewritten(spark, sf_dir)
    written = first.withColumn("version", F.lit(1)).unionByName(second.withColumn("version", F.lit(2)))
    return latest(written, HIT_KEY, ["version"])


def twice_written(spark, sf_dir):
    path = scratch_dir(spark, "hits")
    append_hits(rewritten(spark, sf_dir), path, version=2)
    append_hits(hits(spark, sf_dir), path, version=1)
    return path


def stored_hits(spark, sf_dir):
    """Written twice, the later version first, and read back."""
    return read_hits(spark, twice_written(spark, sf_dir))


def compacted_hits(spark, sf_dir):
    path = twice_written(spark, sf_dir)
    compact_hits(spark, path)
    return read_hits(spark, path)


def stored_groups(spark, sf_dir):
    """Results that a later rule replaces for the groups of odd numbers."""
    path = scratch_dir(spark, "groups")
    odd = results(spark, sf_dir).where("observationgroup % 2 = 1")
    append_groups(odd.withColumn("grouphit", F.lit(-1)), path)
    append_groups(results(spark, sf_dir).where("observationgroup % 2 = 0"), path)
    append_groups(odd, path)
    return read_groups(spark, path)


def hits_of_observation(spark, sf_dir):
    return lookups.ranked_hits(hits(spark, sf_dir), LOOKUP_GROUP, LOOKUP_ORDER)


def stored_observation(spark, sf_dir):
    """The same from the stored table, of which only the group's folder is read."""
    found = read_hits(spark, twice_written(spark, sf_dir), [LOOKUP_GROUP])
    return lookups.hits_of_observation(found, LOOKUP_GROUP, LOOKUP_ORDER)


def hits_json_query(spark, sf_dir):
    shown = (
        "`observation group` int, `observation number` int, frequency double, SNR double, driftrate double, "
        "`uncorrected frequency` double"
    )
    back = hits_json(hits(spark, sf_dir)).select(F.from_json("json", shown).alias("hit"))
    return back.select(
        F.col("hit.observation group").alias("observationgroup"),
        F.col("hit.observation number").alias("observationorder"),
        F.col("hit.frequency").alias("frequency"),
        F.col("hit.SNR").alias("snr"),
        F.col("hit.driftrate").alias("driftrate"),
        F.col("hit.uncorrected frequency").alias("uncorrectedfrequency"),
    )


def page_observation(spark, sf_dir):
    return lookups.answer("2", hits(spark, sf_dir), groups(spark, sf_dir), LOOKUP_GROUP, LOOKUP_ORDER)


def page_group(spark, sf_dir):
    return lookups.answer(lookups.GROUP_QUERY, hits(spark, sf_dir), groups(spark, sf_dir), LOOKUP_GROUP)


def group_lookup(spark, sf_dir):
    return lookups.group_lookup(groups(spark, sf_dir), LOOKUP_GROUP)


def groups_by_source(spark, sf_dir):
    return lookups.groups_by_source(groups(spark, sf_dir), LOOKUP_SOURCE)


def anomalous_groups(spark, sf_dir):
    return lookups.anomalous_groups(groups(spark, sf_dir))


def anomaly_feed(spark, sf_dir):
    return lookups.anomaly_feed(groups(spark, sf_dir))


def observation_counts(spark, sf_dir):
    return detect.observation_counts(hits(spark, sf_dir), RULE)


def observation_roles(spark, sf_dir):
    role = F.when(detect.is_on(F.col("observationorder")), "ON").otherwise("OFF").alias("role")
    return hits(spark, sf_dir).groupBy("observationorder", role).agg(F.count(F.lit(1)).alias("n_hits"))


def detection_funnel(spark, sf_dir):
    return detect.detection_funnel(hits(spark, sf_dir), RULE)


def batch_groups(spark, sf_dir):
    return detect.groups_in(hits(spark, sf_dir))


def first_group(spark, sf_dir):
    return detect.first_group(hits(spark, sf_dir))


def stream_detect(spark, sf_dir):
    """The messages sorted into files by group, played as a stream of four batches or so.

    There are as many files as shuffle partitions; a large group lies in several.
    """
    root = scratch_dir(spark, "stream")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages_by_group(spark, sf_dir, files).write.text(f"{root}/in")
    arriving = text_messages(spark, f"{root}/in", maxFilesPerTrigger=max(1, files // 4))
    job.run_available(arriving, f"{root}/tables", RULE, metadata(spark, sf_dir))
    return job.read_results(spark, f"{root}/tables")


def anomaly_changes(spark, sf_dir):
    """The messages as a stream, a part of them late and the tables compacted in between; the changes are
    followed as they come, and the groups are those that the feed leaves."""
    root = scratch_dir(spark, "changes")
    for k, part in enumerate(early_and_late(spark, sf_dir)):
        part.write.text(f"{root}/in/{k}")
        arriving = text_messages(spark, f"{root}/in/*")
        job.run_available(arriving, f"{root}/tables", RULE, metadata(spark, sf_dir))
        job.compact(spark, f"{root}/tables", RULE)
        job.write_feed(spark, f"{root}/tables", available_now=True).awaitTermination()
    return job.replayed(job.read_feed(spark, f"{root}/tables"))


def entry(spark: SparkSession) -> DataFrame:
    """Detection over all groups of the smallest data set."""
    return detect_anomalies(spark, "/root/testdata/sf0.001")


def on_workers(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this folder on the path of the session's Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings = spark.sparkContext.environment
        path = settings.get("PYTHONPATH", "").split(os.pathsep)
        if HERE not in path:
            settings["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, path)])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}
    corpus = {name: on_workers(query) for name, query in corpus.items()}
    return corpus | {
        "detect_anomalies": detect_anomalies,
        "detect_two_radii": detect_two_radii,
        "range_semi_numeric": range_semi_numeric,
        "range_anti_numeric": range_anti_numeric,
        "range_semi_fraction": range_semi_fraction,
        "range_semi_time": range_semi_time,
        "range_anti_time": range_anti_time,
        "range_pairs": range_pairs_query,
        "range_semi_large": range_semi_large,
        "range_anti_large": range_anti_large,
        "range_pairs_large": range_pairs_large,
        "distance_pairs_exact": distance_pairs_exact,
        "distance_pairs_arrays": distance_pairs_arrays,
        "distance_semi_lsh": distance_semi_lsh,
        "distance_semi_lsh_arrays": distance_semi_lsh_arrays,
        "distance_pairs_embeddings": distance_pairs_embeddings,
        "lsh_hashes": lsh_hashes,
        "encode_hits": encode_hits_query,
        "parse_hits": parse_hits_query,
        "quarantined_messages": quarantined_messages,
        "upsert_latest": upsert_latest,
        "stored_hits": stored_hits,
        "compacted_hits": compacted_hits,
        "stored_groups": stored_groups,
        "stored_observation": stored_observation,
        "hits_of_observation": hits_of_observation,
        "hits_json": hits_json_query,
        "page_observation": page_observation,
        "page_group": page_group,
        "group_lookup": group_lookup,
        "groups_by_source": groups_by_source,
        "anomalous_groups": anomalous_groups,
        "anomaly_feed": anomaly_feed,
        "observation_counts": observation_counts,
        "observation_roles": observation_roles,
        "detection_funnel": detection_funnel,
        "group_results": results,
        "batch_groups": batch_groups,
        "first_group": first_group,
        "stream_detect": stream_detect,
        "anomaly_changes": anomaly_changes,
    }


# ---- the same in SQL

HITS_SQL = """
hits_v AS (
  SELECT CAST(l_suppkey AS INT) AS observationgroup, CAST(l_linenumber AS INT) AS observationorder,
         l_extendedprice / 10 AS frequency, l_quantity * 2 AS snr,
         l_discount - l_tax AS driftrate,
         l_extendedprice / 10 + l_tax - l_discount AS uncorrectedfrequency
  FROM lineitem
)"""


def _near(order: int, radius: float, snr: int, drift: str = "driftrate") -> str:
    """A hit of the given observation above its thresholds and within the radius of hit ``a``."""
    return f"""EXISTS (
    SELECT 1 FROM hits_v b WHERE b.observationgroup = a.observationgroup AND b.observationorder = {order}
      AND b.snr > {snr} AND {drift.replace("driftrate", "b.driftrate")} > 0.0001
      AND b.frequency > a.frequency - {radius} AND b.frequency <= a.frequency + {radius})"""


def _detect_sql(r_on: float, r_off: float, drift: str = "driftrate") -> str:
    on = " AND ".join(_near(o, r_on, 25, drift) for o in (3, 5))
    off = " AND ".join("NOT " + _near(o, r_off, 20, drift) for o in (2, 4, 6))
    return f"""SELECT DISTINCT a.* FROM hits_v a
  WHERE a.observationorder = 1 AND a.snr > 25 AND {drift.replace("driftrate", "a.driftrate")} > 0.0001
    AND {on} AND {off}"""


_FUNNEL = {"on_3": (3, 25), "on_5": (5, 25), "off_2": (2, 20), "off_4": (4, 20), "off_6": (6, 20)}


def _funnel_sql() -> str:
    tests = ", ".join(f"{_near(o, RADIUS, snr)} AS near_{o}" for o, snr in _FUNNEL.values())
    selects, alive = [], []
    for stage, (order, _) in _FUNNEL.items():
        alive.append(f"near_{order}" if stage.startswith("on") else f"NOT near_{order}")
        selects.append(
            f"SELECT g.observationgroup, '{stage}' AS stage, count(f.frequency) AS n_hits "
            f"FROM (SELECT DISTINCT observationgroup FROM hits_v) g "
            f"LEFT JOIN flags f ON f.observationgroup = g.observationgroup AND {' AND '.join(alive)} "
            f"GROUP BY g.observationgroup"
        )
    return f"""WITH {HITS_SQL}, flags AS (
  SELECT a.*, {tests} FROM (SELECT DISTINCT * FROM hits_v
    WHERE observationorder = 1 AND snr > 25 AND driftrate > 0.0001) a
) {" UNION ALL ".join(selects)}"""


_GROUP_COLUMNS = (
    "observationgroup, grouphit, source, mjd, ra, dec, "
    "filename1, filename2, filename3, filename4, filename5, filename6"
)
_GROUPS_SQL = f"""WITH {HITS_SQL}, found AS (
  {_detect_sql(RADIUS, RADIUS)}
), groups_v AS (
  SELECT g.observationgroup, CAST(count(f.frequency) AS INT) AS grouphit, any_value(m.n_name) AS source,
         CAST(NULL AS DOUBLE) AS mjd, CAST(NULL AS VARCHAR) AS ra, CAST(NULL AS VARCHAR) AS dec,
         CAST(NULL AS VARCHAR) AS filename1, CAST(NULL AS VARCHAR) AS filename2,
         CAST(NULL AS VARCHAR) AS filename3, CAST(NULL AS VARCHAR) AS filename4,
         CAST(NULL AS VARCHAR) AS filename5, CAST(NULL AS VARCHAR) AS filename6
  FROM (SELECT DISTINCT observationgroup FROM hits_v) g
  LEFT JOIN found f ON f.observationgroup = g.observationgroup
  LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) m
    ON m.s_suppkey = g.observationgroup
  GROUP BY g.observationgroup
) """
_PAIR_SELECT = """SELECT a.observationgroup, a.frequency AS frequency_1, a.snr AS snr_1, a.driftrate AS driftrate_1,
       b.frequency AS frequency_3, b.snr AS snr_3, b.driftrate AS driftrate_3
FROM hits_v a JOIN hits_v b ON a.observationgroup = b.observationgroup
 AND a.observationorder = 1 AND b.observationorder = 3"""


def _numeric(order: int) -> str:
    return f"""EXISTS (SELECT 1 FROM hits_v b WHERE b.observationgroup = a.observationgroup
  AND b.observationorder = {order} AND b.frequency > a.frequency - {RADIUS} AND b.frequency <= a.frequency + {RADIUS})"""


_NEWEST_SQL = f"""newest AS (
  SELECT * EXCLUDE version FROM (
    SELECT *, 1 AS version FROM hits_v UNION ALL
    SELECT observationgroup, observationorder, frequency, snr, driftrate, uncorrectedfrequency + 1, 2
    FROM hits_v WHERE observationorder % 2 = 1)
  QUALIFY row_number() OVER (PARTITION BY {", ".join(HIT_KEY)} ORDER BY version DESC, uncorrectedfrequency DESC) = 1)"""

_LARGE_SQL = """WITH totals AS (SELECT o_orderkey, o_orderstatus,
  floor(o_totalprice) * pow(10::DOUBLE, (o_orderkey % 5 * 3)::DOUBLE) AS value FROM orders)"""
_LARGE_NEAR = "b.o_orderstatus = 'F' AND b.value > a.value - 50::DOUBLE AND b.value <= a.value + 50::DOUBLE"


def _bucket_sql(alias: str, vector: list[float], names: list[str], length: float) -> str:
    terms = " + ".join(f"({alias}.{n} * '{w!r}'::DOUBLE) * '{v!r}'::DOUBLE" for v, (n, w) in zip(vector, HIT_WEIGHTS.items()))
    return f"CAST(floor(({terms}) / '{length!r}'::DOUBLE) AS BIGINT)"


def _lsh_sql() -> str:
    vectors, names = projections(len(HIT_WEIGHTS), TABLES), list(HIT_WEIGHTS)
    same = " OR ".join(
        f"{_bucket_sql('a', v, names, BUCKET_LENGTH)} = {_bucket_sql('b', v, names, BUCKET_LENGTH)}" for v in vectors
    )
    squares = " + ".join(
        f"(a.{n} * '{w!r}'::DOUBLE - b.{n} * '{w!r}'::DOUBLE) * (a.{n} * '{w!r}'::DOUBLE - b.{n} * '{w!r}'::DOUBLE)"
        for n, w in HIT_WEIGHTS.items()
    )
    return f"""SELECT DISTINCT a.* FROM hits_v a WHERE a.observationorder = 1 AND EXISTS (
        SELECT 1 FROM hits_v b WHERE b.observationgroup = a.observationgroup AND b.observationorder = 3
        AND sqrt({squares}) < '{DISTANCE!r}'::DOUBLE AND ({same}))"""


def _near_sql(queries: str) -> str:
    return f"""WITH near AS (
  SELECT a.vec_id AS left_id, b.vec_id AS right_id, a.label,
         sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: pow(p[1]::DOUBLE - p[2]::DOUBLE, 2)))) AS distance
  FROM embeddings a JOIN embeddings b ON {queries}a.vec_id <> b.vec_id)"""


_NEAR_SQL = _near_sql("a.vec_id % 20 = 0 AND ")


_CLICK_NEAR = """EXISTS (SELECT 1 FROM events b WHERE b.event_type = 'click'
  AND b.ts > a.ts - INTERVAL 10 MINUTE AND b.ts <= a.ts + INTERVAL 10 MINUTE)"""


def oracle_sql() -> dict[str, str]:
    hits_v = f"WITH {HITS_SQL} "
    one_observation = f"WHERE observationgroup = {LOOKUP_GROUP} AND observationorder = {LOOKUP_ORDER}"
    groups_all = f"{_GROUPS_SQL} SELECT {_GROUP_COLUMNS} FROM groups_v"
    corpus = dict(llm.ORACLE_SQL) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus | {
        "detect_anomalies": hits_v + _detect_sql(RADIUS, RADIUS),
        "detect_two_radii": hits_v + _detect_sql(RADIUS, RADIUS / 2, "abs(driftrate)"),
        "range_semi_numeric": f"{hits_v} SELECT DISTINCT a.* FROM hits_v a WHERE a.observationorder = 1 AND {_numeric(3)}",
        "range_anti_numeric": f"{hits_v} SELECT DISTINCT a.* FROM hits_v a WHERE a.observationorder = 1 AND NOT {_numeric(2)}",
        "range_semi_fraction": """SELECT DISTINCT a.event_id, a.value FROM events a
            WHERE a.event_type = 'error' AND EXISTS (SELECT 1 FROM events b WHERE b.event_type = 'purchase'
              AND b.value > a.value - CAST(0.01 AS DOUBLE) AND b.value <= a.value + CAST(0.01 AS DOUBLE))""",
        "range_semi_time": f"SELECT a.event_id, a.value FROM events a WHERE a.event_type = 'error' AND {_CLICK_NEAR}",
        "range_anti_time": f"SELECT a.event_id, a.value FROM events a WHERE a.event_type = 'error' AND NOT {_CLICK_NEAR}",
        "range_pairs": f"""{hits_v} {_PAIR_SELECT}
            WHERE a.frequency > b.frequency - {RADIUS} AND a.frequency <= b.frequency + {RADIUS}""",
        "range_semi_large": f"""{_LARGE_SQL} SELECT o_orderkey, value FROM totals a WHERE o_orderstatus = 'O'
            AND EXISTS (SELECT 1 FROM totals b WHERE {_LARGE_NEAR})""",
        "range_anti_large": f"""{_LARGE_SQL} SELECT o_orderkey, value FROM totals a WHERE o_orderstatus = 'O'
            AND NOT EXISTS (SELECT 1 FROM totals b WHERE {_LARGE_NEAR})""",
        "range_pairs_large": f"""{_LARGE_SQL} SELECT a.o_orderkey AS o_orderkey_left, b.o_orderkey AS o_orderkey_right
            FROM totals a JOIN totals b ON {_LARGE_NEAR} WHERE a.o_orderstatus = 'P'""",
        "distance_semi_lsh": f"{hits_v} {_lsh_sql()}",
        # all pairs, without buckets: equal only if hashing misses none
        "distance_semi_lsh_arrays": f"{_near_sql('')} SELECT DISTINCT left_id AS vec_id, label FROM near WHERE distance < {NEAR}::DOUBLE",
        "distance_pairs_embeddings": f"""{_NEAR_SQL} SELECT left_id, right_id, round(distance, 9) AS distance
            FROM near WHERE distance <= {NEAR}::DOUBLE""",
        "lsh_hashes": f"""{hits_v} SELECT *, {", ".join(
            f"{_bucket_sql('hits_v', v, list(HIT_WEIGHTS), BUCKET_LENGTH)} AS bucket_{t}"
            for t, v in enumerate(projections(len(HIT_WEIGHTS), TABLES)))} FROM hits_v WHERE observationorder = 1""",
        "distance_pairs_exact": f"""{hits_v} {_PAIR_SELECT}
            WHERE (a.frequency - b.frequency) * (a.frequency - b.frequency) * CAST(1e-8 AS DOUBLE)
                + (a.snr - b.snr) * (a.snr - b.snr) * CAST(1e-4 AS DOUBLE)
                + (a.driftrate - b.driftrate) * (a.driftrate - b.driftrate) <= CAST({DISTANCE * DISTANCE!r} AS DOUBLE)""",
        "distance_pairs_arrays": f"""{hits_v} {_PAIR_SELECT}
            WHERE list_distance([a.frequency * 1e-4, a.snr * 1e-2, a.driftrate],
                                [b.frequency * 1e-4, b.snr * 1e-2, b.driftrate]) <= {DISTANCE}""",
        "encode_hits": f"""{hits_v} SELECT 'S' || observationgroup AS key, CAST({FIELDS} AS INT) AS n_fields, * FROM hits_v""",
        "parse_hits": f"{hits_v} SELECT * FROM hits_v",
        "quarantined_messages": """SELECT CASE (o_orderkey // 10) % 3 WHEN 0 THEN 'too few fields' WHEN 1 THEN
              'not a number' ELSE 'not finite' END AS reason, count(*) AS n_messages
            FROM orders WHERE o_orderkey % 10 = 7 GROUP BY 1""",
        "upsert_latest": f"{hits_v}, {_NEWEST_SQL} SELECT * FROM newest",
        "stored_hits": f"{hits_v}, {_NEWEST_SQL} SELECT * FROM newest",
        "compacted_hits": f"{hits_v}, {_NEWEST_SQL} SELECT * FROM newest",
        "stored_groups": groups_all,
        "stored_observation": f"{hits_v}, {_NEWEST_SQL} SELECT * FROM newest {one_observation}",
        "hits_of_observation": f"""{hits_v} SELECT *, rank() OVER (ORDER BY snr DESC, driftrate DESC) AS place
            FROM hits_v {one_observation}""",
        "hits_json": f"{hits_v} SELECT * FROM hits_v",
        "page_observation": f"""{hits_v} SELECT observationgroup, observationorder, frequency, snr AS "SNR",
            driftrate, uncorrectedfrequency FROM hits_v {one_observation}""",
        "page_group": f"{groups_all} WHERE observationgroup = {LOOKUP_GROUP}",
        "group_lookup": f"{groups_all} WHERE observationgroup = {LOOKUP_GROUP}",
        "groups_by_source": f"{groups_all} WHERE source = '{LOOKUP_SOURCE}'",
        "anomalous_groups": f"{_GROUPS_SQL} SELECT observationgroup, grouphit, source, mjd, ra, dec FROM groups_v WHERE grouphit > 0",
        "anomaly_feed": f"{groups_all} WHERE grouphit > 0",
        "observation_counts": f"""{hits_v} SELECT observationgroup, observationorder, count(*) AS n_hits FROM hits_v
            WHERE driftrate > 0.0001 AND snr > CASE WHEN observationorder % 2 = 1 THEN 25 ELSE 20 END
              AND observationorder <= 6 GROUP BY 1, 2""",
        "observation_roles": f"""{hits_v} SELECT observationorder,
            CASE WHEN observationorder % 2 = 1 THEN 'ON' ELSE 'OFF' END AS role, count(*) AS n_hits
            FROM hits_v GROUP BY 1, 2""",
        "detection_funnel": _funnel_sql(),
        "group_results": groups_all,
        "batch_groups": f"{hits_v} SELECT DISTINCT observationgroup FROM hits_v",
        "first_group": f"""{hits_v} SELECT min(observationgroup) AS first_group,
            count(DISTINCT observationgroup) AS n_groups FROM hits_v""",
        "stream_detect": groups_all,
        "anomaly_changes": f"{groups_all} WHERE grouphit > 0",
    }
