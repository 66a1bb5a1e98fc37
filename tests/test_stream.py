import random
import re
import time

import pytest
from pyspark.sql import functions as F

from nearfield.functions.records import encode_hits
from nearfield.plans.detect import Rule, group_results
from nearfield.schema import HIT_KEY, HITS
from nearfield.sources import log
from nearfield.sources.messages import message_values, text_messages
from nearfield.streaming import job

RULE = Rule(r_on=0.7, r_off=0.7, snr_off=70)


def random_rows(groups, n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        f = rng.uniform(0, 20)
        out.append((rng.choice(groups), rng.randint(1, 6), f, rng.uniform(0, 100), rng.uniform(0, 1), f))
    return out


def batch_of(spark, rows):
    return encode_hits(spark.createDataFrame(rows, HITS), F.lit("s")).select("value")


def counts(df):
    return {r["observationgroup"]: r["grouphit"] for r in df.collect()}


def reported(spark, root, batch_id):
    rows = job.read_reports(spark, root).where(F.col("batch_id") == batch_id)
    return sorted(r["observationgroup"] for r in rows.collect())


def play(spark, root, batches, **options):
    for i, rows in enumerate(batches):
        job.process_batch(batch_of(spark, rows), i, root, RULE, **options)
    return [reported(spark, root, i) for i in range(len(batches))]


ORDER = [[1, 1, 1], [1, 2], [2, 3, 4], [1, 4]]


def batches_in_order():
    rng = random.Random(4)
    out = []
    for i, groups in enumerate(ORDER):
        rows = random_rows(groups, 300, seed=i)
        rows += [(g, 1, rng.uniform(0, 20), 90.0, 0.5, 0.0) for g in groups]
        out.append(rows)
    return out


def test_groups_close_when_a_higher_one_appears(spark, tmp_path):
    root, batches = str(tmp_path / "t"), batches_in_order()
    assert play(spark, root, batches) == [[], [1], [2, 3], [1]]
    job.flush(spark, root, RULE)
    assert reported(spark, root, 3) == [1, 4]
    everything = spark.createDataFrame([r for b in batches for r in b], HITS)
    results = counts(job.read_results(spark, root))
    assert results == counts(group_results(everything, RULE)) and sum(results.values()) > 0

    # The last batch run again, as after a failure, changes nothing.
    before = sorted(map(tuple, job.read_stored_hits(spark, root).collect()))
    job.process_batch(batch_of(spark, batches[3]), 3, root, RULE)
    assert sorted(map(tuple, job.read_stored_hits(spark, root).collect())) == before
    assert reported(spark, root, 3) == [1, 4]
    assert counts(job.read_results(spark, root)) == results


def test_a_flush_replaces_the_report_of_the_one_before(spark, tmp_path):
    root = str(tmp_path / "t")
    play(spark, root, [[(1, o, 5.0, 90.0, 0.5, 5.0) for o in (1, 3, 5)]])
    for snr, found in ((25, 1), (1e6, 0), (25, 1)):
        job.flush(spark, root, Rule(r_on=0.7, r_off=0.7, snr_on=snr))
        assert counts(job.read_results(spark, root)) == {1: found}


def test_compaction_changes_nothing_but_the_files(spark, tmp_path):
    root, batches = str(tmp_path / "t"), batches_in_order()
    play(spark, root, batches[:3])
    job.process_batch(spark.createDataFrame([("nonsense",)], "value string"), 3, root, RULE)
    job.flush(spark, root, RULE)
    read = lambda: [sorted(map(tuple, f(spark, root).collect()), key=repr) for f in (job.read_stored_hits, job.read_results, job.read_rejects)]
    before, tables = read(), job.Tables(root)
    slow = job.read_stored_hits(spark, root), job.read_results(spark, root)  # read after the compaction
    job.compact(spark, root, RULE)
    assert read() == before
    assert [sorted(map(tuple, df.collect()), key=repr) for df in slow] == before[:2]
    state = tables.states(RULE)[0]
    for path in (tables.of("hits"), tables.anchors(RULE), state):
        buckets = [about["bucket"] for about in log.snapshot(spark, path).parts.values()]
        assert len(buckets) == len(set(buckets))
    assert not log.rewrite(spark, state, job._state_schema(spark, RULE)[0], lambda rows: rows, "bucket")
    job.process_batch(batch_of(spark, batches[3]), 4, root, RULE, compact_every=5)
    job.compact(spark, root, RULE, unused_for=0)
    assert len(list((tmp_path / "t/groups/data").glob("write=*"))) == 1
    job.flush(spark, root, RULE)
    everything = spark.createDataFrame([r for b in batches for r in b], HITS)
    assert counts(job.read_results(spark, root)) == counts(group_results(everything, RULE))


class Cut(Exception):
    pass


def test_a_batch_cut_off_anywhere_loses_nothing(spark, tmp_path, monkeypatch):
    """The third batch dies at each of its steps, before a write, between a write and its commit, and after a
    commit, and is run again each time; its last run gives what a first would have given."""
    root, batches = str(tmp_path / "t"), batches_in_order()
    play(spark, root, batches[:2])
    before, step = counts(job.read_results(spark, root)), {}

    def dying(call):
        def run(*args, **kwargs):
            step["n"] -= 1
            if not step["n"]:
                raise Cut
            return call(*args, **kwargs)

        return run

    messages = batch_of(spark, batches[2]).unionByName(spark.createDataFrame([("nonsense",)], "value string"))
    with monkeypatch.context() as patch:
        patch.setattr(log, "write", dying(log.write))
        patch.setattr(log, "_create", dying(log._create))
        died, tables = 0, ["rejects", "hits", "anchors", "state", "groups"]
        for step["n"] in [1, *[2, 3] * len(tables)]:
            try:
                job.process_batch(messages, 2, root, RULE)
            except Cut:
                died += 1
                assert counts(job.read_results(spark, root)).items() >= before.items()
    assert died >= 2 * len(tables)
    job.process_batch(messages, 2, root, RULE)
    job.process_batch(batch_of(spark, batches[3]), 3, root, RULE)
    job.flush(spark, root, RULE)
    everything = spark.createDataFrame([r for b in batches for r in b], HITS)
    assert counts(job.read_results(spark, root)) == counts(group_results(everything, RULE))
    assert job.read_stored_hits(spark, root).count() == everything.dropDuplicates(HIT_KEY).count()
    assert job.read_rejects(spark, root).count() == 1
    assert [r["hits"] for r in job.batch_counts(spark, root).orderBy("batch_id").collect()] == [len(b) for b in batches]


def test_state_gives_what_all_hits_give(spark, tmp_path):
    """Late hits and replaced keys, two radii, and a rule that the tables have no state of."""
    root, other = str(tmp_path / "t"), Rule(r_on=0.7, r_off=0.3, snr_off=60, abs_drift=True)
    rows = random_rows([1, 2, 3], 500, seed=9)
    again = [(*r[:5], r[5] + 1) for r in rows[:200]]
    parts = [rows[:250], again, rows[250:], [(1, 2, r[2], 95.0, 0.5, r[5]) for r in rows if r[:2] == (1, 1)][:8]]
    for i, part in enumerate(parts):
        job.process_batch(batch_of(spark, part), i, root, RULE if i < 2 else other)
    everything = spark.createDataFrame([r for p in parts for r in p], HITS)
    ids = everything.select("observationgroup").distinct()
    for rule in (other, RULE, Rule(on_orders=(1,), r_off=0.2), Rule(off_orders=())):
        got = counts(job._results(spark, job.Tables(root), ids, rule, None))
        assert got == counts(group_results(everything.dropDuplicates(HIT_KEY), rule))
    assert sum(counts(group_results(everything, other)).values()) > 0


def test_a_report_reads_its_groups_state_only(spark, tmp_path):
    root, rows = str(tmp_path / "t"), random_rows(range(1, 60), 900, seed=2)
    play(spark, root, [rows])
    one = spark.createDataFrame([(7,)], "observationgroup int")
    results = job._results(spark, job.Tables(root), one, RULE, None)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert f"{root}/hits/" not in plan
    files = {f.split("/t/")[1].split("/data/")[0] for f in results.inputFiles()}
    buckets = {re.search(r"bucket=(\d+)", f)[1] for f in results.inputFiles()}
    assert all(f.startswith(("anchors_", "state_")) for f in files) and len(buckets) == 1


def test_counts_of_a_batch(spark, tmp_path):
    root, batches = str(tmp_path / "t"), batches_in_order()
    bad = spark.createDataFrame([("nonsense",), (None,)], "value string")
    for i, rows in enumerate(batches):
        job.process_batch(batch_of(spark, rows).unionByName(bad.limit(i)), i, root, RULE)
    assert sorted(map(tuple, job.batch_counts(spark, root).collect())) == [
        (i, len(rows), min(i, 2), len(reported(spark, root, i))) for i, rows in enumerate(batches)
    ]


def anomalous(df):
    return sorted(map(tuple, df.where("grouphit > 0").collect()), key=repr)


def test_feed_follows_corrections(spark, tmp_path):
    """A group that is reported again is updated, one that falls to zero goes, and compaction tells nothing."""
    root = str(tmp_path / "t")
    seen = lambda g, snr=90.0, f=5.0: [(g, o, f, snr, 0.5, f) for o in (1, 3, 5)]
    batches = [seen(1), seen(2) + seen(1, f=9.0), [(1, 2, 5.0, 90.0, 0.5, 5.0), (3, 1, 1.0, 1.0, 0.5, 1.0)], seen(2)]
    batches += [[(1, 4, 9.0, 90.0, 0.5, 9.0)], seen(1, f=15.0)]
    for i, rows in enumerate(batches):
        job.process_batch(batch_of(spark, rows), i, root, RULE)
        job.write_feed(spark, root, available_now=True).awaitTermination()
        if i == 3:
            job.compact(spark, root, RULE)
    job.flush(spark, root, RULE)
    job.compact(spark, root, RULE)
    job.write_feed(spark, root, available_now=True).awaitTermination()
    feed = job.read_feed(spark, root)
    told = [(r["change"], r["observationgroup"], r["grouphit"]) for r in feed.orderBy("version", "observationgroup").collect()]
    assert told == [("insert", 1, 2), ("update", 1, 1), ("insert", 2, 1), ("delete", 1, 0), ("insert", 1, 1)]
    assert anomalous(job.replayed(feed)) == anomalous(job.read_results(spark, root))
    whole, some = job.changes(spark, root), job.changes(spark, root, after=1)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, feed.collect()), key=repr)
    assert sorted(map(tuple, some.collect()), key=repr) == sorted(map(tuple, feed.where("version > 1").collect()), key=repr)


def test_timed_trigger(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    query = job.start(text_messages(spark, str(source)), root, RULE, every="1 second", compact_every=2)
    try:
        for i, rows in enumerate(batches_in_order()[:2]):
            draft = tmp_path / f"{i}.txt"
            draft.write_text("\n".join(r["value"] for r in batch_of(spark, rows).collect()) + "\n")
            draft.rename(source / f"{i}.txt")
            until = time.time() + 60
            while job.batch_counts(spark, root).count() <= i and time.time() < until and query.isActive:
                time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.exception() is None
    assert [tuple(r)[:2] for r in job.batch_counts(spark, root).orderBy("batch_id").collect()] == [(0, 303), (1, 302)]
    assert counts(job.read_results(spark, root)).keys() == {1}


def test_a_message_of_any_size_stops_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    hit = (1, 1, 5.0, 90.0, 0.5, 5.0)
    rows = [(1, o, f, 90.0, 0.5, f) for o in (1, 3, 5) for f in (5.0, 1e300)]
    job.process_batch(batch_of(spark, rows), 0, root, RULE)
    endless = spark.createDataFrame([("s;1;1;NaN;90;0.5;1",), ("s;1;1;1.0;Infinity;0.5;1",), ("s;1;1;1.0;9;-Infinity;1",)], "value string")
    job.process_batch(endless.unionByName(batch_of(spark, [(2, *hit[1:])])), 1, root, RULE)
    assert counts(job.read_results(spark, root)) == {1: 1}
    assert [r["reason"] for r in job.read_rejects(spark, root).collect()] == ["not finite"] * 3


def test_topics_have_offsets_of_their_own(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [("b", 0, 1, 6.0), ("a", 0, 9, 7.0), ("b", 0, 0, 8.0)]
    values = [(f"s;1;1;5.0;90.0;0.5;{u}", t, p, o) for t, p, o, u in rows]
    job.process_batch(spark.createDataFrame(values, "value string, topic string, partition int, offset long"), 0, root, RULE)
    assert [r["uncorrectedfrequency"] for r in job.read_stored_hits(spark, root).collect()] == [6.0]


def test_closed_groups_are_read_by_their_buckets(spark, tmp_path):
    """Five thousand groups: only the folders of the closed groups' buckets are listed in the scan."""
    root = str(tmp_path / "t")
    rows = [(g, o, 1.0, 90.0, 0.5, 1.0) for g in range(5000) for o in (1, 3)]
    job.process_batch(batch_of(spark, rows), 0, root, RULE)
    assert len(log.snapshot(spark, f"{root}/hits").parts) == 64
    few = job.read_stored_hits(spark, root, spark.createDataFrame([(7,), (4321,)], "observationgroup int"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert sorted({r[0] for r in few.collect()}) == [7, 4321]


def test_a_batch_that_begins_a_group_closes_the_one_before(spark, tmp_path):
    root = str(tmp_path / "t")
    batches = [random_rows([g], 40, seed=g) for g in (1, 2, 3)]
    assert play(spark, root, batches) == [[], [1], [2]]


def test_smallest_group_rule(spark, tmp_path):
    assert play(spark, str(tmp_path / "t"), batches_in_order(), compat=True) == [[], [1], [2], [1]]


def test_repeated_keys_count_once(spark, tmp_path):
    root = str(tmp_path / "t")
    hit = (1, 1, 5.0, 90.0, 0.5, 5.0)
    others = [(1, o, 5.0, 90.0, 0.4, 5.0) for o in (3, 5)]
    play(spark, root, [[hit, *others], [(*hit[:5], 6.0), *others], [(2, 1, 1.0, 1.0, 1.0, 1.0)]])
    assert counts(job.read_results(spark, root)) == {1: 1}
    one = spark.createDataFrame([(1,)], "observationgroup int")
    stored = job.read_stored_hits(spark, root, one).where("observationorder = 1").collect()
    assert [r["uncorrectedfrequency"] for r in stored] == [6.0]


def test_bad_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    bad = spark.createDataFrame([("nonsense",), (None,), ("a;b;c;d;e;f;g",)], "value string")
    job.process_batch(bad, 0, root, RULE)
    job.flush(spark, root, RULE)
    job.process_batch(batch_of(spark, random_rows([5], 30)), 1, root, RULE)
    job.process_batch(bad.limit(0), 2, root, RULE)
    job.process_batch(batch_of(spark, random_rows([6], 30)), 3, root, RULE)
    assert counts(job.read_results(spark, root)).keys() == {5}
    assert sorted(r["reason"] for r in job.read_rejects(spark, root).collect()) == [
        "no value",
        "not a number",
        "too few fields",
    ]


def test_many_closed_groups(spark, tmp_path):
    root, rows = str(tmp_path / "t"), random_rows(range(1, 6), 300)
    assert play(spark, root, [rows]) == [[1, 2, 3, 4]]
    expected = counts(group_results(spark.createDataFrame(rows, HITS), RULE))
    assert counts(job.read_results(spark, root)) == {g: n for g, n in expected.items() if g < 5}


def test_stream_equals_batch(spark, tmp_path):
    """Files played as a stream, one per batch, with a late file; stopped and started again."""
    rows = random_rows(range(1, 5), 600)
    parts = [sorted(rows)[i::1][j : j + 120] for i in (0,) for j in range(0, 600, 120)]
    parts.append([(1, 2, r[2], 90.0, 0.5, r[5]) for r in rows if r[0] == 1 and r[1] == 1][:10])
    source, root = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    metadata = spark.createDataFrame([(1, "Vega")], "observationgroup int, source string")

    def send(i):
        (source / f"part-{i}.txt").write_text("\n".join(r["value"] for r in batch_of(spark, parts[i]).collect()) + "\n")

    for half in (range(0, 3), range(3, 6)):
        for i in half:
            send(i)
        job.run_available(text_messages(spark, str(source), maxFilesPerTrigger=1), root, RULE, metadata)
    everything = spark.createDataFrame([r for p in parts for r in p], HITS)
    results = job.read_results(spark, root)
    assert counts(results) == counts(group_results(everything, RULE))
    assert {r["observationgroup"]: r["source"] for r in results.collect()} == {1: "Vega", 2: None, 3: None, 4: None}


def test_origin_columns_are_kept(spark):
    raw = spark.createDataFrame([(b"k", b"1;2;3", "hits", 1, 7)], "key binary, value binary, topic string, partition int, offset long")
    assert message_values(raw).columns == ["value", "topic", "partition", "offset"]
    assert message_values(raw).first()["value"] == "1;2;3"
