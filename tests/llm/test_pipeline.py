import sys
from collections import Counter

import pytest

import corpus_pipeline
from llm.conftest import clashing, prose
from nearfield.llm import decontam, linededup, minhash, packing, quality
from nearfield.llm.common import table

SF = "/root/testdata/sf0.01"


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["good_quality", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """The rows after each stage, written and read again."""
    out, docs = {}, table(spark, SF, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = out[stage.__name__] = spark.read.parquet(path)
    return out


def test_each_stage_keeps_what_its_operator_says(spark, ran):
    docs = table(spark, SF, "documents")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    scored = quality.scored_documents(docs, table(spark, SF, "labels"))
    assert ids(ran["good_quality"]) == ids(scored.where("predicted = 1"))
    lines = linededup.without_repeated_lines(ran["good_quality"])
    texts = {r.doc_id: r.text for r in lines.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in ran["line_dedup"].collect()}
    assert all(texts[i] == t and n == len(t) for i, (t, n) in after.items())
    assert all(not t.strip() for i, t in texts.items() if i not in after)
    assert ids(ran["near_dedup"]) == ids(minhash.near_duplicates(ran["line_dedup"]).where("kept"))
    leaked = decontam.contaminated_documents(ran["near_dedup"], table(spark, SF, "benchmark"))
    assert ids(ran["decontamination"]) == ids(leaked.where("NOT contaminated"))
    for name, df in ran.items():
        if name != "best_fit_packing":
            assert df.columns == docs.columns and df.schema == docs.schema


def test_the_last_stage_packs_what_is_left(spark, ran):
    places = ran["best_fit_packing"]
    assert {r.doc_id for r in places.collect()} == {r.doc_id for r in ran["decontamination"].collect()}
    assert places.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_run_gives_the_last_stage(spark, ran):
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, found.select(*own).collect())) == Counter(map(tuple, ran["best_fit_packing"].select(*own).collect()))


def test_clean_documents_stay(spark, ran):
    """Good documents of which no line, of any length, recurs, and that share no passage or item with others, come
    through untouched."""
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    lines = Counter(x for t in texts.values() for line in t.split("\n") if (x := line.strip(" \t\r")))
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    clean = {
        i for i, t in texts.items()
        if labels.get(i) == 1 and all(lines[x.strip(" \t\r")] < 2 for x in t.split("\n")) and not any(x in t for x in items)
    }
    kept = {r.doc_id: r.text for r in ran["decontamination"].collect()}
    near = {r.doc_id for r in minhash.near_duplicates(docs).where("NOT kept").collect()}
    lost = {i for i in clean - near if kept.get(i) != texts[i]}
    assert len(clean) > 50 and len(lost) <= 0.03 * len(clean)


@pytest.mark.parametrize("k", range(5))
def test_odd_rows_in_every_stage(spark, odd, none, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = clashing(odd)
    found = stage(spark, docs, "/root/testdata/sf0.001")
    if k < 4:
        assert found.columns == docs.columns
        assert {(r.doc_id, r.text) for r in found.collect()} <= {(r.doc_id, r.text) for r in docs.collect()} | {(9, ""), (9, prose(9, 60)), (9, prose(5, 80)), (5, "")}
    else:
        assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect()}
    assert stage(spark, none, "/root/testdata/sf0.001").count() == 0


def test_the_rest_does_not_need_this(spark):
    import subprocess

    code = (
        "import sys; sys.modules['nearfield.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; names = set(e.queries()); print(len(names), any(n.startswith('op') and n[2].isdigit() for n in names), 'pipeline' in names)"
    )
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).stdout.split()
    assert int(out[0]) > 20 and out[1:] == ["False", "False"]
