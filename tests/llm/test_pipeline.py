"""The pipeline's stages against plain versions, each on its own input."""

import re
from collections import Counter

import corpus_pipeline
from test_llm_operators import ODD, base_spans, contamination, plain_copies, weak_spans


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, function in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = function(spark, docs, sf)
        after = docs.collect()
        docs = spark.createDataFrame(after, docs.schema)
        if name != "packing":
            assert docs.columns == columns
        was, now = Counter(r.doc_id for r in before), Counter(r.doc_id for r in after)
        if name == "quality":
            gone = set(was) - set(now)
            assert sum(labels[i] == 0 for i in gone if i in labels) >= 0.9 * sum(i in labels for i in gone)
        elif name == "near_duplicates":
            plain = plain_copies([(r.doc_id, r.text) for r in before])
            assert max(now.values()) == 1 and set(plain) <= set(now) and len(now) - len(plain) <= max(1, 0.05 * (len(before) - len(plain)))
        elif name == "decontamination":
            assert now == Counter({r.doc_id: 1 for r in before if not contamination(r.text, items)[1]})
        elif name == "secrets":
            by = {r.doc_id: r for r in after}
            for r in before:
                spans = base_spans(r.text) + weak_spans(r.text)
                assert (by[r.doc_id].text == r.text) == (not spans)
                assert by[r.doc_id].n_chars == len(by[r.doc_id].text)
                assert not [s for s in base_spans(by[r.doc_id].text) if s.startswith(("access", "hex"))]
            assert now == was
        else:
            assert {r.doc_id for r in after if r.piece == 0} == set(was)


def test_stages_keep_awkward_rows_whole(spark, sf):
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    for name, function in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = function(spark, given, sf)
            assert out.columns == docs.columns
            n = out.count()
            assert n == 0 if given is not docs else n > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
    assert re.fullmatch("packing", corpus_pipeline.STAGES[-1][0])


def test_run_gives_all_stages_and_deletes_what_it_no_longer_needs(spark, sf):
    from pathlib import Path

    from voxtable.llm import common

    common.drop_stages(spark)
    packed = corpus_pipeline.run(spark, sf)
    ids = {r.doc_id for r in packed.collect()}
    quality = corpus_pipeline.quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert ids and ids < {r.doc_id for r in quality.collect()}
    base = Path(common.base_dir(spark).removeprefix("file://"))
    assert len(list(base.iterdir())) <= 4  # the last stage's input and tables
    common.drop_stages(spark)
    assert not base.exists()


def test_tables_are_staged_where_all_executors_see_them(spark, tmp_path):
    from pathlib import Path
    from types import SimpleNamespace

    import pytest
    from voxtable.llm import common

    def session(master, named=None, checkpoint=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" else default), sparkContext=SimpleNamespace(master=master, applicationId="a", getCheckpointDir=lambda: checkpoint))

    assert common.base_dir(session("spark://x", "hdfs://n/c/")) == "hdfs://n/c/voxtable-a"
    assert common.base_dir(session("yarn", None, "s3://b/c")) == "s3://b/c/voxtable-a"
    assert common.base_dir(session("local[4]")) == f"{common.LOCAL_STAGE}/voxtable-a"
    for master in ("spark://x", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            common.base_dir(session(master))
    with common.scratch(spark) as kept:
        inner = common.stage(spark.range(5))
        path = Path(inner.inputFiles()[0].removeprefix("file://")).parent
        out = common.stage(inner.where("id > 1"), kept)
        assert path.exists()
    assert not path.exists() and out.count() == 3


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    from voxtable.llm import common

    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as x")
    assert hinted(common.bounded_broadcast(df, 100)) and not hinted(common.bounded_broadcast(df, 99)) and not hinted(common.bounded_broadcast(df, 100, 50_000))
    assert hinted(common.bounded_broadcast(df.limit(0)))
