from datetime import datetime
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from postlens.operators import clean, ingest, scorer, sentiment, state
from postlens.plans import jobs
from postlens.schema import INDEX_SCHEMA
from postlens.sources import manifest, store
from postlens.streaming import incremental

RUN = datetime(2024, 1, 1)


def test_batch_runs(spark, tmp_path):
    source, root = tmp_path / "posts.csv", str(tmp_path / "store")
    source.write_text("tweet,label,type\nI love this day,ok,none\nyou are awful and ugly,bad,insult\n,x,y\nmore,than,three,fields\n")
    counts = jobs.ingest_run(spark, str(source), root, RUN)
    assert counts == {"loaded": 4, "with_text": 3, "after_cleaning": 3, "created": 2, "failed": 1}
    terms = sentiment.seed_terms(spark)
    for pending in (2, 0):  # the second round finds nothing to do
        assert jobs.clean_run(spark, root, RUN) == {"pending": pending, "written": pending, "failed": 0}
        assert jobs.enrich_run(spark, root, terms, run_ts=RUN) == {"pending": pending, "written": pending, "failed": 0}
    assert jobs.index_run(spark, root) == {"indexed": 2, "failed": 0}
    index = store.check_schema(jobs.index_docs(spark, root), INDEX_SCHEMA)
    assert {(r.label, r.sentiment) for r in index.collect()} == {("ok", "positive"), ("bad", "negative")}
    assert [(r.reason, "fields" in r.preview) for r in jobs.quarantine(spark, root).collect()] == [("ingest:surplus_fields", True)]
    # A reset of cleaning empties the enrichment in the same commit; the index stays until it is made again.
    before = manifest.read(spark, root)
    assert jobs.clean_run(spark, root, RUN, reset=True)["written"] == 2
    after = manifest.read(spark, root)
    assert after.number == before.number + 1 and jobs.results(spark, root, jobs.ENRICHED) is None
    assert jobs.results(spark, root, jobs.CLEAN).count() == 2 and jobs.index_docs(spark, root).count() == 2
    assert manifest.remove_old(spark, root, keep=1) and manifest.table(spark, root, jobs.CLEAN).count() == 2


def test_changed_posts_are_done_again(spark, texts, tmp_path):
    root, terms = str(tmp_path), sentiment.seed_terms(spark)
    kinds = {"label": F.lit("x"), "type": F.lit("y")}
    for given, redone in ((["good", "bad", "day"], 3), (["good", "good", "day"], 1), (["good", "bad", "day"], 1)):
        store.publish(texts(given).withColumns(kinds), root, name=jobs.POSTS)
        assert jobs.clean_run(spark, root, RUN)["written"] == redone
        assert jobs.enrich_run(spark, root, terms, run_ts=RUN)["written"] == redone
        jobs.index_run(spark, root)
        assert {r.id_post: r.contenu for r in jobs.index_docs(spark, root).collect()} == dict(zip("012", given))


def test_bad_rows_lie_apart(spark, tmp_path):
    root, terms = str(tmp_path), sentiment.seed_terms(spark)
    posts = spark.createDataFrame([("1", "good", "a", "b"), (None, "lost", "a", "b")], "id_post string, text string, label string, type string")
    store.publish(posts, root, name=jobs.POSTS)
    assert jobs.clean_run(spark, root, RUN) == {"pending": 2, "written": 1, "failed": 1}
    fails = scorer.scoring(lambda batch: pa.array([len(t.as_py()) // 0 for t in batch.column(0)]), "long", "size", ["processed_text"])
    assert jobs.enrich_run(spark, root, terms, run_ts=RUN, scorer=fails) == {"pending": 1, "written": 0, "failed": 1}
    found = {(r.id, r.reason) for r in jobs.quarantine(spark, root).collect()}
    assert found == {(None, "clean:missing_id"), ("1", "size:ZeroDivisionError")}
    with pytest.raises(FileNotFoundError):
        jobs.index_run(spark, root)


def test_runs_shuffle_no_texts(spark, texts, tmp_path):
    root, kinds = str(tmp_path), {"label": F.lit("x"), "type": F.lit("y")}
    for given in (["good", "bad", "day"], ["good", "worse", "day"]):
        store.publish(texts(given).withColumns(kinds), root, name=jobs.POSTS)
        jobs.clean_run(spark, root, RUN)
    store.publish(texts(["good", "worse", "night"]).withColumns(kinds), root, name=jobs.POSTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current, pending = jobs.current(spark, root, jobs.CLEAN), jobs.pending(spark, root, jobs.POSTS, jobs.results(spark, root, jobs.CLEAN))
        for df in (current, pending):
            shown = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
            exchanges = [b for b in shown.split("\n\n") if ") Exchange" in b]
            assert exchanges and not any("text#" in b for b in exchanges)
        assert {r.text for r in current.collect()} == {"good", "worse"} and [r.text for r in pending.collect()] == ["night"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_doubled_ids_stop_the_ingest(spark, tmp_path):
    with pytest.raises(ingest.DuplicateIds, match="b"):
        ingest.require_unique(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id_post string"))


def test_scorer_keeps_all_rows(spark):
    rows = spark.createDataFrame([(i, "x" * i, "kept") for i in range(50)], "id int, text string, more string").repartition(3)

    def size(batch):
        if "xxxxxxx" in batch.column(0).to_pylist():
            raise KeyError("seven")
        return pc.utf8_length(batch.column(0))

    found = rows.transform(scorer.scoring(size, "long", "size", ["text"], rows=8)).collect()
    assert {(r.id, r.size, r.more) for r in found} == {(i, None if i == 7 else i, "kept") for i in range(50)}
    assert [r[scorer.REASON] for r in found if r.id == 7] == ["size:KeyError"]


def test_commits(spark, tmp_path):
    root = str(tmp_path)
    assert manifest.read(spark, root) == (0, {}) and manifest.table(spark, root, "a") is None
    folders = [manifest.write(spark.range(n), root, "a") for n in (1, 2, 3)]
    for f in folders:
        manifest.commit(spark, root, lambda tables: {**tables, "a": [f]})  # noqa: B023
    assert manifest.read(spark, root) == (3, {"a": [folders[2]]})
    # Another writer commits between reading and renaming: the change is made again on what it left.
    met = []

    def change(tables):
        if not met:
            met.append(manifest.commit(spark, root, lambda t: {**t, "b": ["x"]}))
        return {**tables, "c": ["y"]}

    assert manifest.commit(spark, root, change) == (5, {"a": [folders[2]], "b": ["x"], "c": ["y"]})
    lost = manifest.write(spark.range(9), root, "a")  # a writer that never came to its commit
    assert manifest.remove_old(spark, root, keep=3) == sorted(folders[:2])
    assert spark.read.parquet(f"{root}/{lost}").count() == 9 and manifest.table(spark, root, "a").count() == 3


def test_merge_rewrites_touched_buckets(spark, tmp_path):
    root = str(tmp_path)
    merge = lambda rows: manifest.merge(
        spark.createDataFrame(rows, "k string, v int, x string"), root, "t", "k", ["v"], state.latest_rows, 8
    )
    merge([(str(i), 1, "old") for i in range(40)])
    before = set(manifest.read(spark, root).tables["t"])
    merge([("3", 2, "new"), ("3", 0, "late"), ("77", 1, "first")])
    after = set(manifest.read(spark, root).tables["t"])
    assert len(before - after) <= 2 and len(before & after) >= 6
    found = {r.k: r.x for r in manifest.table(spark, root, "t").collect()}
    assert found == {**{str(i): "old" for i in range(40)}, "3": "new", "77": "first"}


def test_stream_takes_only_new_files(spark, texts, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    texts(["good day", "bad day"]).write.parquet(source)
    schema = spark.read.parquet(source).schema
    run = lambda: incremental.incremental_clean(spark, source, schema, out, checkpoint, max_files=1)
    run()
    before = {r.id_post: r.processed_text for r in incremental.read_results(spark, out).collect()}
    assert before == {"0": "good day", "1": "bad day"}
    run()
    # A later file brings a new post and replaces an old one.
    spark.createDataFrame([("1", "changed"), ("9", "new")], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    after = {r.id_post: r.processed_text for r in incremental.read_results(spark, out).collect()}
    assert after == {"0": "good day", "1": "changed", "9": "new"}
    # Rows without an id lie apart; two versions of a key in a batch are told apart by their version.
    rows = [("1", "zz older"), ("1", "aa newer"), (None, "lost")]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    run()
    newest = {r.id_post: r.text for r in incremental.read_results(spark, out, version="text").collect()}
    assert newest["1"] == "zz older" and incremental.read_results(spark, out).count() == 3
    assert [tuple(r) for r in incremental.read_rejected(spark, out).collect()] == [(None, "missing_id")]


@pytest.mark.parametrize("max_keys", [1000, 0])
def test_stream_of_cleaned_posts(spark, texts, tmp_path, max_keys):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    clean.preprocess(texts(["a good day", "a bad day", ""])).write.parquet(source)
    schema = spark.read.parquet(source).schema
    terms = sentiment.seed_terms(spark)
    incremental.incremental_nlp(spark, source, schema, out, checkpoint, terms, max_keys=max_keys)
    got = {r.id_post: r.sentiment_consensus.final_sentiment for r in incremental.read_results(spark, out).collect()}
    assert got == {"0": "positive", "1": "negative", "2": "neutral"}


def test_replayed_batch_overwrites_itself(spark, texts, tmp_path):
    out = str(tmp_path / "out")
    batch = texts(["a", "b"])
    for _ in range(2):
        batch.write.mode("overwrite").parquet(f"{out}/{incremental.BATCH}=0")
    assert incremental.read_results(spark, out).count() == 2


def test_shared_folder_follows_the_session(spark):
    class Session:
        def __init__(self, setting, master):
            self.conf = {"spark.checkpoint.dir": setting} if setting else {}
            self.sparkContext = SimpleNamespace(master=master)

    assert incremental.shared_folder(Session("hdfs://x/y/", "yarn")).startswith("hdfs://x/y/")
    with pytest.raises(ValueError):
        incremental.shared_folder(Session(None, "yarn"))
    assert incremental.shared_folder(spark) != incremental.shared_folder(spark)


@pytest.mark.parametrize("name", ["preprocess", "valence_scores", "detect_language", "post_ids", "quarantine", "dash_language_share"])
def test_queries_match_their_sql(spark, name):
    import __spark_entry__ as entry
    from checks.compare import connect, difference

    sf_dir = entry.SMOKE_DIR
    assert difference(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
