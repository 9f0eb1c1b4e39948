from datetime import datetime

from conftest import plan
from pyspark.sql import functions as F

from postlens.operators import clean, enrich, report, sentiment, state
from postlens.sources import store

FLAGS = "_id int, processed boolean, nlp_processed boolean"
ROWS = [(1, True, None), (2, True, None), (3, False, None), (4, True, False), (5, True, True), (6, None, None)]


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_pending(spark):
    df = spark.createDataFrame(ROWS, FLAGS)
    assert ids(state.pending_clean(df)) == [3]
    assert ids(state.pending_nlp(df)) == [1, 2, 4]
    assert ids(state.ready_docs(df)) == [5]
    assert ids(state.not_done(df, df.where("_id < 4"), "_id")) == [4, 5, 6]
    assert report.stage_counts(df).first().asDict() == {
        "total": 6, "processed": 4, "nlp_processed": 1, "not_processed": 2, "not_nlp_processed": 3,
    }


def test_upsert(spark):
    base = spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "id_post string, x string, y int")
    updates = spark.createDataFrame([("2", None, 9.5), ("7", "z", 0.0)], "id_post string, x string, z double")
    got = {r.id_post: (r.x, r.y, r.z) for r in state.upsert(base, updates).collect()}
    assert got == {"1": ("a", 1, None), "2": (None, 2, 9.5)}
    again = state.upsert(state.upsert(base, updates), updates)
    assert {r.id_post: (r.x, r.y, r.z) for r in again.collect()} == got


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = spark.range(100).selectExpr("string(id) id_post", "id x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("posts_b", "updates_b"):
            store.save_bucketed(rows, name, "id_post", 4, str(tmp_path / name))
        posts, updates = spark.table("posts_b"), spark.table("updates_b")
        for df in (state.upsert(posts, updates), state.not_done(posts, updates)):
            assert "Exchange" not in plan(df)
        assert state.not_done(posts, updates).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS posts_b")
        spark.sql("DROP TABLE IF EXISTS updates_b")


def test_last_write_wins(spark):
    rows = [("hot", i, f"v{i}") for i in range(1000)] + [("a", 1, "x"), ("a", 1, "y"), ("b", None, "n")]
    df = spark.createDataFrame(rows, "id_post string, version int, v string").repartition(8)
    got = {r.id_post: r.v for r in state.last_write_wins(df, "id_post", ["version"]).collect()}
    assert got == {"hot": "v999", "a": "y", "b": "n"}
    shown = state.last_write_wins(df, "id_post", ["version"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in shown and "Window" not in shown


def test_latest_rows(spark, tmp_path):
    rows = [("hot", i % 50, f"v{i}") for i in range(200)] + [("a", 1, "x"), ("b", None, "n"), (None, 1, "p"), (None, 1, "q")]
    for part in (rows[:100], rows[100:]):
        spark.createDataFrame(part, "id_post string, version int, v string").coalesce(1).write.mode("append").parquet(str(tmp_path))
    df = spark.read.parquet(str(tmp_path))
    found = state.latest_rows(df, "id_post", ["version"])
    got = [(r.id_post, r.v) for r in found.collect()]
    assert len(got) == 5 and dict(got)["hot"] in {"v49", "v99", "v149", "v199"} and {v for k, v in got if k is None} == {"p", "q"}
    shown = plan(found)
    # The rows meet only a small list of places; what is grouped and sorted are keys without the other columns.
    assert "BroadcastHashJoin [_file" in shown
    assert all("v#" not in line for line in shown.splitlines() if "Exchange" in line or "SortAggregate" in line)
    assert state.latest_rows(df.where("id_post = 'a'"), "id_post", ["version"]).count() == 1


def test_rows_without_places(spark, tmp_path):
    spark.range(100_000).selectExpr("id", "string(id) v").repartition(2).write.parquet(f"{tmp_path}/rows")
    rows = state.placed(spark.read.parquet(f"{tmp_path}/rows"))
    gone = F.col("id").isin(0, 7, 99_999) | (F.col("id") % 3 == 1)
    expected = {i for i in range(100_000) if i not in (0, 7, 99_999) and i % 3 != 1}
    for bitmaps in (state.BITMAPS, 1):  # by bits, by a join
        found = state.without(rows, rows.where(gone).select(state.PLACE).union(rows.where("id = 7").select(state.PLACE)), bitmaps)
        assert found.columns == rows.columns and ("SortMergeJoin" in plan(found) or "BroadcastHashJoin" in plan(found))
        got = [r.id for r in found.select("id").collect()]
        assert len(got) == len(expected) and set(got) == expected
    assert state.without(rows, rows.where("id < 0").select(state.PLACE)).count() == 100_000


def test_changed(spark):
    source = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z"), (None, "w")], "id_post string, content_digest string")
    done = spark.createDataFrame([("1", "x"), ("2", "old"), (None, "w")], "id_post string, content_digest string")
    assert {r[0] for r in state.changed(source, done).collect()} == {"2", "3", None}
    kinds = spark.createDataFrame([("a",), ("",), (None,), ("t",)], "t string").select(state.content_digest(F.col("t")))
    assert kinds.distinct().count() == 4


def test_resets(spark, texts):
    posts = texts(["good day"]).withColumn("processed", F.lit(False))
    run = datetime(2024, 1, 1)
    done = state.mark_nlp(enrich.enrich(state.mark_clean(clean.preprocess(posts), run), sentiment.seed_terms(spark)), run)
    row = done.first()
    assert row.processed and row.nlp_processed and row.preprocessing_date == row.nlp_processing_date == run
    again = state.reset_nlp(done)
    assert not set(state.NLP_STATE) & set(again.columns) and again.first().nlp_processed is False
    assert again.first().processed is True
    bare = state.reset_clean(done)
    assert bare.columns == ["id_post", "text", "processed", "nlp_processed"]
    assert tuple(bare.first()) == ("0", "good day", False, False)
