import pytest

from postlens.operators import report


@pytest.fixture
def index(spark):
    rows = [("en", "a", "negative")] * 5 + [("fr", "b", "positive")] * 3 + [("de", "b", "neutral")] * 2 + [("es", "a", "negative"), (None, "a", "neutral")]
    return spark.createDataFrame(rows, "langue string, type_harcelement string, sentiment string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_label_counts(spark):
    df = spark.createDataFrame([("harassment",)] * 60 + [("normal",)] * 40, "label string")
    assert dict(rows(report.counts(df, "label"))) == {"harassment": 60, "normal": 40}
    assert report.total_docs(df).first()[0] == 100


def test_counts_and_terms(index):
    assert rows(report.top_counts(index, "langue", 2)) == [("en", 5), ("fr", 3)]
    assert rows(report.top_counts(index, "langue"))[3:] == [(None, 1), ("es", 1)]
    assert rows(report.terms(index, "langue")) == [("en", 5), ("fr", 3), ("de", 2), ("es", 1)]


def test_dashboard(index):
    assert {r[0]: (r[1], r[2]) for r in rows(report.share_with_other(index, "langue", 2))} == {
        "en": (5, 5 / 12), "fr": (3, 3 / 12), "other": (4, 4 / 12),
    }
    assert {r[0]: r[1] for r in rows(report.sentiment_share(index))} == {"negative": 6, "positive": 3, "neutral": 3}
    assert report.negative_total(index).first()[0] == 6
    heat = {r.langue: (r.negative, r.neutral, r.positive) for r in report.language_by_sentiment(index).collect()}
    assert heat == {"en": (5, 0, 0), "fr": (0, 0, 3), "de": (0, 2, 0), "es": (1, 0, 0), None: (0, 1, 0)}
    assert sum(r["count"] for r in report.language_sentiment_counts(index).collect()) == 12
    assert sum(r["count"] for r in report.dashboard(index).collect()) == 12


def test_word_stats(spark):
    df = spark.createDataFrame([(True, 2), (True, 5), (False, 100), (None, 7)], "processed boolean, word_count int")
    assert rows(report.word_stats(df)) == [(3.5, 2, 5, "3.50")]
    assert rows(report.word_stats(df.where("false"))) == []


def test_preview_and_profile(spark):
    df = spark.createDataFrame([("2", "x" * 90, None), ("1", "short", "l"), ("3", None, "l")], "id string, text string, label string")
    assert rows(report.preview(df, "id", {"text": 80, "label": None}, 2)) == [("1", "short", "l"), ("2", "x" * 80 + "...", "N/A")]
    profile = {r.field: r for r in report.profile_fields(df).collect()}
    assert (profile["text"].present, profile["text"].missing, profile["text"].min_length, profile["text"].max_length) == (2, 1, 5, 90)
    assert profile["label"].type == "string"
    assert report.profile_fields(df.where("false")).count() == 3


def test_a_null_group_is_not_other(spark):
    df = spark.createDataFrame([(v,) for v in [None] * 5 + ["en"] * 3 + ["fr", "other"]], "v string")
    assert sorted((r.v or "", r["count"]) for r in report.share_with_other(df, "v", 2).collect()) == [("", 5), ("en", 3), ("other", 2)]
    words = spark.createDataFrame([(True, w) for w in (2, 2, 2, 2, 2, 2, 2, 3)], "processed boolean, word_count int")
    assert report.word_stats(words).first().avg_display == "2.12"
