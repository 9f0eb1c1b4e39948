from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from postlens.functions import text as X, time
from postlens.operators import clean, docs, enrich, sentiment
from postlens.schema import INDEX_SCHEMA
from postlens.sources import store


def enriched(spark, texts, given):
    rows = texts(given).withColumns({"label": F.lit("harassment"), "type": F.lit(None).cast("string")})
    return enrich.enrich(clean.preprocess(rows), sentiment.seed_terms(spark))


def test_flatten(spark, texts):
    rows = docs.flatten_docs(enriched(spark, texts, ["A very good day! " * 10, None, "the and"]))
    assert rows.columns == INDEX_SCHEMA.fieldNames()
    a, b, c = rows.orderBy("id_post").collect()
    assert a.titre == ("a very good day! " * 10)[:100] + "..." and a.label == "harassment"
    assert a.type_harcelement == "unknown" and a.auteur == "anonymous" and a.url == ""
    assert a.contenu == a.contenu_traite == " ".join(["good day"] * 10) and a.nb_mots == 20
    assert a.sentiment == "positive" and a.longueur_texte == len(a.contenu)
    assert (b.contenu, b.titre, b.longueur_texte, b.nb_mots, b.vader_neutre, b.langue) == ("", "", 0, 0, 1.0, "unknown")
    assert c.contenu == c.contenu_original == "the and" and c.contenu_traite == ""


def test_flatten_of_bare_rows_takes_defaults(spark):
    row = docs.flatten_docs(spark.createDataFrame([("1",)], "id_post string")).first()
    assert (row.sentiment, row.score, row.vader_neutre, row.label, row.contenu) == ("neutral", 0.0, 1.0, "unknown", "")


def test_title_edges(spark):
    df = spark.createDataFrame([("x" * 100,), ("x" * 101,), ("x" * 257,)], "t string")
    got = df.select(docs.doc_title(F.col("t")), docs.title_keyword(F.col("t"))).collect()
    assert [r[0] for r in got] == ["x" * 100, "x" * 100 + "...", "x" * 100 + "..."]
    assert [r[1] is None for r in got] == [False, False, True]


def test_quarantine(spark):
    raw = spark.createDataFrame(
        [("1", "0.5"), ("2", "abc"), (None, "1"), ("4", None), ("5", "x" * 300)], "id string, score string"
    )
    checked = docs.check_docs(raw, "id", {"score": "double"})
    assert {(r.id, r.score) for r in docs.valid_docs(checked).collect()} == {("1", 0.5), ("4", None)}
    bad = docs.quarantine(checked, "id")
    assert {r.id: r.reason for r in bad.collect()} == {"2": "bad_number:score", None: "missing_id", "5": "bad_number:score"}
    assert max(len(r.preview) for r in bad.collect()) == 200
    assert tuple(docs.index_accounting(checked).first()) == (2, 3)
    assert {tuple(r) for r in docs.failure_counts(bad).collect()} == {("bad_number:score", 2), ("missing_id", 1)}
    first = [r[:3] for r in docs.first_failures(bad, 2).collect()]
    assert first == [(None, "missing_id", "missing_id"), ("2", "bad_number:score", "bad_number")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_safe_timestamp(spark, zone):
    run = F.lit("2024-06-01T00:00:00Z").cast("timestamp")
    given = {"2024-01-02T03:04:05Z": (2024, 1, 2, 3), "2024-01-02T03:04:05+02:00": (2024, 1, 2, 1),
             "2024-01-02 03:04:05": (2024, 1, 2, 3), "2024-01-02": (2024, 1, 2, 0), "2024-01-02T03:04": (2024, 1, 2, 3), "2024-01-02T03:04:05.123": (2024, 1, 2, 3),
             "nonsense": (2024, 6, 1, 0), "2024-13-45": (2024, 6, 1, 0), "": (2024, 6, 1, 0), "2024": (2024, 6, 1, 0)}
    df = spark.createDataFrame([(k,) for k in given], "t string")
    at = F.unix_seconds(time.safe_timestamp(F.col("t"), run)).alias("at")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.select("t", at, time.is_bad_timestamp(F.col("t")).alias("bad")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for r in rows:
        when = datetime.fromtimestamp(r.at, timezone.utc)
        assert (when.year, when.month, when.day, when.hour) == given[r.t]
        assert r.bad == (r.t in ("nonsense", "2024-13-45", "2024"))


@pytest.mark.parametrize("given,expected", [
    ("I can't, won't and shouldn’t've", ["i", "can't", "won't", "and", "shouldn’t've"]),
    ("pi is 3.14 or 1,234.56; $5.", ["pi", "is", "3.14", "or", "1,234.56", "5"]),
    ("U.S.A. a.b:c d' 'e f-g", ["u.s.a", "a.b:c", "d", "e", "f", "g"]),
    ("snake_case_ __x 4th 3a.b a.3", ["snake_case_", "__x", "4th", "3a.b", "a", "3"]),
    ("日本語テスト です カタカナー", ["日", "本", "語", "テスト", "で", "す", "カタカナー"]),
    ("e\u0301te\u0301 co\u00adop naïve", ["e\u0301te\u0301", "co\u00adop", "naïve"]),
    ("... ' - _ 🙂 ", []), ("", []), (None, []), ("x" * 600, ["x" * 255, "x" * 255, "x" * 90]),
])
def test_words_by_the_rules_of_unicode(spark, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(X.terms(F.coalesce("t", F.lit("")), [])).first()[0] == expected


def test_long_words_do_not_exhaust_the_stack(texts):
    hostile = ["a'" * 100_000, "é" * 200_000, "1," * 100_000, "_" * 100_000, "a1" * 100_000, "a_" * 100_000, "e\u0301" * 50_000]
    texts(hostile).select(docs.analyze_terms(F.col("text"))).write.format("noop").mode("overwrite").save()


def test_search(spark, texts):
    df = texts(["The Quick-brown fox", "a lazy dog", None, "quick dog"])
    assert df.select(docs.analyze_terms(F.col("text"))).first()[0] == ["quick", "brown", "fox"]
    ids = lambda d: {r.id_post for r in d.collect()}
    assert ids(docs.match_terms(df, "text", ["QUICK", "dog"])) == {"0", "1", "3"}
    assert ids(docs.match_terms(df, "text", ["quick", "dog"], "all")) == {"3"}


def test_publish_and_check(spark, texts, tmp_path):
    root = str(tmp_path / "index")
    assert not store.exists(spark, root) and store.current_version(spark, root) is None
    flat = docs.flatten_docs(enriched(spark, texts, ["good", "bad day"]))
    first = store.publish_index(flat, root)
    assert store.exists(spark, root)
    stored = store.read_published(spark, root)
    assert store.check_schema(stored).count() == 2
    with pytest.raises(store.EmptyTable):
        store.publish_index(flat.where("false"), root)
    assert store.current_version(spark, root) == first
    with pytest.raises(store.SchemaMismatch, match="missing"):
        store.check_schema(stored.drop("url"))
    store.publish_index(flat.limit(1), root, ["langue"])
    assert store.read_published(spark, root).count() == 1
    stats = store.store_stats(spark.read.parquet(first)).first()
    assert stats.total_documents == 2 and stats.index_size > 0
    assert stats.index_size_mb == round(stats.index_size / 1024 / 1024, 2)
    with pytest.raises(FileNotFoundError):
        store.read_published(spark, str(tmp_path / "none"))


def test_json(spark):
    row = docs.docs_to_json(spark.createDataFrame([("1", 'a "b"')], "id_post string, t string")).first()
    assert row.json == '{"id_post":"1","t":"a \\"b\\""}'
