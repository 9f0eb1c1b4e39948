import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postlens.operators import ingest
from postlens.schema import POST_SCHEMA
from postlens.sources import csv

RUN = datetime(2024, 1, 1)
RAW = [("Une phrase méchante", "bad", "insult"), ("Bonne journée", "good", "none"), ("Encore une insulte", "bad", "threat")]


@pytest.mark.parametrize("columns,roles", [
    (["text", "label", "type"], ("text", "label", "type")),
    (["tweet_text", "cyberbullying_type"], ("tweet_text", "cyberbullying_type", "cyberbullying_type")),
    (["Message", "Class", "Category"], ("Message", "Class", "Category")),
    (["a", "b", "c"], ("a", "c", "c")),
    (["text", "message", "label"], ("message", "label", "label")),
    (["message_type", "label"], ("message_type", "label", "label")),
])
def test_roles(columns, roles):
    assert tuple(csv.resolve_roles(columns)) == roles


def test_roles_table(spark):
    assert csv.roles_table(spark, ["text", "label"]).count() == 3


def test_csv_round_trip(spark, tmp_path):
    file = tmp_path / "posts.csv"
    file.write_text('text,label,type\n"two\nlines, ""quoted""",a,b\nNA,a,b\nplain,1,n/a\n')
    rows = csv.read_csv(spark, str(file)).collect()
    assert [tuple(r) for r in rows] == [('two\nlines, "quoted"', "a", "b", None), (None, "a", "b", None), ("plain", "1", None, None)]


def cells(record):
    """The fields of a record, by hand: quoted only if the first character is a quote."""
    out, i = [], 0
    while i <= len(record):
        value = ""
        if record[i : i + 1] == '"':
            i += 1
            while record[i] != '"' or record[i + 1 : i + 2] == '"':
                value += record[i]
                i += 1 + (record[i] == '"')
            i += 1
        end = record.find(",", i) if "," in record[i:] else len(record)
        out.append(value + record[i:end])
        i = end + 1
    return out


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
def test_csv_in_splits(spark, tmp_path, split):
    """Files of line breaks inside quotes, stray quotes and surplus fields, cut anywhere."""
    rng = random.Random(split)

    def field():
        kind = rng.random()
        if kind < 0.2:
            return '"' + "".join(rng.choice(["a", "\n", ",", '""', "é ", "\n\n"]) for _ in range(rng.randrange(12))) + '"'
        return rng.choice(['5" disk', 'x"y"', 'a "b" c', 'it"']) if kind < 0.3 else rng.choice(["ab", "", "longer text", "é", "NA"])

    records = []
    for k in range(3):
        made = [r for r in (",".join(field() for _ in range(rng.choice([3, 3, 3, 4, 2]))) for _ in range(200)) if r]
        (tmp_path / f"{k}.csv").write_text("text,label,type\n" + "\n".join(made) + rng.choice(["", "\n"]))
        records += made
    expected = []
    for r in records:
        found = [None if c in csv.NULL_CELLS else c for c in cells(r)]
        expected.append((*(found + [None] * 3)[:3], r if len(found) > 3 else None))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = csv.read_csv(spark, str(tmp_path))
        assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, expected))
        assert split > 64 or csv.lines_of(spark, str(tmp_path / "0.csv")).rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_with_a_field_that_is_never_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('text,label\nx,y\n"open,z\nmore\n')
    (tmp_path / "b.csv").write_text("text,label\n1,2\n")
    rows = csv.read_csv(spark, str(tmp_path)).select("text", "label").collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ('open,z\nmore', None), ("x", "y")] or len(rows) == 3


def test_csv_missing(spark, tmp_path):
    with pytest.raises(csv.SourceNotFound):
        csv.read_csv(spark, str(tmp_path / "no.csv"))


def test_posts(spark):
    raw = spark.createDataFrame([*RAW, ("", "x", "y"), (None, "x", "y"), ("  ", "x", "y"), ("  kept ", None, None)],
                                "text string, label string, type string")
    posts = ingest.make_posts(raw, RUN)
    assert [(f.name, f.dataType) for f in posts.schema] == [(f.name, f.dataType) for f in POST_SCHEMA]
    rows = posts.collect()
    assert len(rows) == 4 and len({r.id_post for r in rows}) == 4
    kept = next(r for r in rows if r.text == "kept")
    assert (kept.label, kept.type, kept.processed, kept.created_at) == ("unknown", "unknown", False, RUN)
    assert ingest.duplicate_ids(posts).count() == 0
    parity = ingest.make_posts(raw, RUN, null_label="nan").where("text = 'kept'").first()
    assert parity.label == "nan"


def test_numeric_text_column(spark):
    raw = spark.createDataFrame([(1, "a", "b")], "text int, label string, type string")
    assert ingest.make_posts(raw, RUN).first().text == "1"


def test_ids_of_copies_do_not_depend_on_the_split(spark):
    # One text holds a third of the rows and is written out by several tasks.
    rows = [("hot",)] * 500 + [(f"t{i}",) for i in range(1000)]
    df = spark.createDataFrame(rows, "text string")
    one = ingest.content_ids(df.coalesce(1), chunk=64)
    many = ingest.content_ids(df.repartition(7), chunk=100_000)
    a, b = ({(r.id_post, r.text) for r in x.collect()} for x in (one, many))
    assert a == b and len(a) == 1500 and len({i for i, _ in a}) == 1500


def test_accounting(spark):
    df = spark.createDataFrame([("a",), (" ",), (None,)], "text string")
    assert tuple(ingest.ingest_accounting(df, df.limit(1)).first()) == (3, 2, 1, 1)
    none = df.where(F.lit(False))
    assert tuple(ingest.ingest_accounting(none, none).first()) == (0, 0, 0, 0)


def test_ids_of_rows_that_read_alike(spark):
    rows = [("a\x01b", "c"), ("a", "b\x01c"), (None, "x"), ("x", None), ("a1:", "b"), ("a", "1:b")]
    df = spark.createDataFrame(rows, "text string, label string")
    assert ingest.content_ids(df).select("id_post").distinct().count() == len(rows)
