import pytest
from pyspark.sql import functions as F

from postlens.functions import emoji
from postlens.operators import sentiment

CASES = [
    ("I am 😊 today", "I am smiling face with smiling eyes today"),
    ("so😊much", "so smiling face with smiling eyes much"),
    ("❤️ it", "heavy black heart it"),
    ("👩‍👧 walk", "woman girl walk"),
    ("👍🏽", "thumbs up sign emoji modifier fitzpatrick type 4"),
    ("🏳️‍🌈 up", "rainbow flag up"),
    ("plain & text\n2nd", "plain & text\n2nd"), ("", ""), (None, None), ("a → b", "a → b"),
]


@pytest.mark.parametrize("max_keys", [100_000, 0])
def test_names_of_emoji(spark, texts, max_keys):
    names = emoji.emoji_names(spark).union(spark.createDataFrame([("🏳️‍🌈", "rainbow flag")], "emoji string, name string"))
    rows = emoji.spell_emoji(texts([t for t, _ in CASES]), names, max_keys=max_keys).collect()
    squeezed = {r.id_post: r.text and " ".join(r.text.split(" ")).replace("  ", " ") for r in rows}
    assert squeezed == {str(i): want for i, (_, want) in enumerate(CASES)}


def test_scores_read_emoji(spark, texts):
    terms = sentiment.seed_terms(spark).union(spark.createDataFrame([("smiling", 2.0, None, False, None, 0.5, 0.5, 1.0, False, False)], sentiment.TERM_SCHEMA))
    given = texts(["we meet 😊", "we meet"])
    plain = sentiment.valence_scores(given, terms)
    named = sentiment.valence_scores(given, terms, emoji=emoji.emoji_names(spark))
    label = lambda df: [r[0] for r in df.orderBy("id_post").select(F.col("vader_sentiment.sentiment_label")).collect()]
    assert label(plain) == ["neutral", "neutral"] and label(named) == ["positive", "neutral"]
