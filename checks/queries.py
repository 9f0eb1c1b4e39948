"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as B
from postlens.functions import emoji, lookup, numbers, text as X, time
from postlens.functions.wordlists import STOP_WORDS
from postlens.operators import clean, docs, enrich, ingest, language, lemma, report, scorer, sentences, sentiment, state
from postlens.plans import jobs
from postlens.sources import csv, manifest, store
from postlens.streaming import incremental

RUN_TS = datetime(2024, 6, 1, 12, 0, 0)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def long(*columns: str) -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# --- shared inputs ------------------------------------------------------------


def cleaned(spark, sf):
    return clean.preprocess(B.documents(spark, sf, "text"))


def profiles(spark, sf) -> DataFrame:
    return language.train_language_profiles(B.spread(B.table(spark, sf, "documents").select("text", "lang")))


def enriched(spark, sf) -> DataFrame:
    found = clean.preprocess(B.posts(spark, sf, "text", "label", "type"))
    return enrich.enrich(found, B.lexicon(spark), published_profiles(spark, sf))


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, so that planning does not compute it again."""
    path = incremental.shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PROFILES: dict[tuple[str, str], DataFrame] = {}


def published_profiles(spark, sf) -> DataFrame:
    """The language profiles as a table, trained by the first query of a session that detects languages."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in PROFILES:
        PROFILES[key] = stored(profiles(spark, sf))
    return PROFILES[key]


INDEXES: dict[tuple[str, str], str] = {}


def flat(spark, sf) -> DataFrame:
    """The published index, as the reports read it; written by the first report of a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in INDEXES:
        root = incremental.shared_folder(spark)
        store.publish(docs.flatten_docs(enriched(spark, sf)), root)
        INDEXES[key] = root
    return store.read_published(spark, INDEXES[key])


def flat_results(df: DataFrame) -> DataFrame:
    return df.select(
        "id_post",
        F.col("language_detection.language").alias("language"),
        F.col("language_detection.confidence").alias("confidence"),
        F.col("textblob_sentiment.polarity").alias("polarity"),
        F.col("textblob_sentiment.subjectivity").alias("subjectivity"),
        F.col("textblob_sentiment.sentiment_label").alias("polarity_label"),
        F.col("vader_sentiment.compound").alias("compound"),
        F.col("vader_sentiment.positive").alias("positive"),
        F.col("vader_sentiment.neutral").alias("neutral"),
        F.col("vader_sentiment.negative").alias("negative"),
        F.col("vader_sentiment.sentiment_label").alias("valence_label"),
        F.col("sentiment_consensus.final_sentiment").alias("final_sentiment"),
        F.col("sentiment_consensus.confidence").alias("sentiment_confidence"),
        F.col("sentiment_consensus.final_score").alias("final_score"),
    )


# --- sources, sinks, state writes ---------------------------------------------


@query
def scan_posts(spark, sf):
    return store.scan(spark, f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id", "source", "n_chars")


@query
def resolve_roles(spark, sf):
    return csv.select_roles(store.scan(spark, f"{sf}/documents.parquet"))


@query
def duplicate_ids(spark, sf):
    return ingest.duplicate_ids(B.table(spark, sf, "conversations"), "conv_id")


@query
def upsert_clean(spark, sf):
    posts = B.posts(spark, sf, "text", "processed")
    updates = clean.preprocess(posts.where("processed")).select("id_post", "processed_text", *long("word_count"))
    return state.upsert(posts.select("id_post", "processed", F.lit("").alias("processed_text")), updates)


@query
def upsert_nlp(spark, sf):
    posts = B.posts(spark, sf, "text", "processed")
    scored = sentiment.score_sentiment(clean.preprocess(posts.where("processed")), B.lexicon(spark))
    updated = state.upsert(posts.select("id_post"), scored.select("id_post", "sentiment_consensus"))
    return updated.select("id_post", "sentiment_consensus.final_sentiment", "sentiment_consensus.final_score")


@query
def last_write_wins(spark, sf):
    return state.latest_rows(B.table(spark, sf, "conversations"), "conv_id", ["turn"])


@query
def last_write_wins_rows(spark, sf):
    """The same for rows that are not read from files."""
    return state.last_write_wins(B.table(spark, sf, "conversations"), "conv_id", ["turn"])


@query
def merge_updates(spark, sf):
    """Turns put into a table of buckets in three merges, the last ones first; each rewrites the buckets it touches."""
    root, rows = incremental.shared_folder(spark), B.table(spark, sf, "conversations")
    for k in (2, 0, 1):
        manifest.merge(rows.where(F.col("turn") % 3 == k), root, "turns", "conv_id", ["turn"], state.latest_rows, 8)
    return manifest.table(spark, root, "turns")


@query
def csv_round_trip(spark, sf):
    """Documents written as CSV with quotes in bare fields, line breaks in quoted ones and surplus fields, and read again."""
    text, lang, key = F.replace("text", F.lit('"'), F.lit('""')), F.col("lang"), F.col("doc_id")
    note = (
        F.when(key % 3 == 0, F.concat(F.lit('5" of '), lang)).when(key % 3 == 1, F.concat(F.lit('"'), lang, F.lit(', ""x""\n"')))
        .otherwise(lang)
    )
    surplus = F.when(key % 10 == 3, ',more,"a,\nb"').otherwise("")
    line = F.concat(key, F.lit(',"'), text, F.lit('",'), note, surplus)
    # The first row of a partition brings the header of its file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = B.documents(spark, sf, "doc_id", "text", "lang").select(F.when(first, F.concat(F.lit("doc_id,text,note\n"), line)).otherwise(line))
    folder = incremental.shared_folder(spark)
    lines.write.text(folder)
    rows = csv.read_csv(spark, folder)
    return rows.select(
        F.col("doc_id").cast("long"), F.sha2("text", 256).alias("text_sha256"), "note", F.col(csv.CORRUPT).isNotNull().alias("surplus")
    )


# --- runs -----------------------------------------------------------------------


def turn_posts(spark, sf) -> DataFrame:
    """Turns as posts with an id of their own; every 17th has none."""
    key = F.concat_ws("-", "conv_id", "turn")
    rows = B.spread(B.table(spark, sf, "conversations"))
    return rows.select(
        F.when((F.col("conv_id") + F.col("turn")) % 17 > 0, key).alias("id_post"), "text", F.col("role").alias("label"),
        F.concat(F.lit("turn "), F.col("turn") % 3).alias("type"),
    )


RUNS: dict[tuple[str, str], tuple[str, list]] = {}


def run_store(spark, sf) -> tuple[str, list]:
    """A store after two rounds of cleaning, enriching and indexing, a part of the posts changed between them; and the counts of the runs."""
    key = (spark.sparkContext.applicationId, sf)
    if key in RUNS:
        return RUNS[key]
    root, posts, counts = incremental.shared_folder(spark), turn_posts(spark, sf), []
    shorter = F.substring("text", F.lit(1), (F.length("text") / 2).cast("int"))
    rounds = [posts.withColumn("text", F.when(F.col("label") == "user", shorter).otherwise(F.col("text"))), posts]
    for rows in rounds:
        store.publish(rows, root, name=jobs.POSTS)
        counts.append(("clean", jobs.clean_run(spark, root, RUN_TS)))
        counts.append(("enrich", jobs.enrich_run(spark, root, B.lexicon(spark), run_ts=RUN_TS)))
        counts.append(("index", jobs.index_run(spark, root)))
    RUNS[key] = root, counts
    return RUNS[key]


@query
def batch_runs(spark, sf):
    """The index after posts changed under their ids: each has the results of its newest text."""
    return jobs.index_docs(spark, run_store(spark, sf)[0]).select(
        "id_post", "label", "type_harcelement", "contenu_traite", "langue", "langue_confiance", "sentiment", "score"
    )


@query
def batch_counts(spark, sf):
    """What the runs counted while they wrote."""
    rows = [
        (k // 3, name, c.get("pending"), c.get("written"), c.get("indexed"), c["failed"])
        for k, (name, c) in enumerate(run_store(spark, sf)[1])
    ]
    return spark.createDataFrame(rows, "round int, run string, pending long, written long, indexed long, failed long")


@query
def batch_quarantine(spark, sf):
    rows = jobs.quarantine(spark, run_store(spark, sf)[0])
    return rows.groupBy("id", "reason").agg(F.count("*").alias("n"))


@query
def user_scorer(spark, sf):
    """A scorer of the user's own over Arrow batches, which fails for some rows: all rows stay, failures have a reason."""

    def shouting(batch):
        import pyarrow.compute as pc

        if pc.any(pc.equal(pc.struct_field(batch.to_struct_array(), [0]), "assistant")).as_py():
            raise ValueError("not for assistants")
        marks = pc.count_substring(batch.column(1), "!")
        return pc.add(pc.multiply(marks, 2), pc.count_substring(batch.column(1), "?"))

    rows = B.spread(B.table(spark, sf, "conversations"))
    found = rows.transform(scorer.scoring(shouting, "long", "loudness", ["role", "text"]))
    return found.select("conv_id", "turn", "loudness", F.col(scorer.REASON).alias("reason"))


@query
def language_accuracy(spark, sf):
    """How held-out documents are told apart by profiles of the others: rows of language and verdict."""
    rows = B.spread(B.table(spark, sf, "documents").select("doc_id", "text", "lang"))
    held = F.col("doc_id") % 5 == 0
    trained = stored(language.train_language_profiles(rows.where(~held)))
    return language.language_accuracy(rows.where(held), trained)


def checked_pages(spark, sf):
    return docs.check_docs(B.raw_pages(spark, sf), "page_id", {"score": "double"})


@query
def quarantine(spark, sf):
    return docs.quarantine(checked_pages(spark, sf), "page_id")


@query
def index_accounting(spark, sf):
    return docs.index_accounting(checked_pages(spark, sf))


@query
def failure_breakdown(spark, sf):
    return docs.failure_counts(docs.quarantine(checked_pages(spark, sf), "page_id"))


@query
def first_failures(spark, sf):
    return docs.first_failures(docs.quarantine(checked_pages(spark, sf), "page_id"))


@query
def store_stats(spark, sf):
    return store.store_stats(B.table(spark, sf, "documents"))


@query
def preview(spark, sf):
    columns = {"label": None, "type": None, "nlp_processed": None, "text": 80}
    return report.preview(B.posts(spark, sf), "id_post", columns, 3)


@query
def profile_fields(spark, sf):
    return report.profile_fields(B.posts(spark, sf))


@query
def docs_to_json(spark, sf):
    return docs.docs_to_json(B.posts(spark, sf, "text", "label", "type"))


# --- rows ---------------------------------------------------------------------


@query
def clean_rows(spark, sf):
    return ingest.clean_rows(B.turns(spark, sf))


@query
def make_posts(spark, sf):
    raw = B.spread(B.table(spark, sf, "documents")).select("doc_id", "text", F.nullif("lang", F.lit("es")).alias("label"), F.col("source").alias("type"))
    return ingest.make_posts(raw, RUN_TS, id_col="doc_id").drop("created_at")


@query
def post_ids(spark, sf):
    raw = B.spread(B.table(spark, sf, "documents").select("text", "lang")).select("text", F.col("lang").alias("label"), F.col("lang").alias("type"))
    return ingest.make_posts(raw, RUN_TS).select("id_post", "label")


@query
def pending_clean(spark, sf):
    return state.pending_clean(B.posts(spark, sf, "label", "processed"))


@query
def pending_nlp(spark, sf):
    return state.pending_nlp(B.posts(spark, sf, "label", "processed", "nlp_processed"))


@query
def ready_docs(spark, sf):
    return state.ready_docs(B.posts(spark, sf, "label", "processed", "nlp_processed"))


@query
def pending_anti(spark, sf):
    done = B.table(spark, sf, "labels").select("doc_id")
    return state.not_done(B.table(spark, sf, "documents").select("doc_id", "source"), done, "doc_id")


def without_profiles(spark, sf) -> DataFrame:
    """Enriched posts whose language comes from function words: resets drop the results."""
    found = clean.preprocess(B.posts(spark, sf, "text", "label", "type"))
    return enrich.enrich(found, B.lexicon(spark))


@query
def reset_clean(spark, sf):
    rows = state.mark_nlp(without_profiles(spark, sf).transform(state.mark_clean, RUN_TS), RUN_TS)
    return state.reset_clean(rows)


@query
def reset_nlp(spark, sf):
    rows = state.mark_nlp(without_profiles(spark, sf).transform(state.mark_clean, RUN_TS), RUN_TS)
    kept = state.reset_nlp(rows).drop("tokens", "preprocessing_date", "text")
    return kept.withColumns({"word_count": F.col("word_count").cast("bigint")})


@query
def flatten_docs(spark, sf):
    rows = docs.flatten_docs(enriched(spark, sf))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("longueur_texte", "nb_mots")})


@query
def doc_title(spark, sf):
    return B.documents(spark, sf, "text").select("id_post", docs.doc_title(F.col("text")).alias("titre"))


@query
def title_keyword(spark, sf):
    return B.documents(spark, sf, "text").select("id_post", docs.title_keyword(F.col("text")).alias("keyword"))


@query
def doc_content(spark, sf):
    rows = clean.preprocess(B.turns(spark, sf))
    return rows.select("id_post", docs.doc_content(F.col("processed_text"), F.col("original_text")).alias("contenu"))


@query
def safe_timestamp(spark, sf):
    c = F.col("date")
    return B.event_times(spark, sf).select(
        "event_id",
        F.unix_micros(time.safe_timestamp(c, F.lit("2024-06-01T12:00:00Z").cast("timestamp"))).alias("at_micros"),
        time.is_bad_timestamp(c).alias("is_bad"),
    )


@query
def doc_lengths(spark, sf):
    rows = docs.doc_lengths(B.documents(spark, sf, "text"), "text", "id_post")
    return rows.select("id_post", *long("longueur_texte", "nb_mots"))


@query
def nlp_empty_default(spark, sf):
    rows = clean.preprocess(B.turns(spark, sf))
    return flat_results(enrich.enrich(rows, B.lexicon(spark)))


# --- text ---------------------------------------------------------------------


def on_documents(name: str, expression: Callable[[Column], Column], out: str) -> None:
    def run(spark, sf):
        return B.documents(spark, sf, "text").select("id_post", expression(F.col("text")).alias(out))

    QUERIES[name] = run


def on_fragments(name: str, expression: Callable[[Column], Column], out: str) -> None:
    def run(spark, sf):
        return B.fragments(spark, sf).select("page_id", expression(F.col("text")).alias(out))

    QUERIES[name] = run


on_documents("lower_text", F.lower, "lowered")
on_documents("strip_special", X.strip_special, "stripped")
on_documents("strip_punct_digits", X.strip_punct_digits, "stripped")
on_documents("langid_clean", language.langid_text, "letters")
on_fragments("strip_html", X.strip_html, "stripped")
on_fragments("strip_urls", X.strip_urls, "stripped")


@query
def abbreviations(spark, sf):
    return sentences.learn_abbreviations(B.documents(spark, sf, "text")).select("word", F.round("score", 6).alias("score"))


@query
def sentence_counts(spark, sf):
    """Sentences of web pages and documents without markup, by the abbreviations of the documents."""
    learnt = stored(sentences.learn_abbreviations(B.documents(spark, sf, "text")))
    pages = B.fragments(spark, sf).select(F.concat(F.lit("page-"), "page_id").alias("id_post"), X.strip_html(F.col("text")).alias("text"))
    rows = B.documents(spark, sf, "text").unionByName(pages)
    return sentences.sentence_count(rows, learnt).select("id_post", *long("sentences"))


@query
def clean_text(spark, sf):
    return clean.clean_text(B.fragments(spark, sf)).select("page_id", "cleaned_text")


@query
def clean_entities(spark, sf):
    """Cleaning of texts in which names of characters, known and unknown, stand between the words."""
    c = F.col("text")
    for at, name in ((" the ", " AT&T; "), (" of ", " &copy of&nbsp;"), (" de ", " &#x41;&#66;d&eacute; &amp;lt; "), (". ", " R&D; &fjlig;&notin; &copyx &#9 ")):
        c = F.replace(c, F.lit(at), F.lit(name))
    return clean.clean_text(B.documents(spark, sf, "text").withColumn("text", c)).select("id_post", "cleaned_text")


@query
def tokenize(spark, sf):
    rows = clean.clean_text(B.documents(spark, sf, "text"))
    return rows.select("id_post", F.array_join(clean.tokenize(F.col("cleaned_text")), " ").alias("tokens"))


def tokens_of(spark, sf):
    rows = clean.clean_text(B.documents(spark, sf, "text"))
    return rows.select("id_post", clean.tokenize(F.col("cleaned_text")).alias("tokens"))


@query
def remove_stopwords(spark, sf):
    kept = X.drop_words(F.col("tokens"), STOP_WORDS)
    return tokens_of(spark, sf).select("id_post", F.array_join(kept, " ").alias("tokens"))


@query
def remove_stopwords_table(spark, sf):
    unwanted = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    rows = lemma.drop_listed(tokens_of(spark, sf), unwanted, max_keys=0)
    return rows.select("id_post", F.array_join("tokens", " ").alias("tokens"))


@query
def lemmatize_rules(spark, sf):
    return tokens_of(spark, sf).select("id_post", F.array_join(clean.lemmatize(F.col("tokens")), " ").alias("tokens"))


def lemmas_in_use(spark, sf) -> DataFrame:
    """The words of the benchmark texts serve as the table of known nouns."""
    nouns = (
        clean.clean_text(B.table(spark, sf, "benchmark"))
        .select(F.explode(F.split("cleaned_text", " ")).alias("noun")).distinct()
    )
    return lemma.build_lemmas(tokens_of(spark, sf).select(F.explode("tokens").alias("form")), nouns)


@query
def lemmatize_dict(spark, sf):
    rows = lemma.lemmatize_dict(tokens_of(spark, sf), lemmas_in_use(spark, sf))
    return rows.select("id_post", F.array_join("tokens", " ").alias("tokens"))


@query
def preprocess_dict(spark, sf):
    """Cleaning with a stop list and lemmas from tables, by both ways of looking words up."""
    stops = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    lemmas, rows = stored(lemmas_in_use(spark, sf)), B.documents(spark, sf, "text")
    small = clean.preprocess(rows, "text", stops, lemmas).select("id_post", "processed_text", F.lit("constant").alias("way"))
    joined = clean.preprocess(rows, "text", stops, lemmas, 0).select("id_post", "processed_text", F.lit("join").alias("way"))
    return small.union(joined)


@query
def tokens_final(spark, sf):
    return tokens_of(spark, sf).select(
        "id_post", F.array_join(clean.keep_long(clean.lemmatize(X.drop_words(F.col("tokens"), STOP_WORDS))), " ").alias("tokens")
    )


@query
def processed_text(spark, sf):
    return cleaned(spark, sf).select("id_post", "processed_text")


@query
def preprocess(spark, sf):
    """The flagship: cleaning of documents and of web pages."""
    pages = B.fragments(spark, sf).select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("id_post"), "text")
    rows = clean.preprocess(B.documents(spark, sf, "text").unionByName(pages))
    return rows.select("id_post", "cleaned_text", "processed_text", *long("word_count"))


@query
def analyze_terms(spark, sf):
    return B.documents(spark, sf, "text").select(
        "id_post", F.array_join(docs.analyze_terms(F.col("text")), " ").alias("terms")
    )


@query
def match_terms(spark, sf):
    rows = B.documents(spark, sf, "text")
    both = docs.match_terms(rows, "text", ["which", "from"], "all").select("id_post", F.lit("all").alias("how"))
    return both.unionByName(docs.match_terms(rows, "text", ["Elle", "Nicht"]).select("id_post", F.lit("any").alias("how")))


# --- language -----------------------------------------------------------------


@query
def language_guards(spark, sf):
    letters = language.langid_text(F.col("text"))
    return B.turns(spark, sf).select("id_post", language.too_short(letters).alias("is_short"))


@query
def language_confidence(spark, sf):
    letters = language.langid_text(F.col("text"))
    return B.turns(spark, sf).select(
        "id_post", language.language_confidence(language.blank_words(letters)).alias("confidence")
    )


@query
def train_language_profiles(spark, sf):
    return profiles(spark, sf)


@query
def detect_language(spark, sf):
    rows = language.detect_language(B.documents(spark, sf, "text"), published_profiles(spark, sf), "text")
    return rows.select("id_post", "language_detection.language", "language_detection.confidence")


@query
def detect_language_joined(spark, sf):
    """The same by the join that serves profiles of any size."""
    rows = language.detect_language(B.documents(spark, sf, "text"), published_profiles(spark, sf), "text", max_keys=0)
    return rows.select("id_post", "language_detection.language", "language_detection.confidence")


@query
def detect_language_words(spark, sf):
    rows = language.detect_language_words(B.documents(spark, sf, "text"), "text")
    return rows.select("id_post", "language_detection.language", "language_detection.confidence")


# --- sentiment ----------------------------------------------------------------


@query
def exact_round(spark, sf):
    x = "l_extendedprice * (1D - l_discount) / 97D"
    return B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.exact_round(x).alias("rounded"), numbers.exact_round(f"-({x})", 2).alias("negative")
    )


def scored(spark, sf):
    return sentiment.score_sentiment(cleaned(spark, sf), B.lexicon(spark))


@query
def polarity_scores(spark, sf):
    return scored(spark, sf).select(
        "id_post", "textblob_sentiment.polarity", "textblob_sentiment.subjectivity",
        F.col("textblob_sentiment.sentiment_label").alias("polarity_label"),
    )


@query
def valence_scores(spark, sf):
    v = "vader_sentiment."
    return scored(spark, sf).select(
        "id_post", v + "compound", v + "positive", v + "neutral", v + "negative",
        F.col(v + "sentiment_label").alias("valence_label"),
    )


@query
def lookup_ways(spark, sf):
    """Scores and language of posts whose ids are doubled or null, by the constant and by the join."""
    turn = F.col("turn")
    rows = B.spread(B.table(spark, sf, "conversations")).select(
        F.when(turn % 3 > 0, F.col("conv_id").cast("string")).alias("id_post"), F.concat_ws("-", "conv_id", "turn").alias("row"), "text"
    )
    # Every fourth conversation's opening is there twice.
    cleaned = clean.preprocess(rows.union(rows.where("row LIKE '%0-0'")))
    ways = []
    for way, keys in (("constant", lookup.MAX_KEYS), ("join", 0)):
        found = enrich.enrich(cleaned, B.lexicon(spark), published_profiles(spark, sf), max_keys=keys)
        ways.append(flat_results(found.withColumn("id_post", F.concat_ws("/", "row", "id_post"))).withColumn("way", F.lit(way)))
    return ways[0].union(ways[1])


@query
def valence_scores_joined(spark, sf):
    """The same by the join that serves lexicons of any size."""
    rows = sentiment.score_sentiment(cleaned(spark, sf), B.lexicon(spark), max_keys=0)
    v = "vader_sentiment."
    return rows.select(
        "id_post", v + "compound", v + "positive", v + "neutral", v + "negative",
        F.col(v + "sentiment_label").alias("valence_label"),
    )


def shouted(c: Column) -> Column:
    """Raw texts with capitals, marks and a picture, made of words that are there."""
    for at, given in ((" the ", " THE "), (" de ", " DE! "), (" la ", ' "la", '), (" of ", " st (of)? "), (" to ", " 😊 ")):
        c = F.replace(c, F.lit(at), F.lit(given))
    return c


@query
def valence_of_raw_texts(spark, sf):
    """The single scorer on texts as they are, emoji spelled, capitals and marks included."""
    rows = B.documents(spark, sf, "text").withColumn("text", shouted(F.col("text")))
    found = sentiment.valence_scores(rows, B.lexicon(spark), emoji=stored(emoji.emoji_names(spark)))
    v = "vader_sentiment."
    return found.select("id_post", v + "compound", v + "positive", v + "neutral", v + "negative", F.col(v + "sentiment_label").alias("valence_label"))


@query
def polarity_of_raw_texts(spark, sf):
    rows = B.documents(spark, sf, "text").withColumn("text", shouted(F.col("text")))
    found = sentiment.polarity_scores(rows, B.lexicon(spark))
    p = "textblob_sentiment."
    return found.select("id_post", p + "polarity", p + "subjectivity", F.col(p + "sentiment_label").alias("polarity_label"))


@query
def sentiment_labels(spark, sf):
    x = "(value / 100D - 0.2D)"
    return B.table(spark, sf, "events").select(
        "event_id",
        F.expr(sentiment.polarity_label(x)).alias("polarity_label"),
        F.expr(sentiment.valence_label(x)).alias("valence_label"),
    )


@query
def consensus(spark, sf):
    rows = scored(spark, sf)
    return rows.select(
        "id_post", "sentiment_consensus.final_sentiment", F.col("sentiment_consensus.confidence").alias("sentiment_confidence"),
        "sentiment_consensus.final_score",
    )


@query
def enrich_posts(spark, sf):
    return flat_results(enriched(spark, sf))


# --- reports ------------------------------------------------------------------


@query
def total_docs(spark, sf):
    return report.total_docs(B.table(spark, sf, "documents"))


@query
def stage_counts(spark, sf):
    return report.stage_counts(B.posts(spark, sf, "processed", "nlp_processed"))


@query
def label_counts(spark, sf):
    return report.counts(B.posts(spark, sf, "label"), "label")


@query
def word_stats(spark, sf):
    rows = clean.preprocess(B.posts(spark, sf, "text", "processed"))
    return report.word_stats(rows).select("avg_word_count", *long("min_word_count", "max_word_count"), "avg_display")


@query
def language_counts(spark, sf):
    return report.top_counts(flat(spark, sf), "langue", 10)


@query
def sentiment_counts(spark, sf):
    return report.top_counts(flat(spark, sf), "sentiment")


@query
def terms_sentiment(spark, sf):
    return report.terms(flat(spark, sf), "sentiment")


@query
def terms_language(spark, sf):
    return report.terms(flat(spark, sf), "langue")


@query
def dash_language_share(spark, sf):
    return report.share_with_other(flat(spark, sf), "langue", 2)


@query
def dash_type_counts(spark, sf):
    return report.counts(flat(spark, sf), "type_harcelement")


@query
def dash_sentiment_share(spark, sf):
    return report.sentiment_share(flat(spark, sf))


@query
def dash_negative_total(spark, sf):
    return report.negative_total(flat(spark, sf))


@query
def dash_lang_sentiment(spark, sf):
    return report.language_by_sentiment(flat(spark, sf))


@query
def dash_lang_sentiment_long(spark, sf):
    return report.language_sentiment_counts(flat(spark, sf))


@query
def dash_cube(spark, sf):
    return report.dashboard(flat(spark, sf))


@query
def ingest_accounting(spark, sf):
    raw = B.turns(spark, sf)
    named = raw.select("text", F.col("id_post").alias("label"), F.col("id_post").alias("type"))
    return ingest.ingest_accounting(raw, ingest.make_posts(named, RUN_TS))


# --- streams ------------------------------------------------------------------


@query
def incremental_clean(spark, sf):
    folder = incremental.shared_folder(spark)
    schema = B.table(spark, sf, "documents").schema
    incremental.incremental_clean(spark, f"{sf}/documents.parque[t]", schema, f"{folder}/out", f"{folder}/checkpoint", key="doc_id")
    rows = incremental.read_results(spark, f"{folder}/out", "doc_id")
    return rows.select("doc_id", "processed_text", *long("word_count"))


@query
def incremental_nlp(spark, sf):
    folder = incremental.shared_folder(spark)
    cleaned(spark, sf).write.parquet(f"{folder}/clean")
    schema = spark.read.parquet(f"{folder}/clean").schema
    incremental.incremental_nlp(
        spark, f"{folder}/clean", schema, f"{folder}/out", f"{folder}/checkpoint",
        B.lexicon(spark), published_profiles(spark, sf),
    )
    return flat_results(incremental.read_results(spark, f"{folder}/out"))


QUERIES["enrich"] = QUERIES.pop("enrich_posts")
