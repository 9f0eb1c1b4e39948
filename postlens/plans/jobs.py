"""The four batch runs: ingest, clean, enrich, index.

Each run is one plan from a table of a store to another table of it (see
``sources.manifest``) and ends with one commit, so a run that is lost leaves the
tables as they were. Clean and enrich take the posts that are new or whose text
changed; a reset does all again and, in the same commit, empties what was built
on the table. Rows that fail a check are written in the same pass beside the
others, with the reason, and join the table ``quarantine``. Each run returns what it
counted while it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlens.functions import lookup
from postlens.functions.wordlists import STOP_WORDS
from postlens.operators import clean, docs, enrich, ingest, state
from postlens.schema import INDEX_SCHEMA
from postlens.sources import csv, manifest, store

POSTS, CLEAN, ENRICHED, INDEX, QUARANTINE = "posts", "clean", "enriched", "index", "quarantine"
STATE, OK, REJECTED = "_state", "ok", "rejected"
VERSION, REASON = "_version", "_reason"

Stage = Callable[[DataFrame], DataFrame]


def write_apart(df: DataFrame, root: str, table: str, partition_by: Iterable[str] = ()) -> tuple[list[str], list[str], dict[str, int]]:
    """Write ``df`` in one pass, rows with a ``REASON`` apart from the others.

    Returns the folders of either kind, and the numbers ``written`` and ``failed`` of the pass.
    """
    seen = Observation()
    reason = F.col(REASON)
    counted = df.observe(seen, F.count_if(reason.isNull()).alias("written"), F.count_if(reason.isNotNull()).alias("failed"))
    state_of = F.when(reason.isNull(), OK).otherwise(REJECTED)
    folder = manifest.write(counted.withColumn(STATE, state_of), root, table, [STATE, *partition_by])
    parts = manifest.subfolders(df.sparkSession, root, folder)
    of = lambda kind: [f for f in parts if f.endswith(f"{STATE}={kind}")]
    return of(OK), of(REJECTED), {k: seen.get.get(k, 0) for k in ("written", "failed")}


def checked(df: DataFrame, stage: str, *checks: tuple[str, Column]) -> DataFrame:
    """``df`` with the first reason against a row; ``checks`` are reasons and when they hold."""
    tests = [(f"{stage}:missing_id", F.col("id_post").isNull()), *((f"{stage}:{name}", test) for name, test in checks)]
    found = F.coalesce(*[F.when(test, name) for name, test in tests])
    return df.withColumn(REASON, F.coalesce(F.col(REASON), found) if REASON in df.columns else found)


def results(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The newest result for each post, or None before the first run."""
    found = manifest.table(spark, root, table)
    return None if found is None else state.latest_rows(found, "id_post", [VERSION]).drop(VERSION, REASON)


def quarantine(spark: SparkSession, root: str) -> DataFrame | None:
    """Rejected rows of all runs: stage and reason, id, the start of the row as JSON."""
    found = manifest.table(spark, root, QUARANTINE)
    if found is None:
        return None
    rest = [c for c in found.columns if c not in (VERSION, REASON)]
    preview = F.substring(F.to_json(F.struct(*rest)), 1, docs.PREVIEW_LENGTH)
    key = F.col("id_post") if "id_post" in rest else F.lit(None).cast("string")
    return found.select(key.alias("id"), F.col(REASON).alias("reason"), preview.alias("preview"))


def ingest_run(spark: SparkSession, csv_path: str, root: str, run_ts: datetime | None = None) -> dict[str, int]:
    """CSV to the table of posts, replacing it; records with more fields than the header are rejected.

    Nothing is committed if posts share an id or if there are none.
    """
    seen = Observation()
    broken = F.when(F.col(csv.CORRUPT).isNotNull(), "ingest:surplus_fields")
    raw = csv.read_csv(spark, csv_path)
    roles = csv.resolve_roles(raw.columns)
    rows = csv.select_roles(raw, roles, csv.CORRUPT).withColumn(REASON, broken)
    # The file is read once: what it holds is set down as it is, and posts are made of that.
    good, bad, failed = write_apart(rows.observe(seen, *ingest.loaded_counts(F.col("text"))), root, "raw")
    if not good:
        raise store.EmptyTable(root)
    posts = ingest.make_posts(manifest.load(spark, root, good).drop(csv.CORRUPT, REASON), run_ts)
    folder = manifest.write(posts.sortWithinPartitions("label", "type"), root, POSTS)
    written = spark.read.parquet(f"{root}/{folder}")
    created = written.count()  # from the footers
    if not created:
        raise store.EmptyTable(root)
    ingest.require_unique(written)

    def change(tables: manifest.Tables) -> manifest.Tables:
        return {**tables, POSTS: [folder], QUARANTINE: tables.get(QUARANTINE, []) + bad}

    manifest.commit(spark, root, change)
    for f in good:
        manifest.delete(spark, root, f)
    return {**seen.get, "created": created, "failed": failed["failed"]}


def current_places(spark: SparkSession, root: str, table: str) -> tuple[DataFrame, DataFrame | None] | None:
    """The rows of ``table`` as ``state.placed``, and the places of those that are not the result of a post as it is now.

    Keys, digests and places alone are joined; what goes is left out by place, so that no text is shuffled.
    """
    found, posts = manifest.table(spark, root, table), manifest.table(spark, root, POSTS)
    if found is None:
        return None
    if "content_digest" not in found.columns:
        found = found.withColumn("content_digest", state.content_digest(F.col("text")))
    rows = state.placed(found)
    if table == POSTS:
        return rows, None
    gone = state.replaced(rows, "id_post", [VERSION])
    if posts is not None:
        held = posts.select("id_post", state.content_digest(F.col("text")))
        gone = gone.union(state.matched(rows, held, "left_anti").select(state.PLACE))
    return rows, gone


def current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The results of ``table`` that belong to a post as it is now."""
    found = current_places(spark, root, table)
    return None if found is None else state.without(*found).drop(*state.PLACE, VERSION, REASON)


def pending(spark: SparkSession, root: str, source: str, done: DataFrame | None) -> DataFrame | None:
    """The posts of ``source`` that have no result in ``done`` for their text."""
    found = current_places(spark, root, source)
    if found is None:
        return None
    rows, gone = found
    if done is not None:
        again = state.matched(rows, done.select("id_post", "content_digest"), "left_semi").select(state.PLACE)
        gone = again if gone is None else gone.union(again)
    kept = rows if gone is None else state.without(rows, gone)
    return kept.drop(*state.PLACE) if source == POSTS else kept.drop(*state.PLACE, VERSION, REASON)


def run_stage(
    spark: SparkSession, root: str, source: str, table: str, dependents: list[str], stage: Stage, reset: bool
) -> dict[str, int]:
    """Run ``stage`` on the posts of ``source`` that have no result in ``table`` for their text, and add the results."""
    rows = pending(spark, root, source, None if reset else results(spark, root, table))
    if rows is None:
        raise FileNotFoundError(f"{root}: {source}")
    started = manifest.read(spark, root)
    seen = Observation()
    staged = rows.observe(seen, F.count(F.lit(1)).alias("pending")).transform(stage)
    found = checked(staged, table).withColumn(VERSION, F.lit(started.number + 1).cast("long"))
    good, bad, counts = write_apart(found, root, table)

    def change(tables: manifest.Tables) -> manifest.Tables:
        tables[table] = ([] if reset else tables.get(table, [])) + good
        tables[QUARANTINE] = tables.get(QUARANTINE, []) + bad
        for name in dependents if reset else ():
            tables[name] = []
        return tables

    if good or bad or reset:
        manifest.commit(spark, root, change)
    return {"pending": seen.get.get("pending", 0), **counts}


def clean_run(
    spark: SparkSession,
    root: str,
    run_ts: datetime | None = None,
    reset: bool = False,
    stop_words: Iterable[str] | DataFrame = STOP_WORDS,
    lemmas: DataFrame | None = None,
    max_keys: int = lookup.MAX_KEYS,
) -> dict[str, int]:
    """Clean the posts that are new or changed; ``reset`` cleans all again and drops the enrichment."""
    stage = lambda df: state.mark_clean(clean.preprocess(df, "text", stop_words, lemmas, max_keys), run_ts)
    return run_stage(spark, root, POSTS, CLEAN, [ENRICHED], stage, reset)


def enrich_run(
    spark: SparkSession,
    root: str,
    terms: DataFrame,
    profiles: DataFrame | None = None,
    run_ts: datetime | None = None,
    reset: bool = False,
    max_keys: int = lookup.MAX_KEYS,
    scorer: Stage | None = None,
) -> dict[str, int]:
    """Enrich the cleaned posts that are new or changed; ``reset`` enriches all again.

    ``scorer`` is one more stage, as ``scorer.scoring`` makes it of a function of the caller's.
    """

    def stage(df: DataFrame) -> DataFrame:
        found = enrich.enrich(df, terms, profiles, max_keys)
        return state.mark_nlp(found if scorer is None else scorer(found), run_ts)

    return run_stage(spark, root, CLEAN, ENRICHED, [], stage, reset)


def index_run(spark: SparkSession, root: str, partition_by: list[str] | None = None) -> dict[str, int]:
    """Write the newest finished posts as search documents, replacing the index, which keeps one document for each id.

    ``report`` and ``store.store_stats`` read the result.
    """
    enriched = current(spark, root, ENRICHED)
    if enriched is None:
        raise FileNotFoundError(f"{root}: {ENRICHED}")
    flat = store.to_schema(docs.flatten_docs(state.ready_docs(enriched)), INDEX_SCHEMA)
    good, bad, counts = write_apart(checked(flat, INDEX), root, INDEX, partition_by or ())
    if not good:
        raise store.EmptyTable(root)

    def change(tables: manifest.Tables) -> manifest.Tables:
        return {**tables, INDEX: good, QUARANTINE: tables.get(QUARANTINE, []) + bad}

    manifest.commit(spark, root, change)
    return {"indexed": counts["written"], "failed": counts["failed"]}


def index_docs(spark: SparkSession, root: str) -> DataFrame:
    """The search documents as they are now."""
    return store.read_published(spark, root, INDEX).drop(REASON)
