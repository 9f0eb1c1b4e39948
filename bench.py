"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (cores). Each query is run
twice on whole tables and the second time counts. A time includes building the
plan and, for the queries that need one, training the language profile.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import tables as B  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from postlens.operators import clean, docs, language  # noqa: E402
from postlens.plans import jobs  # noqa: E402
from postlens.streaming import incremental  # noqa: E402

HEADLINE = [
    "make_posts", "post_ids", "preprocess", "train_language_profiles", "detect_language",
    "polarity_scores", "valence_scores", "enrich", "flatten_docs", "last_write_wins", "upsert_clean",
    "word_stats", "dash_lang_sentiment", "dash_language_share", "stage_counts",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def runs_with_writes(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of the batch runs from a CSV file to the index, each with its writes, commit and counts."""
    folder = incremental.shared_folder(spark)
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", quoted, "lang", "source")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = B.documents(spark, sf_dir, "text", "lang", "source")
    rows.select(F.when(first, F.concat(F.lit("text,label,type\n"), line)).otherwise(line)).write.text(f"{folder}/csv")
    profiles = QUERIES["train_language_profiles"](spark, sf_dir)
    profiles.write.parquet(f"{folder}/profiles")
    profiles, root, times = spark.read.parquet(f"{folder}/profiles"), f"{folder}/store", {}
    for name, run in (
        ("ingest", lambda: jobs.ingest_run(spark, f"{folder}/csv", root)),
        ("clean", lambda: jobs.clean_run(spark, root)),
        ("enrich", lambda: jobs.enrich_run(spark, root, B.lexicon(spark), profiles)),
        ("index", lambda: jobs.index_run(spark, root)),
    ):
        start = time.perf_counter()
        run()
        times[name] = time.perf_counter() - start
    return {**times, "all": sum(times.values())}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, sf_dir)  # noqa: B023
        timed(run)
        times[name] = round(timed(run), 3)

    n_docs = B.table(spark, sf_dir, "documents").count()
    tokens = clean.clean_text(B.documents(spark, sf_dir, "text")).agg(
        F.sum(language.blank_words(F.col("cleaned_text")))
    ).first()[0]
    rate = lambda seconds: {"docs_per_sec": round(n_docs / seconds), "tokens_per_sec": round(tokens / seconds)}
    # Indexing alone: flat documents from the stored enriched ones.
    root = B.spread(B.table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("id_post"), F.lower("text").alias("original_text"),
        F.lower("text").alias("processed_text"), "lang",
    ).cache()
    root.count()
    timed(lambda: docs.flatten_docs(root))
    indexing = timed(lambda: docs.flatten_docs(root))
    written = runs_with_writes(spark, sf_dir)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "documents": n_docs,
        "tokens": int(tokens),
        "throughput": {
            "ingest": rate(times["make_posts"]), "clean": rate(times["preprocess"]),
            "enrich": rate(times["enrich"]), "index": rate(indexing), "all_stages": rate(times["flatten_docs"]),
        },
        "runs_with_writes": {name: {"sec": round(sec, 3), **rate(sec)} for name, sec in written.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
