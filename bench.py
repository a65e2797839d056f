"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is built and run to the end (all rows produced, none kept). The session and the file
listing are warmed up by one small read first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus_engine.catalog import load
from corpus_engine.session import build_session

HEADLINES = (
    "clean_corpus",
    "prepared_corpus",
    "corpus_overview",
    "length_boxplots",
    "articles_per_month",
    "words_per_language",
    "vocabulary_default",
    "tfidf_weights",
    "new_documents_weights",
    "fit_sample",
    "train_test_split",
    "vote_report",
    "topic_dimension",
    "nearest_topic",
    "density_topic_ids",
    "explaining_words",
    "word_attributions",
    "logistic_scores",
    "scored_articles",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/labels.parquet").count()
    catalog = load()
    times = {}
    for name in names:
        start = time.time()
        catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
