"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Results go to Spark's no-op
sink, so every row and column is computed and nothing is collected.

The tables come as one file with one row group each, which one task reads whatever
``spark.sql.files.maxPartitionBytes`` says, while tables of a corpus have many files. So the tables are
first written as a file per core; this is not timed. No query or setting depends on it.
"""

import json
import os
import sys
import tempfile
import time

from sparkprep.plans.queries import QUERIES
from sparkprep.plans.staging import local_session, table

TABLES = ["documents", "conversations", "events", "embeddings", "labels", "pages", "benchmark"]

HEADLINE = [
    "prepare_training_data",
    "chunk_documents",
    "make_examples",
    "sample_chunks",
    "split_exact",
    "quality_metrics",
    "dataset_summary",
    "section_chunks",
    "token_budget",
    "read_examples",
    "bleu",
    "rouge_n",
    "rouge_l",
    "model_metrics",
    "classification_metrics",
    "embedding_similarity",
    "compare_outputs",
    "rating_violations",
    "prediction_metrics",
    "metric_points",
    "alerts",
    "failure_streaks",
    "trial_running_best",
    "stream_metrics",
]


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cores, partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    scale, folder = os.path.basename(data_dir.rstrip("/")).removeprefix("sf"), tempfile.TemporaryDirectory(prefix="bench-")
    parts = spark.sparkContext.defaultParallelism
    for name in TABLES:
        table(spark, data_dir, name).repartition(parts).write.parquet(f"{folder.name}/{name}.parquet")
    data_dir = folder.name
    for name in names[:1]:  # starts the JVM's file system and code paths
        QUERIES[name](spark, data_dir).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
            }
        )
    )
    spark.stop()
    folder.cleanup()


if __name__ == "__main__":
    main()
