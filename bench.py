"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[BENCH_CPUS]``. Each query is written to the ``noop`` sink, so that every
row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from evenkeel.queries import REGISTRY
from evenkeel.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = (
    "join_labels clean_text keyword_class class_weights ngrams term_counts encode_sequences hash_rank undersample "
    "oversample balance_classes source_mix stratified_folds stratified_split smote confusion_lineitem "
    "classification_report cv_summary soft_vote multiplier_scores tfidf_vocabulary tfidf_documents max_cosine "
    "early_stopping running_mean top_n_per_class keyword_augmentation mixed_augmentation semantic_augmentation "
    "prepare tfidf_folds boosted_folds"
).split()


def main(names: list[str]) -> None:
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="evenkeel-bench-"),
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the Python workers and the code generator before the clock runs
    REGISTRY["embed_with_encoder"].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
