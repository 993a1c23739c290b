"""Times the headline queries and prints one JSON line.

Every query is run to its last row (``noop`` sink), three times; the fastest run counts.
"""

from __future__ import annotations

import json
import os
import time

from textgauge.session import local_session
from textgauge.workload import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = (
    "J3_lexicon_hits",
    "J3_large_lexicon_hits",
    "A2_row_scores",
    "A3_term_counts",
    "A4_corpus_summary",
    "A5_group_metrics",
    "F4_hit_contexts",
    "K3_flagged_csv",
    "J2_filled_templates",
    "W1_deduplicated_prompts",
    "W2_first_prompts_per_topic",
    "P5_rubric_points",
    "A9_rubric_coverage",
    "A12_group_rates",
    "A16_reweighting",
    "A19_classification_report",
    "A20_roc_auc",
    "A21_roc_corners",
    "W6_stratified_split",
    "W7_stratified_folds",
    "M1_tfidf",
    "M2_logistic_regression",
    "F14_few_shot_prompts",
    "S9_table_digests",
    "A22_run_summary",
)


def main() -> None:
    spark = local_session(CORES, shuffle_partitions=int(CORES))
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
