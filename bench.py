"""Headline queries, warm, forced with a no-op write. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

CPUS = os.environ.get("BENCH_CPUS", "8")
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERY_SECONDS = 30

HEADLINE = [
    "B10_strip_tags",
    "B16_chunk_text",
    "B17_repair_json",
    "B23_flatten_summaries",
    "C01_training_window",
    "D01_join_metadata",
    "D02_stratum_count",
    "E01_strata_counts",
    "E02_monthly_documents",
    "E02_document_chunks",
    "E07_quartile_fences",
    "E14_slice_metrics",
    "F04_latest_per_key",
    "G04_nearest_vectors",
    "H02_distinct_rows",
    "I02_range_check",
    "I04_duplicate_rows",
    "I05_personal_data",
    "I09_z_outliers",
    "I18_quality_report",
    "J01_keyword_ratio",
    "J05_lexicon_label",
    "J07_label_model",
    "K02_tag_aspects",
    "L01_stratified_sample",
    "L05_time_split",
    "M01_search_then_filter",
    "M06_hierarchical_summary",
    "M10_feature_skew",
    "M12_batch_scoring",
    "CH2_clean_reviews",
    "CH3_training_chain",
    "CH5_document_chain",
]


def main() -> None:
    from reviewloom import catalog
    from reviewloom.session import local_session

    catalog.load_all()
    spark = local_session(CPUS, os.environ.get("BENCH_MEMORY", "7g"), "bench")
    times = {}
    only = tuple(os.environ.get("BENCH_QUERIES", "").split(",")) if os.environ.get("BENCH_QUERIES") else ("",)
    for name in [n for n in HEADLINE if n.startswith(only)]:
        run = catalog.QUERIES[name]
        taken = []
        # at least one warm run, then more while a query stays below its share of time
        while len(taken) < 2 or (len(taken) <= RUNS and sum(taken) < QUERY_SECONDS):
            start = time.perf_counter()
            run(spark, FOLDER).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        # the first run warms up code generation and the file cache
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(FOLDER.rstrip("/"))}))


if __name__ == "__main__":
    main()
