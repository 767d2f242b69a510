"""Time the headline jobs; prints one JSON line.

Every job runs BENCH_RUNS times (default 3) and its median is reported, so the
first run warms the JVM up. Results are consumed by a ``noop`` write, which
computes every row and column but moves nothing to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import corpora  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from lexispan import TextIndex, table_corpus  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [
    "lines", "tokens", "stopwords_removed", "body_range",
    "document_index", "term_frequency", "term_totals",
    "word_search_spans", "adjacent_spans", "adjacent_lines", "phrase3_spans", "any_of_lines", "none_of_lines",
    "adjacent_with_not_lines", "both_lines_spans", "group_adjacent_spans", "mixed_lengths_spans",
    "word_counts", "phrase_alternatives", "matching_lines_text", "remaining_lines_text", "result_order",
    "results_by_document", "highlighted_lines", "report", "saved_searches",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(job: Callable[[], None]) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for key, value in {
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    folders = iter(lambda: tempfile.mkdtemp(prefix="bench-"), None)
    latest: list[TextIndex] = []

    def state(make: Callable[[SparkSession, str], DataFrame]):
        return table_corpus(make(spark, SF_DIR))

    def build() -> None:
        latest[:] = [TextIndex(spark, next(folders))]
        latest[0].sync(state(corpora.earlier_state)).collect()

    timings["build_index"] = median_time(build)
    timings["sync_unchanged"] = median_time(lambda: latest[0].sync(state(corpora.earlier_state)).collect())
    # Alternates between two states, so every run has new, updated and deleted documents.
    states = iter([corpora.later_state, corpora.earlier_state] * RUNS)
    timings["sync_changed"] = median_time(lambda: latest[0].sync(state(next(states))).collect())

    for name in HEADLINES:
        timings[name] = median_time(lambda: consume(QUERIES[name](spark, SF_DIR)))

    print(json.dumps({
        "metric": "total_median_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(Path(SF_DIR).name.removeprefix("sf") or 0),
        "cpus": int(CPUS),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
