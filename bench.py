"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the local cores.
Every query is computed in full and its rows are discarded; one untimed query warms the session up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import session  # noqa: E402
from checks.spark_queries import QUERIES  # noqa: E402

HEADLINE = [
    "ingest",
    "prepare_evidence",
    "token_noise_report",
    "lexicon_scores",
    "lexicon_hits",
    "mentions",
    "entities_by_video",
    "ner_qa",
    "vocab_cap",
    "tfidf_weights",
    "keywords_desc",
    "anchors",
    "cluster_metrics",
    "strength_quantiles",
    "universe_hash",
    "universe_equal",
    "integrity_gates",
    "cluster_index",
    "cards",
    "embed",
    "kmeans",
]


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    timed(spark, "topic_text", sf_dir)
    seconds = {name: round(timed(spark, name, sf_dir), 3) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
