"""Wall-clock time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed
runs per query, of which the median counts; one warm-up run comes before).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from inkstrata.catalog import QUERIES  # noqa: E402
from inkstrata.session import local_session  # noqa: E402

HEADLINE = [
    "n1_public_corpus",
    "n2_private_ingest",
    "n3_question_answering",
    "n4_training_examples",
    "n5_instruction_examples",
    "n6_doc_qa_report",
    "n7_perplexity_report",
    "c4_process_examples",
    "d1_sliding_windows",
    "d3_digest_embedding",
    "e2_search_cosine",
    "f4_bigram_losses",
    "g1_rolling_step_time",
    "h1_top_k",
    "j2_word_counts",
    "j7_encode_words",
    "k1_stream_clean_and_shard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    seconds: dict[str, float] = {}
    for name in wanted:
        taken = []
        for turn in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if turn:
                taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
