"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``. Every query runs to its last
row into a sink that discards it; written intermediate tables are part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tandemtext.plans.queries import QUERIES  # noqa: E402
from tandemtext.session import local_session, scratch_scope  # noqa: E402

HEADLINE = [
    "split_prod",
    "split_full",
    "split_drop_punct",
    "filter_english",
    "english_ratio_lexicon",
    "chunk_manifest",
    "assign_chunks",
    "batch_manifest",
    "translate_strict",
    "assemble_pairs",
    "article_pairs",
    "translation_memory_join",
    "word_language",
    "english_all_words",
    "training_slices",
    "build_vocab",
    "encode_pad",
    "stream_chunk_ingest",
    "scan_json_array",
    "zip_pairs",
    "chunk_articles_by_words",
    "resume_chunks",
    "concat_datasets",
    "abbreviation_matches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    # Start the JVM's readers and compilers before the clock runs.
    QUERIES["split_prod"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        with scratch_scope(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    sentences = QUERIES["split_prod"](spark, folder).count()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "sentences": sentences,
    }
    if "chunk_manifest" in seconds:
        result["sentences_per_sec_article_to_chunk"] = round(sentences / seconds["chunk_manifest"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
