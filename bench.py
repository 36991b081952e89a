"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peakweave.plans.queries import queries  # noqa: E402
from peakweave.session import build_session  # noqa: E402

HEADLINE = (
    # dataset build
    "regex_delimited_scan", "record_ids_over_splits", "tokenize_sequences", "exact_split_tenth", "matrix_lookup",
    "wide_matrix_scan", "json_shard_export",
    # variant merge
    "variant_merge", "snp_effect",
    # cell preparation
    "gene_quality", "prepare_for_ranking", "prepare_for_binning", "binned_tokens", "rank_tokens", "highly_variable_genes",
    # features
    "pool_sample_cells", "model_features",
    # metrics
    "regression_report", "rank_correlation_continuous", "roc_auc_by_group", "retrieval_report", "bleu", "sari_rows",
    "answer_scores", "entity_report", "character_error_rate", "stream_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 8)))
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"), spark__checkpoint__dir=scratch)
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = queries()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times, failed = {}, {}
    for name in wanted:
        start = time.perf_counter()
        try:
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # a failing query must not hide the others
            failed[name] = str(error)[:200]
            continue
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "lineitem_rows": lineitem,
        "rows_per_sec": {n: round(lineitem / times[n]) for n in (
            "regex_delimited_scan", "record_ids_over_splits", "tokenize_sequences", "variant_merge", "snp_effect",
            "prepare_for_binning", "prepare_for_ranking") if n in times},
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
