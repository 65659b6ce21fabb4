"""Benchmark of the headline analyses.

Runs each query on the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], forcing full evaluation with the no-op sink, and prints one
JSON line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf"}.
$BENCH_REPS (default 3) timed runs follow one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "site_tags": "ag07_fill_tags",
    "hwe_exact": "ag08_hardy_controls",
    "annotate_exact": "jn10_annotate_exact",
    "annotate_overlap": "jn11_annotate_overlap",
    "or_filter": "flt09_named_or_filter",
    "carriers_per_gene": "flagship_gene_carriers",
    "bh_all_p": "wn12_bh_adjust",
    "manhattan": "dp2_manhattan",
    "grm": "st01_grm",
    "ld_prune": "st02_ld_prune",
    "glm_linear": "st04b_glm_linear",
    "set_test_skato": "st08_skato",
    "stage_dates": "ag02_mitos_stage_dates",
    "kings_staging": "fn15_kings_stage",
    "mitos_staging": "fn14_mitos_stage",
    "decay_fit": "st11_fit_d50",
    "glm_logistic": "st05_glm_logistic",
    "rare_variant_flow": "e3_rare_variant_association",
    "annotate_scores": "jn12_annotate_scores",
    "read_vcf": "src01_read_vcf_per_sample",
    "write_vcf": "snk02_write_vcf",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]

    from genoframe.plans.registry import load_all
    from genoframe.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    cat = load_all()
    times: dict[str, float] = {}
    for label, name in HEADLINE.items():
        if only and label not in only:
            continue
        fn = cat[name][0]
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                runs.append(dt)
        times[label] = round(statistics.median(runs), 3)
        print(f"# {label} ({name}): {times[label]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
