"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpusloom.plans import catalog
from corpusloom.session import local_session

HEADLINE = (
    "usenet_merge corpus_group_stats tokens_clean ngrams_bigram term_totals doc_freq dtm_counts "
    "tfidf tfidf_totals top_terms_per_group tfidf_project_test kruskal_h wordvec_tf_mean "
    "cluster_internal_stats cluster_silhouette sim_cosine keywords_per_group"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    catalog.load()
    spark.read.parquet(f"{sf}/documents.parquet").count()  # start-up is not a query
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": sf,
            }
        )
    )


if __name__ == "__main__":
    main()
