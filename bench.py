"""Headline-query benchmark.

Runs the corpus operators at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is forced end to end with the ``noop`` sink (full computation,
no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from quarry.session import get_spark
    from quarry.plans.catalog import QUERIES
    from quarry.sources import tables
    from quarry.operators import tokenizer as tok

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    state = {}

    def run_query(name):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def bpe_train():
        wc = tok.pretoken_counts(tables.documents(spark, sf_dir).select("text"))
        state["model"] = tok.train_bpe(wc, 256 + 3 + 400)

    def bpe_encode():
        model = state.get("model") or tok.train_bpe(
            tok.pretoken_counts(tables.documents(spark, sf_dir).select("text")), 256 + 3 + 64)
        docs = tables.documents(spark, sf_dir).select("doc_id", "text")
        tok.encode(docs, model).write.format("noop").mode("overwrite").save()

    plan = [
        ("curation_summary", run_query("curation_summary")),
        ("gopher_filter", run_query("gopher_filter")),
        ("mask_pii", run_query("mask_pii")),
        ("line_dedup", run_query("line_dedup")),
        ("minhash_dedup", run_query("minhash_dedup")),
        ("pretoken_counts", run_query("pretoken_counts")),
        ("bpe_train_400", bpe_train),
        ("bpe_encode", bpe_encode),
        ("article_records", run_query("article_records")),
        ("html_text", run_query("html_text")),
        ("token_windows", run_query("token_windows")),
    ]
    # Warm the JVM and Python workers once so the first query is not charged.
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name, fn in plan:
        if only and name not in only:
            continue
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
    n_docs = tables.documents(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "docs": n_docs,
           "docs_per_sec": {k: round(n_docs / v, 1) for k, v in times.items() if v > 0}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
