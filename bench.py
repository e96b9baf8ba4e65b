"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then ``RUNS`` times into a noop sink; its time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"

from tidemark.plans import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = ("valuation_gap", "statements_by_year", "fcf_eps_roe_growth", "bars_5m", "vwap_5m", "volatility", "volume_surge_tod", "price_fx_asof", "news_dedup", "news_sentiment_mix", "macro_yoy")
RUNS = 3


def main() -> None:
    base, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(1 + RUNS):
            began = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(base).name}))
    spark.stop()


if __name__ == "__main__":
    main()
