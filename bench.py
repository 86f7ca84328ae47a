"""Benchmark: load the receipts once, then build every model; one JSON line on stdout.

Like the original pipeline (load the staging table, then build each model from it), the
staging rows are derived from the test tables of ``$BENCH_SF_DIR`` and written once as a
Parquet table bucketed by Reference ("stage"), the Reference check runs once, and each model is
then evaluated in full on the staged table (noop sink: every row is computed, nothing is
collected).

The JVM is warmed first by running the same flow, untimed, on sf0.01 (large enough for the
JIT to compile the hot loops).
``queries`` holds the median of three runs of each step (staging is a full refresh each
time); ``cold`` holds each step's first run. ``daily_job`` times the production job after
staging: every model written as a table in dependency order, each reading the tables written
before it (``plans.build_all``).

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans import MODEL_NAMES, ReceiptModels, build_all  # noqa: E402
from tillroll.session import build_session, local_master  # noqa: E402
from tillroll.sources import receipts_from_tables, stage_receipts  # noqa: E402
from tillroll.sources.staging import reference_is_unique  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.01"


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def _run(spark, sf_dir: str, table: str, repeat: int) -> tuple[dict, dict, bool]:
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    box: dict = {}
    stage_runs = [_timed(lambda: box.__setitem__(
        "t", stage_receipts(receipts_from_tables(spark, sf_dir), table=table)))
        for _ in range(repeat)]
    cold["stage"] = stage_runs[0]
    timings["stage"] = round(statistics.median(stage_runs), 3)
    staged = box["t"]
    check_runs = [_timed(lambda: box.__setitem__("u", reference_is_unique(staged)))
                  for _ in range(repeat)]
    cold["reference_check"] = check_runs[0]
    timings["reference_check"] = round(statistics.median(check_runs), 3)
    models = ReceiptModels(staged, unique_reference=box["u"])
    for name in MODEL_NAMES:
        df = models.table(name)
        runs = [_timed(lambda: df.write.format("noop").mode("overwrite").save())
                for _ in range(repeat)]
        cold[name] = runs[0]
        timings[name] = round(statistics.median(runs), 3)
    return timings, cold, box["u"], staged


def _daily_job(staged, unique: bool, prefix: str) -> dict[str, float]:
    models = ReceiptModels(staged, unique_reference=unique)
    return {name: _timed(lambda: build_all(models, prefix, names=[name]))
            for name in MODEL_NAMES}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    warehouse = tempfile.mkdtemp(prefix="tillroll-bench-")
    spark = build_session(local_master(cpus), app_name="tillroll-bench",
                          shuffle_partitions=cpus,  # one per core: stages at sf0.1 are small
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.warehouse.dir": warehouse})
    spark.sparkContext.setLogLevel("ERROR")

    if os.path.isdir(WARMUP_DIR):
        _run(spark, WARMUP_DIR, "bench_warmup_stg", 1)
    timings, cold, unique, staged = _run(spark, sf_dir, "bench_stg_receipts", repeat)
    daily = _daily_job(staged, unique, "bench_")

    sf_name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "total_model_build_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "cold": cold,
                      "daily_job": {"total": round(sum(daily.values()) + timings["stage"], 3),
                                    "models": daily},
                      "sf": sf, "cpus": cpus,
                      "receipt_local": unique}))
    spark.stop()


if __name__ == "__main__":
    main()
