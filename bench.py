"""Benchmark: three jobs on $BENCH_SF_DIR, local[$BENCH_CPUS]; prints one JSON line.

* worklist      - warehouse scan -> cells -> grain profiles -> numbered work list
* forecast_hw   - work list -> series -> baseline + grid Holt-Winters -> record
* forecast_all  - same with all four models and the JSON documents (the boosters with all their rounds)

Each job is materialised with a ``noop`` write (a ``count`` would let the
optimiser prune the model folds). One warm-up pass over all three jobs
precedes the timed pass.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from demand.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="demand-bench")
    from demand.operators import facts, worklist as W
    from demand.plans import forecast_job
    from demand.sources.testdata import TESTDATA_AS_OF, TESTDATA_CUTOFF, warehouse_from_testdata

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def wl_job():
        wh = warehouse_from_testdata(spark, sf_dir)
        cells = facts.cells(wh, TESTDATA_AS_OF)
        wl = W.worklist(cells, TESTDATA_CUTOFF)
        noop(wl)
        return cells, wl

    def run_all():
        times = {}
        t = time.time()
        cells, wl = wl_job()
        times["worklist"] = time.time() - t
        t = time.time()
        noop(forecast_job.forecast_record(cells, wl, models="hwexsmooth"))
        times["forecast_hw"] = time.time() - t
        t = time.time()
        noop(forecast_job.forecast_record(cells, wl))
        times["forecast_all"] = time.time() - t
        return times, wl

    run_all()  # warm-up pass over every job (JVM JIT, codegen caches, Python workers)
    times, wl = run_all()
    n_series = wl.count()
    from demand.operators.models import boosted
    rounds, tasks = boosted.MAX_ITER, -(-n_series // boosted.SERIES_PER_TASK)

    out = {"metric": "total_job_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in times.items()},
           "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
           "boosting": {"rounds": rounds, "tasks_at_most": tasks}, "series": n_series, "series_per_sec_all_models": round(n_series / times["forecast_all"], 2)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
