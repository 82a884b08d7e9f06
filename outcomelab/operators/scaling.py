"""Fit-time sweep over training-set sizes."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.operators.resample import bootstrap_resample

TIMINGS = "n_rows bigint, arm string, status string, seconds double, distinct_rows bigint, id_sum bigint"


def scaling_curve(spark: SparkSession, base: DataFrame, id_col: str, sizes: Sequence[int],
                  arms: Mapping[str, Callable[[DataFrame], object]], seed: int = 42) -> DataFrame:
    """Seconds to fit each arm on nested exact-size bootstraps of ``base``.

    Draw i takes the same base row whatever the size, so the largest resample is
    drawn once and a smaller one is its first draws. Each size is dealt to about
    ``ROWS_PER_FIT_TASK`` rows a task and materialised before the clock starts,
    so only the fit is timed. A failed fit has its error as ``status`` and no
    seconds, and the sweep goes on. ``distinct_rows`` and ``id_sum`` describe
    the rows drawn (integer ids). The timings are written to the shared scratch
    folder, and what is returned is read back from there.
    """
    from outcomelab.operators.models import ROWS_PER_FIT_TASK
    from outcomelab.session import scratch_path
    from outcomelab.sources.sinks import write_checked
    top = max(sizes)
    drawn = bootstrap_resample(spark, base, id_col, top, seed=seed) \
        .repartition(max(1, -(-top // ROWS_PER_FIT_TASK))).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        for n in sizes:
            boot = (drawn.where(F.col("draw_id") < n).drop("draw_id")
                    .repartition(max(1, -(-int(n) // ROWS_PER_FIT_TASK))).persist(StorageLevel.MEMORY_AND_DISK))
            try:
                distinct, total = boot.agg(F.count_distinct(id_col), F.sum(id_col)).first()
                for name, fit in arms.items():
                    t0 = time.perf_counter()
                    try:
                        fit(boot)
                        status, seconds = "ok", time.perf_counter() - t0
                    except Exception as e:  # a failed arm is a row without seconds
                        status, seconds = f"{type(e).__name__}: {e}"[:200], None
                    rows.append((int(n), name, status, seconds, int(distinct), int(total)))
            finally:
                boot.unpersist()
    finally:
        drawn.unpersist()
    return write_checked(spark.createDataFrame(rows, TIMINGS), scratch_path(spark, "timings"))
