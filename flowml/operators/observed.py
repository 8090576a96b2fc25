"""Metrics collected while predictions are written (E3, E4, E6-E9): no pass of their own.

The (label, prediction) counts are observed in the job that writes the predictions, so nothing is
read again. They are the pair table of :mod:`flowml.operators.metrics`, from which every metric
derives. Classes are listed: one counter a pair, and one for all rows, so that rows with
a label or prediction outside the list are noticed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flowml.operators.sampling import literal_table


def write_observed(df: DataFrame, path: str, classes: Sequence[float], label: str = "label",
                   pred: str = "prediction", fmt: str = "parquet", mode: str = "overwrite",
                   outside: str = "error") -> DataFrame:
    """Write ``df`` and return its (label, prediction, n) counts, pairs without rows left out.

    ``outside``: what to do about rows with a null or unlisted label or prediction: "error"
    (raised once the table is written) or "ignore" (written, not counted).
    """
    if outside not in ("error", "ignore"):
        raise ValueError("outside must be 'error' or 'ignore'")
    values = [float(c) for c in classes]
    pairs = {f"c{i}_{j}": (a, b) for i, a in enumerate(values) for j, b in enumerate(values)}
    actual, given = F.col(label).cast("double"), F.col(pred).cast("double")
    counters = [F.count_if((actual == a) & (given == b)).alias(n) for n, (a, b) in pairs.items()]
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("total"), *counters).write.mode(mode).format(fmt).save(path)
    got = seen.get
    rows = [(a, b, got.get(n, 0)) for n, (a, b) in pairs.items() if got.get(n, 0)]
    missed = got.get("total", 0) - sum(r[2] for r in rows)
    if missed and outside == "error":
        raise ValueError(f"{missed} rows with a label or prediction outside the listed classes")
    return literal_table(df.sparkSession, "label double, prediction double, n long", rows)
