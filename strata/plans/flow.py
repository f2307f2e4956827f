"""A reusable load -> named steps -> save object.

Row counts per step are complete counts: a count observed inside the final
job would stop short wherever a later step (a limit, a join with nothing)
stops reading.  They take one pass over the data where every step reads all
its input, once: one job observes the rows between the steps.  A step that may
stop reading early, or that reads its input twice, starts a pass of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.csv import read_csv

Step = tuple[str, Callable[[DataFrame], DataFrame]]


#: Operators of a plan that read all their input, and once.  A range exchange (a sort, a repartition by range) is none of
#: them: it samples its input first, in a job of its own, so rows before it would be observed twice.
_READ_ALL = {
    "Aggregate",
    "CollectMetrics",
    "Deduplicate",
    "Distinct",
    "Filter",
    "Generate",
    "Project",
    "RebalancePartitions",
    "Repartition",
    "SubqueryAlias",
    "Window",
}


def _reads_all(before: DataFrame, after: DataFrame) -> bool:
    """Does ``after`` read every row of ``before`` once?  False where that is not certain."""
    try:
        source, node = before._jdf.queryExecution().analyzed(), after._jdf.queryExecution().analyzed()
        while not node.equals(source):
            if node.nodeName() not in _READ_ALL or node.children().size() != 1:
                return False
            node = node.children().head()
        return True
    except Exception:  # no access to plans in this session
        return False


def _total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def _observed(spark: SparkSession, names: list[str], frame: DataFrame) -> list[int | None]:
    """Run ``frame``; the observed counts, None where one is missing or not certain."""
    group, context = f"step-counts-{uuid.uuid4().hex}", spark.sparkContext
    saved = [(key, context.getLocalProperty(key)) for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")]
    context.setJobGroup(group, "row counts of steps")
    try:
        (last,) = frame.collect()
    finally:
        for key, value in saved:
            context.setLocalProperty(key, value)
    if len(names) == 1:
        return [last["rows"]]
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    if any(s is None or s.currentAttemptId or s.numFailedTasks for s in stages):
        return [None] * len(names)
    metrics = frame._jdf.queryExecution().observedMetrics()
    # a step whose input the optimizer proves empty is not run, so nothing is observed there
    found = [int(metrics.apply(name).getLong(0)) if metrics.contains(name) else None for name in names]
    return [*found[:-1], last["rows"]]


class Flow:
    """Session + raw-file root + layer store, with step counts."""

    def __init__(self, spark: SparkSession, raw_root: str, store):
        self.spark = spark
        self.raw_root = raw_root.rstrip("/")
        self.store = store
        self._runs: list[tuple[list[tuple[str, DataFrame]], list]] = []

    def read_csv(self, file_name: str, infer_schema: bool = True, header: bool = True, schema=None, **options) -> DataFrame:
        """CSV below the raw root; a missing file raises ``FileNotFoundError``."""
        return read_csv(
            self.spark, f"{self.raw_root}/{file_name}", schema=schema, infer=infer_schema, header=header, **options
        )

    def apply(self, df: DataFrame, steps: Sequence[Step], count_rows: bool = True) -> DataFrame:
        """Apply ``(name, fn)`` steps in order; nothing runs.

        With ``count_rows`` the input and every step's output are remembered
        for :meth:`counts`, which applies the steps once more: they should be
        functions of their frame alone.
        """
        frames = [("input", df)]
        for name, fn in steps:
            df = fn(df)
            frames.append((name, df))
        if count_rows:
            self._runs.append((frames, [None, *(fn for _, fn in steps)]))
        return df

    def passes(self) -> list[tuple[list[str], DataFrame]]:
        """The frames that :meth:`counts` runs: ``(observation names, one-row frame)`` each, in order of steps."""
        out = []
        for frames, fns in self._runs:
            names, cur = [], None
            for k, (_, df) in enumerate(frames):
                if k and not _reads_all(frames[k - 1][1], df):
                    out.append((names, _total(cur)))
                    names, cur = [], None
                names.append(f"rows_{uuid.uuid4().hex[:12]}")
                cur = (df if cur is None else fns[k](cur)).observe(names[-1], F.count(F.lit(1)).alias("rows"))
            out.append((names, _total(cur)))
        return out

    def counts(self) -> list[tuple[str, int]]:
        """``(name, rows)`` of the input and of every step, in order; equal names keep their entries.

        A job that lost tasks may have observed rows twice (a repeated map
        task adds its rows again), so its counts are taken anew, step by step.
        """
        found = [n for names, frame in self.passes() for n in _observed(self.spark, names, frame)]
        plain = [frame for frames, _ in self._runs for frame in frames]
        return [(name, df.count() if n is None else n) for n, (name, df) in zip(found, plain, strict=True)]

    def step_counts(self) -> DataFrame:
        """:meth:`counts` as a frame ``step, name, rows``."""
        rows = [(step, name, n) for step, (name, n) in enumerate(self.counts())]
        return self.spark.createDataFrame(rows, "step int, name string, rows long")

    def save(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", overwrite_schema: bool = False) -> int:
        """Write to ``<root>/<layer>/<table>`` with the given mode; returns rows written."""
        return self.store.write(df, layer, table, mode=mode, overwrite_schema=overwrite_schema)
