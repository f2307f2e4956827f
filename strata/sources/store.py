"""Path-addressed layer store: ``<root>/<layer>/<table>``.

Parquet by default, Delta when the session has it.  A plain Parquet
overwrite deletes the old files before the job runs: a job that fails half
way leaves no table, and a plan that reads the path it replaces loses its
input.  So ``write``:

* refuses, unless asked, to change the schema of an existing table;
* overwrites an existing Parquet table by writing a sibling staging folder
  (same file system, under the layer) and swapping it in only after the
  write job has committed; a failed job leaves the old table untouched, and
  a plan may read the table it replaces;
* counts rows with an ``Observation`` inside the write job (no extra job);
* repairs an overwrite that was interrupted while it swapped: see ``settle``.

Delta overwrites are already atomic and are written in place.  One writer a
table at a time is assumed; readers may come at any moment.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_MODES = {"overwrite", "append", "ignore", "error", "errorifexists"}


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists on its Hadoop file system; None if that cannot be asked."""
    try:
        fs, hpath = _hadoop_fs(spark, path)
        return bool(fs.exists(hpath))
    except Exception:
        return None


def delete_path(spark: SparkSession, path: str) -> None:
    """Best-effort recursive delete through the Hadoop file system of ``path``."""
    try:
        fs, hpath = _hadoop_fs(spark, path)
        fs.delete(hpath, True)
    except Exception:
        pass


class LayerStore:
    """Tables addressed by (layer, name) below one root on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # -------------------------------------------------- interrupted overwrites
    def _staging_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/_staging_{table}_{uuid.uuid4().hex[:12]}"

    def _staged_folders(self, layer: str, table: str) -> dict[str, int]:
        """Staging folders of exactly this table (set-aside versions end in ``_old``) -> time of change."""
        fs, folder = _hadoop_fs(self.spark, f"{self.root}/{layer}")
        if not fs.exists(folder):
            return {}
        mine = re.compile(rf"_staging_{re.escape(table)}_[0-9a-f]{{12}}(_old)?")
        found = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(folder)]
        return {f"{self.root}/{layer}/{name}": changed for name, changed in found if mine.fullmatch(name)}

    def settle(self, layer: str, table: str) -> str | None:
        """Finish or undo an overwrite that stopped between its renames.

        An overwrite commits its job in a staging folder, moves the old table
        aside, moves the new one in and deletes the old one.  Whatever stopped
        in between is settled by what lies there:

        * no table, old and new version: the new one was committed, so it takes
          its place (``"completed"``);
        * no table, only the old version: it comes back (``"undone"``);
        * a table and an old version: the old one is deleted (``"cleaned"``).

        ``read``, ``exists``, ``schema`` and ``write`` call this.  While a table
        is in place they pay one existence check (a write: one listing).
        """
        if self.fmt == "delta":
            return None
        fs, target = _hadoop_fs(self.spark, self.path(layer, table))
        folders = self._staged_folders(layer, table)
        asides = sorted((f for f in folders if f.endswith("_old")), key=folders.get)
        if not asides:
            return None
        if fs.exists(target):
            for aside in asides:
                delete_path(self.spark, aside)
            return "cleaned"
        aside = asides[-1]
        staged = aside[: -len("_old")]
        if staged in folders and fs.rename(_hadoop_fs(self.spark, staged)[1], target):
            delete_path(self.spark, aside)
            return "completed"
        if fs.exists(target):  # its writer, or another reader, was faster
            return None
        if not fs.rename(_hadoop_fs(self.spark, aside)[1], target):
            raise OSError(f"{aside} holds the last version of {self.path(layer, table)} but cannot be moved back")
        return "undone"

    def clean_staging(self, layer: str, table: str, older_than_hours: float = 24.0) -> int:
        """Delete staging folders that failed writers left behind; returns how many.

        A folder that a running write still fills looks the same, so only old
        ones go.  Set-aside versions are settled, never just deleted.
        """
        self.settle(layer, table)
        before = (time.time() - older_than_hours * 3600) * 1000
        left = [f for f, changed in self._staged_folders(layer, table).items() if not f.endswith("_old") and changed <= before]
        for folder in left:
            delete_path(self.spark, folder)
        return len(left)

    # ---------------------------------------------------------------- reads
    def read(self, layer: str, table: str) -> DataFrame:
        self.exists(layer, table)  # settles an interrupted overwrite
        return self.spark.read.format(self.fmt).load(self.path(layer, table))

    def read_all(self, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
        return {t: self.read(layer, t) for t in tables}

    def exists(self, layer: str, table: str) -> bool:
        found = _path_exists(self.spark, self.path(layer, table))
        if found is False:
            return self.settle(layer, table) is not None or bool(_path_exists(self.spark, self.path(layer, table)))
        if found is not None:
            return found
        try:
            self.spark.read.format(self.fmt).load(self.path(layer, table)).schema
            return True
        except AnalysisException:
            return False

    def schema(self, layer: str, table: str):
        """Schema of an existing table, or None when there is none."""
        if not self.exists(layer, table):
            return None
        try:
            return self.read(layer, table).schema
        except AnalysisException:
            return None
        except Exception as exc:  # a damaged footer reaches Python as a bare JVM error
            raise OSError(
                f"table {self.path(layer, table)} cannot be read; overwrite it with overwrite_schema=True"
            ) from exc

    # --------------------------------------------------------------- writes
    def set_aside(self, staged: str, target: str) -> str | None:
        """Move the table at ``target`` aside; None if there is none."""
        fs, t = _hadoop_fs(self.spark, target)
        if not fs.exists(t):
            return None
        if not fs.rename(t, _hadoop_fs(self.spark, f"{staged}_old")[1]):
            raise OSError(f"could not move {target} aside; new version kept at {staged}")
        return f"{staged}_old"

    def _swap_in(self, staged: str, target: str) -> None:
        """Replace ``target`` by the committed folder ``staged`` (same file system).

        The old folder is moved aside first and deleted last; it is moved back
        if the new one cannot take its place.
        """
        fs, t = _hadoop_fs(self.spark, target)
        _, st = _hadoop_fs(self.spark, staged)
        aside = self.set_aside(staged, target)
        try:
            moved, cause = fs.rename(st, t), None
        except Exception as exc:
            moved, cause = False, exc
        if not moved and aside is not None and fs.exists(t) and not fs.exists(st):
            moved = True  # a reader saw the gap and completed the swap
        if not moved:
            if aside is not None:
                fs.rename(_hadoop_fs(self.spark, aside)[1], t)
            raise OSError(f"could not move {staged} to {target}; the old version is back") from cause
        if aside is not None:
            delete_path(self.spark, aside)

    def stage(self, df: DataFrame, layer: str, table: str) -> tuple[str, int]:
        """Write ``df`` to a new staging folder of the table; its path and the rows written."""
        staged = self._staging_path(layer, table)
        try:
            return staged, self._save(df, staged, "errorifexists")
        except Exception:
            delete_path(self.spark, staged)
            raise

    def publish(self, staged: str, layer: str, table: str) -> None:
        """Make a staged folder the table."""
        self._swap_in(staged, self.path(layer, table))

    def discard(self, staged: str) -> None:
        delete_path(self.spark, staged)

    def _save(self, df: DataFrame, path: str, mode: str, **options) -> int:
        obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(self.fmt).mode(mode).options(**options).save(path)
        return int(obs.get.get("rows", 0))

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        mode: str = "overwrite",
        overwrite_schema: bool = False,
    ) -> int:
        """Write ``df`` to (layer, table) and return the number of rows written."""
        if mode not in _MODES:
            raise ValueError(f"mode must be one of {sorted(_MODES)}")
        target = self.path(layer, table)
        self.settle(layer, table)
        replaces = mode == "overwrite" and overwrite_schema  # the old schema does not matter, nor need it be readable
        existing = None if replaces else self.schema(layer, table)
        if existing is not None and mode == "ignore":
            return 0  # nothing is written, so no observation would ever arrive
        if existing is not None and mode in ("error", "errorifexists"):
            raise FileExistsError(f"table {target} already exists")
        if existing is not None and (mode == "append" or not overwrite_schema):
            if [(f.name, f.dataType) for f in existing] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(
                    f"schema of {target} would change; pass overwrite_schema=True to allow it"
                )
        if mode == "overwrite" and self.fmt != "delta" and (existing is not None or replaces and self.exists(layer, table)):
            staged, rows = self.stage(df, layer, table)
            self._swap_in(staged, target)
            return rows
        options = {"overwriteSchema": "true"} if self.fmt == "delta" and overwrite_schema else {}
        return self._save(df, target, mode, **options)

    def write_all(
        self, tables: Mapping[str, DataFrame], layer: str, mode: str = "overwrite", parallel: int = 4
    ) -> dict[str, int]:
        """Write several independent tables; up to ``parallel`` write jobs are
        submitted at once so small tables do not leave executors idle while a
        large one finishes.  Returns rows written per table."""
        return in_parallel({name: partial(self.write, df, layer, name, mode) for name, df in tables.items()}, parallel)

    def register_views(self, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
        """Register (layer, table) reads as temp views named after the tables."""
        out = self.read_all(layer, tables)
        for name, df in out.items():
            df.createOrReplaceTempView(name)
        return out


def in_parallel(jobs: Mapping[str, Callable[[], int]], parallel: int = 4) -> dict[str, int]:
    """Run independent jobs from a small thread pool; results by name, in order."""
    if parallel <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(parallel, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count), computed as a union of
    per-table aggregates (each a partial count per task)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
