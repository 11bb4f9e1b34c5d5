"""Curated snapshots and the log that says which one is current.

Spark cannot overwrite files it is reading, and plain Parquet has no MERGE. Each run
therefore writes what it changes to a directory of its own and, when all of it has passed
its checks, adds one record to the log. Readers follow the last record, so both tables
change together and a run that fails or loses executors changes nothing. The record names
the folder of each month of orders; a month that no run has touched since stays where it is.

Two loads that started from the same record cannot both finish: a run first claims its number
with a file that must not be there yet, and the second one to do so fails. A claim is a lease: one
that is older than LEASE and has led to no record was left by a load that died, and the next load
claims the number once more, with the next attempt. Records carry the attempt; of two records of one
number the later attempt's counts, and a load that finds a later claim than its own after it has
written its record has lost.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = (
    "run_number BIGINT, run_ts TIMESTAMP_NTZ, "
    "orders_clean_path STRING, order_months MAP<INT, STRING>, items_path STRING, "
    "last_item_id BIGINT, attempt INT"
)
#: Seconds after which a claim without a record may be taken over.
LEASE = 3600
#: Seconds that a folder which no record names is left alone: a load may still be writing it.
SWEEP_AGE = 7 * 24 * 3600


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.gettempdir()}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/orderledger/{purpose}-{uuid.uuid4().hex}"


def new_run_folder(root: str, run_ts: datetime) -> str:
    """A fresh folder for each attempt, so a retry cannot meet a half-written one."""
    return f"{root}/runs/{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


class RunConflict(RuntimeError):
    """Another load has finished, or is finishing, since this one started."""


def _files(spark: SparkSession, path: str):
    """Hadoop's path and file system, which know the stores that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> set[str]:
    """The names of what lies in a folder; none if it is not there."""
    path, files = _files(spark, path)
    if not files.exists(path):
        return set()
    return {status.getPath().getName() for status in files.listStatus(path)}


def _age(files, path) -> float:
    return time.time() - files.getFileStatus(path).getModificationTime() / 1000


def claim(spark: SparkSession, root: str, number: int, lease: float = LEASE) -> int:
    """Claim a run number, which only one of two runs can do; returns the attempt.

    Spark's writers check and then write, so the file is made by Hadoop's file system. A claim
    that is younger than the lease, or that has led to a record, is respected.
    """
    attempt = 0
    while True:
        path, files = _files(spark, f"{root}/claims/{number}.{attempt}")
        files.mkdirs(path.getParent())
        if files.createNewFile(path):
            return attempt
        if _age(files, path) < lease or _recorded(spark, root, number):
            raise RunConflict(f"run {number} is taken by another load: {path.toString()}")
        attempt += 1


def _recorded(spark: SparkSession, root: str, number: int) -> bool:
    log = run_log(spark, root)
    return log is not None and not log.filter(F.col("run_number") == number).isEmpty()


def _claimed_later(spark: SparkSession, root: str, number: int, attempt: int) -> bool:
    path, files = _files(spark, f"{root}/claims/{number}.{attempt + 1}")
    return files.exists(path)


def run_log(spark: SparkSession, root: str) -> DataFrame | None:
    """All records, None before the first."""
    path, files = _files(spark, f"{root}/log")
    if not files.exists(path):
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")


def current_run(spark: SparkSession, root: str) -> Row | None:
    """The last committed run, None before the first."""
    log = run_log(spark, root)
    if log is None:
        return None
    order = F.struct("run_number", F.coalesce("attempt", F.lit(0)))
    last = log.agg(F.max_by(F.struct("*"), order).alias("run")).first()
    return last.run


def commit_run(
    spark: SparkSession,
    root: str,
    previous: Row | None,
    run_ts: datetime,
    orders_clean_path: str,
    order_months: dict[int, str],
    items_path: str,
    last_item_id: int = 0,
    lease: float = LEASE,
) -> Row:
    """Make a finished run the current one, if the run it built upon still is."""
    number = 1 if previous is None else previous.run_number + 1
    attempt = claim(spark, root, number, lease)
    record = {
        "run_number": number,
        "run_ts": run_ts,
        "orders_clean_path": orders_clean_path,
        "order_months": order_months,
        "items_path": items_path,
        "last_item_id": last_item_id,
        "attempt": attempt,
    }
    # A Python datetime becomes a zoned literal, so the time goes in as text.
    months = [F.lit(part) for month in order_months.items() for part in month]
    literals = {name: F.lit(value) for name, value in record.items() if name != "order_months"}
    literals |= {"run_ts": F.lit(run_ts.isoformat(sep=" ")), "order_months": F.create_map(*months)}
    fields = [
        literals[field.name].cast(field.dataType).alias(field.name)
        for field in T.StructType.fromDDL(LOG_SCHEMA)
    ]
    spark.range(1, numPartitions=1).select(fields).write.mode("append").parquet(f"{root}/log")
    if _claimed_later(spark, root, number, attempt):
        raise RunConflict(f"run {number} was taken over by another load")
    return Row(**record)


def reachable_folders(spark: SparkSession, root: str, keep: int = 1) -> set[str]:
    """The run folders that the last `keep` runs name, months of earlier runs among them."""
    log = run_log(spark, root)
    if log is None:
        return set()
    last = log.orderBy(F.desc("run_number"), F.desc("attempt")).limit(keep).collect()
    paths = [
        path
        for run in last
        for path in [run.orders_clean_path, run.items_path, *run.order_months.values()]
    ]
    top = f"{root}/runs/"
    return {path.split(top, 1)[1].split("/")[0] for path in paths if top in path}


def sweep(
    spark: SparkSession, root: str, keep: int = 1, age: float = SWEEP_AGE
) -> list[str]:
    """Delete the run folders that none of the last `keep` runs names; returns their names.

    First the reachable folders are marked, then the others go if they are older than `age`:
    what a load in progress writes is named by no record yet.
    """
    marked = reachable_folders(spark, root, keep)
    top, files = _files(spark, f"{root}/runs")
    if not files.exists(top):
        return []
    swept = []
    for status in files.listStatus(top):
        name = status.getPath().getName()
        if name not in marked and _age(files, status.getPath()) >= age:
            files.delete(status.getPath(), True)
            swept.append(name)
    return sorted(swept)
