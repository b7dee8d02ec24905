"""Helpers of the training-data operators: shared folders, stored tables, row locators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import threading
import uuid
import zipfile

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 5_000, 8 << 20

#: Narrow rows (identifiers, links) that a task writes.
TASK_ROWS = 100_000

#: Spark's setting that frees a query's shuffle files at its end; what is stored needs them no more.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Seconds without a task after which a worker gives up what it keeps.
IDLE = 3.0

_own: dict[str, str] = {}
_kept: dict = {}
_waiting: list[threading.Timer] = []


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a context; they need not have it installed.

    Also bounds, for the session, what goes to Python at once: texts are long, and by default a batch is ten
    thousand of them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if _own.get("shipped") == context.applicationId:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # The driver's own copy; Spark serves it to the executors as long as the context lives.
    folder = tempfile.mkdtemp(prefix="fleetlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"fleetlens_llm_{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.write(os.path.join(os.path.dirname(here), "__init__.py"), "fleetlens/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                archive.write(os.path.join(here, name), f"fleetlens/llm/{name}")
    context.addPyFile(path)
    _own["shipped"] = context.applicationId


def kept(key, make):
    """What a worker keeps from task to task under ``key``; only one operator's at a time, to bound memory."""
    made = _kept.get(key)
    if made is None:
        forget()
        made = _kept[key] = make()
        give_back()
    return made


def forget() -> None:
    """Give up what is kept; who still uses it has it for as long as that takes."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Return memory that a worker no longer uses to the system; workers outlive their tasks."""
    gc.collect()
    _trim()


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def _busy() -> None:
    while _waiting:
        _waiting.pop().cancel()


def _idle() -> None:
    _busy()
    timer = threading.Timer(IDLE, forget)
    timer.daemon = True
    _waiting.append(timer)
    timer.start()


def trimmed(run):
    """``run`` over batches, which returns the memory it has freed when its task ends.

    Should the worker then get no other task for IDLE seconds, it also gives up what it keeps: Spark lets workers
    live on while later steps, which need no Python or other things, use the executor's memory.
    """

    def whole(batches):
        _busy()
        try:
            yield from run(batches)
            _trim()
        finally:
            _idle()

    return whole


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master may go without that setting: it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _own.setdefault("root", tempfile.mkdtemp(prefix="fleetlens-llm-"))
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}" if spark.sparkContext.master.startswith("local") else root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table and read it back: the lineage ends there, and a lost executor costs no rework.

    What is read next has a known size, so Spark itself chooses broadcasts by it, and a join
    on it gets a shuffle of its own, which adaptive execution can split where a key is hot. The shuffle files of
    the write go with it: otherwise they stay until the driver happens to collect garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, n: int) -> DataFrame:
    """``df``, of at most about ``n`` narrow rows, in as many tasks as these call for; of few rows, one for each core.

    Otherwise the last step has a task for each shuffle partition, which the rows of a late round do not fill.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, n // TASK_ROWS + 1))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_folder`` named."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def with_locator(docs: DataFrame, folder: str) -> DataFrame:
    """Add ``_file`` and ``_row``, where the row lies; rows from elsewhere than files are stored first."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return stored(docs, f"{folder}/rows").select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
        )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
