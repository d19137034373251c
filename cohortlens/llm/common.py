"""Helpers shared by the text-pipeline operators: shared folder, files, words."""

from __future__ import annotations

import ctypes
import gc
import io
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import shared_path

#: Fixed value: a word is a run of characters other than space, \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``; removed with the application."""
    path = shared_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return fs.makeQualified(where).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (lineage ends there)."""
    path = f"{scratch_path(df.sparkSession, name)}/data"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`scratch_path` and all that is in it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that no plan still to run reads, and free their shuffles."""
    for table in tables:
        delete_path(table.sparkSession, table.written_path)
        release(table.sparkSession)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans that nothing refers to any more.

    Its cleaner acts when the driver's garbage is collected, which on a large
    heap may be long after a multi-step operator has moved on. Plans that Python let go
    reach the JVM a moment later, hence the second round.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI, usable in tasks (``file:/x`` and ``file:///x`` alike)."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


#: Rows and bytes that go to a Python worker at once, where the session has Spark's defaults.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
_DEFAULTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", BATCH_ROWS),
             "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", BATCH_BYTES)}


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches: rows are whole texts, and a batch is in memory several times."""
    for key, (default, value) in _DEFAULTS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, str(value))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers (once per application).

    Executors then need no installed copy; the archive goes through the shared folder.
    """
    bound_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    uri = f"{scratch_path(spark, 'code')}/{root.name}.zip"
    fs, path = filesystem(uri)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)


def give_back() -> None:
    """Return memory that the process holds unused to the system.

    Python workers outlive their tasks and stages; what a task no longer needs
    would stay in their allocators while other workers and the JVM need it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(function: Callable) -> Callable:
    """A function of ``mapInPandas`` after whose last row its worker's unused memory is given back."""
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        give_back()

    return run


class AttemptFile:
    """A file written by one task attempt under a name no other attempt uses.

    The writer returns a manifest row for each file it closed. Spark commits
    the rows of one successful attempt per task only, so readers that follow
    the manifest never see files of failed or speculative attempts.
    """

    def __init__(self, folder: str, suffix: str):
        fs, path = filesystem(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
        fs.create_dir(path, recursive=True)
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.size = 0
        self._out = fs.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()


def text_of(column: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per Python worker; special strings are ordinary text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded
