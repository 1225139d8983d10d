"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


ROWS = 1_000                # rows of a batch that a function sees at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: later steps (and retries after a lost executor) start
    from the written table, never from a machine-local copy.
    """
    path = scratch_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


class Scratch:
    """Owner of the tables that a step stages: ``with scratch.step(spark):`` around
    the step collects them, and the next step, called when the output of the one
    before has been written, deletes them first."""

    def __init__(self):
        self.held: list[str] = []

    @contextmanager
    def step(self, spark: SparkSession):
        self.release(spark)
        _scopes.append([])
        try:
            yield
        finally:
            self.held = _scopes.pop()

    def release(self, spark: SparkSession) -> None:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in self.held:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        self.held = []


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]],
                schema: str) -> DataFrame:
    """Run a batch function over Arrow batches. ``make`` is called once per
    task and returns the function, so models are loaded once."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            # what is made of a batch is held as Python objects: some rows at a time
            for at in range(0, batch.num_rows, ROWS):
                cols = fn(batch.slice(at, ROWS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[f.name], type=f.type) for f in out], schema=out)
        fn = cols = batch = None
        hand_back()

    return df.mapInArrow(run, schema)


def hand_back() -> None:
    """Return a task's freed memory to the machine. Workers wait for further tasks
    and would else hold it beside those of the next step."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one at a time; null reads as ''."""
    for value in column:
        yield value.as_py() or ""


def per_worker(key, build: Callable):
    """A value kept for the life of a Python worker, over all its tasks.

    The package ships its functions by value, so a worker holds no module of
    ours to keep a cache in; this makes one.
    """
    store = sys.modules.setdefault("_clusterlens_worker", types.ModuleType("_clusterlens_worker"))
    values = store.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = build()
    return values[key]


class Shared:
    """A broadcast of an object of this package, pickled by value as well."""

    def __init__(self, spark: SparkSession, value):
        self.handle = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self):
        return cloudpickle.loads(self.handle.value)
