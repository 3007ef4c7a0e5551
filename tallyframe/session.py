"""Session settings, staging of intermediate tables, and small driver-built tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def get_session(app: str = "tallyframe", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect: UTC times, AQE, skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and staged tables.

    The session's ``spark.checkpoint.dir`` always wins. Only a local session may fall back to
    a folder of its own, since no other machine has to see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = configured or context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tallyframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(current)
    return current


_STAGED: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`stage` writes inside the block when it ends.

    For callers that know when a result has been used: rows that are still to be read from such a table must be written elsewhere
    (``stage(df, label, keep=1)``, a sink, a collect) before the block ends. Blocks may lie in each other.
    """
    written: list[str] = []
    _STAGED.append(written)
    try:
        yield
    finally:
        _STAGED.remove(written)
        for path in written:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, label: str, balance: bool = False, keep: int = 0, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return a scan of the written table.

    Used where a costly plan is read many times (model fitting): lineage is cut, lost executors
    only re-read files, and later readers still get column pruning and pushed filters.
    ``balance`` evens out the files by one shuffle first: worth it where a hot join key leaves a
    huge partition, or a small table only one, and many passes follow. ``schema`` reads the columns as other types of the same form.
    Written tables stay, unless they are written inside a :func:`staging` block; ``keep`` tells how many blocks a table outlives.
    """
    df = df.hint("rebalance") if balance else df
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if len(_STAGED) > keep:
        _STAGED[-1 - keep].append(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """A table from driver-held report values (size bounded by columns, classes or models)."""
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = list(rows)
    arrow_schema = to_arrow_schema(struct)
    columns = [pa.array([row[i] for row in rows], type=field.type) for i, field in enumerate(arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema), schema=struct)


def rows_up_to(df: DataFrame, limit: int) -> list | None:
    """All rows when there are at most ``limit`` of them, else ``None`` (nothing is cut off)."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None

