"""Records of quoted CSV files that are read in pieces by many tasks, line breaks inside fields included.

Spark cuts a text file into ranges at line breaks. Whether a range begins inside a quoted field follows from the number of
quotes before it, so a first pass counts quotes by range. In a second pass each range joins its own lines to records; only
records that cross a border of ranges meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = ["file", "start"]
_PIECE = {"file": pa.string(), "start": pa.int64(), "at": pa.int64(), "nth": pa.int64(), "kind": pa.int64(), "record": pa.string()}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the range they were read in: (file, start, line)."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of a batch that come from one range, as a task may read several one after the other."""
    if not batch.num_rows:
        return
    starts = batch.column(1).to_numpy()
    other = pc.not_equal(batch.column(0)[1:], batch.column(0)[:-1]).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(starts) != 0) | other.astype(bool)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.column(0)[a].as_py(), int(starts[a]), batch.slice(a, b - a)


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range: the parity of its quotes, and whether a record ends in it if it begins outside (ends0) or inside a field (ends1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list] = {}
        for batch in batches:
            for file, start, part in _runs(batch):
                held = seen.setdefault((file, start), [0, False, False])
                inside = (held[0] + np.cumsum(pc.count_substring(part.column(2), '"').to_numpy())) % 2
                held[0] = int(inside[-1])
                held[1] |= bool((inside == 0).any())
                held[2] |= bool((inside == 1).any())
        columns = [[k[0] for k in seen], [k[1] for k in seen], *([v[i] for v in seen.values()] for i in range(3))]
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "start", "parity", "ends0", "ends1"])

    return lines.mapInArrow(run, "file string, start long, parity long, ends0 boolean, ends1 boolean")


def _placed(ranges: DataFrame) -> DataFrame:
    """(file, start, inside, opened): whether the range begins inside a field, and the range in which the record that reaches into it began."""
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    known = ranges.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
    known = known.withColumn("ends", F.when(F.col("inside"), F.col("ends1")).otherwise(F.col("ends0")))
    # A record that goes on at a range's end began there if another ended there, or none reached into it.
    opened = F.max(F.when(F.col("ends") | ~F.col("inside"), F.col("start"))).over(before)
    return known.select("file", "start", "inside", F.coalesce(opened, F.lit(0)).alias("opened"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, nth, record): whole records as text. The header of a file is the record with start 0 and nth 0.

    Fields follow the usual rule: one that holds a quote, comma or line break stands in quotes, and quotes inside are doubled. The table of
    ranges that is broadcast has one row for each ``spark.sql.files.maxPartitionBytes`` of text.
    """
    lines = _lines(spark, path)
    placed = lines.join(F.broadcast(_placed(_ranges(lines))), RANGE).select("file", "start", "line", "inside", "opened")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of each range; kind 0 is whole, 1 the end of one that began in ``opened``, 2 the beginning of one that goes on."""
        now, held, inside, nth, kind = None, [], False, 0, 0
        out: list[tuple] = []

        def pack() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE.values())], list(_PIECE))

        def close(goes_on: bool) -> None:
            nonlocal held, nth, kind
            if held:
                out.append((now[0], opened if kind == 1 else now[1], now[1], nth, 2 if goes_on and kind == 0 else kind, "\n".join(held)))
                nth += 1
            held, kind = [], 0

        opened = 0
        for batch in batches:
            for file, start, part in _runs(batch):
                if now != (file, start):
                    if now is not None:
                        close(True)
                    now, held, nth, inside, opened = (file, start), [], 0, part.column(3)[0].as_py(), part.column(4)[0].as_py()
                    kind = 1 if inside else 0
                odd = pc.count_substring(part.column(2), '"').to_numpy() % 2 == 1
                for line, flips in zip(part.column(2).to_pylist(), odd.tolist()):
                    held.append(line)
                    inside ^= flips
                    if not inside:
                        close(False)
                if len(out) >= 5_000:
                    yield pack()
                    out = []
        if now is not None:
            close(True)
        yield pack()

    pieces = placed.mapInArrow(run, "file string, start long, at long, nth long, kind long, record string")
    whole = pieces.where("kind = 0").select("file", "start", "nth", "record")
    # A record across a border: its beginning, the ranges it fills, and its end, in order of their ranges.
    parts = F.array_sort(F.collect_list(F.struct("at", "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    across = pieces.where("kind > 0").groupBy("file", "start").agg(F.min_by("nth", "at").alias("nth"), text.alias("record"))
    return whole.unionByName(across)


def csv_fields(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All fields as text. Names come from the header, which must be that of ``schema`` if given."""
    names = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path).columns
    if schema is not None and [n.lower() for n in schema.names] != [n.lower() for n in names]:
        raise ValueError(f"the header has {names}, the schema {schema.names}")
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    text = csv_records(spark, path).where("not (start = 0 and nth = 0)")
    cells = F.from_csv(F.regexp_replace("record", "\r$", ""), fields.simpleString(), {"quote": '"', "escape": '"', "multiLine": "true"})
    rows = text.where("trim(record) <> ''").select(cells.alias("r"))
    return rows.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names if schema is None else schema.names)])
