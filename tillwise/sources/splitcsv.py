"""CSV files with line breaks inside quoted fields, read by many tasks.

Whether a line break ends a record depends on the quotes before it: inside an odd number of
quotes it belongs to a field (a doubled quote adds two and changes nothing).  So:

1. one pass counts the quotes of every split of every file; the running parity over the splits of a
   file (one row a split) says for each split whether it starts inside a quoted field;
2. each task then walks the lines of its splits from the right state and joins the lines of a record;
3. what a record has on the other side of a split's edge comes as a fragment (two rows a split at
   most, but for a field longer than a split) and is joined by its record;
4. the records are parsed by Spark's CSV parser.

Lines end in a line feed, with or without a carriage return before it; a carriage return inside a field
stays.  No record is shuffled, but for the fragments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRAGMENTS = "record string, file string, block bigint, place int, is_head boolean, is_first boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether each split starts inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)   # a row a split
    return counts.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _assemble(batches: Iterator[pa.RecordBatch], edges_only: bool = False) -> Iterator[pa.RecordBatch]:
    """Whole records, and the fragments at the edges of the splits, from lines in the order of the file.

    Quotes are counted for a batch of lines at once: a record ends at each line with an even number of them since
    its split began, and the lines between two such ends are joined by Arrow.  With ``edges_only`` the whole records
    are left out.
    """
    split, inside, begun = None, False, False   # ``begun``: a record has begun in this split
    waiting: list[str] = []

    def told(records: pa.Array, place: int, first: bool = False) -> pa.RecordBatch:
        n = len(records)
        is_first = np.zeros(n, bool)
        is_first[:1] = first
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
        columns = [records.cast(pa.string()), same(split[0], pa.string()), same(split[1], pa.int64()), same(place, pa.int32()),
                   same(place == 1, pa.bool_()), pa.array(is_first)]
        return pa.RecordBatch.from_arrays(columns, ["record", "file", "block", "place", "is_head", "is_first"])

    def fragment(lines: list[str], head: bool, first: bool = False) -> pa.RecordBatch:
        return told(pa.array(["\n".join(lines)], pa.string()), 1 if head else 2, first)

    first = False   # the record that waits is the first of its file
    for batch in batches:
        values = batch.column("value")
        odd = pc.count_substring(values, '"').to_numpy() % 2
        files, blocks, states = (batch.column(c) for c in ("file", "block", "inside"))
        codes = files.dictionary_encode().indices.to_numpy()
        at = blocks.to_numpy()
        edges = np.flatnonzero((codes[1:] != codes[:-1]) | (at[1:] != at[:-1])) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(values)], strict=True):
            if begin == end:
                continue
            own = (files[begin].as_py(), int(at[begin]))
            if own != split:
                if waiting:   # the end of a split: an open record goes on in the next one
                    yield fragment(waiting, head=not begun, first=first)
                split, inside, begun, waiting = own, states[begin].as_py(), False, []
                first = own[1] == 0
            if not inside and not waiting:
                begun = True
            open_after = (int(inside) + np.cumsum(odd[begin:end])) % 2 == 1
            ends = begin + 1 + np.flatnonzero(~open_after)   # behind the last line of each record
            inside = bool(open_after[-1])
            if not len(ends):
                waiting += values.slice(begin, end - begin).to_pylist()
                continue
            if waiting or not begun:   # the record that was open before these lines
                waiting += values.slice(begin, ends[0] - begin).to_pylist()
                if not begun:
                    yield fragment(waiting, head=True)   # the end of a record that another split began
                    begun = True
                else:
                    if not edges_only:
                        yield told(pa.array(["\n".join(waiting)], pa.string()), 0, first)
                    first = False
                begin, ends = int(ends[0]), ends[1:]
            if len(ends):
                if not edges_only:
                    if len(ends) == ends[-1] - begin:   # no line break in any field
                        yield told(values.slice(begin, len(ends)), 0, first)
                    else:
                        cut = pa.array(np.concatenate(([0], ends - begin)), pa.int32())
                        yield told(pc.binary_join(pa.ListArray.from_arrays(cut, values.slice(begin, ends[-1] - begin)), "\n"), 0, first)
                first, begin = False, int(ends[-1])
            waiting = values.slice(begin, end - begin).to_pylist()
    if waiting:
        yield fragment(waiting, head=not begun, first=first)


def _assemble_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _assemble(batches, edges_only=True)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_first): every record of the files as a text; ``is_first`` marks the first of each file."""
    lines = _lines(spark, path)
    states = split_states(lines).checkpoint(eager=True)
    known = F.coalesce("inside", F.raise_error(F.lit("the files were split in another way when their lines were read again")).cast("boolean"))
    # one small row for each split of the files
    started = lines.join(F.broadcast(states), ["file", "block"], "left").select("value", "file", "block", known.alias("inside"))
    whole = started.mapInArrow(_assemble, _FRAGMENTS).filter("place = 0").select("record", "is_first")
    pieces = started.mapInArrow(_assemble_edges, _FRAGMENTS)
    # the splits of a file in order: each open end starts a record, the heads after it belong to it
    in_file = Window.partitionBy("file").orderBy("block", "place")
    edges = pieces.filter("place > 0").withColumn("_record", F.sum(F.when(F.col("is_head"), 0).otherwise(1)).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
    joined = edges.groupBy("file", "_record").agg(parts.alias("_parts"), F.bool_or("is_first").alias("is_first"))
    return whole.union(joined.select(F.array_join(F.transform("_parts", lambda p: p["record"]), "\n").alias("record"), "is_first"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The typed columns of every record but the headers; blank lines are no records."""
    text = F.rtrim(F.col("record"), F.lit("\r"))
    rows = read_records(spark, path).filter(~F.col("is_first")).select(text.alias("record")).filter(F.col("record") != "")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parse = {k: v for k, v in options.items() if k != "header"}
    return rows.select(F.from_csv("record", ddl, parse).alias("_r")).select("_r.*")
