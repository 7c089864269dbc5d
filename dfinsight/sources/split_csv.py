"""SRC1 over many tasks: CSV with quoted newlines, read in blocks of a file (SRC1, SRC2, SRC6).

Spark's ``multiLine`` reader takes a file as one task, because where a record begins depends on all quotes
before it. Here the file is read as lines, which do split, and what depends on the text before is worked out
for blocks instead of records:

1. A task reads the lines of its block once for both cases, the block beginning outside or inside a quoted
   field, and numbers the records that end in it. A line only maps a state (outside, inside) to a state: one without
   quotes keeps it, any other is looked at field by field. The lines are stored with these numbers.
2. A block, too, is a map of two states: constant, unchanged or swapped. Running over the blocks of a file
   (one row a block) gives the state each begins with, and the block in which a record that is still open began.
3. Lines that are whole records, nearly all, go straight to ``from_csv``. Only lines of records that cross lines
   are grouped, by file, block and number of their record, and glued.

The result has the rows of ``read_csv`` with ``multiLine``. One block is ``spark.sql.files.maxPartitionBytes`` or
``block_bytes``. A field without a closing quote reaches to the end of its file, here as there, as one record.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.sizing import materialize
from ..session import importable
from .io import BOM

LINES = ("file string, block long, line long, text string, blank boolean, returns boolean, "
         "ends_out boolean, nth_out long, whole_out boolean, ends_in boolean, nth_in long, whole_in boolean")


class LineStates:
    """What a line does to the state of the reader: False outside, True inside a quoted field."""

    def __init__(self, sep: str):
        other = f"[^{re.escape(sep)}]"
        #: A quote opens a field only as its first character; after the closing quote the rest up to the separator is text.
        field = f'(?:"[^"]*+(?:""[^"]*+)*+"(?!"){other}*+|(?!"){other}*+)'
        self.record = re.compile(f"{field}(?:{re.escape(sep)}{field})*+", re.S)
        self.closing = re.compile(f'[^"]*+(?:""[^"]*+)*+"(?!"){other}*+', re.S)

    def from_outside(self, line: str, at: int = 0) -> bool:
        m = self.record.match(line, at)
        return m is None or m.end() < len(line)

    def from_inside(self, line: str) -> bool:
        m = self.closing.match(line)
        return m is None or m.end() < len(line) and self.from_outside(line, m.end() + 1)


def _number_lines(sep: str):
    """Rows (file, block, text) in file order -> LINES."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        states = LineStates(sep)
        now, line, state, nth = None, 0, [False, True], [0, 0]  # per case: the block begins outside, inside
        for b in batches:
            if not b.num_rows:
                continue
            text = b.column(2)
            quoted = pc.match_substring(text, '"').to_numpy(zero_copy_only=False)
            blocks = b.column(1).to_numpy()
            files = pc.dictionary_encode(b.column(0))
            codes = files.indices.to_numpy()
            new = np.ones(b.num_rows, bool)
            new[1:] = (blocks[1:] != blocks[:-1]) | (codes[1:] != codes[:-1])
            starts = np.flatnonzero(new)
            ends = np.r_[starts[1:], b.num_rows]
            number = np.empty(b.num_rows, np.int64)
            inside = [np.empty(b.num_rows, bool), np.empty(b.num_rows, bool)]  # after the line
            before = [np.empty(b.num_rows, bool), np.empty(b.num_rows, bool)]
            count = [np.empty(b.num_rows, np.int64), np.empty(b.num_rows, np.int64)]
            for lo, hi in zip(starts, ends):
                key = (files.dictionary[int(codes[lo])].as_py(), int(blocks[lo]))
                if key != now:
                    now, line, state, nth = key, 0, [False, True], [0, 0]
                number[lo:hi] = line + np.arange(hi - lo)
                line += hi - lo
                places = lo + np.flatnonzero(quoted[lo:hi])
                lines = text.take(pa.array(places)).to_pylist()
                for case in (0, 1):
                    change, s = [state[case]], state[case]
                    for t in lines:
                        s = states.from_inside(t) if s else states.from_outside(t)
                        change.append(s)
                    after = np.array(change)[np.cumsum(quoted[lo:hi])]
                    inside[case][lo:hi] = after
                    before[case][lo:hi] = np.r_[state[case], after[:-1]]
                    done = np.cumsum(~after)
                    count[case][lo:hi] = nth[case] + np.r_[0, done[:-1]]
                    state[case], nth[case] = bool(after[-1]), nth[case] + int(done[-1])
            blank = pc.is_in(text, pa.array(["", "\r"]))
            returns = pc.ends_with(text, "\r")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(number), text, blank, returns, pa.array(~inside[0]), pa.array(count[0]),
                 pa.array(~inside[0] & ~before[0]), pa.array(~inside[1]), pa.array(count[1]), pa.array(~inside[1] & ~before[1])],
                names=["file", "block", "line", "text", "blank", "returns", "ends_out", "nth_out", "whole_out", "ends_in", "nth_in", "whole_in"])

    return run


@contextmanager
def _setting(spark: SparkSession, name: str, value):
    if value is None:
        yield
        return
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def numbered_lines(spark: SparkSession, path: str, sep: str = ",", block_bytes: int | None = None) -> DataFrame:
    """Every line of the files with its block and the numbers of both cases, stored once. The job runs when
    this is called, so the blocks are those of one read."""
    importable(spark)
    with _setting(spark, "spark.sql.files.maxPartitionBytes", block_bytes):
        text = spark.read.option("lineSep", "\n").text(path)
        first = F.col("_metadata.file_block_start") == 0
        value = F.when(first & F.startswith("value", F.lit(BOM)), F.substr("value", F.lit(2))).otherwise(F.col("value"))
        rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value.alias("text"))
        return materialize(rows.mapInArrow(_number_lines(sep), LINES), "csv-lines")


def block_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside, crlf, from_block, from_nth, header_block, header_nth): the state each block begins with, the
    block and number of the record that is open there, the file's line ends (those of its first line) and header record."""
    last = lambda c: F.max_by(c, "line")
    blocks = lines.groupBy("file", "block").agg(
        (~last("ends_out")).alias("after_out"), (~last("ends_in")).alias("after_in"), F.count_if("ends_out").alias("n_out"), F.count_if("ends_in").alias("n_in"),
        F.min(F.when(~F.col("blank"), F.col("nth_out"))).alias("first_out"), F.bool_or(F.expr("block = 0 and line = 0 and returns")).alias("returns_first"))
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("after_out") == F.col("after_in")
    swaps = F.count_if(F.col("after_out") & ~F.col("after_in")).over(by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    blocks = blocks.withColumn("swaps", swaps % 2)
    # the state after the last constant block, with the swaps since; a file begins outside
    anchor = F.last(F.when(constant, F.col("after_out").cast("int").bitwiseXOR(F.col("swaps").cast("int"))), ignorenulls=True).over(before)
    state = F.coalesce(anchor, F.lit(0)).bitwiseXOR(F.coalesce(F.lag("swaps").over(by_file), F.lit(0)).cast("int")) == 1
    blocks = blocks.withColumn("inside", state)
    n = F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))
    opener = F.when(~F.col("inside") | (n > 0), F.struct("block", n.alias("n")))
    whole_file = by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    some = F.when(F.col("first_out").isNotNull(), F.struct("block", F.col("first_out").alias("n")))
    blocks = blocks.withColumns({"opened": F.last(opener, ignorenulls=True).over(before), "header": F.first(some, ignorenulls=True).over(whole_file),
                                 "crlf": F.bool_or("returns_first").over(whole_file)})
    return blocks.select("file", "block", "inside", "crlf", F.col("opened.block").alias("from_block"), F.col("opened.n").alias("from_nth"),
                         F.col("header.block").alias("header_block"), F.col("header.n").alias("header_nth"))


def split_records(spark: SparkSession, path: str, header: bool = True, sep: str = ",", block_bytes: int | None = None) -> DataFrame:
    """(record): the text of every record but the headers and blank lines, glued where it crosses lines."""
    lines = numbered_lines(spark, path, sep, block_bytes)
    by_case = lambda name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    text = F.when(F.col("crlf") & F.col("returns"), F.substr("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    at = lines.join(block_starts(lines), ["file", "block"]).withColumns({"nth": by_case("nth"), "whole": by_case("whole"), "text": text})
    carried = F.col("inside") & (F.col("nth") == 0)
    at = at.withColumns({"rec_block": F.when(carried, F.col("from_block")).otherwise(F.col("block")), "rec": F.when(carried, F.col("from_nth")).otherwise(F.col("nth"))})
    if header:
        at = at.filter(~(F.col("rec_block").eqNullSafe(F.col("header_block")) & F.col("rec").eqNullSafe(F.col("header_nth"))))
    whole = at.filter("whole").select(F.col("text").alias("record"))
    pieces = at.filter("not whole").groupBy("file", "rec_block", "rec").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("pieces"))
    glued = pieces.select(F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("record"))
    return whole.union(glued).filter("record <> ''")


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, sep: str = ",",
                   null_value: str | None = None, block_bytes: int | None = None) -> DataFrame:
    """SRC1 with quoted newlines, one task a block: header, quote and escape ``"``, UTF-8, columns by position.

    Lines end in a newline; where a file's first line ends in a carriage return and a newline, that pair is its line end,
    also inside quotes. A compressed file is one block."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    if null_value is not None:
        options["nullValue"] = null_value
    records = split_records(spark, path, header, sep, block_bytes)
    return records.select(F.from_csv("record", schema.toDDL(), options).alias("r")).select("r.*")
