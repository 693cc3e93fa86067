"""CSV files whose quoted text holds line breaks, read by many tasks.

The files are scanned as text lines, which splits them at any place. Whether a
line starts inside a quoted field depends on all lines before it, but it has two
answers only, so a piece of a file (a split of the scan) is a map from the state
at its first line to the state after its last. One scan finds these maps, one
small table puts them together in the order of each file, and a second scan,
which then knows the state that every split starts in, puts lines together to
records. A record over two or more splits is joined from its parts, of which a
split has two at most. No scanned line is shuffled.

Quotes count as the CSV reader counts them: they open a field only at its start,
two of them are one, and what follows a closing quote runs on to the delimiter.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir

_QUOTED = r'"(?:[^"]|"")*+"[^,]*+'
_FIELD = rf'(?:{_QUOTED}|(?:[^",][^,]*+)?+)'
#: Lines after which no quote is open, from outside of quotes and from inside.
CLOSED = re.compile(rf'{_FIELD}(?:,{_FIELD})*+', re.S), re.compile(rf'(?:[^"]|"")*+"[^,]*+(?:,{_FIELD})*+', re.S)

#: Bytes of split states that are broadcast; more are joined by a shuffle.
BROADCAST = 32 << 20
HEAD, WHOLE, TAIL = 0, 1, 2   # parts of a split: the end of a record begun before, whole records, the start of one that goes on


def open_after(line: str, inside: bool) -> bool:
    """Is a quoted field open after the line?"""
    if '"' not in line:
        return inside
    return not CLOSED[inside].fullmatch(line)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")


def _maps(batches):
    """For each split of a task: is a field open after it, if none was before,
    and if one was? Lines without quotes come as null."""
    here, states = None, [False, True]
    for b in batches:
        for file, start, value in zip(*(c.to_pylist() for c in b.columns)):
            if (file, start) != here:
                if here:
                    yield _map_row(here, states)
                here, states = (file, start), [False, True]
            if value is not None:
                states = [open_after(value, s) for s in states]
    if here:
        yield _map_row(here, states)


def _map_row(here, states):
    return pa.RecordBatch.from_pydict({"file": [here[0]], "start": [here[1]], "from_out": [states[0]], "from_in": [states[1]]})


def _fold(table: pa.Table) -> pa.Table:
    """The state at the start of each split of one file."""
    table = table.sort_by("start")
    inside, out = False, []
    for a, b in zip(table.column("from_out").to_pylist(), table.column("from_in").to_pylist()):
        out.append(inside)
        inside = b if inside else a
    return table.select(["file", "start"]).append_column("inside", pa.array(out, pa.bool_()))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, inside): is a quoted field open where the split starts?"""
    quoted = lines.select("file", "start", F.when(F.col("value").contains('"'), F.col("value")).alias("value"))
    maps = quoted.mapInArrow(_maps, "file string, start long, from_out boolean, from_in boolean")
    return maps.groupBy("file").applyInArrow(_fold, "file string, start long, inside boolean")


def _records(batches):
    """Lines of one split after the other to records; the first record of a file
    is its header and goes."""
    here, inside, part, held, header = None, False, WHOLE, [], False

    def done(kind):
        return {"file": here[0], "start": here[1], "part": kind, "record": "\n".join(held)}

    def batch(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("start", pa.int64()), ("part", pa.int32()), ("record", pa.string())]))

    for b in batches:
        rows = []
        for file, start, own, value in zip(*(c.to_pylist() for c in b.columns)):
            if (file, start) != here:
                if held:
                    rows.append(done(TAIL if part == WHOLE else HEAD))
                here, inside, held, header = (file, start), bool(own), [], start == 0
                part = HEAD if inside else WHOLE
            held.append(value)
            inside = open_after(value, inside)
            if not inside:
                if not header:
                    rows.append(done(part))
                held, part, header = [], WHOLE, False
        if rows:
            yield batch(rows)
    if held:
        yield batch([done(TAIL if part == WHOLE else HEAD)])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of each record but the headers."""
    lines = _lines(spark, path)
    ensure_checkpoint_dir(spark)
    states = split_states(lines).where("inside").checkpoint()  # the others start outside of quotes
    size = states.agg(F.coalesce(F.sum(F.length("file") + 16), F.lit(0))).first()[0]
    if size <= BROADCAST:  # such a join keeps the lines in order
        told = lines.join(F.broadcast(states), ["file", "start"], "left")
    else:
        told = lines.join(states, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "at")
    found = told.select("file", "start", F.coalesce("inside", F.lit(False)).alias("inside"), "value").mapInArrow(
        _records, "file string, start long, part int, record string")
    ends = found.where(F.col("part") != WHOLE)
    # two parts of a split at most: each TAIL opens a record that the HEADs after it go on with
    order = Window.partitionBy("file").orderBy("start", "part")
    joined = ends.withColumn("n", F.count_if(F.col("part") == TAIL).over(order)).groupBy("file", "n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "part", "record"))), lambda p: p["record"]), "\n").alias("record"))
    text = found.where(F.col("part") == WHOLE).select("record").unionByName(joined.select("record"))
    text = text.select(F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")).alias("record"))
    return text.where(F.col("record") != "")


def read_multiline_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All columns as text, in the schema's order; missing cells are null. Every
    file of ``path`` has a header. The states of the splits are found at once, the
    records when they are read. Of a file that ends inside quotes, which is
    malformed, the last line break is lost."""
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    row = F.from_csv("record", text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"', "multiLine": "true"})
    return records(spark, path).select(row.alias("row")).select("row.*")
