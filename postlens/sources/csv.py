"""CSV source and column-role resolution.

A quoted field may hold line breaks, so a task that starts in the middle of a file does
not know whether it starts inside one. Each split is read as lines and says how it
ends, for either start; run along the splits of a file, that tells where each one
starts. A second pass cuts the lines into records. Records that go across splits
come out in parts, of which there are two for a split at most, and are put together.
So any file is read by as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.wordlists import NULL_CELLS

CORRUPT = "_corrupt_record"

# A field opens quoted only if it begins with a quote; a quote elsewhere is a character like any other, and what
# follows a closing quote belongs to the field. The possessive groups keep matching iterative.
QUOTED = r'"(?:[^"]++|"")*+"(?!")[^,]*+'
FIELD = rf'(?:{QUOTED}|(?!")[^,]*+)'
REST = rf"(?:,{FIELD})*+$"
# A line that is whole: all its quoted fields are closed. Starting inside one, it closes that first.
WHOLE = rf"^{FIELD}{REST}"
CLOSING = rf'^(?:[^"]++|"")*+"(?!")[^,]*+{REST}'


class SourceNotFound(FileNotFoundError):
    """The input path does not exist or cannot be read."""


class Roles(NamedTuple):
    """Names of the columns that hold text, label and type."""

    text: str
    label: str
    type: str


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, line, opens, stays)``: each line, whether a quoted field is open after it if none was before, and if one was."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"),
        (~F.col("value").rlike(WHOLE)).alias("opens"), (~F.col("value").rlike(CLOSING)).alias("stays"),
    )


def walked(batch: pa.RecordBatch) -> Iterator[tuple[str, int, str, bool, bool]]:
    """The lines of a batch as Python values."""
    return zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line", "opens", "stays")))


def split_ends(lines: DataFrame) -> DataFrame:
    """``(file, start, opens, stays)`` for each split: as for a line, after its last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for file, start, opens, stays in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "opens", "stays"))):
                now = ends.setdefault((file, start), [False, True])
                now[:] = [stays if open_ else opens for open_ in now]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in ends], pa.string()), pa.array([k[1] for k in ends], pa.int64()),
             pa.array([e[0] for e in ends.values()], pa.bool_()), pa.array([e[1] for e in ends.values()], pa.bool_())],
            names=["file", "start", "opens", "stays"],
        )

    return lines.select("file", "start", "opens", "stays").mapInArrow(run, "file string, start long, opens boolean, stays boolean")


def open_starts(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that start inside a quoted field; one in some hundred megabytes at most, and few of them do."""
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = split_ends(lines).withColumn("before", F.collect_list(F.struct("opens", "stays")).over(along))
    state = F.aggregate("before", F.lit(False), lambda now, s: F.when(now, s["stays"]).otherwise(s["opens"]))
    return {(r["file"], r["start"]) for r in before.where(state).select("file", "start").collect()}


def records_of(lines: DataFrame, opened: set[tuple[str, int]]) -> DataFrame:
    """``(file, start, part, record)``: whole records (part 0, the first of a file -1), and what begins (1) or goes on or ends (2, 3) elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, inside, part = None, [], False, 0
        out: list[tuple[str, int, int, str]] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "part", "record"])

        def put(kind: int) -> None:
            text = "\n".join(held)
            out.append((*at, kind, text.removesuffix("\r") if kind != 1 else text))
            held.clear()

        def finish() -> None:
            if held:  # the field is closed in a later split, or never
                put(2 if part == 3 else 1)

        for batch in batches:
            for file, start, line, opens, stays in walked(batch):
                if at != (file, start):
                    if at:
                        finish()
                    at = (file, start)
                    inside = at in opened
                    part = 3 if inside else (-1 if start == 0 else 0)
                held.append(line)
                inside = stays if inside else opens
                if not inside:
                    if part or line.strip("\r") or len(held) > 1:  # a blank line is no record
                        put(part)
                        part = 0
                    else:
                        held.clear()
            yield rows()
        if at:
            finish()
        yield rows()

    return lines.mapInArrow(run, "file string, start long, part int, record string")


def joined_parts(parts: DataFrame) -> DataFrame:
    """The records that go across splits, from their parts in the order of the file."""
    along = Window.partitionBy("file").orderBy("start", F.expr("CASE part WHEN 1 THEN 1 ELSE 0 END"))
    numbered = parts.withColumn("n", F.count_if(F.col("part") == 1).over(along))
    return numbered.groupBy("file", "n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n").alias("record")
    ).select("record")


def read_csv(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> DataFrame:
    """A CSV file or folder of files with header; every column a string, missing-value cells null.

    A record with more fields than the header has its text in the column ``CORRUPT`` as well; of one
    with fewer the last columns are null. A field that is never closed goes on to the end of its
    file. ``header`` names the columns; otherwise they are those of the first file.
    """
    try:
        names = list(header or spark.read.option("header", True).option("escape", '"').csv(path).columns)
        lines = lines_of(spark, path)
    except AnalysisException as e:
        raise SourceNotFound(path) from e
    records = records_of(lines, open_starts(lines))
    whole = records.where("part = 0").select("record")
    parts = records.where("part > 0").select("file", "start", "part", "record")
    return parsed(whole.union(joined_parts(parts)), names)


def n_fields(record: Column) -> Column:
    return F.regexp_count(F.concat(F.lit(","), record), F.lit(rf"\G,{FIELD}"))


def parsed(records: DataFrame, names: list[str]) -> DataFrame:
    schema = T.StructType([*(T.StructField(f"c{k}", T.StringType()) for k in range(len(names))), T.StructField(CORRUPT, T.StringType())])
    options = {"escape": '"', "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    rows = records.select("record", F.from_csv("record", schema.simpleString(), options).alias("r"))
    cell = lambda k: F.col(f"r.c{k}")
    cells = [F.when(~cell(k).isin(NULL_CELLS), cell(k)).alias(name) for k, name in enumerate(names)]
    surplus = F.col(f"r.{CORRUPT}").isNotNull() & (n_fields(F.col("record")) > len(names))
    return rows.select(*cells, F.when(surplus, F.col("record")).alias(CORRUPT))


def resolve_roles(columns: Sequence[str]) -> Roles:
    """Find the role columns by name; among several candidates the last one wins.

    A name is tried for text first, then label, then type. Without a match the
    text is the first column, the label the last one, and the type the label.
    """
    columns = [c for c in columns if c != CORRUPT]
    marks = {"text": ("text", "message", "tweet"), "label": ("label", "class"), "type": ("type", "category")}
    found: dict[str, str] = {}
    for column in columns:
        role = next((r for r, words in marks.items() if any(w in column.lower() for w in words)), None)
        if role:
            found[role] = column
    label = found.get("label", columns[-1])
    return Roles(found.get("text", columns[0]), label, found.get("type", label))


def roles_table(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """The resolved roles as a table ``(role, column_name)``."""
    return spark.createDataFrame(list(resolve_roles(columns)._asdict().items()), "role string, column_name string")


def select_roles(df: DataFrame, roles: Roles | None = None, *more: str) -> DataFrame:
    """The three role columns of ``df`` as strings named text, label and type, and the columns ``more``."""
    roles = roles or resolve_roles(df.columns)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(r) for r, c in roles._asdict().items()], *more)
