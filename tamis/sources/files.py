"""Delimited and parquet files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamis.sources.records import (
    BLANK,
    QUOTED,
    UnclosedQuote,
    delimited_records,
    fold_splits,
    header_names,
    small,
)

_RAW = "_corrupt_record"
_OPTIONS = {
    "escape": '"',
    "columnNameOfCorruptRecord": _RAW,
    "columnPruning": "false",
}


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.option("header", True).csv(path)


def read_csv_infer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header and inferred types.

    Inference reads the whole input once more; pass ``schema`` where the types
    are known.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def write_csv(
    rows: DataFrame, path: str, *, header: bool = False, mode: str = "errorifexists"
) -> None:
    rows.write.mode(mode).option("header", header).csv(path)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet data below ``path``; None where the path is missing or empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_delimited_rows(
    spark: SparkSession, path: str, *, multiline: bool | None = None
) -> DataFrame:
    """CSV rows as string cells: an empty cell is ``''``, an absent one is null.

    Cells beyond the header are dropped; an empty line is a row of nulls.  Files
    may have headers of their own: cells go by name, a name that a file lacks is
    null, of a repeated name the last cell counts.  A file whose last quoted cell
    never ends is refused by name.

    One pass over the text finds out whether quoted cells hold line breaks.  If
    so, or if headers differ, records are put together from lines in a second
    pass; else files are read as they are.  ``multiline=False`` says that all files
    have one header and no line breaks, and spares the first pass.  Either way a
    file is read by as many tasks as it has splits.
    """
    if multiline is False:
        names = spark.read.options(header=True, **_OPTIONS).csv(path).columns
        return _plain_rows(spark, path, _Layout(names), blanks=True)
    splits = fold_splits(spark, path)
    first = splits.where("split = 0")
    least, most, lacking = first.agg(
        F.min("header"), F.max("header"), F.bool_or(F.col("header").isNull())
    ).first()
    if lacking:
        raise UnclosedQuote(f"a header below {path} does not end in its first split")
    if least is None:
        return spark.createDataFrame([], "value string")
    broken, blanks = splits.agg(F.bool_or("broken"), F.bool_or("blank")).first()
    layout = _Layout(header_names(least)) if least == most else None
    if layout and not broken:
        return _plain_rows(spark, path, layout, blanks=bool(blanks))
    records = delimited_records(spark, path, splits)
    if layout:
        return _record_rows(records, layout, layout.names)
    return _rows_by_header(records, first)


def _schema(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width)) + f", {_RAW} string"


def _cells(width: int) -> list[Column]:
    """The cells of a row that was parsed by ``_schema``; those it does not have are null."""
    # Only rows with too few or too many cells carry their raw text.
    raw = F.col(_RAW)
    bare = F.regexp_replace(raw, rf'(^|,){QUOTED}"', "$1")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    return [F.when(raw.isNull() | (commas >= i), F.coalesce(f"c{i}", F.lit(""))) for i in range(width)]


def _named(cells: list[str]) -> list[str]:
    return [cell or f"_c{i}" for i, cell in enumerate(cells)]


class _Layout:
    """The cells of a header: their names in order, and the place that counts for each."""

    def __init__(self, cells: list[str]):
        cells = _named(cells)
        self.width = len(cells)
        self.place = {name: i for i, name in enumerate(cells)}  # the last one of a name
        self.names = list(self.place)

    @property
    def schema(self) -> str:
        return _schema(self.width)

    def cells(self, names: list[str]) -> list[Column]:
        cells = _cells(self.width)
        return [cells[self.place[name]].alias(name) for name in names]

    def blank_cells(self, names: list[str], text: Column) -> list[Column]:
        """An empty line has no cells, a blank one is its own first cell."""
        first = F.when(text != "", text)
        none = F.lit(None).cast("string")
        return [(first if self.place.get(name) == 0 else none).alias(name) for name in names]


def _plain_rows(spark: SparkSession, path: str, layout: _Layout, *, blanks: bool) -> DataFrame:
    reader = spark.read.options(header=True, multiLine=False, **_OPTIONS)
    rows = reader.schema(layout.schema).csv(path).select(*layout.cells(layout.names))
    if not blanks:
        return rows
    line = F.col("value")
    blank = spark.read.text(path).where(line.rlike(BLANK))
    return rows.unionByName(blank.select(*layout.blank_cells(layout.names, line)))


def _record_rows(records: DataFrame, layout: _Layout, names: list[str]) -> DataFrame:
    record = F.col("record")
    parsed = F.from_csv(record, layout.schema, _OPTIONS)
    rows = records.select("record", F.inline(F.array(parsed)))
    cells = zip(names, layout.cells(names), layout.blank_cells(names, record))
    blank = record.rlike(BLANK)
    return rows.select(*(F.when(blank, b).otherwise(c).alias(name) for name, c, b in cells))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [_named(header_names(header)) for header in batch.column(1).to_pylist()]
        columns = [*batch.columns, pa.array(names, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["file", "header", "names"])


def _rows_by_header(records: DataFrame, first: DataFrame) -> DataFrame:
    """Records of files with any number of different headers, parsed in one scan.

    Records are parsed as wide as the widest header; each cell is then looked up at the place
    that its name has last in the header of the record's own file.
    """
    schema = "file string, header string, names array<string>"
    headers = first.select("file", "header").mapInArrow(_headers, schema)
    width = headers.agg(F.max(F.size("names"))).first()[0]
    each = headers.select("header", F.posexplode("names").alias("place", "name"))
    named = each.groupBy("name").agg(F.min(F.struct("header", "place")).alias("at"))
    every = [r.name for r in named.orderBy("at").collect()]  # the columns of the result
    own = headers.select("file", "names")
    rows = records.join(small(own), "file")
    parsed = F.from_csv(F.col("record"), _schema(width), _OPTIONS)
    rows = rows.select("record", "names", F.inline(F.array(parsed)))
    rows = rows.select("record", "names", F.array(*_cells(width)).alias("cells"))
    blank = F.col("record").rlike(BLANK)

    def cell(name: str) -> Column:
        back = F.array_position(F.reverse("names"), name)
        place = F.when(back > 0, F.size("names") - back).cast("int")  # from 0; null if absent
        # an empty line has no cells, a blank one is its own first cell
        of_blank = F.when((place == 0) & (F.col("record") != ""), F.col("record"))
        return F.when(blank, of_blank).otherwise(F.get("cells", place)).alias(name)

    return rows.select(*map(cell, every))
