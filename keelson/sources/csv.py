"""Raw tables from CSV files, or from zip archives that hold one CSV each."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.scalar import drop_tokens, to_number, to_time
from keelson.spec import ContractError

#: bytes of CSV text parsed at a time, and the longest row
BLOCK = 1 << 22
LARGEST_BLOCK = 1 << 30
HEADER_BYTES = 1 << 24
#: archives that fit into a cell of a table
CELL_BYTES = (1 << 31) - 1 - (1 << 16)
CORRUPT = "_bad"


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def typed(raw: DataFrame, schema: T.StructType, null_tokens: Iterable[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Text columns to the declared types; null tokens and unparsable values become NULL."""
    cells = []
    for f in schema.fields:
        c = drop_tokens(F.col(f.name), null_tokens)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = to_time(c, T.StringType()).cast(f.dataType)
        elif isinstance(f.dataType, T.NumericType):
            c = to_number(c, T.StringType()).try_cast(f.dataType)
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cells.append(c.alias(f.name))
    return raw.select(*cells, *keep)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, null_tokens: Iterable[str] = (),
             multi_line: bool = False, keep_bad: bool = False) -> DataFrame:
    """CSV files with a header and a declared schema. Malformed lines go to ``_bad`` when ``keep_bad`` is set.

    Columns are found by the header's names, which all files must share; further columns are ignored and, being pruned,
    not parsed. Files are split among tasks; ``multi_line`` allows quoted line breaks, at the price of one task per file.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns  # reads one line, infers nothing
    missing = sorted(set(schema.fieldNames()) - set(header))
    if missing:
        raise ContractError(f"CSV is missing columns: {missing}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in header])
    if keep_bad:
        text = text.add(CORRUPT, T.StringType())
    raw = spark.read.schema(text).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                                          enforceSchema=False).csv(path)
    return typed(raw, schema, null_tokens, [CORRUPT] if keep_bad else [])


def require_rows(df: DataFrame, what: str = "raw table") -> DataFrame:
    """Fail on a table without columns or without rows."""
    if not df.columns:
        raise ContractError(f"{what} has no columns")
    if df.isEmpty():
        raise ContractError(f"{what} has no rows")
    return df


def _members(archive: zipfile.ZipFile) -> list[str]:
    return [n for n in archive.namelist()
            if n.lower().endswith(".csv") and not n.endswith("/") and not n.startswith("__MACOSX/")]


def _opened(content: bytes | None, path: str) -> BinaryIO:
    """An archive that Spark has read, or one too long for a cell, by the file system its path names."""
    if content is not None:
        return io.BytesIO(content)
    try:
        files, inside = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
        return files.open_input_file(inside)
    except (OSError, pa.ArrowInvalid) as e:
        raise ValueError(f"archive beyond {CELL_BYTES} bytes cannot be opened by its path: {str(e).splitlines()[0][:200]}") from None


def _batches(content: bytes | None, path: str, names: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """The CSV of one archive as text columns, unpacked as a stream and parsed a block at a time.

    Raises ValueError with the reason where it cannot be read, at once or after some batches; a field that crosses blocks
    raises ``_Straddles``.
    """
    try:
        with _opened(content, path) as file, zipfile.ZipFile(file) as archive:
            members = _members(archive)
            if len(members) != 1:
                raise ValueError(f"expected one CSV in the archive, found {len(members)}")
            with archive.open(members[0]) as raw:
                header = next(csv.reader([raw.readline(HEADER_BYTES).decode("utf-8-sig")]), [])
            missing = [n for n in names if n not in header]
            if missing:
                raise ValueError(f"columns missing: {missing}")
            with archive.open(members[0]) as raw, pyarrow.csv.open_csv(
                    raw, read_options=pyarrow.csv.ReadOptions(block_size=block, use_threads=False),
                    parse_options=pyarrow.csv.ParseOptions(newlines_in_values=True),
                    convert_options=pyarrow.csv.ConvertOptions(include_columns=names, column_types={n: pa.string() for n in names})) as reader:
                yield from reader
    except zipfile.BadZipFile:
        raise ValueError("not a zip archive") from None
    except (UnicodeDecodeError, pa.ArrowInvalid, zlib.error, EOFError, NotImplementedError, RuntimeError, csv.Error) as e:
        if "straddling" in str(e) and block < LARGEST_BLOCK:
            raise _Straddles from None
        raise ValueError(f"unreadable CSV: {str(e).splitlines()[0][:200]}") from None


class _Straddles(Exception):
    """A row is longer than a block."""


def _block_that_fits(content: bytes | None, path: str, names: list[str], block: int) -> int:
    """Reads the archive once without keeping rows: the block size at which every row fits, or ValueError if the archive
    cannot be read to its end. Blocks grow with the longest row, not with the file."""
    while True:
        try:
            for _ in _batches(content, path, names, block):
                pass
            return block
        except _Straddles:
            block = min(LARGEST_BLOCK, 4 * block)


def read_archives(spark: SparkSession, path: str | list[str], schema: T.StructType, null_tokens: Iterable[str] = (),
                  pattern: str = "*.zip") -> DataFrame:
    """Rows of many archives, one archive per task row: schema columns, ``_source``, ``_line`` and ``_error``.

    Spark's reader brings archives up to 2 GB to their tasks, wherever they are stored; longer ones are opened by their
    path and read as a stream. Unpacked sizes are not limited. See :func:`parse_archives`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    cells = files.where(F.col("length") <= CELL_BYTES).select("path", "content")
    # this side never asks for the content, so its length does not matter
    longer = files.where(F.col("length") > CELL_BYTES).select("path", F.lit(None).cast("binary").alias("content"))
    return parse_archives(cells.unionByName(longer), schema, null_tokens)


def parse_archives(files: DataFrame, schema: T.StructType, null_tokens: Iterable[str] = (), block: int = BLOCK) -> DataFrame:
    """Rows of the archives in (path, content); a null content is opened by its path.

    An unreadable archive yields one row with ``_error`` and no other, instead of failing the job; see
    :func:`require_archives`. To know that before the first row, an archive is read twice. Memory holds the packed bytes
    and one block of about ``block`` bytes (more only for longer rows), not the unpacked file. Quoted line breaks survive.
    """
    names = schema.fieldNames()
    out = _as_text(schema).add("_source", T.StringType()).add("_line", T.LongType()).add("_error", T.StringType())
    columns = [*names, "_source", "_line", "_error"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # one content at a time
                file, content = batch.column("path")[at].as_py(), batch.column("content")[at].as_py()
                try:
                    fitting = _block_that_fits(content, file, names, block)
                except ValueError as e:
                    yield pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.string())] * len(names), pa.array([file]), pa.nulls(1, pa.int64()), pa.array([str(e)])], names=columns)
                    continue
                line = 0
                for part in _batches(content, file, names, fitting):
                    n = part.num_rows
                    whole = [*part.columns, pa.array([file] * n, pa.string()), pa.array(range(line, line + n), pa.int64()), pa.nulls(n, pa.string())]
                    yield from pa.table(whole, names=columns).to_batches(max_chunksize=20_000)
                    line += n

    raw = files.select("path", "content").mapInArrow(parse, out)
    return typed(raw, schema, null_tokens, ["_source", "_line", "_error"])


def require_archives(df: DataFrame) -> DataFrame:
    """The rows of readable archives; fails, naming one problem, if an archive could not be read."""
    bad = df.where(F.col("_error").isNotNull()).select("_source", "_error").limit(1).collect()
    if bad:
        raise ContractError(f"{bad[0]['_source']}: {bad[0]['_error']}")
    return df.drop("_error")
