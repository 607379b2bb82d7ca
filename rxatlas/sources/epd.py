"""Prescribing months.

A landing folder holds one or more CSVs per month (``EPD_YYYYMM.csv``, plain or
compressed), each with its own header: columns go by name, and files differ in
their order and in what they have besides.

The landing folder is read in one scan by position. Which position a column has
comes from the headers, one row a file, joined to the rows by
``_metadata.file_path``: a file's later splits don't see its first line, so the
headers are read beforehand, in one job with a task a file that stops after the
file's first lines.
"""

from __future__ import annotations

import csv
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.functions.text import year_text
from rxatlas.schemas import EPD_COLUMNS, EPD_MEASURE_TYPES
from rxatlas.session import materialize

#: Files whose headers may be broadcast; more of them join by shuffle.
MOST_BROADCAST_FILES = 50_000
#: Larger than any file: a split of the header scan is a whole file, and no two files share one.
_WHOLE_FILE = str(1 << 40)
SOURCE_FILE = "source_file"


class BadHeader(ValueError):
    """A landed file whose header lacks needed columns or names one twice."""


def type_epd(df: DataFrame) -> DataFrame:
    """Cast the three measure columns; everything else stays text.

    ANSI casts raise on a malformed number, as the reference's strict
    schema override does.
    """
    return df.select(*[F.col(c).cast(EPD_MEASURE_TYPES[c]).alias(c) if c in EPD_MEASURE_TYPES
                       else F.col(c) for c in df.columns])


@contextmanager
def _conf(spark: SparkSession, **values: str):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def unpacked(spark: SparkSession):
    """While it holds, a scan puts no two files into one task. Packing goes by
    bytes, so that a task gets many compressed months, which have ten times the
    rows of plain ones of that size; large plain files are split as ever."""
    return _conf(spark, **{"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")})


def month_glob(years: list[int] | None = None, months: list[str] | None = None) -> str:
    """The file names of the given years, or of the given YYYYMM months."""
    if months is not None:
        return "*_{" + ",".join(months) + "}[._]*"
    if years is not None:
        return "*_{" + ",".join(str(y) for y in years) + "}[0-9][0-9][._]*"
    return "*.csv*"


def _load(reader, source: str | list[str], kind: str):
    return getattr(reader, kind)(source)


def first_lines(spark: SparkSession, source: str | list[str], glob: str | None = None, n: int = 1, sep: str = ",",
                quote: str = '"') -> DataFrame:
    """(path, lines): the first ``n`` lines of each file below ``source``, cut
    into values.

    One job; each task reads the begin of one file. Empty files have no row. The
    rows (one a file) are written to the checkpoint folder: the job runs once,
    under its own split settings.
    """
    def begin(batches):
        held: dict[str, list[str]] = {}
        for b in batches:
            if held and all(len(x) == n for x in held.values()):
                break  # the split is one file: what is behind its first batch of lines is not read
            for path, line in zip(b.column("path").to_pylist(), b.column("value").to_pylist()):
                own = held.setdefault(path, [])
                if len(own) < n:
                    own.append(line)
        for path, lines in held.items():
            lines[0] = lines[0].lstrip("\ufeff")
            yield pa.RecordBatch.from_pydict({"path": [path], "lines": [list(csv.reader(lines, delimiter=sep, quotechar=quote))]},
                                             schema=pa.schema([("path", pa.string()), ("lines", pa.list_(pa.list_(pa.string())))]))

    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    with _conf(spark, **{"spark.sql.files.maxPartitionBytes": _WHOLE_FILE, "spark.sql.files.openCostInBytes": _WHOLE_FILE}):
        lines = _load(reader, source, "text").select(F.col("_metadata.file_path").alias("path"), "value")
        return materialize(lines.mapInArrow(begin, "path string, lines array<array<string>>"))


def file_headers(spark: SparkSession, source: str | list[str], glob: str | None = None, sep: str = ",",
                 quote: str = '"') -> DataFrame:
    """(path, names): the header of each file below ``source``."""
    return first_lines(spark, source, glob, 1, sep, quote).select("path", F.element_at("lines", 1).alias("names"))


def landed_scan(spark: SparkSession, source: str | list[str], glob: str | None = None, required: list[str] | None = None,
                **options) -> DataFrame:
    """All rows of the landed CSVs as text, columns by name, with SOURCE_FILE.

    ``source`` is a folder (or paths), ``glob`` narrows it by file name before
    anything is read. Columns are the ``required`` ones and any others that some
    file has; a file without one of those others gives nulls. Header lines are
    left out wherever they stand in a file.
    """
    headers = file_headers(spark, source, glob, options.get("sep", ","), options.get("quote", '"'))
    stats = headers.agg(F.count("*").alias("n"), F.max(F.size("names")).alias("width"),
                        F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))).alias("names")).first()
    if not stats.n:
        raise FileNotFoundError("no month file to read")
    required = list(required or [])
    lack = F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), "names")
    bad = headers.select("path", lack.alias("lack"), (F.size(F.array_distinct("names")) < F.size("names")).alias("twice")) \
        .where("size(lack) > 0 or twice").limit(5).collect()
    if bad:
        raise BadHeader("; ".join(f"{r.path}: " + (f"lacks {', '.join(r.lack)}" if r.lack else "a column twice") for r in bad))
    names = required + [c for c in stats.names if c not in required]
    reader = spark.read.option("header", False).schema(", ".join(f"_c{k} string" for k in range(stats.width)))
    for k, v in ({"pathGlobFilter": glob} if glob else {}).items() | options.items():
        reader = reader.option(k, v)
    rows = _load(reader, source, "csv").select(F.array(*[f"_c{k}" for k in range(stats.width)]).alias("_values"),
                                               F.col("_metadata.file_path").alias(SOURCE_FILE))
    where = headers.select(F.col("path").alias(SOURCE_FILE), F.col("names").alias("_names"),
                           *[F.array_position("names", c).cast("int").alias(f"_at{k}") for k, c in enumerate(names)])
    rows = rows.join(F.broadcast(where) if stats.n <= MOST_BROADCAST_FILES else where, SOURCE_FILE)
    rows = rows.where(~F.slice("_values", F.lit(1), F.size("_names")).eqNullSafe(F.col("_names")))
    return rows.select(*[F.get("_values", F.col(f"_at{k}") - 1).alias(c) for k, c in enumerate(names)], SOURCE_FILE)


def read_epd_csv(spark: SparkSession, path: str, year: int | None = None, months: list[str] | None = None,
                 keep_source: bool = False, **options) -> DataFrame:
    """Landed month CSVs (header, all strings), measures typed.

    ``year`` or ``months`` (YYYYMM) narrow the scan by file name. With
    ``keep_source`` each row carries the file it comes from.
    """
    glob = month_glob(None if year is None else [year], months)
    return read_epd_files(spark, path, glob, keep_source, **options)


def read_epd_files(spark: SparkSession, source: str | list[str], glob: str | None = None, keep_source: bool = False,
                   **options) -> DataFrame:
    """The named month files, typed. A column that only some files have is null for the others."""
    if not source:
        raise FileNotFoundError("no month file to read")
    df = landed_scan(spark, source, glob, **options)
    return type_epd(df if keep_source else df.drop(SOURCE_FILE))


def check_epd_headers(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """(path, n_columns, missing, further): every landed file's header against T1."""
    t1 = F.array(*map(F.lit, EPD_COLUMNS))
    h = file_headers(spark, path, month_glob(None if year is None else [year]))
    return h.select("path", F.size("names").alias("n_columns"), F.array_except(t1, "names").alias("missing"),
                    F.array_except("names", t1).alias("further"))


def year_slice(epd: DataFrame, year: int) -> DataFrame:
    """S3 as a row predicate, for data that is not split into files by year."""
    return epd.filter(year_text("YEAR_MONTH") == F.lit(f"{year:04d}"))


def slice_summary(epd: DataFrame) -> DataFrame:
    """Rows and items per year slice, the figures a year's file glob would cover."""
    return (epd.groupBy(year_text("YEAR_MONTH").alias("slice_year"))
            .agg(F.count("*").alias("n_rows"),
                 F.countDistinct("YEAR_MONTH").alias("n_months"),
                 F.sum("ITEMS").alias("items")))
