"""File sources: CSV masters, the transfer manifest, dated folders, logs,
success markers and landed cluster documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C


def read_master_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Headered CSV master table; all columns are text unless a schema is given."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The transfer manifest: ``|``-delimited CSV with a header, all text.

    Columns are found by their header names, in any order; a known column that
    the header lacks is null, further columns follow."""
    df = spark.read.option("header", "true").option("delimiter", C.MANIFEST_DELIMITER).csv(path)
    have = {c.strip().upper(): c for c in df.columns}
    known = [F.col(f"`{have[c]}`").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in C.MANIFEST_COLUMNS]
    return df.select(*known, *[F.col(f"`{c}`") for up, c in have.items() if up not in C.MANIFEST_COLUMNS])


def read_by_format(spark: SparkSession, fmt: str, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """Any source by format name; csv is headered and ``|``-delimited."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("delimiter", C.MANIFEST_DELIMITER)
    else:
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_dated(spark: SparkSession, fmt: str, base: str, indicator: str | None, run_date: dt.date,
               options: dict[str, str] | None = None) -> DataFrame:
    """A ``year=/month=/day=`` partitioned folder, read for one day.

    Indicator null or ``m``: the base folder as it is.  Otherwise the day's
    folder alone is listed and read (month and day with or without a leading
    zero); a day folder that does not exist raises PATH_NOT_FOUND.
    """
    if indicator is None or indicator.lower() == C.BASE_PATH_INDICATOR:
        return read_by_format(spark, fmt, base, options)
    root, missing = base.rstrip("/"), None
    for day in (f"month={run_date:%m}/day={run_date:%d}", f"month={run_date.month}/day={run_date.day}"):
        try:
            return read_by_format(spark, fmt, f"{root}/year={run_date.year}/{day}", options)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = missing or e
    raise missing


def read_positional_csv(spark: SparkSession, path: str, fields: dict[str, int], sep: str = ",") -> DataFrame:
    """Header-less delimited rows, columns picked by 1-based position
    (``{"usecase": 1, "category": 8}``); positions that a row lacks are null,
    whatever the width of the first row."""
    schema = ", ".join(f"_c{i} string" for i in range(max(fields.values())))
    df = spark.read.option("header", "false").option("sep", sep).schema(schema).csv(path)
    return df.select(*[F.col(f"_c{pos - 1}").alias(name) for name, pos in fields.items()])


def read_wide_history(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The wide status history: a header, fixed columns, then one column per day."""
    return spark.read.option("header", "true").option("sep", sep).csv(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with the file they came from (``file_path``, ``file_name``)."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def list_markers(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Names of the marker files in a folder, zero-length ones included (a scan would skip those).

    Only the listing is used; Spark lists many folders in parallel.  Names come
    to the driver: a load date has one marker per table.  A folder that does not
    exist raises PATH_NOT_FOUND."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).inputFiles()
    names = [(unquote(p.rsplit("/", 1)[-1]),) for p in found]
    return spark.createDataFrame(names, "marker string")


def touch_markers(spark: SparkSession, folder: str, names: DataFrame, name_col: str = "marker") -> int:
    """Create the zero-length marker files ``folder/<name>`` that ``list_markers`` finds; the number created.

    Tasks create the files, so the time is shared by all cores and no name comes
    to the driver.  The folder must be one that all executors reach, as with any
    result.  A store that pyarrow cannot open (``viewfs``, say) is written by the
    driver through Hadoop, with the names coming one partition at a time."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    base = make(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(base)
    names = names.select(F.col(name_col).cast("string").alias("name")).filter("name <> ''").distinct()
    uri = fs.makeQualified(base).toUri()
    try:
        store, root = (pafs.LocalFileSystem(), uri.getPath()) if uri.getScheme() == "file" else pafs.FileSystem.from_uri(uri.toString())
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        n = 0
        for row in names.toLocalIterator():
            fs.create(make(base, row[0]), True).close()
            n += 1
        return n

    def create(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                if "/" in name:
                    store.create_dir(f"{root}/{name}".rpartition("/")[0])
                store.open_output_stream(f"{root}/{name}").close()
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return names.mapInArrow(create, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_pages(spark: SparkSession, path: str, page_schema: StructType | str, items: str, token: str,
               request: str = "request") -> DataFrame:
    """The items of landed result pages, one row each, as columns of their own.

    A page is one JSON document (it may span lines) with the list ``items`` and,
    if another page follows, the text ``token``; it lies under
    ``<request>=<token it was asked with>``, the first page under
    ``<request>=first``.  Pages without items give no rows; a page that is not
    such a document fails the read.  The chain of tokens
    must be whole: a token whose page is missing, or a page that no token leads
    to, raises ValueError (names of a few) instead of losing rows."""
    schema = f"{page_schema}, {token} string, {request} string" if isinstance(page_schema, str) else \
        StructType([*page_schema.fields]).add(token, "string").add(request, "string")
    pages = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    check_page_chain(pages, token, request)
    return pages.select(F.inline(items))


def check_page_chain(pages: DataFrame, token: str, request: str, first: str = "first") -> None:
    """Raise if a page's token has no page, if a page is reached by no token, or if the first page is missing."""
    asked = pages.select(F.col(request).alias("t")).distinct()
    led = (pages.select(F.col(token).alias("t")).filter("t is not null and t <> ''")
           .unionAll(pages.sparkSession.createDataFrame([(first,)], "t string")).distinct())
    lost, stray = led.join(asked, "t", "left_anti").limit(5).collect(), asked.join(led, "t", "left_anti").limit(5).collect()
    if lost or stray:
        raise ValueError(f"broken page chain: pages missing for {sorted(r.t for r in lost)}, "
                         f"pages that no page leads to {sorted(str(r.t) for r in stray)}")


def snapshot_times(spark: SparkSession, folder: str, column: str = "snapshot_ts") -> list[str]:
    """Time stamps of the snapshots in a folder, in order (folder names only, no file is read)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_snapshot_as_of(spark: SparkSession, folder: str, as_of: str, column: str = "snapshot_ts") -> DataFrame:
    """The latest snapshot at or before ``as_of`` (time stamps compare as text), its time stamp as last column.

    Only that partition's folder is read.  Without such a snapshot: ValueError."""
    known = [t for t in snapshot_times(spark, folder, column) if t <= as_of]
    if not known:
        raise ValueError(f"no snapshot at or before {as_of} in {folder}")
    return spark.read.parquet(f"{folder}/{column}={known[-1]}").withColumn(column, F.lit(known[-1]))


def read_cluster_docs(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Landed JSON documents (one per line), read with a fixed nested schema."""
    return spark.read.schema(schema).json(path)
