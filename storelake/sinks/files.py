"""Parquet and CSV writers."""

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from storelake.session import scratch_path


# Hexadecimal keys, which are most of a fact, take half the room that they take in Spark's default codec.
CODEC = "zstd"

# Extracts are compressed. A compressed file cannot be split, so a task closes one after so many rows: readers then share them.
EXTRACT_ROWS = 500_000


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path, compression=CODEC)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path, compression=CODEC)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a frame and read it back: its work is done once and its real size is known.

    Without a path the table goes to the scratch folder, where a lost executor cannot take it along.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "stored")
    overwrite(df, path)
    return spark.read.schema(df.schema).parquet(path)


def observed_rows(counter: Observation, count: Callable[[], int]) -> int:
    """The counted rows. Spark drops an observation along with an input that it finds empty; then ``count`` tells."""
    return observed(counter, lambda: {"rows": count()})["rows"]


def observed(counter: Observation, measure: Callable[[], dict]) -> dict:
    """The observed values, or what ``measure`` finds where Spark has dropped the observation."""
    try:
        found = counter.get
    except Py4JJavaError:
        found = {}
    return found or measure()


def stored_counted(df: DataFrame, path: str | None = None) -> tuple[DataFrame, int]:
    """``stored`` with the number of rows, counted by the tasks that write them."""
    counter = Observation()
    written = stored(df.observe(counter, F.count(F.lit(1)).alias("rows")), path)
    return written, observed_rows(counter, written.count)


def append_delta(delta: DataFrame, path: str) -> int:
    """Append a delta unless it is empty, and return its row count.

    The delta is staged first: its source is read once, and the count belongs to the very rows
    that are appended even when the source changes meanwhile. The staged copy is deleted afterwards.
    """
    staging = scratch_path(delta.sparkSession, "delta")
    staged, rows = stored_counted(delta, staging)
    if rows:
        append(staged, path)
    delete_folder(delta.sparkSession, staging)
    return rows


def _store_of(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, in whatever store it lies."""
    store, target = _store_of(spark, path)
    store.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    store, target = _store_of(spark, path)
    store.mkdirs(target)


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, target = _store_of(spark, path)
    return store.exists(target)


def subfolders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the folders ``column=value`` in a folder, which need not exist."""
    store, target = _store_of(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the files in a folder."""
    store, target = _store_of(spark, path)
    summary = store.getContentSummary(target)
    return summary.getFileCount(), summary.getLength()


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    store, old = _store_of(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.mkdirs(new.getParent())
    if store.exists(new) or not store.rename(old, new):
        raise OSError(f"{source} cannot become {target}")


def replace_files(spark: SparkSession, source: str, target: str) -> None:
    """Put the one data file of a folder under the name of the one in another folder."""
    store, old = _store_of(spark, target)
    (new,) = [f for f in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{source}/part-*"))]
    (place,) = [f for f in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/part-*"))]
    store.delete(place.getPath(), False)
    store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/.{place.getPath().getName()}.crc"), False)
    store.rename(new.getPath(), place.getPath())


def write_whole(
    df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None], keep_empty: bool = False
) -> int:
    """Write a folder that appears whole, by a rename, or not at all, and return its number of rows.

    Without rows there is no folder, unless ``keep_empty`` is set. One that exists is whole already: it is left as it is, nothing is computed and 0 is returned, so
    that a reader of folders meets each file once. What an earlier failure left behind lies in hidden
    folders, whose names begin with an underscore. In a store that copies instead of renaming, appearance takes as long as the copy.
    """
    spark = df.sparkSession
    if folder_exists(spark, path):
        return 0
    parent, name = path.rstrip("/").rsplit("/", 1)
    staging = f"{parent}/_{name}-{uuid.uuid4().hex}"
    counter = Observation()
    write(df.observe(counter, F.count(F.lit(1)).alias("rows")).write, staging)
    rows = observed_rows(counter, lambda: _row_count(spark, staging))
    if rows or keep_empty:
        move_folder(spark, staging, path)
    else:
        delete_folder(spark, staging)
    return rows


def _row_count(spark: SparkSession, path: str) -> int:
    """Rows of a folder of Parquet or line files that has just been written, none where it holds no data file."""
    if not any(name.endswith((".parquet", ".json", ".csv")) for name in _file_names(spark, path)):
        return 0
    if any(name.endswith(".parquet") for name in _file_names(spark, path)):
        return spark.read.parquet(path).count()
    return spark.read.text(path).count()


def _file_names(spark: SparkSession, path: str) -> list[str]:
    store, target = _store_of(spark, path)
    files, names = store.listFiles(target, True), []
    while files.hasNext():
        names.append(files.next().getPath().getName())
    return names


def write_csv_counted(df: DataFrame, path: str, file_rows: int = EXTRACT_ROWS) -> int:
    """``write_csv`` in gzip files of at most ``file_rows`` rows, and the number of rows that its tasks have written."""
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    write_csv(counted, path, compression="gzip", maxRecordsPerFile=file_rows)
    return observed_rows(counter, df.count)


def write_csv(df: DataFrame, path: str, line_sep: str = "\r\n", **options) -> None:
    """Bronze extract: header, doubled quotes, untrimmed text, nulls and empty text left blank."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("lineSep", line_sep)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
        .csv(path)
    )
