"""CSV event tables: all-string scan and column binding, for one file or for many."""

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codays.fixed_values import EVENT_COLUMNS
from codays.session import staging_path

#: Larger than any file, and still far from overflow when added for a million files.
ONE_FILE_PER_TASK = 1 << 42
#: Files whose header differs from the most common one, up to which their list is broadcast.
MOST_BROADCAST_FILES = 100_000


def read_event_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with every column a string; short rows are padded with nulls."""
    return spark.read.option("header", True).csv(path)


def bind_columns(raw: DataFrame) -> DataFrame:
    """Latitude, longitude and date by position, by name where the position is null.

    The name is matched exactly. A table with too few columns binds nulls, so
    that its rows are rejected later and can still be counted.
    """
    names = raw.columns
    by_position = raw.toDF(*[f"c{i}" for i in range(len(names))])
    last_index = {name: i for i, name in enumerate(names)}

    def bound(position: int, name: str):
        if len(names) <= position:
            return F.lit(None).cast("string").alias(name)
        value = F.col(f"c{position}")
        if name in last_index:
            value = F.coalesce(value, F.col(f"c{last_index[name]}"))
        return value.alias(name)

    return by_position.select(*[bound(i, name) for i, name in enumerate(EVENT_COLUMNS)])


def load_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan and bind; rows are still raw text."""
    return bind_columns(read_event_csv(spark, path))


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, names: the header of every CSV file, which is its first line that is not blank.

    Each file is one task, which ends after the first lines. The result is staged.
    """

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, line in zip(batch.column(0), batch.column(1)):
                names = next(csv.reader([line.as_py()]), [])
                if line.as_py().strip():
                    types = [pa.string(), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((file.as_py(), names), types)], ["file", "names"])
                    return

    # A session of its own, so that the size of scan tasks stays as it is elsewhere.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(ONE_FILE_PER_TASK))
    apart.conf.set("spark.sql.files.openCostInBytes", str(ONE_FILE_PER_TASK))
    lines = apart.read.text(path).select(F.col("_metadata.file_path"), "value")
    target = staging_path(spark, "headers")
    lines.mapInArrow(first_line, "file string, names array<string>").write.parquet(target)
    return spark.read.schema("file string, names array<string>").parquet(target)


def _last_place(name: str) -> Column:
    """Where a header has exactly this name, from 0 on, the last one if it comes again."""
    places = F.transform("names", lambda n, i: F.when(n == name, i))
    return F.array_max(places).alias(f"at_{name}")


def load_event_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """latitude, longitude, date as text, file, and the record of every row of many files.

    As ``load_events``, but each file's own header says which column fills in
    where a position is null, and tells the columns: rows with fewer are filled
    up with nulls. ``record`` is the line as it stands where it has not as many
    values as the widest header, else its values as CSV.
    """
    headers = file_headers(spark, path)
    places = [f"at_{name}" for name in EVENT_COLUMNS]
    placed = headers.select("file", F.size("names").alias("width"), *[_last_place(name) for name in EVENT_COLUMNS])
    kinds = placed.groupBy(*places).agg(F.count("*").alias("n"), F.max("width").alias("width"))
    # One row: the most common places, and the widest header of all.
    common = kinds.agg(F.max(F.struct("n", *places)).alias("most"), F.max("width").alias("width")).first()
    width = max(common["width"] or 0, len(EVENT_COLUMNS))
    usual = [common["most"][at] if common["most"] else None for at in places]
    others = placed.where(~F.coalesce(F.equal_null(F.struct(*places), F.struct(*[F.lit(at).cast("int").alias(n) for n, at in zip(places, usual)])), F.lit(False)))

    columns = [f"c{i}" for i in range(width)]
    scan = (
        spark.read.schema(", ".join(f"{c} string" for c in [*columns, "line"]))
        .option("header", True)
        .option("columnNameOfCorruptRecord", "line")
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    record = F.coalesce("line", F.to_csv(F.struct(*columns))).alias("record")
    n_others = others.count()
    if n_others:
        rows = others.select("file", F.lit(True).alias("other"), *places)
        scan = scan.join(F.broadcast(rows) if n_others <= MOST_BROADCAST_FILES else rows, "file", "left")

    def bound(position: int, name: str) -> Column:
        value = F.col(columns[position])
        at = F.lit(usual[position]).cast("int")
        if n_others:
            at = F.when(F.col("other"), F.col(f"at_{name}")).otherwise(at)
        return F.coalesce(value, F.get(F.array(*columns), at)).alias(name)

    return scan.select(*[bound(i, name) for i, name in enumerate(EVENT_COLUMNS)], "file", record)
