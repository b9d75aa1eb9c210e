"""Session settings and tables staged in the cluster's shared folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_local_folders: dict[str, str] = {}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("codays")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local run without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = context.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="codays-")
    return _local_folders[application]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/codays/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application for clean-up."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove every table that this application has staged; frames that read them end here."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, *folders: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table and go on from the written files.

    Rows with different values of ``folders`` go into different folders of it.

    Several later branches then read a small columnar table instead of
    repeating the work behind it, and a lost executor cannot undo that work.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path, partitionBy=list(folders) or None, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Meanwhile rows go to Python in batches of about ``size`` bytes; for steps that run at once, with wide rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffle_width(spark: SparkSession, num_partitions: int | None = None) -> int:
    """Partitions for a shuffle whose output is far larger than its input.

    Adaptive coalescing looks at input bytes only and would fold a quadratic
    join into very few tasks, so those shuffles ask for this many by number.
    """
    return num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
