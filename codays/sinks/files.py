"""Text and CSV sinks that replace whatever is at their path once the new files are whole."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame


def replace_folder(rows: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then put it in place of what is there.

    The old files stay as they are until the new ones are complete, so a failed
    write loses nothing, and ``rows`` may come from the very files it replaces.
    Where a file system renames by copying, as object stores do, the old files are
    set aside first and put back if the new ones cannot take their place.
    """
    spark = rows.sparkSession
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = path_of(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Readers of the folder above pass over names that begin with an underscore.
    mark = uuid.uuid4().hex
    new = path_of(target.getParent(), f"_{target.getName()}-new-{mark}")
    old = path_of(target.getParent(), f"_{target.getName()}-old-{mark}")
    try:
        write(new.toString())
        had_old = files.exists(target)
        if had_old and not files.rename(target, old):
            raise OSError(f"{path} cannot be set aside")
        moved = False
        try:
            moved = files.exists(new) and files.rename(new, target)
        finally:
            if had_old and not moved:
                files.rename(old, target)
        if not moved:
            raise OSError(f"new files cannot take the place of {path}")
        if had_old:
            files.delete(old, True)
    finally:
        files.delete(new, True)


def overwrite_text(rows: DataFrame, path: str) -> None:
    """One text file from a frame of one row at most with a ``value`` column."""
    replace_folder(rows, path, rows.select("value").coalesce(1).write.text)


def overwrite_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV; ``single_file`` is for frames of a few rows."""
    out = rows.coalesce(1) if single_file else rows
    replace_folder(rows, path, out.write.option("header", True).csv)
