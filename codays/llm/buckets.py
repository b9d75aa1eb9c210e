"""Documents dealt into buckets of bounded size, each met by its own word list.

The words of a corpus are too many to broadcast and too many to look up token
by token in a join. So documents are dealt into buckets of about
``bytes_per_bucket``; a bucket asks for its distinct words once, and what is
known of them comes back to it in a cogroup. A bucket is a partition by its number,
so no task gets two of them.
"""

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.llm.common import text_of

BYTES_PER_BUCKET = 24_000_000


def compressed(rows: pa.Table | pa.RecordBatch) -> bytes:
    """The rows as a block that ``unpacked`` reads."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write(rows)
    return sink.getvalue().to_pybytes()


def packed(docs: DataFrame, bytes_per_bucket: int = BYTES_PER_BUCKET, *more: Column) -> tuple[DataFrame, int, str]:
    """doc_id, text and ``more`` columns of ``docs``, dealt out: the rows of a batch that share a bucket are one block.

    Returns (bucket, block) rows, the number of buckets, and the type of doc_id.
    ``unpacked`` gives the rows of a block back. A shuffle of compressed blocks is much
    smaller than one of texts. The bucket follows from the id and the text, so neither
    copies of a text nor rows without an id gather in one bucket.
    """
    rows = docs.select(F.col("doc_id"), text_of().alias("text"), *more)
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bytes_per_bucket))
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")

    names = rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.concatenate(([True], np.diff(own[order]) != 0))) if len(own) else []
            blocks = []
            for places in np.split(order, starts[1:]) if len(own) else []:
                blocks.append(compressed(batch.select(names).take(pa.array(places))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[order][starts] if len(own) else [], pa.int32()), pa.array(blocks, pa.binary())],
                ["bucket", "block"],
            )

    blocks = rows.select(bucket.alias("bucket"), *names).mapInArrow(pack, "bucket int, block binary")
    return blocks.repartitionById(buckets, "bucket"), buckets, rows.schema["doc_id"].dataType.simpleString()


def give_back() -> None:
    """Memory that a task no longer needs goes back to the system, as its worker lives on beside those of others."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def unpacked(blocks: pa.Array) -> Iterator[pa.Table]:
    """The rows of each block as a table."""
    for block in blocks:
        yield pa.ipc.open_stream(block.as_buffer()).read_all()
