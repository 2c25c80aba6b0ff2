"""What the operators share: reading, splitting words, hash shares, sorted group scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.session import ship_package, stage

__all__ = ["SPACES", "WORD", "crc_share", "documents_of", "grouped_batches", "partitions", "read", "ship_package", "stage", "table_of", "unused"]

# Fixed character classes of the contracts: white space, and everything else.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents_of(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null becomes empty), whatever else the frame holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def unused(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until ``frame`` has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_share(doc_id: Column, parts: int) -> Column:
    """Remainder of crc32 of the id written as text: the fixed split of labelled rows."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_of(batch: pa.RecordBatch) -> pa.Table:
    return pa.Table.from_batches([batch])


def grouped_batches(batches: Iterator[pa.RecordBatch], key: str, work: Callable[[pa.Table], pa.Table], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Feed ``work`` with tables that hold whole groups of ``key``.

    The input is a partition sorted by ``key``.  Groups that end inside a batch
    are passed on at once, many in one table; the last group waits for the next
    batch.  Memory is a batch plus the largest group, so keys must come with
    bounded groups.
    """
    held: list[pa.RecordBatch] = []

    def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows:
            yield from work(table.combine_chunks()).to_batches(max_chunksize=rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        last = keys[len(keys) - 1].as_py()
        cut = len(keys)
        if keys[0].as_py() == last:
            cut = 0
        else:
            import pyarrow.compute as pc

            cut = pc.index(keys, keys[len(keys) - 1]).as_py()
        if cut:
            ready = pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
            yield from passed(ready)
        elif held and held[0].column(batch.schema.get_field_index(key))[0].as_py() != last:
            yield from passed(pa.Table.from_batches(held))
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield from passed(pa.Table.from_batches(held))
