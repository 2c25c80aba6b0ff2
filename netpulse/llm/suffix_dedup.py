"""Removal of long repeated passages with a logarithmic family of sorted suffix tables.

Suffixes are sampled by content: every 100-byte string picks the leftmost smallest
of its 32-byte grams, so equal strings pick the same suffix and about one byte in 35
starts one.  A row is a sampled suffix with the run of 100-byte strings that picked
it, and its context is all bytes of that run.  A batch's rows are sorted by (gram,
context) and merge-scanned, in one sort, with every level of the family: a context
seen before is a repeat as a whole.  New contexts make a level, and levels that have
come to equal ranks merge in the scan that the next batch needs anyway.  Where one gram has several contexts, the bytes
themselves are compared string by string.

The order is that of 64-bit fingerprints of the bytes, not of the bytes: the scan asks
for equal strings only, and a row stays 32 bytes instead of 160.  Equality rests on
two fingerprints of 64 bits, gram and context or gram and string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import documents_of, grouped_batches, partitions, ship_package, stage
from netpulse.llm.shingles import CHUNK_BYTES, mixed, power_tables

LENGTH = 100
GRAM = 32
# Batches of the query; rows of one gram whose strings are compared in memory, above that by a shuffle.
BATCHES = 2
GROUP_LIMIT = 2000

_STEP = LENGTH - GRAM + 1  # grams in a string
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_BITS = np.uint64(24)
_RELATIVE = np.uint64(0x9FB21C651E98DF25)
_ROW = "a long, c long, row long, at long, kind byte"


def _prefix(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = power_tables(len(raw))
    return np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)]), down


def _hash(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * down[start]


def sampled_suffixes(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first string's start, number of strings, gram's place behind that start, gram, context) per sampled suffix."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    sums, down = _prefix(raw)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(raw) - GRAM + 1])
    # the gram's upper bits with its place below them: a minimum is then the leftmost smallest
    least = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= _STEP:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[_STEP - width : _STEP - width + n])
    picked = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)

    whole = np.flatnonzero(sizes >= LENGTH)
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, begins[whole], 1)
    np.add.at(inside, np.minimum(begins[whole] + sizes[whole] - LENGTH + 1, n), -1)
    start = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    owner = np.searchsorted(begins, start, side="right") - 1
    fresh = np.ones(len(start), bool)
    fresh[1:] = (picked[start[1:]] != picked[start[:-1]]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(start)))
    low, owner = start[first], owner[first]
    place = picked[low]
    context = mixed(_hash(sums, down, low, low + count + LENGTH - 1) + (place - low).astype(np.uint64) * _RELATIVE)
    return owner, low - begins[owner], count, place - low, grams[place], context


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Texts in lists of about ``CHUNK_BYTES``, with their numbers and starts; longer ones are cut with an overlap that loses no string."""
    parts: list[bytes] = []
    numbers: list[int] = []
    starts: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK_BYTES):
            part = text[at : at + CHUNK_BYTES + LENGTH - 1]
            if held and held + len(part) > CHUNK_BYTES:
                yield parts, numbers, starts
                parts, numbers, starts, held = [], [], [], 0
            parts.append(part)
            numbers.append(i)
            starts.append(at)
            held += len(part)
    if parts:
        yield parts, numbers, starts


def suffixes(docs: DataFrame) -> DataFrame:
    """Sampled suffixes (a, c, row, at, kind) of ``docs`` (row, text).

    ``at`` packs start, number of strings and gram's place.  Of equal contexts in one
    Arrow batch all but the first are known repeats: their kind is 1 instead of 0, and
    they get a gram of their own and no context, so that a passage in a third of all rows is no hot key.
    """
    ship_package(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = frame["row"].to_numpy()
            found = []
            for parts, numbers, starts in _pieces([t.encode("utf-8", "replace") for t in frame["text"]]):
                owner, low, count, place, gram, context = sampled_suffixes(parts)
                at = (np.array(starts, np.int64)[owner] + low) * 65536 + count * 256 + place
                found.append((gram, context, rows[np.array(numbers, np.int64)[owner]], at))
            if not found:
                continue
            gram, context, row, at = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((at, row, context, gram))
            before, after = order[:-1], order[1:]
            here = np.zeros(len(order), bool)
            here[after] = (gram[before] == gram[after]) & (context[before] == context[after])
            own = mixed(row.astype(np.uint64) * _RELATIVE ^ mixed(at.astype(np.uint64)))
            yield pd.DataFrame({"a": np.where(here, own, gram).view(np.int64), "c": np.where(here, 0, context.view(np.int64)), "row": row, "at": at, "kind": here.astype(np.int8)})

    return docs.select("row", "text").mapInPandas(work, _ROW)


def _start(at: Column) -> Column:
    return F.shiftright(at, 16)


def _end(at: Column) -> Column:
    """End of the context: its strings overlap in all but one byte each."""
    return F.shiftright(at, 16) + F.shiftright(at, 8).bitwiseAND(F.lit(255)) + (LENGTH - 1)


class SuffixIndex:
    """Levels of distinct (gram, context) rows; a level of rank r holds 2**r batches.

    Batches must come in ascending order of their rows: what a level holds is
    earlier than what is added.  Every level is a table in the shared folder.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []  # ranks descend, the newest last

    def _due(self) -> tuple[int, int]:
        """How many of the newest levels are to merge (equal ranks, and what that makes equal), and the rank that results."""
        ranks = [rank for rank, _ in self.levels]
        merged, rank = 0, 0
        while len(ranks) > 1 and ranks[-1] == ranks[-2]:
            rank = ranks.pop() + 1
            ranks[-1] = rank
            merged = len(self.levels) - len(ranks) + 1
        return merged, rank

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Index ``batch`` (a, c, row, at, kind).

        Returns the byte runs (row, lo, hi) of its contexts that came before, and the
        rows (a, row, at) of all grams that have several contexts in the whole family.
        """
        merged, rank = self._due()
        stay = len(self.levels) - merged
        # 0: the batch, 1: known repeats in it, 2: a level that merges now, 3: a level that stays as it is
        rows = batch
        for i, (_, level) in enumerate(self.levels):
            rows = rows.unionByName(level.withColumn("kind", F.lit(2 + (i < stay)).cast("byte")))
        group = Window.partitionBy("a")
        order = group.orderBy("c", F.col("kind").desc(), "row", "at")
        scanned = rows.select(
            "*",
            ((F.col("kind") == 1) | F.lag("c").over(order).eqNullSafe(F.col("c"))).alias("seen"),
            (F.min("c").over(group) != F.max("c").over(group)).alias("several"),
        )
        scanned = stage(scanned.where("several OR kind < 3"), "suffixes")
        if merged:
            self.levels[stay:] = [(rank, scanned.where("kind = 2").select("a", "c", "row", "at"))]
        self.levels.append((0, scanned.where("kind = 0 AND NOT seen").select("a", "c", "row", "at")))
        runs = scanned.where("seen").select("row", _start(F.col("at")).alias("lo"), _end(F.col("at")).alias("hi"))
        return runs, scanned.where("several AND NOT seen").select("a", "row", "at")


def _strings(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(suffix, fingerprint, start) of every 100-byte string of the contexts in ``table``."""
    at = table.column("at").to_numpy()
    count = at >> 8 & 255
    contexts = table.column("context").to_pylist()
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    sums, down = _prefix(raw)
    sizes = count + LENGTH - 1
    of = np.repeat(np.arange(len(at)), count)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(sizes) - sizes)[of] + inner
    return of, mixed(_hash(sums, down, begin, begin + LENGTH)), (at >> 16)[of] + inner


def _repeated_runs(table: pa.Table) -> pa.Table:
    """(row, lo, hi) of the strings that an earlier string of the same gram equals; ``table`` holds whole grams."""
    row, gram = table.column("row").to_numpy(), table.column("a").to_numpy()
    of, prints, start = _strings(table)
    order = np.lexsort((start, row[of], prints, gram[of]))
    repeat = np.zeros(len(of), bool)
    before, here = order[:-1], order[1:]
    repeat[here] = (prints[before] == prints[here]) & (gram[of[before]] == gram[of[here]])
    at = np.flatnonzero(repeat)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(at) != 1) | (of[at[1:]] != of[at[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return pa.table({"row": row[of[at[first]]], "lo": start[at[first]], "hi": start[at[last]] + LENGTH})


def _all_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 2048):
            table = pa.Table.from_batches([batch.slice(low, 2048)])
            of, prints, start = _strings(table)
            yield pa.RecordBatch.from_pydict(
                {"a": table.column("a").to_numpy()[of], "print": prints.view(np.int64), "row": table.column("row").to_numpy()[of], "start": start}
            )


def compared(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Byte runs (row, lo, hi) that repeat, for suffixes ``rows`` (a, row, at) whose grams have several contexts.

    The bytes are taken from ``docs`` (row, text).  Grams of up to ``GROUP_LIMIT``
    contexts are compared a gram at a time; the strings of all others are dealt
    out one by one, so that a frequent gram is no large group.
    """
    listed = rows.groupBy("row").agg(F.collect_list(F.struct("a", "at")).alias("listed"))
    texts = docs.select("row", "text").join(listed, "row")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, text, wanted in zip(frame["row"], frame["text"], frame["listed"]):
                raw = text.encode("utf-8", "replace")
                for w in wanted:
                    low = w["at"] >> 16
                    out.append((w["a"], row, w["at"], raw[low : low + (w["at"] >> 8 & 255) + LENGTH - 1]))
            yield pd.DataFrame(out, columns=["a", "row", "at", "context"])

    schema = "a long, row long, at long, context binary"
    contexts = stage(texts.mapInPandas(cut, schema), "contexts")
    crowded = stage(contexts.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_LIMIT).select("a"), "crowded")
    small = contexts.join(crowded, "a", "left_anti").select("a", "row", "at", "context")
    dealt = small.repartition(partitions(docs.sparkSession), "a").sortWithinPartitions("a")
    runs = dealt.mapInArrow(lambda batches: grouped_batches(batches, "a", _repeated_runs), "row long, lo long, hi long")

    strings = contexts.join(crowded, "a", "left_semi").select("a", "row", "at", "context").mapInArrow(_all_strings, "a long, print long, row long, start long")
    place = Window.partitionBy("a", "print").orderBy("row", "start")
    later = strings.withColumn("nth", F.row_number().over(place)).where("nth > 1")
    return runs.unionByName(later.select("row", F.col("start").alias("lo"), (F.col("start") + LENGTH).alias("hi")))


def ordered_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): ``row`` is the doc_id where that is present and unique, else the place in the order by (doc_id, text)."""
    plain = documents_of(docs)
    doubled = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if not doubled.take(1):
        return plain.withColumn("row", F.col("doc_id"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    placed = plain.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return stage(placed.withColumn("row", F.monotonically_increasing_id()), "ordered")


def repeated_passages(docs: DataFrame, batches: int = BATCHES, with_kept: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on demand ``kept``, the bytes that stay.

    A byte goes where a 100-byte string that covers it also starts earlier: in a
    smaller doc_id, or before in the same text.  Texts are UTF-8 bytes, null is
    empty, and texts under 100 bytes lose nothing.  Rows that repeat a doc_id count
    in the order of their texts, missing doc_ids come last; other columns are ignored.
    Runs one job per batch, over ranges of the rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = ordered_rows(docs)
    shares = [i / batches for i in range(1, batches)]
    borders = sorted(set(rows.approxQuantile("row", shares, 0.01))) if shares else []
    index, found, unsettled = SuffixIndex(), [], None
    for low, high in zip([None, *borders], [*borders, None]):
        part = rows if low is None else rows.where(F.col("row") > int(low))
        part = part if high is None else part.where(F.col("row") <= int(high))
        runs, unsettled = index.add(suffixes(part))
        found.append(runs)
    # the last scan saw all levels, so its unsettled rows are those of the whole table
    found.append(compared(rows, unsettled))
    every = found[0]
    for runs in found[1:]:
        every = every.unionByName(runs)
    spans = every.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, listed in zip(frame["doc_id"], frame["text"], frame["spans"]):
                raw = text.encode("utf-8", "replace")
                depth = np.zeros(len(raw) + 1, np.int64)
                for span in () if listed is None else listed:
                    depth[span["lo"]] += 1
                    depth[span["hi"]] -= 1
                gone = np.cumsum(depth)[:-1] > 0
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                edges = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((doc_id, len(raw), len(raw) - len(left), edges, hashlib.sha256(left).hexdigest(), left if with_kept else None))
            result = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            result["doc_id"] = result["doc_id"].astype("Int64")
            yield result

    joined = rows.join(spans, "row", "left").select("doc_id", "text", "spans")
    result = joined.mapInPandas(remove, schema)
    return result if with_kept else result.drop("kept")
