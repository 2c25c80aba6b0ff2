"""Packing documents into sequences of fixed capacity by the sum-of-squares rule.

Documents are tokenised once into piece rows (place, length, checksum), which are
dealt into shards by turns, so that all have the same size whatever the rows hold.
Within a shard every piece goes where the sum over residual gaps of the squared
number of open bins becomes smallest.  A shard is a bounded number of rows: neither
a hot source, a long document nor rows that repeat an id make one large.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import documents_of, ship_package, stage

CAPACITY = 2048
SEPARATOR = 0
# Pieces per shard: what stays open at a shard's end is a dozen or so bins.
SHARD_PIECES = 50_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
PLACED_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-ſ–-…€]")

_encoders: dict[str, object] = {}


class Encoder:
    """Token ids of the vocabulary file ``path`` (the tokenizers library's JSON).

    With ``ranks`` (the same vocabulary as a tiktoken file and its split pattern)
    texts of ordinary Latin characters take the faster library; all others, texts
    with very long unbroken stretches, and texts that hold the string of one of the
    file's added tokens, take the tokenizers library.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        added = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=ranks[1], mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        added = self.added is not None and self.added.search(text)
        if self.fast and not added and not _PLAIN.search(text) and (len(text) < 2000 or max(map(len, text.split()), default=len(text)) < 2000):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids

    @classmethod
    def cached(cls, path: str, ranks: tuple[str, str] | None) -> Encoder:
        if path not in _encoders:
            _encoders[path] = cls(path, ranks)
        return _encoders[path]  # type: ignore[return-value]


def piece_starts(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n_ids``; the first takes the remainder."""
    first = (n_ids - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n_ids, capacity)]


def token_pieces(docs: DataFrame, path: str, ranks: tuple[str, str] | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids if asked for.

    A document is its ids and then one separator, so an empty or null text is one
    id.  Only documents above ``capacity`` are cut.  Rows are tokenised on their
    own: repeated rows and missing doc_ids give pieces of their own.
    """
    ship_package(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.cached(path, ranks)
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = np.array([*encoder.ids(text), SEPARATOR], dtype="<u4")
                for k, (start, length) in enumerate(piece_starts(len(ids), capacity)):
                    own = ids[start : start + length]
                    out.append((doc_id, k, start, length, zlib.crc32(own.tobytes()), own.astype("i4") if with_ids else None))
            result = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            result["doc_id"] = result["doc_id"].astype("Int64")
            yield result

    pieces = documents_of(docs).mapInPandas(work, PIECE_SCHEMA)
    return pieces if with_ids else pieces.drop("ids")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset for each length, in the order given.

    Moving a bin from gap g to gap g - s changes the sum of squares by
    2 (N[g-s] - N[g]) + 2, where closed bins do not count; a new bin adds
    2 N[capacity-s] + 1.  The least change wins, then the smaller remaining gap.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap; full ones are not counted
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    big = np.int64(1) << 40
    for i, size in enumerate(lengths.tolist()):
        rest = capacity - size
        chosen = -1
        if rest:
            here = counts[size:capacity]  # gaps size .. capacity-1
            change = 2 * (counts[:rest] - here) + 2
            change[0] -= 1  # closes the bin
            change[here == 0] = big
            at = int(change.argmin())
            if change[at] <= 2 * counts[rest] + 1 and here[at]:
                chosen = size + at
        if chosen < 0:
            b, gap = made, capacity
            made += 1
        else:
            b, gap = open_bins[chosen].pop(), chosen
            counts[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        left = gap - size
        if left:
            open_bins[left].append(b)
            counts[left] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Stages the pieces, so that the shards can be counted without tokenising twice, and
    deals them by their running number in the staged files, which a lost task finds
    again as it was.  A shard takes its pieces longest first; pieces that agree in all
    columns may change places.  No pieces give no rows; rows that repeat an id, or have
    none, are pieces of their own.
    """
    ship_package(pieces.sparkSession)
    staged = stage(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    shards = max(1, -(-staged.count() // shard_pieces))

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True])
        bins, offsets = sum_of_squares(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = frame["shard"].astype("int64") * 2**32 + bins
        frame["offset"] = offsets
        return frame.drop(columns="shard")

    # the lower 33 bits count the rows of a task; the task's number, hashed, is where its turns begin
    number = F.monotonically_increasing_id()
    turn = number.bitwiseAND(2**33 - 1) + F.pmod(F.xxhash64(F.shiftright(number, 33)), F.lit(shards))
    dealt = staged.withColumn("shard", F.pmod(turn, F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(work, PLACED_SCHEMA)


def packed_sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id and its ids: the pieces' ids in the places that ``pack`` gave them."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    unique = pieces_with_ids.dropDuplicates(key)
    joined = placed.join(unique, [F.coalesce(placed[c], F.lit(-1)) == F.coalesce(unique[c], F.lit(-1)) for c in key])
    ordered = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return ordered.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
