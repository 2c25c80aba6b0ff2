"""Alignment of two tokenizers over exactly deduplicated texts.

Texts are shuffled by their full content, so each distinct one is tokenised and
aligned once.  Its links (a token of either side ending at the same byte) are kept
as distinct id pairs with counts; corpus-wide counts weigh them by the text's
copies.  The measures go back to the documents by the text's digest.

Both tokenizers work on stretches of blanks and a word on their own, as no piece
spans the start of a blank, so a worker aligns a stretch once and remembers it.
Texts with other white space are aligned in one piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import documents_of, ship_package, stage

# Pairs whose corpus-wide counts are sent to every task (17 bytes each); beyond, the texts' pairs are joined with them.
BROADCAST_PAIRS = 4_000_000
# Strings that a worker remembers, characters tokenised in one go, texts worked on at once, pairs gathered before they are added up.
REMEMBERED = 500_000
CHUNK = 1500
TEXTS = 256
GATHERED = 4_000_000

BLANK = "▁"  # how pieces write a space
_STRETCHES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# Any other white space, and the piece form of a space: such texts go in one piece.
_ODD = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　▁]")
# Characters on which the faster library splits as the vocabulary file does.
_PLAIN = re.compile(r"[\n\x20-\x7e\xa1-ſ–-…€]*")


@dataclass(frozen=True)
class Vocabularies:
    """Paths: byte-level vocabulary (A), its ranks and split pattern for a faster library, piece model (B)."""

    bytes_path: str
    pieces_path: str
    ranks_path: str | None = None
    pattern: str | None = None


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones as they are, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Token ids of both sides and their groups, for many strings at once."""

    def __init__(self, vocabularies: Vocabularies):
        import sentencepiece
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabularies.bytes_path)
        self.slow.encode_special_tokens = True
        self.fast = None
        if vocabularies.ranks_path:
            import tiktoken

            with open(vocabularies.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=vocabularies.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocabularies.pieces_path)
        letters = byte_letters()
        size = self.slow.get_vocab_size(with_added_tokens=True)
        entries = [self.slow.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        n = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        self.blank = self.pieces.piece_to_id(BLANK)
        # a stretch stands on its own only if no piece goes from another character into a blank
        self.splits = self.blank > 0 and not any(re.search(rf"[^{BLANK} \n][{BLANK} \n]|\n[^\n]|[{BLANK} ]\n", p) for p in names)
        self.width = n
        self.a_lengths = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(b) for b in self.b_bytes], np.int64)
        self.digits = np.array([[f"{i}{c}" for i in range(max(size, n))] for c in ",|;"], dtype="S8")

    def a_ids(self, text: str, longest: int) -> list[int]:
        fast = self.fast and longest < 2000 and _PLAIN.fullmatch(text)
        return self.fast.encode_ordinary(text) if fast else self.slow.encode(text, add_special_tokens=False).ids

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of strings whose first blank, where they begin with one, is the one that the tokenizer adds itself."""
        found = self.pieces.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            if t == " ":
                found[i] = [self.blank]
            elif t[:1] != " " and found[i][:1] == [self.blank]:
                found[i] = found[i][1:]
        return found

    def aligned(self, chunks: list[list[str]]) -> Aligned:
        """Counts, links and groups of every string of the chunks, whose strings are tokenised in one go.

        A string whose tokens do not spell it has none and is not ``valid``.
        """
        texts = ["".join(c) for c in chunks]
        a, b = [self.a_ids(t, max(map(len, c))) for t, c in zip(texts, chunks)], self.b_ids(texts)
        raw = [t.encode() for t in texts]
        spelled = [
            b"".join(map(self.a_bytes.__getitem__, x)) == r and b"".join(map(self.b_bytes.__getitem__, y)) == r
            for r, x, y in zip(raw, a, b)
        ]
        if any(len(c) > 1 and not good for c, good in zip(chunks, spelled)):
            return self.aligned([part for c, good in zip(chunks, spelled) for part in ([c] if good else [[s] for s in c])])
        flat_a = np.fromiter(chain.from_iterable(compress(a, spelled)), np.int64)
        flat_b = np.fromiter(chain.from_iterable(compress(b, spelled)), np.int64)
        valid = np.repeat(np.array(spelled, bool), [len(c) for c in chunks])
        sizes = np.array([len(s) if s.isascii() else len(s.encode()) for c in chunks for s in c], np.int64)
        # every string spells its own bytes, so the ends of one after another line up on both sides
        ends_a, ends_b = np.cumsum(self.a_lengths[flat_a]), np.cumsum(self.b_lengths[flat_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        ends = np.cumsum(np.where(valid, sizes, 0))
        if not np.isin(ends[valid], common).all():
            raise ValueError("a token spans two strings of a chunk")
        n_a, n_b, cuts = (np.diff(np.searchsorted(e, ends, side="right"), prepend=0) for e in (ends_a, ends_b, common))
        codes = flat_a[last_a] * self.width + flat_b[last_b]
        written, letters = self._written(flat_a, flat_b, ends_a, ends_b, common, last_a, last_b)
        at = np.concatenate([[0], np.cumsum(letters)])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        groups = [written[x : y - 1] if y > x else b"" for x, y in pairwise(at)]
        return Aligned(valid, n_a, n_b, cuts, codes, groups)

    def _written(self, flat_a, flat_b, ends_a, ends_b, common, last_a, last_b) -> tuple[bytes, np.ndarray]:
        """All tokens in the order of their groups, A before B, as text with separators, and each token's bytes."""
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        kinds_a, kinds_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        kinds_a[last_a], kinds_b[last_b] = 1, 2
        place_a = np.arange(len(flat_a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(flat_b)) + np.searchsorted(group_a, group_b, side="right")
        tokens = np.empty(len(flat_a) + len(flat_b), self.digits.dtype)
        tokens[place_a], tokens[place_b] = self.digits[kinds_a, flat_a], self.digits[kinds_b, flat_b]
        letters = tokens.view(np.uint8).reshape(len(tokens), -1)
        return letters[letters != 0].tobytes(), (letters != 0).sum(axis=1)


@dataclass
class Aligned:
    """Per string: valid, tokens of both sides, links; ``codes`` of all links in turn; the groups as text."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    links: np.ndarray
    codes: np.ndarray
    groups: list[bytes]


class Memory:
    """Alignments of the strings met so far, as rows of arrays."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.numbers = np.zeros((4, 0), np.int64)  # valid, n_a, n_b, links
        self.starts = np.zeros(1, np.int64)
        self.codes = np.zeros(0, np.int64)

    def learn(self, stretches: list[str], wholes: list[str]) -> None:
        """Align what is new: stretches many at a time, wholes (which others may not follow) one by one."""
        chunks, size = [[w] for w in wholes], CHUNK
        for s in stretches:
            if size >= CHUNK:
                chunks.append([])
                size = 0
            chunks[-1].append(s)
            size += len(s)
        if not chunks:
            return
        found = self.aligner.aligned(chunks)
        self.at.update((s, len(self.groups) + i) for i, s in enumerate(chain.from_iterable(chunks)))
        self.groups += found.groups
        self.numbers = np.hstack([self.numbers, np.stack([found.valid.astype(np.int64), found.n_a, found.n_b, found.links])])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(found.links)])
        self.codes = np.concatenate([self.codes, found.codes])


@dataclass
class Measured:
    """Per text: tokens of both sides, links, the digest of the groups, and its distinct link codes with counts."""

    n_a: np.ndarray
    n_b: np.ndarray
    links: np.ndarray
    digests: list[str]
    starts: np.ndarray
    codes: np.ndarray
    counts: np.ndarray


def measured(texts: list[str], memory: Memory) -> Measured:
    """Align each text once, with the blank in front that both sides read."""
    aligner = memory.aligner
    whole = [not aligner.splits or _ODD.search(t) is not None for t in texts]
    split = [[] if not t else [f" {t}"] if w else _STRETCHES.findall(f" {t}") for t, w in zip(texts, whole)]
    if len(memory.at) > REMEMBERED or len(memory.codes) > REMEMBERED * 8:
        memory.clear()
    strings = list(chain.from_iterable(split))
    sizes = np.array([len(r) for r in split], np.int64)
    rows = list(map(memory.at.get, strings))
    new = {s for s, at in zip(strings, rows) if at is None} if None in rows else None
    if new:
        # a text that goes in one piece, and blanks that would run into the next stretch, stand alone
        alone = {r[0] for r, w in zip(split, whole) if w and r}.union(filter(str.isspace, new)) & new
        memory.learn(list(new - alone), list(alone))
        rows = list(map(memory.at.__getitem__, strings))
    flat = np.array(rows, np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    before = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(memory.numbers[:, flat], axis=1)], axis=1)
    sums = before[:, bounds[1:]] - before[:, bounds[:-1]]
    good = (sums[0] == sizes) & (sizes > 0)
    groups = memory.groups
    digests = [
        hashlib.sha256(b";".join(map(groups.__getitem__, rows[x:y]))).hexdigest() if g else ""
        for g, (x, y) in zip(good, pairwise(bounds.tolist()))
    ]
    text_of = np.repeat(np.arange(len(texts)), sizes)
    flat, text_of = flat[good[text_of]], text_of[good[text_of]]
    lengths = memory.numbers[3, flat]
    places = np.repeat(memory.starts[flat] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    space = len(aligner.a_bytes) * aligner.width
    distinct, counts = np.unique(np.repeat(text_of, lengths) * space + memory.codes[places], return_counts=True)
    per_text = np.searchsorted(distinct, np.arange(len(texts) + 1) * space)
    n_a, n_b, links = (np.where(good, s, 0) for s in sums[1:])
    return Measured(n_a, n_b, links, digests, per_text, distinct % space, counts)


_memories: dict[Vocabularies, Memory] = {}

ALIGNED = pa.schema([
    ("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
])


def lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def aligned_texts(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """One row per distinct text: its digest, copies, measures, and its distinct link codes with counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabularies not in _memories:
            _memories[vocabularies] = Memory(Aligner(vocabularies))
        memory = _memories[vocabularies]
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = part.column(0).to_pylist()
                m = measured(texts, memory)
                keys = [hashlib.sha256(t.encode()).digest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.binary()), part.column(1), pa.array(m.n_a), pa.array(m.n_b), pa.array(m.links),
                        pa.array(m.digests), lists(m.starts, m.codes, pa.int64()), lists(m.starts, m.counts, pa.int32()),
                    ],
                    schema=ALIGNED,
                )

    distinct = documents_of(docs).groupBy("text").agg(F.count("*").alias("copies"))
    return distinct.mapInArrow(work, "key binary, copies long, n_a long, n_b long, n_links long, groups_sha256 string, codes array<long>, counts array<int>")


def added_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(code, n, best) of every id pair: its links corpus-wide, and whether its B id has none more often."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            own = batch.column(1)
            copies = np.repeat(batch.column(0).to_numpy(), np.diff(own.offsets.to_numpy()))
            codes = np.concatenate([codes, own.flatten().to_numpy()])
            counts = np.concatenate([counts, batch.column(2).flatten().to_numpy() * copies])
            codes, counts = added_up(codes, counts)
            if len(codes) > GATHERED:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])
                codes, counts = codes[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    parts = aligned.select("copies", "codes", "counts").mapInArrow(work, "code long, n long")
    pairs = stage(parts.groupBy("code").agg(F.sum("n").alias("n")).withColumn("b", F.pmod("code", F.lit(width))), "pairs")
    highest = pairs.groupBy("b").agg(F.max("n").alias("highest"))
    return pairs.join(highest, "b").select("code", "n", (F.col("n") == F.col("highest")).alias("best"))


def looked_up(aligned: DataFrame, counted: Broadcast) -> DataFrame:
    """key, measures, n_best and count_sum from counts that every task holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, totals, best = counted.value
        for batch in batches:
            own = batch.column(5)
            text_of = np.repeat(np.arange(batch.num_rows), np.diff(own.offsets.to_numpy()))
            at = np.searchsorted(codes, own.flatten().to_numpy())
            times = batch.column(6).flatten().to_numpy().astype(np.int64)
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, text_of, times * best[at])
            np.add.at(count_sum, text_of, times * totals[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(n_best), pa.array(count_sum)], [*batch.schema.names[:5], "n_best", "count_sum"])

    return aligned.select("key", "n_a", "n_b", "n_links", "groups_sha256", "codes", "counts").mapInArrow(
        work, "key binary, n_a long, n_b long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )


def joined(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """The same by a join of the texts' pairs with the counts."""
    pairs = aligned.select("key", F.explode(F.arrays_zip("codes", "counts")).alias("p")).select("key", F.col("p.codes").alias("code"), F.col("p.counts").alias("times"))
    sums = pairs.join(counted, "code").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    return aligned.select("key", "n_a", "n_b", "n_links", "groups_sha256").join(sums, "key", "left").na.fill(0, ["n_best", "count_sum"])


def align_tokens(docs: DataFrame, vocabularies: Vocabularies, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that the tokens of a side do not spell, have no
    tokens: zeros and an empty ``groups_sha256``.  Every row counts as an occurrence of
    its text, repeated and missing doc_ids too.  Ties for a B id's highest count are all
    best.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    aligned = stage(aligned_texts(docs, vocabularies), "aligned")
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=vocabularies.pieces_path).get_piece_size()
    counted = stage(pair_counts(aligned, width), "pair-counts")
    if counted.count() <= broadcast_pairs:
        table = counted.orderBy("code").toArrow()
        columns = [table.column(c).to_numpy() for c in ("code", "n", "best")]
        per_text = looked_up(aligned, spark.sparkContext.broadcast((columns[0], columns[1], columns[2].astype(bool))))
    else:
        per_text = joined(aligned, counted)
    keyed = documents_of(docs).select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    # every byte where tokens of both sides end closes a group and links the two that end there
    return keyed.join(per_text, "key").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256"
    )
