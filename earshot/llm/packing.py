"""Best-fit packing by minimum bin slack.

What matters to the packing is how many pieces there are of each length, at most
4,096 numbers however large the corpus.  Each step takes the longest length left,
finds by bitset subset sums the fullest sequence around it, and repeats that
pattern as often as the lengths allow, which uses up one of them; so there are few
patterns.  Pieces are then numbered within their length, in Spark, and looked up in
the patterns.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm.common import hand_back, kept, read_documents, released

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Text that is split and encoded at a time.
STEP_BYTES = 4 << 20
# Words of letters whose ids a worker remembers, about 45 bytes each.
REMEMBERED = 500_000
# Marks that form pieces of their own after letters, whatever stands next to them.
MARKS = ".,;:!?#*$%&|()\"-"
# The one letter whose lower case is a letter and a mark.
TURKISH_I = "\u0130"
# Pieces of one length are numbered in groups of about this many.
GROUP = 1_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


@cache
def _tokenizer(path: str) -> tuple[Tokenizer, np.ndarray]:
    """The tokenizer, and which of its ids end a piece of a word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, number in tokenizer.get_vocab().items():
        ends[number] = token.endswith("</w>")
    return tokenizer, ends


@dataclass
class Codes:
    """Runs of ids, all in one array: run ``i`` is ``ids[starts[i]:starts[i] + lengths[i]]``."""

    ids: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        self.starts = np.cumsum(self.lengths) - self.lengths

    def picked(self, runs: np.ndarray) -> Codes:
        """The runs of these numbers one after another; -1 is an empty one."""
        lengths = np.where(runs >= 0, self.lengths[runs], 0).astype(np.int32)
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        at += np.repeat((self.starts[runs] - (ends - lengths)).astype(np.int32), lengths)
        return Codes(self.ids[at], lengths)


class Known:
    """Words met so far and their codes in flat arrays; forgetting them only costs time."""

    def __init__(self, most: int) -> None:
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.codes = Codes(np.empty(0, "<u4"), np.empty(0, np.int32))

    def told(self, words: pa.Array, encode: Callable) -> Codes:
        """The codes of different words; ``encode`` gives the ids and lengths of a list of new ones."""
        if len(self.words) + len(words) > self.most:
            self._forget()
        at = pc.index_in(words, value_set=self.words)
        fresh = words.filter(pc.is_null(at))
        if len(fresh):
            ids, lengths = encode(fresh.to_pylist())
            self.codes = Codes(
                np.append(self.codes.ids, ids),
                np.append(self.codes.lengths, lengths).astype(np.int32),
            )
            at = at.to_numpy(zero_copy_only=False)
            at[np.isnan(at)] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
        return self.codes.picked(np.asarray(at, np.int64))


@cache
def _known(path: str) -> Known:
    return Known(REMEMBERED)


def encode(texts: pa.Array, path: str) -> Codes:
    """Each text's ids; a null text has none.

    This tokenizer drops white space before it forms pieces, so a text's ids are
    those of its white-space-separated words in turn, and each different word is encoded once.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    # The tokenizer lower-cases too, but looks for its special tokens before it does.
    special = pc.match_substring(texts, "<|")
    texts = pc.if_else(special, texts, pc.ascii_lower(texts))
    words = pc.ascii_split_whitespace(texts)
    first, stops = words.offsets[0].as_py(), np.asarray(words.offsets)[1:]
    words = words.flatten().dictionary_encode()
    if not len(words):
        return Codes(np.empty(0, "<u4"), np.zeros(len(texts), np.int64))
    found = _encode_words(words.dictionary, path).picked(np.asarray(words.indices))
    totals = np.append(0, np.cumsum(found.lengths, dtype=np.int64))[stops - first]
    return Codes(found.ids, np.diff(totals, prepend=0))


def _encode_words(words: pa.Array, path: str) -> Codes:
    """Codes of different words: letters and the marks after them are pieces of their own."""
    stems = pc.utf8_rtrim(words, characters=MARKS)
    # Some letters decompose, or lower-case to a letter and a mark.
    still = [is_normalized("NFC", stem) for stem in stems.to_pylist()]
    plain = pc.and_(pc.utf8_is_alpha(stems), pa.array(still, pa.bool_()))
    plain = pc.and_not(plain, pc.match_substring(stems, TURKISH_I))
    marks = pc.replace_substring_regex(words, f"^.*[^{re.escape(MARKS)}]", "")
    letters = pc.if_else(plain, stems, None).dictionary_encode()
    others = pc.if_else(plain, marks, words).dictionary_encode()
    told = _known(path).told(letters.dictionary, lambda fresh: _encode_letters(fresh, path))
    ids, lengths = _encode_each(others.dictionary.to_pylist(), path)
    parts = Codes(np.append(told.ids, ids), np.append(told.lengths, lengths))
    first = pc.fill_null(letters.indices, -1)
    both = np.stack([first, pc.add(others.indices, len(letters.dictionary))], 1)
    found = parts.picked(both.ravel())
    return Codes(found.ids, found.lengths.reshape(-1, 2).sum(1))


def _encode_letters(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Words of letters alone: each ends with an id that ends a piece, so many go as one text.

    All their ids, and how many each has.
    """
    tokenizer, ends = _tokenizer(path)
    ids, lengths = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
    for at in range(0, len(words), 500):
        some = words[at : at + 500]
        joined = tokenizer.encode(" ".join(some), add_special_tokens=False)
        found = np.array(joined.ids, "<u4")
        counts = np.diff(np.flatnonzero(ends[found]), prepend=-1)
        if len(counts) != len(some):  # a letter that this tokenizer does not take for one
            found, counts = _encode_each(some, path)
        ids.append(found)
        lengths.append(counts)
    return np.concatenate(ids), np.concatenate(lengths)


def _encode_each(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    tokenizer, _ = _tokenizer(path)
    ids, lengths = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
    for at in range(0, len(texts), 5_000):
        found = tokenizer.encode_batch(texts[at : at + 5_000], add_special_tokens=False)
        ids += [np.array(f.ids, "<u4") for f in found]
        lengths.append(np.array([len(f.ids) for f in found], np.int64))
    return np.concatenate(ids), np.concatenate(lengths)


def in_steps(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of about ``size`` bytes, or one text if it is longer: first row and one past the last."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, length in enumerate(lengths.tolist()):
        if total and total + length > size:
            yield first, i
            first, total = i, 0
        total += length
    if first < len(lengths):
        yield first, len(lengths)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every row of ``doc_id, text``.

    A row's ids are its text's and the end id (a null text is empty: the end id
    alone); only rows longer than ``capacity`` are cut.
    """
    end = struct.pack("<I", end_id)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for first, last in in_steps(batch.column(1), STEP_BYTES):
                some = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(_pieces(some), PIECE_NAMES)
                hand_back()

    def _pieces(batch: pa.RecordBatch) -> list[pa.Array]:
        codes = encode(batch.column(1), path)
        ids = memoryview(codes.ids).cast("B")
        doc_ids, pieces, starts, lengths, sums = [], [], [], [], []
        for doc_id, at, n in zip(
            batch.column(0).to_pylist(), codes.starts.tolist(), codes.lengths.tolist(), strict=True
        ):
            for piece, start in enumerate(range(0, n + 1, capacity)):
                stop = min(start + capacity, n + 1)
                found = zlib.crc32(ids[4 * (at + start) : 4 * (at + min(stop, n))])
                doc_ids.append(doc_id)
                pieces.append(piece)
                starts.append(start)
                lengths.append(stop - start)
                sums.append(zlib.crc32(end, found) if stop > n else found)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [doc_ids, pieces, starts, lengths, sums]
        return [pa.array(c, t) for c, t in zip(columns, types, strict=True)]

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(pieces, PIECES)


def fullest(available: dict[int, int], capacity: int) -> list[int]:
    """Lengths, longest first, that fill one sequence best around the longest one left.

    Bit ``s`` of the set is on when the lengths seen so far can add up to ``s``;
    lengths go in from the longest, and the search ends once the rest of the
    sequence can be filled exactly.
    """
    lengths = sorted(available, reverse=True)
    first = lengths[0]
    room = capacity - first
    mask, full = (1 << (room + 1)) - 1, 1 << room
    reach, steps = 1, []
    for length in lengths:
        if length > room or reach & full:
            continue
        left = min(available[length] - (length == first), room // length)
        share = 1
        while left > 0:  # binary pieces of the number available
            count = min(share, left)
            steps.append((length, count, reach))
            reach |= (reach << (length * count)) & mask
            left -= count
            share *= 2
    rest, chosen = reach.bit_length() - 1, [first]
    for length, count, before in reversed(steps):
        if not before >> rest & 1:  # this step was needed to reach the sum
            chosen += [length] * count
            rest -= length * count
    return sorted(chosen, reverse=True)


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Sequences as lists of lengths and how often each is used; every piece is in one."""
    left = {length: n for length, n in counts.items() if n}
    found = []
    while left:
        lengths = fullest(left, capacity)
        need = {length: lengths.count(length) for length in lengths}
        times = min(left[length] // n for length, n in need.items())
        found.append((lengths, times))
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return found


def _slots(found: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Which numbers within a length a pattern takes, and where they go."""
    used: dict[int, int] = {}
    rows, first_sequence = [], 0
    for lengths, times in found:
        offset = 0
        for length in dict.fromkeys(lengths):
            per = lengths.count(length)
            low = used.get(length, 0)
            used[length] = low + per * times
            rows.append((length, low, low + per * times, per, first_sequence, times, offset))
            offset += per * length
        first_sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id, offset``.  Any columns beside ``length`` are kept.

    Equal lengths are interchangeable, so it does not matter which piece gets which
    number; repeated rows are pieces of their own.  No piece, no sequence.
    """
    spark = pieces.sparkSession
    # Groups of rows of one length: by length and a salt, so that a length that a third
    # of all pieces share is numbered in many tasks.
    counts = {  # at most ``capacity`` rows
        row["length"]: row["n"]
        for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    slots = _slots(patterns(counts, capacity))
    table = spark.createDataFrame(
        slots,
        "length bigint, low bigint, high bigint, per bigint, first bigint, times bigint, at bigint",
    )
    salts = spark.createDataFrame(
        [(length, -(-n // GROUP)) for length, n in counts.items()], "length bigint, salts bigint"
    )
    keyed = kept(
        pieces.join(F.broadcast(salts), "length").withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "piece"), "salts")
        )
    )
    groups = keyed.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = groups.select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from")
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbers = (
        keyed.withColumn("number", F.row_number().over(within) - 1)
        .join(starts, ["length", "salt"])
        .withColumn("number", F.col("number") + F.col("from"))
    )
    # Capacity bounds the table: a pattern uses up a length, and has few lengths.
    met = numbers.join(
        F.broadcast(table),
        (numbers["length"] == table["length"])
        & (numbers["number"] >= table["low"])
        & (numbers["number"] < table["high"]),
    )
    place = F.col("number") - F.col("low")
    return met.select(
        *[numbers[c] for c in pieces.columns],
        (F.col("first") + F.floor(place / F.col("per"))).alias("sequence_id"),
        (F.col("at") + (place % F.col("per")) * numbers["length"]).alias("offset"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return packed_documents(read_documents(spark, sf_dir))


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every document's pieces and their places, in any columns' presence."""
    return pack(kept(cut(docs, tokenizer or public_tokenizers.path(TOKENIZER))))
