"""Best-fit packing of tokenised documents into sequences, with matching of large items.

Only the number of pieces of each length decides how full sequences are, and there are
at most ``capacity`` lengths. So the plan is made for lengths with counts, on the driver,
and has a size that does not depend on the documents: items above a third of the capacity
fit at most twice, so the largest is matched with the largest that still fits; smaller
ones, largest first, go where the least room is left. The pieces then get their places
by their rank among pieces of the same length, in parallel.

A null text is empty; an empty text is its end token alone. Repeated rows are packed
each. Only documents over the capacity are cut. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import saved, slices, texts

CAPACITY = 4096
END = 1
# Parts of the pieces of one length; a part is ranked in one task.
PARTS = 256


# Words of plain Latin letters and what may follow them: their pieces are known without
# the tokenizer's own splitting, which takes most of its time.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


def byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: printable ones
    stand for themselves, the others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    return Subwords(path)


class Numbers(dict[bytes, int]):
    """Numbers of words from 0 on, in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


class Subwords:
    """Token ids of texts, word by word: white space always ends a word of this vocabulary.

    Words seen before are looked up; at most about ``most`` are remembered, and as many
    pieces of words apart from them: forgetting the words keeps the pieces.
    """

    def __init__(self, path: str, most: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.letters = byte_letters()
        self.parts: dict[str, list[int]] = {"": []}
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.flat = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def part(self, text: str) -> list[int]:
        """Ids of letters or marks that the vocabulary takes as one piece."""
        found = self.parts.get(text)
        if found is None:
            written = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            found = self.parts[text] = [t.id for t in self.tokenizer.model.tokenize(written)]
        return found

    def new(self, words: list[bytes]) -> list[list[int]]:
        found, parts, plain, part = [], self.parts, PLAIN.fullmatch, self.part
        for word in words:
            text = word.decode("utf-8", "replace")
            if match := plain(text):
                letters, marks = match.groups()
                letters = letters.lower()
                ids = parts.get(letters) or part(letters)
                found.append(ids + (parts.get(marks) or part(marks)) if marks else ids)
            else:
                found.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return found

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Places of the words among the known ones, to which new words are added."""
        if len(self.known) > self.most:
            self.forget()
        if len(self.parts) > self.most:
            self.parts = {"": []}
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        size = len(self.starts) - 1
        if size < len(self.known):
            found = self.new(list(islice(self.known, size, None)))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
            self.flat = np.concatenate([self.flat, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return at

    def spelled(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words one after the other; the first id of each word."""
        lengths = self.starts[at + 1] - self.starts[at]
        begin = np.zeros(len(at) + 1, np.int64)
        np.cumsum(lengths, out=begin[1:])
        return self.flat[np.arange(begin[-1]) + np.repeat(self.starts[at] - begin[:-1], lengths)], begin

    def encode(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words of all texts; the first id of each word, and of each text."""
        ids, begin = self.spelled(self.numbers([w for words in split for w in words]))
        text = np.zeros(len(split) + 1, np.int64)
        np.cumsum([len(w) for w in split], out=text[1:])
        return ids, begin, begin[text]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = subwords(path)
        for batch in slices(batches):
            ids, _, texts_at = tokens.encode([t.split() for t in texts(batch.column("text"))])
            rows = []
            for doc, low, high in zip(
                batch.column("doc_id").to_pylist(), texts_at.tolist(), texts_at[1:].tolist()
            ):
                own = np.append(ids[low:high], np.int32(end)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    cut = own[start : start + capacity]
                    rows.append((doc, piece, start, len(cut), zlib.crc32(cut.tobytes()), cut))
            doc, piece, start, length, crc, cut = zip(*rows)
            columns = [
                pa.array(doc, pa.int64()),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(list(cut), pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False
) -> DataFrame:
    """The token pieces of every document, with their ids if asked for."""
    schema = PIECES if keep_ids else PIECES.rpartition(",")[0]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end, keep_ids), schema)


class Plan:
    """Places for so many pieces of each length.

    ``places`` has, for ranks ``low`` to ``high`` of a length, the sequence and offset of
    the first, and how many of them follow each other in one sequence.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = dict(counts)
        self.ranked = dict.fromkeys(counts, 0)
        self.sequences = 0
        self.places: list[tuple[int, int, int, int, int, int]] = []
        # Open sequences by room: the same room may hold several runs of sequences.
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

        large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
        self._match(large)
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._fit(length)

    def _place(self, length: int, first: int, sequences: int, each: int, offset: int) -> None:
        n, low = sequences * each, self.ranked[length]
        self.places.append((length, low, low + n, first, each, offset))
        self.ranked[length] += n
        self.left[length] -= n

    def _opened(self, first: int, sequences: int, room: int) -> None:
        if room and sequences:
            if room not in self.open:
                bisect.insort(self.rooms, room)
                self.open[room] = []
            self.open[room].append((first, sequences))

    def _match(self, large: list[int]) -> None:
        for length in large:
            while self.left[length]:
                rest = self.capacity - length
                mate = next((m for m in large if m <= min(rest, length) and self.left[m]), None)
                if mate == length and self.left[length] == 1:
                    mate = next((m for m in large if m < length and self.left[m]), None)
                n = self.left[length]
                if mate == length:
                    n //= 2
                elif mate:
                    n = min(n, self.left[mate])
                first, self.sequences = self.sequences, self.sequences + n
                if mate == length:
                    self._place(length, first, n, 2, 0)
                else:
                    self._place(length, first, n, 1, 0)
                    if mate:
                        self._place(mate, first, n, 1, length)
                self._opened(first, n, rest - (mate or 0))

    def _fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = min(self.capacity // length, self.left[length])
                n = max(self.left[length] // each, 1)
                self._opened(self.sequences, n, self.capacity)
                self.sequences += n
                continue
            room = self.rooms[at]
            first, sequences = self.open[room].pop()
            if not self.open[room]:
                del self.open[room], self.rooms[at]
            each = min(room // length, self.left[length])
            used = min(sequences, self.left[length] // each)
            self._place(length, first, used, each, self.capacity - room)
            self._opened(first, used, room - each * length)
            self._opened(first + used, sequences - used, room)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, parts: int = PARTS
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    rows = saved(pieces(docs, tokenizer, capacity, end).withColumn("part", part))
    by_part = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    # At most ``capacity`` rows, whatever the documents.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, capacity)
    by_length: dict[int, list[tuple]] = {}
    for length, *place in plan.places:
        by_length.setdefault(length, []).append(tuple(place))
    place = "struct<low:bigint,high:bigint,first:bigint,each:bigint,at:bigint>"
    places = spark.createDataFrame(
        list(by_length.items()), f"length bigint, places array<{place}>"
    )

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy(*keys)) - 1
    ranked = rows.join(before, ["length", "part"]).withColumn("rank", rank + F.col("earlier"))
    mine = F.filter(
        F.col("places"), lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"])
    )
    # Broadcast: the plan has a few rows for each of at most ``capacity`` lengths.
    placed = ranked.join(F.broadcast(places), "length").withColumn("place", F.get(mine, F.lit(0)))
    nth = F.col("rank") - F.col("place.low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("place.first") + F.floor(nth / F.col("place.each"))).cast("long").alias("sequence_id"),
        (F.col("place.at") + nth % F.col("place.each") * F.col("length")).cast("long").alias("offset"),
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, **sizes: int) -> DataFrame:
    """sequence_id and ids of every packed sequence; ``packed`` is what ``pack`` gave.

    A sequence gathers at most ``capacity`` ids. Pieces that are alike are exchangeable:
    their ids are joined once for all of them.
    """
    alike = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = pieces(docs, tokenizer, keep_ids=True, **sizes).dropDuplicates(alike)
    left, right = packed.alias("l"), ids.alias("r")
    same = F.lit(True)
    for key in alike:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    item = F.struct("offset", "r.ids")
    return (
        left.join(right, same)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select("sequence_id", F.flatten(F.col("items.ids")).alias("ids"))
    )
