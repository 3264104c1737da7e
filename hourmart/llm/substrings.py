"""Removal of word sequences that occur more than once, by FM-indexes over shards of passages.

Every document streamed through every shard would cost the square of the corpus. So passages
are first routed: the least 8-word hash of each 35-word window is equal for equal windows, and
windows in a row that share it form one short passage. Only passages whose hash occurs at two
places or more can repeat; they are sent to the shard of their hash. A shard indexes its distinct
passages (BWT in a wavelet matrix) and streams them through the index by backward search. The
matching statistics tell which windows occur twice or more: nothing is cut, dropped or sampled.

A hash that very many places share is split: each of its windows is routed by its own content.
Equal passages of one step of a task are counted before they are sent.

A null text has no words. Repeated rows are documents of their own, so all their windows repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Interner, kgram_hashes, slices, stored, texts, words_of
from hourmart.llm.fmindex import DEPTH, FMIndex

WINDOW = 35
GRAM = 8
# Places that share a hash; beyond, its windows are routed one by one.
HOT = 10_000
# Words of one index, unless one hash alone has more.
SHARD_WORDS = 1 << 18


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


class Windows:
    """The windows of a batch of texts and the least gram hash of each."""

    def __init__(self, column: pa.Array, hashed: Interner, window: int) -> None:
        self.split, words, self.starts = words_of(column, hashed)
        self.window, self.grams = window, window - GRAM + 1
        n = len(words)
        self.gram = kgram_hashes(words, GRAM)
        self.least = _slide(self.gram, self.grams, np.minimum) if n >= window else self.gram[:0]
        text = np.repeat(np.arange(len(self.split)), np.diff(self.starts))
        self.text = text[: len(self.least)]
        self.valid = np.arange(len(self.least)) + window <= self.starts[1:][self.text]

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of every place whose gram is the least of some window."""
        if not len(self.least):
            return self.text, self.least
        held = np.where(self.valid, self.least, np.uint64(0))
        edge = np.zeros(self.grams - 1, np.uint64)
        most = _slide(np.concatenate([edge, held, edge]), self.grams, np.maximum)
        places = np.flatnonzero(most[: len(self.gram)] == self.gram)
        text = np.searchsorted(self.starts, places, side="right") - 1
        return text, self.gram[places]

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of all runs that share a hash, within one text."""
        if not len(self.least):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        new = np.ones(len(self.least), bool)
        new[1:] = (
            (self.least[1:] != self.least[:-1])
            | (self.text[1:] != self.text[:-1])
            | (self.valid[1:] != self.valid[:-1])
        )
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(self.least)))
        return first[self.valid[first]], length[self.valid[first]]


def _minimizers(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Interner(xxhash.xxh64_intdigest)
        for batch in slices(batches):
            text, value = Windows(batch.column("text"), hashed, window).minimizers()
            order = np.lexsort((value, text))
            text, value = text[order], value[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(text)))
            rid = batch.column("rid").to_numpy(False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rid[text[first]]),
                    pa.array(value[first].view(np.int64)),
                    pa.array(times.astype(np.int32)),
                ],
                names=["rid", "value", "times"],
            )

    return run


def _passages(window: int, with_content: bool):
    """Passages of candidate hashes: their places, or what they hold."""

    def pieces(batch: pa.RecordBatch, hashed: Interner) -> Iterator[tuple[int, int, int, int, bytes]]:
        found = Windows(batch.column("text"), hashed, window)
        values = batch.column("values").flatten()
        hashes = values.field("value").to_numpy(False).view(np.uint64)
        hot_hashes = np.unique(hashes[values.field("hot").to_numpy(False).astype(bool)])
        first, length = found.runs()
        wanted = np.isin(found.least[first], np.unique(hashes))
        first, length = first[wanted], length[wanted]
        hot = np.isin(found.least[first], hot_hashes)
        step = np.where(hot, 1, found.grams)
        parts = -(-length // step)
        at = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = first[at] + nth * step[at]
        many = np.minimum(step[at], length[at] - nth * step[at])
        words = [w for ws in found.split for w in ws]
        text = found.text[begin]
        for t, s, m, is_hot, value, start in zip(
            text.tolist(),
            begin.tolist(),
            many.tolist(),
            hot[at].tolist(),
            found.least[begin].view(np.int64).tolist(),
            (begin - found.starts[text]).tolist(),
        ):
            content = b" ".join(words[s : s + m + window - 1])
            yield t, start, m, None if is_hot else value, content

    def contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Interner(xxhash.xxh64_intdigest)
        for batch in slices(batches):
            counted: dict[bytes, list] = {}
            for _, _, _, value, content in pieces(batch, hashed):
                counted.setdefault(content, [value, 0])[1] += 1
            digests = [md5(c).digest() for c in counted]
            keys = [
                int.from_bytes(d[:8], "little", signed=True) if v is None else v
                for d, (v, _) in zip(digests, counted.values())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(list(counted), pa.binary()),
                    pa.array([min(n, 2) for _, n in counted.values()], pa.int32()),
                ],
                names=["key", "digest", "content", "times"],
            )

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Interner(xxhash.xxh64_intdigest)
        for batch in slices(batches):
            rows = [(t, s, md5(c).digest()) for t, s, _, _, c in pieces(batch, hashed)]
            text = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid").take(text),
                    batch.column("rid2").take(text),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                names=["rid", "rid2", "start", "digest"],
            )

    return contents if with_content else places


def _repeats(window: int, shard_words: int):
    """Of passages sorted by hash, which of their windows occur twice or more."""

    def search(passages: list[tuple[bytes, list[bytes], int]]) -> pa.RecordBatch:
        words = [w for _, ws, _ in passages for w in ws]
        number = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
        symbols = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        lengths = np.array([len(ws) for _, ws, _ in passages])
        ends = np.cumsum(lengths)
        often = np.array([times > 1 for _, _, times in passages])
        # A passage seen twice is indexed twice: it needs no search itself.
        copies = np.where(often, 2, 1)
        order = np.repeat(np.arange(len(passages)), copies)
        size = lengths[order] + 1
        text = np.zeros(size.sum(), np.int64)
        at = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        inside = at < np.repeat(lengths[order], size)
        text[inside] = symbols[(np.repeat((ends - lengths)[order], size) + at)[inside]]
        index = FMIndex(text, len(number) + 1)
        once = np.flatnonzero(~often)
        found = index.frequent(symbols, (ends - lengths)[once], ends[once], window)
        masks = np.zeros(len(passages), np.uint64)
        for j in range(DEPTH - window + 1):
            place = ends - lengths + j
            there = j <= lengths - window
            hit = found[np.minimum(place, len(found) - 1)] | often
            masks |= np.where(there & hit, np.uint64(1) << np.uint64(j), np.uint64(0))
        some = np.flatnonzero(masks)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([passages[i][0] for i in some], pa.binary()),
                pa.array(masks[some].view(np.int64)),
            ],
            names=["digest", "mask"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[bytes, list[bytes], int]] = []
        size, key, digest = 0, None, None
        for batch in batches:
            for next_key, next_digest, content, times in zip(
                *[batch.column(c).to_pylist() for c in ("key", "digest", "content", "times")]
            ):
                if shard and next_digest == digest:
                    shard[-1] = (digest, shard[-1][1], 2)
                    continue
                if next_key != key and size >= shard_words:
                    yield search(shard)
                    shard, size = [], 0
                key, digest = next_key, next_digest
                shard.append((digest, content.split(), times))
                size += len(shard[-1][1])
        if shard:
            yield search(shard)

    return run


def _removed(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, rid2, marks in zip(
                texts(batch.column("text")),
                batch.column("rid2").to_pylist(),
                batch.column("marks").to_pylist(),
            ):
                words = text.split()
                cover = np.zeros(len(words) + 1, np.int64)
                for mark in marks or ():
                    if mark["rid2"] == rid2:
                        for j in range(DEPTH - window + 1):
                            if mark["mask"] >> j & 1:
                                cover[mark["start"] + j] += 1
                                cover[mark["start"] + j + window] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rows.append((len(words), int(gone.sum()), kept.decode("utf-8", "replace")))
            n, removed, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row, without the words of repeated windows.

    ``window`` is from 9 to 36 words: a passage has to fit the depth of the index.
    """
    if not GRAM < window or 2 * window - GRAM > DEPTH:
        raise ValueError(f"a window of {window} words does not fit an index of depth {DEPTH}")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.xxhash64(F.lit(1), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("rid"),
        F.xxhash64("text", F.lit(2), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("rid2"),
    )
    least = stored(
        rows.select("rid", "text").mapInArrow(
            _minimizers(window), "rid long, value long, times int"
        )
    )
    # Grouped by another form of the hash, the counts are dealt anew for the join, so that
    # a hash with very many places can be split there.
    shared = (
        least.groupBy(F.bitwise_not("value").alias("other"))
        .agg(F.sum("times").alias("n"))
        .filter("n > 1")
        .select(F.bitwise_not("other").alias("value"), (F.col("n") > hot).alias("hot"))
    )
    wanted = (
        least.join(shared, "value")
        .groupBy("rid")
        .agg(F.collect_set(F.struct("value", "hot")).alias("values"))
    )
    streamed = rows.join(wanted, "rid")
    masks = (
        streamed.mapInArrow(
            _passages(window, True), "key long, digest binary, content binary, times int"
        )
        .repartition("key")
        .sortWithinPartitions("key", "digest")
        .mapInArrow(_repeats(window, shard_words), "digest binary, mask long")
    )
    places = streamed.mapInArrow(
        _passages(window, False), "rid long, rid2 long, start int, digest binary"
    )
    marks = (
        places.join(masks, "digest")
        .groupBy("rid")
        .agg(F.collect_set(F.struct("rid2", "start", "mask")).alias("marks"))
    )
    return rows.join(marks, "rid", "left").mapInArrow(
        _removed(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
