"""Helpers the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Text of one step in a Python worker, so that its memory does not follow the batch.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, lambdas inside it included."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_hash(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text (null: empty text), by modulus."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: ``spark.checkpoint.dir``, which all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = f"file:/tmp/checkpoints/{uuid.uuid4().hex}"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def saved(frame: DataFrame) -> DataFrame:
    """The frame as a checkpoint in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: smaller than a checkpoint."""
    path = f"{shared_folder(frame.sparkSession)}/{uuid.uuid4().hex}.parquet"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        step = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)


class Interner:
    """Numbers for words, forgotten as soon as more than ``most`` are known."""

    def __init__(self, number: Callable[[bytes], int], most: int = 300_000) -> None:
        self.number, self.most, self.known = number, most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known, number = self.known, self.number
        for word in set(words).difference(known):
            known[word] = number(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words_of(column: pa.Array, hashed: Interner) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Per text its words; the hashes of all words in a row; where each text begins in them."""
    split = [t.split() for t in texts(column)]
    starts = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(w) for w in split], out=starts[1:])
    flat = [w for ws in split for w in ws]
    return split, hashed(flat), starts


def kgram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each place on (shorter by k - 1)."""
    n = max(len(words) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j : j + n]
    return mix(out)



def shingles(words: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and where each text begins in them.

    A text of fewer words is one shingle; one without words has none.
    """
    lengths = np.diff(starts)
    counts = np.where(lengths >= k, lengths - k + 1, np.minimum(lengths, 1))
    out = np.zeros(len(starts), np.int64)
    np.cumsum(counts, out=out[1:])
    places = np.arange(out[-1]) + np.repeat(starts[:-1] - out[:-1], counts)
    grams = kgram_hashes(np.concatenate([words, np.zeros(k, np.uint64)]), k)
    found = grams[places]
    for text in np.flatnonzero((lengths > 0) & (lengths < k)):
        own = words[starts[text] : starts[text + 1]]
        found[out[text]] = kgram_hashes(np.append(own, np.uint64(len(own))), len(own) + 1)[0]
    return found, out
