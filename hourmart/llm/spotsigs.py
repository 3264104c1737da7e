"""Document fingerprints from spot signatures (SpotSigs).

A spot is an anchor, one of a few words that are common in running text, with the chain of
content words that follow it. The set of a text's spots is its fingerprint: what stands around
the running text has few anchors and leaves few spots. Sets are compared by Jaccard likeness;
only sets of near lengths can be alike, so lengths are cut into parts such that a set meets
its own part and the two next to it, and frequent spots are looked up last.

A stretch of ``STRETCH`` or more content words without an anchor, such as a list or a text in
another language, has as spots a share of its chains of ``CHAIN`` + 1 words, chosen by their hash,
so that near copies of it are alike, too. A text that has no spot so far has those of all its words,
or the one of least hash; if it is shorter than a chain, one made of all its words. One without words (null included) has the
empty fingerprint, which is like itself alone. Rows with one id follow each other by their text;
null ids come last. The next document of the last one is the first, of a single one itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Interner, kgram_hashes, mix, slices, stored, texts

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """
    a an the is was were are be of and to in that it on for with as at by from
    der die das und ist in von zu mit den dem ein eine auf für nicht im
    le la les de des du et un une est en que qui dans pour pas sur
    el la los las de y en un una es que por con para se del lo
    """.split()
)
CHAIN = 2
# Content words without an anchor from which on chains are spots, and one of how many chains.
STRETCH, SHARE = 12, 4
LIKENESS = 0.8
# How many frequent spots are told apart from the others; results do not depend on it.
OFTEN = 10_000
MARKS = ".,;:!?()[]{}\"'`|*#$%&<>-_/\\"
# Words without letters or digits take no part; anchors have small numbers.
_NOTHING, _CONTENT = 0, 1 << 16


def _number(anchors: dict[str, int]):
    def number(word: bytes) -> int:
        plain = word.decode("utf-8", "replace").lower().strip(MARKS)
        if not plain:
            return _NOTHING
        return anchors.get(plain) or xxhash.xxh64_intdigest(plain.encode()) | _CONTENT

    return number


class Fingerprints:
    """Sorted sets of 32-bit spots of many texts at once."""

    def __init__(self, anchors: Iterable[str] = ANCHORS, chain: int = CHAIN) -> None:
        self.chain = chain
        names = sorted(anchors)
        self.anchors = len(names)
        self.hashed = Interner(_number({a: i for i, a in enumerate(names, 1)}))

    def of(self, shard: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in shard]
        words = self.hashed([w for ws in split for w in ws])
        owner = np.repeat(np.arange(len(split)), [len(ws) for ws in split])
        owner, words = owner[words != _NOTHING], words[words != _NOTHING]
        anchor = words <= self.anchors
        content, content_owner = words[~anchor], owner[~anchor]
        at = np.flatnonzero(anchor)
        # The content words after an anchor begin with as many as stand before it.
        first = at - np.arange(len(at))
        whole = first + self.chain <= len(content)
        at, first = at[whole], first[whole]
        inside = (
            content_owner[first + self.chain - 1] == owner[at] if len(at) else np.empty(0, bool)
        )
        at, first = at[inside], first[inside]
        spot = words[at]
        for j in range(self.chain):
            spot = mix(spot * np.uint64(0x9E3779B97F4A7C15) + content[first + j])
        spot = (spot >> np.uint64(32)).astype(np.uint32)
        more, more_owner = self._stretches(content, content_owner, np.cumsum(anchor)[~anchor])
        spot, of_spot = np.concatenate([spot, more]), np.concatenate([owner[at], more_owner])
        order = np.argsort(of_spot, kind="stable")
        spot = spot[order]
        ends = np.searchsorted(of_spot[order], np.arange(len(split) + 1))
        borders = np.searchsorted(owner, np.arange(len(split) + 1))
        found = []
        for i in range(len(split)):
            own = np.unique(spot[ends[i] : ends[i + 1]])
            low, high = borders[i], borders[i + 1]
            if not len(own) and high > low:
                chains = kgram_hashes(words[low:high], min(self.chain + 1, high - low))
                some = chains[chains % np.uint64(SHARE) == 0]
                own = np.unique(some if len(some) else chains.min(keepdims=True))
                own = np.unique((own >> np.uint64(32)).astype(np.uint32))
            found.append(own)
        return found


    def _stretches(
        self, content: np.ndarray, owner: np.ndarray, anchors: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Chosen chains in long stretches without an anchor, and whose they are.

        ``anchors`` is how many of them stand before each content word.
        """
        size = self.chain + 1
        if len(content) < max(size, STRETCH):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        new = np.append(True, (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1]))
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(content)))
        stretch = np.cumsum(new) - 1
        chains = kgram_hashes(content, size)
        there = np.arange(len(chains))
        inside = there + size <= (begin + length)[stretch[: len(chains)]]
        long = length[stretch[: len(chains)]] >= STRETCH
        at = np.flatnonzero(inside & long & (chains % np.uint64(SHARE) == 0))
        return (chains[at] >> np.uint64(32)).astype(np.uint32), owner[at]


def written(spots: np.ndarray) -> str:
    """The set as text, eight hexadecimal digits for each spot."""
    return spots.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 if their lengths cannot give ``floor``."""
    if not len(one) and not len(other):
        return 1.0
    if min(len(one), len(other)) < floor * max(len(one), len(other)):
        return 0.0
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / (len(one) + len(other) - both)


def _chained(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ids (bucket), each range followed by the first row of the next one."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("no_id"), F.col("doc_id"), F.col("digest")]
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("no_id", F.col("doc_id").isNull()).withColumn(
        "digest", F.xxhash64("text")
    )
    at = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    # As many borders as shuffle partitions, like any range partitioning has.
    borders = rows.agg(F.percentile_approx("doc_id", at, 10_000).alias("b")).first()["b"] or []
    known = F.lit(sorted(set(borders))).cast("array<bigint>")
    bucket = F.when(F.col("no_id"), F.lit(len(borders))).otherwise(
        F.size(F.filter(known, lambda b: b <= F.col("doc_id")))
    )
    rows = rows.withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(*order)).alias("first"))
    # One row for each of these ranges.
    found = sorted(firsts.collect(), key=lambda r: r["bucket"])
    if not found:
        return rows.withColumn("tail", F.lit(False))
    before = [found[-1]["bucket"], *[r["bucket"] for r in found[:-1]]]
    sent = spark.createDataFrame(
        [(r["bucket"], *r["first"], to) for r, to in zip(found, before)],
        "bucket int, no_id boolean, doc_id long, digest long, to int",
    ).alias("s")
    same = F.col("r.bucket") == F.col("s.bucket")
    for key in ("no_id", "doc_id", "digest"):
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}"))
    own = F.struct(F.col("r.bucket").alias("bucket"), F.lit(False).alias("tail"))
    tail = F.struct(F.col("to").alias("bucket"), F.lit(True).alias("tail"))
    places = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, tail))
    dealt = (
        rows.alias("r")
        .join(F.broadcast(sent), same, "left")
        .select("r.no_id", "r.doc_id", "r.digest", "r.text", F.explode(places).alias("place"))
        .select("*", "place.bucket", "place.tail")
        .drop("place")
    )
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", *order)


def _compare(chain: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(chain=chain)

        def compared(rows: list[tuple], last: tuple) -> pa.RecordBatch:
            """Each row with the one after it in the list, the last one with ``last``."""
            plain = [t for _, t in [*rows, last]]
            characters = [t.decode("utf-8", "replace") for t in plain]
            edited = []
            for one, other in zip(characters, characters[1:]):
                quarter = len(one) // 4
                edited.append((one[: len(one) - quarter] + other[:quarter]).encode())
            sets = prints.of(plain)
            edited_sets = prints.of(edited)
            pairs = list(zip(sets, edited_sets, sets[1:]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in rows], pa.int64()),
                    pa.array([len(c) for c in characters[:-1]], pa.int64()),
                    pa.array([sha256(e).hexdigest() for e in edited]),
                    pa.array([written(s) for s in sets[:-1]]),
                    pa.array([written(s) for s in edited_sets]),
                    pa.array([likeness(s, e) for s, e, _ in pairs], pa.float64()),
                    pa.array([likeness(s, n) for s, _, n in pairs], pa.float64()),
                ],
                names=[
                    "doc_id",
                    "n_chars",
                    "edited_sha256",
                    "fingerprint",
                    "edited_fingerprint",
                    "near_edited",
                    "near_next",
                ],
            )

        waiting: list[tuple] = []
        bucket, closed = None, False
        for batch in slices(batches):
            for place, tail, doc, text in zip(
                batch.column("bucket").to_pylist(),
                batch.column("tail").to_pylist(),
                batch.column("doc_id").to_pylist(),
                texts(batch.column("text")),
            ):
                if place != bucket:
                    bucket, closed = place, False
                if tail and not closed:
                    yield compared(waiting, (doc, text))
                    waiting, closed = [], True
                elif not tail:
                    waiting.append((doc, text))
            if len(waiting) > 1:
                yield compared(waiting[:-1], waiting[-1])
                waiting = waiting[-1:]

    return run


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and how like they and the next one's are."""
    rows = _chained(docs).select("bucket", "tail", "doc_id", "text")
    return rows.mapInArrow(_compare(chain), COMPARED)


def _spots(chain: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(chain=chain)
        for batch in slices(batches):
            sets = prints.of(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([written(s) for s in sets], pa.string())],
                names=["doc_id", "fingerprint"],
            )

    return run


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """doc_id and fingerprint of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_spots(chain), "doc_id long, fingerprint string")


def length_part(size: Column, floor: float) -> Column:
    """Number of the part of a set's length: lengths of alike sets differ by one part at most."""
    # The small addend keeps lengths on a border together, whichever way they were rounded.
    return F.floor(F.log(size) / F.log(F.lit(1 / floor)) + 1e-9).cast("int")


def _read(often: list[int], floor: float):
    """Written sets as lists of numbers, and the first spots of each, frequent ones last."""
    known = np.array(sorted(often), np.uint32)
    rank = {spot: place for place, spot in enumerate(reversed(often), 1)}
    ranks = np.array([rank[spot] for spot in known.tolist()], np.int64)

    def first(own: np.ndarray) -> np.ndarray:
        late = np.zeros(len(own), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            late = np.where(known[at] == own, ranks[at], 0)
        size = len(own)
        return own[np.lexsort((own, late))][: size - int(np.ceil(floor * size - 1e-9)) + 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in slices(batches, "fingerprint"):
            sets = [
                np.frombuffer(t, ">u4").astype(np.uint32)
                for t in batch.column("fingerprint").to_pylist()
            ]
            columns = [batch.column(n) for n in ("digest", "asked", "copies")]
            columns.append(pa.array([s.view(np.int32) for s in sets], kind))
            columns.append(pa.array([first(s).view(np.int32) for s in sets], kind))
            names = ["digest", "asked", "copies", "spots", "first"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _digest() -> Column:
    return F.unhex(F.md5("fingerprint"))


def _often(asked: DataFrame) -> list[int]:
    """The ``OFTEN`` spots that most different fingerprints of the queries hold, most first."""
    digits = F.expr(
        "transform(sequence(0, length(fingerprint) div 8 - 1), i -> substr(fingerprint, 8 * i + 1, 8))"
    )
    sets = asked.filter(F.length("fingerprint") > 0).select("fingerprint").distinct()
    counts = sets.select(F.explode(digits).alias("spot")).groupBy("spot").count()
    most = counts.filter("count > 1").orderBy(F.desc("count"), "spot").limit(OFTEN).collect()
    return [int(row["spot"], 16) for row in most]


def alike(rows: DataFrame, floor: float = LIKENESS, often: Iterable[int] = ()) -> DataFrame:
    """Pairs of different fingerprints, as digests, that are alike by ``floor``, equal ones included.

    ``rows`` hold fingerprint, asked (the row is a query) and there (the row can be found). The
    result holds query_set, found_set, likeness and copies, the number of rows of the found set.

    Each different set is looked up once. Sets that are alike share one of the first spots of
    both: all but ``ceil(floor * length)`` plus one of them, in any order that is the same for
    all sets. In it the spots ``often``, most frequent ones first, come last, so that lookups
    meet short lists; the result does not depend on them.
    """
    sets = (
        rows.filter(F.length("fingerprint") > 0)
        .withColumn("digest", _digest())
        # Four bytes a spot.
        .groupBy("digest")
        .agg(
            F.any_value(F.unhex("fingerprint")).alias("fingerprint"),
            F.max("asked").alias("asked"),
            F.sum(F.col("there").cast("long")).alias("copies"),
        )
    )
    sets = stored(
        sets.select("fingerprint", "digest", "asked", "copies").mapInArrow(
            _read(list(often), floor),
            "digest binary, asked boolean, copies long, spots array<int>, first array<int>",
        )
    )
    size = F.size("spots")
    part = length_part(size, floor)
    lists = sets.select(
        "digest", "asked", "copies", size.alias("size"), part.alias("part"),
        F.explode("first").alias("spot"),
    )
    near = F.explode(F.array(*[F.col("part") + d for d in (-1, 0, 1)]))
    # Pairs that meet by an accident of this hash are not alike.
    key = F.xxhash64("part", "spot").alias("key")
    left = lists.filter("asked").withColumn("part", near).select("digest", "size", key).alias("q")
    right = lists.filter("copies > 0").select("digest", "size", key).alias("d")
    one, other = F.col("q.size"), F.col("d.size")
    met = left.join(
        right,
        (F.col("q.key") == F.col("d.key"))
        & (F.least(one, other) >= F.lit(floor) * F.greatest(one, other) - 1e-9),
    ).select(F.col("q.digest").alias("query_set"), F.col("d.digest").alias("found_set")).distinct()
    found = sets.select(
        F.col("digest").alias("found_set"), F.col("spots").alias("found_spots"), "copies"
    )
    asked = sets.filter("asked").select(
        F.col("digest").alias("query_set"), F.col("spots").alias("query_spots")
    )
    both = F.size(F.array_intersect("query_spots", "found_spots"))
    union = F.size("query_spots") + F.size("found_spots") - both
    pairs = met.join(found, "found_set").join(asked, "query_set")
    pairs = pairs.select("query_set", "found_set", (both / union).alias("likeness"), "copies")
    return pairs.filter(F.col("likeness") >= floor)


def search(queries: DataFrame, index: DataFrame, floor: float = LIKENESS, chain: int = CHAIN) -> DataFrame:
    """query_id, doc_id, likeness of all rows of ``index`` that are like a query by ``floor``.

    Rows without words are like none.
    """

    def marked(docs: DataFrame, asked: bool) -> DataFrame:
        flags = {"asked": F.lit(asked), "there": F.lit(not asked)}
        return stored(fingerprints(docs, chain)).withColumns(flags)

    asked, there = marked(queries, True), marked(index, False)
    pairs = alike(asked.unionByName(there), floor, _often(asked))
    ids = asked.select(F.col("doc_id").alias("query_id"), _digest().alias("query_set"))
    found = there.select("doc_id", _digest().alias("found_set"))
    joined = pairs.join(ids, "query_set").join(found, "found_set")
    return joined.select("query_id", "doc_id", "likeness")


def links(
    docs: DataFrame, queries: Column, floor: float = LIKENESS, chain: int = CHAIN
) -> DataFrame:
    """doc_id, n_links, n_linked_sets of the rows that are queries, copies not expanded into pairs.

    n_links counts the rows of ``docs`` other than the query itself that are like it by ``floor``,
    n_linked_sets the different fingerprints among them and it; both are 0 for a query without
    words. ``queries`` is a condition on doc_id; null is no query.
    """
    asked = F.coalesce(queries, F.lit(False))
    own = stored(fingerprints(docs.filter(asked), chain))
    rows = fingerprints(docs, chain)
    rows = rows.select("fingerprint", asked.alias("asked"), F.lit(True).alias("there"))
    pairs = alike(rows, floor, _often(own))
    counted = pairs.groupBy("query_set").agg(
        (F.sum("copies") - 1).alias("n_links"), F.count("*").alias("n_linked_sets")
    )
    own = own.select("doc_id", _digest().alias("query_set"))
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_linked_sets")]
    return own.join(counted, "query_set", "left").select("doc_id", *numbers)
