"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of what
follows. A byte is coded in the longest known context; if it is new there, an escape is coded
(method C: as likely as the number of different bytes seen) and the next shorter context is
asked, without the bytes that the longer ones would have coded. The counts are frozen after
training, so the code length of a byte depends on the bytes before it alone. Only contexts
that were seen are held. The language with the shortest code for the whole text wins.

ASCII letters are folded to lower case, digits to one symbol, white space to one; every other byte
of the training texts is a symbol of its own, and those they never have share one. Null texts and texts without a letter are ``und``
with score 0. The score is the share of the best language if code lengths per byte are read as odds.
Without training rows every text is ``und``. Repeated rows are judged alike and learned once; very
long texts are read whole, one at a time. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import slices, texts

ORDER = 3
# The model is fitted on so many different documents of each language, read whole.
FIT_DOCUMENTS = 96
# Parts of the documents of a language, each of which names its candidates for the sample.
PARTS = 64
# Characters of a language after which no further document is taken; the last one is whole, too.
FIT_TOTAL = 4 << 20
# Bytes from which the odds of a text do not get steeper.
SURE_BYTES = 24.0


def folded() -> np.ndarray:
    table = np.arange(256)
    table[65:91] += 32
    table[48:58] = 48
    table[[9, 10, 11, 12, 13]] = 32
    return table


def alphabet(samples: list[bytes]) -> np.ndarray:
    """The symbol of each byte: those of the samples have their own, from 1 on; 0 is all the rest."""
    table = folded()
    counts = np.zeros(256, np.int64)
    for sample in samples:
        counts += np.bincount(table[np.frombuffer(sample, np.uint8)], minlength=256)
    used = np.flatnonzero(counts)
    own = np.zeros(256, np.int64)
    # At most 216: folding leaves so many.
    own[used] = np.arange(1, len(used) + 1)
    return own[table]


def code_lengths(sample: np.ndarray, symbols: int, order: int = ORDER) -> np.ndarray:
    """Bits of every symbol after every context of ``order`` symbols (the last one varies fastest).

    A context that was never seen codes as its longest known end does, which is where the
    variable order comes from.
    """
    shape = [symbols]
    chance = np.full((1, symbols), 1.0 / symbols)
    for k in range(order + 1):
        n = len(sample) - k
        place = np.zeros(max(n, 0), np.int64)
        for j in range(k + 1):
            place = place * symbols + sample[j : j + n]
        counts = np.bincount(place, minlength=symbols ** (k + 1)).reshape(-1, symbols)
        shorter = chance if k == 0 else np.tile(chance, (symbols, 1))
        seen = counts > 0
        kinds = seen.sum(axis=1, keepdims=True)
        total = counts.sum(axis=1, keepdims=True)
        escape = np.where(kinds == symbols, 0, kinds) / np.maximum(total + kinds, 1)
        rest = 1.0 - np.where(seen, shorter, 0).sum(axis=1, keepdims=True)
        known = counts / np.maximum(total + np.where(kinds == symbols, 0, kinds), 1)
        other = escape * shorter / np.maximum(rest, 1e-12)
        chance = np.where(total > 0, np.where(seen, known, other), shorter)
        shape = [symbols, *shape]
    return (-np.log2(np.maximum(chance, 1e-12))).astype(np.float32).ravel()


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted ones among sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Contexts:
    """The chances of ``code_lengths``, held for the contexts that were seen alone.

    A gram is a context and the symbol after it, a byte each, the last one lowest.
    """

    def __init__(self, sample: np.ndarray, symbols: int, order: int = ORDER) -> None:
        self.symbols, self.order = symbols, order
        # By length of context: grams and their chances; contexts and the weight of shorter ones.
        self.grams, self.known, self.contexts, self.weight = [], [], [], []
        for k in range(order + 1):
            n = max(len(sample) - k, 0)
            place = np.zeros(n, np.int64)
            for j in range(k + 1):
                place = place << 8 | sample[j : j + n]
            grams, counts = np.unique(place, return_counts=True)
            shorter = self.chance(grams, k - 1)
            contexts, at = np.unique(grams >> 8, return_inverse=True)
            kinds, total = np.bincount(at, minlength=len(contexts)), np.bincount(at, counts)
            new = np.where(kinds == symbols, 0, kinds)
            rest = 1.0 - np.bincount(at, shorter, len(contexts))
            self.grams.append(grams)
            self.known.append(counts / (total + new)[at])
            self.contexts.append(contexts)
            self.weight.append(new / (total + new) / np.maximum(rest, 1e-12))

    def chance(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Chances of grams by contexts of up to ``order`` symbols."""
        found = np.ones(len(grams))
        open_ = np.arange(len(grams))
        for k in range(order, -1, -1):
            own = grams[open_] & ((1 << 8 * (k + 1)) - 1)
            at, there = _find(self.grams[k], own)
            found[open_[there]] *= self.known[k][at[there]]
            open_, own = open_[~there], own[~there]
            at, there = _find(self.contexts[k], own >> 8)
            found[open_[there]] *= self.weight[k][at[there]]
        found[open_] /= self.symbols
        return found

    def bits(self, grams: np.ndarray) -> np.ndarray:
        return -np.log2(np.maximum(self.chance(grams, self.order), 1e-12))


class Model:
    """Languages, their samples as symbols, and the contexts in them."""

    def __init__(self, fitted: str) -> None:
        samples = {}
        for item in fitted.split("\n") if fitted else []:
            name, sample = item.split("\t")
            samples[base64.b64decode(name).decode()] = base64.b64decode(sample)
        self.languages = sorted(samples)
        self.alphabet = alphabet(list(samples.values())).astype(np.uint32)
        self.symbols = int(self.alphabet.max()) + 1 if samples else 1
        self.contexts = [
            Contexts(self.alphabet[np.frombuffer(samples[name], np.uint8)].astype(np.int64), self.symbols)
            for name in self.languages
        ]

    def bits(self, shard: list[bytes]) -> np.ndarray:
        """(texts, languages) bits of each text; it is read as if white space stood before it."""
        blank = b" " * ORDER
        coded = self.alphabet[np.frombuffer(b"".join([blank + t for t in shard]), np.uint8)]
        sizes = np.array([len(t) + ORDER for t in shard])
        place = coded[:-ORDER]
        for j in range(1, ORDER + 1):
            place = place << np.uint32(8) | coded[j : len(coded) - ORDER + j]
        # Each different gram is looked up once.
        met = pa.array(place).dictionary_encode()
        grams, place = met.dictionary.to_numpy().astype(np.int64), met.indices.to_numpy()
        begin = np.cumsum(sizes) - sizes
        found = np.zeros((len(shard), len(self.languages)))
        for language, contexts in enumerate(self.contexts):
            cost = np.zeros(len(place) + 1)
            np.cumsum(contexts.bits(grams)[place], out=cost[1:])
            found[:, language] = cost[begin + sizes - ORDER] - cost[begin]
        return found


@lru_cache(maxsize=2)
def model(fitted: str) -> Model:
    return Model(fitted)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, documents: int = FIT_DOCUMENTS, total: int = FIT_TOTAL) -> str:
    """A bounded sample of every language in ``labelled`` (text, lang), as text.

    It takes the different documents of least digest, so reruns agree, and reads them whole.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", "text", F.md5("text").alias("digest")
    )
    kinds = rows.groupBy("lang", "digest").agg(F.max(F.length("text").cast("long")).alias("size"))
    # First the least of every part of a language, so that what one task gets does not grow with the
    # documents of a language.
    least = lambda rows, *by: rows.withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang", *by).orderBy("digest"))
    ).filter(F.col("nth") <= documents)
    some = least(kinds.withColumn("dealt", F.pmod(F.xxhash64("digest"), F.lit(PARTS))), "dealt")
    some = least(some.drop("dealt", "nth"))
    by_digest = Window.partitionBy("lang").orderBy("digest")
    before = F.sum("size").over(by_digest.rowsBetween(Window.unboundedPreceding, -1))
    some = some.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < total)
    # Broadcast: at most so many short rows of each language.
    some = rows.join(F.broadcast(some.drop("size", "before")), ["lang", "digest"])
    some = some.dropDuplicates(["lang", "digest"])
    held: dict[str, list[bytes]] = {}
    for row in some.orderBy("lang", "nth").collect():
        held.setdefault(row["lang"], []).append(row["text"].encode())
    encode = lambda b: base64.b64encode(b).decode()
    return "\n".join(f"{encode(k.encode())}\t{encode(b' '.join(v))}" for k, v in sorted(held.items()))


def _predict(fitted: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = model(fitted)
        for batch in slices(batches):
            shard = texts(batch.column("text"))
            names, scores = ["und"] * len(shard), np.zeros(len(shard))
            judged = [i for i, t in enumerate(shard) if has_letter(t.decode("utf-8", "replace"))]
            if judged and ppm.languages:
                bits = ppm.bits([shard[i] for i in judged])
                sizes = np.array([len(shard[i]) for i in judged])
                odds = bits - bits.min(axis=1, keepdims=True)
                odds *= (np.minimum(sizes, SURE_BYTES) / sizes)[:, None]
                best = bits.argmin(axis=1)
                scores[judged] = 1 / np.exp2(-odds).sum(axis=1)
                for i, language in zip(judged, best.tolist()):
                    names[i] = ppm.languages[language]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, learn: Column, **sizes: int) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows where ``learn`` holds."""
    fitted = fit(docs.filter(learn).select("text", "lang"), **sizes)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), (~learn).alias("held_out")
    )
    return rows.mapInArrow(
        _predict(fitted), "doc_id long, held_out boolean, lang_pred string, score double"
    )
