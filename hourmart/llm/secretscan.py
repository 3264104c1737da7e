"""Secret scans by a trigram index: postings first, patterns on what is left.

Each step of a task is a shard: the trigrams its texts share with the rules are looked up in one
pass over the bytes and become postings, the documents of a trigram. A rule's Boolean query
is answered by intersecting and uniting postings; only its candidates are searched with its
pattern. A rule without mandatory trigrams searches every text. No row is moved.

A null text is empty. Spans are in code points, their end exclusive. Letters are of either case
for ASCII only. Repeated rows are scanned each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm import trigrams
from hourmart.llm.common import slices, texts


@dataclass(frozen=True)
class Rule:
    """A match counts if the group has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False
    # A quicker pattern with the same matches, for rules that search every text.
    search: str | None = None

    @cached_property
    def compiled(self) -> re.Pattern:
        flags = re.ASCII | (re.IGNORECASE if self.any_case else 0)
        return re.compile(self.search or self.pattern, flags)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [
            m.span()
            for m in self.compiled.finditer(text)
            if len(m[self.group]) >= self.least
        ]


# Fixed patterns of the base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # Runs are maximal, so the long ones are found alone.
    Rule("hex", r"[0-9a-f]+", least=24, search=r"[0-9a-f]{24,}"),
)
# Further kinds: published formats of access tokens and key files.
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class TrigramIndex:
    """Postings of the trigrams that a set of queries asks for, over one shard of texts."""

    def __init__(self, wanted: list[bytes]) -> None:
        # Not more than 254 trigrams fit one byte each of the lookup table.
        self.number = {gram: i for i, gram in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for gram, i in self.number.items():
            self.table[int.from_bytes(gram, "big")] = i + 1
        fold = np.arange(256, dtype=np.uint32)
        fold[65:91] += 32
        self.fold = fold

    def add(self, shard: list[bytes]) -> None:
        self.documents = len(shard)
        codes = self.fold[np.frombuffer(b"".join(shard), np.uint8)]
        self.postings: list[np.ndarray] = [np.zeros(self.documents, bool) for _ in self.number]
        if len(codes) < 3:
            return
        hit = self.table[codes[:-2] << np.uint32(16) | codes[1:-1] << np.uint32(8) | codes[2:]]
        at = np.flatnonzero(hit)
        ends = np.cumsum([len(t) for t in shard])
        document = np.searchsorted(ends, at, side="right")
        # A trigram over the border of two texts is in neither.
        inside = at + 2 < ends[document]
        for i in range(len(self.postings)):
            self.postings[i][document[inside & (hit[at] == i + 1)]] = True

    def documents_of(self, query: trigrams.Query) -> np.ndarray:
        if isinstance(query, trigrams.Tri):
            return self.postings[self.number[query.gram]]
        if isinstance(query, trigrams.And):
            return np.logical_and.reduce([self.documents_of(q) for q in query.of])
        if isinstance(query, trigrams.Or):
            return np.logical_or.reduce([self.documents_of(q) for q in query.of])
        return np.ones(self.documents, bool)


SPANS = "array<struct<start:int,end:int,kind:string>>"


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigrams.query(rule.pattern) for rule in rules]
        index = TrigramIndex(sorted(set().union(*map(trigrams.grams, queries))))
        for batch in slices(batches):
            shard = texts(batch.column("text"))
            index.add(shard)
            found: list[list[tuple[int, int, int]]] = [[] for _ in shard]
            for number, (rule, query) in enumerate(zip(rules, queries)):
                for i in np.flatnonzero(index.documents_of(query)).tolist():
                    text = shard[i].decode("utf-8", "replace")
                    found[i] += [(start, number, end) for start, end in rule.spans(text)]
            spans = [
                [{"start": s, "end": e, "kind": rules[n].kind} for s, n, e in sorted(own)]
                for own in found
            ]
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, "spans"]
            )

    return run


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text, spans: all that the rules find, by start, then in the order of the rules."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_scan(rules), f"doc_id long, text string, spans {SPANS}")


def _spans_text(spans):
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def _of_kind(kind: str):
    return F.filter(F.col("spans"), lambda s: s["kind"] == kind)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    base = F.filter(F.col("spans"), lambda s: s["kind"].isin([r.kind for r in BASE]))
    counts = [F.size(_of_kind(rule.kind)).cast("long").alias(f"n_{rule.kind}") for rule in BASE]
    return scan(docs, rules).drop("text").select(
        "doc_id",
        *counts,
        F.sha2(_spans_text(base), 256).alias("base_sha256"),
        _spans_text(F.col("spans")).alias("spans"),
    )


def _redact(rules: tuple[Rule, ...], mark: str, column: int):
    scanned = _scan(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scanned(batches):
            clean = []
            for text, spans in zip(
                batch.column(column).to_pylist(), batch.columns[-1].to_pylist()
            ):
                if spans:
                    parts, at = [], 0
                    for span in spans:
                        if span["start"] >= at:
                            parts += [text[at : span["start"]], mark]
                        at = max(at, span["end"])
                    text = "".join(parts) + text[at:]
                clean.append(text)
            columns = list(batch.columns[:-1])
            columns[column] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The rows with every secret replaced by ``mark``; a column n_chars follows the text."""
    place = docs.columns.index("text")
    clean = docs.mapInArrow(_redact(rules, mark, place), docs.schema)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return clean.withColumn("n_chars", length.cast(kind))
