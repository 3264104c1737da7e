"""Searches over vectors and documents against plain versions, over odd rows and small tables."""

from __future__ import annotations

import os

# Small matrices are slower on many threads.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import math
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import helpers as h  # noqa: E402
from hourmart.llm import lexical, nearest, negatives, tiles  # noqa: E402
from hourmart.llm.common import table  # noqa: E402
from hourmart.llm.heaps import Heaps  # noqa: E402
from hourmart.llm.strassen import multiply  # noqa: E402

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int"
INF, NAN = math.inf, math.nan


def odd_vectors(large: bool = True) -> list[tuple]:
    """Ties, repeated rows and ids, other lengths, and all that takes no part."""
    draw = np.random.default_rng(5)
    rows = [(i, draw.integers(-3, 4, 5).astype(float).tolist(), i % 3) for i in range(0, 120, 2)]
    rows += [(200 + i, [1.0, 2.0, 0.0, -1.0, 1.0], i % 4) for i in range(40)]
    rows += rows[:6] * 2 + [(100, [0.5, 0.5, 0.5, 0.5, 0.5], 1), (100, [2.0, 1.0], 1), (7, [1.0, 1.0], 1)]
    rows += [(300, None, 1), (302, [], 1), (304, [0.0] * 5, 1), (306, [1.0, None, 1, 1, 1], 1)]
    rows += [(308, [1.0, INF, 1, 1, 1], 1), (310, [1.0, NAN, 1, 1, 1], 1), (None, [1.0] * 5, 1)]
    rows += [(350, [1.0, 1.0, 1.0, 1.0, 2.0], None), (352, [-0.0, 1.0, 0.0, 0.0, 0.0], 9)]
    if large:
        rows += [(400, [1e300, 1.0, 0.0, 0.0, 0.0], 2), (401, [1e-300, 0.0, 0.0, 0.0, 0.0], 2)]
    return [(i, v and [None if x is None else float(x) for x in v], l) for i, v, l in rows]


def vectors(spark, rows):
    found = spark.createDataFrame(rows, VECTORS)
    for name in ("vec", "copies", "digest", "tile", "kind", "rank", "copy", "turn"):
        found = found.selectExpr("*", f"'x' AS {name}")
    return found


def finite(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_nearest(rows, every: int, k: int) -> Counter:
    used = [(i, v) for i, v, _ in rows if i is not None and finite(v) and any(v)]
    out = Counter()
    for place, (query, v) in enumerate(used):
        if query % every:
            continue
        found = []
        for other, (i, w) in enumerate(used):
            if other != place and len(w) == len(v):
                total = 0.0
                for x, y in zip(v, w):
                    total += (x - y) * (x - y)
                found.append((math.sqrt(total), i))
        out.update((query, n + 1, i, d) for n, (d, i) in enumerate(sorted(found)[:k]))
    return out


def plain_negatives(rows, every: int, step: int) -> Counter:
    used = []
    for i, v, label in rows:
        if i is not None and label is not None and finite(v):
            label = (label + 1) % 10 if i % step == 0 else label
            used.append((i, [math.floor(256 * x) for x in v], label))
    out = Counter()
    for place, (anchor, v, label) in enumerate(used):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, l)
            for other, (i, w, l) in enumerate(used)
            if other != place and len(w) == len(v)
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            found = [s for s in scored if s[2] != label and -50 * score <= -100 * s[0] <= -95 * score]
            out.update(
                (anchor, positive, n + 1, i, -score, -s) for n, (s, i, _) in enumerate(found[:3])
            )
    return out


def small_tiles(monkeypatch):
    """Many groups and strips, blocks that do not divide them."""
    monkeypatch.setattr(tiles, "GROUP_CELLS", 60)
    monkeypatch.setattr(tiles, "STRIP_ROWS", 25)
    monkeypatch.setattr(tiles.blocks, "__defaults__", (7,))


@pytest.mark.parametrize("small", [False, True])
def test_nearest(spark, monkeypatch, small):
    if small:
        small_tiles(monkeypatch)
    rows = odd_vectors()
    found = nearest.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, 6)
    assert Counter(map(tuple, found.collect())) == plain_nearest(rows, 4, 6)
    # Fewer candidates than asked for.
    few = nearest.nearest(vectors(spark, rows[:4]), F.col("vec_id") % 4 == 0, 6)
    assert Counter(map(tuple, few.collect())) == plain_nearest(rows[:4], 4, 6)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:
        small_tiles(monkeypatch)
    rows = odd_vectors(large=False)
    vec_id = F.col("vec_id")
    found = negatives.hard_negatives(vectors(spark, rows), vec_id % 4 == 0, vec_id % 7 == 0)
    expected = plain_negatives(rows, 4, 7)
    assert Counter(map(tuple, found.collect())) == expected and expected


def test_vector_tables(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "embeddings").collect()]
    docs, vec_id = table(spark, SMALL, "embeddings"), F.col("vec_id")
    found = nearest.nearest(docs, vec_id % 100 == 0)
    assert Counter(map(tuple, found.collect())) == plain_nearest(rows, 100, 10)
    found = negatives.hard_negatives(docs, vec_id % 50 == 0, vec_id % 7 == 0)
    assert Counter(map(tuple, found.collect())) == plain_negatives(rows, 50, 7)


def test_no_vectors(spark):
    empty, vec_id = vectors(spark, odd_vectors()).limit(0), F.col("vec_id")
    assert nearest.nearest(empty, vec_id % 4 == 0).collect() == []
    assert negatives.hard_negatives(empty, vec_id % 4 == 0, vec_id % 7 == 0).collect() == []


def test_components_too_large_for_scores(spark):
    rows = [(0, [1e17, 1.0], 1), (1, [1e17, 2.0], 1)]
    found = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") == 0, F.lit(False))
    with pytest.raises(Exception, match="too large"):
        found.collect()


def test_error_of_codes_is_never_beyond_its_bound():
    draw = np.random.default_rng(1)
    for size in (1, 3, 64, 1500):
        a, b = (draw.normal(size=(30, size)) * draw.lognormal(0, 3, (30, 1)) for _ in range(2))
        middle, off = nearest.bounds(nearest.quantised(a), nearest.quantised(b))
        true = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)
        assert (np.abs(middle - true) <= off).all()
    codes = [draw.integers(-127, 128, (9, 1500)).astype(np.int8) for _ in range(2)]
    assert (nearest.product(*codes) == codes[0].astype(int) @ codes[1].astype(int).T).all()


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 65), (40, 64, 51), (5, 100, 3), (64, 0, 8)])
def test_strassen(shape):
    m, k, n = shape
    draw = np.random.default_rng(m)
    a, b = draw.integers(-(2**30), 2**30, (m, k)), draw.integers(-(2**30), 2**30, (k, n))
    for leaf in (1, 4, 16):
        assert (multiply(a, b, leaf) == a @ b).all()


def test_heaps_merge():
    draw = np.random.default_rng(2)
    owner, score, ids = (draw.integers(0, top, 500) for top in (4, 9, 60))
    heaps, halves = Heaps(5, 7, -1), [Heaps(5, 7, -1) for _ in range(2)]
    heaps.add(owner, score, ids, ids)
    for half, part in zip(halves, (slice(0, 300), slice(300, 500))):
        for low in range(0, 300, 50):
            some = slice(part.start + low, min(part.start + low + 50, part.stop))
            half.add(owner[some], score[some], ids[some], ids[some])
    merged = Heaps(5, 7, -1)
    for half in halves:
        merged.add(*half.entries())
    for o in range(5):
        best = sorted((-s, i) for w, s, i in zip(owner, score, ids) if w == o)[:7]
        for found in (heaps, merged):
            n = found.filled[o]
            assert list(zip(-found.score[o, :n], found.ids[o, :n])) == best
            assert (found.more[o, :n] == found.ids[o, :n]).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k: int) -> Counter:
    own = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    n, total = sum(1 for _, c in own if c), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = Counter()
    for item_id, text in items:
        wanted, found = set(plain_terms(text)), []
        for doc_id, counts in own:
            score = 0
            for term in wanted & counts.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                m = 100 - 90 + (90 * sum(counts.values()) * n) // total
                tf = counts[term]
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        ranked = sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k]
        out.update((item_id, r + 1, d, -s) for r, (s, _, d) in enumerate(ranked))
    return out


def odd_items(spark, docs):
    texts = [r["text"] for r in docs.collect() if r["text"]]
    rows = [(i, t[: 80 + i]) for i, t in enumerate(texts[:8])]
    rows += [(20, None), (21, ""), (22, "?!"), (None, texts[2]), (23, "nobody_has+this"), (24, "É ok OK")]
    return spark.createDataFrame(rows + rows[1:3], "item_id long, text string")


@pytest.mark.parametrize("index_bytes", [lexical.INDEX_BYTES, 300])
def test_ranked_search(spark, monkeypatch, index_bytes):
    docs = h.frame(spark)
    items = odd_items(spark, docs)
    monkeypatch.setattr(lexical, "CELLS", 50)
    monkeypatch.setattr(lexical, "TASK_SET", 2)
    found = lexical.ranked_documents(docs.repartition(7), items, 10, index_bytes)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = plain_search(plain, [tuple(r) for r in items.collect()], 10)
    assert Counter(map(tuple, found.collect())) == expected


def test_search_of_tables(spark):
    docs, items = (table(spark, SMALL, name) for name in ("documents", "benchmark"))
    found = lexical.ranked_documents(docs, items)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = plain_search(plain, [tuple(r) for r in items.collect()], 10)
    assert Counter(map(tuple, found.collect())) == expected
    for left, right in ((docs.limit(0), items), (docs, items.limit(0))):
        assert lexical.ranked_documents(left, right).collect() == []


def test_terms_of_long_texts_in_steps(monkeypatch):
    monkeypatch.setattr(lexical, "STEP_BYTES", 10)
    text = "Aé!b_c " * 30 + "x" * 50 + " \x1f\x7f\x85z 漢字"
    found = [t.decode() for some in lexical.terms(text.encode()) for t in some]
    assert found == plain_terms(text)
