"""The corpus pipeline stage by stage against plain versions, and pieces of the toxicity network."""

from __future__ import annotations

import os
import re

# Small matrices are slower on many threads.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import helpers as h  # noqa: E402

import corpus_pipeline  # noqa: E402
from hourmart.llm import gru, mixing, neardup, oracles  # noqa: E402

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sql(query: str, folder: Path) -> list[tuple]:
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/**/*.parquet'")
    return connection.execute(query).fetchall()


@pytest.mark.parametrize("source", ["odd", "table", "empty"])
def test_pipeline(spark, tmp_path, source):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if source == "table" else h.frame(spark, clash=False)
    if source == "empty":
        docs = docs.limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages, frames, folders = dict(corpus_pipeline.STAGES), [docs], [tmp_path / "documents.parquet"]
    for name, stage in corpus_pipeline.STAGES:
        folders.append(tmp_path / name)
        stage(spark, frames[-1], str(tmp_path)).write.parquet(str(folders[-1]))
        frames.append(spark.read.parquet(str(folders[-1])))
    assert list(stages) == ["quality rules", "near-duplicates", "secrets", "mixing", "packing"]
    assert all(frame.columns == COLUMNS for frame in frames[:-1])
    rows = [[tuple(r) for r in frame.select(*COLUMNS).collect()] for frame in frames[:-1]]

    kept = Counter(r[0] for r in sql(oracles.QUALITY, folders[0]) if r[7])
    assert Counter(r[0] for r in rows[1]) == kept

    found = rows[1]
    classes = h.near_classes([(r[0], r[1]) for r in found])
    members = defaultdict(list)
    for row, number in zip(found, classes):
        members[number].append(row)
    assert len(rows[2]) == len(members)
    for number, group in members.items():
        ids = [r[0] for r in group if r[0] is not None]
        one = [r for r in rows[2] if r in group]
        assert len(one) == 1 and one[0][0] == (min(ids) if ids else None)

    # Secrets become marks; ids, languages and sources stay, and so do texts without secrets.
    texts = defaultdict(list)
    for row in rows[2]:
        texts[row[0], row[2], row[3]].append(row[1])
    assert Counter((r[0], r[2], r[3]) for r in rows[3]) == Counter((r[0], r[2], r[3]) for r in rows[2])
    for doc_id, text, lang, of, n_chars in rows[3]:
        assert text in texts[doc_id, lang, of] or "[secret]" in text
        assert n_chars == len(text)
        assert not re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", text)

    taken = Counter()
    for doc_id, size, *_, words in sql(oracles.MIXING, folders[3]):
        taken[doc_id] += words // size if size else 0
    assert Counter(r[0] for r in rows[4]) == +taken

    tokenizer = Tokenizer.from_file(h.TOKENIZER)
    expected, packed, sequences = Counter(), Counter(), defaultdict(list)
    for row in rows[4]:
        length = len(tokenizer.encode(row[1], add_special_tokens=False).ids) + 1
        for piece in range(-(-length // 4096)):
            expected[row[0], piece, min(4096, length - 4096 * piece)] += 1
    for row in frames[-1].collect():
        packed[row["doc_id"], row["piece"], row["length"]] += 1
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert packed == expected
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


CLASHES = ("_digest", "_nth", "_turn", "_node", "_kept", "row", "node", "own", "kept", "copy", "turn", "nth", "times")


def test_columns_named_like_ours(spark):
    plain = h.frame(spark, clash=False)
    docs = plain
    for name in CLASHES:
        docs = docs.selectExpr("*", f"concat('own ', doc_id) AS {name}")
    for stage in (neardup.keep_one, mixing.mixed_documents):
        found = stage(docs)
        assert found.columns == docs.columns
        rows = found.collect()
        assert all(r[name] == (None if r["doc_id"] is None else f"own {r['doc_id']}") for r in rows for name in CLASHES)
        assert Counter(tuple(r)[:5] for r in rows) == Counter(map(tuple, stage(plain).collect()))


def network(seed: int = 3) -> tuple:
    draw = np.random.default_rng(seed)
    texts = [[f"word{draw.integers(40)}x" for _ in range(n)] for n in (0, 1, 31, 32, 33, 90, 200, 15)]
    net = gru.Network(gru.Lookup.of(texts * gru.LEAST))
    for value in net.weights.values():
        value += draw.standard_normal(value.shape).astype(np.float32) * 0.3
    known = sorted({w for t in texts for w in t} | {"other"})
    vectors = net.embed(*net.lookup.rows(known))
    words = np.array([known.index(w) for t in texts for w in t])
    return net, vectors, words, np.array([len(t) for t in texts])


def test_scores_of_windows_are_those_of_the_plain_network():
    net, vectors, words, sizes = network()
    text, first, logits = net.logits(net.gates(vectors), words, sizes)
    begin, w = np.cumsum(sizes) - sizes, net.weights
    for t, at, logit in zip(text, first, logits):
        own = words[begin[t] + at : begin[t] + min(at + gru.WINDOW, sizes[t])]
        states = {}
        for way, order in (("ahead", own), ("back", own[::-1])):
            state, found = np.zeros(gru.HIDDEN), []
            for word in order:
                a = vectors[word] @ w[f"{way} in"] + w[f"{way} bias"]
                u, n = state @ w[f"{way} own"], gru.HIDDEN
                z, r = (1 / (1 + np.exp(-(a + u)[i * n : i * n + n])) for i in range(2))
                state = z * state + (1 - z) * np.tanh(a[2 * n :] + r * u[2 * n :])
                found.append(state)
            states[way] = found if way == "ahead" else found[::-1]
        if not len(own):
            assert logit == pytest.approx(w["bias"][0], abs=1e-5)
            continue
        h_ = np.concatenate([states["ahead"], states["back"]], axis=1)
        s = np.exp(np.tanh(h_ @ w["attend"]) @ w["query"])
        plain = (s / s.sum()) @ h_ @ w["out"] + w["bias"][0]
        assert logit == pytest.approx(plain, abs=1e-4)


def test_gradient_of_the_recurrent_network():
    net, vectors, words, sizes = network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    text, first = gru.windows(sizes)
    at, there = net.places(text, first, np.cumsum(sizes) - sizes, sizes)
    x, label = vectors[words[at]].astype(np.float64), (np.arange(len(text)) % 2).astype(np.float64)

    def loss() -> float:
        logit = net.forward(x, there)[-1]
        return float(np.mean(np.logaddexp(0, logit) - label * logit))

    found, dx = net.gradient(x, there, label)
    draw = np.random.default_rng(0)
    checked = [(net.weights[k], g) for k, g in found.items()] + [(x, dx * there[:, :, None])]
    for value, gradient in checked:
        for _ in range(6):
            place = tuple(draw.integers(n) for n in value.shape)
            if value is x and not there[place[:2]]:
                continue
            old, step = value[place], 1e-3
            value[place] = old + step
            up = loss()
            value[place] = old - step
            down = loss()
            value[place] = old
            assert gradient[place] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_rows_of_n_grams_are_those_of_the_table():
    texts = [["wörter", "word", "漢字漢字", "a", ""], ["words", "wörter", "漢字漢字", "ab"]] * gru.LEAST
    lookup = gru.Lookup.of(texts)
    words = ["word", "", "wörterbuch", "漢字", "漢字漢字", "zzz", "a", "ab", "words"]
    own, line, owner = lookup.rows(words)
    assert own.tolist() == [lookup.words.get(w, 0) for w in words]
    expected = [(i, lookup.parts[g]) for i, w in enumerate(words) for g in gru.grams(w) if g in lookup.parts]
    assert list(zip(owner.tolist(), line.tolist())) == expected and len(expected) > 20
    assert [len(part) for part in lookup.rows([])] == [0, 0, 0]
    assert len(gru.Lookup({}, {}).rows(["word"])[1]) == 0
