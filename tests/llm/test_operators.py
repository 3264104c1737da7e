"""The text operators against plain versions, over odd rows and over the small tables."""

from __future__ import annotations

import os

# Small matrices are slower on many threads.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import hashlib
import pickle
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import helpers as h  # noqa: E402
from hourmart.llm import (  # noqa: E402
    attention,
    darts,
    language,
    mixing,
    neardup,
    packing,
    quality,
    queries,
    scoring,
    secretscan,
    spotsigs,
    substrings,
    toxicity,
    trigrams,
)
from hourmart.llm.common import id_hash, table  # noqa: E402
from hourmart.llm.components import components  # noqa: E402
from hourmart.llm.fmindex import FMIndex  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(params=["odd", "table"])
def docs(request, spark):
    return h.frame(spark) if request.param == "odd" else table(spark, SMALL, "documents")


def texts_of(docs) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_quality_measures(docs):
    expected = Counter()
    for doc_id, text in texts_of(docs):
        text, own = text or "", h.words(text)
        lines = [line for line in text.split("\n") if h.words(line)]
        cover = h.repeated_words([text], 5)[0]
        symbols = len(re.findall(quality.SYMBOLS, text))
        n, repeats = len(own), sum(cover)
        failed = n < 10 or 100 * repeats > 20 * n
        expected[
            doc_id, n, sum(map(len, own)), symbols, len(lines) - len(set(lines)), repeats, failed
        ] += 1
    rows = quality.judge(docs).collect()
    assert Counter(tuple(r)[:-2] for r in rows) == expected
    kept = Counter(r["doc_id"] for r in rows if r["kept"])
    assert Counter(r["doc_id"] for r in quality.filter_documents(docs).collect()) == kept
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert all(r["kept"] == (r["rejected_by"] is None) for r in rows)
    assert all(r["base_failed"] == (r["rejected_by"] in quality.BASE) for r in rows)


def rejecting(text: str) -> set[str]:
    """Names of all rules that reject the text, by a plain reading of them."""
    own = h.words(text)
    lines = [line for line in text.split("\n") if h.words(line)]
    chars, n = sum(map(len, own)), len(own)
    cut = sum(line.rstrip(" \t\n\v\f\r").endswith(("...", "…")) for line in lines)
    bullets = sum(line.lstrip(" \t\n\v\f\r").startswith(("-", "*", "•")) for line in lines)
    letters = sum(any(c > "\x7f" or c.isalpha() for c in w) for w in own)
    found = {
        "few words": n < 10,
        "repeated words": 100 * sum(h.repeated_words([text], 5)[0]) > 20 * n,
        "symbols": 10 * len(re.findall(quality.SYMBOLS, text)) > 3 * n,
        "repeated lines": 10 * (len(lines) - len(set(lines))) > 7 * len(lines),
        "word length": not 2 * n <= chars <= 20 * n,
        "few letters": 2 * letters < n,
        "cut lines": cut > 1 and 10 * cut > 3 * len(lines),
        "bullet lines": bullets > 1 and 10 * bullets > 9 * len(lines),
    }
    return {name for name, rejects in found.items() if rejects}


def test_rules_are_asked_one_after_the_other(spark, monkeypatch):
    line = lambda i: h.sentence(i, 9)
    texts = [
        "\n".join(map(line, range(4))),
        "\n".join(line(i) + " ..." * (i < 3) for i in range(6)),
        "\n".join(line(i) + "… " * (i < 1) for i in range(6)),
        "\n".join(f" - {line(i)}" for i in range(12)),
        "\n".join("-*•"[i % 3] * (i > 0) + line(i) for i in range(8)),
        " ".join(str(i * 37) for i in range(40)),
        " ".join(f"{i} ab{i}" for i in range(40)),
        " ".join("漢字" + str(i) for i in range(40)),
        line(1) + " a b ...",
        "# # # # " + line(2),
    ]
    texts += [t for _, t in texts_of(h.frame(spark)) if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["rejected_by"] for r in quality.judge(docs).collect()}
    named = [rejecting(t) for t in texts]
    assert all((found[i] in names) if names else found[i] is None for i, names in enumerate(named))
    assert set().union(*named) >= {"few letters", "cut lines", "bullet lines", "symbols"}

    # A measure that can't be taken of a text that another rule rejects: it isn't asked for.
    def strict(text, words):
        asked = quality.MEASURES["n_words"](text, words)
        return quality.F.when(asked < 10, quality.F.raise_error(quality.F.lit("asked"))).otherwise(asked)

    monkeypatch.setitem(quality.MEASURES, "strict", strict)
    late = quality.Rule("late", lambda m: m("strict") < 0)
    monkeypatch.setattr(
        quality, "estimate", lambda docs, rules: [(r, float(r is late), float(r is not late)) for r in rules]
    )
    rules = (late, *quality.RULES)
    assert {r["doc_id"]: r["kept"] for r in quality.judge(docs, rules).collect()} == {
        i: name is None for i, name in found.items()
    }
    kept = {r["doc_id"] for r in quality.filter_documents(docs, rules).collect()}
    assert kept == {i for i, name in found.items() if name is None}


def test_estimates_come_from_all_of_the_table(spark):
    # Short texts stand first, so the first rows alone would say that all are rejected.
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "IF(id < 5000, 'a b', repeat(concat('word', id, ' '), 30)) AS text"
    )
    found = {rule.name: (cost, share) for rule, cost, share in quality.estimate(docs)}
    assert 0.1 < found["few words"][1] < 0.45
    assert found["repeated words"][0] > found["few words"][0] >= 0


def test_cascade_order():
    a, b, c = (quality.Rule(n, lambda m: m("n_words") < 1) for n in "abc")
    assert quality.ordered([(a, 2.0, 0.1), (b, 1.0, 0.1), (c, 1.0, 0.0)]) == [b, a, c]


def water(sources: dict, weights, share: float, repeats: int) -> dict:
    """Targets by resharing the excess again and again."""
    budget, open_ = share * sum(sources.values()), set(sources)
    target = dict.fromkeys(sources, 0.0)
    while open_:
        level = (budget - sum(v for k, v in target.items() if k not in open_)) / sum(
            weights[k] for k in open_
        )
        over = {k for k in open_ if weights[k] * level >= repeats * sources[k]}
        for k in over or open_:
            target[k] = repeats * sources[k] if over else weights[k] * level
        open_ = open_ - over if over else set()
    return target


def test_mixing(docs):
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(h.words(r["text"]))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = water(size, weights, 1.5, 2)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    taken = Counter()
    for r in mixed:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    longest = max(r["size"] for r in mixed)
    assert all(abs(taken[s] - target[s]) <= 2 * longest for s in size)
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    again = mixing.mixed_documents(docs)
    assert again.columns == docs.columns
    assert sum(len(h.words(r["text"])) for r in again.collect()) == sum(taken.values())


def test_packing(docs):
    tokenizer = Tokenizer.from_file(h.TOKENIZER)
    expected = Counter()
    for doc_id, text in texts_of(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = ids[start : start + 4096]
            expected[doc_id, piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    packed = packing.pack(docs, h.TOKENIZER)
    rows = packed.collect()
    assert Counter(tuple(r)[:5] for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in held.values():
        ends = np.cumsum([0, *[n for _, n in sorted(items)]])
        assert [o for o, _ in sorted(items)] == ends[:-1].tolist() and ends[-1] <= 4096
    total = sum(r["length"] for r in rows)
    assert len(held) <= -(-total // 4096) + 2
    full = packing.sequences(docs, packed, h.TOKENIZER).collect()
    assert sum(len(r["ids"]) for r in full) == total and max(len(r["ids"]) for r in full) <= 4096


def test_subwords_are_those_of_the_tokenizer():
    words = ["Héllo,", "don't", "x2y", "...", "ÉCOLE!", "<|endoftext|>", "a b", "漢字", "ab--cd", "ﬁ", "Ａ"]
    whole = Tokenizer.from_file(h.TOKENIZER)
    own = packing.Subwords(h.TOKENIZER, most=5)
    for text in [*words, " ".join(words)]:
        ids = own.encode([text.encode().split()])[0].tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_subwords_keep_pieces_when_words_are_forgotten():
    whole = Tokenizer.from_file(h.TOKENIZER)
    own = packing.Subwords(h.TOKENIZER, most=3)
    first = [w.encode() for w in ["Alpha", "alpha,", "ALPHA", "alpha"]]
    own.encode([first])
    pieces = dict(own.parts)
    own.encode([[b"epsilon"]])
    assert not own.known.keys() & set(first)
    assert pieces.items() <= own.parts.items()
    for text in ["Alpha alpha, ALPHA alpha", "epsilon alpha"]:
        ids = own.encode([text.encode().split()])[0].tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("lengths", [[3000] * 5, [1400, 1400, 2000, 2000, 700], [4096, 1, 1], [1365] * 7, [1]])
def test_plan_places_every_piece(lengths):
    counts = Counter(lengths)
    plan = packing.Plan(dict(counts), 4096)
    seen, used = Counter(), defaultdict(list)
    for length, low, high, first, each, at in plan.places:
        for i in range(high - low):
            used[first + i // each].append((at + i % each * length, length))
        seen[length] += high - low
    assert seen == counts
    for items in used.values():
        ends = np.cumsum([0, *[n for _, n in sorted(items)]])
        assert [o for o, _ in sorted(items)] == ends[:-1].tolist() and ends[-1] <= 4096


@pytest.mark.parametrize("options", [{}, {"hot": 1, "shard_words": 200}, {"window": 9}])
def test_substrings(docs, options):
    rows = texts_of(docs)
    gone = h.repeated_words([t for _, t in rows], options.get("window", 35))
    expected = Counter(
        (i, len(g), sum(g), " ".join(w for w, x in zip(h.words(t), g) if not x))
        for (i, t), g in zip(rows, gone)
    )
    assert Counter(map(tuple, substrings.remove_repeats(docs, **options).collect())) == expected


def test_minimizers_count_all_their_places():
    phrase = h.sentence(1, 34)
    # What stands around the phrase differs, so its least hash is that of many places of one text.
    text = " ".join(f"{h.sentence(i, 40)} {phrase}" for i in range(2, 302))
    batch = substrings.pa.RecordBatch.from_pydict({"rid": [1], "text": [text]})
    times = next(substrings._minimizers(substrings.WINDOW)([batch])).column("times").to_numpy()
    assert times.max() == 300


def test_index_counts_windows():
    rng = np.random.default_rng(3)
    for _ in range(20):
        parts = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(12)]
        width = int(rng.integers(2, 6))
        text = np.concatenate([np.append(p, 0) for p in parts])
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        found = FMIndex(text, 5).frequent(text, starts, starts + sizes, width)
        counts = Counter(tuple(p[i : i + width]) for p in parts for i in range(len(p) - width + 1))
        for part, start in zip(parts, starts):
            for i in range(len(part) - width + 1):
                assert found[start + i] == (counts[tuple(part[i : i + width])] > 1)


def test_near_duplicates(docs):
    rows = texts_of(docs)
    group = h.near_classes(rows)
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    expected = Counter((i, least.get(g)) for (i, _), g in zip(rows, group))
    found = neardup.classes(docs).select("doc_id", "class_id").collect()
    assert Counter(map(tuple, found)) == expected
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group))


def test_blocks_find_links_outside_the_main_component(spark, monkeypatch):
    """Many variants around the threshold: no link is lost, whatever the blocks."""
    base = h.sentence(50, 120).split()
    rows = []
    for i in range(60):
        own = list(base)
        for j in range(2 + i % 4):
            own[(i * 7 + j * 29) % 120] = f"x{i}y{j}"
        rows.append((i, " ".join(own), None, None, None))
    monkeypatch.setattr(neardup, "OUTER_BLOCK", 4)
    monkeypatch.setattr(neardup, "INNER_BLOCK", 8)
    group = h.near_classes([(r[0], r[1]) for r in rows])
    least = {g: min(i for i, x in enumerate(group) if x == g) for g in group}
    found = neardup.classes(h.frame(spark, rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: least[g] for i, g in enumerate(group)}


def test_darts_estimate_weighted_likeness():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = np.concatenate([a[:240], rng.integers(0, 2**63, 60, dtype=np.uint64)])
    weights = rng.random(300) * 3
    both = weights[:240].sum()
    likeness = both / (2 * weights.sum() - both)
    signs = darts.signatures(
        np.concatenate([a, b]), np.array([0, 300, 600, 600]), 2048, np.concatenate([weights, weights])
    )
    assert (signs[0] == signs[1]).mean() == pytest.approx(likeness, abs=0.05)
    assert (signs[2] == np.iinfo(np.uint64).max).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 21), (4, 5), (5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, found)) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


def base_spans(text: str) -> list[tuple]:
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(docs):
    expected = Counter()
    for doc_id, text in texts_of(docs):
        spans = base_spans(text or "")
        kinds = Counter(k for _, k, _ in spans)
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        digest = hashlib.sha256(line.encode()).hexdigest()
        expected[doc_id, kinds[0], kinds[1], kinds[2], digest] += 1
    assert Counter(tuple(r)[:5] for r in secretscan.report(docs).collect()) == expected
    clean = secretscan.redact(docs)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    assert not any(base_spans(r["text"] or "") for r in clean.collect())


def test_trigram_queries_never_lose_a_match():
    texts = [b"xx Token: abcdef99", b"AKIA" + b"Z" * 16, b"api_key=123456", b"ghp_" + b"a" * 36, b"none", b""]
    queries = [trigrams.query(rule.pattern) for rule in secretscan.RULES]
    index = secretscan.TrigramIndex(sorted(set().union(*map(trigrams.grams, queries))))
    index.add(texts)
    for rule, query in zip(secretscan.RULES, queries):
        candidates = index.documents_of(query)
        for text, candidate in zip(texts, candidates):
            assert candidate or not rule.spans(text.decode())
    assert isinstance(trigrams.query("[0-9a-f]+"), trigrams.Any_)
    assert trigrams.grams(trigrams.query("(abcd|xyz)?k")) == set()
    assert trigrams.grams(trigrams.query("a(bc|de)f+")) == {b"abc", b"bcf", b"ade", b"def"}
    # Two texts in a row hold it only across their border.
    query = trigrams.query("KIAZ")
    index = secretscan.TrigramIndex(sorted(trigrams.grams(query)))
    index.add([*texts, b"AKI", b"AZ"])
    assert index.documents_of(query)[:6].tolist() == [False, True, False, False, False, False]
    assert not index.documents_of(query)[6:].any()


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = language.identify(docs, id_hash(4) != 2).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert all(h.remainder(r["doc_id"], 4) == 2 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


def test_language_of_odd_rows(spark):
    docs = h.frame(spark)
    rows = language.identify(docs, id_hash(4) != 2).collect()
    assert len(rows) == len(h.odd_rows())
    found = defaultdict(set)
    for r in rows:
        found[r["doc_id"]].add(r["lang_pred"])
        assert 0 <= r["score"] <= 1
    assert found[1] == found[2] == found[3] == {"und"} and "und" in found[None]
    nothing = language.identify(docs, id_hash(4) == 9).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_language_learns_whole_distinct_texts(spark):
    filler = "0123 " * 900
    rows = [(i, f"{filler} {h.sentence(i, 60)}", "x") for i in range(20)]
    rows += [(i, f"{filler} {h.sentence(i, 60).translate(str.maketrans('aeiou', 'bcdfg'))}", "y") for i in range(20)]
    # Many copies of one text in each language.
    rows += [(100 + i, "9", lang) for i in range(300) for lang in "xy"]
    rows += [(1000, h.sentence(500, 30), "x"), (1001, h.sentence(501, 30).translate(str.maketrans("aeiou", "bcdfg")), "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = scoring.F.col("doc_id") < 1000
    found = language.identify(docs, learn, documents=15).filter("held_out").collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1000: "x", 1001: "y"}
    sample = language.base64.b64decode(language.fit(docs.filter(learn)).split("\n")[0].split("\t")[1])
    assert sample.count(b"9 ") + sample.endswith(b" 9") <= 2
    assert all(h.sentence(i, 60).encode() in sample for i in range(20))


def test_language_tells_bytes_of_other_scripts_apart():
    # Two languages of letters from disjoint, large sets, beside many common ones.
    common = "".join(chr(c) for c in [*range(97, 123), *range(0x3B1, 0x3C9), *range(0x430, 0x450)]) * 40
    one = common + "".join(chr(0x10A0 + 7 * i % 20) for i in range(60))
    other = common + "".join(chr(0x10B4 + 7 * i % 12) for i in range(60))
    encode = lambda t: language.base64.b64encode(t.encode()).decode()
    found = language.Model(f"{encode('a')}\t{encode(one)}\n{encode('b')}\t{encode(other)}")
    used = {*one.encode(), *other.encode()}
    assert len(used) > 48 and len({int(found.alphabet[b]) for b in used} - {0}) == len(used)
    bits = found.bits([one[-60:].encode(), other[-60:].encode()])
    assert bits.argmin(axis=1).tolist() == [0, 1]


def test_sparse_contexts_are_those_of_code_lengths():
    sample = np.random.default_rng(0).integers(0, 5, 60)
    symbols, order = 6, 3
    bits = language.code_lengths(sample, symbols, order)
    digits = np.indices([symbols] * (order + 1)).reshape(order + 1, -1)
    grams = sum(d.astype(np.int64) << 8 * (order - k) for k, d in enumerate(digits))
    assert language.Contexts(sample, symbols, order).bits(grams) == pytest.approx(bits, abs=1e-4)


def test_code_lengths_are_those_of_chances():
    sample = np.array([1, 2, 1, 2, 3, 1, 2, 0, 3, 3, 1])
    bits = language.code_lengths(sample, 4, order=2).reshape(-1, 4)
    assert np.exp2(-bits).sum(axis=1) == pytest.approx(1, abs=1e-5)
    # After 2 and 1 comes 2, once: 1 of 1 + 1 escape.
    assert bits[2 * 4 + 1, 2] == pytest.approx(1, abs=1e-5)
    # Nothing came after 0 and 2; after 2 alone came three different symbols, once each.
    assert bits[0 * 4 + 2, 0] == pytest.approx(-np.log2(1 / 6), abs=1e-5)


def test_fingerprints(docs):
    rows = sorted(
        ((i, t or "") for i, t in texts_of(docs)), key=lambda r: (r[0] is None, r[0] or 0)
    )
    found = spotsigs.compare(docs).collect()
    assert len(found) == len(rows)
    ids = Counter(r["doc_id"] for r in found)
    assert ids == Counter(i for i, _ in rows)
    by_text = defaultdict(set)
    unique = [k for k, n in ids.items() if n == 1]
    got = {r["doc_id"]: r for r in found}
    for place, (doc_id, text) in enumerate(rows):
        follower = rows[(place + 1) % len(rows)]
        if doc_id not in unique:
            continue
        by_text[text].add(got[doc_id]["fingerprint"])
        assert got[doc_id]["n_chars"] == len(text)
        if follower[0] in unique:
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + follower[1][:quarter]
            assert got[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert all(len(v) == 1 for v in by_text.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)


def test_fingerprints_without_anchors_stay_alike(spark):
    plain = [h.sentence(i, 60 + i) for i in range(20)]
    running = " ".join(f"the {w} {w}x" for w in h.sentence(99, 80).split())
    assert not any(spotsigs.ANCHORS & set(t.split()) for t in plain)
    rows = [(2 * i + j, t) for i, t in enumerate(plain) for j, t in enumerate((t, running))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r["doc_id"]: r["near_edited"] for r in spotsigs.compare(docs).collect()}
    assert all(near[2 * i] > 0 for i in range(20))
    prints = spotsigs.Fingerprints()
    one, other, far = prints.of([t.encode() for t in (plain[0], plain[0] + " more words", plain[1])])
    assert spotsigs.likeness(one, other) > 0.8 > 0.1 > spotsigs.likeness(one, far)
    # Texts do not depend on those beside them.
    assert all((a == prints.of([t.encode()])[0]).all() for a, t in zip(prints.of([t.encode() for t in plain]), plain))


def spot_sets(docs) -> list[tuple]:
    found = spotsigs.fingerprints(docs).collect()
    return [(r["doc_id"], frozenset(re.findall("." * 8, r["fingerprint"]))) for r in found]


@pytest.mark.parametrize("floor, often", [(0.7, 10_000), (0.5, 3), (0.8, 0)])
def test_fingerprint_search(spark, monkeypatch, floor, often):
    monkeypatch.setattr(spotsigs, "OFTEN", often)
    docs = table(spark, SMALL, "documents")
    sets = dict(spot_sets(docs))
    found = spotsigs.search(docs.filter("doc_id % 20 = 0"), docs, floor).collect()
    expected = {
        (q, d)
        for q in sets
        for d in sets
        if q % 20 == 0 and sets[q] and len(sets[q] & sets[d]) >= floor * len(sets[q] | sets[d])
    }
    assert Counter((r["query_id"], r["doc_id"]) for r in found) == Counter(expected)


def test_fingerprint_links(docs):
    sets = spot_sets(docs)
    expected = Counter()
    for doc_id, own in sets:
        if doc_id is not None and doc_id % 20 == 0:
            near = [o for _, o in sets if own and len(own & o) >= 0.8 * len(own | o)]
            expected[doc_id, max(len(near) - 1, 0), len(set(near))] += 1
    rows = spotsigs.links(docs, F.col("doc_id") % 20 == 0)
    assert rows.columns == ["doc_id", "n_links", "n_linked_sets"]
    assert Counter(map(tuple, rows.collect())) == expected


def test_language_model_counts(docs):
    rows = [(i, [*(w.encode().lower() for w in h.words(t)), None]) for i, t in texts_of(docs)]
    train = [ws for i, ws in rows if h.remainder(i, 7) != 2]
    counts = Counter(w for ws in train for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (str(i), h.remainder(i, 7) == 2, len(ws), sum(counts[w] > 0 for w in ws), total),
            sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws),
        )
        for i, ws in rows
    )
    found = sorted(
        ((str(r[0]), *tuple(r)[1:5]), r["base_score"], r["score"])
        for r in scoring.score(docs, id_hash(7) != 2, h.TOKENIZER).collect()
    )
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert [f[1] for f in found] == pytest.approx([e[1] for e in expected])
    assert all(f[2] < 0 for f in found)


def test_attention_learns_more_than_frequencies(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    split = [r["text"].encode().lower().split() for r in docs]
    tokens = packing.subwords(h.TOKENIZER)
    ids, starts, _, _ = scoring._sequence(tokens, split[:200])
    held, held_starts, _, _ = scoring._sequence(tokens, split[200:300])
    counts = np.bincount(ids, minlength=scoring.IDS)
    model = attention.Attention(attention.Vocabulary.of(counts))
    model.train(ids, starts)
    alone = np.log((counts + 0.5) / (counts + 0.5).sum())[held].mean()
    assert model.log_chances(held, held_starts).mean() > alone + 0.7


def test_words_are_spelled_once_however_often_they_come(monkeypatch):
    spelled, plain = [], packing.Subwords.spelled
    monkeypatch.setattr(
        packing.Subwords, "spelled", lambda self, at: spelled.append(len(at)) or plain(self, at)
    )
    texts = ["Ab cd, " * 5000, None, "cd, x2y"] * 3
    batch = scoring.pa.RecordBatch.from_pydict({"text": texts})
    found = Counter()
    for out in scoring._count(h.TOKENIZER)([batch, batch]):
        for row in out.to_pylist():
            found[row["subword"], row["key"]] += row["n"]
    whole = Tokenizer.from_file(h.TOKENIZER)
    ids = Counter(i for t in texts for i in whole.encode(t or "", add_special_tokens=False).ids)
    expected = {i: 2 * n for i, n in (ids + Counter({scoring.END: len(texts)})).items()}
    assert {k: n for (subword, k), n in found.items() if subword} == expected
    assert sorted(n for (subword, _), n in found.items() if not subword) == [6, 30000, 30006]
    assert sum(spelled) == 3


def test_words_are_asked_for_once_a_block():
    batch = scoring.pa.RecordBatch.from_pydict({"text": ["a b c", "b c d", None], "block": [0, 1, 0]})
    asked = [(r["block"], r["key"]) for out in scoring._ask([batch, batch, batch]) for r in out.to_pylist()]
    key = lambda w: int(np.uint64(scoring.xxhash.xxh64_intdigest(w)).view(np.int64))
    assert Counter(asked) == Counter([(0, key(w)) for w in "abc"] + [(1, key(w)) for w in "bcd"])


def test_counts_of_a_block_follow_forgotten_words(monkeypatch):
    tokens = packing.Subwords(h.TOKENIZER, most=2)
    monkeypatch.setattr(scoring, "subwords", lambda path: tokens)
    words = [b"one", b"two", b"three", b"four"]
    keys = np.array([scoring.xxhash.xxh64_intdigest(w) for w in words[:3]], np.uint64).view(np.int64)
    counts = scoring.pa.table({"key": keys, "n": [1, 2, 3]})
    model = attention.Attention(attention.Vocabulary.of(np.ones(scoring.IDS)))
    reader = scoring._Reader(h.TOKENIZER, model, counts)
    for text, expected in (("one two three", [1, 2, 3]), ("four three one", [0, 3, 1]), ("two", [2])):
        border, n, of_word, of_end = reader.read(scoring.pa.RecordBatch.from_pydict({"text": [text]}))
        assert n.tolist() == expected and border.tolist() == [0, len(expected)]
        ids, starts, place, begin = scoring._sequence(tokens, [text.encode().split()])
        chance = model.log_chances(ids, starts)
        sums = [chance[place[low:high]].sum() for low, high in zip(begin, begin[1:])]
        assert of_word == pytest.approx(sums) and of_end == pytest.approx(chance[-1:])


def test_attention_is_sent_without_nodes_at_rest():
    model = attention.Attention(attention.Vocabulary.of(np.arange(3000.0)))
    model.tree[7] = 2
    sent = pickle.dumps(model)
    assert len(sent) < model.tree.nbytes and (pickle.loads(sent).tree == model.tree).all()


def patterned(seed: int, n: int) -> str:
    """Words of which each comes after one other."""
    names = h.sentence(1, 12).split()
    return " ".join(names[(seed + i) % len(names)] for i in range(n))


def shuffled(text: str) -> str:
    return " ".join(np.random.default_rng(0).permutation(text.split()))


def test_attention_learns_whole_distinct_texts(spark):
    # What follows a word is learned from what stands after 4000 characters of odd texts, and
    # though another text is there very often.
    rows = [(i, h.sentence(9, 40)) for i in range(0, 2000)]
    rows += [(i, h.sentence(i, 700) + " " + patterned(i, 900)) for i in range(2000, 2040)]
    rows += [(-1, patterned(5, 300)), (-2, shuffled(patterned(5, 300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = scoring.F.col("doc_id") >= 0
    found = {r["doc_id"]: r["score"] for r in scoring.score(docs, train, h.TOKENIZER).collect()}
    assert found[-1] - found[-2] > 0.1 * 300


def test_scores_follow_the_rows_not_their_layout(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SHARD_CHARS", 1 << 18)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    scores = lambda rows: sorted(
        tuple(r) for r in scoring.score(rows, id_hash(7) != 2, h.TOKENIZER).collect()
    )
    found = scores(docs)
    assert found == scores(docs.repartition(7, "text").orderBy(scoring.F.desc("doc_id")))
    # The weights are fitted on training texts, where no word is new.
    base, score = np.sum([r[5:] for r in found if not r[1]], axis=0)
    assert score > base + 0.005 * abs(base)


def test_attention_averages_shards(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SHARD_CHARS", 1 << 19)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    split = [r["text"].encode().lower().split() for r in docs.filter("doc_id % 5 = 0").collect()]
    learned = docs.filter("doc_id % 5 > 0")
    tokens = packing.subwords(h.TOKENIZER)
    held, starts, _, _ = scoring._sequence(tokens, split)
    own = [r["text"].encode().lower().split() for r in learned.collect()]
    counts = np.bincount(scoring._sequence(tokens, own)[0], minlength=scoring.IDS)
    alone = np.log((counts + 0.5) / (counts + 0.5).sum())[held].mean()
    model = scoring.fit(learned.repartition(3), counts, h.TOKENIZER)
    assert model.log_chances(held, starts).mean() > alone + 1


def test_attention_chances_within_classes_follow_context():
    rng = np.random.default_rng(0)
    # Pairs of two rare tokens each, of one class: only what stands before tells them apart.
    counts = np.zeros(4000)
    counts[:200] = 1000
    pairs = rng.integers(0, 40, 3000)
    tokens = np.stack([pairs, 1000 + 50 * pairs], axis=1).ravel()
    np.add.at(counts, tokens, 1)
    starts = np.arange(0, len(tokens) + 1, 30)
    vocabulary = attention.Vocabulary.of(counts)
    model = attention.Attention(vocabulary)
    everything = np.arange(len(counts))
    state = rng.standard_normal((1, attention.WIDTH)).astype(np.float32)
    model.tree += rng.standard_normal(model.tree.shape).astype(np.float32)
    within = np.exp(model._within(np.repeat(state, len(counts), axis=0), everything))
    of_class = np.bincount(vocabulary.class_of, within)
    assert of_class[np.unique(vocabulary.class_of)] == pytest.approx(1, abs=1e-4)
    model = attention.Attention(vocabulary)
    model.train(tokens, starts, epochs=30)
    second = np.arange(1, len(tokens), 2)
    shares = np.bincount(tokens[second], minlength=len(counts))[tokens[second]] / len(second)
    assert model.log_chances(tokens, starts)[second].mean() > np.log(shares).mean() + 2
    # Reading fewer classes or less before a token is no way to save time.
    assert attention.CLASSES >= 128 and attention.ALONE >= 96 and attention.WIDTH >= 24
    assert attention.WINDOW - attention.STRIDE >= 8


def test_attention_gradient_and_windows():
    vocabulary = attention.Vocabulary.of(np.arange(300.0))
    model = attention.Attention(vocabulary)
    rng = np.random.default_rng(0)
    tokens, starts = rng.integers(0, 300, 200), np.array([0, 1, 41, 200])
    chance = model.log_chances(tokens, starts)
    # A later token changes no chance before it.
    other = tokens.copy()
    other[150] = (other[150] + 1) % 300
    assert np.allclose(model.log_chances(other, starts)[:150], chance[:150], atol=1e-5)
    rows = rng.integers(0, 50, (3, attention.WINDOW))
    classes = rng.integers(0, attention.CLASSES, rows.shape)
    valid = np.ones(rows.shape, bool)
    gradient = model._gradient(rows, classes, valid)

    def loss() -> float:
        return -model._of_class(model._forward(rows)[-1].astype(float), classes).mean()

    for name in ("qkv", "mix", "places", "inputs"):
        at = np.unravel_index(np.abs(gradient[name]).argmax(), gradient[name].shape)
        kept, step = model.weights[name][at], 1e-2
        model.weights[name][at] = kept + step
        up = loss()
        model.weights[name][at] = kept - step
        down = loss()
        model.weights[name][at] = kept
        assert (up - down) / (2 * step) == pytest.approx(gradient[name][at], rel=0.05, abs=1e-4)


def test_gradient_down_the_tree():
    rng = np.random.default_rng(0)
    vocabulary = attention.Vocabulary.of(rng.zipf(1.3, 6000).astype(float))
    model = attention.Attention(vocabulary)
    model.tree += 0.3 * rng.standard_normal(model.tree.shape).astype(np.float32)
    # One node with many tokens, others with a few, and tokens that do not count.
    deep = np.flatnonzero(vocabulary.depth > 1)
    tokens = rng.choice(np.append(rng.choice(deep, 40), np.full(60, deep[0])), (5, attention.WINDOW))
    rows = rng.integers(0, 50, tokens.shape)
    valid = rng.random(tokens.shape) < 0.8
    classes = vocabulary.class_of[tokens]
    gradient = model._gradient(rows, classes, valid, tokens)
    nodes, passed, g = gradient["tree"]
    ways = vocabulary.node_of[tokens[valid]]
    assert dict(zip(nodes.tolist(), passed.tolist())) == Counter(ways[ways >= 0].tolist())
    assert passed.max() > attention.SLOTS

    h = model._forward(rows)[-2][valid]
    sums = defaultdict(float)
    for state, token in zip(h, tokens[valid]):
        for node, child in zip(vocabulary.node_of[token], vocabulary.child_of[token]):
            if node >= 0:
                z = model.tree[node] @ state + vocabulary.prior[node]
                p = np.exp(z - z.max())
                sums[node] += np.outer(p / p.sum() - (np.arange(attention.FAN) == child), state)
    for node, found in zip(nodes.tolist(), g):
        assert found == pytest.approx(sums[node], abs=1e-4)

    def loss() -> float:
        *_, h, z = model._forward(rows)
        own = model._of_class(z.astype(float), classes)[valid]
        return -(own + model._within(h[valid][:, :-1], tokens[valid])).mean()

    for name in ("qkv", "mix", "inputs"):
        at = np.unravel_index(np.abs(gradient[name]).argmax(), gradient[name].shape)
        kept, step = model.weights[name][at], 1e-2
        model.weights[name][at] = kept + step
        up = loss()
        model.weights[name][at] = kept - step
        down = loss()
        model.weights[name][at] = kept
        assert (up - down) / (2 * step) == pytest.approx(gradient[name][at], rel=0.05, abs=1e-4)


def test_large_scores_have_chances():
    rng = np.random.default_rng(0)
    vocabulary = attention.Vocabulary.of(np.arange(3000.0))
    model = attention.Attention(vocabulary)
    model.tree += 40 * rng.standard_normal(model.tree.shape).astype(np.float32)
    for weights in model.weights.values():
        weights *= 6
    tokens, starts = rng.integers(0, 3000, 300), np.array([0, 1, 90, 300])
    chances = model.log_chances(tokens, starts)
    assert np.isfinite(chances).all() and (chances <= 1e-3).all()
    state = rng.standard_normal((1, attention.WIDTH)).astype(np.float32)
    within = model._within(np.repeat(state, 3000, axis=0), np.arange(3000))
    of_class = np.bincount(vocabulary.class_of, np.exp(within))
    assert of_class[np.unique(vocabulary.class_of)] == pytest.approx(1, abs=1e-3)
    model.train(tokens, starts, epochs=1)
    assert all(np.isfinite(w).all() for w in model.weights.values()) and np.isfinite(model.tree).all()


def test_toxicity_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.score(docs, labels, id_hash(5) != 0).join(labels, "doc_id").filter("held_out")
    rows = found.select("predicted", "toxic").collect()
    right = [r["predicted"] == r["toxic"] for r in rows]
    caught = [r["predicted"] for r in rows if r["toxic"]]
    assert np.mean(right) > 0.97 and np.mean(caught) > 0.85


def test_toxicity_learns_what_stands_late(spark):
    clean = [h.sentence(i % 7, 2400) for i in range(160)]
    late = h.sentence(1000, 300)
    docs = [(i, t + (f" {late}" * 8 if i % 2 else "")) for i, t in enumerate(clean)]
    docs += [(1000, h.sentence(3, 100)), (1001, late)]
    assert all(len(t) > 12_000 and late not in t[:12_000] for _, t in docs[:160])
    labels = [(i, 0, i % 2) for i in range(160)]
    found = toxicity.score(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        toxicity.F.col("doc_id") < 160,
    )
    assert {r["doc_id"]: r["predicted"] for r in found.filter("held_out").collect()} == {1000: 0, 1001: 1}


def test_toxicity_takes_fewer_rows_not_parts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity.gru.Network, "train", lambda self, texts, labels: seen.append(texts))
    docs = spark.createDataFrame([(i, "word " * 4000) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    toxicity.fit(docs, labels, toxicity.F.lit(True), total=45_000)
    assert [len(t) for t in seen[0]] == [4000] * 6


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame(
        [(i, 0, i % 2) for i in range(1, 13)] + [(None, 0, 1), (7, None, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = toxicity.score(h.frame(spark), labels, id_hash(5) != 0).collect()
    assert len(rows) == len(h.odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    nothing = toxicity.score(h.frame(spark), labels.limit(0), id_hash(5) != 0).collect()
    assert {r["score"] for r in nothing} == {0.0}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = connection.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    expected = Counter(cursor.fetchall())
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == expected


def test_empty_tables(spark):
    docs = h.frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    learn = id_hash(4) != 2
    frames = [
        quality.judge(docs),
        quality.filter_documents(docs),
        mixing.mix(docs),
        mixing.mixed_documents(docs),
        packing.pack(docs, h.TOKENIZER),
        substrings.remove_repeats(docs),
        neardup.classes(docs),
        neardup.keep_one(docs),
        secretscan.report(docs),
        secretscan.redact(docs),
        language.identify(docs, learn),
        spotsigs.compare(docs),
        scoring.score(docs, learn, h.TOKENIZER),
        toxicity.score(docs, labels, learn),
    ]
    for found in frames:
        assert found.count() == 0
