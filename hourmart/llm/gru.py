"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word comes in twice: by an embedding of its own, and by the scaled sum of the embeddings of its
character n-grams, so unknown forms of a known word are read by their parts. Windows of words
pass through one recurrent layer in each direction; attention weighs the states of all words
into one vector, which decides.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

from hourmart.llm.common import kgram_hashes

EMBED, HIDDEN, POOL = 8, 8, 8
WINDOW, STRIDE = 32, 16
BATCH = 4096
# A word or n-gram needs so many documents of the sample to be known.
LEAST = 8
DECAY = 0.2


def plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(".,;:!?()[]{}\"'`|*#$%&<>-_/\\")


GRAMS = (3, 4, 5, 6)


def grams(word: str) -> list[str]:
    edged = f"^{word}$"
    return [edged[i : i + n] for n in GRAMS for i in range(len(edged) - n + 1)]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word (within the text) of all overlapping windows; one for an empty text."""
    many = np.where(sizes > WINDOW, 1 + -(-(sizes - WINDOW) // STRIDE), 1)
    text = np.repeat(np.arange(len(sizes)), many)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE


class Lookup:
    """Rows of words: their own embedding's row and those of their n-grams; 0 is unknown."""

    def __init__(self, words: dict[str, int], parts: dict[str, int]) -> None:
        self.words, self.parts = words, parts
        # Of each length the hashes of the known n-grams, sorted, and their rows.
        self.known = {}
        for n in GRAMS:
            own = [g for g in parts if len(g) == n]
            hashes = kgram_hashes(points("".join(own)), n)[::n]
            order = np.argsort(hashes)
            self.known[n] = hashes[order], np.array([parts[g] for g in own], np.int64)[order]

    @classmethod
    def of(cls, texts: list[list[str]]) -> Lookup:
        seen, parts = Counter(), Counter()
        for text in texts:
            own = set(text)
            seen.update(own)
            parts.update({g for w in own for g in grams(w)})
        number = lambda c: {k: i for i, k in enumerate(sorted(k for k in c if c[k] >= LEAST), 1)}
        return cls(number(seen), number(parts))

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each word; rows of all n-grams in one line, and whose word each is."""
        own = np.array([self.words.get(w, 0) for w in words], np.int64)
        text = points("".join([f"^{w}$" for w in words]))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.repeat(np.cumsum(sizes), sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        lines, owners = [], []
        for n, (hashes, rows) in self.known.items():
            if not len(rows) or len(text) < n:
                continue
            inside = np.flatnonzero(np.arange(n, len(text) + 1) <= ends[: len(text) - n + 1])
            found = kgram_hashes(text, n)[inside]
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            same = hashes[at] == found
            lines.append(rows[at[same]])
            owners.append(word[inside[same]])
        if not lines:
            return own, np.zeros(0, np.int64), np.zeros(0, np.int64)
        line, owner = np.concatenate(lines), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return own, line[order], owner[order]


class Network:
    def __init__(self, lookup: Lookup, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s, by=1.0: (by * rng.standard_normal(s)).astype(np.float32)
        h, x = HIDDEN, 2 * EMBED
        self.lookup = lookup
        self.weights = {
            "word": draw(len(lookup.words) + 1, EMBED, by=0.01),
            "part": draw(len(lookup.parts) + 1, EMBED, by=0.01),
            "attend": draw(2 * h, POOL, by=0.3),
            "query": draw(POOL, by=0.3),
            "out": draw(2 * h, by=0.3),
            "bias": np.full(1, -1, np.float32),
        }
        for way in ("ahead", "back"):
            self.weights |= {
                f"{way} in": draw(x, 3 * h, by=0.3),
                f"{way} own": draw(h, 3 * h, by=0.3),
                f"{way} bias": np.zeros(3 * h, np.float32),
            }
        self.weights["word"][0] = 0

    def embed(self, own: np.ndarray, line: np.ndarray, owner: np.ndarray) -> np.ndarray:
        w = self.weights
        total = np.zeros((len(own), EMBED), np.float32)
        for j in range(EMBED):
            total[:, j] = np.bincount(owner, w["part"][line, j], len(own))
        total /= np.sqrt(np.maximum(np.bincount(owner, minlength=len(own)), 1))[:, None]
        return np.concatenate([w["word"][own], total], axis=1)

    def _run(self, way: str, x: np.ndarray, there: np.ndarray, trace: list | None) -> np.ndarray:
        w, h = self.weights, HIDDEN
        state = np.zeros((len(x), h), np.float32)
        out = np.empty((*x.shape[:2], h), np.float32)
        gates = x @ w[f"{way} in"] + w[f"{way} bias"]
        for t in range(x.shape[1]) if way == "ahead" else reversed(range(x.shape[1])):
            a, u, m = gates[:, t], state @ w[f"{way} own"], there[:, t, None]
            zr = sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
            if trace is not None:
                trace.append((t, state, z, r, n, u[:, 2 * h :], m))
            state = np.where(m, z * state + (1 - z) * n, state)
            out[:, t] = state
        return out

    def forward(self, x: np.ndarray, there: np.ndarray, traces: dict | None = None):
        w = self.weights
        ways = ("ahead", "back")
        h = np.concatenate(
            [self._run(k, x, there, None if traces is None else traces.setdefault(k, [])) for k in ways],
            axis=2,
        )
        e = np.tanh(h @ w["attend"])
        s = np.where(there, e @ w["query"], np.float32(-1e9))
        s = np.exp(s - s.max(axis=1, keepdims=True)) * there
        s /= np.maximum(s.sum(axis=1, keepdims=True), 1e-9)
        pooled = (s[:, :, None] * h).sum(axis=1)
        return h, e, s, pooled, pooled @ w["out"] + w["bias"][0]

    def gradient(self, x: np.ndarray, there: np.ndarray, label: np.ndarray) -> tuple[dict, np.ndarray]:
        w, n = self.weights, HIDDEN
        traces: dict = {}
        h, e, s, pooled, logit = self.forward(x, there, traces)
        d = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        found = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        dp = d[:, None] * w["out"]
        ds = np.einsum("btk,bk->bt", h, dp)
        ds = s * (ds - (s * ds).sum(axis=1, keepdims=True))
        de = ds[:, :, None] * w["query"] * (1 - e * e)
        dh = s[:, :, None] * dp[:, None, :] + de @ w["attend"].T
        found["query"] = np.einsum("btk,bt->k", e, ds)
        found["attend"] = np.einsum("btk,btj->kj", h, de)
        dx = np.zeros_like(x)
        for way, part in (("ahead", slice(0, n)), ("back", slice(n, 2 * n))):
            dgates = np.zeros((*x.shape[:2], 3 * n), np.float32)
            down = np.zeros((len(x), n), np.float32)
            down_own = np.zeros_like(w[f"{way} own"])
            for t, state, z, r, new, u, m in reversed(traces[way]):
                down = down + dh[:, t, part]
                here = np.where(m, down, 0)
                dn = here * (1 - z) * (1 - new * new)
                dz = here * (state - new) * z * (1 - z)
                dr = dn * u * r * (1 - r)
                dgates[:, t] = np.concatenate([dz, dr, dn], axis=1)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                down_own += state.T @ du
                down = np.where(m, here * z, down) + du @ w[f"{way} own"].T
            found[f"{way} own"] = down_own
            found[f"{way} in"] = np.einsum("btx,btg->xg", x, dgates)
            found[f"{way} bias"] = dgates.sum(axis=(0, 1))
            dx += dgates @ w[f"{way} in"].T
        return found, dx

    def _batches(self, sizes: np.ndarray):
        text, first = windows(sizes)
        for low in range(0, len(text), BATCH):
            yield text[low : low + BATCH], first[low : low + BATCH]

    @staticmethod
    def places(text: np.ndarray, first: np.ndarray, begin: np.ndarray, sizes: np.ndarray):
        at = first[:, None] + np.arange(WINDOW)
        there = at < sizes[text][:, None]
        return np.where(there, begin[text][:, None] + at, 0), there

    def gates(self, vectors: np.ndarray) -> np.ndarray:
        """What words bring to the gates of each direction, whatever stands around them.

        Inputs of a sigmoid are halved: it is computed as a hyperbolic tangent.
        """
        out = np.empty((len(vectors), 2, 3 * HIDDEN), np.float32)
        for i, way in enumerate(("ahead", "back")):
            out[:, i] = vectors @ self.weights[f"{way} in"] + self.weights[f"{way} bias"]
        out[:, :, : 2 * HIDDEN] *= 0.5
        return out

    def _infer(self, gates: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """The logits that ``forward`` gives, both directions step by step at once."""
        w, h, (many, steps) = self.weights, HIDDEN, at.shape
        own = np.stack([w["ahead own"], w["back own"]])
        own[:, :, : 2 * h] *= 0.5
        forth, back = (np.ascontiguousarray(gates[:, i]) for i in range(2))
        at, there = np.ascontiguousarray(at.T), np.ascontiguousarray(there.T)
        state = np.zeros((2, many, h), np.float32)
        states = np.empty((steps, many, 2 * h), np.float32)
        a = np.empty((2, many, 3 * h), np.float32)
        for t in range(steps):
            np.take(forth, at[t], axis=0, out=a[0])
            np.take(back, at[steps - 1 - t], axis=0, out=a[1])
            u = state @ own
            zr = a[:, :, : 2 * h] + u[:, :, : 2 * h]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            n = zr[:, :, h:] * u[:, :, 2 * h :]
            n += a[:, :, 2 * h :]
            np.tanh(n, out=n)
            state -= n
            state *= zr[:, :, :h]
            state += n
            # What follows the last word must not reach the others: it comes last ahead, first back.
            state[1] *= there[steps - 1 - t][:, None]
            states[t, :, :h] = state[0]
            states[steps - 1 - t, :, h:] = state[1]
        s = np.tanh(states @ w["attend"]) @ w["query"]
        s[~there] = -1e9
        s = np.exp(s - s.max(axis=0)) * there
        s /= np.maximum(s.sum(axis=0), 1e-9)
        return (s * (states @ w["out"])).sum(axis=0) + w["bias"][0]

    def logits(self, gates: np.ndarray, words: np.ndarray, sizes: np.ndarray):
        """Logits of all windows, with their texts and first words; ``words`` are rows of ``gates``."""
        begin = np.cumsum(sizes) - sizes
        words = words if len(words) else np.zeros(1, np.int64)
        # Only the words that occur, side by side.
        kinds, words = np.unique(words, return_inverse=True)
        gates, found = gates[kinds], []
        for text, first in self._batches(sizes):
            at, there = self.places(text, first, begin, sizes)
            found.append((text, first, self._infer(gates, words[at], there)))
        return tuple(map(np.concatenate, zip(*found)))

    def train(self, texts: list[list[str]], labels: np.ndarray, epochs: int = 10, rate: float = 0.01) -> None:
        """Each text is learned by the window that now looks most like label 1, and a random one if 0."""
        rng = np.random.default_rng(1)
        vocabulary = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(vocabulary)}
        words = np.array([number[w] for t in texts for w in t], np.int64)
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        own, line, owner = self.lookup.rows(vocabulary)
        many = np.sqrt(np.maximum(np.bincount(owner, minlength=len(vocabulary)), 1))
        line_at = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            known = self.gates(self.embed(own, line, owner))
            text, first, logit = self.logits(known, words, sizes)
            noise = rng.random(len(text))
            best = np.lexsort((logit if epoch else noise, text))
            best = best[np.append(np.diff(text[best]) > 0, True)]
            some = np.lexsort((noise, text))
            some = some[np.append(np.diff(text[some]) > 0, True)]
            chosen = np.concatenate([best, some[labels[text[some]] == 0]])
            order = rng.permutation(len(chosen))
            for low in range(0, len(order), 64):
                pick = chosen[order[low : low + 64]]
                at, there = self.places(text[pick], first[pick], begin, sizes)
                kinds, local = np.unique(words[at], return_inverse=True)
                local = local.reshape(at.shape)
                spans = [np.arange(line_at[k], line_at[k + 1]) for k in kinds]
                lines = np.concatenate(spans)
                mine = np.repeat(np.arange(len(kinds)), [len(s) for s in spans])
                x = self.embed(own[kinds], line[lines], mine)[local]
                found, dx = self.gradient(x, there, labels[text[pick]].astype(np.float32))
                dx[~there] = 0
                of_word = np.zeros((len(kinds), 2 * EMBED), np.float32)
                np.add.at(of_word, local.ravel(), dx.reshape(-1, 2 * EMBED))
                found["word"] = np.zeros_like(self.weights["word"])
                np.add.at(found["word"], own[kinds], of_word[:, :EMBED])
                found["word"][0] = 0
                found["part"] = np.zeros_like(self.weights["part"])
                share = of_word[mine, EMBED:] / many[kinds][mine, None]
                np.add.at(found["part"], line[lines], share)
                step += 1
                pace = rate * (1 - 0.9 * epoch / epochs)
                for k, g in found.items():
                    m, v = moment[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    scale = (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
                    self.weights[k] -= pace * scale * m / (np.sqrt(v) + 1e-6)
                    if k in ("word", "part"):
                        # Words of single texts are forgotten, those that help are learned again.
                        self.weights[k] *= 1 - DECAY * pace
