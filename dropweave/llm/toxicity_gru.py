"""Toxicity by a bidirectional gated recurrent network with attention pooling over word and character inputs.

A word enters as the vector of its hash bucket and the mean of the vectors of its character trigrams (with its borders).
Windows of ``WINDOW`` words that overlap by half go through a recurrent network in either direction; attention pools
the states of a window, and a text scores as its worst window.  All windows of a text are scored.

Training is in numpy on the driver, from at most ``PER_CLASS`` labelled documents of each class with up to ``SAMPLE_BYTES``
bytes.  Only texts are labelled, not windows: in every round the present network picks the worst window of each
training text, and learns from these.  The first axis of both kinds of vectors starts at the log odds of being found in
toxic training texts, so the first round picks well.

A text without words (null, empty, punctuation only) scores 0.  Without labels every other score is 0; with labels of one class,
that class.
"""

from __future__ import annotations

import numpy as np

from dropweave.llm._learning import Adam, sigmoid, slices
from dropweave.llm._words import ALNUM, mixed, words

WORD_BUCKETS, TRIGRAM_BUCKETS = 1 << 14, 1 << 14
AXES, HIDDEN, GATE = 4, 8, 8
WINDOW, STRIDE = 32, 16
PER_CLASS, SAMPLE_BYTES = 2000, 20_000
ROUNDS, BATCH, RATE = 8, 64, 0.01
SCORED = 4096
TEXTS = 200


class Tokens:
    """Distinct words of some texts: bucket of each, trigram buckets, and the words of every text in order."""

    def __init__(self, texts: list[str]) -> None:
        found = words([t.lower().encode("utf-8", "replace") for t in texts], ALNUM)
        self.counts = found.counts
        self.hashes, first, self.codes = np.unique(found.hashes, return_index=True, return_inverse=True)
        self.bucket = (self.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        starts, sizes = found.starts[first], found.ends[first] - found.starts[first]
        # Byte before and after the word count as blank, so a trigram knows where a word begins and ends.
        self.sizes = sizes
        self.begin = np.cumsum(sizes) - sizes
        at = np.repeat(starts - self.begin, sizes) + np.arange(sizes.sum())
        middle = found.data[at].astype(np.uint64)
        left, right = np.zeros_like(middle), np.zeros_like(middle)
        left[1:], right[:-1] = middle[:-1], middle[1:]
        if len(sizes):
            left[self.begin], right[self.begin + sizes - 1] = 32, 32
        self.trigrams = (mixed(left << np.uint64(16) | middle << np.uint64(8) | right) % np.uint64(TRIGRAM_BUCKETS)).astype(np.int64)

    @classmethod
    def of_many(cls, texts: list[str]) -> Tokens:
        """As ``Tokens(texts)``, in slices: the distinct words of a slice are kept, not what is worked out for its bytes."""
        parts = [cls(texts[part]) for part in slices(texts)]
        if len(parts) < 2:
            return parts[0] if parts else cls(texts)
        out = cls.__new__(cls)
        out.counts = np.concatenate([p.counts for p in parts])
        offsets = np.cumsum([0, *(len(p.hashes) for p in parts)])
        out.hashes, first, same = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True)
        out.codes = np.concatenate([same[o:][p.codes] for o, p in zip(offsets, parts)])
        out.bucket = np.concatenate([p.bucket for p in parts])[first]
        sizes, trigrams = np.concatenate([p.sizes for p in parts]), np.concatenate([p.trigrams for p in parts])
        starts = (np.cumsum(sizes) - sizes)[first]
        out.sizes = sizes[first]
        out.begin = np.cumsum(out.sizes) - out.sizes
        out.trigrams = trigrams[np.repeat(starts - out.begin, out.sizes) + np.arange(out.sizes.sum())]
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of every window, -1 beyond the text, and the number of windows per text."""
        per_text = np.where(self.counts > 0, np.maximum(1, -(-(self.counts - STRIDE) // STRIDE)), 0)
        first = np.cumsum(self.counts) - self.counts
        number = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        start = np.repeat(first, per_text) + number * STRIDE
        left = np.repeat(first + self.counts, per_text) - start
        place = start[:, None] + np.arange(WINDOW)
        codes = np.append(self.codes, 0)[np.minimum(place, len(self.codes))]
        return np.where(np.arange(WINDOW) < left[:, None], codes, -1), per_text


class Network:
    def __init__(self, seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        near = lambda *shape: draw.normal(0, shape[0]**-0.5, shape)
        self.weights = {"words": draw.normal(0, 0.05, (WORD_BUCKETS, AXES)), "trigrams": draw.normal(0, 0.05, (TRIGRAM_BUCKETS, AXES)),
                        "a": near(2 * HIDDEN, GATE), "ab": np.zeros(GATE), "av": near(GATE), "o": near(2 * HIDDEN), "c": np.full(1, -2.0)}
        for d in "fb":  # forward and backward: input to reset, update and new state; the same from the last state; biases
            self.weights |= {f"x{d}": near(2 * AXES, 3 * HIDDEN), f"h{d}": near(HIDDEN, 3 * HIDDEN), f"n{d}": np.zeros(3 * HIDDEN)}

    def start_from(self, tokens: Tokens, labels: np.ndarray) -> None:
        """First axes from the log odds of texts that hold a word or trigram."""
        for name, buckets in (("words", WORD_BUCKETS), ("trigrams", TRIGRAM_BUCKETS)):
            count = np.zeros((2, buckets), np.int64)  # not toxic, toxic
            ends = np.cumsum(tokens.counts)
            # Texts a few at a time: a text counts once for each of its buckets.
            for first in range(0, len(labels), TEXTS):
                part = slice(first, first + TEXTS)
                counts = tokens.counts[part]
                codes = tokens.codes[ends[first] - counts[0]:ends[part][-1]]
                text = np.repeat(np.arange(len(counts)), counts)
                if name == "words":
                    pairs = np.unique(text * buckets + tokens.bucket[codes])
                else:
                    sizes = tokens.sizes[codes]
                    at = np.repeat(tokens.begin[codes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    pairs = np.unique(np.repeat(text, sizes) * buckets + tokens.trigrams[at])
                np.add.at(count, ((labels[part][pairs // buckets] > 0).astype(np.int64), pairs % buckets), 1)
            odds = np.log((count[1] + 0.5) / (labels.sum() + 1)) - np.log((count[0] + 0.5) / (len(labels) - labels.sum() + 1))
            self.weights[name][:, 0] = np.clip(odds * (count.sum(0) >= 3), -3, 3) / 2

    def inputs(self, tokens: Tokens, dtype: type = np.float64) -> np.ndarray:
        """Vector of each distinct word."""
        characters = np.add.reduceat(self.weights["trigrams"][tokens.trigrams], tokens.begin, axis=0) / tokens.sizes[:, None]
        return np.hstack([self.weights["words"][tokens.bucket], characters]).astype(dtype)

    def run(self, vectors: np.ndarray, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple | None]:
        """Logits of windows.  ``vectors`` has a row per distinct word."""
        w, dtype = self.weights, vectors.dtype
        steps, n = codes.shape[1], len(codes)
        held, kept = np.empty((steps, n, 2 * HIDDEN), dtype), {}
        valid = codes >= 0
        for half, d in enumerate("fb"):
            table = np.vstack([vectors @ w[f"x{d}"].astype(dtype) + w[f"n{d}"].astype(dtype), np.zeros((1, 3 * HIDDEN), dtype)])
            recurrent = w[f"h{d}"].astype(dtype)
            state, trail = np.zeros((n, HIDDEN), dtype), []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                x, m = table[codes[:, t]], valid[:, t, None]
                r_z = sigmoid(x[:, :2 * HIDDEN] + state @ recurrent[:, :2 * HIDDEN])
                r, z = r_z[:, :HIDDEN], r_z[:, HIDDEN:]
                back = state @ recurrent[:, 2 * HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN:] + r * back)
                if keep:
                    trail.append((t, state, r, z, back, new))
                state = np.where(m, state + z * (new - state), state)
                held[t, :, half * HIDDEN:(half + 1) * HIDDEN] = state
            kept[d] = trail
        u = np.tanh(held @ w["a"].astype(dtype) + w["ab"].astype(dtype))
        s = np.where(valid.T, u @ w["av"].astype(dtype), -1e9)
        e = np.exp(s - s.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[:, :, None] * held).sum(0)
        logit = pooled @ w["o"].astype(dtype) + dtype.type(w["c"][0])
        return logit, (held, u, alpha, pooled, kept) if keep else None

    def gradients(self, tokens: Tokens, vectors: np.ndarray, codes: np.ndarray, error: np.ndarray, kept: tuple) -> dict[str, np.ndarray]:
        w, (held, u, alpha, pooled, trails) = self.weights, kept
        valid = codes >= 0
        d_pooled = error[:, None] * w["o"]
        d_alpha = (held * d_pooled).sum(2)
        ds = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        du = ds[:, :, None] * w["av"] * (1 - u * u)
        dh = alpha[:, :, None] * d_pooled + du @ w["a"].T
        out = {"o": pooled.T @ error, "c": np.array([error.sum()]), "av": (ds[:, :, None] * u).sum((0, 1)),
               "ab": du.sum((0, 1)), "a": held.reshape(-1, 2 * HIDDEN).T @ du.reshape(-1, GATE)}
        d_vectors = np.zeros((len(vectors) + 1, vectors.shape[1]))
        for half, d in enumerate("fb"):
            recurrent, carry = w[f"h{d}"], np.zeros((len(codes), HIDDEN))
            d_recurrent, d_bias, d_input = np.zeros_like(recurrent), np.zeros(3 * HIDDEN), np.zeros_like(w[f"x{d}"])
            extended = np.vstack([vectors, np.zeros((1, vectors.shape[1]))])
            for t, state, r, z, back, new in reversed(trails[d]):
                total = carry + dh[t, :, half * HIDDEN:(half + 1) * HIDDEN]
                live = total * valid[:, t, None]
                d_new = live * z * (1 - new * new)
                d_z = live * (new - state) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                pre = np.hstack([d_r, d_z, d_new])
                d_recurrent[:, :2 * HIDDEN] += state.T @ pre[:, :2 * HIDDEN]
                d_recurrent[:, 2 * HIDDEN:] += state.T @ (d_new * r)
                carry = total - live * z + pre[:, :2 * HIDDEN] @ recurrent[:, :2 * HIDDEN].T + (d_new * r) @ recurrent[:, 2 * HIDDEN:].T
                d_bias += pre.sum(0)
                d_input += extended[codes[:, t]].T @ pre
                np.add.at(d_vectors, codes[:, t], pre @ w[f"x{d}"].T)
            out |= {f"h{d}": d_recurrent, f"n{d}": d_bias, f"x{d}": d_input}
        d_vectors = d_vectors[:-1]
        out["words"] = np.zeros_like(w["words"])
        np.add.at(out["words"], tokens.bucket, d_vectors[:, :AXES])
        out["trigrams"] = np.zeros_like(w["trigrams"])
        live = np.flatnonzero(np.abs(d_vectors).sum(1))
        sizes = tokens.sizes[live]
        at = np.repeat(tokens.begin[live] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        np.add.at(out["trigrams"], tokens.trigrams[at], np.repeat(d_vectors[live, AXES:] / sizes[:, None], sizes, axis=0))
        return out


def _logits(net: Network, tokens: Tokens, codes: np.ndarray) -> np.ndarray:
    vectors = net.inputs(tokens, np.float32)
    return np.concatenate([net.run(vectors, codes[i:i + SCORED])[0] for i in range(0, len(codes), SCORED)])


def train(texts: list[str], labels: np.ndarray) -> Network | float:
    """A network, or the constant score there is evidence for."""
    if not len(labels) or labels.min() == labels.max():
        return float(labels[0]) if len(labels) else 0.0
    tokens, net, draw = Tokens.of_many(texts), Network(), np.random.default_rng(17)
    codes, counts = tokens.windows()
    net.start_from(tokens, labels)
    adam, begin = Adam(net.weights, RATE), np.cumsum(counts) - counts
    used = np.flatnonzero(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    for round_ in range(ROUNDS):
        adam.rate = RATE * (1 - round_ / ROUNDS)
        if round_:
            logit = _logits(net, tokens, codes)
        else:  # before any training: the window whose words have the largest log odds
            strength = np.append(net.inputs(tokens)[:, [0, AXES]].sum(1), -9.0)
            logit = np.sort(strength[codes], axis=1)[:, -3:].sum(1)
        order = np.lexsort((-logit, text))
        worst = order[begin[used]]
        labelled = labels[used]
        shuffled = draw.permutation(len(used))
        for i in range(0, len(shuffled), BATCH):
            part = shuffled[i:i + BATCH]
            window = codes[worst[part]]
            distinct, local = np.unique(np.append(window, -1), return_inverse=True)
            small = _part(tokens, distinct[1:])
            local = (local[:-1] - 1).reshape(window.shape)
            vectors = net.inputs(small)
            logit, kept = net.run(vectors, local, keep=True)
            adam.apply(net.gradients(small, vectors, local, (sigmoid(logit) - labelled[part]) / len(part), kept))
    return net


def _part(tokens: Tokens, chosen: np.ndarray) -> Tokens:
    """The tokens with only the chosen distinct words."""
    small = Tokens.__new__(Tokens)
    small.bucket, small.sizes = tokens.bucket[chosen], tokens.sizes[chosen]
    small.begin = np.cumsum(small.sizes) - small.sizes
    at = np.repeat(tokens.begin[chosen] - small.begin, small.sizes) + np.arange(small.sizes.sum())
    small.trigrams = tokens.trigrams[at]
    return small


def score(model: Network | float, texts: list[str]) -> np.ndarray:
    tokens = Tokens(texts)
    codes, counts = tokens.windows()
    out = np.zeros(len(texts))
    full = np.flatnonzero(counts)
    if isinstance(model, float):
        out[full] = model
    elif len(full):
        begin = np.cumsum(counts) - counts
        out[full] = sigmoid(np.maximum.reduceat(_logits(model, tokens, codes), begin[full]).astype(np.float64))
    return out
