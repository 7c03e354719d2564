"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is encoded by a small network from shares of
neighbouring byte classes, word lengths and repeated words.  A gated attention network, learned from document
labels only, weighs the passages; the weighted sum of their encodings gives the score.

Training is in numpy on the driver, from at most ``PER_CLASS`` labelled documents of each class with up to ``SAMPLE_BYTES``
bytes each.  Scoring runs in tasks over whole texts; a long text is many passages of one bag.

A text without words (null, empty or blank) scores the lowest score of the trained range, 0.  Without labels every score is
0.5; with labels of one class only, that class.  Repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np

from dropweave.llm._learning import Adam, sigmoid, slices
from dropweave.llm._words import NOT_BLANK, byte_table, words

PASSAGE_WORDS = 64
PER_CLASS = 3000
SAMPLE_BYTES = 20_000
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE = 30, 64, 0.004

_CLASSES = np.zeros(256, np.int64)
for _number, _members in enumerate((
        range(97, 123), range(65, 91), range(48, 58), [32, 9], [10, 13], [46, 44, 59, 58], [33, 63], [39, 34, 96], [40, 41, 91, 93, 123, 125],
        [47, 92, 95, 64], [124], range(128, 256)), 1):
    _CLASSES[byte_table(_members)] = _number
N_CLASSES = 13
WIDTH = N_CLASSES * N_CLASSES + 6


def passage_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of features per passage, and the number of passages per text."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    found = words(coded, NOT_BLANK)
    n = len(found.starts)
    if not n:
        return np.zeros((0, WIDTH), np.float32), np.zeros(len(texts), np.int64)
    first = np.cumsum(found.counts) - found.counts
    place = np.arange(n) - np.repeat(first, found.counts)
    begins = np.flatnonzero(place % PASSAGE_WORDS == 0)
    passage = np.cumsum(place % PASSAGE_WORDS == 0) - 1
    per_text = np.bincount(found.text[begins], minlength=len(texts))
    # Bytes of a passage: from its first word to the next passage's, or to the end of its text.  Each pairs with the byte after it;
    # behind a text that is the line feed between texts, so a score hangs on its own text only.
    starts = found.starts[begins]
    text_ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1) - 1
    of_text = found.text[begins]
    same = np.append(of_text[1:] == of_text[:-1], False)
    sizes = np.where(same, np.append(starts[1:], 0), text_ends[of_text]) - starts
    classes = _CLASSES[found.data]
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    pairs = classes[at] * N_CLASSES + classes[at + 1]
    of_byte = np.repeat(np.arange(len(begins)), sizes)
    shares = np.bincount(of_byte * N_CLASSES**2 + pairs, minlength=len(begins) * N_CLASSES**2).reshape(len(begins), -1)
    count = np.bincount(passage).astype(np.float64)
    length = found.ends - found.starts
    again = np.zeros(n, bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((found.hashes, passage))
    h, p = found.hashes[order], passage[order]
    new = np.ones(n, bool)
    new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    mean = np.bincount(passage, length) / count
    spread = np.sqrt(np.maximum(np.bincount(passage, length.astype(np.float64) ** 2) / count - mean**2, 0))
    extra = np.stack([np.bincount(passage, again) / count, np.bincount(p, new) / count, np.log1p(mean), np.log1p(spread),
                      np.log1p(count), np.log1p(np.maximum.reduceat(length, begins))], 1)
    return np.hstack([np.sqrt(shares / sizes[:, None]), extra]).astype(np.float32), per_text


class Model:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the output (o, c)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.weights = {"w": draw.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN),
                        "v": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
                        "a": draw.normal(0, GATE**-0.5, GATE), "o": draw.normal(0, HIDDEN**-0.5, HIDDEN), "c": np.zeros(1)}

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logits of bags (each with a passage at least) and what the backward pass needs."""
        w = self.weights
        x = (rows - self.mean) / self.scale
        h = np.tanh(x @ w["w"] + w["b"])
        t, g = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        s = (t * g) @ w["a"]
        begin = np.cumsum(counts) - counts
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, begin), counts))
        alpha = e / np.repeat(np.add.reduceat(e, begin), counts)
        z = np.add.reduceat(h * alpha[:, None], begin, axis=0)
        return z @ w["o"] + w["c"][0], (x, h, t, g, alpha, z, begin)

    def gradients(self, error: np.ndarray, counts: np.ndarray, kept: tuple) -> dict[str, np.ndarray]:
        """Gradients for the error of each bag's logit."""
        w, (x, h, t, g, alpha, z, begin) = self.weights, kept
        dz = np.repeat(error[:, None] * w["o"], counts, axis=0)
        d_alpha = (dz * h).sum(1)
        mean = np.repeat(np.add.reduceat(d_alpha * alpha, begin), counts)
        ds = alpha * (d_alpha - mean)
        dt, dg = ds[:, None] * w["a"] * g * (1 - t * t), ds[:, None] * w["a"] * t * g * (1 - g)
        dh = (dz * alpha[:, None] + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
        return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (ds[:, None] * t * g).sum(0),
                "o": z.T @ error, "c": np.array([error.sum()])}


def train(texts: list[str], labels: np.ndarray) -> Model | float:
    """A model, or the constant score there is evidence for."""
    if not len(labels) or labels.min() == labels.max():
        return float(labels[0]) if len(labels) else 0.5
    parts = [passage_features(texts[part]) for part in slices(texts)]
    rows, counts = np.concatenate([r for r, _ in parts]), np.concatenate([c for _, c in parts])
    del parts
    begin = np.cumsum(counts) - counts
    model = Model(rows.mean(0), rows.std(0) + 0.02)
    adam, draw = Adam(model.weights, RATE), np.random.default_rng(11)
    used = np.flatnonzero(counts)
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(used)
        for i in range(0, len(order), BATCH):
            bags = order[i:i + BATCH]
            sizes = counts[bags]
            at = np.repeat(begin[bags] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            logit, kept = model.forward(rows[at], sizes)
            gradients = model.gradients((sigmoid(logit) - labels[bags]) / len(bags), sizes, kept)
            for k in "wvuo":
                gradients[k] += 1e-4 * model.weights[k]
            adam.apply(gradients)
    return model


def score(model: Model | float, texts: list[str]) -> np.ndarray:
    rows, counts = passage_features(texts)
    out = np.zeros(len(texts))
    full = np.flatnonzero(counts)
    if isinstance(model, float):
        out[full if model < 1 else slice(None)] = model
    elif len(full):
        out[full] = sigmoid(model.forward(rows, counts[full])[0])
    return out


def attention(model: Model, text: str) -> np.ndarray:
    """The weight of each passage of a text."""
    rows, counts = passage_features([text])
    return model.forward(rows, counts)[1][4] if len(rows) else np.zeros(0)
