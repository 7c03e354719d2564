"""Passage attention, toxicity network and the split of labelled rows."""

import random
import re
import zlib
from math import exp, log1p, sqrt, tanh

import numpy as np
import pytest
from pyspark.sql import functions as F

from dropweave.llm import passage_attention, queries, toxicity_gru
from dropweave.llm._common import id_crc
from dropweave.llm._learning import judged, labelled_sample, scored, sigmoid

draw = random.Random(8)
GOOD = ["ander", "blume", "river", "stone", "walking", "house", "garden", "letter", "morning", "quiet", "table", "window"]


def prose(n, extra=()):
    words = [draw.choice(GOOD) for _ in range(n)]
    for w in extra:
        words.insert(draw.randrange(len(words) + 1), w)
    return " ".join(words)


def test_sample_keeps_held_out_rows_and_bounds(spark):
    docs = spark.createDataFrame([(i, f"t{i}" * (1 if i % 5 else 100)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(400)], "doc_id long, quality boolean").withColumn(
        "quality", F.col("quality").cast("int"))
    texts, known = labelled_sample(docs, labels, "quality", id_crc("doc_id") % 4 == 2, 30, 50)
    assert len(texts) == 60 and known.sum() == 30
    for t in texts:
        i = int(t[1:])
        assert zlib.crc32(str(i).encode()) % 4 != 2 and i % 5


def test_attention_gradients():
    rows, counts = passage_features_of(["a b c " * 40, "x | y | z", "Q! " * 100])
    model = passage_attention.Model(rows.mean(0), rows.std(0) + 0.1)
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        logit, _ = model.forward(rows, counts)
        p = sigmoid(logit)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum()

    logit, kept = model.forward(rows, counts)
    check(model.weights, model.gradients(sigmoid(logit) - labels, counts, kept), loss)


def passage_features_of(texts):
    rows, counts = passage_attention.passage_features(texts)
    return rows.astype(np.float64), counts


def check(weights, gradients, loss, only=None):
    rng = np.random.default_rng(0)
    for name, g in gradients.items():
        flat = weights[name].reshape(-1)
        places = np.flatnonzero(g.reshape(-1))
        for at in rng.choice(places, min(5, len(places)), replace=False):
            old = flat[at]
            flat[at] = old + 1e-5
            up = loss()
            flat[at] = old - 1e-5
            down = loss()
            flat[at] = old
            assert (up - down) / 2e-5 == pytest.approx(g.reshape(-1)[at], rel=2e-3, abs=1e-7), name


def test_network_gradients():
    tokens = toxicity_gru.Tokens(["one two three", "four five " * 10, "two six"])
    codes, counts = tokens.windows()
    net = toxicity_gru.Network()
    labels = np.arange(len(codes)) % 2.0

    def loss():
        p = sigmoid(net.run(net.inputs(tokens), codes)[0])
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum()

    vectors = net.inputs(tokens)
    logit, kept = net.run(vectors, codes, keep=True)
    check(net.weights, net.gradients(tokens, vectors, codes, sigmoid(logit) - labels, kept), loss)


def test_windows_overlap_and_cover_every_word():
    for n in (0, 1, 15, 16, 17, 32, 33, 48, 49, 200):
        tokens = toxicity_gru.Tokens(["w " * 3, " ".join(f"w{i}" for i in range(n))])
        codes, counts = tokens.windows()
        own = codes[counts[0]:]
        assert set(own[own >= 0]) == set(tokens.codes[3:])
        assert len(own) == counts[1] == (0 if n == 0 else max(1, -(-(n - 16) // 16)))


def test_quality_on_held_out_texts():
    def good():
        return prose(draw.randrange(20, 300))

    def bad():
        return draw.choice([lambda: " | ".join(draw.choice(GOOD) for _ in range(60)), lambda: (draw.choice(GOOD) + " ") * 80,
                            lambda: prose(60).upper() + "!!!"])()

    train = [(good(), 1.0) for _ in range(150)] + [(bad(), 0.0) for _ in range(150)]
    model = passage_attention.train([t for t, _ in train], np.array([y for _, y in train]))
    test = [(good(), 1) for _ in range(60)] + [(bad(), 0) for _ in range(60)]
    got = passage_attention.score(model, [t for t, _ in test])
    assert ((got >= 0.7) == [y for _, y in test]).mean() > 0.95
    # One poor passage among many good ones gets its own weight; weights add up to one.
    weights = passage_attention.attention(model, prose(64 * 5) + " " + " | ".join(GOOD * 6))
    assert weights.sum() == pytest.approx(1)


def test_toxic_words_anywhere_on_held_out_texts():
    toxic = ["scumbag", "idioten", "lowlife"]
    train = [(prose(draw.randrange(5, 200)), 0.0) for _ in range(200)] + [
        (prose(draw.randrange(5, 200), [draw.choice(toxic) + draw.choice(["", "s", "ly"]) for _ in range(3)]), 1.0) for _ in range(200)]
    net = toxicity_gru.train([t for t, _ in train], np.array([y for _, y in train]))
    test = [(prose(draw.randrange(5, 3000)), 0) for _ in range(60)] + [
        (prose(draw.randrange(5, 3000), [draw.choice(toxic) for _ in range(2)]), 1) for _ in range(60)]
    got = toxicity_gru.score(net, [t for t, _ in test])
    assert ((got >= 0.5) == [y for _, y in test]).mean() > 0.95


@pytest.mark.parametrize("module, blank", [(passage_attention, 0.0), (toxicity_gru, 0.0)])
def test_odd_texts_and_constant_labels(module, blank):
    texts = ["", "  \n", "word", "é" * 200_000, "w " * 100_000]
    rng_texts = [prose(20), "| " * 50 + "idiot"] * 10
    model = module.train(rng_texts, np.array([1.0, 0.0] * 10))
    got = module.score(model, texts)
    assert got[0] == got[1] == blank and ((got >= 0) & (got <= 1)).all()
    assert module.score(module.train([], np.zeros(0)), texts)[2] in (0.0, 0.5)
    assert module.score(module.train(["a", "b"], np.ones(2)), texts)[2] == 1.0
    assert len(module.score(model, [])) == 0


def test_scores_of_a_table(spark):
    model = passage_attention.train([prose(20), "| " * 50] * 10, np.array([1.0, 0.0] * 10))
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, None, 6), (2, "", None)], "doc_id long, text string, score long")
    got = judged(df, scored(df.drop("score"), model, passage_attention.score, "text", ["doc_id"]), 4, 2, 0.7)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and len(got.collect()) == 4
    assert [r.held_out for r in got.filter("doc_id IS NULL").collect()] == [zlib.crc32(b"") % 4 == 2]
    assert len({r.score for r in got.filter("doc_id = 1").collect()}) == 1
    assert scored(df.limit(0), model, passage_attention.score, "text", ["doc_id"], "s").count() == 0


def test_queries_hold_rows_without_an_id(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([(None, "a null id"), (None, None)] + [(i, prose(30) if i % 2 else "| " * 60 + "idiot") for i in range(80)],
                                 "doc_id long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(None, 1, 1), (3, None, None)] + [(i, i % 2, 1 - i % 2) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for query in (queries.passage_quality, queries.toxicity):
        rows = query(spark, folder).collect()
        assert len(rows) == 82 and sum(r.doc_id is None for r in rows) == 2
        odd, even = ([r.score for r in rows if r.doc_id is not None and r.doc_id % 2 == y] for y in (1, 0))
        assert min(odd) > max(even) if query is queries.passage_quality else max(odd) < min(even)


TEXTS = ["", " \n ", "\n lead and trail \n\n", "one", "Good words, good words | 12 (x) 'y' é über?! " * 40, "x " * 130, "tab\tand \x0b more\r\n" * 30, "東京 " * 70]


def plain_passages(text):
    """Features of each passage, counted byte by byte."""
    data = text.encode()
    found = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", data)]
    out = []
    for first in range(0, len(found), passage_attention.PASSAGE_WORDS):
        own = found[first:first + passage_attention.PASSAGE_WORDS]
        end = found[first + passage_attention.PASSAGE_WORDS][0] if first + passage_attention.PASSAGE_WORDS < len(found) else len(data)
        n = passage_attention.N_CLASSES
        row, size = [0.0] * (n * n), end - own[0][0]
        for i in range(own[0][0], end):
            after = data[i + 1] if i + 1 < len(data) else 10
            row[passage_attention._CLASSES[data[i]] * n + passage_attention._CLASSES[after]] += 1
        words, lengths = [data[a:b] for a, b in own], [b - a for a, b in own]
        mean = sum(lengths) / len(own)
        spread = sqrt(max(sum(x * x for x in lengths) / len(own) - mean * mean, 0))
        out.append([sqrt(x / size) for x in row] + [
            sum(a == b for a, b in zip(words, words[1:])) / len(own), len(set(words)) / len(own), log1p(mean), log1p(spread),
            log1p(len(own)), log1p(max(lengths))])
    return out


def test_quality_agrees_with_plain_loops():
    model = passage_attention.train([prose(150) for _ in range(40)] + ["| x " * 90] * 40, np.array([1.0, 0.0] * 40))
    got = passage_attention.score(model, TEXTS)
    w = {k: v.tolist() for k, v in model.weights.items()}
    for text, value in zip(TEXTS, got):
        held = []
        for row in plain_passages(text):
            x = [(v - m) / s for v, m, s in zip(row, model.mean.tolist(), model.scale.tolist())]
            h = [tanh(sum(x[i] * w["w"][i][j] for i in range(len(x))) + w["b"][j]) for j in range(passage_attention.HIDDEN)]
            gated = [tanh(sum(h[i] * w["v"][i][j] for i in range(len(h)))) / (1 + exp(-sum(h[i] * w["u"][i][j] for i in range(len(h)))))
                     for j in range(passage_attention.GATE)]
            held.append((exp(sum(a * g for a, g in zip(w["a"], gated))), h))
        if not held:
            assert value == 0
            continue
        total = sum(e for e, _ in held)
        pooled = [sum(e / total * h[j] for e, h in held) for j in range(passage_attention.HIDDEN)]
        assert value == pytest.approx(1 / (1 + exp(-sum(p * o for p, o in zip(pooled, w["o"])) - w["c"][0])), abs=1e-4)
    alone = [passage_attention.score(model, [t])[0] for t in TEXTS]
    assert alone == pytest.approx(got.tolist(), abs=1e-9)  # whatever texts lie beside it


def plain_hash(data, size):
    mask, factor, h = 2**64 - 1, 0x9E3779B97F4A7C15, 0
    if size is None:
        for place, byte in enumerate(data, 1):
            h = (h + (byte + 1) * pow(factor, place, 2**64)) & mask
    else:
        h = data[0] << 16 | data[1] << 8 | data[2]
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = ((h ^ (h >> shift)) * by) & mask
    h ^= h >> 33
    return h % (toxicity_gru.WORD_BUCKETS if size is None else size)


def test_toxicity_agrees_with_plain_loops():
    texts = [t for t in TEXTS if len(t) < 900] + ["You scumbag, go " + "home " * 40]
    train = [prose(40) for _ in range(40)] + [prose(30, ["scumbag"]) for _ in range(40)]
    net = toxicity_gru.train(train, np.array([0.0] * 40 + [1.0] * 40))
    w, size = net.weights, toxicity_gru.HIDDEN

    def sig(v):
        return 1 / (1 + np.exp(-v))

    def logit(window):
        states = {}
        for d, order in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
            state = np.zeros(size)
            for t in order:
                x = window[t] @ w[f"x{d}"] + w[f"n{d}"]
                back = state @ w[f"h{d}"]
                r, z = sig(x[:size] + back[:size]), sig(x[size:2 * size] + back[size:2 * size])
                state = state + z * (np.tanh(x[2 * size:] + r * back[2 * size:]) - state)
                states[t, d] = state
        held = [np.concatenate([states[t, "f"], states[t, "b"]]) for t in range(len(window))]
        scores = [np.tanh(h @ w["a"] + w["ab"]) @ w["av"] for h in held]
        weights = np.exp(scores) / np.exp(scores).sum()
        return sum(a * h for a, h in zip(weights, held)) @ w["o"] + w["c"][0]

    for text, value in zip(texts, toxicity_gru.score(net, texts)):
        vectors = []
        for word in re.findall(rb"[0-9a-zA-Z\x80-\xff]+", text.lower().encode()):
            padded = b" " + word + b" "
            trigrams = [w["trigrams"][plain_hash(padded[i:i + 3], toxicity_gru.TRIGRAM_BUCKETS)] for i in range(len(word))]
            vectors.append(np.concatenate([w["words"][plain_hash(word, None)], sum(trigrams) / len(word)]))
        starts = range(0, max(len(vectors) - toxicity_gru.STRIDE, 1), toxicity_gru.STRIDE) if vectors else []
        want = max((sig(logit(vectors[s:s + toxicity_gru.WINDOW])) for s in starts), default=0)
        assert value == pytest.approx(want, abs=1e-4)


def test_tokens_in_slices_are_those_at_once(monkeypatch):
    texts = [prose(draw.randrange(1, 60), ["naïve", "x"]) for _ in range(50)] + ["", "é" * 30]
    at_once = toxicity_gru.Tokens(texts)
    monkeypatch.setattr(toxicity_gru, "slices", lambda t: [slice(i, i + 7) for i in range(0, len(t), 7)])
    parts = toxicity_gru.Tokens.of_many(texts)
    for name in ("counts", "hashes", "codes", "bucket", "sizes", "begin", "trigrams"):
        assert (getattr(parts, name) == getattr(at_once, name)).all(), name
