"""Token alignment against a plain version with the libraries' own encoders."""

import hashlib
import random
from collections import Counter
from functools import reduce
from itertools import pairwise

import numpy as np
import pytest

from dropweave.llm import token_alignment as own
from dropweave.llm._byte_bpe import byte_letters
from dropweave.llm.queries import vocabulary

FILES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return own.Tokenizers.load(*FILES)


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = byte_letters()
    bytes_a = {i: bytes(map(letters.__getitem__, a.id_to_token(i))) for i in range(50_256)}
    bytes_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())]
    return a, b, bytes_a, bytes_b


def plain(encoders, text):
    """Groups ``(a ids, b ids)`` and links of a text, token by token."""
    a, b, bytes_a, bytes_b = encoders
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    wanted = (" " + text).encode()
    if b"".join(bytes_a[i] for i in ids_a) != wanted or b"".join(bytes_b[i] for i in ids_b) != wanted:
        return [], []
    spans = []
    for ids, table in ((ids_a, bytes_a), (ids_b, bytes_b)):
        ends = np.cumsum([len(table[i]) for i in ids]).tolist()
        spans.append([(i, e - len(table[i]), e) for i, e in zip(ids, ends)])
    shared = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
    groups = [([i for i, _, e in spans[0] if x < e <= y], [i for i, _, e in spans[1] if x < e <= y]) for x, y in pairwise([0, *shared])]
    links, first = [], 0
    for i, s, e in spans[0]:
        while spans[1][first][2] <= s:
            first += 1
        k = first
        while k < len(spans[1]) and spans[1][k][1] < e:
            links.append((i, spans[1][k][0]))
            k += 1
    return groups, links


def brute(encoders, texts):
    found = [plain(encoders, t) for t in texts]
    docs = Counter(pair for _, links in found for pair in set(links))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for groups, links in found:
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out


def odd_texts():
    rng = random.Random(3)
    letters = ["word", "Straße", "naïve", "東京都", "😀", "  ", "\n", " \t", "a b", "12345", "don't", "<s>", "</s>", "<|endoftext|>", "<0x41>", "...",
               "é", "　", "x" * 70, "\x1c", "\x85"]
    made = [" ".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    made += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(20)]
    return [None, "", " ", "   ", "\n", " lead", "trail ", "a  b", "▁", "one ▁ two", "\x00 nul", "a", *made, made[0], made[0]]


def collected(df):
    return sorted((r.doc_id, *r[1:]) if r.doc_id is not None else (-1, *r[1:]) for r in df.collect())


@pytest.mark.parametrize("chunk, broadcast_pairs", [(own.CHUNK, own.BROADCAST_PAIRS), (200, own.BROADCAST_PAIRS), (64, 0)])
def test_alignment_agrees_with_plain_encoding(spark, both, encoders, chunk, broadcast_pairs):
    texts = odd_texts()
    rows = [(None if i == 13 else i, t, "extra", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, row long").repartition(5)
    want = sorted((-1 if i == 13 else i, *row) for i, row in enumerate(brute(encoders, texts)))
    assert collected(own.align(docs, both, chunk=chunk, broadcast_pairs=broadcast_pairs)) == want


def test_alignment_of_given_documents(spark, both, encoders):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *row) for r, row in zip(rows, brute(encoders, [r.text for r in rows])))
    assert collected(own.align(docs, both, chunk=3000)) == want


def test_tree_of_many_ranges_and_text_without_borders(spark, both, encoders):
    rng = random.Random(5)
    long = " ".join("".join(rng.choice("abcdefghäß") for _ in range(rng.randrange(1, 9))) for _ in range(8000))
    texts = [long, "y" * 9000, "z" * 500 + " " + "é" * 3000 + " q", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(own.ranges(long, 100)) > own.ARITY**2
    assert collected(own.align(docs, both, chunk=100)) == sorted((i, *row) for i, row in enumerate(brute(encoders, texts)))


def test_compose_is_associative(both):
    """Fragments of one text cut anywhere give the same whole in any order."""
    words, align, rng = own.Words(both), own.Aligner(both), random.Random(9)
    text = "don't stop naïve Straßen 東京都 unbelievably 12345.67 internationalization xyzzy"
    place, _ = words.places([text])
    a, b = words.take("a", place), words.take("b", place)
    ends_a, ends_b = np.cumsum(align.length_a[a]), np.cumsum(align.length_b[b])
    whole = align.finish(align.open(0, 0, a, b))
    for _ in range(60):
        cuts = sorted(rng.sample(range(1, int(ends_a[-1])), 5))
        parts = []
        for x, y in pairwise([0, *cuts, int(ends_a[-1])]):
            in_a, in_b = (ends_a > x) & (ends_a <= y), (ends_b > x) & (ends_b <= y)
            starts = [int((e - n)[k][0]) if k.any() else x for e, n, k in ((ends_a, align.length_a[a], in_a), (ends_b, align.length_b[b], in_b))]
            parts.append(align.open(*starts, a[in_a], b[in_b]))
        left = reduce(align.compose, parts)
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i:i + 2] = [align.compose(parts[i], parts[i + 1])]
        for got in (left, parts[0]):
            got = align.finish(got)
            assert (got.text, got.n_a, got.n_b, got.n_groups) == (whole.text, whole.n_a, whole.n_b, whole.n_groups)
            assert got.codes.tolist() == whole.codes.tolist() and got.times.tolist() == whole.times.tolist()


def test_empty_table(spark, both):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert own.align(docs, both).collect() == []
