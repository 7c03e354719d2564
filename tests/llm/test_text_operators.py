"""SentencePiece, line dedup, n-gram join, decontamination and the pipeline against brute force."""

import random
import re
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dropweave.llm import edit_decontamination as decon
from dropweave.llm import jaccard_join, line_edit_join, sentencepiece_codec
from dropweave.llm._components import components
from dropweave.llm.catalogue import queries
from dropweave.llm.queries import vocabulary
from dropweave.session import staging_root

SF_DIR = "/root/testdata/sf0.001"
draw = random.Random(12)


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x):
        new = [i + 1]
        for j, b in enumerate(y):
            new.append(min(row[j] + (a != b), new[j] + 1, row[j + 1] + 1))
        row = new
    return row[-1]


def edited(text, edits, alphabet="xé"):
    out = list(text)
    for _ in range(edits):
        at, kind = draw.randrange(len(out) + 1), draw.random()
        if kind < 0.4 and out:
            out[min(at, len(out) - 1)] = draw.choice(alphabet)
        elif kind < 0.7:
            out.insert(at, draw.choice(alphabet))
        elif out:
            del out[min(at, len(out) - 1)]
    return "".join(out)


# --- SentencePiece

@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.Pieces.load(vocabulary())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary())


def test_ids_and_texts_equal_the_library(spark, pieces, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").withColumn("ids", F.lit("clash"))
    got = sentencepiece_codec.decode(sentencepiece_codec.round_trip(docs, pieces), pieces).collect()
    assert len(got) == 200
    for r in got:
        assert r.ids == library.encode(r.text) and r.decoded == r.text and r.round_trip and r.n_tokens == len(r.ids)


def test_odd_texts(spark, pieces, library):
    texts = ["", " ", "   ", "a", " a", "a  b   c\n\n\td", "▁", "a▁b", "<0x41></s><s>", "日本語 😀", "\x00", "ß" * 5000, "ab" * 30_000,
             " " * 3000, None, "a", "a"]
    texts += ["".join(draw.choice("ab the▁ \n日é😀<>0x41") for _ in range(draw.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert sorted(r.doc_id for r in sentencepiece_codec.encode(df, pieces).collect()) == list(range(len(texts)))
    for r in sentencepiece_codec.decode(sentencepiece_codec.round_trip(df, pieces), pieces).collect():
        t = texts[r.doc_id]
        if t is None:
            assert r.ids is None and r.decoded is None and r.n_tokens is None and r.round_trip is None
        else:
            assert r.ids == library.encode(t), repr(t)
            assert r.decoded == library.decode(r.ids) == t.replace("▁", " ") and r.round_trip
    assert sentencepiece_codec.round_trip(df.limit(0), pieces).count() == 0


def test_decoding_skips_what_is_no_id(spark, pieces, library):
    df = spark.createDataFrame([(1, [28705, 264, None, 99_999, -5, 264]), (2, []), (3, None), (4, [3 + 0xC3])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in sentencepiece_codec.decode(df, pieces).collect()}
    assert got == {1: " a a", 2: "", 3: None, 4: "�"}


def test_pair_test_equals_merging(pieces):
    names = [n for n in pieces.ids]
    inner = [n for n in names if not n.startswith(" ")]
    for _ in range(20_000):
        a, b = draw.choice(names), draw.choice(inner)
        if draw.random() < 0.5:
            whole = draw.choice(names)
            cut = draw.randrange(len(whole))
            a, b = whole[:cut], whole[cut:]
            if a not in pieces.ids or b not in pieces.ids:
                continue
        assert sentencepiece_codec.fit(a, b, pieces) == (sentencepiece_codec.merged(a + b, pieces)[-1] == [a, b])


def test_unigram_scores_take_the_best_sum(pieces):
    class Small:
        is_bpe, bytes, unknown, codec, fits = False, None, 0, None, {}
        ids = {" ": 1, "a": 2, "b": 3, "ab": 4, " a": 5, "bab": 6}
        scores = [0.0, -2.0, -3.0, -3.0, -4.0, -4.5, -6.0]
        tails = {"bab": (3, 2, 1)}

    def best(word):
        paths = {0: (0.0, [])}
        for end in range(1, len(word) + 1):
            options = []
            for size in range(1, end + 1):
                i = Small.ids.get(word[end - size:end])
                if i is not None or size == 1:
                    s, p = paths[end - size]
                    options.append((s + (Small.scores[i] if i else -16.0), p + [i or 0]))
            paths[end] = max(options)
        return paths[len(word)][1]

    encoder = sentencepiece_codec.Encoder(Small)
    for word in sorted({" " + "".join(draw.choice("ab") for _ in range(draw.randrange(9))) for _ in range(100)}):
        got = encoder.encode(word)
        assert sum(Small.scores[i] for i in got) == pytest.approx(sum(Small.scores[i] for i in best(word)))


# --- line dedup

def cleaned(rows, edits, min_chars):
    first, near = {}, set()
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip():
                first.setdefault(line, (d, i))
    known = list(first)
    for i, a in enumerate(known):
        for b in known[:i]:
            k = max(2, min(len(a), len(b)) // 20) if edits is None else edits
            if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= k and line_edit_join.bounded_distance(a, b, k) <= k:
                near.add(a)
    return {d: t if t is None else "\n".join(line for i, line in enumerate(t.split("\n")) if not line.strip()
                                           or first[line] == (d, i) and line not in near) for d, t in rows}


@pytest.mark.parametrize("edits, min_chars", [(2, 10), (1, 20), (3, 12)])
def test_line_dedup_equals_brute_force(spark, edits, min_chars):
    base = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(8, 40))) for _ in range(30)]
    rows = [(d, "\n".join([edited(draw.choice(base), draw.choice([0, 0, 1, 2, 3])) for _ in range(draw.randrange(5))]
                          + ["  "] * draw.randrange(2))) for d in range(120)] + [(120, None), (121, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: r for r in line_edit_join.dedup(df, edits=edits, min_chars=min_chars).collect()}
    assert {d: r.text for d, r in got.items()} == cleaned(rows, edits, min_chars)
    assert (got[120].n_lines, got[120].n_dropped) == (0, 0)


def test_line_dedup_budget_follows_the_length(spark):
    rows = []
    for size in (39, 40, 55, 60, 79, 100, 130, 200, 377, 700, 1300):
        base = "".join(draw.choice("abcdefgh ") for _ in range(size))
        k = max(2, size // 20)
        rows += [base, edited(base, k), base[7:] + base[:7], edited(base, k - 1), edited(base, k + 2), edited(base, 2 * k), "ab" * (size // 2) + str(size)]
    rows += [r[:-1] + "cd" for r in rows if r.startswith("ababab")]
    draw.shuffle(rows)
    want = set()
    for i, line in enumerate(rows):
        for before in rows[:i]:
            short = min(len(line), len(before))
            if line == before or short >= 40 and abs(len(line) - len(before)) <= max(2, short // 20) and distance(line, before) <= max(2, short // 20):
                want.add(i)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    plan = line_edit_join.dedup(df, edits=None)
    assert {r.doc_id for r in plan.collect() if r.n_dropped} == want
    long_ = "y" * 5000 + "".join(map(str, range(3000)))
    got = line_edit_join.dedup(spark.createDataFrame([(1, long_), (2, long_[:-500]), (3, long_[:-9000])], "doc_id long, text string"), edits=None)
    assert {r.doc_id for r in got.collect() if r.n_dropped} == {2}


def test_line_dedup_of_odd_rows(spark):
    long_ = "y" * 5000 + "".join(map(str, range(3000)))
    rows = [(None, "same line"), (1, "same line\nother"), (1, "same line\nother"), (1, "third\nother"), (2, long_ + "\n" + long_[:-1]), (3, "same line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in line_edit_join.dedup(df).collect()]
    assert len(got) == 6
    # Identical rows are one document; the null id comes last; a text of its own under the same id is another document.
    assert got.count((1, "same line\nother")) == 2 or {t for d, t in got if d == 1} == {"same line", "third\nother"}
    assert (None, "") in got and (3, "") in got and (2, long_) in got
    assert line_edit_join.dedup(df.limit(0)).count() == 0


def test_bounded_distance():
    for _ in range(6000):
        edits = draw.choice([0, 1, 2, 4, 9, 40])
        a = "".join(draw.choice("abé") for _ in range(draw.randrange(60)))
        b = edited(a, draw.randrange(edits + 3))
        assert line_edit_join.bounded_distance(a, b, edits) == min(distance(a, b), edits + 1)
    long_ = "".join(draw.choice("abcdefgh ") for _ in range(60_000))
    assert line_edit_join.bounded_distance("x" + long_, long_[:30_000] + "yz" + long_[30_000:], 3000) == 3


@pytest.mark.parametrize("bytes_, keys, growth", [(0, 250_000, 2), (1 << 28, 50, 8)])
def test_near_lines_in_rounds_without_and_with_filters(spark, monkeypatch, bytes_, keys, growth):
    """A group of near copies behind a line that is near to none of them, in small parts of filters and without any."""
    for name, value in {"FILTER_BYTES": bytes_, "FILTER_KEYS": keys, "GROWTH": growth}.items():
        monkeypatch.setattr(line_edit_join, name, value)
    shared, base = "the very same twenty-odd characters ", "".join(draw.choice("abcdefgh ") for _ in range(90))
    rows = [(0, shared + "".join(draw.choice("xyz") for _ in range(90)))] + [(d, shared + edited(base, draw.randrange(9))) for d in range(1, 60)]
    rows += [(60 + d, shared + "".join(draw.choice("klmn") for _ in range(90))) for d in range(20)]
    pairs, verify = [], line_edit_join.near_later

    def counted(found, *args):
        pairs.append(found.count())
        return verify(found, *args)

    monkeypatch.setattr(line_edit_join, "near_later", counted)
    got = {r.doc_id for r in line_edit_join.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_dropped}
    want = {d for i, (d, a) in enumerate(rows) if any(distance(a, b) <= max(2, min(len(a), len(b)) // 20) for _, b in rows[:i])}
    assert got == want and len(want) > 30
    assert sum(pairs) < 80 * 79 / 2


def test_substring_hashes_do_not_hang_on_the_place():
    hashes = line_edit_join.Hashes(["abcabc", "xabc", "é" * 5])
    at = np.array([0, 3, 7, 1])
    assert len(set(hashes.of(at[:3], 3).tolist())) == 1 and hashes.of(at[:1], 2)[0] != hashes.of(at[:1], 3)[0]
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    parts = [(i, line_edit_join.Filter.part(keys[keys % np.uint64(3) == i])) for i in range(3)]
    held = line_edit_join.Filter(parts, 3)
    assert held.holds(keys).all() and held.holds(keys + np.uint64(12345)).mean() < 0.02


# --- n-gram join

def sets_of(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def linked(rows, percent=80):
    found, parent = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(found):
        for j in range(i):
            both = len(a & found[j])
            if both and 100 * both >= percent * len(a | found[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {(d, len(found[i]), low[root(i)]) for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("most, tile", [(64, 256), (1, 8)])
def test_join_equals_brute_force(spark, monkeypatch, most, tile):
    monkeypatch.setattr(jaccard_join, "LIST", most)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    words = [f"W{i}" for i in range(60)]
    base = [[draw.choice(words) for _ in range(draw.randrange(3, 60))] for _ in range(25)]
    rows = []
    for d in range(300):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
            text[draw.randrange(len(text))] = draw.choice(words)
        if draw.random() < 0.3:
            text += draw.choice(base)[:8]
        rows.append((d, draw.choice([" ", "\n", "  "]).join(text)))
    rows += [(300, ""), (301, None), (302, " \t"), (303, "one two"), (304, "ONE two"), (305, "É two"), (306, "é two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(df).collect()}
    assert got == linked(rows)


def test_near_copies_that_miss_the_pivot_give_few_pairs(spark, monkeypatch):
    """Copies with one or two changed words: some link, most do not link with the pivot; tiles return far fewer pairs than there are."""
    monkeypatch.setattr(jaccard_join, "LIST", 4)
    monkeypatch.setattr(jaccard_join, "TILE", 48)
    base, rows, returned = [f"w{i}" for i in range(100)], [], []
    for d in range(240):
        text = list(base)
        for _ in range(1 if d % 3 else 3):
            text[draw.randrange(10, 100)] = f"x{draw.randrange(10**6)}"
        rows.append((d, " ".join(text)))
    candidates = jaccard_join.Tiles.candidates

    def counted(self, *args):
        found = candidates(self, *args)
        returned.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join.Tiles, "candidates", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(df).collect()} == linked(rows)
    assert returned[0] <= 2 * jaccard_join.MOST * 240 and sum(returned) < 240 * 239 / 4


def test_chains_need_every_link_across_components(spark):
    # Neighbours in the chain link, others do not; every text shares its rare shingles with many.
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - i, " ".join(words[3 * i:3 * i + 60])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(df).collect()}
    assert got == linked(rows)
    assert len({c for *_, c in got}) == 1


def test_join_of_odd_rows(spark):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "q r s t u v"), (3, "q r s t u v"), (4, "x " * 100_000), (5, "x " * 99_999)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.linked(df).collect()), key=str)
    assert got == [(2, 2), (2, 2), (3, 2), (4, 4), (5, 4), (None, None)]
    assert sorted(str(r.doc_id) for r in jaccard_join.representatives(df).collect()) == ["2", "2", "4", "None"]
    assert jaccard_join.linked(df.limit(0)).count() == 0


def test_representatives_of_clashing_ids(spark):
    rows = [(1, "a b c d e f", "p"), (2, "a b c d e f", "p"), (2, "q r s t u v", "p"), (2, " ", "p"), (2, None, "p"), (7, "k l m n o", "p"), (7, "k l m n o", "q"),
            (7, "K l m n o", "p"), (8, "k l m n o", "p"), (9, "", "p"), (9, "", "p"), (None, "q r s t u v", "p"), (None, "q r s t u v", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, (r.text or "-").lower()) for r in jaccard_join.representatives(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f"), (2, "q r s t u v"), (2, " "), (2, "-"), (7, "k l m n o"), (9, "-"), (9, "-"),
                          (None, "q r s t u v"), (None, "q r s t u v")], key=str)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


# --- decontamination

def nearest(item, text):
    """Distance of an item to any substring of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), new[j] + 1, row[j + 1] + 1))
        row = new
    return min(row)


def test_matches_equal_brute_force(spark):
    items = [(i, "".join(draw.choice("abcd ") for _ in range(draw.randrange(20, 70))).strip() or "a") for i in range(15)]
    items += [(15, None), (16, "  "), (17, "tiny"), (18, items[0][1])]
    docs = []
    for d in range(120):
        noise = ["".join(draw.choice("abcd ") for _ in range(40)) for _ in range(2)]
        text = draw.choice(items[:15])[1]
        docs.append((d, noise[0] + edited(text, draw.randrange(6)).upper() + noise[1]))
    docs += [(120, None), (121, ""), (122, "TINY"), (122, "TINY")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in docs:
        for i, item in items:
            a, b = decon.normal(item), decon.normal(t)
            if a and nearest(a, b) <= len(a) // 12:
                want.add((d, i, nearest(a, b)))
    for most in (100, 3):
        got = decon.matches(df, frame, chars_per_edit=12, most=most).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == want
        by_id, item = {d: t for d, t in docs}, dict(items)
        for r in got:
            assert distance(decon.normal(item[r.item_id]), decon.normal(by_id[r.doc_id])[r.start:r.end]) == r.distance
    kept = {r.doc_id for r in decon.clean(df, frame, chars_per_edit=12).collect()}
    assert kept == {d for d, _ in docs} - {d for d, *_ in want}
    assert decon.matches(df, frame.limit(0)).count() == 0 and decon.matches(df.limit(0), frame).count() == 0


@pytest.mark.parametrize("most", [100, 1])
def test_decontamination_of_clashing_and_null_ids(spark, most):
    items = [(None, "an item without an id"), (1, "an item with its own id")]
    rows = [(1, "has An item without an id."), (1, "clean"), (None, "has an item with its own id"), (None, "clean too"), (None, None), (2, None), (2, "clean")]
    df, frame = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decon.matches(df, frame, most=most).collect()} == {(1, None), (None, 1)}
    got = [(r.doc_id, r.text) for r in decon.clean(df, frame, most=most).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if "item" not in (r[1] or "")], key=str)


def test_many_hits_of_a_common_piece(spark):
    item = "lorem ipsum dolor sit amet " * 8
    docs = spark.createDataFrame([(1, "lorem ipsum dolor " * 20_000), (2, "x" * 300_000 + item)], "doc_id long, text string")
    got = decon.matches(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.distance) for r in got] == [(2, 0)]


# --- pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = function(spark, docs, SF_DIR).cache()
        after = {r.doc_id: r.text for r in docs.collect()}
        seen[name] = (before, after)
        assert set(after) <= set(before)
        if number < 4:
            assert docs.columns == columns
    before, after = seen["line_dedup"]
    want = cleaned(sorted(before.items()), None, 40)
    assert after == {d: t for d, t in want.items() if t == before[d] or t.strip()}
    before, after = seen["near_duplicates"]
    assert set(after) == {d for d, _, c in linked(sorted(before.items())) if c == d}
    before, after = seen["decontamination"]
    items = [decon.normal(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not any(i in decon.normal(t) for t in after.values() for i in items)
    assert all(any(decon.pieces(i, decon.budget(i) + 1)[k][1] in decon.normal(before[d]) for i in items for k in range(decon.budget(i) + 1))
               for d in set(before) - set(after))
    assert all(r.round_trip for r in docs.collect())


def test_every_operator_has_a_query():
    names = list(queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names


# --- line dedup: what its join moves

def test_line_dedup_leaves_nothing_of_its_join(spark):
    own = random.Random(3)
    base = ["".join(own.choice("abcdefgh ") for _ in range(120)) for _ in range(20)]
    rows = [(d, base[d % 20][:50] + str(d // 20) + base[d % 20][50:]) for d in range(60)] + [(60, "x" + "-" * 900 + "0"), (61, "x" + "-" * 900 + "1")]
    before = {p.name for p in Path(staging_root(spark)).glob("*")}
    got = {r.doc_id for r in line_edit_join.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_dropped}
    assert got == {*range(20, 60), 61}
    left = {p.name.rpartition("-")[0] for p in Path(staging_root(spark)).glob("*") if p.name not in before}
    assert "marked-firsts" in left and not left & {"probes", "index-entries", "first-lines", "paired-lines", "paired-texts"}


@pytest.mark.parametrize("edits", [None, 3])
def test_a_near_line_finds_a_piece(edits):
    """Also across the borders of bands and zones, from both a shorter and an equally long line."""
    everything, own = line_edit_join.Filter(None), random.Random(4)
    for _ in range(400):
        a = "".join(own.choice("abcdefghijklmnop ") for _ in range(own.choice([40, 55, 56, 71, 88, 124, 176, 250, 296, 420, 1000])))
        b = edited(a, line_edit_join.budget(len(a), edits))
        a, b = (a, b) if len(a) <= len(b) else (b, a)
        if line_edit_join.bounded_distance(a, b, line_edit_join.budget(len(a), edits)) > line_edit_join.budget(len(a), edits):
            continue
        bands = line_edit_join.bands_of(30, len(b), edits)
        held = {int(k): int(p) for _, p, k in zip(*line_edit_join.pieces(line_edit_join.Hashes([a]), bands, edits))}
        _, place, key = line_edit_join.substrings([b], bands, edits, everything)
        assert any(abs(held.get(int(k), 10**6) - p) <= line_edit_join.budget(len(a), edits) for p, k in zip(place.tolist(), key.tolist()))


def staged_by(module, monkeypatch):
    """Names and rows of the tables that a module stages."""
    seen, write = [], module.stage

    def counted(df, name="stage", *args):
        out = write(df, name, *args)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(module, "stage", counted)
    return seen


def near_copies(own):
    base = ["".join(own.choice("abcdefgh ") for _ in range(own.choice([45, 90, 150, 160, 300]))) for _ in range(12)]
    texts = [edited(base[d % 12], own.randrange(8)) for d in range(90)]
    return [(d, t, any(distance(t, b) <= max(2, min(len(t), len(b)) // 20) for b in texts[:d])) for d, t in enumerate(texts)]


@pytest.mark.parametrize("keys", [200, 30])
def test_more_pieces_than_a_filter_holds_go_in_cuts(spark, monkeypatch, keys):
    """The filter stays in use: probes are few, where all substrings were probes before.  30 keys also cut bands by remainders."""
    monkeypatch.setattr(line_edit_join, "FILTER_BYTES", keys * line_edit_join.FILTER_BITS // 8)
    seen, rows = staged_by(line_edit_join, monkeypatch), near_copies(random.Random(5))
    if keys == 30:
        rows = [r for r in rows if r[0] % 12 in (0, 1)]
        rows = [(d, t, any(distance(t, b) <= max(2, min(len(t), len(b)) // 20) for _, b, _ in rows[:i])) for i, (d, t, _) in enumerate(rows)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert {r.doc_id for r in line_edit_join.dedup(df).collect() if r.n_dropped} == {d for d, _, near in rows if near}
    probed = [n for name, n in seen if name == "probes"]
    assert len(probed) > 2 and sum(probed) < sum(len(t) for _, t, _ in rows) / 3


def test_cuts_cover_every_piece_once():
    own = random.Random(6)
    lines_ = ["".join(own.choice("abcd ") for _ in range(own.randrange(40, 400))) for _ in range(200)]
    hashes, bands = line_edit_join.Hashes(lines_), line_edit_join.bands_of(40, 400, None)
    every = line_edit_join.Filter(None)
    some = [line_edit_join.Cut(0, 2, 1), line_edit_join.Cut(3, 3, 1, 0, 2), line_edit_join.Cut(3, 3, 1, 1, 2), line_edit_join.Cut(4, len(bands.first) - 2, 1)]
    for whole, cut in ((line_edit_join.pieces(hashes, bands, None), [line_edit_join.pieces(hashes, bands, None, c) for c in some]),
                       (line_edit_join.substrings(lines_, bands, None, every), [line_edit_join.substrings(lines_, bands, None, every, c) for c in some])):
        assert sorted(zip(*(x.tolist() for x in whole))) == sorted(row for c in cut for row in zip(*(x.tolist() for x in c)))
        assert all(len(c[0]) for c in cut)


def test_few_texts_are_moved_at_a_time(spark, monkeypatch):
    """Pairs are verified in parts of so many characters, members of frequent keys in parts of so many rows, and short rounds end the same."""
    for name, value in {"VERIFIED_CHARS": 20_000, "GROUP": 4, "MEMBERS_AT_ONCE": 0, "ROUND_PAIRS": 0}.items():
        monkeypatch.setattr(line_edit_join, name, value)
    seen, rows = staged_by(line_edit_join, monkeypatch), near_copies(random.Random(7))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert {r.doc_id for r in line_edit_join.dedup(df).collect() if r.n_dropped} == {d for d, _, near in rows if near}
    assert max(n for name, n in seen if name == "verified-pairs") < max(len(rows), 3 * 20_000 / 90)
    assert sum(n for name, n in seen if name == "verified-pairs") <= sum(n for name, n in seen if name == "candidates")


def test_bags_are_a_lower_bound():
    own = random.Random(8)
    one = ["".join(own.choice("abcdefgh é") for _ in range(own.choice([1, 40, 300, 2000]))) for _ in range(200)]
    two = [edited(a, own.randrange(30)) for a in one]
    least = line_edit_join.bag_distances(line_edit_join.bags(one), line_edit_join.bags(two), np.array([len(a) - len(b) for a, b in zip(one, two)]))
    assert all(n <= line_edit_join.bounded_distance(a, b, 60) for n, a, b in zip(least.tolist(), one, two))
    far = line_edit_join.bag_distances(line_edit_join.bags(["a" * 300]), line_edit_join.bags(["b" * 300]), np.array([0]))
    assert far[0] > 40
