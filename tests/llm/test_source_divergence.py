"""The divergence audit against dense counts in plain Python."""

import random
import re
from collections import Counter

import pytest

from dropweave.llm import source_divergence as own

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, rank string"


def plain(docs, min_docs, top):
    counts, held = {}, {}
    for text, lang, source in docs:
        lang, source, found = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        counts.setdefault((lang, source), Counter()).update(found)
        held.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang, in_docs in held.items():
        kept = [t for t, n in in_docs.items() if n >= min_docs]
        groups = {s: c for (la, s), c in counts.items() if la == lang}
        groups_and_all = {**groups, None: sum(groups.values(), Counter())}
        p = {}
        for s, c in groups_and_all.items():
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in groups:
            pairs = [("pair", o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            best = [("term", t, p[s][t] - p[None][t]) for t in kept if groups[s][t] > 0 and p[s][t] > p[None][t]]
            for part, limit in ((pairs, None), (best, top)):
                ranked = sorted(part, key=lambda r: (-r[2], r[1].encode()))[:limit]
                out += [(lang, s, *r, i) for i, r in enumerate(ranked, 1)]
    return sorted(out)


def documents(sources=7):
    rng = random.Random(4)
    words = ["The", "the", "THE", "naïve", "ÀB", "àb", "x1y2", "don't", "東京", "a_b", "\x7f", "[z]", "{q}", "@", "é", "it", "hot", "rare%d"]
    out = [(None, "en", "s0"), ("", "en", "s1"), ("...", "en", "none"), ("alone", "xx", None), (None, None, None), ("word", "", "")]
    for i in range(220):
        text = " ".join(rng.choice(words).replace("%d", str(i)) for _ in range(rng.randrange(0, 40)))
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(sources)}"
        out.append((text, rng.choice(["en", "en", "fr", None]), source))
    out += [("hot " * 3000, "en", "hot")] * 3
    return out


@pytest.mark.parametrize("min_docs, top, small", [(5, 50, False), (3, 2, True), (1, 50, True), (1000, 50, False)])
def test_audit_agrees_with_dense_counts(spark, monkeypatch, min_docs, top, small):
    if small:  # many tiles, dense tables and flushes
        for name, value in {"SOURCES": 3, "ENTRIES": 40, "COLUMNS": 4, "HELD_TERMS": 10}.items():
            monkeypatch.setattr(own, name, value)
    docs = documents()
    df = spark.createDataFrame([(i, *d, "extra", "extra") for i, d in enumerate(docs)], SCHEMA).repartition(5)
    got = [(r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in own.audit(df, min_docs=min_docs, top=top).collect()]
    assert sorted(got) == plain(docs, min_docs, top)


def test_terms_of_bytes_are_those_of_the_pattern():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(0x80, 0x800), 0x85, 0xA0, 0x3000, 0x1F600])) for _ in range(40))
        assert [t.decode() for t in own.terms(text.encode())] == TERM.findall(text.translate(LOWER))


def test_shares_beyond_64_bits_are_exact(spark):
    rows = [(3, 10**13, 7), (10**13, 10**13 + 2, 10**6), (0, 0, 1), (10**15, 10**15, 3)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "n long, total long, kept long").select(own.share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "n", "total", "kept")
    assert all(r.p == 1 + 1_000_000_000 * (r.n + 5) // (r.total + 5 * r.kept) for r in df.collect())


def test_empty_table(spark):
    assert own.audit(spark.createDataFrame([], SCHEMA)).collect() == []
