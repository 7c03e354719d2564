"""One-bit neighbours, hash tree, URL trees and WARC."""

import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dropweave.llm import hash_tree, one_bit_ann, url_trees, warc
from dropweave.llm.hash_tree import Tree


# --- neighbours

def brute_force(vectors, queries, k):
    out = {}
    for q in queries:
        found = sorted(((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q))[:k]
        out[q] = [i for _, i in found]
    return out


def test_neighbours_recall_and_ties(spark):
    draw = np.random.default_rng(1)
    vectors = {i: draw.standard_normal(48).tolist() for i in range(3000)}
    for i in range(100, 180):
        vectors[i] = vectors[99]  # a group of equal vectors larger than k
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, vector array<double>")
    queries = [i for i in vectors if i % 50 == 0]
    got = one_bit_ann.search(df, df.filter("vec_id % 50 = 0"), 20, rows=700, query_rows=32).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    want = brute_force(vectors, queries, 20)
    hits = sum(len(set(found[q]) & set(want[q])) for q in queries)
    assert hits >= 0.99 * 20 * len(queries)
    assert found[150] == want[150]  # ties go to the smaller id


def test_bounds_hold_and_choose(spark):
    draw = np.random.default_rng(2)
    x, q = draw.standard_normal((2000, 32)), draw.standard_normal((20, 32))
    coder = one_bit_ann.Coder(x.mean(0))
    estimate, upper = coder.bounds(q, *coder.encode(x), one_bit_ann.ERROR_WIDTH)
    true = q @ x.T
    assert (upper >= true).mean() > 0.999
    assert abs((estimate - true).mean()) < 0.05
    assert (upper < np.quantile(true, 0.99)).mean() > 0.3  # most vectors need no second look


def test_unusable_vectors_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, 2.0, 3.0]),
            (7, [2.0, 1.0]), (7, [2.0, 1.0]), (None, [1.0, 1.0]), (8, [float("inf"), 1.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit("clash"))
    ready = one_bit_ann.prepare(df, "vec_id", "embedding")
    assert sorted(r.vec_id for r in ready.collect()) == [1, 6, 7, 7]
    got = one_bit_ann.search(ready, ready, 20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (1, 1, 7, 2.0), (1, 2, 7, 2.0), (7, 1, 1, 2.0), (7, 2, 1, 2.0)]
    empty = one_bit_ann.prepare(df.limit(0), "vec_id", "embedding")
    assert one_bit_ann.search(empty, empty, 5).count() == 0


def test_lengths_apart_and_rows_that_share_an_id(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), draw.integers(-3, 4, 3 if i % 3 else 5).astype(float).tolist()) for i in draw.integers(0, 60, 400)]
    rows = [r for r in rows if any(r[1])]
    df = one_bit_ann.prepare(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in one_bit_ann.search(df, df.filter("vec_id % 20 = 0"), 7, rows=50, query_rows=9).collect())
    want = []
    for query in sorted({i for i, _ in rows if i % 20 == 0}):
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for j, q in rows if j == query for i, v in rows if i != query and len(v) == len(q)]
        want += [(query, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:7], 1)]
    assert got == want


# --- hash tree

def test_an_id_with_a_third_of_the_rows_is_cut(spark):
    from dropweave.operators import ordering
    rows = [(7 if i % 3 else i, f"text {i % 5}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = hash_tree.shard(df, Tree.regular(2, 1, 2))
        staged = ordering._sorted_slots(df.withColumn("shard", F.lit(1)).withColumn("_row", F.monotonically_increasing_id()), ["shard", "doc_id", "_row"])
        assert staged.groupBy(F.shiftright("_slot", 33)).count().agg(F.max("count")).first()[0] < 2000  # the id has 4,000 rows
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_shard = {}
    for r in got.collect():
        per_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in per_shard.values()) and sum(map(len, per_shard.values())) == 6000


def test_growth_moves_rows_only_into_the_new_shard(spark):
    rows = [(i if i % 97 else None, None if i % 31 == 0 else f"text {i % 7}" * (i % 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    got = hash_tree.shard(df, Tree.regular(5, 2, 4)).collect()
    assert len(got) == 4000
    assert all(r.grown_shard in (r.shard, 40) for r in got)
    assert 40 < sum(r.grown_shard == 40 for r in got) < 200
    slots, by_id = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        by_id.setdefault(r.doc_id, set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_id.values())
    assert sorted(slots) == list(range(40))
    text = {i: t for i, t in rows}
    for r in got:
        if r.doc_id is not None:
            t = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(t) + 16, zlib.crc32(t))


def test_slots_do_not_depend_on_ranges(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    def slots(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        return {(r.doc_id, r.slot) for r in hash_tree.shard(df.repartition(parts), Tree.regular(2, 2, 2)).collect()}

    try:
        a, b = slots(3), slots(8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b
    assert hash_tree.shard(df.limit(0), Tree.regular(2, 2, 2)).count() == 0


def test_weight_changes_stay_in_their_subtree(spark):
    before = Tree.regular(3, 2, 2)
    racks = [list(r) for r in before.regions]
    racks[0][0] = ((0, 3.0), (1, 1.0))
    after = Tree(tuple(tuple(r) for r in racks))
    ids = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    moved = ids.select(hash_tree.place(F.col("k"), before).alias("a"), hash_tree.place(F.col("k"), after).alias("b")).filter("a <> b").collect()
    assert moved
    assert all(r.b in (0, 1) or r.a // 4 == 0 or r.b // 4 == 0 for r in moved)
    assert not any(r.a // 4 != r.b // 4 and r.b // 4 != 0 for r in moved)  # only the heavier region takes rows of other regions


# --- urls

RULES = [url_trees.Rule.of(v, t) for v, t in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    end = min([i for i in (tail.find(c) for c in "?#") if i >= 0] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "x", "http://", "http://A.NET", "http://a.net/", "HTTPS://Example.NET/en/1?x=/de/", "http://example.com/de/#a",
            "http://notexample.com/de/", "ftp://É.Org/fr/x", "http://a.org?/fr/", "http://a://b/c", "http://x.net\n/y", "a b://c.net/d e",
            "http://a.com?u=http://b.net/x", "http://a.com#x://y.net/en/z", "http://a.net?u=http://b.org/x", "://a.net/://b.org/fr/x",
            "http://a.net\n?/x", "http://a.net/\r\n?x", "http://" + "a" * 50_000 + ".net/" + "é" * 50_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("score", F.lit("clash"))
    got = {r.page_id: r for r in url_trees.judge(df, RULES).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = parts(url)
        want = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, want.text if want else None), url
        assert got[i].verdict == want.verdict if want else got[i].verdict in ("allow", "block")


def test_features(spark):
    row = url_trees.features(spark.createDataFrame([("http://a-b.c.net/x/y1?p=1&q=2#z",), ("aabb",)], "url string")).collect()
    assert (row[0].depth, row[0].labels, row[0].parameters, row[0].hyphens) == (2, 3, 3, 1)
    assert row[1].entropy == pytest.approx(1.0)
    assert row[0].digit_share == pytest.approx(3 / 31)


def test_trees_learn_what_no_rule_says(spark):
    draw = random.Random(4)
    bad = [f"http://{draw.randint(10**6, 10**7)}.casino-{draw.randint(1, 99)}.net/x" for _ in range(150)]
    good = [f"http://news{draw.randint(1, 9)}.example.net/en/{draw.choice('abc')}" for _ in range(150)]
    unknown = ["http://7654321.casino-5.xyz/x", "http://news3.example.xyz/en/a"]
    df = spark.createDataFrame(list(enumerate(bad + good + unknown)), "page_id int, url string")
    got = {r.url: r.verdict for r in url_trees.judge(df, RULES).collect()}
    assert [got[u] for u in unknown] == ["block", "allow"]


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://x.xyz/")], "page_id int, url string")
    assert [r.verdict for r in url_trees.judge(df, RULES).collect()] == ["allow"]
    assert url_trees.judge(df.limit(0), RULES).count() == 0


def test_url_plan_is_native(spark):
    df = spark.createDataFrame([(i, f"http://x{i}.net/{i}") for i in range(50)], "page_id int, url string")
    plan = url_trees.judge(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- warc

def test_round_trip_and_revisits(spark, tmp_path):
    big = "x" * 1200
    pages = [(1, "http://a/", big), (2, "http://b/ c\r\n%41é", big), (3, None, big), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
             (7, "u", ""), (8, "u", "é" * 400_000), (9, "u", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    files = warc.write(df, str(tmp_path / "w"))
    whole = {r.page_id: r for r in warc.read(spark, files).collect()}
    small = {r.page_id: r for r in warc.read(spark, files, split_bytes=100).collect()}
    assert sorted(whole) == sorted(small) == list(range(1, 10))
    for i, url, html in pages:
        for r in (whole[i], small[i]):
            assert r.url == url
            if i in (1, 2):
                assert (r.record_type, r.refers_to, r.payload, r.payload_bytes) == ("revisit", 3, None, 1200)
            else:
                assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, (html or "").encode())
    assert warc.archive(spark, df.limit(0), str(tmp_path / "none")).count() == 0
    path = next((tmp_path / "w").rglob("*.warc.gz"))
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 255
    path.write_bytes(bytes(data))
    with pytest.raises(ValueError, match="can be read"):
        warc.complete(files, warc.read(spark, files))


def test_any_split_owns_each_record_once_despite_false_magic():
    draw = random.Random(3)
    noise = bytes(draw.randrange(256) for _ in range(3000))
    fake = zlib.compressobj(6, zlib.DEFLATED, 31)
    fake = fake.compress(b"not a record" * 20) + fake.flush()
    packed = []
    for i in range(30):
        payload = noise[:draw.randrange(3000)] + warc.MAGIC + fake * (i % 3) + warc.MAGIC + b"\x00" * 7
        member = warc.record(i, "u", payload, "00" * 20, None)
        if i % 4 == 0:  # stored without compression, so the payload's bytes lie open in the file
            text = zlib.decompress(member, 31)
            store = zlib.compressobj(0, zlib.DEFLATED, 31)
            member = store.compress(text) + store.flush()
        packed.append(member)
    data = b"".join(packed)
    starts = [sum(map(len, packed[:i])) for i in range(30)]
    assert data.count(warc.MAGIC) > 45
    for size in (17, 100, 999, 5000, len(data)):
        found = [at for s in range(0, len(data), size) for at, _ in warc.members(io.BytesIO(data), s, s + size)]
        assert found == starts
