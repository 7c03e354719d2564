import pytest
from conftest import ordered, row
from pyspark.sql import functions as F

from dropweave import sinks
from dropweave.operators import grouping, keyjoin, ordering
from dropweave.plans import jobs


def group(lines, **more):
    return ordered(grouping.group_by_key(lines, "21", ("24", "28"), **more))


def test_parent_without_child_does_not_lose_later_matches(drop):
    lines = drop([row(21, k) for k in (1, 2, 3)] + [row(24, k, t) for k, t in ((1, "a"), (3, "b"), (3, "c"))])
    assert group(lines) == [("21", 1, ""), ("24", 1, "a"), ("21", 2, ""), ("21", 3, ""), ("24", 3, "b"), ("24", 3, "c")]


def test_orphan_is_left_out_and_reported(drop, small):
    lines = drop([row(21, 1), row(21, 3)] + [row(24, k) for k in (1, 2, 3)])
    assert group(lines) == [("21", 1, ""), ("24", 1, ""), ("21", 3, ""), ("24", 3, "")]
    assert [(r.reason, r.value) for r in grouping.rejects(lines, small, "21", ("24",)).collect()] == [
        ("orphan", row(24, 2))]


def test_duplicate_parents_come_first_and_children_once(drop):
    lines = drop([row(21, 1, "p"), row(21, 1, "q"), row(21, 2), row(24, 1, "c"), row(24, 2, "d")])
    assert group(lines) == [("21", 1, "p"), ("21", 1, "q"), ("24", 1, "c"), ("21", 2, ""), ("24", 2, "d")]


def test_street_without_descriptor(drop):
    lines = drop([row(11, k) for k in (1, 2, 3, 4)] + [row(15, k) for k in (1, 3, 4)])
    got = ordered(grouping.group_by_key(lines, "11", ("15",)))
    assert [(t, k) for t, k, _ in got] == [
        ("11", 1), ("15", 1), ("11", 2), ("11", 3), ("15", 3), ("11", 4), ("15", 4)]


def test_all_descriptors_or_the_first(drop):
    lines = drop([row(11, 1), row(11, 2), row(15, 1, "ENG"), row(15, 1, "CYM"), row(15, 2, "ENG")])
    every = ordered(grouping.group_by_key(lines, "11", ("15",)))
    first = ordered(grouping.group_by_key(lines, "11", ("15",), limit_per_key=1))
    assert [t for *_, t in every] == ["", "ENG", "CYM", "", "ENG"]
    assert [t for *_, t in first] == ["", "ENG", "", "ENG"]


@pytest.mark.parametrize("threshold", ["1000", "1"])
def test_limit_with_and_without_window(spark, drop, threshold):
    lines = drop([row(21, 1), row(21, 2)] + [row(24, 1 + n % 2, f"t{n}") for n in range(9)], [row(24, 1, "z")])
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        assert [t for *_, t in group(lines, limit_per_key=3)] == ["", "t0", "t2", "t4", "", "t1", "t3", "t5"]
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000")


def test_limit_is_applied_before_the_shuffle(drop):
    limited = grouping.envelope(drop([row(21, 1), row(24, 1)]), "21", ("24",), limit_per_key=2)
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hash") < plan.rindex("WindowGroupLimit")


def test_keys_compare_as_numbers(drop):
    lines = drop([row(11, 100010), row(11, 9000), row(15, 100010), row(15, 9000)])
    assert [k for _, k, _ in ordered(grouping.group_by_key(lines, "11", ("15",)))] == [9000, 9000, 100010, 100010]


def test_rows_without_key_go_to_rejects(drop, small):
    lines = drop([row(21, ""), row(21, 2), row(24, ""), row(24, 2), row(24, "12.0"), row(24, "x")])
    assert group(lines) == [("21", 2, ""), ("24", 2, "")]
    rejected = grouping.rejects(lines, small, "21", ("24",)).filter("reason = 'bad_key'").collect()
    assert sorted(r.value for r in rejected) == sorted([row(21, ""), row(24, ""), row(24, "12.0"), row(24, "x")])


def test_bad_cast_short_and_long_rows_are_rejected(drop, small):
    bad = ['21,"I",x,7,t', '21,"I",1,8', '21,"I",1,9,t,more']
    lines = drop([*bad, row(21, 1, "t")])
    rejected = grouping.rejects(lines, small, "21", ("24",)).collect()
    assert sorted((r.reason, r.value) for r in rejected) == sorted(("corrupt", v) for v in bad)


@pytest.mark.parametrize("parents, sizes", [(4, [2, 2]), (5, [2, 2, 1])])
def test_chunks_hold_exactly_n_parents(drop, parents, sizes):
    lines = drop([row(21, k) for k in range(parents)] + [row(24, k) for k in range(parents)])
    chunks = grouping.group_in_chunks(lines, "21", ("24",), 2)
    got = chunks.filter("type_rank = 0").groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in got] == sizes
    assert chunks.groupBy("key").agg(F.count_distinct("chunk").alias("n")).filter("n > 1").isEmpty()


def test_duplicate_parents_stay_in_one_chunk(drop):
    lines = drop([row(21, k) for k in (1, 2, 2, 2, 3)])
    got = grouping.group_in_chunks(lines, "21", ("24",), 2).groupBy("key").agg(F.collect_set("chunk").alias("c"))
    assert {r.key: r.c for r in got.collect()} == {1: [0], 2: [0], 3: [2]}


def test_written_chunks_read_in_group_order(spark, drop, small, tmp_path):
    files = [[row(21, k, f"p{k}") for k in range(f, 40, 3)] + [row(24, k, f"c{k}") for k in range(40 - f, 0, -3)]
             for f in range(3)]
    out = str(tmp_path / "out")
    jobs.group_uprn(drop(*files), out, small, size=10)
    texts = {}
    for chunk in range(4):
        lines = spark.read.text(f"{out}/part_file=part-{chunk:04d}.csv").collect()
        texts[chunk] = [(int(r.value.split(",")[3]), r.value[:2]) for r in lines]
        assert texts[chunk] == sorted(texts[chunk])
        assert {k for k, _ in texts[chunk]} == set(range(chunk * 10, chunk * 10 + 10))
    assert sum(map(len, texts.values())) == 40 + 39


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_nested_groups_cut_large_ones_without_loss(drop, monkeypatch, broadcast_rows):
    monkeypatch.setattr(grouping, "BROADCAST_ROWS", broadcast_rows)
    lines = drop([row(21, 1), row(21, 2)] + [row(24, 1, f"t{n}") for n in range(25)] + [row(24, 2, "u")]
                 + [row(24, 9) for _ in range(25)])
    whole = {r.key: r for r in grouping.nest_by_key(lines, "21", ("24",), max_rows=100).collect()}
    assert (len(whole[1].parents), len(whole[1].type_24), whole[1].segment) == (1, 25, 0)
    rows = grouping.nest_by_key(lines, "21", ("24",), max_rows=10).orderBy("key", "segment").collect()
    assert [(r.key, r.segment, len(r.parents) + len(r.type_24)) for r in rows] == [(1, 0, 10), (1, 1, 10), (1, 2, 6), (2, 0, 2)]
    texts = [c.value.rsplit(",", 1)[1] for r in rows[:3] for c in r.type_24]
    assert texts == [f"t{n}" for n in range(25)]


@pytest.mark.parametrize("compact", [True, False])
def test_hot_key_is_split_over_tasks(spark, small, tmp_path, monkeypatch, compact):
    """A child key with most of the rows, in one landed file or in many: no task of the join has much more than the rows of a salt."""
    monkeypatch.setattr(keyjoin, "HOT_ROWS", 500)
    text = "x" * 200
    files = ([row(21, k) for k in range(200)] + [row(24, 7, text) for _ in range(6000)],
             [row(24, k, text) for k in range(400)] + [row(24, "", text) for _ in range(3000)] + [row(24, 7, text) for _ in range(6000)])
    (tmp_path / "drop").mkdir()
    for number, held in enumerate(files):
        (tmp_path / "drop" / f"f{number}.csv").write_text("".join(line + "\n" for line in held))
    lines = jobs.prepare(spark, str(tmp_path / "drop"), small, compact=compact)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}

    def per_task(df):
        counted = df.select("key", "value").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
        return [r.n for r in counted.collect()]

    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for grouped in (grouping.group_by_key(lines, "21", ("24",)), grouping.group_in_chunks(lines, "21", ("24",), 10),
                        grouping.lookup_many(lines, lines.filter("record_type = '21'"))):
            tasks = per_task(grouped)
            assert sum(tasks) == 200 + 12000 + 200
            assert max(tasks) < 4 * 500 and len(tasks) > 12  # several salts may share a task; the key alone has 12,000 rows
        lost = grouping.rejects(lines, small, "21", ("24",))
        assert {r.reason: r.n for r in lost.groupBy("reason").agg(F.count("*").alias("n")).collect()} == {"orphan": 200, "bad_key": 3000}
        assert grouping.orphans(lines, "21", ("24",)).count() == 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_colocate_keeps_a_key_in_one_bucket_and_cuts_its_tasks(spark, drop, tmp_path):
    lines = drop([row(24, k) for k in range(50)] + [row(24, 20) for _ in range(500)])
    out = ordering.colocate(lines.filter("key IS NOT NULL"), 25)
    per_key = out.groupBy("key").agg(F.count_distinct("bucket").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b == 1 for r in per_key) and sum(r.n for r in per_key) == 550
    path = str(tmp_path / "buckets")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_colocated(out, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = spark.read.parquet(path).filter("key = 20").select(F.col("_metadata.file_name").alias("f"))
    assert hot.distinct().count() > 1
    assert hot.count() == 501


def test_lookups(drop):
    lines = drop([row(24, k % 10, f"t{k}") for k in range(40)])
    assert grouping.lookup(lines, 3).count() == 4
    keys = lines.sparkSession.createDataFrame([(1,), (1,), (5,), (99,), (None,)], "key BIGINT")
    assert grouping.lookup_many(lines, keys).count() == 8
