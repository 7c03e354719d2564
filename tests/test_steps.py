import pytest
from conftest import row

from dropweave import sinks
from dropweave.__main__ import main
from dropweave.functions import csvtext
from dropweave.functions.registry import RecordType, Registry
from dropweave.operators import counts, filters, grouping, ordering
from dropweave.plans import jobs
from dropweave.sources.typed import good_rows, parse_type, read_typed
from pyspark.sql import functions as F

FILES = (['10,"f"', row(21, 3, "p3"), row(24, 3, "c"), row(24, 1, "d"), '29,"s"', "99,3"],
         ['10,"f"', row(21, 1, "p1"), row(11, 9000, "st"), row(11, 100010, "st"), '29,"s"', "99,3"])


def text(spark, path):
    return [r.value for r in spark.read.text(path).select("value", "_metadata.file_name").orderBy("file_name").collect()]


def test_merge_counts_equal_manifest_counts_and_split_then_merge_is_merge(spark, drop, small, tmp_path):
    lines = drop(*FILES)
    split, merged, again = (str(tmp_path / n) for n in ("split", "merged", "again"))
    jobs.split_all(lines, split, small)
    jobs.merge_all(lines, merged, small)
    wanted = {r.record_type: r.n for r in counts.count_records(lines).groupBy("record_type").agg(F.sum("n").alias("n")).collect()}
    for record_id, name in (("21", "BPLU"), ("24", "LPI"), ("11", "Street")):
        assert len(text(spark, f"{merged}/merged_file=Records_{name}.csv")) == wanted[record_id]
    assert text(spark, f"{split}/split_file=f0_r24.csv") == [row(24, 3, "c"), row(24, 1, "d")]
    jobs.merge_all(jobs.prepare(spark, split, small, source="split_file", glob="part-*"), again, small)
    for name in ("BPLU", "LPI", "Street"):
        assert text(spark, f"{again}/merged_file=Records_{name}.csv") == text(spark, f"{merged}/merged_file=Records_{name}.csv")


def test_headers_are_field_names_once_per_output(spark, drop, small, tmp_path):
    lines = drop(*FILES)
    jobs.merge_all(lines, str(tmp_path / "m"), small, include_headers=True)
    jobs.split_all(lines, str(tmp_path / "s"), small, include_headers=True)
    header = "RECORD_IDENTIFIER,CHANGE_TYPE,PRO_ORDER,UPRN,TEXT"
    assert text(spark, str(tmp_path / "m/merged_file=Records_LPI.csv")) == [header, row(24, 3, "c"), row(24, 1, "d")]
    assert text(spark, str(tmp_path / "s/split_file=f1_r21.csv")) == [header, row(21, 1, "p1")]


def test_trim_by_position_in_a_step(spark, drop, small, tmp_path):
    jobs.merge_all(drop(FILES[0], FILES[1][1:4]), str(tmp_path / "m"), small, trim="position")
    assert text(spark, str(tmp_path / "m/merged_file=Records_BPLU.csv")) == [row(21, 3, "p3")]
    with pytest.raises(ValueError):
        jobs.merge_all(drop(*FILES), str(tmp_path / "x"), small, trim="none")


def test_sort_is_numeric_nulls_first_and_text_order_on_request(drop, small):
    lines = drop([row(11, 100010), row(11, 9000), row(11, ""), row(11, 9000, "b")])
    def keys(**more):
        return [(r.USRN, r.TEXT) for r in ordering.global_sort(lines, small["11"], "USRN", **more).collect()]
    assert keys() == [(None, None), (9000, None), (9000, "b"), (100010, None)]
    assert [k for k, _ in keys(as_text=True)] == [None, 100010, 9000, 9000]


def test_sort_by_another_field_and_unknown_fields(drop, small):
    lines = drop([row(24, 1, "b"), row(24, 2, "a"), row(24, 3, "b")])
    got = ordering.global_sort(lines, small["24"], "TEXT").collect()
    assert [(r.TEXT, r.UPRN) for r in got] == [("a", 2), ("b", 1), ("b", 3)]
    with pytest.raises(ValueError, match="11"):
        ordering.sort_types(lines, [small["21"], small["11"]], "UPRN")


def test_sort_step_writes_ordered_files_and_rejects(spark, drop, small, tmp_path):
    lines = drop([row(24, k, "t") for k in (5, 3, 9, 1)] + ['24,"I",bad,4,t'])
    jobs.sort_records(lines, str(tmp_path / "o"), small, ("24",), rejects=str(tmp_path / "r"))
    assert [r.split(",")[3] for r in text(spark, str(tmp_path / "o/Records_LPI"))] == ["1", "3", "5", "9"]
    assert text(spark, str(tmp_path / "r/Records_LPI")) == ['24,"I",bad,4,t']


def test_global_index_equals_row_number(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("key"), "id")
    got = ordering.global_index(rows, "key", "id").orderBy("key", "id").collect()
    assert [r.row_index for r in got] == list(range(5000))


def test_empty_null_and_blanks_through_sink_and_scan(spark, drop, small, tmp_path):
    lines = drop(['21,"I",1,7," x "', '21,"I",2,8,""', '21,"I",3,9,'])
    typed = good_rows(parse_type(lines, small["21"]))
    sinks.write_table(typed, str(tmp_path / "o"))
    assert text(spark, str(tmp_path / "o")) == ["21,I,1,7, x ", "21,I,2,8,", "21,I,3,9,"]
    back = read_typed(spark, str(tmp_path / "o"), small["21"]).orderBy("PRO_ORDER").collect()
    assert [(r.TEXT, r[csvtext.CORRUPT]) for r in back] == [(" x ", None), (None, None), (None, None)]


def test_landed_scan_opens_only_the_wanted_types(drop):
    plan = filters.with_type(drop(*FILES), "24")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "IN (24,other)" in plan.replace("family", "", 1)


def test_names(spark):
    one = spark.range(1).select(
        csvtext.part_name(F.lit(7)), csvtext.part_name(F.lit(123456)), csvtext.split_name(F.lit("x.csv"), F.lit("24")),
        *(csvtext.split_name(F.lit(n), F.lit("24")) for n in ("x.gz", "a/y.csv.gz", "z", "p.zip!in/y.CSV")),
        csvtext.base_name(F.lit("p.zip!in/y.csv")), csvtext.base_name(F.lit("a/y.csv")), csvtext.base_name(F.lit("y.csv")),
        csvtext.drop_suffix(F.lit("x.csv.yml")), csvtext.file_stem(F.lit("a/b/c.csv"))).first()
    assert tuple(one) == ("part-0007.csv", "part-123456.csv", "x_r24.csv", "x_r24", "a/y_r24.csv", "z_r24", "p.zip!in/y_r24.CSV",
                          "y.csv", "y.csv", "y.csv", "x.csv", "c.csv")


def test_field_without_parsing_the_line(spark):
    lines = ["24,I,1,7,x", "24,I,1,7", "24,I,1", "", '24,"a,b",1,7,x', '24,"a,""b"",",1,"7",x', '24,I,1,7,"x,y"',
             "24,I,1,,x", '24,"a,b",1', '24,"a"",b",1,"7" ,x']
    df = spark.createDataFrame([(v,) for v in lines], "v STRING").select(csvtext.field_at(F.col("v"), 3).alias("f"))
    assert [r.f for r in df.collect()] == ["7", "7", "", "", "7", "7", "7", "", "", '7" ']
    firsts = spark.createDataFrame([("24,I",), ("",)], "v STRING").select(csvtext.field_at(F.col("v"), 0).alias("f"))
    assert [r.f for r in firsts.collect()] == ["24", ""]


def test_key_text(spark):
    texts = ["12", " 12 ", "12.0", "x", "", None, "9223372036854775808", "-3"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(csvtext.to_key(F.col("t")).alias("k"))
    assert [r.k for r in df.collect()] == [12, 12, None, None, None, None, None, -3]


def test_standard_registry():
    registry = Registry.standard()
    assert {t.id: (t.name, len(t.fields)) for t in registry}["28"] == ("DeliveryPointAddress", 29)
    assert sum(len(t.fields) for t in registry) == 190
    assert {t.id: t.key_field for t in registry if t.key_field} == {
        "11": "USRN", "15": "USRN", **dict.fromkeys(("21", "23", "24", "28", "30", "31", "32"), "UPRN")}
    assert all(f.nullable for t in registry for f in t.schema.fields)
    with pytest.raises(KeyError):
        registry["77"]
    with pytest.raises(ValueError):
        RecordType.from_layout("1", "n", "A decimal")


def test_registry_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "r.yml"
    path.write_text('"21":\n  id: 21\n  name: P\n  schema:\n    primaryKey: K\n    fields:\n'
                    '      - {name: A, type: integer}\n      - {name: T, type: time}\n')
    entry = Registry.from_yaml(str(path))["21"]
    assert (entry.name, entry.primary_key, entry.schema.simpleString()) == ("P", "K", "struct<A:int,T:string>")


def test_command_line_with_the_standard_types(spark, tmp_path):
    types = Registry.standard()
    def line(record_id, key, width):
        return ",".join([record_id, '"I"', "1", str(key)] + [""] * (width - 4))
    widths = {t.id: len(t.fields) for t in types}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(
        [line(i, k, widths[i]) for i in ("21", "24", "31", "11", "15") for k in (5, 4)]) + "\n")
    landed, base = str(tmp_path / "landed"), str(tmp_path)
    main(["merge", "--input", str(folder), "--landed", landed, "--output", base + "/merged"])
    main(["split", "--landed", landed, "--output", base + "/split", "--types", "21,24"])
    main(["sort", "--landed", landed, "--output", base + "/sorted", "--types", "21, 24", "--rejects", base + "/bad"])
    main(["group-uprn", "--landed", landed, "--output", base + "/uprn", "--chunk-size", "1"])
    main(["group-usrn", "--input", str(folder), "--scan-mode", "record", "--output", base + "/usrn", "--limit-per-key", "1"])
    main(["count", "--input", str(folder), "--output", base + "/manifest"])
    assert jobs.read_manifest(spark, base + "/manifest").count() == 5
    (folder / "b.csv").write_text(line("21", 9, widths["21"]) + "\n")
    main(["count", "--input", str(folder), "--output", base + "/manifest"])
    main(["merge", "--input", str(folder), "--output", base + "/some", "--manifest", base + "/manifest", "--types", "24"])
    main(["group-usrn", "--input", str(folder), "--output", base + "/streets", "--manifest", base + "/manifest"])
    assert len(text(spark, base + "/some")) == 2 and len(text(spark, base + "/streets")) == 4
    assert [v[:2] for v in text(spark, base + "/uprn/part_file=part-0001.csv")] == ["21", "24", "31"]
    assert len(text(spark, base + "/usrn")) == 4
    assert text(spark, base + "/bad/Records_LPI") == []
    with pytest.raises(SystemExit):
        main(["merge", "--output", base + "/none"])


def test_every_line_has_a_home(spark, drop, small, tmp_path):
    """Outputs and rejects together are the input; each line left out has one reason."""
    text = ["10,head", row(21, 1), row(24, 1), row(24, 9), '24,"I",1,bad,x', row(15, 1), "2X,odd", "", row(23, 1), "99,end"]
    lines = drop(text)
    jobs.group_uprn(lines, str(tmp_path / "g"), small, rejects=str(tmp_path / "gr"))
    reasons = {(r.reason, r.value) for r in spark.read.parquet(str(tmp_path / "gr")).collect()}
    grouped = spark.read.text(str(tmp_path / "g")).collect()
    assert {r.value for r in grouped} == {row(21, 1), row(24, 1)}
    assert reasons == {("control", "10,head"), ("control", "99,end"), ("orphan", row(24, 9)), ("bad_key", '24,"I",1,bad,x'),
                       ("not_requested", row(15, 1)), ("unknown_type", "2X,odd"), ("unknown_type", ""), ("unknown_type", row(23, 1))}
    for step in (jobs.split_all, jobs.merge_all):
        out, bad = (str(tmp_path / f"{step.__name__}-{kind}") for kind in ("o", "r"))
        step(lines, out, small, ("24",), rejects=bad)
        kept, left = spark.read.text(out).count(), spark.read.parquet(bad).groupBy("reason").count().collect()
        assert kept + sum(r["count"] for r in left) == len(text)
        assert {r.reason: r["count"] for r in left} == {"control": 2, "not_requested": 2, "unknown_type": 3}


def test_sort_keeps_rows_that_do_not_fit(spark, drop, small, tmp_path):
    lines = drop(['24,"I",bad,9,c', row(24, 3)])
    jobs.sort_records(lines, str(tmp_path / "o"), small, ("24",))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "o" / "*")).collect()) == ["24,I,,9,c", "24,I,1,3,"]


def test_undeclared_type_is_found(drop):
    assert [r.value for r in filters.with_type(drop(["23,x", row(24, 1)]), "23").collect()] == ["23,x"]


def test_types_sorted_together_are_those_sorted_apart(spark, drop, small, tmp_path):
    files = [[row(i, k % 17 if k % 5 else "", f"t{k}", k) for k in range(f, 90, 3) for i in (21, 24, 31)] + ['24,"I",bad,4,t'] for f in range(3)]
    lines = drop(*files)
    ids = ("24", "31", "21")
    jobs.sort_records(lines, str(tmp_path / "o"), small, ids, rejects=str(tmp_path / "r"))
    for record_id in ids:
        name = small[record_id].name
        apart = good_rows(ordering.global_sort(lines, small[record_id]))
        want = [r.v for r in apart.select(csvtext.format_line(*apart.columns).alias("v")).collect()]
        assert text(spark, str(tmp_path / "o" / f"Records_{name}")) == want and len(want) == 90
        assert text(spark, str(tmp_path / "r" / f"Records_{name}")) == (['24,"I",bad,4,t'] * 3 if record_id == "24" else [])
    together = ordering.sort_together(lines, [small[i] for i in ids], "TEXT").collect()
    assert [r.record_type for r in together] == ["24"] * 93 + ["31"] * 90 + ["21"] * 90
    with pytest.raises(FileExistsError):
        jobs.sort_records(lines, str(tmp_path / "o"), small, ("24",))
    jobs.sort_records(lines, str(tmp_path / "o"), small, ("24", "15"), "PRO_ORDER", mode="overwrite")
    assert text(spark, str(tmp_path / "o" / "Records_StreetDescriptor")) == []
    assert len(text(spark, str(tmp_path / "o" / "Records_LPI"))) == 93
    assert not [p for p in (tmp_path / "o").iterdir() if p.name.startswith("_sorting")]
    with pytest.raises(ValueError):
        ordering.sort_together(lines, [small["21"], small["11"]], "UPRN")


def test_sort_is_one_job_with_one_sample(spark, drop, small):
    plan = ordering.sort_together(drop(*FILES), [small[i] for i in ("21", "24")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1


def test_lookup_by_path_alone(spark, drop, tmp_path):
    lines = drop([row(24, k, f"t{k}") for k in range(300)] + [row(24, 150, "hot") for _ in range(50)])
    path = str(tmp_path / "buckets")
    sinks.write_colocated(ordering.colocate(lines, 60), path)
    fresh = spark.newSession()
    found = grouping.lookup_stored(fresh, path, 150)
    assert found.count() == 51 and found.select("bucket").distinct().count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    assert grouping.lookup_stored(fresh, path, 10_000).count() == 0
    zones = fresh.read.parquet(f"{path}/{sinks.ZONES}").collect()
    assert sum(r.rows for r in zones) == 350 and fresh.read.parquet(path).count() == 350
    spans = {(r.bucket, r.file): (r.first_key, r.last_key) for r in zones}
    opened = found.select("bucket", F.col("_metadata.file_name")).distinct().collect()
    assert {tuple(r) for r in opened} <= {place for place, (a, b) in spans.items() if a <= 150 <= b}
