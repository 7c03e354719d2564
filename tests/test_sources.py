import csv
import gzip
import io
import random
import subprocess
import sys
import zipfile
import zlib
from pathlib import Path

import pytest
from conftest import row

from dropweave import versions
from dropweave.functions.csvtext import CORRUPT
from dropweave.operators import counts, filters
from dropweave.plans import jobs
from dropweave.sources.archives import read_zip
from dropweave.sources.listing import walk
from dropweave.sources.lines import list_files, number_lines, land, read_lines
from dropweave.sources.records import assemble_records
from dropweave.sources.typed import parse_type

DROP = ['10,"f"', row(21, 1), row(24, 1, '"a,b"'), row(24, 2), '29,"s"', "99,3"]


def write(folder, name, lines, sep="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("".join(line + sep for line in lines).encode())


def values(df):
    return [r.value for r in df.orderBy("source_file", "line_no").collect()]


def test_plain_gzip_and_zip_give_the_same_records(spark, small, tmp_path):
    expected = DROP + DROP[1:3]
    write(tmp_path / "csv", "a.csv", expected[:6])
    write(tmp_path / "csv", "b.csv", expected[6:])
    (tmp_path / "gz").mkdir()
    for name in ("a.csv", "b.csv"):
        (tmp_path / "gz" / (name + ".gz")).write_bytes(gzip.compress((tmp_path / "csv" / name).read_bytes()))
    (tmp_path / "zip").mkdir()
    with zipfile.ZipFile(tmp_path / "zip" / "both.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("a.csv", "b.csv"):
            z.write(tmp_path / "csv" / name, f"folder/{name}")
    for kind in ("csv", "gz", "zip"):
        lines = jobs.prepare(spark, str(tmp_path / kind), small)
        assert values(lines) == expected, kind
        assert [r.n_lines for r in lines.select("source_file", "n_lines").distinct().orderBy("source_file").collect()] == [6, 2]
    listed = jobs.list_drop(spark, str(tmp_path / "zip")).collect()
    assert sorted(r.source_file for r in listed) == ["both.zip!folder/a.csv", "both.zip!folder/b.csv"]


def test_zip_is_read_in_batches(spark, tmp_path, monkeypatch):
    from dropweave.sources import archives
    monkeypatch.setattr(archives, "BATCH_BYTES", 64)
    lines = [f"24,{n}," + "yé" * (n % 60) for n in range(500)]
    text = "\r\n".join([*lines, "", "é", ""])
    assert [line for block in archives._line_blocks(io.BytesIO(text.encode()), False) for line in block] == [*lines, "", "é"]
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("m.csv", text)
    got = read_zip(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.value for r in got] == [*lines, "", "é"]
    assert [r.pos for r in got] == list(range(502))


def test_task_functions_do_not_need_the_package(tmp_path):
    from pyspark import cloudpickle
    from dropweave.sources.archives import _line_blocks
    code = cloudpickle.dumps(lambda data: list(_line_blocks(io.BytesIO(data), False)))
    check = ("import sys, pickle; f = pickle.load(sys.stdin.buffer); "
             "assert f(b'a\\r\\nb') == [['a'], ['b']], f(b'a\\r\\nb'); assert not any('dropweave' in m for m in sys.modules)")
    done = subprocess.run([sys.executable, "-c", check], input=code, cwd=tmp_path, capture_output=True, check=False,
                          timeout=60)
    assert done.returncode == 0, done.stderr.decode()


def test_line_numbers_across_file_splits(spark, small, tmp_path):
    lines = [row(24, n, "z" * (n % 50)) for n in range(3000)]
    write(tmp_path / "d", "big.csv", lines)
    write(tmp_path / "d", "little.csv", lines[:5])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        raw = read_lines(spark, str(tmp_path / "d"))
        landed = land(raw, small)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert landed.filter("source_file = 'big.csv'").select("block").distinct().count() > 5
    numbered = number_lines(landed, with_total=True)
    assert values(numbered) == lines + lines[:5]
    assert [r.line_no for r in numbered.filter("source_file = 'big.csv'").orderBy("line_no").collect()] == list(range(3000))


def test_carriage_returns_and_odd_file_names(spark, small, tmp_path):
    write(tmp_path / "d", "a b+c%20.csv", DROP, sep="\r\n")
    lines = jobs.prepare(spark, str(tmp_path / "d"), small)
    assert values(lines) == DROP
    names = {r.source_file for r in lines.collect()}
    assert names == {r.source_file for r in list_files(spark, str(tmp_path / "d")).collect()} == {"a b+c%20.csv"}
    write(tmp_path / "d", "x[1]{2}.csv", DROP)
    got = jobs.count_all(spark, str(tmp_path / "d"), str(tmp_path / "manifest")).collect()
    assert {(r.source_file, r.n) for r in got if r.record_type == "24"} == {("a b+c%20.csv", 2), ("x[1]{2}.csv", 2)}


def test_a_drop_can_be_a_directory_of_part_files(spark, small, tmp_path):
    write(tmp_path / "d", "x", [])
    for name, lines in (("part-10", DROP[3:]), ("part-9", DROP[:3])):  # shorter names come first
        write(tmp_path / "d" / "source_file=a b.csv", name, lines)
    for source in ("directory", "source_file"):
        lines = jobs.prepare(spark, str(tmp_path / "d"), small, source=source, glob="part-*")
        assert values(lines) == DROP
        assert {(r.source_file, r.n_lines) for r in lines.collect()} == {("a b.csv", 6)}
        got = jobs.count_all(spark, str(tmp_path / "d"), str(tmp_path / source), source, "part-*").collect()
        assert {(r.source_file, r.record_type, r.n) for r in got} == {
            ("a b.csv", t, n) for t, n in (("10", 1), ("21", 1), ("24", 2), ("29", 1), ("99", 1))}


def test_zero_byte_file_is_listed_and_not_pending_again(spark, tmp_path):
    folder, path = tmp_path / "d", str(tmp_path / "manifest")
    write(folder, "good.csv", DROP)
    write(folder, "empty.csv", [])
    got = jobs.count_all(spark, str(folder), path).collect()
    assert [(r.record_type, r.n) for r in got if r.source_file == "empty.csv"] == [(None, 0)]
    files = list_files(spark, str(folder))
    assert counts.pending_files(files, jobs.read_manifest(spark, path)).isEmpty()
    entries = counts.manifest_text(counts.manifest_entries(jobs.read_manifest(spark, path))).collect()
    assert {r.source_file: r.counts for r in entries} == {"empty.csv": "", "good.csv": "10:1,21:1,24:2,29:1,99:1"}
    exported = counts.manifest_json(counts.manifest_entries(jobs.read_manifest(spark, path))).collect()
    assert '{"name":"good.csv","counts":{"10":1,"21":1,"24":2,"29":1,"99":1}}' in [r.value for r in exported]


def test_manifest_forgets_removed_files_and_counts_only_new_ones(spark, tmp_path):
    folder, path = tmp_path / "d", str(tmp_path / "manifest")
    write(folder, "b.csv", DROP)
    write(folder, "c.csv", DROP[:2])
    old = spark.createDataFrame([("a.csv", "21", 5), ("b.csv", "21", 77)], "source_file STRING, record_type STRING, n BIGINT")
    old.write.parquet(path)
    got = {(r.source_file, r.record_type, r.n) for r in jobs.count_all(spark, str(folder), path).collect()}
    # b.csv was known and is not counted again.
    assert got == {("b.csv", "21", 77), ("c.csv", "10", 1), ("c.csv", "21", 1)}
    with zipfile.ZipFile(folder / "more.zip", "w") as z:
        z.writestr("d.csv", "\n".join(DROP[1:4]))
    got = {(r.source_file, r.record_type, r.n) for r in jobs.count_all(spark, str(folder), path).collect()}
    assert {g for g in got if g[0] == "more.zip!d.csv"} == {("more.zip!d.csv", "21", 1), ("more.zip!d.csv", "24", 2)}
    assert len(got) == 5


def test_quoted_newline_is_one_record_in_record_mode(drop):
    text = [row(24, 1, '"EN'), 'G"', row(24, 2)]
    assert sorted(r.record_type for r in drop(text).collect()) == ["24", "24", 'G"']
    records = drop(text, scan_mode="record")
    assert values(records) == ['24,"I",1,1,"EN\nG"', row(24, 2)]
    assert [r.line_no for r in records.orderBy("line_no").collect()] == [0, 2]


def python_records(text):
    """Record texts as Python's own reader sees them: it says after how many lines a record ends."""
    lines = text.split("\n")[:-1]
    reader = csv.reader(io.StringIO(text, newline=""))
    ends, out = 0, []
    for _ in reader:
        out.append("\n".join(lines[ends:reader.line_num]))
        ends = reader.line_num
    return out


def test_records_agree_with_a_sequential_reader_over_small_splits(spark, tmp_path):
    rng = random.Random(7)
    def field():
        kind = rng.random()
        body = "".join(rng.choice("ab,\n\"xyz") for _ in range(rng.randrange(12)))
        if kind < 0.5:
            return '"' + body.replace('"', '""') + '"'
        plain = body.replace(",", "").replace("\n", "").lstrip('"')
        return plain  # may hold quotes in mid-field, which are plain text
    text = "".join(",".join(["24", *(field() for _ in range(3))]) + "\n" for _ in range(1500))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f.csv").write_text(text, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        records = assemble_records(read_lines(spark, str(tmp_path / "d"), keep_cr=True))
        got = values(records)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert got == python_records(text)


def test_records_of_an_unsplittable_file_are_worked_on_in_runs(spark, tmp_path, monkeypatch):
    from dropweave.sources import records as module
    monkeypatch.setattr(module, "RUN_BITS", 3)
    text = "".join(f'24,{n},"x' + "\n" * (n % 23) + 'y"\n' for n in range(120))
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(text.encode()))
    got = values(assemble_records(read_lines(spark, str(tmp_path), keep_cr=True)))
    assert got == python_records(text)


@pytest.mark.parametrize("length", [1, 20, 3000])
def test_record_nobody_closed_keeps_its_lines(spark, tmp_path, length):
    lines = ["24,ok", '24,"open'] + [f"24,{n}" for n in range(length)]
    write(tmp_path / "d", "f.csv", lines)
    write(tmp_path / "d", "g.csv", ["24,next"])  # the open quote ends with its file
    scan = read_lines(spark, str(tmp_path / "d"), keep_cr=True)
    assert values(assemble_records(scan)) == lines + ["24,next"]


@pytest.mark.parametrize("length", [1, 20, 3000])
def test_closed_record_is_one_row_at_any_length(spark, tmp_path, length):
    record = ['24,"open'] + [f"24,{n}" for n in range(length)] + ['end"']
    write(tmp_path / "d", "f.csv", ["24,ok", *record, "24,after"])
    scan = read_lines(spark, str(tmp_path / "d"), keep_cr=True)
    assert values(assemble_records(scan)) == ["24,ok", "\n".join(record), "24,after"]
    with pytest.raises(ValueError, match="line 1 of f.csv"):
        assemble_records(scan, max_bytes=10)


def test_files_of_equal_names_are_different_drops(spark, small, tmp_path):
    root, path = tmp_path / "d", str(tmp_path / "manifest")
    root.mkdir()
    write(root / "one", "x.csv", DROP)
    jobs.count_all(spark, str(root), path)
    write(root / "two", "x.csv", DROP[1:3])
    for name in ("p", "q"):
        with zipfile.ZipFile(root / f"{name}.zip", "w") as z:
            z.writestr("in/x.csv", "\n".join(DROP[1:4]))
            z.writestr("readme.txt", "24 hours\n32 bits")
    got = jobs.count_all(spark, str(root), path).collect()
    sizes = {}
    for r in got:
        sizes[r.source_file] = sizes.get(r.source_file, 0) + r.n
    assert sizes == {"one/x.csv": 6, "two/x.csv": 2, "p.zip!in/x.csv": 3, "q.zip!in/x.csv": 3}
    lines = jobs.prepare(spark, str(root), small)
    assert {(r.source_file, r.n_lines) for r in lines.collect()} == set(sizes.items())
    assert filters.positional_trim(lines).count() == 3  # only one/x.csv has more than three lines
    from dropweave.sources.archives import other_members
    assert {r.member for r in other_members(spark, str(root)).collect()} == {"readme.txt"}


def test_control_lines_by_type_and_by_position(drop):
    lines = drop(DROP, DROP[1:4])
    by_type = filters.drop_control(lines)
    assert by_type.groupBy("source_file").count().orderBy("source_file").collect()[0][1] == 3
    assert values(by_type) == DROP[1:4] * 2
    # The second file has no control lines: by position it loses its first and last two.
    assert values(filters.positional_trim(lines)) == DROP[1:4]


def test_mixed_flag_and_files_without_some_control_type(drop):
    lines = drop(DROP, ['10,"f"', row(24, 1), "99,1"])
    got = counts.data_types_per_file(counts.manifest(counts.count_records(lines))).orderBy("source_file").collect()
    assert [(r.source_file, r.n_types, r.mixed) for r in got] == [("f0.csv", 2, True), ("f1.csv", 1, False)]


def test_quotes_and_commas_in_fields(drop, small):
    lines = drop(['24,"I",4,100010,"K,1 say ""hi"""', '24,"a,b",5,7,x'])
    typed = parse_type(lines, small["24"], ("key",)).orderBy("PRO_ORDER").collect()
    assert [(r.key, r.CHANGE_TYPE, r.TEXT, r[CORRUPT]) for r in typed] == [
        (100010, "I", 'K,1 say "hi"', None), (7, "a,b", "x", None)]


def test_positional_trim_needs_totals(drop):
    with pytest.raises(ValueError):
        filters.positional_trim(drop(DROP, scan_mode="record"))


def test_compact_landing_keeps_every_line(spark, small, tmp_path):
    write(tmp_path / "d", "a.csv", DROP * 20)
    lines = jobs.prepare(spark, str(tmp_path / "d"), small, landed=str(tmp_path / "landed"), compact=True)
    assert values(lines) == DROP * 20
    assert values(jobs.reopen(spark, str(tmp_path / "landed"))) == DROP * 20


def test_unknown_types_are_kept(drop):
    odd = ["", "zz,1", "é,2", "9", row(24, 3)]
    lines = drop(odd)
    assert values(lines) == odd
    assert {r.record_type: r.n for r in counts.count_records(lines).collect()} == {"": 1, "zz": 1, "é,": 1, "9": 1, "24": 1}


def test_manifest_of_a_failed_job_is_not_read(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "d", str(tmp_path / "manifest")
    write(folder, "a.csv", DROP)
    first = sorted(map(str, jobs.count_all(spark, str(folder), path).collect()))
    write(folder, "b.csv", DROP)
    # The job dies after the rows were written, before they are named the present ones.
    with monkeypatch.context() as patched:
        patched.setattr(versions, "_store", dying_after_the_write(path))
        with pytest.raises(RuntimeError):
            jobs.count_all(spark, str(folder), path)
    assert sorted(map(str, jobs.read_manifest(spark, path).collect())) == first
    # A folder half written by a dead job is passed over, and its number is not used again.
    (tmp_path / "manifest" / "v-0000000009").mkdir()
    assert jobs.count_all(spark, str(folder), path).count() == 2 * len(first)
    assert versions.newest(spark, path).endswith("v-0000000010")
    for _ in range(3):
        jobs.count_all(spark, str(folder), path)
    assert len([p for p in (tmp_path / "manifest").iterdir() if p.name.startswith("v-")]) == versions.KEPT


def dying_after_the_write(path):
    store_of = versions._store

    def store(spark, folder):
        if any((Path(path) / n).exists() for n in ("v-0000000002/_SUCCESS",)):
            raise RuntimeError("the job dies here")
        return store_of(spark, folder)
    return store


def test_landing_by_manifest_opens_files_of_the_types_only(spark, small, tmp_path):
    folder, path = tmp_path / "d", str(tmp_path / "manifest")
    write(folder, "a b%.csv", [row(21, 1), row(24, 1), '29,"s"'])
    write(folder, "b.csv", ['10,"f"', row(21, 2)])
    write(folder, "c.csv", [row(15, 3)])
    with zipfile.ZipFile(folder / "z.zip", "w") as z:
        z.writestr("in/x.csv", "\n".join([row(24, 9), row(15, 1)]))
        z.writestr("in/y.csv", row(21, 9))
    jobs.count_all(spark, str(folder), path)
    lines = jobs.prepare(spark, str(folder), small, manifest=path, types=("24",))
    assert {(r.source_file, r.line_no, r.record_type) for r in lines.collect()} == {
        ("a b%.csv", 0, "21"), ("a b%.csv", 1, "24"), ("a b%.csv", 2, "29"), ("z.zip!in/x.csv", 0, "24"), ("z.zip!in/x.csv", 1, "15")}
    # A file that is not named is not opened: it can be gone, and the index prunes it before any task.
    only = spark.createDataFrame([("a b%.csv",)], "source_file string")
    scan = read_lines(spark, str(folder), only=only)
    assert scan.count() == 3
    assert {r[0].rsplit("/", 1)[1] for r in scan.select("part").distinct().collect()} == {"a%20b%25.csv"}
    with pytest.raises(ValueError):
        jobs.prepare(spark, str(folder), small, types=("24",))


@pytest.mark.parametrize("most", [10_000, 0])
def test_named_files_by_filter_and_by_join(spark, tmp_path, monkeypatch, most):
    from dropweave.sources import lines as module
    monkeypatch.setattr(module, "PRUNED_FILES", most)
    for n in range(6):
        write(tmp_path / "d", f"f{n}.csv", DROP[:n + 1])
    only = spark.createDataFrame([("f1.csv",), ("f4.csv",), ("no.csv",), (None,)], "source_file string")
    scan = read_lines(spark, str(tmp_path / "d"), only=only)
    assert {r.source_file: r["count"] for r in scan.groupBy("source_file").count().collect()} == {"f1.csv": 2, "f4.csv": 5}
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert ("LeftSemi" in plan) == (most == 0)


def test_listing_in_tasks(spark, tmp_path):
    root = tmp_path / "d"
    for folder in ("", "a", "a/b c", "x=1", "_hidden", ".git", "empty"):
        (root / folder).mkdir(parents=True, exist_ok=True)
    for name in ("one.csv", "a/two.csv.gz", "a/b c/three%41.csv", "x=1/part-0", "x=1/_SUCCESS", "_hidden/no.csv", ".git/no.csv", "a/note.txt", "a/.no.csv"):
        (root / name).write_text("" if "two" in name else "24,x\n")
    got = list_files(spark, str(root))
    assert sorted(r.source_file for r in got.collect()) == ["a/b c/three%41.csv", "a/two.csv.gz", "one.csv"]
    # No list of names lies in the plan, only staged tables.
    assert "three" not in got._jdf.queryExecution().toString()
    assert [r.source_file for r in list_files(spark, str(root), "x", "part-*").collect()] == ["1"]
    assert [r.source_file for r in list_files(spark, str(root / "one.csv")).collect()] == ["one.csv"]
    assert [r.part.rsplit("/", 1)[1] for r in list_files(spark, str(root / "a*" / "*.gz")).collect()] == ["two.csv.gz"]
    sizes = {r.path.rsplit("/", 1)[1]: r.size for r in walk(spark, str(root)).collect()}
    assert sizes == {"one.csv": 5, "two.csv.gz": 0, "three%41.csv": 5, "part-0": 5, "note.txt": 5}
    jobs.count_all(spark, str(root), str(tmp_path / "m"))
    assert {(r.source_file, r.n) for r in jobs.read_manifest(spark, str(tmp_path / "m")).collect()} == {
        ("one.csv", 1), ("a/two.csv.gz", 0), ("a/b c/three%41.csv", 1)}


class Watched(io.BytesIO):
    def read(self, size=-1):
        data = super().read(size)
        Watched.bytes += len(data)
        return data


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_a_member_is_read_from_its_own_place(method):
    from dropweave.sources.archives import MemberStream, directory
    packed = io.BytesIO(b"")
    packed.write(b"some bytes in front")
    with zipfile.ZipFile(packed, "a", method) as z:
        for n in range(2000):
            z.writestr(f"m{n}.csv", f"{n}," * (n % 50))
        z.mkdir("folder")
    members = directory(io.BytesIO(packed.getvalue()))
    assert len(members) == 2000
    Watched.bytes = 0
    for m in members[::100]:
        stream, text = MemberStream(Watched(packed.getvalue()), m.header, m.packed, m.method, m.flags, m.crc), b""
        while block := stream.read(7):
            text += block
        n = int(m.name[1:-4])
        assert text == (f"{n}," * (n % 50)).encode()
    assert Watched.bytes < 20 * 500  # the directory alone has over 100,000 bytes
    m = members[49]
    broken = bytearray(packed.getvalue())
    broken[m.header + 30 + len(m.name) + 2] ^= 1
    for data, place in ((bytes(broken), m.header), (packed.getvalue(), m.header + 1), (packed.getvalue()[:m.header + 30 + len(m.name) + 3], m.header)):
        with pytest.raises((zipfile.BadZipFile, zlib.error)):
            stream = MemberStream(io.BytesIO(data), place, m.packed, m.method, m.flags, m.crc)
            while stream.read(1000):
                pass
