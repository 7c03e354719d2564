"""Record-aware scan: a line end inside quotes does not end the record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropweave.session import broadcast_if_small, pin_splits, stage
from dropweave.sources.lines import without_cr

MAX_RECORD_BYTES = 2**31 - 64  # what one row can hold
# Splits are taken in runs of 256 lines: the most a list of quoted lines, or of records that a line may belong to, can hold.
RUN_BITS = 8
_LAST = 2**63 - 1


def _ends_inside(text: Column) -> Column:
    """Whether a text that starts at a field start ends inside a quoted field.

    Doubled quotes change nothing, complete quoted fields go next; an opening quote that is
    still there at a field start was never closed.  A quote in mid-field is plain text.
    """
    single = F.regexp_replace(text, '""', "")
    rest = F.regexp_replace(single, '(^|,)"[^"]*"[^,]*', "$1")
    return rest.rlike('(^|,)"')


def _state(start: Column, flips: Column, fixed: Column) -> Column:
    """Inside (1) or outside (0) after a row of lines, from the state before them.

    A line keeps the state, flips it, or fixes it whatever it was before.  So the state is
    the last fixed one, or ``start`` if there is none, flipped as often as lines since say.
    """
    return F.when(fixed.isNull(), start.bitwiseXOR(flips % 2)).otherwise(
        fixed["state"].bitwiseXOR((flips - fixed["flips"]) % 2))


def _runs(lines: DataFrame) -> DataFrame:
    """One row per run of lines: ``(source_file, part, block, run, n, first_pos, quotes)``, staged.

    ``quotes`` are the lines that may change the quote state, ``(pos, f0, f1)`` in order: whether the line ends inside a quoted
    field if it starts outside or inside of one.  All lines of a run are in one task, so they are added up before the shuffle.
    """
    quoted = F.col("value").contains('"')
    out, inside = _ends_inside(F.col("value")), _ends_inside(F.concat(F.lit('"'), F.col("value")))
    told = lines.select("source_file", "part", "block", "pos", F.shiftright("pos", RUN_BITS).alias("run"),
                        F.when(quoted, F.struct(out.cast("int").alias("f0"), inside.cast("int").alias("f1"))).alias("f"))
    changes = F.when(F.expr("f.f0 = 1 OR f.f1 = 0"), F.struct("pos", "f.f0", "f.f1"))
    return stage(told.groupBy("source_file", "part", "block", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.array_sort(F.collect_list(changes)).alias("quotes")), "runs")


def _ends(quotes: Column, start: int) -> Column:
    return F.aggregate(quotes, F.lit(start), lambda state, line: F.when(state == 0, line["f0"]).otherwise(line["f1"]))


def _turns(quotes: Column, start: Column, shift: Column) -> Column:
    """Numbers of the lines in which the state changes."""
    def step(s: Column, line: Column) -> Column:
        after = F.when(s["state"] == 0, line["f0"]).otherwise(line["f1"])
        return F.struct(after.alias("state"), F.when(after != s["state"], F.array_append(s["turns"], line["pos"] + shift)).otherwise(
            s["turns"]).alias("turns"))
    return F.aggregate(quotes, F.struct(start.cast("int").alias("state"), F.array().cast("array<bigint>").alias("turns")), step, lambda s: s["turns"])


def _placed_runs(runs: DataFrame) -> DataFrame:
    """Runs with ``shift`` (from place to line number) and ``spans``, staged.

    ``spans`` are the records of several lines that have lines in the run, ``(first, last)`` in line numbers; a record that goes on
    beyond the run has no last line here, and one that nobody closes is left out.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    in_source = Window.partitionBy("source_file").orderBy(F.length("part"), "part", "block", "run")
    in_part, whole = Window.partitionBy("part").orderBy("block", "run"), Window.partitionBy("part")
    before = in_part.rowsBetween(Window.unboundedPreceding, -1)
    chained = (
        runs.withColumn("shift", F.coalesce(F.sum("n").over(in_source.rowsBetween(Window.unboundedPreceding, -1)), zero) - F.col("first_pos"))
        .withColumn("g0", _ends(F.col("quotes"), 0)).withColumn("g1", _ends(F.col("quotes"), 1))
        .withColumn("flips", F.sum(F.when(F.expr("g0 = 1 AND g1 = 0"), one).otherwise(zero)).over(
            in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("fixed", F.last(F.when(F.expr("g0 = g1"), F.struct(F.col("g0").cast("bigint").alias("state"), "flips")), ignorenulls=True).over(before))
        .withColumn("inside", _state(zero, F.expr("flips - IF(g0 = 1 AND g1 = 0, 1, 0)"), F.col("fixed")))
        .withColumn("turns", _turns(F.col("quotes"), F.col("inside"), F.col("shift")))
        .withColumn("last_turn", F.get("turns", F.size("turns") - 1))
        .withColumn("carried", F.last("last_turn", ignorenulls=True).over(before))
        # The state changes an even number of times in a file whose records are all closed.
        .withColumn("unclosed", F.when(F.sum(F.size("turns")).over(whole) % 2 == 1, F.max("last_turn").over(whole))))
    bounds = F.concat(F.when(F.col("inside") == 1, F.array("carried")).otherwise(F.array().cast("array<bigint>")), "turns")
    pairs = F.transform(F.filter(F.transform("bounds", lambda b, i: F.struct(b.alias("first"), F.coalesce(
        F.get("bounds", i + 1), F.lit(_LAST)).alias("last"), (i % 2 == 0).alias("opens"))), lambda p: p["opens"]),
        lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last")))
    closed = F.filter(pairs, lambda p: ~p["first"].eqNullSafe(F.col("unclosed")))
    return stage(chained.withColumn("bounds", bounds).select("part", "block", "run", "n", "first_pos", "shift", closed.alias("spans")), "placed-runs")


def assemble_records(lines: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """Lines (scanned with ``keep_cr``) to records ``(source_file, line_no, value)``.

    ``line_no`` is that of the record's first line.  The text is scanned again instead of being moved: the first scan
    leaves the quoted lines of every run as two flags each, which are worked out for both states the run could start in, chained
    over the runs of a file, and turned into spans of lines.  In the second one a line finds the spans of its run; one that
    is in none is a record as it stands.  Only lines of records of several lines are shuffled and staged.

    Both scans must cut files alike: the least number of partitions is pinned for the session, and a line that the first scan has not
    seen is an error.  A closed record is one row at any length.  If a quote is still open at the end of a file, the lines from
    the record's first on are kept one by one, however few or many they are.  A closed record too large for a row is an error that
    names its place.
    """
    pin_splits(lines.sparkSession)
    runs = _placed_runs(_runs(lines))
    splits = broadcast_if_small(stage(runs.groupBy("part", "block").agg(
        F.min("shift").alias("shift"), F.sum("n").alias("n"), F.min("first_pos").alias("first_pos")), "splits"))
    spans = broadcast_if_small(stage(runs.filter(F.size("spans") > 0).select("part", "block", "run", "spans"), "spans"))
    seen = F.col("shift").isNotNull() & (F.col("pos") - F.col("first_pos")).between(0, F.col("n") - 1)
    line_no = F.when(seen, F.col("pos") + F.col("shift")).otherwise(F.raise_error(F.concat(
        F.lit("a second scan cuts this file in another way: "), "part")).cast("bigint"))
    placed = (lines.withColumn("run", F.shiftright("pos", RUN_BITS)).join(splits, ["part", "block"], "left")
              .join(spans, ["part", "block", "run"], "left").select("source_file", "value", "spans", line_no.alias("line_no"))
              .select("source_file", "value", "line_no", F.get(F.filter(
                  "spans", lambda p: F.col("line_no").between(p["first"], p["last"])), 0)["first"].alias("record_no")))
    strip = without_cr(F.col("value")).alias("value")
    alone = placed.filter("record_no IS NULL").select("source_file", "line_no", strip)
    if spans.isEmpty():
        return alone
    several = stage(placed.filter("record_no IS NOT NULL"), "lines-of-records")
    key = ["source_file", "record_no"]
    too_large = several.groupBy(*key).agg(F.sum(F.octet_length("value") + 1).alias("bytes")).filter(
        F.col("bytes") > max_bytes).first()
    if too_large:
        raise ValueError(f"the record at line {too_large.record_no} of {too_large.source_file} has {too_large.bytes} bytes, "
                         f"more than a row can hold ({max_bytes})")
    joined = several.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("lines")).select(
        "source_file", F.col("record_no").alias("line_no"),
        without_cr(F.array_join("lines.value", "\n")).alias("value"))
    return alone.union(joined)
