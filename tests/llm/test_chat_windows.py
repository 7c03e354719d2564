"""Chat windows against a plain version of their rules, and the digests of the query."""

import hashlib
import random
from pathlib import Path

import pytest

from dropweave.llm import chat_windows as own, queries
from dropweave.llm.queries import vocabulary

BYTES = Path(vocabulary("byte_bpe_50k.json")).read_bytes()
SCHEMA = "conv_id long, turn long, role string, text string, window string, tokens string"


@pytest.fixture(scope="module")
def count():
    return own.Counted(BYTES)


def conversations():
    rng = random.Random(11)
    words = ["hello", "</s>", "[INST]", "<<SYS>>", "a\\.b", "\\", "<", "naïve", "ok\n", " [/INST]", "[ROLE] x [/ROLE]", "😀"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randrange(1, 9)):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", "assistant", "tool", None, "[INST]"])
            rows.append((conv, turn, role, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))))
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " * rng.randrange(1, 9)) for t in range(300)]
    rows += [(101, 0, "system", "be kind"), *((101, t, "assistant" if t % 2 else "user", "x " * (t % 40)) for t in range(1, 200))]
    rows += [(102, 0, "system", "long " * 400), (102, 1, "user", "hi"), (102, 2, "assistant", "word " * 3000), (102, 3, "user", None)]
    rows += [(103, None, "user", "first"), (103, 0, "assistant", "second"), (103, 0, "assistant", "second"), (103, 0, "user", "zz")]
    rows += [(None, 1, "assistant", "nobody"), (None, 0, "user", ""), (104, 0, "assistant", "")]
    rng.shuffle(rows)
    return [(*r, "extra", "extra") for r in rows]


def by_conversation(spark, rows):
    """Turns in order: by number (null first), role and hash of the text."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    out = {}
    for r in df.withColumn("h", F.xxhash64("text")).orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "h").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    return out


def plain_windows(turns, count, budget, history, segment):
    """``(segment, window, first turn, number of new turns, repeated turns, system repeated)``, turn by turn."""
    tokens = [count.turn(*t) for t in turns]
    before = [sum(tokens[:i]) for i in range(len(turns))]
    keeps = turns[0][0] == "system" and 2 * tokens[0] <= budget
    out, at, window, now = [], 0, 0, 0
    while at < len(turns):
        number = before[at] // (segment * budget)
        window = window + 1 if out and number == now else 0
        now = number
        system = keeps and at > 0
        room = budget - count.start - (tokens[0] if system else 0)
        low = at
        while low > (1 if keeps else 0) and sum(tokens[low - 1:at]) <= min(history, room - tokens[at]):
            low -= 1
        end = at + 1
        while end < len(turns) and before[end] // (segment * budget) == number and sum(tokens[low:end + 1]) <= room:
            end += 1
        out.append((number, window, at, end - at, at - low, system))
        at = end
    return out


@pytest.mark.parametrize("budget, history, segment, parts", [(1024, 256, 32, 8), (100, 30, 2, 3), (60, 0, 1, 8)])
def test_windows_agree_with_plain_rules(spark, count, budget, history, segment, parts):
    rows = conversations()
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # conversations are cut by partitions
    try:
        found = own.windows(spark.createDataFrame(rows, SCHEMA).repartition(4), BYTES, budget=budget, history=history, segment=segment).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv, turns in by_conversation(spark, rows).items():
        got = sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.segment, r.window))
        want = plain_windows(turns, count, budget, history, segment)
        assert [(r.segment, r.window, r.first_turn, r.n_turns, r.n_repeated) for r in got] == [
            (s, w, first, new, past + system) for s, w, first, new, past, system in want]
        for r, (_, _, first, new, past, system) in zip(got, want):
            shown = turns[:1] * system + turns[first - past:first + new]
            assert [(role, text) for role, text, *_ in own.parse(r.text)] == shown
            said = [own.escape(text) for role, text in turns[first:first + new] if role == "assistant"]
            assert [r.text[s:s + n] for s, n in zip(r.loss_starts, r.loss_sizes)] == said
            assert r.tokens <= budget or r.n_turns == 1
            assert r.tokens == count.start + sum(count.turn(*t) for t in shown)


def digest(turns):
    loss = "".join(text for role, text in turns if role == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_digests_are_those_of_the_input(spark):
    rows = conversations()
    found = own.digests(own.windows(spark.createDataFrame(rows, SCHEMA), BYTES, budget=100, history=30, segment=2)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == {conv: digest(turns) for conv, turns in by_conversation(spark, rows).items()}
    assert len(found) == len({r[0] for r in rows})


def test_query_over_the_given_conversations(spark):
    sf_dir = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = [(*r, "", "") for r in given.collect()] + [(-7, 0, "user", said, "", ""), (-7, 1, "assistant", said, "", "")]
    found = queries.chat(spark, sf_dir).collect()
    want = {conv: digest(turns) for conv, turns in by_conversation(spark, rows).items()}
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == want
    written = own.windows(spark.createDataFrame(rows, SCHEMA), BYTES).collect()
    assert {r.conv_id: r.formatted_chars for r in found} == {c: sum(len(r.text) for r in written if r.conv_id == c) for c in want}


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(2)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "\\.", ".", "<", "[", "/", ">", "x", "\n", ""]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        escaped = own.escape(text)
        assert own.unescape(escaped) == text and not own.CONTROL.search(escaped)
        role, after = rng.choice(["user", "assistant", "system", text]), own.around("user")
        before, behind = own.around(role)
        window = own.START + before + escaped + behind + after[0] + "next" + after[1]
        assert [(r, t) for r, t, *_ in own.parse(window)] == [(role, text), ("user", "next")]


def test_empty_table_and_bad_settings(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert own.windows(empty, BYTES).collect() == [] and own.digests(own.windows(empty, BYTES)).collect() == []
    with pytest.raises(ValueError):
        own.windows(empty, BYTES, budget=10, history=10)
