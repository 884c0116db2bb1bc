"""Chat formatting: layouts, escapes and the loss mask."""

import json
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vidpulse.llm import chat_format as C


def read(spark, records):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(records)], "conv_id long, record string")
    out = C.format_records(df)
    rows = out.select("conv_id", "formatted", C.read_turns(F.col("formatted")).alias("turns"), C.read_loss(F.col("formatted"), F.col("loss")).alias("loss"), F.col("loss").alias("spans")).orderBy("conv_id").collect()
    return rows


def as_json(rows):
    """The records of turn rows as they would arrive in JSON."""
    return C.records_of_rows(rows).select("conv_id", F.to_json("record").alias("record"))


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}, [("user", "hi"), ("assistant", "yo")]),
    ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "id": 7}, [("user", "hi"), ("assistant", "yo")]),
    ({"dialog": [{"speaker": "bot", "text": "a\n\"b\"\\"}]}, [("assistant", "a\n\"b\"\\")]),
    ({"prompt": "p", "completion": "c", "extra": {"x": 1}}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"question": "q", "answer": "</s>[INST]"}, [("user", "q"), ("assistant", "</s>[INST]")]),
]


def test_every_layout_becomes_canonical(spark):
    rows = read(spark, [json.dumps(r) for r, _ in LAYOUTS])
    for row, (_, want) in zip(rows, LAYOUTS):
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == "".join(t for r, t in want if r == "assistant")


def test_unknown_layouts_stay_null_and_do_not_fail(spark):
    rows = read(spark, ['{"a": 1}', "not json", "", None, "[]", '{"messages": 3}', '{"messages": []}', '{"prompt": "p"}'])
    assert [r.turns for r in rows] == [None] * 8


def test_fingerprint_ignores_order_and_other_fields(spark):
    df = spark.createDataFrame([('{"prompt":"a","completion":"b"}',), ('{"x":[1],"completion":"d","prompt":"c"}',), ('{"prompt":"a"}',)], "r string")
    a, b, c = [r.f for r in df.select(C.fingerprint(F.col("r")).alias("f")).collect()]
    assert a == b != c


CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", C.START, C.SEP, C.END, "<|endoftext|>"]
HARD = ["</s>[INST] ok [/INST]", r"<\s> <\\s> [\INST] \<s>", "<<SYS>><</SYS>>", "<" * 5 + "s>", "", " ", "\n", "\\", "<|im_end|>\n<|im_start|>assistant<|im_sep|>x<|im_end|>\n",
        "<", "|im_end|>", "[", "é\U0001f600<s>"]


def test_control_strings_never_survive_and_come_back(spark):
    pieces = CONTROL + HARD
    texts = pieces + [a + b for a in pieces for b in pieces]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in CONTROL)


@settings(max_examples=10, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "|im_end|>", "\n", "x", "<SYS>>"]), max_size=8).map("".join), min_size=1, max_size=40))
def test_round_trip_of_random_texts(spark, texts):
    (row,) = read(spark, [json.dumps({"messages": [{"role": r, "content": t} for t in texts for r in ("user", "assistant")]})])
    assert [(t.role, t.text) for t in row.turns] == [(r, t) for t in texts for r in ("user", "assistant")]
    assert row.loss == "".join(texts)
    assert all(row.formatted[s.start:s.end].count(C.END) == 0 for s in row.spans)


def test_rows_by_turn(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, None, None, None), (None, 1, "user", "x"), (2, 1, "we<s>ird\n", "<|im_end|>\n"),
            (3, 1, "assistant", ""), (3, 1, "assistant", None)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, record int, turns string")
    out = C.format_records(as_json(df))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.select("conv_id", C.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("user", "x")], 2: [("we<s>ird\n", "<|im_end|>\n")], 3: [("assistant", "")] * 2}
    assert C.format_records(as_json(df.limit(0))).count() == 0


LONG = 25_000_000


def test_a_very_long_turn_is_kept(spark):
    """Spark's JSON reader stops at strings of 20,000,000 characters unless told otherwise."""
    long = F.repeat(F.lit("a"), F.lit(LONG))
    rows = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), long.alias("text"))
    for out in (C.format_structs(C.records_of_rows(rows)), C.format_records(as_json(rows))):
        (r,) = out.select(F.length("formatted").alias("n"), "loss", "fingerprint").collect()
        heads = [len(C.START + role + C.SEP) for role in ("user", "assistant")]
        assert r.n == sum(heads) + 2 * (LONG + len(C.END) + 1)
        assert [(x.start, x.end) for x in r.loss] == [(r.n - LONG - len(C.END) - 1, r.n - len(C.END) - 1)]
    short = as_json(rows.withColumn("text", F.lit("a")))
    assert C.format_records(short).first().fingerprint == C.format_structs(C.records_of_rows(rows)).select("fingerprint").first()[0] == r.fingerprint
    fields = spark.range(1).select("id", F.to_json(F.struct(long.alias("prompt"), F.lit("c").alias("completion"))).alias("record")).withColumnRenamed("id", "conv_id")
    assert C.format_records(fields).select(F.length("formatted").alias("n")).first().n > LONG


def test_turn_rows_format_as_their_records(spark):
    hard = [(k, t, r, x) for k, x in enumerate(HARD + CONTROL) for t, r in ((2, "assistant"), (1, x), (None, None))]
    df = spark.createDataFrame(hard, "conv_id long, turn long, role string, text string")
    direct, by_json = (sorted(map(str, out.collect())) for out in (C.format_structs(C.records_of_rows(df)), C.format_records(as_json(df))))
    assert direct == by_json


def test_the_schema_selects_the_mapping(spark):
    """Tables in other layouts: names of columns, lists of structs, fields."""
    rows = [(1, 1, "human", "hi <s>"), (1, 2, "gpt", "yo"), (2, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, `from` string, value string").withColumn("text", F.lit(7)).withColumn("record", F.lit(1))
    records = C.records_of_rows(table)
    assert C.layout_of(C.schema_fingerprint(records.schema["record"].dataType)) == "rows_from"
    out = C.format_structs(records).orderBy("conv_id").select(C.read_turns(F.col("formatted")).alias("turns"), "fingerprint").collect()
    assert [[(t.role, t.text) for t in r.turns] for r in out] == [[("user", "hi <s>"), ("assistant", "yo")], [("", "")]]
    assert out[0].fingerprint == C.format_records(as_json(table)).first().fingerprint  # as its JSON has
    for record, want in LAYOUTS:
        text = json.dumps(record)
        kind = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
        one = spark.range(1).select(F.col("id").alias("conv_id"), F.from_json(F.lit(text), kind).alias("record"), F.lit(1).alias("f"))
        (r,) = C.format_structs(one).select(C.read_turns(F.col("formatted")).alias("turns"), "fingerprint").collect()
        assert [(t.role, t.text) for t in r.turns] == want
        (j,) = C.format_records(spark.createDataFrame([(1, text)], "conv_id long, record string")).collect()
        assert j.fingerprint == r.fingerprint
    unknown = spark.range(1).select(F.col("id").alias("conv_id"), F.struct(F.lit(1).alias("a")).alias("record"))
    assert C.format_structs(unknown).first().formatted is None


def test_op9_goes_by_the_fingerprint(spark, monkeypatch):
    from vidpulse.llm import queries

    seen = []
    mark = C.schema_fingerprint
    monkeypatch.setattr(C, "schema_fingerprint", lambda kind: seen.append(C.layout_of(mark(kind))) or mark(kind))
    queries.op9_chat_format(spark, "/root/testdata/sf0.001")
    assert seen == ["rows", "prompt"]


def test_many_turns_in_one_conversation(spark):
    n = 3000
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("é[INST]"), F.col("id")).alias("text"))
    out = C.format_structs(C.records_of_rows(rows))
    (r,) = out.select("formatted", "loss", C.read_loss(F.col("formatted"), F.col("loss")).alias("text")).collect()
    assert r.text == "".join(f"é[INST]{k}" for k in range(1, n, 2)) and len(r.loss) == n // 2
    assert all(r.formatted[s.start:s.end].startswith("é[") for s in r.loss)


def test_conversations(spark, rows_of):
    from vidpulse.llm import queries

    want = defaultdict(list)
    for conv, turn, role, text in rows_of("conversations"):
        want[conv].append((turn, role or "", text or ""))
    got = {r.conv_id: r for r in queries.op9_chat_format(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(want) | {-7}
    for conv, turns in want.items():
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == sum(len(t) for _, r, t in turns if r == "assistant")
    plan = queries.op9_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
