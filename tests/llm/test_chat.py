import hashlib
import random

from pyspark.sql import functions as F

from orderlens.llm import chat, queries

SF = "/root/testdata/sf0.001"


def test_escaping_comes_back(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("<|\\>ni\n a") for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
                    chat.escape_role(F.col("t")).alias("r"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("v")).collect()
    assert all(r.u == r.t and r.v == r.t and "<|" not in r.e and "\n" not in r.r for r in out)


def formatted(spark, rows, cols="conv_id long, turn long, role string, text string, state string, formatted string"):
    df = spark.createDataFrame([(*r, "x", None) for r in rows], cols)
    out = chat.format_conversations(df).withColumn("turns", chat.parse_formatted(F.col("formatted")))
    return {r.conv_id: r for r in out.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}


def test_turns_and_loss(spark):
    rows = [(1, 2, "assistant", "a<|im_end|>\n"), (1, 0, "system", "s"), (1, 1, "user", "u\\"), (1, 3, "user", None), (1, 4, "assistant", ""),
            (2, 0, "assistant", "first"), (3, 0, "user", "q"), (3, None, "user", "no turn"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
            (4, 0, None, "r"), (5, 0, "us\ner", "<|im_start|>"), (6, 0, "user", "l" * 200_000), (6, 1, "assistant", "m"), (7, 0, "user", "d"), (7, 0, "user", "d")]
    got = formatted(spark, rows)
    assert [tuple(t) for t in got[1].turns] == [("system", "s"), ("user", "u\\"), ("assistant", "a<|im_end|>\n"), ("user", ""), ("assistant", "")]
    assert got[1].valid and got[1].loss == "a<|im_end|>\n" and got[1].n_turns == 5
    assert not got[2].valid and got[2].state == "error" and got[2].loss == "first"
    assert [tuple(t) for t in got[3].turns] == [("user", "no turn"), ("user", "q")] and not got[3].valid
    assert got[None].valid and got[4].turns[0].role == "" and got[5].turns[0].role == "us\ner" and got[5].turns[0].text == "<|im_start|>"
    assert got[6].valid and got[7].n_turns == 2 and not got[7].valid
    assert got[1].formatted.count("<|im_start|>") == 5 and got[1].formatted.count("<|im_end|>") == 5
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert formatted(spark, [], "conv_id long, turn long, role string, text string") == {}


def test_query_reads_back_every_conversation(spark):
    convs: dict = {-1: [(0, "user", queries.CONTROL_TEXT), (1, "assistant", queries.CONTROL_TEXT)]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    df = queries.QUERIES["op10_chat_format"](spark, SF)
    got = {r.conv_id: r for r in df.collect()}
    assert got.keys() == convs.keys()
    for i, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert got[i].n_turns == len(turns) and got[i].loss_chars == len(loss)
        assert got[i].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        state = "begin"
        for _, role, _ in turns:
            state = chat.CHATML["transitions"].get(state, {}).get(role, "error")
        assert got[i].state == state and got[i].valid == (state == "assistant")
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert "system>user" in df._jdf.queryExecution().optimizedPlan().toString()  # the machine's transitions
