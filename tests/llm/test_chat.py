import random
from hashlib import sha256

from pyspark.sql import functions as F

from floodmark.llm import chat


def test_escapes_are_reversible():
    rng = random.Random(1)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "/INST]", "a", "é", "\n", "<\\s>", "<\\\\/s>"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "", "<s>x"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        text, mask = chat.formatted(turns)
        assert chat.read_back(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def expected(conv, turns):
    told = sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return conv, len(turns), told, len(loss), sha256(loss.encode()).hexdigest()


def test_query(spark, tmp_path):
    rng = random.Random(2)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} <s> é") for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "assistant", "x" * (t % 3)) for t in range(700)]
    rows += [(60, 1, None, None), (60, None, "user", "no turn"), (61, 0, "assistant", ""), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    rows += [(62, 0, "user", "same")] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[:5] for r in chat.op1_chat_formatting(spark, str(tmp_path)).collect()}
    hard = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", hard), (-1, 1, "assistant", hard)]
    want = {}
    for c in {r[0] for r in rows}:
        mine = sorted(((-1 if t is None else t, r or "", x or "") for k, t, r, x in rows if k == c))
        want[c] = expected(c, [(r, x) for _, r, x in mine])
    assert got == want


def test_trees(spark):
    rows = [
        (1, 10, None, 1.0), (1, 11, 10, 0.0), (1, 12, 10, 3.0), (1, 13, 12, 3.0), (1, 14, 12, 5.0),
        (2, 20, 99, 1.0), (3, 30, 31, 0.0), (3, 31, 30, 0.0), (3, 32, 31, 9.0), (4, 40, None, None),
    ]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    messages = messages.withColumns({"role": F.lit("user"), "text": F.col("node").cast("string")})
    got = sorted((r.tree, r.rank, [t for _, t in chat.read_back(r.text)]) for r in chat.format_paths(messages, best=2).collect())
    assert got == [(1, 1, ["10", "12", "14"]), (1, 2, ["10", "12", "13"]), (2, 1, ["20"]), (4, 1, ["40"])]


def test_empty(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_paths(chat.chained(rows, "conv_id", "turn", "role", "text")).collect() == []
