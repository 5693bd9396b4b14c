import hashlib

from pyspark.sql import types as T

from transitlake.llm import chat

TURNS = "conv_id long, turn long, role string, text string"
HARD = ["\\### Assistant: </turn> ok", "<turn:user>", "\\l\\b\\g \\\\l", "a\nb</turn>\n<turn:x>", "", "é🙂>", "\\"]


def digests(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def formatted(spark, rows):
    return chat.format_chats(chat.log_of(spark.createDataFrame(rows, TURNS)))


def test_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, 0, None, None), (2, 1, "assistant", None), (3, 5, "as<si>st\\ant", "x"), (None, 0, "assistant", "null conversation")]
    rows += [(4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a"), (5, 0, "user", "long " * 40_000)]
    got = {r["conv_id"]: r for r in chat.digests(formatted(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for c, r in got.items():
        turns = sorted([x[1:] for x in rows if x[0] == c], key=lambda x: (x[0], x[1] or "", x[2] or ""))
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digests([x[1:] for x in turns])


def test_mask_points_at_the_texts(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    out = formatted(spark, rows).first()
    assert out["formatted"].count("</turn>\n") == len(HARD)
    for (_, _, role, text), m in zip(rows, out["mask"]):
        piece = out["formatted"][m["start"]:m["start"] + m["length"]]
        assert piece.replace("\\g", ">").replace("\\l", "<").replace("\\b", "\\") == text
        assert m["loss"] == (role == "assistant")


def test_edits_and_regenerations(spark):
    log = spark.createDataFrame([
        (1, 5, 2, "delta", "assistant", "lo"), (1, 4, 2, "delta", "assistant", "Hel"), (1, 1, 1, "delta", "user", "hi"),
        (1, 6, 2, "regenerate", "assistant", "ignored"), (1, 7, 2, "delta", "assistant", "Good "), (1, 8, 2, "delta", None, "day"),
        (1, 9, 1, "edit", "user", "hello"), (1, 10, 1, "delta", "user", "!"), (1, 11, 3, "regenerate", "assistant", None)],
        "conv_id long, seq long, message long, kind string, role string, text string")
    out = [(r["message"], r["role"], r["text"]) for r in sorted(chat.fold(log).collect())]
    assert out == [(1, "user", "hello!"), (2, "assistant", "Good day"), (3, "assistant", "")]


def test_empty_table_and_other_columns(spark):
    assert chat.digests(formatted(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "x", 3, "e")], T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("seq", T.IntegerType()), T.StructField("mask", T.StringType())]))
    assert chat.digests(chat.format_chats(chat.log_of(rows))).first()["n_turns"] == 1
