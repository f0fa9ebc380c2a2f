from pyspark.sql import functions as F

from ringlake.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|says|>x<|end|>", "␛0␛1<␛1|turn|>", "<<SYS>>[INST]", "", "a\nb", "<|<|end|>end|>", "漢🙂<|image|>"]


def test_escaping_is_reversible(spark):
    frame = spark.createDataFrame([(t,) for t in NASTY], "t string").withColumn("e", chat.escaped(F.col("t")))
    for r in frame.withColumn("u", chat.unescaped(F.col("e"))).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_round_trip_and_loss(spark):
    rows = [(c, i, ["user", "assistant", "system", None, "assistant", "<|end|>", "tool", "assistant"][i], NASTY[(i + c) % 8]) for c in range(3) for i in range(8)]
    rows += [(9, None, "user", None), (9, None, "user", None), (9, 1, "assistant", None), (None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seen", "2 AS content")
    out = chat.format_chats(turns, chat.text_part(F.col("text")))
    got = {
        r.conv_id: r
        for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    for c in (0, 1, 2, 9, None):
        wanted = sorted(((-1 if t is None else t), r or "", x or "") for k, t, r, x in rows if k == c)
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in wanted]
        assert got[c].loss == "".join(x for _, r, x in wanted if r == "assistant")


def test_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    parts = [part("text", "see "), part("image", ref="a.png", w=28, h=29), part("text", "<|image|>"), part("audio", ref="b.wav", s=2.5), part("document", ref="c.pdf", p=3), part("image"), part(None, "x")]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    r = chat.format_chats(frame, F.col("parts")).first()
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, 1, "image", "a.png", 6), (0, 3, "audio", "b.wav", 63), (0, 4, "document", "c.pdf", 1800), (0, 5, "image", None, 1),
    ]
    assert r.formatted.count("<|image|>") == 2 and r.expanded_tokens == 6 + 63 + 1800 + 1 + 1 + 3 + 1
    assert chat.format_chats(frame.limit(0), F.col("parts")).count() == 0
