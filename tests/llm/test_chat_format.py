import hashlib

from partwise.llm import chat_format as cf
from pyspark.sql import functions as F

TURNS = [
    (1, 2, "assistant", "second \\ <|end|> tricky"), (1, 1, "user", "hi <|body|>"), (2, 1, "user", None), (2, 2, None, "x"), (2, 2, "assistant", ""), (3, None, "assistant", "no turn"),
    (None, 1, "assistant", "no id"), (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"), (4, 1, "assistant", "a\\<|"), (4, 1, "assistant", "a\\<|"),
]


def frame(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, body string")


def formatted(df):
    return cf.format_conversations(df.select("conv_id", "turn", "role", cf.text_parts(F.col("text")).alias("parts"), "body"))


def test_texts_come_back_and_loss_is_the_assistant(spark):
    found = {r.conv_id: r for r in cf.read_back(formatted(frame(spark))).collect()}
    for conv in {t[0] for t in TURNS}:
        rows = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in found[conv].turns] == [(t[2] or "", t[3] or "") for t in rows]
        assert found[conv].loss_text == "".join(t[3] or "" for t in rows if t[2] == "assistant")
    digest = {r.conv_id: r for r in cf.digests(formatted(frame(spark))).collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert digest.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and digest.n_turns == 2
    assert cf.digests(formatted(frame(spark, []))).collect() == []


def test_visitor_numbers_attachments_and_counts_tokens(spark):
    parts = "array(named_struct('type','text','text','see <|image:0|> ','ref',null,'units',0), named_struct('type','image','text',null,'ref','r1','units',7), named_struct('type','text','text',' and ','ref',null,'units',0), named_struct('type','document','text',null,'ref','r2','units',2), named_struct('type','audio','text',null,'ref','r3','units',null))"
    df = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.expr(parts).alias("parts"))
    r = cf.format_conversations(df).first()
    assert r.formatted == "<|turn|>assistant<|body|>see <\\|image:0|> <|image:0|> and <|document:1|><|audio:2|><|end|>"
    assert [(a.place, a.type, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "r1", 7), (1, "document", "r2", 512), (2, "audio", "r3", 0)] and r.media_tokens == 519
