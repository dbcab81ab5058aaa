import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxorule.llm import chat as C


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    return C.format_chat(df.withColumn("parts", C.text_part(F.col("text"))))


def test_round_trip_of_control_strings(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n", "\\", "\\0\\1", "### user: ", "<image:1>", "", "a\nb", "é😀"]
    rows = [(1, i, "assistant" if i % 2 else "us:er</turn>", t, 0) for i, t in enumerate(nasty)]
    got = chats(spark, rows).select("*", C.parse_turns(F.col("formatted")).alias("t"),
                                    C.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [(x.role, x.text) for x in got.t] == [(r[2], r[3]) for r in rows]
    assert got.loss == "".join(r[3] for r in rows if r[2] == "assistant")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="\\<>#:/tur n0123é\n", max_size=12), min_size=1, max_size=6))
def test_round_trip_property(spark, texts):
    rows = [(1, i, "assistant", t, 0) for i, t in enumerate(texts)]
    got = chats(spark, rows).select(C.parse_turns(F.col("formatted")).alias("t")).first()
    assert [x.text for x in got.t] == texts


def test_digest_ties_nulls_and_empty(spark):
    rows = [(1, 0, "user", "b", 0), (1, 0, "user", "a", 0), (1, None, None, None, 0), (None, 1, "assistant", "x", 0)]
    got = {r.conv_id: r for r in C.chat_digest(chats(spark, rows)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nuser\na\nuser\nb\n").hexdigest()
    assert got[None].loss_sha256 == hashlib.sha256(b"x").hexdigest()
    assert C.chat_digest(chats(spark, rows).limit(0)).count() == 0


def test_typed_parts_become_placeholders(spark):
    df = spark.sql("""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(
        named_struct('type','text','text','look: <here>','ref',cast(null AS string),'tokens',cast(null AS bigint)),
        named_struct('type','image','text',null,'ref','s3://a.png','tokens',256L),
        named_struct('type','audio','text',null,'ref','b.wav','tokens',cast(null AS bigint)),
        named_struct('type',null,'text','end','ref',null,'tokens',null)) AS parts""")
    got = C.format_chat(df).first()
    assert got.formatted == "### user: look\\3 \\1here><image:2><audio:3>end</turn>\n"
    assert [(a.ordinal, a.type, a.ref, a.tokens) for a in got.attachments] == [
        (2, "image", "s3://a.png", 256), (3, "audio", "b.wav", 1)]
    assert got.n_tokens == 2 + 256 + 1 + 1 and got.loss_spans == []


def test_native_plan(spark):
    plan = C.chat_digest(chats(spark, [(1, 0, "u", "t", 0)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
