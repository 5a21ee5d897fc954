"""Chat formatting: round trips, digests against direct hashing, typed parts, odd rows."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.llm import chat_format as C
from helixframe.llm import queries

SF = "/root/testdata/sf0.001"
TEXT = st.lists(st.sampled_from(list("<|\\nim_end>start a\né") + ["<|im_end|>", "<|im_start|>", "\\|"]), max_size=30).map("".join)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_hides_control_strings(text):
    for kind in (C.escape, C.escape_line):
        assert C.unescape(kind(text)) == text
        assert "<|" not in kind(text)
    assert "\n" not in C.escape_line(text)


@given(TEXT, TEXT)
@settings(max_examples=200, deadline=None)
def test_a_formatted_turn_parses_back(role, text):
    assert C.parse_turn(f"{C.START}{C.escape_line(role)}\n{C.escape(text)}{C.END}\n") == (role, text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_direct_hashing(spark):
    got = {r.conv_id: r for r in queries.op1_chat_format(spark, SF).collect()}
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    tricky = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [("user", tricky), ("assistant", tricky)]
    assert set(got) == set(turns)
    for conv, said in turns.items():
        loss = "".join(t for r, t in said if r == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))


def test_no_control_string_forms_across_parts():
    """Every way to cut control strings and placeholders in two or three parts, also around empty and unknown ones."""
    def part(kind, text):
        return {"type": kind, "text": text, "ref": "r", "width": None, "height": None, "seconds": None, "pages": None}
    for whole in (C.START, C.END, "<|audio_9|>", "x <|im_end|> b", "<<||", "\\<|\\n|<|"):
        for i in range(len(whole) + 1):
            for j in range(i, len(whole) + 1):
                for kinds in (("text", "text", "text"), ("text", "odd", "text"), ("odd", "text", None)):
                    visitor = C.PartVisitor(C.Template())
                    for kind, text in zip(kinds, (whole[:i], whole[i:j], whole[j:]), strict=True):
                        visitor.visit(part(kind, text))
                    body = "".join(visitor.out)
                    assert "<|" not in body and len(body) == visitor.length
                    assert C.parse_turn(f"{C.START}user\n{body}{C.END}\n") == ("user", whole)
    visitor = C.PartVisitor(C.Template())
    for p in (part("text", "<"), part("image", None), part("text", "|audio_9|>")):
        visitor.visit(p)
    assert "".join(visitor.out) == "<<|image_1|>|audio_9|>"


def test_typed_parts_are_flattened_in_order(spark):
    rows = spark.sql(f"""
      SELECT 5L AS conv_id, 0L AS turn, 'user' AS role, 'x' AS formatted, CAST(array(
        struct('text', 'see <|', null, null, null, null, null), struct('image', null, 's3://i', 280, 57, null, null),
        struct('audio', null, 's3://a', null, null, 2.02D, null), struct('video', 'odd', 's3://v', null, null, null, null)
      ) AS array<struct<{C._fields()}>>) AS parts
      UNION ALL SELECT 5L, 1L, null, 'y', CAST(array(struct('document', null, 's3://d', null, null, null, 3))
        AS array<struct<{C._fields()}>>)
      UNION ALL SELECT null, null, 'assistant', 'z', null""")
    out = {(r.conv_id, r.turn_index): r for r in C.format_chat(rows).collect()}
    first, second, empty = out[5, 0], out[5, 1], out[None, 0]
    assert first.formatted == "<|im_start|>user\nsee <\\|<|image_1|><|audio_2|>odd<|im_end|>\n"
    assert [(a.ordinal, a.type, a.ref, a.n_tokens) for a in first.attachments] == [
        (1, "image", "s3://i", 30), (2, "audio", "s3://a", 51), (None, "video", "s3://v", 0)]
    whole = first.formatted + second.formatted
    for a in first.attachments[:2] + second.attachments:
        assert whole[a.at:].startswith(f"<|{a.type}_{a.ordinal}|>")
    assert second.attachments[0].ordinal == 3 and second.n_expanded == 768 and first.n_expanded == 81
    assert empty.formatted == "<|im_start|>assistant\n<|im_end|>\n" and empty.in_loss


def test_repeated_and_tied_turns_are_kept_and_empty_tables_work(spark):
    rows = spark.createDataFrame([(1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "y"), (1, None, None, None)],
                                 "conv_id long, turn long, role string, text string").withColumn("parts", C.text_part(F.col("text")))
    row, = C.read_back(C.format_chat(rows)).collect()
    assert row.n_turns == 4 and row.turns_sha256 == sha("\n\n" + "a\ny\n" * 2 + "b\nx\n")
    assert C.read_back(C.format_chat(rows.limit(0))).count() == 0


def test_a_very_long_conversation_crosses_batches(spark):
    rows = spark.range(25_000).select(F.lit(9).alias("conv_id"), "id", F.lit("assistant").alias("role"),
                                      F.col("id").cast("string").alias("text"))
    row, = C.read_back(C.format_chat(rows.withColumn("parts", C.text_part(F.col("text"))), turn="id")).collect()
    assert row.loss_sha256 == sha("".join(str(i) for i in range(25_000))) and row.n_turns == 25_000
