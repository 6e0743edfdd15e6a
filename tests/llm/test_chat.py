import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import chat

PIECES = st.lists(st.sampled_from(
    ["<", "[", "\\", "|", "<|turn|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "a", "\n", "é"]), max_size=12)


@given(PIECES)
def test_escaping_can_be_undone_and_leaves_no_control_string(pieces):
    text = "".join(pieces)
    out = chat.escape(text)
    assert chat.unescape(out) == text
    for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"):
        assert mark not in out


def expected(rows):
    said = [(r or "", t or "") for r, t in rows]
    loss = "".join(t for r, t in said if r == "assistant")
    return (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(23 + len(chat.escape(r)) + len(chat.escape(t)) for r, t in said))


def test_read_back_equals_the_input(spark):
    rng = random.Random(9)
    talks = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")], 1: [(None, None)],
             2: [("assistant", ""), ("assistant", "x" * 200_000)], None: [("user", "no id")]}
    for k in range(10, 60):
        talks[k] = [(rng.choice(["system", "user", "assistant", "a<|body|>b"]),
                     "".join(rng.choice(["<|end|>", "é", " ", "\\", "<", "|", "\n"]) for _ in range(rng.randrange(30))))
                    for _ in range(rng.randrange(1, 30))]
    rows = [(c, n, r, t) for c, talk in talks.items() for n, (r, t) in enumerate(talk)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit(1) for c in ("parts", "segment", "n", "chars", "start")})
    got = chat.read_back(chat.formatted_turns(chat.text_parts(frame))).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {c: expected(t) for c, t in talks.items()}


def test_typed_parts_become_ordered_placeholders(spark):
    part = lambda **k: {"type": None, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k
    parts = [part(type="text", text="see <|image_1|>: "), part(type="image", ref="a.png", width=1024, height=600),
             part(text=" and "), part(type="audio", ref="b.wav", seconds=2.5), part(type="document", ref="c.pdf", pages=3), None]
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, "assistant", None)],
                                 f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    got = sorted(chat.formatted_turns(rows).collect(), key=lambda r: r["n"])
    assert got[0]["segment"] == ("<|turn|>user<|body|>see <\\|image_1|>: <|image_1|> and <|audio_2|><|document_3|><|end|>")
    assert [tuple(a) for a in got[0]["attachments"]] == [
        (1, "image", "a.png", 85 + 170 * 4), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 2400)]
    assert got[0]["expanded_tokens"] == 85 + 680 + 63 + 2400 and got[0]["loss_start"] is None
    assert got[1]["start"] == len(got[0]["segment"])
    assert got[2]["start"] == got[1]["start"] + len(got[1]["segment"])
    assert got[1]["segment"][got[1]["loss_start"]:got[1]["loss_end"]] == ""
    odd = rows.withColumn("parts", F.expr("transform(parts, p -> named_struct('type', 'video', 'text', '', 'ref', '', "
                                          "'width', 0, 'height', 0, 'seconds', 0d, 'pages', 0))"))
    with pytest.raises(Exception, match="no rule for a part"):
        chat.formatted_turns(odd).collect()


def test_repeated_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "b")],
                                  "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.formatted_turns(chat.text_parts(frame))).collect()
    assert [tuple(r)[1:] for r in got] == [expected([("system", "b"), ("user", "a"), ("user", "a")])]
    assert chat.read_back(chat.formatted_turns(chat.text_parts(frame.limit(0)))).count() == 0
