import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat

PARTS = f"array<{chat.PART}>"
SCHEMA = f"conv_id bigint, turn bigint, role string, parts {PARTS}, at int, formatted string, conv string"
bits = st.sampled_from(["<", "|", "\\", "[", "]", "INST]", "/INST]", "s>", "</s>", "<|end|>", "<|body|>", "<|turn|>", "<SYS>>", "a", "\n", "é", "$1"])


def text(t):
    return [("text", t, None, None)]


@settings(max_examples=300, deadline=None)
@given(st.lists(bits, max_size=12).map("".join))
def test_escape_is_reversible(t):
    escaped = re.sub(chat._ESCAPE, r"\1\\\2\3", t)
    assert re.sub(chat._UNESCAPE, r"\1\2\3", escaped) == t
    assert not re.search(rf"[<\[]({chat._CONTROL})", escaped)


def test_read_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|body|>", "<\\|end|>", "", None, "é" * 5000, "<<|", "$1 \\2"]
    rows = []
    for c in range(6):
        for t in range(c):
            rows.append((c, t, ["user", "assistant", "system", None, "<|end|>"][t % 5], text(nasty[(c + t) % len(nasty)]), 1, "x", "y"))
    rows += [(50, 1, "assistant", text("b"), 1, "x", "y"), (50, 1, "assistant", text("a"), 1, "x", "y")]
    rows += [(50, None, "assistant", None, 1, "x", "y"), (50, 1, "assistant", text("a"), 1, "x", "y"), (None, 1, "user", text("n"), 1, "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    want = {}
    for c, t, role, parts, *_ in rows:
        said = (parts[0][1] or "") if parts else ""
        want.setdefault(c, []).append(((t is not None, t or 0), role or "", said))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        loss = "".join(s for _, role, s in turns if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_attachments(spark):
    parts = [
        ("text", "see ", None, None), ("image", "a cat", "s3-like/ref.png", 4), ("audio", None, "b.wav", 50),
        ("document", None, "c.pdf", None), ("movie", "unknown", "d", 9), (None, "z", None, None),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts, 1, "", "")], SCHEMA)
    row = chat.format_chats(df).first()
    assert row["formatted"] == "<|turn|>user<|body|>see <|image|>a cat<|audio|><|document|>unknownz<|end|>"
    assert [(a["turn_at"], a["part"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (1, 1, "image", "s3-like/ref.png", 1024), (1, 2, "audio", "b.wav", 50), (1, 3, "document", "c.pdf", 1)
    ]
    assert row["expanded_tokens"] == 1075 and row["loss_spans"] == []


def test_parts_do_not_form_control_strings_together(spark):
    """Any split of any text into parts reads back as the text, placeholders between them too."""
    draw = random.Random(11)
    pieces = ["<", "|", "end", "|>", "<|end|>", "<|bo", "dy|>", "\\", "[", "INST]", "/INST]", "s>", "/", "a", "\x00", "t", "\x00m", "image", "\x00e", "é", "\n"]
    rows, want = [], {}
    for c in range(400):
        parts, said = [], ""
        for _ in range(draw.randint(0, 8)):
            t = "".join(draw.choices(pieces, k=draw.randint(0, 3)))
            if draw.random() < 0.2:
                parts.append(("image", t, "r", 1))
                said += f"<|image|>{t}"
            else:
                parts.append((draw.choice(["text", None, "odd"]), t if t or draw.random() < 0.5 else None, None, None))
                said += t
        rows.append((c, 0, "assistant", parts, 1, "", ""))
        want[c] = said
    rows.append((1000, 0, "assistant", [("text", "a<", None, None), ("text", "|end|>b", None, None)], 1, "", ""))
    want[1000] = "a<|end|>b"
    chats = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    for r in chat.read_back(chats).collect():
        said = want[r["conv"]]
        assert r["n_turns"] == 1 and r["loss_chars"] == len(said), said
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_native_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = chat.read_back(chat.format_chats(df))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    spans = chat.format_chats(spark.createDataFrame([(1, 0, "assistant", text("[INST]"), 1, "", "")], SCHEMA))
    r = spans.select(F.expr("substring(formatted, loss_spans[0].start + 1, loss_spans[0].length)")).first()
    assert r[0] == "[\\INST]"
