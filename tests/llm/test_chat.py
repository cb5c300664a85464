"""Chat formatting: exact round trip, placeholders, loss spans."""

import math
import random
import time

from pyspark.sql import functions as F

from feedlake.llm import chat

SCHEMA = f"conv_id long, turn long, role string, content array<{chat.PART}>"


def formatted(spark, rows):
    out = chat.format_chat(spark.createDataFrame(rows, SCHEMA))
    return out.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(4)
    bits = ["\\", "|", "<", ">", "<|end|>", "<|turn|>", "\n", "n", "<|end|>\n", "\\|", "\\n", "é", "assistant", "<|image:1|>", ""]
    rows, want = [], {}
    for conv in range(60):
        want[conv] = []
        for turn in range(rnd.randint(1, 5)):
            role = rnd.choice(["user", "assistant", "", "a\nb", "\\n", "x|\\"])
            text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
            parts = [("text", text[:3], None, None), ("text", text[3:], None, None)]
            rows.append((conv, turn, role, parts))
            want[conv].append((role, text))
    rnd.shuffle(rows)
    for r in formatted(spark, rows):
        assert [(t["role"], t["text"]) for t in r["turns"]] == want[r["conv_id"]]
        assert r["masked"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        spans = [r["formatted"][s["start"]:s["end"]] for s in r["loss_spans"]]
        assert "".join(s.replace("\\|", "|").replace("\\\\", "\\") for s in spans) == r["masked"]


def test_visitor_and_defined_cases(spark):
    rows = [
        (1, 0, "user", [("text", "see ", None, None), ("image", None, "a.png", 1.5), ("audio", "ignored", "b.wav", 3.0), ("document", None, None, None),
                        ("strange", "kept", None, None), None, ("text", None, None, None)]),
        (1, 1, "assistant", [("text", "ok", None, None)]), (1, 1, "assistant", [("text", "ok", None, None)]),
        (2, None, None, None), (2, 0, "user", []), (None, 0, "user", [("image", None, "c", 1.0)]),
    ]
    got = {r["conv_id"]: r for r in formatted(spark, rows)}
    assert got[1]["turns"][0]["text"] == "see <|image:1|><|audio:2|><|document:3|>kept"
    assert [(a["turn_index"], a["type"], a["ref"], a["tokens"]) for a in got[1]["attachments"]] == [
        (0, "image", "a.png", 384), (0, "audio", "b.wav", 75), (0, "document", None, 0)]
    assert got[1]["expanded_tokens"] == 459 and got[1]["masked"] == "okok" and len(got[1]["turns"]) == 3
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", ""), ("user", "")]
    assert got[None]["expanded_tokens"] == 256
    assert formatted(spark, []) == []


def brute_body(parts):
    """(text as read back, attachments) of a message."""
    out, found = "", []
    for p in parts or []:
        kind, text, ref, units = p or (None,) * 4
        if kind in chat.TOKENS_PER_UNIT:
            found.append((f"<|{kind}:{len(found) + 1}|>", kind, ref, math.ceil(chat.TOKENS_PER_UNIT[kind] * (units or 0))))
            out += found[-1][0]
        else:
            out += text or ""
    return out, found


def test_mixed_parts_of_the_whole_table(spark):
    """Every turn of conversations, cut into parts with attachments between them, against a plain loop."""
    rows, rnd, want = [], random.Random(8), {}
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    for i, r in enumerate(table):
        parts, text = [], r["text"] or ""
        while text:
            n = rnd.randint(1, 60)
            parts.append((rnd.choice(["text", "text", None, "odd"]), text[:n] + rnd.choice(["", "<", "|", "\\", "é", "\U0001f600"]), None, None))
            text = text[n:]
            if rnd.random() < 0.4:
                parts.append((rnd.choice(list(chat.TOKENS_PER_UNIT)), "not shown", f"ref{rnd.random()}", rnd.choice([None, 0.5, 3.0])))
            if rnd.random() < 0.1:
                parts.append(None)
        rows.append((r["conv_id"], i, r["role"], parts))  # the table's row number makes the order of turns total
        want.setdefault(r["conv_id"], []).append((r["role"] or "", *brute_body(parts)))
    assert sum(len(found) for turns in want.values() for _, _, found in turns) > 100
    got = formatted(spark, rows)
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [t[:2] for t in turns]
        assert [tuple(a) for a in r["attachments"]] == [(i, *a) for i, t in enumerate(turns) for a in t[2]]
        assert r["expanded_tokens"] == sum(a[3] for t in turns for a in t[2])
        assert r["masked"] == "".join(body for role, body, _ in turns if role == "assistant")


def test_many_parts_and_many_turns_take_linear_time(spark):
    """40,000 parts in one message, then 20,000 turns in one conversation."""
    parts = [("image", None, "x", 1.0), ("text", "ab", None, None)] * 20_000
    turns = [(2, i, "assistant" if i % 2 else "user", [("text", f"turn {i} é", None, None)]) for i in range(20_000)]
    formatted(spark, [(0, 0, "user", parts[:2])])  # compiles the plan
    start = time.perf_counter()
    got = {r["conv_id"]: r for r in formatted(spark, [(1, 0, "user", parts), *turns])}
    assert time.perf_counter() - start < 30
    assert len(got[1]["attachments"]) == 20_000 and got[1]["turns"][0]["text"].endswith("<|image:20000|>ab")
    assert got[2]["masked"] == "".join(f"turn {i} é" for i in range(1, 20_000, 2))
