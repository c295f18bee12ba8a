"""Dense numbers of turns and the whole way from events to digests, edits and regenerations included."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from portmart.session import ensure_importable

pytest.importorskip("public_tokenizers")
from portmart.llm import chat_format as chat  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digests(messages):
    """conv -> (turns, digest, loss chars, loss digest) of (role, text) lists."""
    out = {}
    for conv, turns in messages.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def found(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_null_negative_and_repeated_turns_stay_apart(spark):
    ensure_importable(spark)
    rows = [(1, None, "user", "a"), (1, -1, "user", "b"), (1, -1, "user", "b"), (1, 0, None, None), (1, 0, "assistant", "c" * 50000),
            (None, 3, "assistant", "x"), (None, None, "user", ""), (2, 1 << 40, "assistant", "</turn>"), (2, 5, "user", "### ")]
    want = {1: [("user", "a"), ("user", "b"), ("user", "b"), ("", ""), ("assistant", "c" * 50000)], None: [("user", ""), ("assistant", "x")],
            2: [("user", "### "), ("assistant", "</turn>")]}
    df = spark.createDataFrame(rows, ROWS).withColumns({"seq": F.lit("x"), "_place": F.lit(1), "message": F.lit(2)}).repartition(4)
    assert found(chat.conversation_digests(chat.turns_as_events(df))) == digests(want)
    assert chat.conversation_digests(chat.turns_as_events(spark.createDataFrame([], ROWS))).count() == 0


def test_one_hot_conversation_is_numbered_over_ranges(spark):
    ensure_importable(spark)
    n = 3000
    rows = spark.range(n).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    events = chat.turns_as_events(rows)
    assert sorted(r[0] for r in events.select("seq").collect()) == list(range(n))
    hot = events.filter("conv_id = 7")
    span = hot.agg(F.min("seq"), F.max("seq"), F.count("seq")).first()
    assert span[1] - span[0] + 1 == span[2] == 2000  # so its blocks hold BLOCK turns each
    turns = {}
    for i in range(n):
        turns.setdefault(7 if i % 3 < 2 else i, []).append(("user" if i % 2 == 0 else "assistant", f"t{i}"))
    assert found(chat.conversation_digests(events)) == digests(turns)


def folded(events):
    """A plain fold of the log, event by event in order of seq."""
    out = {}
    for conv in {e[0] for e in events}:
        state = {}
        for _, seq, message, kind, role, text in sorted((e for e in events if e[0] == conv), key=lambda e: e[1]):
            if kind == "regenerate":
                for later in [m for m in state if m > message]:
                    del state[later]
            if kind == "delta" and message in state:
                state[message][1] += text
            elif message in state:
                state[message][1] = text
            else:
                state[message] = [role, text]
        out[conv] = [tuple(state[m]) for m in sorted(state)]
    return out


@pytest.mark.parametrize("seed, span", [(1, 8), (2, 1200)])
def test_edits_and_regenerations_to_digests(spark, seed, span):
    """Deltas, edits and regenerations, with messages over several blocks, against the plain fold."""
    ensure_importable(spark)
    rng = random.Random(seed)
    events, seq = [], 0
    for conv in range(4):
        numbers = sorted(rng.sample(range(span), 8))
        role = {m: "user" if i % 2 == 0 else "assistant" for i, m in enumerate(numbers)}
        for _ in range(120):
            seq += rng.randrange(1, 9)
            m = rng.choice(numbers)
            events.append((conv, seq, m, rng.choice(["delta"] * 6 + ["edit", "regenerate"]), role[m], rng.choice(["a", "###", "</turn>", "\\", "é", ""])))
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")
    assert found(chat.conversation_digests(df.repartition(3))) == digests(folded(events))
