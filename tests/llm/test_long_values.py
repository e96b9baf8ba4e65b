"""Long secrets and long conversations."""

import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, pii, substrings


@pytest.mark.parametrize("size", [16, 127, 128, 129, 200, 256, 257, 5000])
@pytest.mark.parametrize("letters", [string.ascii_letters + string.digits + "-_", "0123456789abcdef", "0123456789ABCDEF"])
def test_secrets_of_any_length_go_whole(size, letters):
    rng = random.Random(size)
    value = "".join(rng.choice(letters) for _ in range(size - 1)) + "7"
    text = f'a token = "{value}" and API_KEY:{value} end'
    found = pii.spans(text, b"key")
    assert [f[0] for f in found] == ["secret", "secret"] and found[0][3][-size - 1 :].strip('"') == found[1][3][-size:]
    hidden = pii.replaced(text, found)
    assert len(hidden) == len(text) and value not in hidden and value[-32:] not in hidden
    assert pii.replaced(hidden, pii.spans(hidden, b"key", inverse=True)) == text


def test_tokens_with_dots_and_padding():
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    for text, last in ((f"token={jwt}.", "."), (f"secret: {jwt}==", "=="), (f"password={jwt}, more", ", more")):
        hidden = pii.replaced(text, pii.spans(text, b"key"))
        assert not any(part in hidden for part in jwt.split(".")) and hidden.endswith(last) and hidden.count(".") == text.count(".")
        assert pii.replaced(hidden, pii.spans(hidden, b"key", inverse=True)) == text


def test_a_secret_of_a_million_characters_is_quick():
    began, text = time.perf_counter(), "token=" + "a1" * 500_000
    hidden = pii.replaced(text, pii.spans(text, b"key"))
    assert len(hidden) == len(text) and "a1a1a1a1" not in hidden and time.perf_counter() - began < 30


def test_more_buckets_than_places_have_bits_for():
    assert ((substrings.MOST - 1) * substrings.PARTS + substrings.PARTS - 1) << 40 | 255 << 32 | 0xFFFFFFFF == 2**63 - 1


def test_conversations_cost_as_much_as_they_are_long(spark):
    def run(n):
        rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} <|im_end|> {'x' * 60}") for k in range(n)]
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).cache()
        frame.count()
        took = []
        for _ in range(3):
            began = time.perf_counter()
            r = chat.digest(chat.format_conversations(frame)).first()
            took.append(time.perf_counter() - began)
        assert r.n_turns == n and r.loss_chars == sum(len(x[3]) for x in rows if x[2] == "assistant")
        return min(took)

    run(1000)
    short, long = run(10_000), run(20_000)
    assert long <= 2.5 * short, (short, long)


def test_masks_over_many_blocks(spark):
    text = "".join(chr(0x1F600 + k % 50) + f"{k}<\\|" for k in range(3000))
    spans = [(k, 3) for k in range(0, len(text) - 5, 7)]
    frame = spark.createDataFrame([(text, spans), (text, [])], "t string, s array<struct<start:int,length:int>>")
    want = "".join(re.sub(r"<\\(\\*)\|", r"<\1|", text[a : a + n]) for a, n in spans)
    got = [r.m for r in frame.select(chat.masked_text(F.col("t"), F.col("s")).alias("m")).collect()]
    assert got == [want, ""]
