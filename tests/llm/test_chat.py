import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexispark.llm import chat

TEXTS = st.lists(st.sampled_from(["</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<SEP>>", "\\", "[\\INST]", "<\\\\/s>", " ", "a", "é", "\n", "<", "["]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]), TEXTS), max_size=5))
def test_round_trip_of_hostile_texts(turns):
    pieces = [chat.render(r, t) for r, t in turns]
    assert chat.parse("".join(p for p, _, _ in pieces)) == turns
    for (p, lo, hi), (_, text) in zip(pieces, turns, strict=True):
        assert chat.unescape(p[lo:hi]) == text


def test_plain_texts_are_not_escaped_and_the_parser_is_strict():
    assert chat.render("user", "hi")[0] == "[INST] hi [/INST]"
    assert chat.render("assistant", "")[0] == "<s>  </s>"
    for bad in ("hi", "[INST] hi", "[INST] a <s> b [/INST]"):
        with pytest.raises(ValueError):
            chat.parse(bad)


def rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def test_digests_against_brute_force(spark):
    data = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"), (2, None, None, None), (2, 0, "assistant", "é" * 9), (None, 3, "user", "[INST]"), (3, 0, "assistant", "long " * 40_000)]
    data += [(4, 0, "user", t) for t in ("a\nb", "a", "a\tb", "a!", "a [INST]", "a [\\INST]", "a </s>", "", "a ", "é", "\U0001f600", "\uffee")]
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(rows(spark, data))).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv, r in found.items():
        own = sorted((x for x in data if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, (x[2] or "").encode(), (x[3] or "").encode()))
        turns = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= len(loss)


def test_empty_table_and_extra_columns(spark):
    from pyspark.sql import functions as F

    assert chat.read_back(chat.format_turns(rows(spark, []))).count() == 0
    extra = rows(spark, [(1, 0, "user", "x")]).select("*", F.lit("x").alias("rendered"), F.lit("y").alias("loss_from"))
    assert chat.read_back(chat.format_turns(extra)).first().n_turns == 1
