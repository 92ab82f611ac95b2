import hashlib
import itertools
import re

import pytest
from frames import TEXTS

from tidemark.llm import chat
from tidemark.llm.queries import BYTE_TOKENIZER, CONTROL_TURN, op8_chat
from tidemark.llm.shared import read_table
from tidemark.sources.scratch import settle

SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, start int, place int"
TRICKY = [CONTROL_TURN, "\\", "\\\\###", "</turn>\n### user: x", "a: b\\: c", "<|endoftext|>", "é́🎉\x00", "####"]


def slow(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)) if r[0] == conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        length = sum(len(f"### {chat.escape(r)}: {chat.escape(t)}</turn>\n") for r, t in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out.append((conv, len(turns), sha[0], len(loss), sha[1], length))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_equals_brute_force(spark, sf_dir):
    rows = list(map(tuple, read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()))
    rows += [(-7, 0, "user", CONTROL_TURN), (-7, 1, "assistant", CONTROL_TURN)]
    assert sorted(map(tuple, op8_chat(spark, sf_dir).collect())) == slow(rows)


@pytest.mark.parametrize("text", [t or "" for _, t in TEXTS] + TRICKY)
def test_turns_read_back(text):
    code = chat.coder(BYTE_TOKENIZER)
    ids, start, end = code.turn(text[:50], text)
    assert code.parse(ids) == (text[:50], text)
    assert chat.unescape(code.print(ids[start:end])) == text
    reserved = {code.open, code.middle, code.close}
    assert [i for i in ids if i in reserved] == [code.open, code.middle, code.close]


HEADINGS = ["#### user y", "##### a: b", "x\n###### h ### y ## z # w", "\\#### user", "</turn></turn>: : ####"]


@pytest.mark.parametrize("text", [t or "" for _, t in TEXTS] + TRICKY + HEADINGS)
def test_no_unescaped_control_string_is_printed(text):
    code = chat.coder(BYTE_TOKENIZER)
    ids, start, end = code.turn(text[:50], text)
    for part in (ids[1 : ids.index(code.middle)], ids[start:end]):
        printed = code.print(part)
        # Each character behind a backslash is taken out, so what is left stands for itself.
        left = re.sub(r"\\.", "\0", printed, flags=re.DOTALL)
        assert not any(c in left for c in ("### ", "###", ": ", "</turn>", "\\"))
        assert "###" not in printed
    assert code.parse(ids) == (text[:50], text)


def test_awkward_rows_and_one_long_conversation(spark):
    rows = [(n % 3 if n % 5 else None, n, ["user", "assistant", None, "tool: x"][n % 4], t) for n, t in enumerate(TRICKY * 3 + [None, ""])]
    rows += [(50, n, "assistant" if n % 2 else "user", f"turn {n}") for n in range(500)] + [(60, None, "assistant", "no turn")]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    formatted = chat.format_chats(table, BYTE_TOKENIZER).cache()
    found = chat.digests(formatted, BYTE_TOKENIZER).collect()
    assert sorted(map(tuple, found), key=lambda r: (r[0] is not None, r[0] or 0)) == slow(rows)
    long = sorted(formatted.where("conv = 50").collect(), key=lambda r: r.place)
    assert [r.start for r in long] == [sum(r.n_ids for r in long[:k]) for k in range(len(long))]
    assert all((r.loss_to > r.loss_from) == bool(r.place % 2) for r in long)


def test_a_hot_conversation_is_split_and_counted_on(spark, monkeypatch):
    rows = [(None if n % 3 else 5, n, "user", f"turn {n} " * (n % 7)) for n in range(3000)]
    rows += [(6 + n, 0, "assistant", "one") for n in range(300)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = []
    monkeypatch.setattr(chat, "settle", lambda df, path: (seen.append(settle(df, path)), seen[-1])[1])
    try:
        formatted = chat.format_chats(table, BYTE_TOKENIZER)
        found = formatted.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (parts,) = [df for df in seen if "part" in df.columns]
    assert parts.where("conv IS NULL").select("part").distinct().count() > 2 and len(found) == len(rows)
    for conv in {r.conv for r in found}:
        turns = sorted((r for r in found if r.conv == conv), key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(len(turns)))
        assert [r.start for r in turns] == list(itertools.accumulate([r.n_ids for r in turns], initial=0))[:-1]


def test_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.format_chats(table, BYTE_TOKENIZER), BYTE_TOKENIZER).count() == 0
