import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import repair
from tidemark.llm.queries import op13_turn_repair
from tidemark.llm.shared import read_table

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
LANGUAGE = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        spaced = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        h = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2:]
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def left_to_right(kinds):
    """kinds: (initial, must go, truncated) per row. Independent of cells: the best way to each state,
    row by row, with insertions tried until nothing changes."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def insert(ways):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, roles) in list(ways.items()):
                for role in "ua":
                    to = moves[state].get(role)
                    way = (cost + 2, audit + "I", roles + [("I", role)])
                    if to and (to not in ways or way[:2] < ways[to][:2]):
                        ways[to], changed = way, True
        return ways

    ways = insert({"": (0, "", [])})
    for initial, go, cut in kinds:
        after = {}

        def offer(to, way):
            if to is not None and (to not in after or way[:2] < after[to][:2]):
                after[to] = way

        for state, (cost, audit, roles) in ways.items():
            offer(state, (cost + 3, audit + "D", roles + [("D", "")]))
            if not go:
                offer(moves[state].get(initial), (cost + cut, audit + "K", roles + [("K", initial)]))
                for role in "ua":
                    offer(moves[state].get(role), (cost + cut + 2, audit + "R", roles + [("R", role)]))
        ways = insert(after)
    return min(ways[s] for s in ("", "a") if s in ways)


def every_script(kinds, most_inserts):
    """All edit scripts of a few rows, checked against the language as text."""
    best = None
    options = [[("D", "", 3)] if go else [("D", "", 3), ("K", i, cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)] for i, go, cut in kinds]
    for script in itertools.product(*options):
        for inserts in range(most_inserts + 1):
            for places in itertools.combinations_with_replacement(range(len(kinds) + 1), inserts):
                for roles in itertools.product("ua", repeat=inserts):
                    steps, left = [], sorted(zip(places, range(inserts)))
                    for n in range(len(kinds) + 1):
                        steps += [("I", roles[k], 2) for p, k in left if p == n]
                        steps += [script[n]] if n < len(kinds) else []
                    if LANGUAGE.fullmatch("".join(s[1] for s in steps)):
                        found = (sum(s[2] for s in steps), "".join(s[0] for s in steps))
                        best = found if best is None else min(best, found)
    return best


def slow(rows):
    """rows of one conversation after damage, in order."""
    seen, kinds, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        stripped = text.strip(" \t\n\v\f\r")
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        kinds.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault in ("blank", "duplicate"), int(fault == "truncated")))
    cost, audit, roles = left_to_right(kinds)
    lines, at = [], 0
    for step, role in roles:
        if step == "I":
            lines.append({"u": "user", "a": "assistant"}[role] + ":")
            continue
        _, _, own, text = rows[at]
        at += 1
        if step != "D":
            lines.append(f"{own if step == 'K' else {'u': 'user', 'a': 'assistant'}[role]}:{text}")
    turns = [t for _, t, _, _ in rows if t is not None]
    initials = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(original):
    by_conv = {}
    for row in damage(original):
        by_conv.setdefault(row[0], []).append(row)
    out = {}
    for conv in {r[0] for r in original}:
        digest = lambda r: hashlib.sha256(r[3].encode()).hexdigest()
        rows = sorted(by_conv.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
        out[conv] = slow(rows)
    return out


def found(df):
    rows = df.collect()
    result = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(result) == len(rows)
    return result


def test_query_equals_brute_force(spark, sf_dir):
    source = [tuple(r) for r in read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_turn_repair(spark, sf_dir)) == expected(source)


KINDS = [(i, False, c) for i in "suax" for c in (0, 1)] + [("x", True, 0)]
LETTER = {k: "D" if k[1] else k[0].upper() if k[2] else k[0] for k in KINDS}


@pytest.mark.parametrize("length", [0, 1, 2])
def test_cells_equal_all_scripts(length):
    for kinds in itertools.product(KINDS, repeat=length):
        assert repair.best(repair.parse("".join(LETTER[k] for k in kinds))) == every_script(kinds, 3)


def test_cells_equal_left_to_right_and_every_cut():
    rng = random.Random(4)
    for _ in range(300):
        kinds = [rng.choice(KINDS) for _ in range(rng.randrange(3, 40))]
        letters = "".join(LETTER[k] for k in kinds)
        cell = repair.parse(letters)
        assert repair.best(cell) == left_to_right(kinds)[:2]
        cut = rng.randrange(1, len(letters))
        assert repair.join(repair.parse(letters[:cut]), repair.parse(letters[cut:])) == cell


def test_spans_in_order():
    rng = random.Random(6)
    letters = "".join(LETTER[rng.choice(KINDS)] for _ in range(61))
    spans = repair.Spans()
    for c in letters:
        spans.add(repair.row_cell(c))
    assert spans.cell() == repair.parse(letters)


def test_awkward_rows_and_a_hot_conversation(spark, monkeypatch):
    rng = random.Random(8)
    words = ["Yes.", "no", "Why?", " ", "", "Because \n", "ends here!\t", "é.", None, "x" * 50_000]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(c, t, rng.choice(roles), rng.choice(words)) for c in (1, 2, 3, None) for t in (None, None, 5, 5, 1, 2, 9)]
    rows += [(7, t, rng.choice(roles[:3]), f"{rng.choice(words)}{t % 900}{rng.choice('.x')}") for t in range(3000)]
    rows += [(8, None, "user", None), (9, 2, "user", "Same."), (9, 2, "user", "Same.")]
    rows += [(1000 + n, 0, "user", "Hi.") for n in range(60)]
    table = [(*r, n, "z", True) for n, r in enumerate(rows)]
    frame = spark.createDataFrame(
        table, "conv_id bigint, turn bigint, role string, text string, place bigint, `a b-c.d` string, first boolean"
    ).repartition(6)
    result = repair.with_absent(repair.repair_conversations(repair.damaged(frame)), frame)
    assert found(result) == expected(rows)
    assert len(expected(rows)) > len({r[0] for r in damage(rows)})


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair.repair_conversations(frame).count() == 0
    assert repair.with_absent(repair.repair_conversations(repair.damaged(frame)), frame).count() == 0
