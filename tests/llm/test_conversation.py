"""Conversation repair against trying all edits, and both of its ways against each other."""

import hashlib
import random
import re
import zlib

import pytest

from labtide.llm import conversation
from labtide.llm.conversation import Row, aligned, rebuilt, steps_back, walked

SCHEMA = "conv_id bigint, turn bigint, role string, text string, slice int, at string"
WHITE = " \t\n\x0b\x0c\r"


def all_edits(rows):
    """The cheapest edits by trying every one, least audit first; targets are checked with the pattern itself."""
    best = (3 * len(rows), "D" * len(rows))

    def go(i, cost, audit, made):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", made):
            best = min(best, (cost, audit))
        for c in "ua":
            go(i, cost + 2, audit + "I", made + c)
        if i < len(rows):
            row = rows[i]
            go(i + 1, cost + 3, audit + "D", made)
            if not row.bad:
                if row.initial in ("s", "u", "a"):
                    go(i + 1, cost + row.cut, audit + "K", made + row.initial)
                for c in "ua":
                    go(i + 1, cost + row.cut + 2, audit + "R", made + c)

    go(0, 0, "", "")
    return best


def random_rows(draw, most):
    return [Row(draw.choice("ssuuuaaat "), draw.random() < 0.15, draw.randint(0, 1)) for _ in range(draw.randint(0, most))]


def test_op13_alignment_equals_all_edits():
    draw = random.Random(5)
    for _ in range(250):
        rows = random_rows(draw, 4)
        assert aligned(rows) == all_edits(rows), rows


def test_op13_both_ways_agree():
    draw = random.Random(6)
    for _ in range(1500):
        rows = random_rows(draw, 40)
        cost, audit = aligned(rows)
        back = steps_back(rows, conversation.AT_END)
        text, phase = walked(rows, back, 0)
        assert (back[0][0], text + "I" * (conversation.AT_END[phase] // 2)) == (cost, audit)
        made = "".join(r[:1] for r, _ in rebuilt(audit, [r.initial for r in rows], rows))
        assert re.fullmatch("(s?(ua)+)?", made)


def brute(rows):
    """Results of the query for (conv_id, turn, role, text) rows, in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        held.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = []
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        turns = {t for t, _, _ in held if t is not None}
        seen, kinds = set(), []
        for _, role, text in held:
            bare = text.rstrip(WHITE)
            kinds.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in held]
        lined = [Row(i, k in ("b", "d"), int(k == "t")) for i, k in zip(initials, kinds)]
        cost, audit = all_edits(lined) if len(held) < 5 else aligned(lined)
        lines, i, made = [], 0, ""
        for step in audit:
            want = {"": "user", "s": "user", "u": "assistant", "a": "user"}[made[-1:]]
            if step == "I":
                lines.append(f"{want}:")
            elif step != "D":
                lines.append(f"{held[i][1] if step == 'K' else want}:{held[i][2]}")
            if step in "IKR":
                made += lines[-1][0]
            i += step != "I"
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *[kinds.count(k) for k in "bdt"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, count, most):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, most)):
            role = draw.choice(["user", "assistant"] * 3 + ["system", "tool", None, ""])
            text = draw.choice([f"Turn {turn} é.", "Same text!", "no stop", None, "", " \n", "One. two \t", "x" * 70 + str(turn)])
            rows.append((conv, draw.choice([turn, turn, turn + 2, None]), role, text))
    return rows


EDGES = [
    (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (None, 2, "assistant", "y" * 200_000),
    (900, 5, "system", "S."), (901, 1, "user", "Only."), (902, None, "assistant", "a."), (903, 0, "ünder", "?"),
    *[(904, 3, "user", "Again.")] * 6,
]


def result(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = conversation.digests(conversation.repair(conversation.damaged(frame), **how))
    return sorted(map(tuple, got.collect()), key=str)


def test_op13_equals_brute_force(spark):
    rows = conversations(1, 120, 9) + EDGES
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("how", [{"limit": 3, "slice_rows": 4}, {"limit": 0, "slice_rows": 1}, {"limit_bytes": 60, "slice_rows": 1 << 12}])
def test_op13_long_conversations_in_slices(spark, how):
    rows = conversations(2, 25, 40) + EDGES
    assert result(spark, rows, **how) == brute(rows)


def test_op13_ranges_cut_a_conversation(spark, monkeypatch):
    from labtide.llm import ranks

    plain = ranks.ordered
    monkeypatch.setattr(conversation, "ordered", lambda rows, keys: plain(rows, keys, run=5))
    rows = conversations(3, 6, 60)
    assert result(spark, rows, limit=10, slice_rows=4) == brute(rows)


def test_op13_empty_table(spark):
    assert result(spark, []) == []
