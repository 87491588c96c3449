import hashlib
import re
import zlib

import numpy as np
import pytest

from tapehouse.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, part string, seq int"
WS = " \t\n\x0b\x0c\r"


def naive_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        found = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: sorted(x, key=order) for c, x in out.items()}


def naive_repair(rows):
    """Forward search over (state, cost, audit, lines): no tables, no blocks."""
    seen, kinds = set(), []
    for _, role, text in rows:
        shown = text.strip(WS)
        kinds.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    pattern = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for initial, name in names.items():
                    if (state, initial) in pattern:
                        better(table, pattern[state, initial], (cost + 3, audit + "I", (*lines, name + ":")))
        return table

    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            better(after, state, (cost + 4, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            more = 3 * (kind == "truncated")
            if (state, role[:1]) in pattern:
                better(after, pattern[state, role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for initial, name in names.items():
                if (state, initial) in pattern:
                    better(after, pattern[state, initial], (cost + 3 + more, audit + "R", (*lines, f"{name}:{text}")))
        best = after
    ends = [v for s, v in inserted(best).items() if s in ("", "a")]
    cost, audit, lines = min(ends)
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    known = {r[0] for r in rows if r[0] is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    counts = tuple(sum(k == kind for k in kinds) for kind in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def chat(seed, conversations, most):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "ux", None]
    texts = ["Hi.", "Why?", "cut off", "", None, " \n", "Ok! ", "é。", "a:b", "Fine.\t"]
    rows = []
    for c in range(conversations):
        for t in range(int(rng.integers(1, most))):
            turn = None if rng.random() < 0.05 else int(t + rng.integers(0, 2))
            rows.append((c, turn, roles[rng.integers(0, len(roles))], texts[rng.integers(0, len(texts))] ))
    rows += [(None, 1, "user", "No id."), (None, None, "assistant", "x" * 100_000), rows[0], rows[0]]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(parts)


def check(spark, rows, parts=3, block=turns.BLOCK):
    expected = {c: naive_repair(x) for c, x in naive_damage(rows).items()}
    got = turns.repair(turns.damaged(frame(spark, rows, parts)), block=block).collect()
    assert len(got) == len(expected)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == expected


def test_block_tables_equal_single_symbols():
    rng = np.random.default_rng(3)
    one = turns.Blocks(1)
    for block in (2, 3, 4):
        table = turns.Blocks(block)
        assert table.vectors == one.vectors
        for n in [*range(9), 500]:
            codes = bytes(rng.integers(0, 16, n).tolist())
            a, b = one.audit(codes), table.audit(codes)
            assert (a[0], "".join(a[1]) + a[2]) == (b[0], "".join(b[1]) + b[2])


@pytest.mark.parametrize("seed, block", [(1, 4), (2, 1), (3, 3)])
def test_repairs_equal_plain_search(spark, seed, block):
    check(spark, chat(seed, 60, 9), block=block)


@pytest.mark.parametrize("seed", [4, 5])
def test_conversations_that_span_ranges(spark, seed):
    rows = [(c % 2 or 7, t, r, x) for i, (c, t, r, x) in enumerate(chat(seed, 40, 12)) if c is not None]
    rows = [(c, None if t is None else t + 3 * i, r, None if x is None else x * (i % 3)) for i, (c, t, r, x) in enumerate(rows)]
    check(spark, rows + [(3, 1, "user", "One."), (3, 2, "assistant", "Two.")], parts=4)


def test_equal_rows_of_one_turn_are_split(spark):
    rows = [(5, 1, "user", "Same.")] * 400 + [(5, 2, "assistant", "Other.")] + [(6, 1, "user", "Hi.")]
    check(spark, rows)


def test_dropped_and_empty(spark):
    gone = [(c, 1, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    assert gone
    check(spark, gone)
    assert turns.repair(turns.damaged(frame(spark, []))).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: naive_repair(x) for c, x in naive_damage(rows).items()}
    assert {r["conv_id"]: tuple(r)[1:] for r in turns.op12_conversation_repair(spark, sf).collect()} == expected
