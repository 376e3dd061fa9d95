import binascii
import hashlib
import random
import re

import pytest

from churnkit.llm import conversation_repair as cr

CONV = "conv_id long, turn long, role string, text string"
BARE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit) by values of every row and state; rows are (initial, fault)."""
    # insertions make the recursion cyclic: iterate until nothing changes
    values = {}
    for i in range(len(rows), -1, -1):
        for s in (None, "s", "u", "a"):
            values[i, s] = (0, "") if i == len(rows) and s in (None, "a") else (10**9, "")
        for _ in range(6):
            for s in (None, "s", "u", "a"):
                turn = "a" if s == "u" else "u"
                options = [values[i, s]]
                c, a = values[i, turn]
                options.append((c + 2, "I" + a))
                if i < len(rows):
                    initial, fault = rows[i]
                    c, a = values[i + 1, s]
                    options.append((c + 3, "D" + a))
                    if fault in "ft":
                        cut = fault == "t"
                        c, a = values[i + 1, turn]
                        options.append((c + cut, "K" + a) if initial == turn else (c + 2 + cut, "R" + a))
                        if initial == "s" and s is None:
                            c, a = values[i + 1, "s"]
                            options.append((c + cut, "K" + a))
                values[i, s] = min(o for o in options)
    return values[0, None]


def brute(conversations):
    out, convs = {}, {}
    for conv, turn, role, text in conversations:
        convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = binascii.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in rows:
            bare = BARE.findall(text)
            marked.append((role[:1], "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "f"))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit = cheapest(marked)
        state, left, lines = "", iter(rows), []
        for e in audit:
            row = None if e == "I" else next(left)
            if e != "D":
                role = row[1] if e == "K" else "assistant" if state == "u" else "user"
                lines.append(f"{role}:{row[2] if row else ''}")
                state = role[:1]
        n = lambda f: sum(x == f for _, x in marked)  # noqa: B023, E731
        pairs = [a[0] + b[0] for a, b in zip(marked, marked[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n("b"), n("d"), n("t"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows, ddl=CONV, **sizes):
    df = cr.report(spark, spark.createDataFrame(rows, ddl).repartition(3), **sizes)
    return {r["conv_id"]: tuple(r)[1:9] for r in df.collect()}


def messy(seed, n_convs, length):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "  ", "", None, "Same. ", "\x85 odd", "é?"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "agent"]
    return [(c, r.choice([t, t, t, None, t + 2]), r.choice(roles[:3] * 4 + roles), r.choice(texts + [f"text {c} {t}."] * 8))
            for c in range(n_convs) for t in range(r.randrange(length))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = messy(seed, 60, 14)
    assert found(spark, rows) == brute(rows)


def test_small_spans_and_a_conversation_with_most_rows(spark):
    rows = [(7, i // 3, ["user", "assistant", "system"][i % 5 % 3], f"t{i % 40}" + "." * (i % 4 > 0)) for i in range(3000)] + messy(3, 10, 9)
    want = brute(rows)
    assert found(spark, rows) == want
    rows = [(3 if c is None else c, t, a, b) for c, t, a, b in messy(4, 3, 60)]
    assert found(spark, rows, span_rows=3, fan_in=2) == brute(rows)


def test_every_span_split_gives_the_same_repair():
    r = random.Random(5)
    for _ in range(40):
        rows = [(r.choice("suax"), r.randrange(4)) for _ in range(r.randrange(1, 9))]
        names = [(a, "fbdt"[f]) for a, f in rows]
        assert cr.repair_rows(rows) == cheapest(names)
        k = r.randrange(len(rows) + 1)
        ways = cr.join_ways(cr.span_ways(rows[:k]), cr.span_ways(rows[k:]))
        assert sorted(ways) == sorted(cr.span_ways(rows))
        assert min((c, a) for p, q, c, a in ways if p == 0 and q in (0, 3)) == cheapest(names)


def test_edges(spark):
    assert found(spark, []) == {}
    dropped = next(c for c in range(1000) if binascii.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    rows = [(None, None, None, None), (None, None, "user", "x" * 3_000_000 + "."), (2, None, None, None), (3, 5, "user", "A."), (3, 5, "user", "A."),
            (3, 5, "user", "A."), (3, -2, "assistant", "A.")]
    assert found(spark, rows) == brute(rows)
    extra = [(*r, "x", 1, 2, True) for r in rows]
    assert found(spark, extra, CONV + ", audit string, part int, n_rows long, live boolean") == brute(rows)


def test_repaired_turns_are_the_digested_text(spark):
    rows = messy(9, 20, 10)
    df = cr.damage(spark.createDataFrame(rows, CONV))
    lines = {}
    for r in sorted(cr.repaired_turns(spark, df).collect(), key=lambda r: (r["conv_id"], r["position"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, want in brute(rows).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == want[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines.get(conv, [])))
