import random
import re

import pytest

from churnkit.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def lengths(parts, ws, i):
    """Every end that the parts reach from word i, by trying all ways."""
    if not parts:
        return {i}
    p, rest = parts[0], parts[1:]
    if isinstance(p, bytes):
        return lengths(rest, ws, i + 1) if i < len(ws) and ws[i] == p.decode() else set()
    if p[0] == "any":
        return set().union(*[lengths(rest, ws, i + k) for k in range(p[1], p[2] + 1) if i + k <= len(ws)], set())
    return lengths(rest, ws, i).union(*[lengths(rest, ws, j) for a in p[1] for j in lengths(a, ws, i)])


def brute(text, templates=ls.TEMPLATES):
    ws = words(text)
    base = [(label, i) for p, label in ls.PHRASES for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()]
    m = [len(p.split()) for p, label in ls.PHRASES if label in {b[0] for b in base}]
    labels = {b[0] for b in base}
    for label, t in templates:
        parts = ls.parse(t)
        if any(lengths(parts, ws, i) for i in range(len(ws)) if ws[i] == parts[0].decode()):
            labels.add(label)
            m.append(sum(isinstance(p, bytes) for p in parts))
    at = [i for _, i in base]
    return (len(ws), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({b[0] for b in base})), ",".join(sorted(labels)),
            max(m, default=0) / (max(m, default=0) + 1))


def filled(template, r):
    """A text that the template accepts."""
    out = []

    def fill(parts):
        for p in parts:
            if isinstance(p, bytes):
                out.append(p.decode())
            elif p[0] == "any":
                out.extend(r.choices(["acme", "the", "software", "café", "license"], k=r.randint(p[1], p[2])))
            elif r.random() < 0.5:
                fill(r.choice(p[1]))
    fill(ls.parse(template))
    return out


def dressed(ws, r):
    return "".join((w.upper() if r.random() < 0.2 else w) + r.choice([" ", "\n  * ", ", ", '" (', "-"]) for w in ws)


def found(spark, rows, ddl="doc_id long, text string"):
    return {r["doc_id"]: tuple(r)[1:] for r in ls.report(spark, spark.createDataFrame(rows, ddl).repartition(2)).collect()}


def test_equals_brute_force(spark):
    r, rows = random.Random(1), []
    for label, t in ls.TEMPLATES:
        ws = filled(t, r)
        noise = lambda: r.choices(["licensed", "under", "the", "permission", "is", "mit", "license", "x"], k=r.randrange(6))
        rows.append(dressed(noise() + ws + noise(), r))
        broken = list(ws)
        broken[r.randrange(1, len(broken) - 1)] = "changed"
        rows.append(dressed(noise() + broken + noise(), r))
        rows.append(dressed(ws[:-2] + ["and"] + ws[-2:], r))
    rows += [" ".join(r.choices(["mit", "license", "apache", "gnu", "general", "public", "cc", "by", "nc", "4.0", "licensed under"], k=80)) for _ in range(20)]
    rows = list(enumerate(rows))
    assert found(spark, rows) == {i: brute(t) for i, t in rows}


@pytest.mark.parametrize("label,template", ls.TEMPLATES)
def test_every_template_accepts_its_wording_and_nothing_else(label, template):
    r, automaton = random.Random(label), ls.Automaton(ls.TEMPLATES)
    accepted = lambda ws: {automaton.labels[t] for t, _, _ in automaton.runs([w.encode() for w in ws])}
    for _ in range(5):
        ws = filled(template, r)
        assert label in accepted(ws)
        firsts = [w.decode() for w in ls.parse(template) if isinstance(w, bytes)]
        assert label not in accepted([w for w in ws if w != firsts[len(firsts) // 2]])


def test_markup():
    a = ls.Automaton([("x", "a [[b [[c]] | d]] {{1-2}} e")])
    yes = ["a z e", "a b z e", "a b c z z e", "a d z e", "a e e"]
    no = ["a e", "a z z z e", "a c z z e", "b z e", "a b c d z z e"]
    holds = lambda t: any(stop == len(t.split()) and start == 0 for _, start, stop in a.runs([w.encode() for w in t.split()]))
    assert [holds(t) for t in yes] == [True] * 5 and [holds(t) for t in no] == [False] * 5
    for bad in ("[[a]] b", "a [[b", "a ]] b", "a {{3-1}}", "A b", "a | b", ""):
        with pytest.raises(ValueError):
            ls.parse(bad)


def test_edges(spark):
    long = "word " * 400_000 + "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "...!"), (4, long), (5, "MIT License"), (6, "CC-BY cc by CC  BY"), (None, "cc by")]
    got = found(spark, rows)
    assert got == {i: brute(t) for i, t in rows}
    assert got[4][5] == "mit" and got[6][1] == 3
    assert found(spark, []) == {}
    clash = [(1, "mit license", 9, "z", 0.5), (1, "mit license", 9, "z", 0.5)]
    df = spark.createDataFrame(clash, "doc_id long, text string, n_words long, places string, score double")
    assert [tuple(r) for r in ls.report(spark, df).collect()] == [(1, *brute("mit license"))] * 2
