import re

from churnkit.llm import decontamination as D
from pyspark.sql import functions as F

ITEM = "A train leaves Boston at 9:30 and travels 120 km before it meets Anna near the old bridge of Salem"


def found(spark, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in D.contaminated(spark, docs, bench, **options).collect()}


def test_templates(spark):
    df = spark.createDataFrame([("He paid $3.50 to Bob for 20 kg. Then 1,000 left <x>",)], "t string")
    assert df.select(D.canonical(F.col("t"))).first()[0] == "he paid <num=3_50> to <name=bob> for <num=20> <unit=kg> then <num=1_000> left x"


def test_reparameterised_question(spark, docs):
    other = ITEM.replace("Boston", "Madrid").replace("9:30", "7:15").replace("120", "85").replace("Anna", "Luis").replace("Salem", "Toledo")
    rows = [(1, f"intro words here. {ITEM} and so on"), (2, f"Quiz {other}."), (3, ITEM.lower().replace(" ", "\n")), (4, "nothing of it at all in here, really")]
    got = found(spark, docs(rows), [(7, ITEM)])
    assert {k: r["kind"] for k, r in got.items() if k[0] != 3} == {(1, 7): "verbatim", (2, 7): "reparameterised"}
    assert (4, 7) not in got and got[(2, 7)]["slots"] >= 5


def test_copies_in_other_capitals_and_white_space(spark, docs):
    short = "Paris lies on the river Seine"
    rows = [(1, ITEM.lower().replace(" ", "\n")), (2, ITEM.upper()), (3, ITEM.replace(" ", "  ")), (4, ITEM.replace(" ", "\u00a0\n")), (5, f"we know that {short} today"),
            (6, f"WE KNOW. {short.upper()}"), (7, f"so,{short.title()}!")]
    got = found(spark, docs(rows), [(7, ITEM), (8, short)])
    assert {k: r["kind"] for k, r in got.items()} == {(i, 7 if i < 5 else 8): "verbatim" for i in range(1, 8)}


def test_letters_that_only_upper_case_makes_equal(spark, docs):
    item = "der große Strauß läuft über die lange straße am Fluß entlang und ruft sehr laut dabei"
    greek = "ο παλιός δρόμος προς τον ψηλό πύργος περνά δίπλα από μεγάλος κήπος και μικρός λόφος"
    rows = [(1, item.upper()), (2, greek.upper()), (3, greek.replace("ς", "σ")), (4, item)]
    got = found(spark, docs(rows), [(7, item), (8, greek)])
    assert set(got) == {(1, 7), (4, 7), (2, 8), (3, 8)}


def test_slots_must_be_consistent(spark, docs):
    item = "Anna gave Bob 5 apples and then Bob gave Anna 5 apples back so Anna has what she had"
    good = "when Carl gave Dora 8 apples and then Dora gave Carl 8 apples back so Carl has what she had"
    bad = "when Carl gave Dora 8 apples and then Emil gave Fred 9 apples back so Gina has what she had"
    got = found(spark, docs([(1, good), (2, bad), (3, f"{bad} {good}")]), [(1, f"when {item}")])
    assert set(got) == {(1, 1), (3, 1)}


def test_an_inconsistent_slot_drops_only_its_windows(spark, docs):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    words[10] = words[90] = "1990"
    long = " ".join(words)
    sums = "there were 3 red apples and there were 5 green apples in the same old basket"
    rows = [(1, " ".join([*words[:90], "1991", *words[91:]])), (2, sums.replace("3", "4").replace("5", "4")),
            (3, long.replace("1990", "1991"))]
    got = found(spark, docs(rows), [(1, long), (2, sums)])
    assert {k: r["kind"] for k, r in got.items()} == {(1, 1): "verbatim", (2, 2): "reparameterised", (3, 1): "reparameterised"}
    assert got[(1, 1)]["matched"] == 93 - 8 and got[(1, 1)]["windows"] == 93


def test_short_sentences_that_begin_with_names(spark, docs):
    clips = "Anna sold 5 clips. Anna kept 3. How many clips did Anna have?"
    pears = "Tom has three apples and twenty-five pears. Tom eats Five miles from home."
    rows = [(1, "Maria sold 7 clips. Maria kept 2. How many clips did Maria have?"), (2, "so Maria sold 7 clips. Maria kept 2. How many clips did Maria have?"),
            (3, "Eva has two apples and 7 pears. Eva eats ten miles from home."), (4, f"Quiz: {clips}"), (5, clips.lower()),
            (6, "She sold 7 bags and he kept some. How many bags did they have?")]
    got = found(spark, docs(rows), [(1, clips), (2, pears)])
    assert {k: r["kind"] for k, r in got.items()} == {
        (1, 1): "reparameterised", (2, 1): "reparameterised", (3, 2): "reparameterised", (4, 1): "verbatim", (5, 1): "verbatim"}
    item = "Anna gave Bob 5 apples and then Bob gave Anna 5 apples back so Anna has what she had"
    good = "Carl gave Dora 8 apples and then Dora gave Carl 8 apples back so Carl has what she had"
    bad = "Carl gave Dora 8 apples and then Emil gave Fred 9 apples back so Gina has what she had"
    assert set(found(spark, docs([(1, good), (2, bad)]), [(1, item)])) == {(1, 1)}


def test_part_of_a_long_item(spark, docs):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    rows = [(1, "x " + " ".join(words[20:33]) + " y"), (2, "x " + " ".join(words[20:32]) + " y")]
    assert set(found(spark, docs(rows), [(1, " ".join(words))])) == {(1, 1)}


def test_table_against_plain_search(spark, small):
    norm = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [(r["item_id"], norm(r["text"])) for r in small("benchmark")]
    want = {(r["doc_id"], i) for r in small("documents") for i, t in items if t in norm(r["text"])}
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(spark, docs, bench).collect()} == want and want


def test_edges(spark, docs, clashing):
    items = [(1, None), (2, ""), (3, "five words are just enough"), (4, "too short"), (5, ITEM), (5, ITEM), (None, "an item without any id that is long enough to search")]
    rows = [(1, None), (2, ""), (3, "Now five words are just enough!"), (4, "too short"), (None, ITEM), (6, "x " * 60_000 + ITEM), (6, "x " * 60_000 + ITEM),
            (8, "an item without any id that is long enough to search"), (9, "five words are")]
    got = found(spark, docs(rows), items)
    assert set(got) == {(3, 3), (4, 4), (None, 5), (6, 5), (8, None)}
    assert found(spark, docs([]), items) == {} and found(spark, docs(rows), []) == {}
    bench = spark.createDataFrame([(5, ITEM)], "item_id long, text string")
    kept = D.decontaminate(spark, clashing([(1, ITEM), (1, "clean"), (2, "clean"), (None, ITEM)]), bench)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "clean"), (2, "clean")] and "a b" in kept.columns


def test_lists_of_names_and_numbers_are_no_evidence(spark, docs):
    authors = "Anna Bell, Carl Dunn, Emma Frost, Gina Hall, Ivan Jones, Karl Lang, Mona Nash, Olga Pratt and Quentin Reed"
    primes = " ".join(str(n) for n in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37) * 5)
    rows = [(1, "RED CARS DRIVE FAST ALONG WIDE OPEN ROADS WHILE BLUE BIRDS FLY HIGH ABOVE GREEN HILLS EVERY SINGLE DAY"),
            (2, "Present: Tom Wood, Una Voss, Will York, Zoe Adams, Ben Clark, Dora Evans, Fred Green, Hans Irving"),
            (3, " ".join(map(str, range(11, 80)))), (4, " ".join(map(str, range(3000)))), (5, f"They are {authors}."), (6, f"here\n{primes}\nthere"),
            (7, f"some {primes} more")]
    got = found(spark, docs(rows), [(1, authors), (2, primes), (3, "Name the capital")])
    assert set(got) == {(5, 1), (6, 2)}
    assert set(found(spark, docs([(1, "x\n NAME  the, capital!\r\ny"), (2, "so name the capital now")]), [(3, "Name the capital")])) == {(1, 3)}


def brute(rows, items, window=8, shortest=5, coverage=0.5, enough=6):
    """The definition in plain Python, on the canonical texts."""
    out = set()
    for doc, dv in rows:
        for item, iv in items:
            iw = iv.split(" ")
            if len(iw) < shortest:
                continue
            size, kinds = min(window, len(iw)), (lambda w: re.sub("=[^<>]*>", ">", w), lambda w: re.sub("=[^<>]*>", ">", re.sub("<name=([^>]*)>", r"\1", w)))
            value = lambda w: re.sub("<name=([^>]*)>", r"\1", w)
            dw, evidence, hits = dv.split(" "), set(), {}
            for kind in kinds:
                it, dt = [kind(w) for w in iw], [kind(w) for w in dw]
                for at in range(len(it) - size + 1):
                    lit = [not w.startswith("<") and "%" not in w for w in it[at:at + size]]
                    if 2 * sum(lit) < size or not any(a and b for a, b in zip(lit, lit[1:])):
                        continue
                    evidence.add(at)
                    for pos in range(len(dt) - size + 1):
                        if dt[pos:pos + size] == it[at:at + size]:
                            hits.setdefault(pos - at, set()).add((pos, at))
            matched = set()
            for shift, found_ in hits.items():
                pairs = {(at + k, value(iw[at + k]), value(dw[pos + k])) for pos, at in found_ for k in range(size) if iw[at + k].startswith("<")}
                votes = {}
                for place, a, b in pairs:
                    c, p = votes.setdefault(a, {}).get(b, (0, 10**9))
                    votes[a][b] = (c + 1, min(p, place))
                stands = {a: max(v, key=lambda b: (v[b][0], -v[b][1])) for a, v in votes.items()}  # noqa: B023
                for pos, at in found_:
                    own = [(value(iw[at + k]), value(dw[pos + k])) for k in range(size) if iw[at + k].startswith("<")]
                    if all(a == b or stands[a] == b for a, b in own):
                        matched.add(at)
            if matched and len(matched) >= min(len(evidence) * coverage, enough):
                out.add((doc, item))
    return out


def test_reparameterised_items_against_plain_python(spark, docs):
    import random

    r = random.Random(4)
    names, plainwords = ["Anna", "Bob", "Carl", "Dora", "Emil"], ["gives", "apples", "to", "the", "old", "market", "and", "sells", "each", "basket", "for", "then", "walks"]
    def text(n):  # noqa: E306
        return [r.choice(names) if r.random() < 0.15 else str(r.randrange(1, 9)) if r.random() < 0.15 else r.choice(plainwords) for _ in range(n)]
    items = [(i, text(r.randrange(5, 30))) for i in range(12)]
    rows = []
    for i in range(80):
        item = list(r.choice(items)[1])
        new = {w: r.choice(names) if w in names else str(r.randrange(1, 9)) for w in item if w in names or w.isdigit()}
        changed = [new.get(w, w) if r.random() < 0.9 else r.choice(plainwords + names) if r.random() < 0.5 else w for w in item]
        rows.append((i, " ".join(text(4) + changed[r.randrange(4):] + text(3))))
    items = [(i, " ".join(ws)) for i, ws in items]
    canon = lambda pairs: [(x[0], x[1]) for x in spark.createDataFrame(pairs, "k long, t string").select("k", D.canonical(F.col("t"))).collect()]
    want = brute(canon(rows), canon(items))
    assert set(found(spark, docs(rows), items)) == want and len(want) > 15


def test_column_clashes(spark):
    df = spark.createDataFrame([(1, ITEM, "a", "b", 1), (2, "clean", "a", "b", 2)], "doc_id long, text string, __id string, _free0 string, __key long")
    kept = D.decontaminate(spark, df, spark.createDataFrame([(5, ITEM)], "item_id long, text string"))
    assert [tuple(r) for r in kept.collect()] == [(2, "clean", "a", "b", 2)]


def test_no_python_in_plan(spark, docs):
    bench = spark.createDataFrame([(5, ITEM)], "item_id long, text string")
    plan = D.contaminated(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
