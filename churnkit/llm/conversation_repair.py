"""Conversation structure repair: the cheapest edits that give every conversation alternating turns.

Knuth's lightest-derivation agenda.  An item says that the last ``used`` rows of a run
of rows lead from one state of the role automaton ``(s?(ua)+)?`` to another; its value is
(cost, audit), the audit being the initials of the edits in order.  Deductions put an edit
(keep, rerole, delete, insert) before an item's audit or join two neighbouring spans.  The
agenda is ordered by (cost, used, audit): for an item ``used`` is fixed, so among its
derivations this is the order by (cost, audit), and every deduction makes the value
larger (an insertion costs, every other edit uses a row), as Knuth's algorithm needs
even though keeping is free.  Equal costs on the same rows never make one audit a prefix of
another (what follows could only be insertions, which cost), so joining keeps the order too.

On Spark the rows are range partitioned by (conversation, turn) and sorted, so that a
conversation with a third of all rows spreads over many tasks.  A task reads its rows as
a stream and cuts them into spans of at most ``SPAN_ROWS`` rows or ``SPAN_BYTES`` bytes.  A
conversation that is one span inside one task is repaired there; the spans of the others
carry the lightest derivation between every two states and are joined in rounds of
``FAN_IN``, then their rows are read a second time as a stream, edited along the audit.
The digest of a conversation is one sequential hash, so that last pass streams each such
conversation through one task, holding its audit and one batch of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.llm.common import WHITE, stored

#: A span's agenda is held by one task: its rows and the bytes of their texts.
SPAN_ROWS, SPAN_BYTES = 512, 8_000_000
#: Spans joined by one task in a round.
FAN_IN = 16

# Costs and end marks: fixed values of the contract.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
ENDS = ".!?"

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
#: States from which a turn of that kind may follow.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
NEXT_ROLE = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
LEGAL = ("su", "ua", "au")

Value = tuple[int, int, str]  # cost, rows used, audit


def agenda(axioms: Iterable[tuple[Value, object]], deduce: Callable[[object, Value, dict], Iterable[tuple[Value, object]]],
           goals: set | None = None) -> dict[object, Value]:
    """Lightest value of every item, popped in order until all ``goals`` are final (None: until nothing is left).

    ``deduce(item, value, final)`` gives the conclusions of the deductions whose last
    antecedent to become final is ``item``.
    """
    heap: list = []
    for value, item in axioms:
        heappush(heap, (value, item))
    final: dict = {}
    left = None if goals is None else set(goals)
    while heap and (left is None or left):
        value, item = heappop(heap)
        if item in final:
            continue
        final[item] = value
        if left is not None:
            left.discard(item)
        for more in deduce(item, value, final):
            if more[1] not in final:
                heappush(heap, more)
    return final


def _edits(rows: list[tuple[str, int]]):
    """Deductions over one span; rows are (role initial, fault), items (rows used from the end, state)."""
    n = len(rows)

    def deduce(item, value, final):
        used, state = item
        cost, _, audit = value
        kinds = BEFORE.get(state, ())
        if state in (USER, ASSISTANT):
            for p in kinds:
                yield (cost + INSERT, used, "I" + audit), (used, p)
        if used == n:
            return
        initial, fault = rows[n - used - 1]
        yield (cost + DELETE, used + 1, "D" + audit), (used + 1, state)
        if fault in (BLANK, DUPLICATE):
            return
        extra = CUT if fault == TRUNCATED else 0
        if initial == INITIAL.get(state):
            step = (cost + extra, used + 1, "K" + audit)
        elif state in (USER, ASSISTANT):
            step = (cost + REROLE + extra, used + 1, "R" + audit)
        else:
            return
        for p in kinds:
            yield step, (used + 1, p)
    return deduce


def repair_rows(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a whole conversation, ties by the audit in byte order."""
    goal = (len(rows), START)
    cost, _, audit = agenda([((0, 0, ""), (0, START)), ((0, 0, ""), (0, ASSISTANT))], _edits(rows), {goal})[goal]
    return cost, audit


def span_ways(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """Lightest (from state, to state, cost, audit) of a span between every two states that it can connect."""
    out = []
    for end in (START, SYSTEM, USER, ASSISTANT):
        starts = {(len(rows), p) for p in (START, SYSTEM, USER, ASSISTANT)
                  if p == end or end in (USER, ASSISTANT) or (p, end) == (START, SYSTEM)}
        final = agenda([((0, 0, ""), (0, end))], _edits(rows), starts)
        out += [(p, end, final[n, p][0], final[n, p][2]) for n, p in starts if (n, p) in final]
    return out


def join_ways(left: list[tuple], right: list[tuple]) -> list[tuple[int, int, int, str]]:
    """Ways of two neighbouring spans: each deduction has a way of both as antecedents."""
    by_end: dict = {}
    for p, q, c, a in left:
        by_end.setdefault(q, []).append((p, c, a))

    def deduce(item, value, final):
        if item[0] != "right":
            return
        _, q, r = item
        for p, c, a in by_end.get(q, ()):
            yield (c + value[0], 1, a + value[2]), ("both", p, r)
    final = agenda([((c, 0, a), ("right", q, r)) for q, r, c, a in right], deduce)
    return [(i[1], i[2], v[0], v[2]) for i, v in final.items() if i[0] == "both"]


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every turn that the audit keeps, changes or inserts."""
    state = START
    for e in audit:
        if e == "D":
            next(rows)
            continue
        role, text = ("", "") if e == "I" else next(rows)
        if e != "K":
            role = NEXT_ROLE[state]
        state = USER if role[:1] == "u" else ASSISTANT if role[:1] == "a" else SYSTEM
        yield e, role, text


def fault_of(text: str, again: bool) -> int:
    bare = text.strip(WHITE)
    return BLANK if not bare else DUPLICATE if again else FINE if bare[-1] in ENDS else TRUNCATED


# ---------------------------------------------------------------- Spark

STATS = "n_rows long, n_turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
SPAN = (f"conv_id long, part int, span int, whole boolean, {STATS}, cost long, audit string, digest string, "
        "ways array<struct<p:int,q:int,cost:long,audit:string>>")
REPORT = f"conv_id long, {STATS}, cost long, audit string, digest string"
WAYS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _arrow(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    plain = [f.split() for f in fields.split(", ") if not f.startswith("ways")]
    return pa.schema([(n, kinds[k]) for n, k in plain] + [("ways", WAYS)] * ("ways" in fields))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows
                                      else [pa.array([], f.type) for f in schema], schema=schema)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live: the damage that crc32(``conv_id:turn``) % 20 names.  Dropped rows
    stay with live = false and no text, so that no conversation disappears."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", ""))
            .otherwise(space("text")))
    role = F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(space("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"), (kind != 0).alias("live"), F.explode(times).alias("copy")).drop("copy")


def whole(conversations: DataFrame) -> DataFrame:
    """The same columns from undamaged rows (nulls: one space)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                space("role"), space("text"), F.lit(True).alias("live"))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``again``: the role and text occur in an earlier turn of the conversation (nulls are the earliest turn).

    Only texts that occur in several turns are joined back; their first turn is aggregated
    before the shuffle, so that a text that fills a conversation is one row of it."""
    print_ = F.unhex(F.md5(F.col("text").cast("binary")))
    live = rows.where("live")
    first = (live.groupBy("conv_id", "role", print_.alias("print")).agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.max(F.col("turn").isNull()).alias("none"))
        .where("(none AND least IS NOT NULL) OR least < most")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "print", "least", "none"))
    later = F.col("turn").isNotNull() & (F.col("none") | (F.col("turn") > F.col("least")))
    return (rows.withColumn("mine", print_).join(
        first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mine") == F.col("print")), "left")
        .select("conv_id", "turn", "role", "text", "live", F.coalesce(later, F.lit(False)).alias("again")))


class _Span:
    """Rows of one conversation that a task has read since the last cut."""

    def __init__(self, conv, first: bool, last=None, turn=None):
        self.conv, self.first = conv, first
        self.rows, self.texts, self.size = [], [], 0
        self.last, self.turn = last, turn  # row and turn before, in this or the span before
        self.counts, self.n_turns, self.illegal = [0] * 4, 0, 0
        self.low = self.high = None

    def add(self, turn, role, text, again):
        same = self.last == (turn, role, text)  # equal rows are neighbours
        fault = fault_of(text, again or same)
        self.last = (turn, role, text)
        if turn is not None:
            self.n_turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if self.rows and self.rows[-1][0] + role[:1] not in LEGAL:
            self.illegal += 1
        self.rows.append((role[:1], fault))
        self.texts.append((role, text))
        self.size += len(text)
        self.counts[fault] += 1

    def out(self, part: int, n: int, whole: bool) -> tuple:
        head, tail = (self.rows[0][0], self.rows[-1][0]) if self.rows else (None, None)
        stats = (len(self.rows), self.n_turns, self.low, self.high, self.counts[BLANK], self.counts[DUPLICATE],
                 self.counts[TRUNCATED], self.illegal, head, tail)
        if not whole:
            ways = [dict(zip(("p", "q", "cost", "audit"), w)) for w in span_ways(self.rows)]
            return (self.conv, part, n, False, *stats, None, None, None, ways)
        cost, audit = repair_rows(self.rows)
        text = "\n".join(f"{r}:{t}" for _, r, t in edited(audit, iter(self.texts)))
        return (self.conv, part, n, True, *stats, cost, audit, hashlib.sha256(text.encode()).hexdigest(), None)


def _spans(batches: Iterator[pa.RecordBatch], span_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition -> its spans.  What its first and last conversation have elsewhere is not known here."""
    schema, part = _arrow(SPAN), TaskContext.get().partitionId()
    out: list = []
    span, n = None, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "again", "live")]
        for conv, turn, role, text, again, live in zip(*columns):
            if span is None:
                span = _Span(conv, True)
            elif conv != span.conv:
                out.append(span.out(part, n, not span.first))
                span, n = _Span(conv, False), n + 1
            elif len(span.rows) >= span_rows or span.size >= SPAN_BYTES:
                out.append(span.out(part, n, False))
                span, n = _Span(conv, True, span.last, span.turn), n + 1
            if live:
                span.add(turn, role, text, again)
        if len(out) >= 2000:
            yield _rows(schema, out)
            out = []
    if span is not None:
        out.append(span.out(part, n, False))
    yield _rows(schema, out)


def _merged(table: pa.Table, fan_in: int) -> pa.Table:
    """At most ``fan_in`` neighbouring spans of a conversation as one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    a = rows[0]
    ways = [tuple(w.values()) for w in a["ways"]]
    for b in rows[1:]:
        ways = join_ways(ways, [tuple(w.values()) for w in b["ways"]])
        if a["n_rows"] and b["n_rows"] and a["tail"] + b["head"] not in LEGAL:
            a["illegal"] += 1
        if b["n_rows"]:
            a["head"], a["tail"] = a["head"] if a["n_rows"] else b["head"], b["tail"]
        if b["low"] is not None:
            a["low"], a["high"] = b["low"] if a["low"] is None else a["low"], b["high"]
        for c in ("n_rows", "n_turns", "blank", "duplicate", "truncated", "illegal"):
            a[c] += b[c]
    a["ways"] = [dict(zip(("p", "q", "cost", "audit"), w)) for w in ways]
    a["place"] //= fan_in
    return pa.Table.from_pylist([{f: a[f] for f in MERGED.names}], schema=MERGED)


MERGED_DDL = f"conv_id long, place long, {STATS}, ways array<struct<p:int,q:int,cost:long,audit:string>>"
MERGED = _arrow(MERGED_DDL)


def _joined(open_: DataFrame, longest: int, fan_in: int) -> DataFrame:
    """Spans of the open conversations joined to one row each, with the lightest repair."""
    rows = open_.select("conv_id", "place", *[f.split()[0] for f in STATS.split(", ")], "ways")
    while longest > 1:
        rows = rows.groupBy("conv_id", F.floor(F.col("place") / fan_in)).applyInArrow(lambda t: _merged(t, fan_in), MERGED_DDL)
        longest = -(-longest // fan_in)
    done = F.filter("ways", lambda w: (w["p"] == START) & w["q"].isin(START, ASSISTANT))
    best = F.array_min(F.transform(done, lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"))))
    return rows.withColumn("best", best).select("conv_id", *[f.split()[0] for f in STATS.split(", ")], F.col("best.cost").alias("cost"),
                                                F.col("best.audit").alias("audit"))


def _walk(turns: bool):
    """Sorted header (the audit) and rows of conversations -> their report with the digest, or the repaired turns."""
    schema = _arrow(TURNS if turns else REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []

        def stream():
            names = ["conv_id", "kind", "role", "text", *[c for c in schema.names if c not in ("conv_id", "digest")]] if not turns else \
                ["conv_id", "kind", "role", "text", "audit"]
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in names])

        source = stream()
        ahead = next(source, None)
        while ahead is not None:
            header = ahead

            def own():
                nonlocal ahead
                ahead = next(source, None)
                while ahead is not None and ahead[1] == 1:
                    row = ahead
                    yield row[2], row[3]
                    ahead = next(source, None)
            audit = header[4] if turns else header[4 + schema.names.index("audit") - 1]
            rows = own()
            if turns:
                for i, (e, r, t) in enumerate(edited(audit or "", rows)):
                    out.append((header[0], i, e, r, t))
                    if len(out) >= 2000:
                        yield _rows(schema, out)
                        out = []
            else:
                digest, first = hashlib.sha256(), True
                for _, r, t in edited(audit or "", rows):
                    digest.update(f"{r}:{t}".encode() if first else f"\n{r}:{t}".encode())
                    first = False
                out.append((header[0], *header[4:], digest.hexdigest()))
            for _ in rows:  # rows deleted at the end are read too
                pass
            if len(out) >= 2000:
                yield _rows(schema, out)
                out = []
        yield _rows(schema, out)
    return run


TURNS = "conv_id long, position long, edit string, role string, text string"


def _streamed(headers: DataFrame, rows: DataFrame, turns: bool) -> DataFrame:
    """``headers`` (conv_id, ..., audit) and the live ``rows`` of those conversations, edited as a stream."""
    more = [f.name for f in headers.schema if f.name != "conv_id"] if not turns else ["audit"]
    types = {f.name: f.dataType for f in headers.schema}
    a = headers.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                       F.lit(None).cast("string").alias("text"), *more)
    b = rows.where("live").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", *[F.lit(None).cast(types[c]).alias(c) for c in more])
    return (a.unionByName(b).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
            .mapInArrow(_walk(turns), TURNS if turns else REPORT))


def repair(spark: SparkSession, rows: DataFrame, span_rows: int = SPAN_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """rows (conv_id, turn, role, text, live) -> per conversation its counts, cost, audit and the digest of the repaired text.

    Rows are taken by turn (nulls first), equal turns by role and text in byte order.  A null
    conv_id is a conversation of its own.  A conversation without live rows has zeros and an empty audit.
    """
    marked = _with_repeats(rows)
    parts = marked.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    spans = stored(spark, parts.mapInArrow(lambda b: _spans(b, span_rows), SPAN), "repair-spans")
    stats = [f.split()[0] for f in STATS.split(", ")]
    order = Window.partitionBy("conv_id").orderBy("part", "span")
    open_ = spans.where("NOT whole").withColumn("place", F.row_number().over(order).cast("long") - 1)
    longest = (open_.agg(F.max("place")).first()[0] or 0) + 1
    joined = stored(spark, _joined(open_, longest, fan_in), "repair-joined")
    mine = rows.join(joined.select(F.col("conv_id").alias("c")), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    return spans.where("whole").select("conv_id", *stats, "cost", "audit", "digest").unionByName(_streamed(joined, mine, False))


def repaired_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R or I), role, text: the repaired conversations themselves."""
    return _streamed(stored(spark, repair(spark, rows).select("conv_id", "audit"), "repair-audits"), rows, True)


def report(spark: SparkSession, conversations: DataFrame, span_rows: int = SPAN_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """The contract's columns for the damaged rows of ``conversations``; other columns of it are not read."""
    gaps: Column = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    return repair(spark, damage(conversations), span_rows, fan_in).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("digest").alias("repaired_sha256"), "n_rows")


#: The contract in SQL: CRC-32 from its polynomial, faults by row numbers, costs by a recursion over rows from the
#: last to the first (value of every state as (cost, audit)), repaired turns by a recursion along the audit.
ORACLE = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce([n, 1, 1, 1, 1, 1, 1, 1, 1], lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))
                    ORDER BY n) AS t FROM (SELECT range::BIGINT AS n FROM range(256))),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
coded AS (SELECT src.*, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT),
              lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1]))) % 20 AS kind FROM src, crc),
rows_ AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM coded WHERE kind <> 0)),
sorted AS (SELECT *, row_number() OVER w AS i,
                  lag(left(role, 1)) OVER w || left(role, 1) AS pair, trim(text, E' \t\n\x0b\x0c\r') AS bare
           FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END AS fault
           FROM sorted),
convs AS (SELECT c.conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
                 count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY 1),
dp AS (
  SELECT conv_id, n AS i, {c: 0, a: ''} AS v0, {c: 4, a: 'II'} AS v1, {c: 2, a: 'I'} AS v2, {c: 0, a: ''} AS v3 FROM convs
  UNION ALL
  SELECT conv_id, i, list_min([w0, {c: w2.c + 2, a: 'I' || w2.a}, {c: w3.c + 4, a: 'II' || w3.a}]),
         list_min([w1, {c: w2.c + 2, a: 'I' || w2.a}, {c: w3.c + 4, a: 'II' || w3.a}]),
         list_min([w2, {c: w3.c + 2, a: 'I' || w3.a}]), list_min([w3, {c: w2.c + 2, a: 'I' || w2.a}])
  FROM (SELECT conv_id, i,
          list_min([{c: v0.c + 3, a: 'D' || v0.a}] || CASE WHEN fault IN ('b', 'd') THEN [] ELSE [user_] || CASE WHEN x = 's' THEN [{c: v1.c + e, a: 'K' || v1.a}] ELSE [] END END) AS w0,
          list_min([{c: v1.c + 3, a: 'D' || v1.a}] || CASE WHEN fault IN ('b', 'd') THEN [] ELSE [user_] END) AS w1,
          list_min([{c: v2.c + 3, a: 'D' || v2.a}] || CASE WHEN fault IN ('b', 'd') THEN [] ELSE [assistant_] END) AS w2,
          list_min([{c: v3.c + 3, a: 'D' || v3.a}] || CASE WHEN fault IN ('b', 'd') THEN [] ELSE [user_] END) AS w3
        FROM (SELECT d.conv_id, d.i - 1 AS i, v0, v1, v2, v3, fault, left(role, 1) AS x, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS e,
                     CASE WHEN x = 'u' THEN {c: v2.c + e, a: 'K' || v2.a} ELSE {c: v2.c + 2 + e, a: 'R' || v2.a} END AS user_,
                     CASE WHEN x = 'a' THEN {c: v3.c + e, a: 'K' || v3.a} ELSE {c: v3.c + 2 + e, a: 'R' || v3.a} END AS assistant_
              FROM dp d JOIN faults f ON d.conv_id IS NOT DISTINCT FROM f.conv_id AND d.i = f.i))),
best AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM dp WHERE i = 0),
walk AS (
  SELECT conv_id, audit, 1 AS k, 0 AS used, '' AS state, '' AS line, false AS said FROM best
  UNION ALL
  SELECT conv_id, audit, k + 1, used2, CASE WHEN e = 'D' THEN state ELSE left(role2, 1) END, role2 || ':' || text2, e <> 'D'
  FROM (SELECT w.conv_id, audit, k, w.state, substr(audit, k::INT, 1) AS e, CASE WHEN e = 'I' THEN used ELSE used + 1 END AS used2,
               CASE WHEN e = 'K' THEN f.role WHEN w.state = 'u' THEN 'assistant' ELSE 'user' END AS role2,
               CASE WHEN e = 'I' THEN '' ELSE f.text END AS text2
        FROM walk w LEFT JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = used + 1 WHERE k <= length(audit))),
said AS (SELECT conv_id, string_agg(line, E'\n' ORDER BY k) AS text FROM walk WHERE said GROUP BY 1)
SELECT c.conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated,
       illegal::BIGINT AS illegal, cost::BIGINT AS cost, audit, sha256(coalesce(s.text, '')) AS repaired_sha256, n::BIGINT AS n_rows
FROM convs c JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN said s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
"""
