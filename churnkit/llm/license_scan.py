"""Licence scan by template markup compiled to token automata.

A template is licence wording with two kinds of markup: ``[[ ... ]]`` is optional (and may
be nested), ``{{a-b}}`` stands for any a to b words.  All templates are compiled into one
automaton over words: a state knows the words that lead on and where any word leads; skipping an
optional region is resolved when the automaton is built.  A text is accepted where all
mandatory words stand in order, with nothing between them but what the markup allows.  Every
template begins with a mandatory word, so runs start only at those words.  Besides
the templates, plain phrases (the base) are located wherever their words stand consecutively.

Per document, no shuffle: one pass over the words; a run from a start word ends as soon as
no state is left, and no run is longer than the longest template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import plain_words

# Fixed values of the contract: phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# The wording of public licences and of their usual notices, as words, with markup.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
 the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
 distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to
 the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in
 all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied
 including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall
 {{1-8}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
 connection with the software or the use or other dealings in the software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following
 conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following
 disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following
 disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_NAME = """[[3]] neither the name of {{1-12}} nor the names of its contributors may be used to endorse or promote products derived
 from this software without specific prior written permission"""
_BSD_END = """this software is provided by {{1-12}} as is and any express or implied warranties including but not limited to the implied
 warranties of merchantability and fitness for a particular purpose are disclaimed"""
_GNU = """is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the
 free software foundation either version {} of the license or at your option any later version"""
_ISC = """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided
 that the above copyright notice and this permission notice appear in all copies"""
_APACHE = """licensed under the apache license version 2 0 [[the license you may not use this file except in compliance with the license
 you may obtain a copy of the license at http [[s]] www apache org licenses license 2 0 [[unless required by applicable law or agreed to
 in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either
 express or implied see the license for the specific language governing permissions and limitations under the license]]]]"""
TEMPLATES = (
    ("apache-2.0", _APACHE),
    ("bsd-2-clause", f"{_BSD} {_BSD_END}"),
    ("bsd-3-clause", f"{_BSD} {_BSD_NAME} {_BSD_END}"),
    ("cc-by-4.0", "licensed under [[a|the]] cc by 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under [[a|the]] cc by nc 4 0"),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under [[a|the]] cc by sa 4 0"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-2.0", "licensed under [[the terms of]] the gnu general public license version 2"),
    ("gpl-2.0-or-later", _GNU.format(2)),
    ("gpl-3.0", "licensed under [[the terms of]] the gnu general public license version 3"),
    ("gpl-3.0-or-later", _GNU.format(3)),
    ("isc", _ISC),
    ("mit", "released under the [[terms of the]] mit license"),
    ("mit", "licensed under the [[terms of the]] mit license"),
    ("mit", _MIT),
)

_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+)-(\d+)\}\}|\||[^\s\[\]{}|]+")


def parse(template: str) -> list:
    """Nested form of a template: words, ("any", a, b) and ("optional", [alternative, ...])."""
    stack: list = [[[]]]
    for m in _MARK.finditer(template):
        t = m.group()
        if t == "[[":
            stack.append([[]])
        elif t == "]]":
            if len(stack) == 1:
                raise ValueError("]] without [[")
            stack[-2][-1].append(("optional", stack[-1]))
            stack.pop()
        elif t == "|":
            stack[-1].append([])
        elif m.group(1):
            if not int(m.group(1)) <= int(m.group(2)):
                raise ValueError(f"empty range {t}")
            stack[-1][-1].append(("any", int(m.group(1)), int(m.group(2))))
        else:
            if plain_words(t.encode()) != [t.encode()]:
                raise ValueError(f"no word: {t}")
            stack[-1][-1].append(t.encode())
    if len(stack) != 1 or len(stack[0]) != 1:
        raise ValueError("[[ without ]], or an alternative outside")
    parts = stack[0][0]
    if not parts or not isinstance(parts[0], bytes):
        raise ValueError("a template begins with a mandatory word")
    return parts


class Automaton:
    """All templates as one automaton over words."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.on: list[dict[bytes, list[int]]] = []  # words that lead on
        self.any: list[list[int]] = []  # where any word leads
        self.skip: list[list[int]] = []  # states reached without a word
        self.accepts: dict[int, int] = {}  # state -> template
        self.labels = [label for label, _ in templates]
        self.mandatory = []
        starts: dict[bytes, list[int]] = {}
        for i, (_, template) in enumerate(templates):
            parts = parse(template)
            self.mandatory.append(sum(isinstance(p, bytes) for p in parts))
            first = self._state()
            starts.setdefault(parts[0], []).append(first)
            self.accepts[self._chain(parts[1:], first)] = i
        self.closed = [self._closure(s) for s in range(len(self.on))]
        self.starts = {w: sorted({c for s in states for c in self.closed[s]}) for w, states in starts.items()}
        #: A text without these words holds no template.
        self.anchors = sorted({max((p for p in parse(t) if isinstance(p, bytes)), key=len) for _, t in templates})

    def _state(self) -> int:
        self.on.append({})
        self.any.append([])
        self.skip.append([])
        return len(self.on) - 1

    def _chain(self, parts: list, state: int) -> int:
        """States for ``parts`` after ``state``; the last one."""
        for p in parts:
            if isinstance(p, bytes):
                new = self._state()
                self.on[state].setdefault(p, []).append(new)
                state = new
            elif p[0] == "any":
                end = self._state()
                for k in range(p[2] + 1):
                    if k >= p[1]:
                        self.skip[state].append(end)
                    if k < p[2]:
                        new = self._state()
                        self.any[state].append(new)
                        state = new
                state = end
            else:
                end = self._state()
                self.skip[state].append(end)
                for alternative in p[1]:
                    begin = self._state()
                    self.skip[state].append(begin)
                    self.skip[self._chain(alternative, begin)].append(end)
                state = end
        return state

    def _closure(self, state: int) -> list[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return sorted(seen)

    def runs(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(template, first word, word after the last) of the longest acceptance from every start."""
        for i, w in enumerate(words):
            states = self.starts.get(w)
            if states is None:
                continue
            found: dict[int, int] = {}
            j = i + 1
            now = set(states)
            while now:
                for s in now:
                    if s in self.accepts:
                        found[self.accepts[s]] = j
                if j == len(words):
                    break
                w = words[j]
                j += 1
                step = set()
                for s in now:
                    for t in self.on[s].get(w, ()):
                        step.update(self.closed[t])
                    for t in self.any[s]:
                        step.update(self.closed[t])
                now = step
            for template, end in found.items():
                yield template, i, end


def _phrase_places(words: list[bytes], phrases) -> Iterator[tuple[str, int, int]]:
    """(label, first word, word after the last) of every place of every phrase."""
    line = b" ".join(words)
    for pattern, label, n in phrases:
        at, seen = 0, 0
        for m in pattern.finditer(line):
            seen += line.count(b" ", at, m.start())
            at = m.start()
            yield label, seen, seen + n


PLACE = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64()), ("mandatory", pa.int32())])
SCAN = "n_words long, places array<struct<label:string,base:boolean,start:long,stop:long,mandatory:int>>"


def _scanner(templates, phrases):
    def run(batches):
        automaton = Automaton(templates)
        compiled = [(re.compile(rb"(?<![^ ])(?=" + re.escape(p.encode()) + rb"(?![^ ]))"), label, len(p.split())) for p, label in phrases]
        ends = [p.encode().split()[-1] for p, _ in phrases]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sizes, places = [], []
            for i in range(len(texts)):
                words = plain_words(texts[i].as_py())
                sizes.append(len(words))
                have = set(words)
                out = []
                if any(e in have for e in ends):
                    out += [dict(label=a, base=True, start=s, stop=e, mandatory=e - s) for a, s, e in _phrase_places(words, compiled)]
                if any(a in have for a in automaton.anchors):
                    out += [dict(label=automaton.labels[t], base=False, start=s, stop=e, mandatory=automaton.mandatory[t])
                            for t, s, e in automaton.runs(words)]
                places.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(PLACE))],
                                             names=["doc_id", "n_words", "places"])
    return run


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words and every place of licence wording (label, base phrase or template, first word, word after the
    last, mandatory words).  A null text has no words; rows with the same doc_id are separate documents."""
    Automaton(templates)  # a bad template fails here, not in a task
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scanner(tuple(templates), tuple(phrases)), f"doc_id {kind}, {SCAN}")


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns.  ``score`` is m / (m + 1) for the m mandatory words of the longest wording that the
    text holds (a template's, else a phrase's), 0 without any: the more words agree, the surer."""
    base = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    longest = F.coalesce(F.array_max(F.transform("places", lambda p: p["mandatory"])), F.lit(0))
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        (longest / (longest + F.lit(1.0))).alias("score"))


def _regex(parts: list) -> str:
    """A template over words that end with a space each, as a regular expression (for the SQL only)."""
    out = ""
    for p in parts:
        if isinstance(p, bytes):
            out += p.decode() + " "
        elif p[0] == "any":
            out += "(?:[^ ]+ ){%d,%d}" % (p[1], p[2])
        else:
            out += "(?:" + "|".join(_regex(a) for a in p[1]) + ")?"
    return out


def _oracle() -> str:
    begins = lambda t: " " + t.split("[[")[0].split("{{")[0].replace("\n", "").strip() + " "
    rows = ", ".join(f"('{label}', '{begins(t)}', ' {_regex(parse(t))}', {Automaton([(label, t)]).mandatory[0]})" for label, t in TEMPLATES)
    phrases = ", ".join(f"('{label}', {p.split()}, {len(p.split())})" for p, label in PHRASES)
    return rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
phrase(label, ps, k) AS (VALUES {phrases}),
template(label, begins, re, m) AS (VALUES {rows}),
place AS (SELECT rid, label, k, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1:i + k] = ps)) AS start FROM w, phrase),
base AS (SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels,
                max(k) AS m FROM place GROUP BY 1),
hit AS (SELECT rid, label, m FROM (SELECT rid, ' ' || array_to_string(ws, ' ') || ' ' AS line FROM w) l, template WHERE CASE WHEN contains(line, begins) THEN regexp_matches(line, re) ELSE false END),
every AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(m) AS m
          FROM (SELECT rid, label, m FROM hit UNION ALL SELECT rid, label, k FROM place) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(e.m, 0) / (coalesce(e.m, 0) + 1.0::DOUBLE) AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN every e USING (rid)"""


ORACLE = _oracle()
