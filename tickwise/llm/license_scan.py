"""License scans: templates with optional and replaceable regions as token automata.

A template is text with markup: ``<<optional>>...<</optional>>`` may be absent,
``<<var>>...<</var>>`` stands for any one to ``MAX_VAR`` words (``<<var n>>``: at most n). All
other wording is mandatory and has to match exactly, word by word. A template
compiles to an automaton over words; optional regions nest.

Texts are scanned for every place where an automaton accepts. A document is
looked at only if it holds a word that the templates can't do without; the words
of the others are only counted. Every row is judged where it is read: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import Words, blocks, column, text_bytes

MAX_VAR = 12
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(/?)(optional|var)\s*(\d*)>>")

# Fixed values of the base scan: phrase, label.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Templates of the method: label, markup.
TEMPLATES = [
    ("mit", "<<optional>>released<</optional>> <<optional>>licensed<</optional>> under the <<optional>>terms of the<</optional>> mit license"),
    ("apache-2", "licensed under the apache license version 2 <<optional>>0<</optional>>"),
    ("cc-by-nc", "licensed under <<optional>>a<</optional>> <<optional>>creative commons<</optional>> cc by nc <<optional>><<var 1>>4<</var>> 0<</optional>>"),
    ("cc-by-sa", "licensed under <<optional>>a<</optional>> <<optional>>creative commons<</optional>> cc by sa <<optional>><<var 1>>4<</var>> 0<</optional>>"),
    ("cc-by", "licensed under <<optional>>a<</optional>> <<optional>>creative commons<</optional>> cc by <<var 1>>4<</var>> 0"),
    ("gpl", "<<optional>>this <<var 2>>work<</var>> is<</optional>> licensed under the gnu general public license "
            "<<optional>>version <<var 1>>3<</var>><</optional>>"),
    ("lgpl", "licensed under the gnu lesser general public license <<optional>>version <<var 2>>3<</var>><</optional>>"),
    ("bsd", "licensed under the bsd <<optional>><<var 2>>3 clause<</var>><</optional>> license"),
    ("proprietary", "all rights reserved"),
    # licence texts
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the <<var 1>>software<</var>> to deal in the software without restriction including without "
            "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
            "and to permit persons to whom the software is furnished to do so subject to the following conditions <<optional>>the "
            "above copyright notice and this permission notice <<optional>>including the next paragraph<</optional>> shall be "
            "included in all copies or substantial portions of the software<</optional>> <<optional>>the software is provided "
            "<<var 2>>as is<</var>> without warranty of any kind express or implied including but not limited to the warranties of "
            "merchantability fitness for a particular purpose and noninfringement in no event shall <<var>>the authors or "
            "copyright holders<</var>> be liable for any claim damages or other liability whether in an action of contract tort or "
            "otherwise arising from out of or in connection with the software or the use or other dealings in the software<</optional>>"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met <<optional>><<var 1>>1<</var>><</optional>> redistributions of source code must retain "
            "the above copyright notice this list of conditions and the following disclaimer <<optional>><<var 1>>2<</var>>"
            "<</optional>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution "
            "<<optional>><<optional>><<var 1>>3<</var>><</optional>> all advertising materials mentioning features or use of this "
            "software must display the following acknowledgement this product includes software developed by "
            "<<var>>the organization<</var>><</optional>> <<optional>><<optional>><<var 1>>3<</var>><</optional>> neither the name of "
            "<<var>>the copyright holder<</var>> nor the names of <<var>>its contributors<</var>> may be used to endorse or promote "
            "products derived from this software without specific prior written permission<</optional>>"),
    ("isc", "permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose with or without "
            "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", "apache license version 2 0 january 2004"),
    ("gpl", "gnu general public license version <<var 1>>3<</var>> <<optional>><<var 1>>29<</var>><</optional>> june <<var 1>>2007<</var>>"),
    ("lgpl", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl", "gnu lesser general public license version 2 1 february 1999"),
    ("agpl", "gnu affero general public license version 3 19 november 2007"),
    # standard headers
    ("apache-2", "licenses this file to you under the apache license version 2 <<optional>>0<</optional>>"),
    *[(label, f"redistribute it and or modify it under the terms of the gnu {name} <<optional>>version <<var 2>>3<</var>><</optional>> "
              "<<optional>>as published by the free software foundation <<optional>>either version <<var 2>>3<</var>> of the license "
              "or at your option any later version<</optional>><</optional>>")
      for label, name in (("gpl", "general public license"), ("lgpl", "lesser general public license"),
                          ("lgpl", "library general public license"), ("agpl", "affero general public license"))],
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 <<optional>>if a copy of the mpl was "
            "not distributed with this file you can obtain one at <<var 6>>https mozilla org mpl 2 0<</var>><</optional>>"),
    *[(label, f"licensed under <<optional>><<var 1>>a<</var>><</optional>> creative commons attribution {more} <<var 1>>4<</var>> 0 "
              "<<optional>>international<</optional>> <<optional>>license<</optional>>")
      for label, more in (("cc-by", ""), ("cc-by-sa", "sharealike"), ("cc-by-sa", "share alike"), ("cc-by-nc", "noncommercial"),
                          ("cc-by-nc", "non commercial"))],
]


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


@dataclass
class Automaton:
    """States 0.. over words: ``step[state]`` maps a word to the next state,
    ``loose[state]`` is the next state on any word, ``skip[state]`` the states
    reached without a word. ``wording``: mandatory words on the way."""

    label: str
    step: list[dict]
    loose: list[list[int]]
    skip: list[set[int]]
    final: int
    wording: int
    needs: frozenset

    def closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int, memo: dict) -> int:
        """End of the longest accepted run of words from ``at`` on, or -1."""
        states, end = self.closure({0}), -1
        i, n = at, len(words)
        while states:
            if self.final in states:
                end = i
            if i == n:
                break
            key = (states, words[i])
            if key not in memo:
                memo[key] = self.closure({s for x in states for s in (
                    *([self.step[x][words[i]]] if words[i] in self.step[x] else ()), *self.loose[x])})
            states = memo[key]
            i += 1
        return end


def compile_template(label: str, markup: str, max_var: int = MAX_VAR) -> Automaton:
    """Compile; a template without mandatory words, or with unbalanced marks, is an error."""
    a = Automaton(label, [{}], [[]], [set()], 0, 0, frozenset())

    def state() -> int:
        a.step.append({})
        a.loose.append([])
        a.skip.append(set())
        return len(a.step) - 1

    at, opened, last, need = 0, [], 0, set()
    inside = 0  # optional regions around

    def literal(text: str) -> None:
        nonlocal at
        for w in words_of(text.encode()):
            s = state()
            a.step[at][w] = s
            at = s
            if not inside:
                a.wording += 1
                need.add(w)

    for m in _MARK.finditer(markup):
        if not (opened and opened[-1][0] == "var"):
            literal(markup[last:m.start()])  # what a variable region says is an example
        last = m.end()
        if not m[1]:
            opened.append((m[2], at, int(m[3] or max_var)))
            if m[2] == "optional":
                s = state()  # a state of its own, so what is before the region can't re-enter it
                a.skip[at].add(s)
                opened[-1] = (m[2], s, 0)
                at, inside = s, inside + 1
            continue
        if not opened or opened[-1][0] != m[2]:
            raise ValueError(f"unbalanced <</{m[2]}>> in the template of {label}")
        kind, began, most = opened.pop()
        end = state()
        if kind == "optional":
            a.skip[at].add(end)
            a.skip[began].add(end)
            inside -= 1
        else:
            for _ in range(most):
                s = state()
                a.loose[at].append(s)
                a.skip[s].add(end)
                at = s
        at = end
    if opened:
        raise ValueError(f"unbalanced marks in the template of {label}")
    literal(markup[last:])
    if not need:
        raise ValueError(f"the template of {label} has no mandatory wording")
    a.final, a.needs = at, frozenset(need)
    return a


class Scanner:
    """Base phrases and automata; ``scan`` takes the words of a text."""

    def __init__(self, base: list[tuple[str, str]], templates: list[tuple[str, str]]):
        self.base = [(words_of(p.encode()), label) for p, label in base]
        self.automata = [compile_template(*t) for t in templates]
        self.memos: list[dict] = [{} for _ in templates]
        self.firsts: dict[bytes, list[int]] = {}
        for k, a in enumerate(self.automata):
            for s in a.closure({0}):
                for w in a.step[s]:
                    self.firsts.setdefault(w, []).append(k)
                if a.loose[s]:
                    raise ValueError(f"the template of {a.label} begins with a variable region")
        self.phrases: dict[bytes, list[int]] = {}
        for k, (p, _) in enumerate(self.base):
            self.phrases.setdefault(p[0], []).append(k)
        # a text without one of the rarest necessary words has no match
        need = [max(a.needs, key=len) for a in self.automata] + [max(p, key=len) for p, _ in self.base]
        self.needs = re.compile(b"|".join(re.escape(w) for w in sorted(set(need))))

    def scan(self, words: list[bytes]) -> dict:
        places, labels, found, best = [], set(), [], 0
        for i, w in enumerate(words):
            for k in self.phrases.get(w, ()):
                p, label = self.base[k]
                if words[i:i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
            for k in self.firsts.get(w, ()):
                a = self.automata[k]
                if len(self.memos[k]) > 50_000:
                    self.memos[k].clear()
                end = a.longest(words, i, self.memos[k])
                if end > i:
                    found.append((a.label, i, end))
                    best = max(best, a.wording)
        return {"places": places, "base": labels, "found": found, "wording": best}


RESULT = "n_words bigint, places array<bigint>, base array<string>, found array<struct<label:string,first:bigint,last:bigint>>, wording bigint"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: list | None = None,
                  templates: list | None = None) -> DataFrame:
    """One row per document: ``id_col, n_words, places, base, found, wording``.

    ``places``: starts of the base phrases (words from 0); ``base``: their
    labels; ``found``: label, first and last word of each accepted run (the longest
    from its start); ``wording``: mandatory words of the best accepted template.
    Defined results: a null or empty text has no words, places or labels;
    overlapping places count each; repeated rows are judged each; other
    columns are not read; no rows in, no rows out.
    """
    base, templates = BASE if base is None else base, TEMPLATES if templates is None else templates
    Scanner(base, templates)  # a bad template fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        nothing = {"places": [], "base": (), "found": [], "wording": 0}
        for b in batches:
            data, offs = text_bytes(column(b, "text"))
            count, rows = [np.zeros(0, np.int64)], []
            for a, z in blocks(offs):
                w = Words(data, offs[a:z + 1])
                count.append(np.diff(w.first))
                for r in range(z - a):
                    text = w.low[w.offsets[r]:w.offsets[r + 1]].tobytes()
                    rows.append(scanner.scan(_WORD.findall(text)) if scanner.needs.search(text) else nothing)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.concatenate(count)), pa.array([r["places"] for r in rows], pa.list_(pa.int64())),
                pa.array([sorted(r["base"]) for r in rows], pa.list_(pa.string())),
                pa.array([[{"label": x, "first": i, "last": j - 1} for x, i, j in r["found"]] for r in rows],
                         pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))),
                pa.array([r["wording"] for r in rows], pa.int64())],
                ["id", "n_words", "places", "base", "found", "wording"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, {RESULT}").withColumnRenamed("id", id_col)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Places and labels as columns. ``score``: words of the longest mandatory wording found (of a base
    phrase three) on a scale where eight are certain; 0 without a label."""
    labels = F.array_sort(F.array_union("base", F.transform("found", lambda x: x["label"])))
    sure = F.least(F.greatest(F.col("wording"), F.when(F.size("places") > 0, 3).otherwise(0)) / 8.0, F.lit(1.0))
    return scanned.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_distinct(labels), ",").alias("labels"), sure.cast("double").alias("score"),
        F.size("found").cast("long").alias("n_found"))
