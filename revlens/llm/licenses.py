"""License scan by template automata.

Templates are written in a small markup over words: plain words are mandatory, ``[...]`` is an
optional region, ``<n>`` stands for a replaceable region of 0 to n words. A template is compiled
into a token automaton; a place in a text is a match when the automaton accepts the words there,
so the mandatory wording must stand exactly and only marked regions may differ.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices

#: The base phrases, whose labels are counted apart.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Wording of public licenses and of the notices that name them.
TEMPLATES = {
    "apache-2.0": ["[licensed] under the apache license [version] 2 0", "apache license version 2 0 january 2004"],
    "bsd-2-clause": [
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met [1] redistributions of source code must retain the above copyright "
        "notice this list of conditions and the following disclaimer [2] redistributions in binary form must "
        "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution <4> this software is provided by"],
    "bsd-3-clause": ["neither the name of <12> nor the names of [its] contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission"],
    "cc-by-nc": ["[licensed under] [the] cc by nc <2> 0", "creative commons attribution noncommercial <2> 0 <2> license"],
    "cc-by-sa": ["[licensed under] [the] cc by sa <2> 0", "creative commons attribution sharealike <2> 0 <2> license"],
    "gpl-2.0": ["gnu general public license [as published by the free software foundation] [either] version 2"],
    "gpl-3.0": ["gnu general public license [as published by the free software foundation] [either] version 3"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "mit": [
        "[released] [licensed] under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files <3> to deal in [the] software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"],
    "mpl-2.0": ["[this source code form is] subject to the terms of the mozilla public license v 2 0"],
    "copyright-notice": ["copyright [c] <8> all rights reserved"],
}

#: Word bytes after A-Z are lower-cased: digits, small letters and everything beyond ASCII.
_TO_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TO_WORDS).split()


@dataclass(frozen=True)
class Automaton:
    """``steps[s]``: the word that state s takes (None: any); ``skips[s]``: states that s also
    stands for; the last state accepts."""

    label: str
    base: bool
    steps: tuple
    skips: tuple

    @property
    def accept(self) -> int:
        return len(self.steps)

    def closure(self, state: int) -> set[int]:
        found, todo = set(), [state]
        while todo:
            s = todo.pop()
            if s not in found:
                found.add(s)
                todo += self.skips[s]
        return found


def compile_template(label: str, markup: str, base: bool = False) -> Automaton:
    steps: list[bytes | None] = []
    skips: list[list[int]] = [[]]
    opened: list[int] = []
    for sign in re.findall(r"\[|\]|<\d+>|[^\s\[\]<>]+", markup):
        if sign == "[":
            opened.append(len(steps))
        elif sign == "]":
            skips[opened.pop()].append(len(steps))
        elif sign[0] == "<":
            for _ in range(int(sign[1:-1])):
                skips[-1].append(len(steps) + 1)
                steps.append(None)
                skips.append([])
        else:
            steps.append(sign.encode())
            skips.append([])
    if opened or not any(steps):
        raise ValueError(f"not a template: {markup!r}")
    return Automaton(label, base, tuple(steps), tuple(map(tuple, skips)))


class Scanner:
    """All automata side by side; ``matches`` gives (label, base, start, length) of every start
    place at which one of them accepts (its shortest acceptance there)."""

    def __init__(self, base: dict[str, str], templates: dict[str, list[str]]):
        self.automata = [compile_template(v, k, True) for k, v in base.items()] + [
            compile_template(label, markup) for label, many in templates.items() for markup in many]
        self.closures = [[frozenset(a.closure(s)) for s in range(a.accept + 1)] for a in self.automata]
        self.first: dict[bytes, list[int]] = {}
        for k, a in enumerate(self.automata):
            starts = {a.steps[s] for s in self.closures[k][0] if s < a.accept}
            if None in starts or a.accept in self.closures[k][0]:
                raise ValueError(f"{a.label}: a template must begin with a word")
            for w in starts:
                self.first.setdefault(w, []).append(k)
        #: every match holds one of these words: each automaton's longest mandatory one
        self.needed = {max(self._mandatory(k), key=lambda w: (len(w), w)) for k in range(len(self.automata))}

    def _mandatory(self, k: int) -> set[bytes]:
        a = self.automata[k]
        out = set()
        for s, word in enumerate(a.steps):
            jumped = any(t > s for r in range(s + 1) for t in a.skips[r])
            if word is not None and not jumped:
                out.add(word)
        return out

    def matches(self, words: list[bytes]) -> list[tuple[str, bool, int, int]]:
        if self.needed.isdisjoint(words):
            return []
        out = []
        first = self.first
        for at, word in enumerate(words):
            for k in first.get(word, ()):
                length = self._accepts(k, words, at)
                if length:
                    a = self.automata[k]
                    out.append((a.label, a.base, at, length))
        return out

    def _accepts(self, k: int, words: list[bytes], at: int) -> int:
        a, closures = self.automata[k], self.closures[k]
        states = closures[0]
        for i in range(at, len(words)):
            word, reached = words[i], set()
            for s in states:
                if s < a.accept and (a.steps[s] is None or a.steps[s] == word):
                    reached |= closures[s + 1]
            if a.accept in reached:
                return i + 1 - at
            if not reached:
                return 0
            states = reached
        return 0


MATCH = T.StructType([T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
                      T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
SCANNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("matches", T.ArrayType(MATCH)), T.StructField("n_covered", T.LongType())])


def scan(docs: DataFrame, base: dict[str, str] | None = None,
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_words, matches (label, base, start, length in words) and n_covered (words that
    lie in some match) of every whole text.

    Null and empty texts have no words and no matches; repeated rows are scanned each; matches
    may overlap. Columns other than doc_id and text are not read.
    """
    base = BASE if base is None else base
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()),
                                   ("start", pa.int64()), ("length", pa.int64())]))
        for batch in slices(batches):
            counts, found, covered = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                hits = scanner.matches(words)
                counts.append(len(words))
                found.append([dict(zip(MATCH.names, h)) for h in hits])
                covered.append(len({i for _, _, at, n in hits for i in range(at, at + n)}) if hits else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(covered, pa.int64())],
                names=SCANNED.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCANNED)


def summarize(scanned: DataFrame) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, and score (the
    share of its words that lie in a match; 0 without words)."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    names = lambda rows: F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda m: m["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(0.0).alias("score"))
