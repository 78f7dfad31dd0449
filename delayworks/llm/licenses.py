"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of the licence templates. Reading a text word by word gives its matching
statistics: for each word, the longest run ending there that some template holds. Runs that cannot be extended and are
long enough are matches; matches of one template that follow each other in both text and template are chained into a
span, and the share of the template's words that a span covers is its coverage. A span with enough coverage labels the
text. Fixed phrases are templates too and are found at every place where the statistics hold them whole.

Text is streamed: the work per word is constant on average, and words that no template has are passed over at once.

Defined cases: a null or empty text has no word and no label; rows are scanned one by one, so repeated rows give equal
results; an empty table gives an empty result; only the named text column is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from delayworks.llm.common import pieces

#: Phrases that are counted, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Passages of public licences and the notices that name them.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission", "bsd-3"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any later "
     "version", "gpl-3"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license version 3", "agpl-3"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4"),
    ("licensed under cc by 4 0", "cc-by-4"),
)
#: Words of a match outside a chain, coverage that labels a text, words of text that a chain may skip.
LEAST_WORDS = 4
COVERAGE = 0.7
GAP = 40

WORD_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class SuffixAutomaton:
    """States of all runs of the templates; ``ends[state]`` lists (template, last word) of every occurrence."""

    def __init__(self, templates: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size, self.ends = [-1], [0], [set()]
        for t, words in enumerate(templates):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].add((t, at))
        for state in sorted(range(1, len(self.size)), key=lambda v: -self.size[v]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _new(self, size: int, step: dict[int, int], link: int) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of exactly ``size[state] + 1`` words behind ``state``: ``target`` itself, or its shorter half cut off."""
        if self.size[target] == self.size[state] + 1:
            return target
        half = self._new(self.size[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = half
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = half
            state = self.link[state]
        return half

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        new = self._new(self.size[last] + 1, {}, 0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.step[last][word])
        return new

    def statistics(self, words: list[int]):
        """(state, length) of the longest template run that ends at each word."""
        step, link, size = self.step, self.link, self.size
        state = length = 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            target = step[state].get(word)
            if target is None:
                length = 0
            else:
                state, length = target, length + 1
            yield state, length


@dataclass
class Match:
    start: int  # in the text
    end: int
    state: int


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least: int = LEAST_WORDS, coverage: float = COVERAGE, gap: int = GAP):
        self.least, self.coverage, self.gap = least, coverage, gap
        self.labels = [label for _, label in (*phrases, *templates)]
        split = [words_of(text) for text, _ in (*phrases, *templates)]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in split for w in t}), start=1)}
        self.templates = [[self.vocabulary[w] for w in t] for t in split]
        self.automaton = SuffixAutomaton(self.templates)
        self.shortest = min(len(t) for t in self.templates)
        self.phrases = [(k, len(split[k])) for k in range(len(phrases))]
        # phrases that are a suffix of a state's runs, if the run is long enough
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.automaton.size]
        for k, n in self.phrases:
            for state, ends in enumerate(self.automaton.ends):
                if (k, n - 1) in ends and self.automaton.size[state] >= n:
                    self.whole[state].append((k, n))
            own = self._state_of(self.templates[k])
            for state in range(len(self.automaton.size)):
                if (k, n) not in self.whole[state] and self._descends(state, own):
                    self.whole[state].append((k, n))

    def _state_of(self, words: list[int]) -> int:
        state = 0
        for w in words:
            state = self.automaton.step[state][w]
        return state

    def _descends(self, state: int, ancestor: int) -> bool:
        while state > 0 and state != ancestor:
            state = self.automaton.link[state]
        return state == ancestor

    def scan(self, words: list[bytes]) -> dict:
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words], np.int32)
        places: list[tuple[int, int]] = []
        matches: list[Match] = []
        known = np.flatnonzero(ids)
        if len(known) >= self.shortest:
            breaks = np.flatnonzero(np.diff(known) > 1) + 1
            begins, ends = known[np.concatenate([[0], breaks])], known[np.concatenate([breaks - 1, [len(known) - 1]])] + 1
            long = ends - begins >= self.shortest
            for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
                self._run(ids[begin:end].tolist(), begin, places, matches)
        spans = self.chain(matches)
        labels = {self.labels[k] for _, k in places}
        good = [s for s in spans if s["coverage"] >= self.coverage]
        return {
            "n_words": len(words), "n_base": len(places),
            "first_word": min((p for p, _ in places), default=None), "last_word": max((p for p, _ in places), default=None),
            "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {s["label"] for s in good})),
            "score": 1.0 if places else max((s["coverage"] for s in spans), default=0.0), "spans": good,
        }

    def _run(self, ids: list[int], offset: int, places: list, matches: list) -> None:
        before, at = (0, 0), -1
        for at, (state, length) in enumerate(self.automaton.statistics(ids)):
            if length <= before[1]:
                self._keep(before, offset + at, matches)
            for k, n in self.whole[state]:
                if length >= n:
                    places.append((offset + at - n + 1, k))
            before = (state, length)
        self._keep(before, offset + at + 1, matches)

    def _keep(self, found: tuple[int, int], end: int, matches: list) -> None:
        state, length = found
        if length >= self.least or length >= self.shortest and self.whole[state]:
            matches.append(Match(end - length, end, state))

    def chain(self, matches: list[Match]) -> list[dict]:
        """Covered template spans. Matches come in order of their end; each template keeps one open chain."""
        open_: dict[int, list[int]] = {}  # template: text start, text end, template end, covered words
        done: list[dict] = []

        def close(t: int) -> None:
            start, end, _, covered = open_.pop(t)
            done.append({"label": self.labels[t], "start": start, "end": end, "coverage": covered / len(self.templates[t])})

        for m in matches:
            n = m.end - m.start
            places: dict[int, list[int]] = {}
            for t, last in self.automaton.ends[m.state]:
                places.setdefault(t, []).append(last)
            for t, lasts in places.items():
                if t in open_:
                    start, end, upto, covered = open_[t]
                    ahead = [x for x in lasts if x >= upto]
                    if m.start - end <= self.gap and ahead:
                        last = min(ahead)
                        gained = min(n, last + 1 - upto, m.end - end)
                        open_[t] = [start, m.end, last + 1, covered + max(0, gained)]
                        continue
                    close(t)
                last = min(lasts)
                open_[t] = [m.start, m.end, last + 1, n]
        for t in list(open_):
            close(t)
        return done


SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
RESULT = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))])
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label: string, start: long, end: long, coverage: double>>")


def scan(text: Column | str, phrases=PHRASES, templates=TEMPLATES, least: int = LEAST_WORDS, coverage: float = COVERAGE, gap: int = GAP) -> Column:
    """Struct of what a whole text holds: see ``SCHEMA``. Spans are in words, their end not included."""
    scanner = Scanner(phrases, templates, least, coverage, gap)

    @F.arrow_udf(SCHEMA)
    def scanned(column: pa.Array) -> pa.Array:
        rows = [scanner.scan(words_of(t)) for piece in pieces(column) for t in piece.to_pylist()]
        return pa.array(rows, RESULT)

    return scanned.asNondeterministic()(F.col(text) if isinstance(text, str) else text)
