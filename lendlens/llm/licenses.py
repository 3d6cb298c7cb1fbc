"""License scans with a generalised suffix automaton of licence words.

The automaton holds all templates. A text is streamed through it once; at each word it gives the
matching statistic, the length of the longest run of words ending there that some template has.
Matches that cannot be extended are chained, in text and template order, into spans that cover a
template; a template covered well enough gives its label. Base phrases are templates too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, id_and_text, slices

# Base phrases and their labels, and sentences of public licence notices.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files",
    "apache": "licensed under the apache license version 2 0 the license you may not use this "
    "file except in compliance with the license",
    "gpl": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with "
    "or without fee is hereby granted",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
}
LEAST_MATCH = 4
MAX_GAP = 20
LEAST_COVER = 0.6
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])),
        ),
    ]
)
_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,start:long,end:long,cover:double>>"
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool


TEMPLATES = [
    *[Template(label, tuple(text.split()), True) for text, label in BASE_PHRASES.items()],
    *[Template(label, tuple(text.split()), False) for label, text in NOTICES.items()],
]


def read_templates(rows: DataFrame, most_words: int = 2_000_000) -> list[Template]:
    """Templates of a table ``label, text`` (base phrases stay), for ``scan_licenses``.

    The automaton is on the driver and in every task, so a table of more than ``most_words`` words is
    refused. Rows with a NULL and equal rows do not count.
    """
    rows = rows.select("label", "text").dropna().distinct()
    words = rows.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    if words > most_words:
        raise ValueError(f"{words} words of templates, at most {most_words}")
    found = [Template(row.label, tuple(words_of(row.text)), False) for row in rows.orderBy("label", "text").collect()]
    return [template for template in TEMPLATES if template.base] + [t for t in found if t.words]


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.translate(_UPPER))


class Automaton:
    """States have a longest length, a suffix link, transitions by word, and template places."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in templates for w in t.words}))}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[set[tuple[int, int]]] = [set()]
        for number, template in enumerate(templates):
            last = 0
            for end, word in enumerate(template.words):
                last = self._extend(last, self.vocabulary[word])
                while len(places) < len(self.next):
                    places.append(set())
                places[last].add((number, end))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            places[self.link[state]] |= places[state]
        self.places = places
        self.phrases = [
            [(n, len(templates[n].words)) for n, end in sorted(p) if templates[n].base and end == len(templates[n].words) - 1]
            for p in places
        ]
        self._inherit_phrases()

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            if self.length[target] != self.length[at] + 1:
                target = self._split(at, word, target)
            self.link[state] = target
        return state

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _inherit_phrases(self) -> None:
        """Whole base phrases that end a state's string, its suffixes included."""
        self.phrases[0] = []
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            known = {n for n, _ in self.phrases[self.link[state]]}
            own = [x for x in self.phrases[state] if x[0] not in known and x[1] <= self.length[state]]
            self.phrases[state] = self.phrases[self.link[state]] + own

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0


def _runs(known: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of two or more words that are all in the vocabulary; other words reset the state."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], known.astype(np.int8), [0]])))
    return [(s, e) for s, e in edges.reshape(-1, 2).tolist() if e - s > 1]


def _chain(matches: list[tuple[int, int, int]]) -> list[tuple[int, list]]:
    """Best collinear chains of (text start, template start, length): covered words and matches."""
    matches = sorted(matches)
    longest = max((n for _, _, n in matches), default=0)
    best: list[tuple[int, int | None]] = []
    for i, (x, y, n) in enumerate(matches):
        choice = (n, None)
        for j in range(i - 1, -1, -1):
            x2, y2, n2 = matches[j]
            if x - x2 > longest + MAX_GAP:  # even the longest ends too early
                break
            new = min(n, y + n - y2 - n2, x + n - x2 - n2)
            if new > 0 and y > y2 and x > x2 and x - x2 - n2 <= MAX_GAP and y - y2 - n2 <= MAX_GAP:
                choice = max(choice, (best[j][0] + new, j), key=lambda c: c[0])
        best.append(choice)
    used, chains = set(), []
    for i in sorted(range(len(best)), key=lambda i: -best[i][0]):
        path, at = [], i
        while at is not None and at not in used:
            path.append(matches[at])
            used.add(at)
            at = best[at][1]
        if path:
            chains.append((sum(n for _, _, n in path), path[::-1]))
    return chains


def scan_words(words: list[str], automaton: Automaton) -> dict:
    get = automaton.vocabulary.get
    ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
    base: list[tuple[int, int]] = []
    matches: dict[int, list[tuple[int, int, int]]] = {}
    for start, end in _runs(ids >= 0):
        state = length = 0
        for at in range(start, end + 1):
            before, was = state, length
            word = int(ids[at]) if at < end else -1
            state, length = automaton.step(state, length, word) if at < end else (0, 0)
            if was >= LEAST_MATCH and length != was + 1:
                for number, last in automaton.places[before]:
                    matches.setdefault(number, []).append((at - was, last - was + 1, was))
            for number, n in automaton.phrases[state]:
                if n <= length:
                    base.append((at - n + 1, number))
    templates = automaton.templates
    spans = [(templates[n].label, s, s + len(templates[n].words), 1.0) for s, n in base]
    for number, found in matches.items():
        template = templates[number]
        if template.base:
            continue
        for _, path in _chain(found):
            covered = set()
            for _, y, n in path:
                covered.update(range(y, y + n))
            cover = len(covered) / len(template.words)
            if cover >= LEAST_COVER:
                spans.append((template.label, path[0][0], path[-1][0] + path[-1][2], cover))
    starts = [start for start, _ in base]
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({templates[n].label for _, n in base})),
        "labels": ",".join(sorted({span[0] for span in spans})),
        "score": float(max((span[3] for span in spans), default=0.0)),
        "spans": [dict(zip(("label", "start", "end", "cover"), span)) for span in sorted(spans)],
    }


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """A row per input row: word count, base places, labels, score and covered spans.

    A NULL text is empty: no words, no places, empty labels, score 0. ``score`` is the largest
    covered share of a template. Repeated rows and NULL ids each give a row. A text is one stream,
    however long.
    """

    def run(batches):
        automaton = Automaton(templates or TEMPLATES)
        for batch in slices(batches):
            ids, texts = (column.to_pylist() for column in batch.columns)
            found = [scan_words(words_of(text), automaton) for text in texts]
            columns = [[x[name] for x in found] for name in _SCHEMA.names[1:]]
            yield batch_of(_SCHEMA, [ids, *columns])

    return id_and_text(docs).mapInArrow(run, _DDL)
