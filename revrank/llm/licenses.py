"""Licence notices by a positional index of their rare words.

Every notice (template) is a run of words with mandatory key phrases. Document frequencies
over the corpus weigh the words. The index holds postings: for each word the notices, and the
places in them, of whose mandatory words it is the rarest. The licence words of a text that have
postings are looked up, whatever the number of notices; each posting votes for the place where
its notice would begin. There the mandatory words are intersected by their relative positions,
and where all are in place, the other words: with enough of their weight it is a find. As a
mandatory word is always looked up, no exact occurrence of the phrases is missed.

Defined results: words are runs of ASCII letters and digits and of all signs beyond ASCII,
lower-cased in A-Z. A null or empty text has no words and no finds; repeated rows are scanned
each; very long texts are scanned whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrank.llm.words import LETTERS, Words, slices


@dataclass(frozen=True)
class Template:
    """A notice; ``phrases`` are the parts of ``text`` that must be there word for word."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @classmethod
    def phrase(cls, label: str, text: str) -> Template:
        return cls(label, text, (text,))


#: The base phrases and their labels.
BASE = (
    Template.phrase("cc-by", "cc by"),
    Template.phrase("gpl", "general public license"),
    Template.phrase("reserved", "all rights reserved"),
)
#: Further notices, as public licences word them, with their key phrases.
NOTICES = (
    Template.phrase("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license", "you may not use this file except in compliance with the license"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "the following conditions are met"),
    ),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "released into the public domain")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template(
        "gpl-or-later",
        "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license as published by the free software foundation", "or at your option any later version"),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("cc0", "dedicated to the public domain under cc0", ("cc0",)),
)
#: Share of a template's words that must stand in position.
SUPPORT = 0.6


#: Places of notices compared with texts at once.
CHUNK = 1 << 19


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths, one after another: each row's run, and its place in it."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


class Index:
    """Postings of the templates' words; ``rarity`` maps a word to its weight (default 1)."""

    def __init__(self, templates: tuple[Template, ...], rarity: dict[str, float] | None = None):
        self.templates = templates
        self.words = sorted({w for t in templates for w in t.text.split()})
        hashes = Words([w.encode() for w in self.words], LETTERS).hashes()
        order = np.argsort(hashes)
        self.known, self.number = hashes[order], order
        at = {w: i for i, w in enumerate(self.words)}
        weight = rarity or {}
        row, weights, mandatory, lead, lookups = [], [], [], [], []
        for k, t in enumerate(templates):
            own = [at[w] for w in t.text.split()]
            needed = np.zeros(len(own), dtype=bool)
            for i, phrase in enumerate(t.phrases):
                words = [at[w] for w in phrase.split()]
                start = next(j for j in range(len(own)) if own[j : j + len(words)] == words)
                needed[start : start + len(words)] = True
                if not i:
                    lead.append(start)
            heavy = np.array([weight.get(w, 1.0) for w in t.text.split()])
            rarest = int(np.where(needed, heavy, -1.0).argmax())
            lookups.append((own[rarest], k, rarest))
            row, weights, mandatory = row + own, [*weights, heavy], [*mandatory, needed]
        #: Of all templates, one after another: word numbers, weights, mandatory places; where each begins.
        self.row, self.weight, self.needed = np.array(row), np.concatenate(weights), np.concatenate(mandatory)
        self.size = np.array([len(w) for w in weights])
        self.begin = np.cumsum(self.size) - self.size
        self.total = np.add.reduceat(self.weight, self.begin)
        self.lead = np.array(lead)
        # Postings: of each word a run of (template, place).
        lookups.sort()
        self.posted = np.array([(k, place) for _, k, place in lookups])
        self.runs = np.bincount([w for w, _, _ in lookups], minlength=len(self.words))
        self.starts = np.cumsum(self.runs) - self.runs

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary of the templates, or -1."""
        at = np.searchsorted(self.known, hashes).clip(max=len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.number[at], -1)

    def _match(self, numbers: np.ndarray, doc: np.ndarray, template: np.ndarray, start: np.ndarray, here: np.ndarray, needed: bool) -> np.ndarray:
        """Weight of a template's words that stand in position, or, of ``needed`` ones, whether all do."""
        run, place = spread(self.size[template])
        if needed:
            keep = self.needed[self.begin[template[run]] + place]
            run, place = run[keep], place[keep]
        own = self.begin[template[run]] + place
        spot = start[run] + place
        # Words of other texts and beyond the ends count as others.
        inside = (spot >= 0) & (spot < len(numbers))
        spot = np.where(inside, spot, 0)
        same = inside & (numbers[spot] == self.row[own]) & (doc[spot] == here[run])
        heads = np.flatnonzero(np.diff(run, prepend=-1))
        if needed:
            return np.logical_and.reduceat(same, heads)
        return np.add.reduceat(same * self.weight[own], heads)

    def find(self, numbers: np.ndarray, doc: np.ndarray | None = None) -> tuple[np.ndarray, ...] | list[tuple]:
        """Finds of several texts (``doc`` is each word's text) in order of place: text, template, first word
        of its first phrase (a place in ``numbers``), and support. Without ``doc`` there is one text, and
        each find is (template, first word, support)."""
        if doc is None:
            return list(zip(*self.find(numbers, np.zeros(len(numbers), dtype=np.int64))[1:]))
        spots = np.flatnonzero(numbers >= 0)
        spots = spots[self.runs[numbers[spots]] > 0]
        out = []
        step = max(1, CHUNK // max(1, int(self.runs.max()) * int(self.size.max())))
        for first in range(0, len(spots), step):
            some = spots[first : first + step]
            run, place = spread(self.runs[numbers[some]])
            template, offset = self.posted[self.starts[numbers[some[run]]] + place].T
            start, here = some[run] - offset, doc[some[run]]
            if not len(start):
                continue
            whole = self._match(numbers, doc, template, start, here, needed=True)
            template, start, here = template[whole], start[whole], here[whole]
            if not len(start):
                continue
            support = self._match(numbers, doc, template, start, here, needed=False) / self.total[template]
            enough = support >= SUPPORT
            out.append(np.array([here[enough], template[enough], (start + self.lead[template])[enough], support[enough]]))
        here, template, word, support = np.concatenate(out, axis=1) if out else np.zeros((4, 0))
        order = np.lexsort((template, word, here))
        return here[order].astype(np.int64), template[order].astype(np.int64), word[order].astype(np.int64), support[order]


def document_frequencies(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = BASE + NOTICES) -> tuple[dict[str, int], int]:
    """In how many of all texts each licence word is, and how many texts there are.

    Each task counts its own texts, so a few hundred numbers a task are moved.
    """
    index = Index(templates)

    def count(batches):
        seen, rows = np.zeros(len(index.words), dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for part in slices(batch.column(0).to_pylist()):
                words = Words(part, LETTERS)
                numbers = index.numbers(words.hashes())
                hit = numbers >= 0
                pairs = np.unique(words.doc[hit] * len(index.words) + numbers[hit])
                seen += np.bincount(pairs % len(index.words), minlength=len(index.words))
        yield pa.RecordBatch.from_pydict({"word": [*index.words, None], "n": [*seen.tolist(), rows]}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    counted = docs.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counted.collect()}
    return found, found.pop(None, 0)


_FIND = T.StructType().add("label", T.StringType()).add("word", T.LongType()).add("base", T.BooleanType()).add("support", T.DoubleType())
_SCAN = T.StructType().add("n_words", T.LongType()).add("finds", T.ArrayType(_FIND))
_SCAN_TYPE = pa.struct(
    [("n_words", pa.int64()), ("finds", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_()), ("support", pa.float64())])))]
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """(id_col, n_words, finds) of each row; ``finds`` holds label, word, base, support by place.

    Word weights are inverse document frequencies of the whole table.
    """
    templates = base + notices
    frequency, rows = document_frequencies(docs, text_col, templates)
    rarity = {w: float(np.log((rows + 1) / (n + 1)) + 1) for w, n in frequency.items()}
    index = Index(templates, rarity)

    @F.arrow_udf(_SCAN)
    def scanned(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts.to_pylist()):
            words = Words(part, LETTERS)
            numbers = index.numbers(words.hashes())
            doc, template, word, support = index.find(numbers, words.doc)
            first = np.searchsorted(doc, np.arange(len(part) + 1))
            for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                rows = zip(template[a:b].tolist(), (word[a:b] - words.first[i]).tolist(), support[a:b].tolist())
                finds = [{"label": templates[k].label, "word": w, "base": k < len(base), "support": s} for k, w, s in rows]
                out.append({"n_words": int(words.first[i + 1] - words.first[i]), "finds": finds})
        return pa.array(out, type=_SCAN_TYPE)

    return docs.select(F.col(id_col), scanned(F.col(text_col)).alias("s")).select(id_col, "s.*")


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and places of base phrases, labels, and a score: the best support of any notice.

    A base phrase by itself supports half; a find of a longer notice its share of weight.
    """
    base = F.filter("finds", lambda f: f["base"])

    def labels(finds):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda f: f["label"]))), ",")

    supports = F.transform("finds", lambda f: F.when(f["base"], f["support"] * 0.5).otherwise(f["support"]))
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda f: f["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f["word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(supports), F.lit(0.0)).alias("score"),
    )
