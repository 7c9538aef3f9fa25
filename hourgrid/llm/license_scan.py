"""License notices: exact set-similarity join of text blocks with templates.

A text's words are cut into blocks of `BLOCK` words that start every `STEP` words. A block matches a template if it holds at
least `percent` of the template's distinct words. All such pairs are found, without comparing every block with every
template:

* order: the words of all templates are ordered by the number of documents that hold them, rarest first;
* prefix: of n words of which k are needed, one of the rarest n - k + 1 must be shared, in the template and, among the block's own
  template words, in the block; only blocks with such a word are looked at;
* length: a block with fewer template words than needed is left out;
* position: a shared word with too few words after it in either order cannot lead to enough shared words;
* what is left is counted word by word.

The templates are a parameter, so their index is as small as they are; documents are read twice, once for the counts of
the templates' words (summed before the shuffle) and once for the join, which shuffles nothing.

Texts are taken whole, null texts are empty, and each row gives one row, repeated ones too. Templates without words are
left out; equal templates match alike. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import arrow_rows, text_bytes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK, STEP = 64, 32

#: Phrases whose places are counted.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Notices as their licenses word them.
TEMPLATES = (
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
            " Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

MATCH = "array<struct<label string, template int, first_word bigint, shared int, containment double>>"
SCHEMA = (
    "doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    f"matches {MATCH}"
)


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


def document_counts(documents: DataFrame, words: Iterable[bytes]) -> dict[bytes, int]:
    """Number of documents that hold each of `words`; the driver gets one number a word."""
    asked = F.array(*(F.lit(w.decode()) for w in sorted(words)))
    own = F.split(F.translate(F.col("text"), CAPITALS, CAPITALS.lower()), BETWEEN)
    held = documents.select(F.explode(F.array_intersect(own, asked)).alias("word"))
    return {r.word.encode(): r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}


class Templates:
    """Templates as sets of word ranks (rarest first), with an index of their prefixes."""

    def __init__(self, templates: Sequence[tuple[str, str]], percent: int, counts: dict[bytes, int]):
        sets = [(label, set(words_of(text.encode()))) for label, text in templates]
        known = sorted(set().union(*(s for _, s in sets)), key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(known)}
        self.labels = [label for label, _ in sets]
        self.sets = [sorted(self.rank[w] for w in s) for _, s in sets]
        self.members = [frozenset(s) for s in self.sets]
        self.need = [max(-(-percent * len(s) // 100), 1) for s in self.sets]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, ranks in enumerate(self.sets):
            for at, r in enumerate(ranks[: max(len(ranks) - self.need[t] + 1, 0)]):
                self.prefixes.setdefault(r, []).append((t, at))
        self.rare = frozenset(w for w, r in self.rank.items() if r in self.prefixes)

    def matching(self, block: Iterable[bytes]) -> Iterator[tuple[int, int]]:
        """(template, words shared) of a block of words."""
        own = sorted({self.rank[w] for w in block if w in self.rank})
        tried = set()
        for j, r in enumerate(own):
            for t, i in self.prefixes.get(r, ()):
                need = self.need[t]
                # Length, and by position what this word and those after it can add up to in either order.
                if t in tried or len(own) < need or min(len(self.sets[t]) - i, len(own) - j) < need:
                    continue
                tried.add(t)
                shared = len(self.members[t].intersection(own))
                if shared >= need:
                    yield t, shared

    def find(self, words: list[bytes], block: int, step: int) -> list[dict]:
        """All matches, by first word and template."""
        starts = set()
        if not self.rare.isdisjoint(words):
            last = max(-(-(len(words) - block) // step), 0) * step
            for at, word in enumerate(words):
                if word in self.rare:
                    starts.update(range(max((at - block) // step + 1, 0) * step, min(at, last) + 1, step))
        return [
            {
                "label": self.labels[t],
                "template": t,
                "first_word": start,
                "shared": shared,
                "containment": shared / len(self.sets[t]),
            }
            for start in sorted(starts)
            for t, shared in sorted(self.matching(words[start : start + block]))
        ]


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """First words of all places where the phrase stands."""
    k, places, at = len(phrase), [], -1
    while phrase:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            break
        if words[at : at + k] == phrase:
            places.append(at)
    return places


def scan(
    documents: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    percent: int = 90,
    block: int = BLOCK,
    step: int = STEP,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, matches) for every row of `documents`.

    n_base counts places of the phrases, first_word and last_word are their smallest and largest start (null without one);
    matches lists every (block, template) pair that meets the threshold, with the words shared.
    """
    if not 0 < step <= block:
        raise ValueError("blocks must touch: 0 < step <= block")
    known = [(label, text) for label, text in templates if words_of(text.encode())]
    asked = set().union(*(words_of(text.encode()) for _, text in known)) if known else set()
    index = Templates(known, percent, document_counts(documents, asked)) if known else None
    wanted = [(label, words_of(text.encode())) for label, text in phrases]

    def judge(doc_id, text: bytes | None) -> tuple:
        words = words_of(text)
        places = [(label, phrase_places(words, phrase)) for label, phrase in wanted]
        starts = [p for _, found in places for p in found]
        return (
            doc_id,
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            sorted({label for label, found in places if found}),
            index.find(words, block, step) if index else [],
        )

    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            yield from arrow_rows((judge(i, t) for i, t in zip(ids, texts, strict=True)), out)

    schema = SCHEMA.format(kind=documents.schema["doc_id"].dataType.simpleString())
    taken = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = _arrow_schema(taken)
    return taken.mapInArrow(rows, schema)


def _arrow_schema(taken: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    match = pa.struct(
        [("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("shared", pa.int32()),
         ("containment", pa.float64())]
    )
    return pa.schema(
        [("doc_id", to_arrow_type(taken.schema["doc_id"].dataType)), ("n_words", pa.int64()), ("n_base", pa.int64()),
         ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
         ("matches", pa.list_(match))]
    )
