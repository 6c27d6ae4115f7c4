"""License scans by a positional rare-token index, as column expressions only.

The index holds, for every template (a licence's notice, or the usual way to name it),
the positions of its words. Of a file's words those that occur in a template are its
licence words; a first pass over all documents counts in how many each occurs. For
each template that can be there at all (all words of its mandatory key phrases occur
in the file), the file's ``RAREST`` licence words of highest inverse document
frequency are looked up: a word at place i of the file that the template has at
position p votes for the relative position i - p. Where the postings agree (at least
half of those looked up stand at one relative position), the key phrases are verified
in the file's words around that place, with ``SLACK`` words on either side.

Beside the templates, ``PHRASES`` are exact: a place is where all words of a phrase
stand consecutively.

Words are runs of characters other than ASCII signs and blanks, with A to Z lowered.
Every expression works on one row at a time: there is no shuffle but that of the
counts, pre-aggregated to at most one row a licence word and task, and nothing but
those counts (a few hundred) reaches the driver.

Defined cases: a null or empty text has no word, no place, no label and score 0; texts
of any length are read whole, and a licence is found as often as it occurs; rows that
repeat an id are rows of their own; ties between words of equal frequency go by the
word; further columns are returned as they were, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

#: What separates words: ASCII blanks, signs and controls.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAREST = 8
SLACK = 12
#: The one character beside I with a dot whose small letter is (in part) an ASCII letter.
KELVIN = "\u212a"

#: Exact phrases and their labels. Fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Templates: label, wording, mandatory key phrases. Wordings of public licences; fixed values.
TEMPLATES = [
    ("mit", "MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
     ["permission is hereby granted free of charge", "deal in the software without restriction"]),
    ("apache-2.0", "Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
     ["except in compliance with the license"]),
    ("gpl-2.0", "GNU General Public License, version 2", ["general public license version 2"]),
    ("gpl-3.0", "GNU General Public License, version 3", ["general public license version 3"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation",
     ["you can redistribute it and or modify it", "gnu general public license"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ["gnu lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ["gnu affero general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", ["redistribution and use in source and binary forms", "conditions are met"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ["for any purpose with or without fee is hereby granted"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license v 2 0"]),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
     ["eclipse public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software released into the public domain"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software",
     ["provided as is without any express or implied warranty", "arising from the use of this software"]),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or "
            "her rights to the work worldwide under copyright law", ["dedicated the work to the public domain"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0 international"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
]


def words_of(text: str) -> list[str]:
    """The words of a fixed text (ASCII)."""
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def words(text: Column) -> Column:
    """The words of a text, with A to Z lowered. Other letters may be lowered too: none of them becomes an ASCII word."""
    held = F.coalesce(text.cast("string"), F.lit(""))
    # the Kelvin sign would become a k; translate is exact, but slow
    lowered = F.when(F.contains(held, F.lit(KELVIN)), F.translate(held, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                     ).otherwise(F.lower(held))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def texts(items) -> Column:
    return F.array(*[F.lit(x) for x in items])


def distinct_words(templates, phrases) -> list[str]:
    """The licence words: all words of templates and phrases."""
    return sorted({w for _, wording, _ in templates for w in words_of(wording)} | {w for p in phrases for w in words_of(p)})


def document_counts(docs: DataFrame, text: str, licence_words: list[str]) -> dict[str, int]:
    """In how many documents each licence word occurs (over all of them)."""
    found = docs.select(F.explode(F.array_intersect(words(F.col(f"`{text}`")), texts(licence_words))).alias("word"))
    counted = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counted.get(w, 0) for w in licence_words}


def places(w: Column, found: Column, phrase: str) -> Column:
    """Where all words of ``phrase`` stand consecutively in ``w``."""
    first, *rest = words_of(phrase)

    def here(x, i):
        met = x == first
        for k, other in enumerate(rest, 1):
            met = met & F.coalesce(F.get(w, i + k) == other, F.lit(False))
        return F.when(met, i)
    all_there = F.lit(True)
    for other in {first, *rest}:
        all_there = all_there & F.array_contains(found, F.lit(other))
    return F.when(all_there, F.filter(F.transform(w, here), lambda i: i.isNotNull())).otherwise(F.array().cast("array<int>"))


def indexed(label: str, wording: str, phrases: list[str]) -> Column:
    """A template's entry of the index."""
    sequence = words_of(wording)
    at: dict[str, list[int]] = {}
    for p, w in enumerate(sequence):
        at.setdefault(w, []).append(p)
    postings = F.create_map(*[c for w, ps in at.items() for c in (F.lit(w), F.array(*[F.lit(p) for p in ps]))])
    return F.struct(F.lit(label).alias("label"), F.lit(len(sequence)).alias("length"), texts(at).alias("words"),
                    postings.alias("postings"), texts(sorted({w for p in phrases for w in words_of(p)})).alias("needed"),
                    texts([f" {' '.join(words_of(p))} " for p in phrases]).alias("phrases"))


def matches(w: Column, found: Column, t: Column, rank: Column) -> Column:
    """Verified places of a template in a file: array of (label, at, share), ``at`` being where its first word would stand."""
    rarest = F.transform(F.slice(F.sort_array(F.transform(
        F.array_intersect(t["words"], found), lambda x: F.struct(F.element_at(rank, x).alias("rank"), x.alias("word")))), 1, RAREST),
        lambda s: s["word"])

    def vote(rare):
        asked = F.aggregate(rare, F.lit(0), lambda n, x: n + F.size(F.element_at(t["postings"], x)))
        here = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(rare, F.get(w, i)))
        relative = F.sort_array(F.flatten(F.transform(here, lambda i: F.transform(
            F.element_at(t["postings"], F.get(w, i)), lambda p: i - p))))
        return let(relative, lambda r: let(asked, lambda n: agreed(r, n)))

    def agreed(r, n):
        starts = F.filter(F.sequence(F.lit(0), F.size(r) - 1),
                          lambda k: (k == 0) | (F.get(r, k) != F.coalesce(F.get(r, k - 1), F.get(r, k))))
        runs = let(starts, lambda s: F.transform(s, lambda a, k: F.struct(
            F.get(r, a).alias("at"), (F.coalesce(F.get(s, k + 1), F.size(r)) - a).alias("votes"))))
        enough = F.filter(runs, lambda x: x["votes"] * 2 >= n)
        verified = F.filter(enough, lambda x: let(around(x["at"]), lambda text: F.forall(
            t["phrases"], lambda p: F.contains(text, p))))
        return F.transform(verified, lambda x: F.struct(t["label"].alias("label"), x["at"].alias("at"),
                                                        (x["votes"] / n).alias("share")))

    def around(at):
        low, high = F.greatest(at - SLACK, F.lit(0)), at + t["length"] + SLACK
        return F.concat(F.lit(" "), F.array_join(F.slice(w, low + 1, F.greatest(high - low, F.lit(0))), " "), F.lit(" "))

    none = F.array().cast("array<struct<label:string,at:int,share:double>>")
    possible = (F.size(F.array_except(t["needed"], found)) == 0) & (F.size(w) > 0)
    return F.when(possible, let(rarest, vote)).otherwise(none)


def scanned(text: Column, counts: dict[str, int], templates, phrases: dict[str, str]) -> Column:
    """All results of one text as a struct."""
    licence_words = texts(distinct_words(templates, phrases))
    # rank 0 is the rarest: the order of descending inverse document frequency, ties by the word
    order = sorted(counts, key=lambda x: (counts[x], x))
    rank = F.create_map(*[c for k, x in enumerate(order) for c in (F.lit(x), F.lit(k))])
    index = F.array(*[indexed(*t) for t in templates])

    def result(w, found, at, matched):
        base = F.filter(F.array(*[F.when(F.size(at[label]) > 0, F.lit(label)) for label in sorted(set(phrases.values()))]),
                        lambda x: x.isNotNull())
        every = F.flatten(F.array(*[at[label] for label in sorted(set(phrases.values()))]))
        shares = F.transform(matched, lambda m: m["share"])
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
            F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
            F.array_join(base, ",").alias("base_labels"),
            F.array_join(F.sort_array(F.array_distinct(F.concat(base, F.transform(matched, lambda m: m["label"])))), ",").alias("labels"),
            F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(shares), F.lit(0.0))).alias("score"),
            matched.alias("matches"))

    def of_file(w, found):
        by_label: dict[str, list[Column]] = {}
        for phrase, label in phrases.items():
            by_label.setdefault(label, []).append(places(w, found, phrase))
        at = F.struct(*[F.concat(*ps).alias(label) for label, ps in by_label.items()])
        matched = F.flatten(F.transform(index, lambda t: matches(w, found, t, rank)))
        return let(at, lambda a: let(matched, lambda m: result(w, found, a, m)))

    return let(words(text), lambda w: let(F.array_intersect(w, licence_words), lambda found: of_file(w, found)))


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Each row with n_words, n_base, first_word, last_word, base_labels, labels, score and matches (label, at, share).

    Columns of ``docs`` come first, but for those of these names.
    """
    counts = document_counts(docs, text, distinct_words(templates, phrases))
    into = unused(docs.columns, "scan")
    found = docs.withColumn(into, scanned(F.col(f"`{text}`"), counts, templates, phrases))
    own = {f.lower() for f in found.schema[into].dataType.fieldNames()}
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own], f"{into}.*")
