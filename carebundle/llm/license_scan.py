"""Licence scan by a positional index of rare licence words; built-in functions only.

The words of licence templates are counted in all documents.  A text that has a share of a template's words has some of
any choice of the others and one more, so the index holds just so many of each template's rarest words, with their
places: a few postings for a template, whatever the corpus.  In a document the index words are looked up, each with its own positions; a word at position i that stands at position p of a template votes for the template
beginning at i - p.  Where several different words of a template vote for the same beginning, they stand in the document
as they stand in the template.  Such a place is verified on the words around it: every key phrase of the template has to
be there, and the share of its words.

Everything happens within a row, in array functions: nothing is shuffled but the counts of template words, so a common
licence line costs no more than any other.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import quoted

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The two characters outside ASCII whose lower case is not.
_KELVIN, _DOTTED_I, _OTHER = "\u212a", "\u0130", "\u0101"


@dataclass(frozen=True)
class Template:
    """A text by which a licence is known, and the phrases that must not be missing from it."""

    label: str
    text: str
    phrases: tuple[str, ...]


# Words by which licences are named or granted.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Licensed under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "sublicense and or sell copies"),
    ),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        ("in compliance with the license", "apache org licenses license 2 0"),
    ),
    Template(
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation",
        ("redistribute it and or modify it", "gnu general public license"),
    ),
    Template(
        "lgpl",
        "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free"
        " Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-3.0",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        ("gnu affero general public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee", "hereby granted"),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc0-1.0", "released under CC0 1.0 Universal public domain dedication", ("cc0 1 0",)),
)
# Phrases that name a licence by themselves.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Settings:
    """``votes`` different rare words of a template have to agree on where it begins.  Around that place, up to ``slack`` words
    further on either side, its phrases and ``coverage`` of its words have to be.  A base phrase without a verified
    template scores ``base_score``."""

    votes: int = 2
    slack: int = 8
    coverage: float = 0.7
    base_score: float = 0.5


def template_words(text: str) -> list[str]:
    """The words of a template, as :func:`words` takes them from a document."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() or "a" <= c <= "z" else " " for c in text)
    return lowered.split()


def words(text: Column) -> Column:
    """The words of a text, with A-Z in lower case; null has none."""
    plain = F.replace(F.replace(text.cast("string"), F.lit(_KELVIN), F.lit(_OTHER)), F.lit(_DOTTED_I), F.lit(_OTHER))
    line = F.trim(F.regexp_replace(F.lower(plain), NO_WORD, " "))
    return F.filter(F.split(F.coalesce(line, F.lit("")), " "), lambda word: word != "")


def document_frequencies(documents: DataFrame, templates: tuple[Template, ...], text_column: str = "text") -> dict[str, int]:
    """In how many documents each template word occurs: one number for each word of the templates."""
    vocabulary = sorted({word for template in templates for word in template_words(template.text)})
    if not vocabulary:
        return {}
    found = F.array_distinct(F.filter(words(quoted(text_column)), lambda word: word.isin(vocabulary)))
    counted = documents.select(F.explode(found).alias("word")).groupBy("word").count()
    return {row["word"]: row["count"] for row in counted.collect()}


def rare_word_index(
    templates: tuple[Template, ...], frequencies: dict[str, int], settings: Settings
) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, position) by word: for each template the words of highest inverse document frequency, of equal
    ones those that come first, as many as a text with the asked share of the words cannot avoid but for one vote less."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        own = template_words(template.text)
        rare = set(sorted(dict.fromkeys(own), key=lambda word: frequencies.get(word, 0))[: index_size(own, settings)])
        for position, word in enumerate(own):
            if word in rare and frequencies.get(word):
                postings.setdefault(word, []).append((number, position))
    return postings


def index_size(own: list[str], settings: Settings) -> int:
    """How many of a template's words are looked up."""
    different = len(set(own))
    return different - math.ceil(settings.coverage * different) + settings.votes


def _constant(value: object, kind: str) -> Column:
    """A small constant of any type; the optimizer reads it once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _phrase_starts(hits: Column, own: Column, phrase: list[str]) -> Column:
    """The positions of a phrase among the looked-up words of a text."""

    def stands(hit: Column) -> Column:
        match = hit["word"] == phrase[0]
        for step, word in enumerate(phrase[1:], 1):
            match = match & F.coalesce(F.get(own, hit["at"] + step) == word, F.lit(False))
        return match

    return F.transform(F.filter(hits, stands), lambda hit: hit["at"])


def _agreed(votes: Column, least: int) -> Column:
    """What at least so many of some sorted votes name: equal ones stand together."""
    picked = F.filter(votes, lambda vote, k: vote == F.get(votes, k + least - 1))
    return F.array_distinct(picked)


def scan(
    documents: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    base_phrases: tuple[tuple[str, str], ...] = BASE_PHRASES,
    settings: Settings = Settings(),  # noqa: B008
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_words, n_base (places of base phrases), first_word and last_word (the smallest and the largest word
    number at which one begins; null if none does), base_labels, labels (those of verified templates too; both distinct,
    sorted, joined by commas), score (the highest share of a verified template's words; of base phrases alone the base
    score; else 0), places (array of label, at: where verified templates begin; before the text if their first words are
    missing) by label and place.

    Null, empty and blank texts have no words and no labels; texts of any length are looked at as a whole.  Repeated rows
    give repeated rows, an empty table an empty one; null ids stay null; other columns are not looked at.
    """
    postings = rare_word_index(templates, document_frequencies(documents, templates, text_column), settings)
    index_words = list(postings)
    base = [(template_words(phrase), label) for phrase, label in base_phrases]
    wanted = sorted({*index_words, *(phrase[0] for phrase, _ in base)})

    rows = documents.select(quoted(id_column).alias("doc_id"), words(quoted(text_column)).alias("words"))
    # Most texts have none of the words; theirs go no further.
    some = F.exists("words", lambda word: word.isin(wanted))
    nothing = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.when(some, F.col("words")).otherwise(nothing).alias("words"))
    numbered = F.transform("words", lambda word, at: F.struct(word.alias("word"), at.alias("at")))
    rows = rows.withColumn("hits", F.filter(numbered, lambda hit: hit["word"].isin(wanted)))

    starts = [_phrase_starts(F.col("hits"), F.col("words"), phrase) for phrase, _ in base]
    rows = rows.withColumns({f"base{k}": found for k, found in enumerate(starts)})
    base_at = F.flatten(F.array(*(F.col(f"base{k}") for k in range(len(base)))))
    base_labels = [F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(base)]
    rows = rows.withColumn("base_at", base_at).withColumn("base_labels", F.array_compact(F.array(*base_labels)))

    # One vote of a word for a beginning, however often the word stands in the template or the text.
    places = _constant([postings[word] for word in index_words], "array<array<array<int>>>")
    numbers = F.array(*map(F.lit, index_words)) if index_words else F.array().cast("array<string>")
    indexed = F.filter("hits", lambda hit: hit["word"].isin(index_words)) if index_words else F.array()

    def votes_of(hit: Column) -> Column:
        number = F.array_position(numbers, hit["word"]).cast("int")
        return F.transform(
            F.get(places, number - 1),
            lambda place: F.struct(place[0].alias("template"), (hit["at"] - place[1]).alias("at"), number.alias("word")),
        )

    if index_words:
        votes = F.array_distinct(F.flatten(F.transform(indexed, votes_of)))
        named = F.array_sort(F.transform(votes, lambda vote: F.struct(vote["template"].alias("template"), vote["at"].alias("at"))))
        rows = rows.withColumn("votes", F.when(F.size("hits") >= settings.votes, named))
        rows = rows.withColumn("candidates", F.coalesce(_agreed(F.col("votes"), settings.votes), F.array().cast(_CANDIDATES)))
    else:
        rows = rows.withColumn("candidates", F.array().cast(_CANDIDATES))

    own = [template_words(template.text) for template in templates]
    known = _constant(
        [
            {"label": t.label, "n": len(w), "words": list(dict.fromkeys(w)), "phrases": [" ".join(template_words(p)) for p in t.phrases]}
            for t, w in zip(templates, own, strict=True)
        ],
        "array<struct<label:string,n:int,words:array<string>,phrases:array<string>>>",
    )

    def judged(candidate: Column) -> Column:
        template = F.get(known, candidate["template"])
        first = F.greatest(candidate["at"] - settings.slack, F.lit(0))
        last = candidate["at"] + template["n"] + settings.slack
        around = F.slice("words", first + 1, F.greatest(last - first, F.lit(0)))
        line = F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" "))
        whole = F.forall(template["phrases"], lambda phrase: F.contains(line, F.concat(F.lit(" "), phrase, F.lit(" "))))
        share = F.size(F.array_intersect(template["words"], around)) / F.size(template["words"])
        return F.struct(
            template["label"].alias("label"), candidate["at"].alias("at"), F.when(whole, share).otherwise(F.lit(0.0)).alias("share")
        )

    found = F.filter(F.transform("candidates", judged), lambda place: place["share"] >= settings.coverage)
    rows = rows.withColumn("found", F.array_sort(found))
    labels = F.array_sort(F.array_union("base_labels", F.transform("found", lambda place: place["label"])))
    base_score = F.when(F.size("base_at") > 0, F.lit(settings.base_score)).otherwise(F.lit(0.0))
    best = F.coalesce(F.array_max(F.transform("found", lambda place: place["share"])), base_score)
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base_at").cast("bigint").alias("n_base"),
        F.array_min("base_at").cast("bigint").alias("first_word"),
        F.array_max("base_at").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        best.alias("score"),
        F.transform("found", lambda place: F.struct(place["label"].alias("label"), place["at"].cast("bigint").alias("at"))).alias("places"),
    )


_CANDIDATES = "array<struct<template:int,at:int>>"
