"""License scans by an index of rare words and their places in license templates.

Of every template the words that fewest documents hold are indexed with their places. A file's
occurrences of indexed words meet those postings; words that agree on the place at which the
template would begin vote for it. A begin with enough votes is a hit if the template's key phrase
stands where it then must. Base phrases are found on their own and always count.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.url_rules import ascii_lower

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: All that stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Indexed words of a template, and how many must agree (all, where it has fewer).
RARE_WORDS, VOTES = 8, 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrase: str = ""  # by default the whole text

    @property
    def words(self) -> list[str]:
        return words_of(self.text)

    @property
    def key_words(self) -> list[str]:
        return words_of(self.key_phrase or self.text)

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def words_of(text: str) -> list[str]:
    return re.findall(WORDS, text.lower())


# The wording of public license notices, paragraph by paragraph, so that a notice is known by any of
# its parts. Each has the phrase that it cannot be without.
NOTICES = [
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions",
        "permission is hereby granted, free of charge",
    ),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted, free of charge",
    ),
    Template(
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "shall be included in all copies or substantial portions",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
        "apache license",
    ),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "warranties or conditions of any kind",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "GNU General Public License",
    ),
    Template(
        "gpl",
        "You should have received a copy of the GNU General Public License along with this program",
        "GNU General Public License",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "GNU Lesser General Public License",
    ),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "GNU Affero General Public License"),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "bsd",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
        " in the documentation and/or other materials provided with the distribution",
        "redistributions in binary form must reproduce the above copyright notice",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies",
        "for any purpose with or without fee is hereby granted",
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for"
        " any damages arising from the use of this software",
        "in no event will the authors be held liable",
    ),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain", "released into the public domain"),
    Template("cc", "Licensed under CC BY", "CC BY"),
    Template("cc", "This work is licensed under a Creative Commons Attribution", "Creative Commons Attribution"),
    *(Template("cc", x) for x in ("License: CC BY", "Licence: CC BY", "CC BY-SA", "CC BY-NC", "CC BY-ND", "CC BY 4.0", "CC BY 3.0", "CC0 1.0 Universal")),
]
#: Identifiers of the license list that files name in one line of their head.
IDENTIFIERS = {
    "mit": ["MIT"], "apache": ["Apache-2.0"], "gpl": ["GPL-2.0", "GPL-3.0"], "lgpl": ["LGPL-2.1", "LGPL-3.0"], "agpl": ["AGPL-3.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "isc": ["ISC"], "zlib": ["Zlib"], "mpl": ["MPL-2.0"], "unlicense": ["Unlicense"],
    "cc": ["CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0"],
}
TEMPLATES = [*NOTICES, *(Template(label, f"SPDX-License-Identifier: {x}") for label, names in IDENTIFIERS.items() for x in names)]


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def license_words(text: Column) -> Column:
    """Lower-cased words (A-Z only); null has none. Splitting between words takes half the time of matching them."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def word_weights(df: DataFrame, text: str = "text", templates: list[Template] | None = None) -> dict[str, float]:
    """Inverse document frequency of the words of the templates over all rows; a row per word is collected."""
    vocabulary = sorted({w for t in templates or TEMPLATES for w in t.words})
    wanted = _literal(vocabulary, "array<string>")
    held = df.select(F.explode(F.concat(F.array_intersect(license_words(F.col(text)), wanted), F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    rows = counts.get("", 0)
    return {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def rare_words(templates: list[Template], weights: dict[str, float]) -> list[list[str]]:
    """The rarest words of each template (ties: by name)."""
    return [sorted(set(t.words), key=lambda w: (-weights.get(w, 0.0), w))[:RARE_WORDS] for t in templates]


def _phrase_places(words: Column, phrase: str) -> Column:
    """Places at which the words of ``phrase`` stand one after the other."""
    parts = phrase.split()
    places = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    return F.filter(places, lambda i: F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts)))


def _aligned(words: Column, hits: Column, needed: list[int]) -> Column:
    """``(template, begin)`` pairs for which enough different words vote; ``hits`` are sorted and may repeat."""
    pair = "struct<t:int,b:int>"
    zero = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("b"), F.lit("").alias("w"), F.lit(0).alias("n"), F.array().cast(f"array<{pair}>").alias("out"))
    enough = _literal(needed, "array<int>")

    def step(state: Column, hit: Column) -> Column:
        same = (state["t"] == hit["t"]) & (state["b"] == hit["b"])
        fresh = ~same | (state["w"] != hit["w"])
        n = F.when(same, state["n"] + fresh.cast("int")).otherwise(1)
        reached = fresh & (n == F.element_at(enough, hit["t"] + 1))
        found = F.array(F.struct(hit["t"].alias("t"), hit["b"].alias("b")))
        return F.struct(hit["t"].alias("t"), hit["b"].alias("b"), hit["w"].alias("w"), n.alias("n"), F.when(reached, F.concat(state["out"], found)).otherwise(state["out"]).alias("out"))

    return F.aggregate(hits, zero, step, lambda s: s["out"])


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    templates: list[Template] | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Adds ``n_words, n_base, first_word, last_word, base_labels, labels, score, hits``.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest and
    largest of them (null without any). ``hits`` are the verified templates ``(label, begin, share)``
    with the share of template words in place (of a notice whose front is cut off, it begins at 0); ``score`` is 1
    with a base phrase, else the largest share, else 0. Null and empty texts have no words, labels or hits. Repeated rows
    get equal results, an empty table stays empty. Columns of these names are replaced; names that start with
    ``lic_`` are reserved.
    """
    templates = TEMPLATES if templates is None else templates
    weights = word_weights(df, text, templates) if weights is None else weights
    rare = rare_words(templates, weights)
    index: dict[str, list[dict]] = {}
    for number, (template, chosen) in enumerate(zip(templates, rare, strict=True)):
        for place, word in enumerate(template.words):
            if word in chosen:
                index.setdefault(word, []).append({"t": number, "q": place})
    known = _literal(sorted(index), "array<string>")
    postings = _literal(index, "map<string,array<struct<t:int,q:int>>>")
    texts = _literal([t.words for t in templates], "array<array<string>>")
    keys = _literal([t.key_words for t in templates], "array<array<string>>")
    key_at = _literal([t.key_at for t in templates], "array<int>")
    labels = _literal([t.label for t in templates], "array<string>")
    # A label needs a base or key phrase: most texts lack the longest word of every one.
    anchors = sorted({max(p, key=len) for p in [*map(words_of, BASE_PHRASES), *(t.key_words for t in templates)]})
    out = df.withColumn("lic_words", license_words(F.col(text)))
    words = F.col("lic_words")
    out = out.withColumn("lic_open", F.arrays_overlap(words, _literal(anchors, "array<string>")))
    none = F.array().cast("array<int>")
    for n, phrase in enumerate(BASE_PHRASES):
        out = out.withColumn(f"lic_base{n}", F.when(F.col("lic_open"), _phrase_places(words, phrase)).otherwise(none))
    base = F.concat(*(F.col(f"lic_base{n}") for n in range(len(BASE_PHRASES))))
    base_labels = F.array_sort(F.array_compact(F.array(*(
        F.when(F.size(f"lic_base{n}") > 0, F.lit(label)) for n, label in enumerate(BASE_PHRASES.values())))))
    met = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(known, x["w"]))
    votes = F.flatten(
        F.transform(
            met,
            lambda x: F.transform(
                F.element_at(postings, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["q"]).alias("b"), x["w"].alias("w"))
            ),
        )
    )
    # a template may begin before the first word, where the front of a notice is cut off
    votes = F.array_sort(votes)
    needed = [min(VOTES, len(chosen)) for chosen in rare]
    out = out.withColumn("lic_votes", F.when(F.col("lic_open"), votes))
    begins = _aligned(words, F.col("lic_votes"), needed)

    def shown(x: Column) -> Column:
        own, cut = F.element_at(texts, x["t"] + 1), F.greatest(-x["b"], F.lit(0))
        there = F.slice(words, F.greatest(x["b"], F.lit(0)) + 1, F.size(own) - cut)
        left = F.slice(own, cut + 1, F.size(own))
        right = F.size(F.filter(F.zip_with(left, there, lambda a, b: a.eqNullSafe(b)), lambda same: same))
        begin = F.greatest(x["b"], F.lit(0)).cast("long")
        return F.struct(F.element_at(labels, x["t"] + 1).alias("label"), begin.alias("begin"), (right / F.size(own)).alias("share"))

    def verified(x: Column) -> Column:
        key, at = F.element_at(keys, x["t"] + 1), x["b"] + F.element_at(key_at, x["t"] + 1)
        return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(key)) == key)

    empty = F.array().cast("array<struct<label:string,begin:bigint,share:double>>")
    out = out.withColumn("lic_hits", F.coalesce(F.transform(F.filter(begins, verified), shown), empty))
    hits = F.col("lic_hits")
    both = F.array_sort(F.array_distinct(F.concat(base_labels, F.transform(hits, lambda h: h["label"]))))
    added = {
        "n_words": F.size(words).cast("long"),
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(base).cast("long"),
        "last_word": F.array_max(base).cast("long"),
        "base_labels": F.array_join(base_labels, ","),
        "labels": F.array_join(both, ","),
        "score": F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform(hits, lambda h: h["share"])), F.lit(0.0))),
        "hits": hits,
    }
    kept = [F.col(c) for c in df.columns if c not in added]
    return out.select(*kept, *(v.alias(k) for k, v in added.items()))
