import re

from pyspark.sql import functions as F

from urbanflux.llm import licenses

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."
TEXTS = [
    "Released under the MIT License.",
    "MIT licence; the Apache-License, version 2.0; apache license APACHE LICENSE",
    "GNU General Public License and general public general public license",
    MIT,
    MIT.replace("granted", "given"),
    MIT.replace("hereby", "herewith").replace("free", "Free"),
    "words before. " + MIT + " " + MIT,
    "Licensed under CC BY-NC 4.0.",
    "permission is granted, hereby, of charge free " * 30,
    "ÀMIT License mit license mit license",
    "",
    None,
    "license " * 20_000,
    "permission hereby charge person obtaining " * 3_000,
    MIT.split("hereby ")[0] + "hereby granted, free of charge, to any person",
    "use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "License: CC BY-SA 4.0",
    "// SPDX-License-Identifier: Apache-2.0\n// SPDX-License-Identifier: BSD-3-Clause",
    "cc by request",
    " ".join(t.text for t in licenses.NOTICES),
]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_force(text, rare):
    """Every template at every place, without an index."""
    words, hits = words_of(text), set()
    for template, chosen in zip(licenses.TEMPLATES, rare, strict=True):
        own, key = template.words, template.key_words
        for begin in range(-len(own), len(words)):
            pairs = [(w, words[begin + i]) for i, w in enumerate(own) if 0 <= begin + i < len(words)]
            votes = {w for w, x in pairs if w == x and w in chosen}
            at = begin + template.key_at
            if len(votes) >= min(licenses.VOTES, len(chosen)) and at >= 0 and words[at : at + len(key)] == key:
                hits.add((template.label, max(begin, 0), round(sum(a == b for a, b in pairs) / len(own), 9)))
    return hits


def test_base_phrases_and_hits_like_brute_force(documents):
    df = documents(*enumerate(TEXTS))
    rare = licenses.rare_words(licenses.TEMPLATES, licenses.word_weights(df))
    for r in licenses.scan_licenses(df).collect():
        words = words_of(TEXTS[r["doc_id"]])
        places, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert r["first_word"] == min(places, default=None) and r["last_word"] == max(places, default=None)
        assert r["base_labels"] == ",".join(sorted(labels))
        hits = {(h["label"], h["begin"], round(h["share"], 9)) for h in r["hits"]}
        assert hits == brute_force(TEXTS[r["doc_id"]], rare), TEXTS[r["doc_id"]]
        assert r["labels"] == ",".join(sorted(labels | {h[0] for h in hits}))
        assert r["score"] == (1.0 if places else max((h[2] for h in hits), default=0.0)) or abs(r["score"] - max(h[2] for h in hits)) < 1e-8


def test_key_phrase_is_mandatory(documents):
    found = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(documents(*enumerate(TEXTS))).collect()}
    assert found[3] == "mit" and found[6] == "mit" and found[7] == "cc"
    assert found[4] == found[5] == ""
    assert found[15] == "" and found[16] == "gpl"  # the front of a key phrase is cut off, or that of the notice alone
    assert found[17] == "cc" and found[18] == "apache,bsd" and found[19] == ""
    assert set(found[20].split(",")) == {t.label for t in licenses.NOTICES}


def test_repeats_null_ids_clashing_columns_and_empty_table(documents):
    df = documents((None, TEXTS[0]), (1, TEXTS[0]), (1, TEXTS[0])).withColumn("labels", F.lit(3)).withColumn("score", F.lit("x"))
    assert [r["labels"] for r in licenses.scan_licenses(df).collect()] == ["mit"] * 3
    assert licenses.scan_licenses(df.limit(0)).collect() == []
