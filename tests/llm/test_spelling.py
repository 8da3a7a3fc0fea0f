"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from urbanflux.llm import ordered, spelling
from urbanflux.llm.common import read
from urbanflux.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_groups(words):
    near = defaultdict(set)
    by_hole, whole = defaultdict(list), set(words)
    for w in words:
        for i in range(len(w)):
            by_hole[w[:i], w[i + 1 :]].append(w)
            if (shorter := w[:i] + w[i + 1 :]) in whole:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in by_hole.values():
        for w in group:
            near[w] |= set(group) - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 40)
    monkeypatch.setattr(ordered, "LEAST_PARTS", 3)


def varied(seed, n=300):
    rnd = random.Random(seed)
    words = {}
    for stem in ["aaaaaa", "banana", "àéîõüÿ", "abcabcabc", "mississippi", "a" * 40]:
        for _ in range(n // 6):
            w = list(stem)
            for _ in range(rnd.randrange(3)):
                i = rnd.randrange(len(w))
                w[i : i + rnd.randrange(2)] = rnd.choice(["", "a", "b", "s", "é"])
            if len(w) >= 6:
                words["".join(w)] = rnd.choice([5, 5, 6, 25, 26, 130, 700])
    return words


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_like_all_pairs(spark, small_parts, seed):
    words = varied(seed)
    df = spark.createDataFrame([(w, n, 1) for w, n in words.items()], "word string, n long, id long").repartition(4)
    assert found(spelling.variant_groups(df)) == plain_groups(words)


def test_chains_of_forms(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "zzzzzz": 5}
    rows = found(spelling.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert rows == plain_groups(words)
    assert {r[2] for r in rows} == {"abjihg", "zzzzzz"}


def test_words_of_texts(spark, documents):
    text = "Straße, straße STRASSE ÀÉÎ× Éclairs éclairs x1y2 abcdefĀghijkl abcdef " * 40
    rows = [(1, text), (2, text + "hello" * 4000), (2, text), (None, text), (3, None), (4, ""), *((i, text) for i in range(10, 60))]
    got = {r["word"]: r["n"] for r in spelling.counted_words(documents(*rows)).collect()}
    assert got == plain_words(rows)


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_spelling"](spark, sf)) == plain_groups(plain_words(rows))


def test_empty_table(spark, documents):
    assert spelling.spelling_variants(documents()).collect() == []


def test_owners_of_shared_nodes():
    ends = [(0, "aa", "abca"), (1, "abcb", "abcd"), (3, "abce", "abx"), (4, "b", "c")]
    owners = spelling.boundary_owners(ends)
    assert owners[1] == ("abc", [0, 0, 0, 0], "abc", [0, 0, 0, 0])
    assert owners[3] == ("abc", [0, 0, 0, 0], "", [0])
    assert owners[4] == ("", [0], "", [0]) or owners[4][:2] == ("", [0])
