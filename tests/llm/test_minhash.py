import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import minhash
from urbanflux.llm.components import connected_components


def words(rnd, n, pool=400):
    return [f"w{rnd.randrange(pool)}" for _ in range(n)]


def bag(text):
    w = text.split()
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def similarity(a, b):
    x, y = bag(a), bag(b)
    common = sum((x & y).values())
    return common / (sum(x.values()) + sum(y.values()) - common) if common else 0.0


def brute_force(rows):
    """Class of each row by comparing everything with everything."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and a.split() and b.split() and (a == b or similarity(a, b) >= 0.8):
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((k for k in m if k is not None), default=None) for r, m in members.items()}
    return [least[root(i)] for i in range(len(rows))]


def corpus():
    rnd = random.Random(5)
    rows = []
    common = words(rnd, 12)
    for base in range(6):
        text = words(rnd, 120)
        for copy in range(7):
            own = list(text)
            for _ in range(copy):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(50)}"
            rows.append(" ".join(common + own + ["again"] * (30 * (base % 2))))
    rows += [" ".join(common + words(rnd, 25)) for _ in range(30)]
    rows += ["one two", "one two", "one  two", "one", "", None, "   ", "a b c d e", "a b c d e f", "y " * 3000, "y " * 2900, "y " * 2000]
    rows += rows[:3] * 2
    rnd.shuffle(rows)
    return [(i * 3 % 101, t) for i, t in enumerate(rows)]


def test_registers_agree_as_often_as_bags_are_similar():
    rnd = random.Random(2)
    for changes in (4, 12, 40):
        a = words(rnd, 400, 60)
        b = list(a)
        for _ in range(changes):
            b[rnd.randrange(len(b))] = f"x{rnd.randrange(6)}"
        x, y = minhash.shingles(" ".join(a), 1), minhash.shingles(" ".join(b), 1)
        s = minhash.signatures([x, y], 8192)
        assert abs((s[0] == s[1]).mean() - minhash.overlap(" ".join(a), " ".join(b), 1)) < 0.02


def test_signatures_do_not_depend_on_the_batch():
    bags = [minhash.shingles(" ".join(words(random.Random(i), 5 + 40 * i))) for i in range(8)]
    together = minhash.signatures(bags, 96)
    alone = np.concatenate([minhash.signatures([b], 96) for b in bags])
    assert (together == alone).all()
    assert np.isinf(minhash.signatures([(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 8)).all()


def test_overlap_is_that_of_multisets():
    rnd = random.Random(9)
    for _ in range(50):
        a = " ".join(words(rnd, rnd.randrange(0, 60), 4))
        b = " ".join(words(rnd, rnd.randrange(0, 60), 4))
        assert minhash.overlap(a, b) == pytest.approx(similarity(a, b))


def test_classes_like_brute_force(spark, documents):
    rows = corpus()
    found = minhash.near_duplicates(documents(*rows).withColumn("class_id", F.lit("clash"))).collect()
    text_of = {}
    assert len(found) == len(rows)
    want = Counter((k, c) for (k, _), c in zip(rows, brute_force(rows), strict=True))
    # a blank text is a class of its own under any key
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == want, text_of


def test_one_of_each_class_stays(spark, documents):
    rows = corpus()
    kept = minhash.keep_one(documents(*rows)).collect()
    blank = sum(not (t or "").split() for _, t in rows)
    classes = {c for (_, t), c in zip(rows, brute_force(rows), strict=True) if (t or "").split()}
    assert len(kept) == len(classes) + blank
    assert {r["doc_id"] for r in kept if (r["text"] or "").split()} == classes
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_null_keys_repeats_and_empty_table(spark, documents):
    rows = [(None, "p q r s t"), (None, "p q r s t"), (4, "u v w x y z"), (4, "u v w x y z"), (2, "u v w x y z")]
    found = minhash.near_duplicates(documents(*rows)).select("doc_id", "class_id", "keeper").collect()
    assert Counter(map(tuple, found)) == Counter({(None, None, True): 2, (4, 2, False): 2, (2, 2, True): 1})
    assert sorted(map(str, (r["doc_id"] for r in minhash.keep_one(documents(*rows)).collect()))) == ["2", "None"]
    assert minhash.near_duplicates(documents(*rows).limit(0)).collect() == []


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3)]
    links += [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["class"] for r in found} == {x: root(x) for x in list(parent)}
    assert len(found) == len(parent)
