"""The trie of conversation prefixes against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from urbanflux.llm import ordered, prefix_trie
from urbanflux.llm.common import read
from urbanflux.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [x for _, x in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in children[p])
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def found(df):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert df.columns == columns
    return sorted(tuple(r) for r in df.collect())


def mixed(seed, convs=90):
    rnd = random.Random(seed)
    rows = [(5, None, None, None), (5, 1, "", "a"), (41, 0, "user", "x y"), (41, 0, "user", "x y"), (41, 0, "bot", ""), (None, 0, "user", "q")]
    for c in range(convs):
        turns = rnd.choice([0, 1, 2, 3, 6]) if c % 20 else rnd.randrange(4)
        rows += [(c, t, "user", rnd.choice(["hi there", "hi\tthere", "", "a b c"])) for t in range(turns)]
    rows += [(1000 + c, t, "user", "same") for c in range(40) for t in range(3)]  # copies
    rows += [(2007, t, "bot", f"long {t % 3}") for t in range(300)]  # deep
    rows += [(9_007_199_254_740_993, 1, "user", "beyond doubles")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 20)
    monkeypatch.setattr(ordered, "LEAST_PARTS", 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_dictionary_of_prefixes(spark, small_parts, seed):
    rows = mixed(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit("clash")).withColumn("pos", F.lit(1)).repartition(5)
    assert found(prefix_trie.prefix_trie(df)) == plain(rows)


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_prefix_trie"](spark, sf)) == plain(rows)


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = found(prefix_trie.prefix_trie(spark.createDataFrame([(c, 0, "user", "gone")], SCHEMA)))
    assert rows == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_running_sums_hand_over_between_parts(spark, small_parts):
    rows = [("a" if i < 150 else "bcd"[i % 3], i) for i in range(200)]
    table = ordered.in_order(spark.createDataFrame(rows, "g string, v long"), ["g", "v"], "t")
    assert table.select("part").distinct().count() > 5
    got = ordered.running(table, "g", {"s": ("sum", F.col("v")), "x": ("bit_xor", F.col("v"))}).collect()
    for r in got:
        before = [v for g, v in rows if g == r["g"] and v <= r["v"]]
        xor = 0
        for v in before:
            xor ^= v
        assert (r["s"], r["x"]) == (sum(before), xor)


def test_following_rows_cross_parts(spark, small_parts):
    table = ordered.in_order(spark.createDataFrame([(i,) for i in range(100)], "v long"), ["v"], "t")
    got = {r["v"]: r["next_v"] for r in ordered.following(table, ["v"]).collect()}
    assert got == {i: i + 1 if i < 99 else None for i in range(100)}
