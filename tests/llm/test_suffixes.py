"""Removal of repeated passages against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from urbanflux.llm import suffixes
from urbanflux.llm.common import read
from urbanflux.llm.queries import QUERIES

N = suffixes.LENGTH


def plain(rows):
    least = {}
    for key, text in rows:
        data = (text or "").encode()
        if key is not None:
            for p in range(len(data) - N + 1):
                w = data[p : p + N]
                least[w] = min(least.get(w, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 2, bool)
        for p in range(len(data) - N + 1):
            if key is not None and least[data[p : p + N]] < key:
                gone[p + 1 : p + N + 1] = True
        inside = gone[1:-1]
        kept = np.frombuffer(data, np.uint8)[~inside].tobytes() if len(data) else b""
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((key, len(data), int(inside.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(rnd, n, vocabulary=400):
    return " ".join(f"{'äéw'[v % 3]}{v * v % 977}" for v in (rnd.randrange(vocabulary) for _ in range(n)))


def mixed(seed):
    rnd = random.Random(seed)
    passages = [words(rnd, n) for n in (8, 12, 15, 30, 200)]
    line = "All rights reserved by the people of this old town, 2026.\n"
    rows = [(i, words(rnd, rnd.randrange(60)) + rnd.choice([*passages, ""]) + words(rnd, rnd.randrange(60)) + line * (i % 3)) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(30)]  # exact copies
    rows += [(300 + i, rows[i][1].replace("7", "8")) for i in range(30)]  # near copies
    rows += [(7, words(rnd, 50) + passages[4]), (7, rows[7][1]), (None, passages[4]), (None, passages[4] * 2), (900, None), (901, ""), (902, "x" * 49)]
    rows += [(-5, passages[3] + "end"), (903, "ab" * 3000), (904, "ab" * 40), (905, words(rnd, 9000) + passages[2] + words(rnd, 9000))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_dictionary_of_windows(spark, documents, seed):
    rows = mixed(seed)
    df = documents(*rows).withColumnRenamed("lang", "text_key").repartition(7)
    assert found(suffixes.digests(df)) == plain(rows)


def test_small_chunks_and_frequent_anchors(spark, documents, monkeypatch):
    rows = mixed(3)
    code = suffixes.frequent_anchors(documents(*((k, t or "") for k, t in rows if k is not None)).repartition(1).select("doc_id", "text"))
    assert not len(code)
    monkeypatch.setattr(suffixes, "FREQUENT", 20)
    every = suffixes.frequent_anchors(documents(*((k, t or "") for k, t in rows if k is not None)).repartition(1).select("doc_id", "text"))
    assert len(every)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    assert found(suffixes.digests(documents(*rows).repartition(3))) == plain(rows)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_suffixes"](spark, sf)) == plain(rows)


def test_kept_bytes_and_spans(spark, documents):
    text = words(random.Random(5), 40)
    rows = suffixes.remove_repeats(documents((1, text), (2, "before " + text + " after"))).orderBy("doc_id").collect()
    assert bytes(rows[1]["kept"]).decode() == "before  after"
    assert [tuple(x) for x in rows[1]["spans"]] == [(7, 7 + len(text.encode()))]
    assert bytes(rows[0]["kept"]).decode() == text


def test_empty_table(spark, documents):
    assert suffixes.remove_repeats(documents()).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_sorting_of_windows(seed):
    rnd = random.Random(seed)
    data = bytes(rnd.choice(b"ab" if rnd.random() < 0.9 else b"abc") for _ in range(300)) * 4
    data += b"a" * 200 + bytes(rnd.randrange(256) for _ in range(200))
    at = np.array([p for p in range(len(data) - N + 1) if rnd.random() < 0.7])
    order, group = suffixes.sort_windows(np.frombuffer(data, np.uint8), at)
    strings = [data[p : p + N] for p in at[order]]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(group, group[1:], strict=False)] == [a == b for a, b in zip(strings, strings[1:], strict=False)]


def test_chunks_hold_every_window_once(monkeypatch):
    rnd = random.Random(9)
    texts = [bytes(rnd.choice(b"abcd") for _ in range(n)) for n in (0, 10, 49, 50, 51, 400, 0, 3000, 70)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    expected = [(i, texts[i][p : p + N]) for i in range(len(texts)) for p in range(len(texts[i]) - N + 1)]
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    got, codes = [], {}
    for _, piece, whole, text in suffixes.chunks(data, starts):
        got += [(t, piece[p : p + N].tobytes()) for p, t in zip(whole.tolist(), text.tolist(), strict=True)]
        for p, code in zip(whole.tolist(), suffixes.anchors(piece, suffixes.GRAM)[whole].tolist(), strict=True):
            assert codes.setdefault(piece[p : p + N].tobytes(), code) == code
    assert got == expected


def test_runs_of_a_batch_are_packed_once_per_bucket(spark):
    rnd, buckets = random.Random(11), 4
    letters = np.frombuffer(b"abcdefgh", np.uint8)
    texts = [letters[[rnd.randrange(8) for _ in range(120_000)]].tobytes() for _ in range(20)]  # over two chunks
    assert sum(map(len, texts)) > 2 * suffixes.CHUNK
    rows = []
    for i, t in enumerate(texts):
        (code, _), = suffixes.text_anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]), np.array([i]))
        rows.append((i, t.decode(), False, i, [bytearray(np.sort(suffixes._short(code, buckets)).tobytes())]))
    known = spark.createDataFrame(rows, "doc_id long, text string, copied boolean, text_key long, codes array<binary>").coalesce(1)
    flow = suffixes.candidate_windows(known.sortWithinPartitions("doc_id"), np.zeros(0, np.uint64), buckets).collect()
    assert sorted(r["bucket"] for r in flow if r["runs"]) == list(range(buckets))
    windows = []
    for r in flow:
        data, (size, doc, key, start) = suffixes.unpack_runs(bytes(r["runs"]), r["size"])
        assert (doc == key).all()
        ends = np.cumsum(size)
        for n, d, a, e in zip(size.tolist(), doc.tolist(), start.tolist(), ends.tolist(), strict=True):
            assert data[e - n : e].tobytes() == texts[d][a : a + n]
            windows += [(d, p) for p in range(a, a + n - N + 1)]
    assert sorted(windows) == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - N + 1)]


@pytest.mark.parametrize("seed", range(3))
def test_anchors_of_chosen_windows(seed):
    rnd = np.random.default_rng(seed)
    data = rnd.integers(97, 101, 3000).astype(np.uint8)
    at = np.flatnonzero(rnd.random(len(data) - N + 1) < [0.005, 0.03, 0.9][seed])
    assert (suffixes.anchors_at(data, at, suffixes.LONG_GRAM) == suffixes.anchors(data, suffixes.LONG_GRAM)[at]).all()


def test_strings_gathered_in_blocks(monkeypatch):
    rnd = np.random.default_rng(4)
    data = rnd.integers(0, 256, 5000).astype(np.uint8)
    at, size = rnd.integers(0, 4000, 60), rnd.integers(N, 900, 60)
    doc, key, start = (rnd.integers(-(2**62), 2**62, 60) for _ in range(3))
    edges = np.array([0, 1, 2, 30, 31, 60])
    monkeypatch.setattr(suffixes, "CHUNK", 2000)
    packs = list(suffixes.pack_runs(data, at, size, start, doc, key, edges))
    for (a, b), pack in zip(zip(edges, edges[1:], strict=False), packs, strict=True):
        held, columns = suffixes.unpack_runs(*pack)
        assert held.tobytes() == b"".join(data[x : x + n].tobytes() for x, n in zip(at[a:b], size[a:b], strict=True))
        assert all((x == y[a:b]).all() for x, y in zip(columns, (size, doc, key, start), strict=True))


@pytest.mark.parametrize("low", [[3, -5, 2, 9, -5, 0], [-(2**63), 2**63 - 1, 0, 5, -1, 7], [4] * 6, []])
def test_order_by_two_columns(low):
    high, low = np.array([2, 0, 2, 1, 0, 2][: len(low)], np.int64), np.array(low, np.int64)
    order = suffixes.order_of(high, low)
    assert list(zip(high[order].tolist(), low[order].tolist(), strict=True)) == sorted(zip(high.tolist(), low.tolist(), strict=True))
