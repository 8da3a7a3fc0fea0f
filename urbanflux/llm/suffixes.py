"""Removal of passages that documents with smaller ids hold too, by sorting suffixes deep and shallow.

Only the first ``LENGTH`` bytes of a suffix matter, so a suffix here is a window of that size. Windows are sorted
by their first bytes, word by word and only where they tie (the shallow part); groups that still tie go into blind
tries, all groups level by level: every member is compared with its group's first one and follows the branch
where it leaves that (the deep part). Equal windows end up side by side, and all but those of the smallest id fall.

Few of all windows are sorted. The smallest code of the grams inside a window is its anchor: equal windows have
equal anchors, so a window whose anchor occurs in one document only has no copy. Windows with other anchors are
sorted within the batch that holds them, and those left over meet their like by a shuffle on the anchor. Runs of windows
with one anchor travel as one string. Anchors of very many documents are known beforehand; their windows meet by
an anchor of almost the window's length instead, in two rounds, so that no frequent line gathers its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import ship_package
from urbanflux.llm.ordered import in_few_files, join_counted
from urbanflux.session import materialize

LENGTH = 50
GRAM = 24
#: Grams by which the windows of frequent anchors are told apart.
LONG_GRAM = 46
SHALLOW = 18
#: Windows handled together, and places whose codes are computed together.
CHUNK = 1 << 20
BLOCK = 1 << 15
#: An anchor is frequent in at least so many documents, and one in so many of all anchors: there are at most so many.
FREQUENT = 256
FREQUENT_SHARE = 1 << 17
#: Text bytes whose anchors or windows meet in one bucket, about, and the fewest buckets.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 256
#: Buckets of anchors that a task answers, about: a document gets a row from each task that knows something of it.
BUCKETS_A_TASK = 16
#: Anchors or replies that are packed together.
PACKED = 1 << 22
#: Bytes of runs, heads included, that are packed together.
PACKED_BYTES = 1 << 24
SALTS = 64
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column one after the other, and where each text starts (one more at the end)."""
    column = column.fill_null("" if pa.types.is_string(column.type) else b"").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data else np.zeros(0, np.uint8)
    return held, starts - starts[0]


def words_at(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight (or fewer) bytes from every place on, as one number."""
    size = np.dtype(kind).itemsize
    return np.ndarray((max(len(data) - size + 1, 0),), kind, data.data, strides=(1,)) if len(data) >= size else np.zeros(0, kind)


def gram_codes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code per gram of so many bytes, 8 at least."""
    n = max(len(data) - size + 1, 0)
    words = words_at(data).astype(np.uint64)
    code = np.zeros(n, np.uint64)
    for k, at in enumerate([*range(0, size - 8, 8), size - 8]):
        code += words[at : at + n]
        code *= np.uint64(MIX[k])
        code ^= code >> np.uint64(29 + k)
    return code


def anchors(data: np.ndarray, gram: int, length: int = LENGTH) -> np.ndarray:
    """The smallest code of the grams inside the window at every place; computed in blocks that stay in the cache."""
    n = max(len(data) - length + 1, 0)
    out = np.empty(n, np.uint64)
    for begin in range(0, n, BLOCK):
        low, width, span = gram_codes(data[begin : begin + BLOCK + length - 1], gram), 1, length - gram + 1
        while 2 * width <= span:
            low, width = np.minimum(low[: len(low) - width], low[width:]), 2 * width
        rest = span - width
        out[begin : begin + BLOCK] = np.minimum(low[: len(low) - rest], low[rest:])
    return out


def anchors_at(data: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """``anchors`` of the windows that begin at ``at``, in ascending order; bytes in none of them are passed over."""
    begin = np.flatnonzero(np.diff(at, prepend=-LENGTH) >= LENGTH)  # windows that overlap stay together
    end = np.append(begin[1:], len(at))
    size = at[end - 1] + LENGTH - at[begin]
    skipped = at[begin] - (np.cumsum(size) - size)
    held = data[np.repeat(skipped, size) + np.arange(size.sum())]
    return anchors(held, gram)[at - np.repeat(skipped, end - begin)]


def chunks(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of ``CHUNK`` places: first place, bytes, places (from the first) whose window lies in one text, its text."""
    for first in range(0, len(data), CHUNK):
        low, high = (int(np.searchsorted(starts, x, "right")) - 1 for x in (first, min(first + CHUNK, len(data)) - 1))
        texts = np.arange(low, high + 1)
        begin = np.maximum(starts[texts], first)
        n = np.maximum(np.minimum(starts[texts + 1] - length + 1, first + CHUNK) - begin, 0)
        whole = np.arange(n.sum()) + np.repeat(begin - first - (np.cumsum(n) - n), n)
        if len(whole):
            yield first, data[first : first + CHUNK + length - 1], whole, np.repeat(texts, n)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before; the first one always does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def text_anchors(data: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk, codes of anchors in the order of the texts, and the documents that hold them."""
    for _, piece, whole, text in chunks(data, starts):
        code = anchors(piece, GRAM)[whole]
        new = changes(code, text)
        yield code[new], ids[text[new]]


def order_of(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Order by two columns, of which ``high`` is never negative; equal rows in any order."""
    if not len(low):
        return np.zeros(0, np.int64)
    least = low.min()
    bits = (int(low.max()) - int(least)).bit_length()
    if bits < 63 and int(high.max()) >> (64 - bits) == 0:  # one word of both sorts faster than two
        return np.argsort(high.astype(np.uint64) << np.uint64(bits) | (low - least).astype(np.uint64))
    return np.lexsort((low, high))


def sorted_pairs(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order."""
    order = np.argsort(code)
    code, doc = code[order], doc[order]
    first = np.flatnonzero(changes(code)) if len(code) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(code)))
    ties = np.flatnonzero(np.repeat(size > 1, size))
    doc[ties] = doc[ties[np.lexsort((doc[ties], code[ties]))]]
    new = changes(code, doc) if len(code) else np.zeros(0, bool)
    return code[new], doc[new]


def sort_windows(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows that begin at ``at``, and a number per place of that order, equal for equal windows."""
    n = len(at)
    order, group = np.arange(n), np.zeros(n, np.int64)
    todo = np.arange(n)  # places whose group holds several windows
    eights = words_at(data, ">u8")
    todo = _regroup(order, group, todo, eights[at].astype(np.uint64), None)
    for depth in range(8, SHALLOW, 5):
        todo = _regroup(order, group, todo, eights[at[order[todo]] + depth].astype(np.uint64) >> np.uint64(24), 40)
    rest = np.arange(SHALLOW, length)
    while len(todo):
        lead = todo[np.maximum.accumulate(np.where(changes(group[todo]), np.arange(len(todo)), 0))]
        mine, other = at[order[todo]], at[order[lead]]
        same = np.ones(len(todo), bool)
        for depth in range(SHALLOW, length - 7, 8):
            same &= eights[mine + depth] == eights[other + depth]
        same &= eights[mine + length - 8] == eights[other + length - 8]
        branch = np.full(len(todo), MIDDLE, np.int64)  # of the trie that the group's first window begins
        off = np.flatnonzero(~same)
        for part in np.array_split(off, max(1, -(-len(off) // CHUNK))):
            left, right = data[mine[part, None] + rest], data[other[part, None] + rest]
            depth = np.argmax(left != right, axis=1)
            here, there = left[np.arange(len(part)), depth].astype(np.int64), right[np.arange(len(part)), depth]
            branch[part] += np.where(here < there, (depth - length) * 256 + here, (length - depth) * 256 + here)
        todo = _regroup(order, group, todo, branch.astype(np.uint64), 16, done=MIDDLE)
    return order, group


MIDDLE = 1 << 15


def _regroup(order: np.ndarray, group: np.ndarray, todo: np.ndarray, key: np.ndarray, bits: int | None, done: int | None = None) -> np.ndarray:
    """Sorts rows of ``todo`` by group and ``key`` (of so many bits), splits their groups by it, and returns what
    still ties but for those with the key ``done``. A group is named by the place at which it starts.
    """
    rank = np.cumsum(changes(group[todo])) - 1 if bits is not None else np.zeros(len(todo), np.int64)
    if bits is None or not len(rank) or int(rank[-1]) >> (64 - bits) == 0:
        # one word of both sorts faster than two
        moved = np.argsort(key if bits is None else rank.astype(np.uint64) << np.uint64(bits) | key)
    else:
        moved = np.lexsort((key, rank))
    order[todo] = order[todo[moved]]
    key = key[moved]
    first = np.flatnonzero(changes(rank, key))  # ranks were in order and still are
    size = np.diff(np.append(first, len(todo)))
    group[todo] = np.repeat(todo[first], size)
    open_ = size > 1
    if done is not None:
        open_ &= key[first] != done
    return todo[np.repeat(open_, size)]


def beaten(data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows also begin in a document with a smaller id."""
    order, group = sort_windows(data, at)
    first = np.flatnonzero(changes(group))
    if not len(first):
        return np.zeros(0, bool)
    least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(at))))
    out = np.zeros(len(at), bool)
    out[order] = doc[order] > least
    return out


def runs_of(place: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of places one after the other with equal columns."""
    first = np.flatnonzero(changes(place - np.arange(len(place)), *columns))
    return first, np.append(first[1:], len(place)) - 1


def is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


# Rows of one stage to the next: packed runs of windows for a bucket, or a removed range.
FLOW = "bucket long, hot boolean, runs binary, size long, doc_id long, text_key long, start long, stop long"
FLOW_ARROW = pa.schema(
    [("bucket", pa.int64()), ("hot", pa.bool_()), ("runs", pa.binary()), *((c, pa.int64()) for c in ("size", "doc_id", "text_key", "start", "stop"))]
)


def _pack(*arrays: np.ndarray) -> tuple[bytes, int]:
    raw = b"".join(x.tobytes() for x in arrays)
    return pa.Codec("zstd", 1).compress(raw, asbytes=True), len(raw)


def steps_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences from one value to the next; those at ``first`` count from 0."""
    steps = values.copy()
    steps[1:] -= values[:-1]
    steps[first] = values[first]
    return steps


def pack_runs(data: np.ndarray, at: np.ndarray, size: np.ndarray, start: np.ndarray, doc: np.ndarray, key: np.ndarray, edges: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """Strings of ``size`` bytes from ``at`` on with their place in their text and its document, packed from edge to edge."""
    steps = [size, *(steps_of(x, edges[:-1]) for x in (doc, key, start))]
    ends = np.append(0, np.cumsum(size))
    reach = ends[edges]
    low, high, held = 0, 0, data[:0]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b > high:  # strings of the next packs, gathered together
            low, high = a, max(b, int(edges[np.searchsorted(reach, ends[a] + CHUNK, "right") - 1]))
            held = data[np.repeat(at[low:high] - (ends[low:high] - ends[low]), size[low:high]) + np.arange(ends[high] - ends[low])]
        yield _pack(np.array([b - a], np.int64), *(x[a:b] for x in steps), held[ends[a] - ends[low] : ends[b] - ends[low]])


def unpack_runs(packed: bytes, raw_size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bytes of all strings one after the other, and their sizes, documents, text keys and places."""
    raw = pa.Codec("zstd").decompress(packed, raw_size, asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    size, *steps = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
    return np.frombuffer(raw, np.uint8, offset=8 + 32 * n), [size, *(np.cumsum(x) for x in steps)]


def _ranges(doc: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    n = len(doc)
    longs = [pa.array(x.astype(np.int64, copy=False)) for x in (doc, key, start, stop)]
    # spread by document
    return pa.RecordBatch.from_arrays([longs[0], pa.array(np.zeros(n, bool)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), *longs], schema=FLOW_ARROW)


def _settled(data: np.ndarray, at: np.ndarray, place: np.ndarray, text: np.ndarray, doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, list[pa.RecordBatch]]:
    """Which of the windows at ``at`` in ``data`` are left, and the ranges of those that fall.

    ``place`` is where a window begins in its text; ``doc`` and ``key`` belong to texts.
    """
    gone = beaten(data, at, doc[text])
    index, ranges = np.flatnonzero(gone), []
    if len(index):
        first, last = (index[x] for x in runs_of(place[index], text[index]))
        ranges.append(_ranges(doc[text[first]], key[text[first]], place[first], place[last] + LENGTH))
    return np.flatnonzero(~gone), ranges


def _routed(at: np.ndarray, place: np.ndarray, text: np.ndarray, doc: np.ndarray, key: np.ndarray, route: np.ndarray, hot: np.ndarray, salted: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one route: where they begin, sizes, places in their texts, documents, text keys, buckets, and whether they are frequent."""
    first, last = runs_of(place, text, route)
    owner = doc[text[first]]
    return at[first], last - first + LENGTH, place[first], owner, key[text[first]], _bucket(route[first], salted[first], owner, buckets), hot[first]


def _packed(data: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """What ``_routed`` found in ``data``, packed by bucket, frequent runs apart."""
    at, size, start, doc, key, bucket, hot = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((start, key, doc, hot, bucket))
    at, size, start, doc, key, bucket, hot = (x[order] for x in (at, size, start, doc, key, bucket, hot))
    lead = np.flatnonzero(changes(bucket, hot))
    rows = list(pack_runs(data, at, size, start, doc, key, np.append(lead, len(at))))
    columns = [pa.array(bucket[lead]), pa.array(hot[lead]), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(rows), pa.int64())] * 4], schema=FLOW_ARROW)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def frequent_anchors(texts: DataFrame) -> np.ndarray:
    """Codes of anchors that stand in very many documents, ascending; at most ``FREQUENT_SHARE`` of them.

    A batch names the anchors that are frequent inside it. The choice only decides by which grams windows meet,
    so an anchor that this misses, being spread thin, is treated like any other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for x, _ in text_anchors(*flat_texts(batch.column(1)), _longs(batch, "doc_id"))]
            code = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            first = np.flatnonzero(changes(code)) if len(code) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(code)))
            often = n >= max(4, len(code) / FREQUENT_SHARE)
            codes = np.append(code[first[often]].view(np.int64), 0)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(np.append(n[often], len(code)))], names=["code", "n"])

    counts = texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialize(in_few_files(counts, texts.count()), "anchors")  # code 0 counts all of them
    total = counts.where("code = 0").first()
    least = max(FREQUENT, (total["n"] if total else 0) / FREQUENT_SHARE)
    rows = counts.where((F.col("code") != 0) & (F.col("n") >= least)).select("code").collect()
    return np.sort(np.array([r["code"] for r in rows], np.int64).view(np.uint64))


def _short(code: np.ndarray, buckets: int) -> np.ndarray:
    """What is kept of a code: its bucket and its upper half."""
    return code & np.uint64(0xFFFFFFFF00000000) | code % np.uint64(buckets)


def recurring_anchors(texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id, codes``: anchors of a document, but for frequent ones, that other documents hold too.

    Anchors are packed by chunk and bucket. One that several documents of a chunk hold is known there and
    then; its bucket gets it once, without documents, so no bucket holds more rows of an anchor than there are chunks.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            fresh = ~np.asarray(batch.column(2).fill_null(False)).astype(bool)
            batch = batch.filter(pa.array(fresh))
            for code, doc in text_anchors(*flat_texts(batch.column(1)), _longs(batch, "doc_id")):
                rare = ~is_in(code, frequent)
                found.append((code[rare], doc[rare]))
                held += int(rare.sum())
                if held >= PACKED:
                    yield from asks(found)
                    found, held = [], 0
        if held:
            yield from asks(found)

    def asks(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        code, doc = sorted_pairs(*(np.concatenate(x) for x in zip(*found, strict=True)))
        first = np.flatnonzero(changes(code))
        size = np.diff(np.append(first, len(code)))
        shared = np.repeat(size > 1, size)
        yield from _replies(doc[shared], _short(code[shared], buckets))
        bucket = (code % np.uint64(buckets)).astype(np.int64)
        upper = (code >> np.uint64(32)).astype(np.uint32)
        at, met = np.flatnonzero(~shared), np.flatnonzero(shared & changes(code))
        at, met = at[order_of(bucket[at], doc[at])], met[np.argsort(bucket[met], kind="stable")]
        edges, met_edges = (np.searchsorted(bucket[x], np.arange(buckets + 1)) for x in (at, met))
        rows = []
        for b in np.flatnonzero((np.diff(edges) > 0) | (np.diff(met_edges) > 0)).tolist():
            mine, theirs = at[edges[b] : edges[b + 1]], met[met_edges[b] : met_edges[b + 1]]
            steps, _ = _pack(np.diff(doc[mine], prepend=0))
            rows.append((b, upper[mine].tobytes(), steps, upper[theirs].tobytes()))
        columns = [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.nulls(len(rows), pa.int64()), *columns], schema=asked)

    def answer(bucket: int, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        codes, unpack = np.concatenate([np.frombuffer(r[0], np.uint32) for r in rows]), pa.Codec("zstd")
        docs = np.concatenate([np.cumsum(np.frombuffer(unpack.decompress(r[1], 2 * len(r[0]), asbytes=True), np.int64)) for r in rows])
        known = np.unique(np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]))
        codes, docs = sorted_pairs(codes, docs)
        first = np.flatnonzero(changes(codes)) if len(codes) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(codes)))
        several = docs[first] != docs[first + size - 1]
        recur = np.repeat(several, size) | is_in(codes, known)
        return docs[recur], codes[recur].astype(np.uint64) << np.uint64(32) | np.uint64(bucket)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows, found, held = None, [], [], 0

        def told() -> Iterator[pa.RecordBatch]:
            if found:
                pairs = (np.concatenate(x) for x in zip(*found, strict=True))
                yield from (x.select(["doc_id", "codes"]) for x in _replies(*pairs))
            found.clear()

        for batch in batches:
            passed = _longs(batch, "bucket") < 0
            if passed.any():
                yield batch.filter(pa.array(passed)).select(["doc_id", "codes"])
            for b, _, *row in zip(*(c.to_pylist() for c in batch.filter(pa.array(~passed)).columns), strict=True):
                if b != bucket and rows:
                    found.append(answer(bucket, rows))
                    held += len(found[-1][0])
                    rows = []
                    if held >= PACKED:
                        yield from told()
                        held = 0
                bucket = b
                rows.append(row)
        if rows:
            found.append(answer(bucket, rows))
        yield from told()

    asked = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.binary()), ("docs", pa.binary()), ("known", pa.binary())])
    questions = texts.mapInArrow(ask, "bucket long, doc_id long, codes binary, docs binary, known binary")
    # Replies known at once travel along: they have a document, but no bucket.
    spread = F.coalesce("bucket", -1 - F.pmod("doc_id", F.lit(buckets))).alias("bucket")
    placed = questions.select(spread, "doc_id", "codes", "docs", "known").repartition(-(-buckets // BUCKETS_A_TASK), "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(answers, "doc_id long, codes binary")


def _replies(doc: np.ndarray, short: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per document with its codes."""
    if not len(doc):
        return
    order = np.lexsort((short, doc))
    doc, short = doc[order], short[order]
    first = np.flatnonzero(changes(doc))
    codes = [x.tobytes() for x in np.split(short, first[1:])]
    none = pa.nulls(len(first), pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(first), pa.int64()), pa.array(doc[first]), pa.array(codes, pa.binary()), none, none], names=["bucket", "doc_id", "codes", "docs", "known"]
    )


def candidate_windows(texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """``FLOW``: what batches of ``doc_id, text, copied, text_key, codes`` can tell by themselves, and the windows left.

    A text that a smaller id holds as a whole falls as a whole. ``texts`` must be in order, so that a repeated
    task gives the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied = np.asarray(batch.column(2).fill_null(False)).astype(bool)
            if copied.any():
                whole = batch.filter(pa.array(copied))
                size = np.diff(flat_texts(whole.column(1))[1])
                long = size >= LENGTH
                if long.any():
                    yield _ranges(_longs(whole, "doc_id")[long], _longs(whole, "text_key")[long], np.zeros(long.sum(), np.int64), size[long])
                batch = batch.filter(pa.array(~copied))
            data, starts = flat_texts(batch.column(1))
            ids, keys = _longs(batch, "doc_id"), _longs(batch, "text_key")
            told = [x for c in batch.column(4).to_pylist() for x in c or ()]
            told = np.unique(np.frombuffer(b"".join(told), np.uint64))
            found, held = [], 0
            for first, piece, whole, text in chunks(data, starts):
                code = anchors(piece, GRAM)[whole]
                begin, end = runs_of(whole, text, code)
                hot = is_in(code[begin], frequent)
                keep = hot | is_in(_short(code[begin], buckets), told)
                size = end - begin + 1
                index = np.flatnonzero(np.repeat(keep, size))
                if not len(index):
                    continue
                hot, route, at, text = np.repeat(hot, size)[index], code[index], whole[index], text[index]
                place = at + first - starts[text]
                left, ranges = _settled(piece, at, place, text, ids, keys)
                yield from ranges
                if len(left):
                    at, place, text, route, hot = (x[left] for x in (at, place, text, route, hot))
                    if hot.any():
                        route[hot] = anchors_at(piece, at[hot], LONG_GRAM)
                    found.append(_routed(at + first, place, text, ids, keys, route, hot, hot, buckets))
                    held += int(found[-1][1].sum()) + 32 * len(found[-1][1])
                    if held >= PACKED_BYTES:
                        yield _packed(data, found)
                        found, held = [], 0
            if found:
                yield _packed(data, found)

    return texts.select("doc_id", "text", "copied", "text_key", "codes").mapInArrow(run, FLOW)


def _bucket(route: np.ndarray, hot: np.ndarray, doc: np.ndarray, buckets: int) -> np.ndarray:
    """Where windows meet: frequent ones first within a share of the documents."""
    salt = (doc.astype(np.int64).view(np.uint64) % np.uint64(SALTS)) * np.uint64(MIX[0])
    mixed = np.where(hot, route ^ salt, route)
    return ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def settle(flow: DataFrame, buckets: int, last: bool) -> DataFrame:
    """Compares windows that meet in a bucket; removed ranges pass.

    Frequent windows meet in two rounds: first within a share of the documents, whose winners go on, then all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            packed = np.asarray(batch.column(2).is_valid())
            if not packed.all():
                yield batch.filter(pa.array(~packed))
                batch = batch.filter(pa.array(packed))
            for b, hot, runs, size in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != bucket and held:
                    yield from compare(held)
                    held = []
                bucket = b
                held.append((hot, runs, size))
        if held:
            yield from compare(held)

    def compare(held: list[tuple[bool, bytes, int]]) -> Iterator[pa.RecordBatch]:
        parts = [unpack_runs(runs, size) for _, runs, size in held]
        data = np.concatenate([p[0] for p in parts])
        size, doc, key, start = (np.concatenate([p[1][k] for p in parts]) for k in range(4))
        hot = np.repeat([h for h, _, _ in held], [len(p[1][0]) for p in parts])
        windows = size - LENGTH + 1
        run = np.repeat(np.arange(len(size)), windows)
        within = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
        at, place = (np.cumsum(size) - size)[run] + within, start[run] + within
        left, ranges = _settled(data, at, place, run, doc, key)
        yield from ranges
        left = left[hot[run[left]]] if not last else left[:0]
        if len(left):
            at, place, run = at[left], place[left], run[left]
            route, again = anchors_at(data, at, LONG_GRAM), np.ones(len(left), bool)
            yield _packed(data, [_routed(at, place, run, doc, key, route, again, ~again, buckets)])

    return flow.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FLOW)


def whole_copies(texts: DataFrame) -> DataFrame:
    """``doc_id, copies``: keys of texts of a document that one with a smaller id holds as a whole."""
    rows = texts.select("doc_id", "text_key", F.unhex(F.sha2("text", 256)).alias("digest"))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    total = texts.count()
    firsts = materialize(in_few_files(firsts.where("first < last"), total), "copies").drop("last")
    found = join_counted(rows, firsts, ["digest"], "n", total).where("doc_id > first")
    return in_few_files(found.groupBy("doc_id").agg(F.collect_set("text_key").alias("copies")), total)


def removed_ranges(texts: DataFrame, dealt: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, stop``: byte ranges of ``doc_id, text, text_key`` to remove; they may overlap.

    ``dealt`` has the same rows, partitioned by document.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    frequent = frequent_anchors(texts.select("doc_id", "text"))
    copies = materialize(whole_copies(texts), "copies")
    marked = dealt.join(copies, "doc_id", "left").withColumn("copied", F.array_contains("copies", F.col("text_key")))
    codes = recurring_anchors(marked.select("doc_id", "text", "copied"), frequent, buckets)
    codes = codes.groupBy("doc_id").agg(F.collect_list("codes").alias("codes"))
    known = marked.join(codes, "doc_id", "left").select("doc_id", "text", "copied", "text_key", "codes")
    flow = candidate_windows(known.sortWithinPartitions("doc_id", "text_key"), frequent, buckets)
    ranges = settle(settle(flow, buckets, last=False), buckets, last=True)
    return ranges.where("runs IS NULL").select("doc_id", "text_key", "start", "stop")


def cut_spans(ranges: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The maximal runs covered by rows of first and last byte."""
    if not len(ranges):
        return []
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, ranges[:, 0], 1)
    np.add.at(edges, ranges[:, 1], -1)
    covered = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    turns = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key``, ``n_bytes, n_removed, n_spans, kept`` (the bytes left) and ``spans``, the removed runs.

    A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller id, in the texts
    as given. Null texts count as empty ones. Rows with equal ids do not remove each other's bytes; rows without
    an id neither remove nor lose any. Other columns are ignored, an empty table stays empty. Texts of any length
    are cut into pieces that overlap.
    """
    ship_package(df.sparkSession)
    text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    texts = rows.where("doc_id IS NOT NULL")
    dealt = texts.repartition("doc_id")  # one shuffle of the texts for all that reads them by document
    ranges = removed_ranges(texts, dealt).groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "start", "stop")).alias("ranges"))
    found = dealt.join(ranges, "doc_id", "left").select("doc_id", "text", "text_key", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat_texts(batch.column(1))
            keys, out = _longs(batch, "text_key").tolist(), []
            ranges = batch.column(3)
            inner = ranges.flatten()
            owner, begin, end = (inner.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            lengths = np.where(ranges.is_valid(), ranges.value_lengths().fill_null(0), 0).astype(np.int64)
            edges = np.append(0, np.cumsum(lengths)).tolist()
            ids = batch.column(0).to_pylist()
            for i, here in enumerate(keys):
                held = data[starts[i] : starts[i + 1]].tobytes()
                mine = slice(edges[i], edges[i + 1])
                which = owner[mine] == here
                spans = cut_spans(np.stack([begin[mine][which], end[mine][which]], 1).astype(np.int64), len(held))
                bounds = [0, *(x for s in spans for x in s), len(held)]
                kept = b"".join(held[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                removed = sum(b - a for a, b in spans)
                out.append((ids[i], len(held), removed, len(spans), kept, [{"start": a, "stop": b} for a, b in spans]))
            columns = [pa.array(list(c), kind.type) for c, kind in zip(zip(*out, strict=True), result, strict=True)] if out else [pa.array([], k.type) for k in result]
            yield pa.RecordBatch.from_arrays(columns, schema=result)

    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    result = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")), ("kept", pa.binary()), ("spans", pa.list_(span))])
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start: long, stop: long>>"
    out = found.mapInArrow(cut, kind)
    zero, nothing = F.lit(0).cast("long"), F.array().cast("array<struct<start: long, stop: long>>").alias("spans")
    apart = rows.where("doc_id IS NULL").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"), nothing)
    return out.unionByName(apart).withColumnRenamed("doc_id", key)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``remove_repeats`` with the digest of the kept bytes in their place."""
    out = remove_repeats(df, key, text)
    return out.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
