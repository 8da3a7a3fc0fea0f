"""Spelling variants: words that differ by one inserted, deleted or replaced character.

Words in order number the nodes of a forward trie, reversed words those of a backward one. Cutting a word
before a character gives a pair of integers, the node of what stands before and the node of what stands after:
leaving the character out (a skipping pair) or not (a gap pair). Words with equal skipping pairs differ by one
replaced character; a skipping pair of one word that is a gap pair of another is a deletion. A pair of nodes
spells out all other characters, so these neighbours are exact, and a pair is shared by at most one word as a
gap and by one word per letter as a skip.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import ship_package
from urbanflux.llm.ordered import in_few_files, in_order
from urbanflux.session import materialize

LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: How many times as frequent a form must be.
RATIO = 5
#: One word in so many, chosen by checksum, loses a character.
MANGLED = 199
#: Distinct words that a task counts before it hands them on, and pairs that it forms together.
COUNTED = 400_000
PAIRS = 200_000
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted_words(
    documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_LENGTH, often: int = MIN_COUNT, mangled: int | None = MANGLED
) -> DataFrame:
    """``word, n`` over all texts, of words of ``least`` characters that occur ``often`` times, ``A-Z`` lower-cased.

    One run in ``mangled`` first loses the character its checksum points at. Null texts have no words; a null key
    counts as the empty text in the checksum. Tasks count in dictionaries of bounded size.
    """
    run = re.compile(f"[{LETTERS}]{{{least},}}")
    number = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("number")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for number, text in zip(batch.column(0), batch.column(1), strict=True):
                words = run.findall((text.as_py() or "").translate(LOWER))
                if mangled:
                    prefix = zlib.crc32(f"{number.as_py()}:".encode())
                    words = [_mangled(w, zlib.crc32(w.encode(), prefix), mangled) for w in words]
                counts.update(words)
                if len(counts) >= COUNTED:
                    yield _rows(counts)
                    counts.clear()
        yield _rows(counts)

    def _rows(counts: Counter[str]) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= least]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    parts = documents.select(number, F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _mangled(word: str, checksum: int, one_in: int) -> str:
    if checksum % one_in:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def boundary_owners(ends: list[tuple[int, str, str]]) -> dict[int, tuple[str, list[int], str, list[int]]]:
    """Which part numbers the nodes that a part shares with its neighbours.

    ``ends`` has the number, first and last word of each part, in order. Per part: the prefix that its first
    words may share with the part before, the owner of each length of it, and the same for the part after. The
    owner is the first part whose last word holds the node.
    """
    shared = [_common(last, first) for (_, _, last), (_, first, _) in zip(ends, ends[1:], strict=False)]
    out, before, owners = {}, "", []
    for k, (part, first, last) in enumerate(ends):
        after = last[: shared[k]] if k < len(shared) else ""
        through = min(_common(first, last), len(before))  # nodes that hold the whole part
        following = [owners[i] if i <= through and i < len(owners) else part for i in range(len(after) + 1)]
        out[part] = (before, owners, after, following)
        before, owners = after, following
    return out


def trie_nodes(ordered: DataFrame, word: str, out: str) -> DataFrame:
    """Adds ``out``: the nodes of all prefixes of ``word``, from the root on, for a table of ``in_order`` by it.

    Nodes are numbered part by part; a node that goes on in the next part belongs to the first part that holds it.
    Only the first and last word of every part reach the driver.
    """
    ends = ordered.groupBy("part").agg(F.min_by(word, "place").alias("a"), F.max_by(word, "place").alias("z")).orderBy("part").collect()
    owners = boundary_owners([tuple(r) for r in ends])
    schema = ordered.select("place", "part", word)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, previous, path, fresh = None, "", [], 0
        for batch in batches:
            places, parts, texts = (batch.column(i).to_pylist() for i in range(3))
            nodes = []
            for here, text in zip(parts, texts, strict=True):
                if here != part:
                    part, previous, path, fresh = here, "", [], 0
                    before, of_before, after, of_after = owners[part]
                keep = _common(previous, text) if path else -1
                path = path[: keep + 1]
                low, high = _common(before, text), _common(after, text)
                for depth in range(keep + 1, len(text) + 1):
                    if depth <= low and depth < len(of_before):
                        path.append(-(of_before[depth] << 33 | depth) - 1)
                    elif depth <= high and depth < len(of_after):
                        path.append(-(of_after[depth] << 33 | depth) - 1)
                    else:
                        path.append(part << 33 | fresh)
                        fresh += 1
                nodes.append(path)
                previous = text
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))], names=["place", out]
            )

    sorted_parts = schema.repartition("part").sortWithinPartitions("part", "place")
    return sorted_parts.select("place", "part", word).mapInArrow(number, f"place long, {out} array<long>")


PAIR = ("before", "after", "skips", "first", "id", "n")


def _pairs(words: DataFrame) -> DataFrame:
    """``PAIR``: all skipping (``skips``) and gap pairs of every word of ``id, n, word, forward, backward``.

    ``first`` marks the first of equal characters in a row, so that a deletion is told by one pair only.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _bounded(batch):
                ids, n = (rows.column(i).to_numpy() for i in (0, 1))
                forward, backward = (rows.column(i).flatten().to_numpy() for i in (3, 4))
                chars = np.frombuffer("".join(rows.column(2).to_pylist()).encode("utf-32-le"), np.uint32)
                size = rows.column(3).value_lengths().to_numpy().astype(np.int64)  # nodes: a gap pair each
                start = np.cumsum(size) - size
                word = np.repeat(np.arange(len(size)), size)
                i = np.arange(len(word)) - start[word]
                mirrored = start[word] + size[word] - 1 - i
                here = i < size[word] - 1
                at = np.flatnonzero(here)
                place = at - word[at]  # of the character in all characters
                fresh = (i[at] == 0) | (chars[place] != chars[np.maximum(place - 1, 0)])
                columns = [
                    np.concatenate([forward, forward[at]]),
                    np.concatenate([backward[mirrored], backward[mirrored[at] - 1]]),
                    np.repeat([False, True], [len(word), len(at)]),
                    np.concatenate([np.zeros(len(word), bool), fresh]),
                    *(np.concatenate([x[word], x[word[at]]]) for x in (ids, n)),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(PAIR))

    kinds = "before long, after long, skips boolean, first boolean, id long, n long"
    return words.select("id", "n", "word", "forward", "backward").mapInArrow(cut, kinds)


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PAIRS`` pairs, a single long word being one."""
    total, begin = 0, 0
    for k, size in enumerate(batch.column(3).value_lengths().to_pylist()):
        if total and total + size > PAIRS:
            yield batch.slice(begin, k - begin)
            total, begin = 0, k
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def seen_in_pairs(before: np.ndarray, after: np.ndarray, skips: np.ndarray, first: np.ndarray, ids: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """``id, near, near_n, near_id`` per word and pair: how many words it meets there, and the best of them.

    Rows stand by pair. A pair has at most one gap word and one skipping word per letter; of the latter the two
    most frequent ones (ties: smallest id) say all, so no pairs of words are formed.
    """
    group = np.cumsum(np.append(True, (before[1:] != before[:-1]) | (after[1:] != after[:-1]))) - 1
    order = np.lexsort((ids, -n, ~skips, group))  # skipping words first, best first
    skips, first, ids, n, group = (x[order] for x in (skips, first, ids, n, group))
    start = np.searchsorted(group, np.arange(group[-1] + 1))
    held = np.bincount(group[skips], minlength=len(start))  # skipping words of a pair
    size = np.diff(np.append(start, len(group)))
    gap = np.where(size > held, start + held, -1)[group]
    lead, place = start[group], np.arange(len(group))
    none = -1
    other = np.where(place != lead, lead, np.where(held[group] > 1, lead + 1, none))
    deleted = np.where(first, gap, none)
    better = (other < 0) | ((deleted >= 0) & ((n[deleted] > n[other]) | ((n[deleted] == n[other]) & (ids[deleted] < ids[other]))))
    best = np.where(deleted >= 0, np.where(better, deleted, other), other)
    near = held[group] - 1 + (deleted >= 0)
    firsts = np.bincount(group[first], minlength=len(start))
    lead_first = np.full(len(start), none)
    at = np.flatnonzero(first)[::-1]
    lead_first[group[at]] = at  # the last assignment, the best one, stays
    near = np.where(skips, near, firsts[group])
    best = np.where(skips, best, lead_first[group])
    kept = np.flatnonzero(near > 0)
    return [ids[kept], near[kept], n[best[kept]], ids[best[kept]]]


def neighbours(words: DataFrame) -> DataFrame:
    """``id, n_near, near_n, near_id`` of ``id, n, word, forward, backward``: how many words are near, and the
    most frequent one (ties: smallest id). Words without any are left out.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in PAIR]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            before, after = columns[:2]
            last = np.flatnonzero((before != before[-1]) | (after != after[-1]))
            whole = int(last[-1]) + 1 if len(last) else 0  # the last pair may go on in the next batch
            if whole:
                yield rows(seen_in_pairs(*(c[:whole] for c in columns)))
            held = [c[whole:] for c in columns]
        if held is not None and len(held[0]):
            yield rows(seen_in_pairs(*held))

    def rows(found: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names=["id", "near", "near_n", "near_id"])

    pairs = _pairs(words).repartition("before", "after").sortWithinPartitions("before", "after")
    seen = pairs.mapInArrow(meet, "id long, near long, near_n long, near_id long")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near_id")).alias("best")
    found = seen.groupBy("id").agg(F.sum("near").alias("n_near"), best)
    return found.select("id", "n_near", (-F.col("best")["n"]).alias("near_n"), F.col("best")["near_id"].alias("near_id"))


def variant_groups(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n`` (unique words).

    ``form`` is the near word of largest ``n`` (ties: smallest by code point), if it is at least ``ratio`` times
    as frequent, else null; ``root`` follows forms to the last. Other columns are ignored; an empty table has
    no words. Long words cost a pair per character.
    """
    if ratio < 2:
        raise ValueError(f"a form must be at least twice as frequent, not {ratio} times")
    ship_package(counted.sparkSession)
    words = materialize(counted.select("word", "n"), "words")
    forward = in_order(words, ["word"], "forward").withColumnRenamed("place", "id")
    back = in_order(forward.select("id", F.reverse("word").alias("reversed")), ["reversed"], "backward")
    prefixes = trie_nodes(forward.withColumnRenamed("id", "place"), "word", "forward").withColumnRenamed("place", "id")
    suffixes = trie_nodes(back, "reversed", "backward").join(back.select("place", "id"), "place").drop("place")
    numbered = forward.select("id", "n", "word").join(prefixes, "id").join(suffixes, "id")
    rows = forward.select("id", "word", "n").join(neighbours(numbered), "id", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    rows = rows.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("near_id")).alias("form_id"), F.when(has, F.col("near_n")).alias("form_n"),
    )
    size = words.agg(F.count("*").alias("words"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    rows = materialize(in_few_files(rows, size["words"]), "forms")
    links = rows.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id"))
    roots = _followed(links, size["most"], ratio)
    names = rows.select("id", "word")
    named = rows.join(roots, "id", "left")
    named = named.join(names.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id", "left")
    named = named.join(names.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _followed(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """Last forms. A form is ``ratio`` times as frequent as its word, so a path has no more steps than the
    largest count ``most`` has powers of that.
    """
    steps, power = 0, ratio
    while power <= most:
        steps, power = steps + 1, power * ratio
    onward = links.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
    for _ in range(steps - 1):
        links = links.join(onward, "root_id", "left").select("id", F.coalesce("next", "root_id").alias("root_id"))
    return links


def spelling_variants(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The variant groups of all words of all texts, see ``counted_words`` and ``variant_groups``.

    Null and empty texts have no words, repeated rows count as often as they stand there, other columns are
    ignored, and an empty table has no words.
    """
    ship_package(documents.sparkSession)
    counted = counted_words(documents.select(key, text), key, text)
    return variant_groups(in_few_files(counted, 5 * documents.count()))
