"""Near-duplicates by weighted MinHash over multisets of word shingles.

Signatures are drawn as in BagMinHash: a shingle with count ``w`` owns the integer levels up to
``w``; the levels form intervals that double in length, every interval has one Poisson process
of its length times the number of registers, and a point, which falls on a register and on a level of its
interval, counts where the level is at most ``w``. A register keeps its earliest point, and two
documents agree in a register with their weighted Jaccard similarity as probability. Points are
drawn in order of time and only up to the time by which all registers are filled.

Bands of registers give candidates and multiset overlap decides. In a band's bucket everything is
compared with one member first. Buckets that then hold several classes still are settled by an exact
filter: texts in different classes are compared if they share one of their rarest tokens, as all
texts that overlap enough do. No bucket is ever turned into all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import ship_package, slices, texts_of
from urbanflux.llm.components import connected_components
from urbanflux.llm.ordered import join_counted
from urbanflux.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at the least similarity shares no band once in about 55,000 times.
BANDS, ROWS = 36, 6

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``size`` words, and their counts; fewer words form one run."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    rows = np.full(n, size, np.uint64)
    for k in range(size):
        rows = (rows ^ codes[k : k + n]) * _MULTIPLY
        rows ^= rows >> np.uint64(29)
    return np.unique(rows, return_counts=True)


def overlap(a: str, b: str, size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of two texts; 0 where one has no words."""
    (x, n), (y, m) = shingles(a, size), shingles(b, size)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common / (int(n.sum() + m.sum()) - common) if common else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """Earliest point of every register (row: document); all infinite for an empty bag."""
    out = np.full((len(bags), registers), np.inf)
    todo = np.array([i for i, (x, _) in enumerate(bags) if len(x)], np.int64)
    factor = 1.0
    while len(todo):
        # Intervals of levels: (0, 1], (1, 2], (2, 4], ... as far as they begin below the count.
        keys = np.concatenate([bags[i][0] for i in todo])
        counts = np.concatenate([bags[i][1] for i in todo])
        docs = np.repeat(np.arange(len(todo)), [len(bags[i][0]) for i in todo])
        total = np.bincount(docs, counts)
        limit = factor * (np.log(registers) + 3) / total
        parts, low, k = [], 0, 0
        chosen = np.arange(len(keys))
        while len(chosen):
            parts.append((chosen, np.full(len(chosen), low), np.full(len(chosen), max(1, low)), np.full(len(chosen), k)))
            low, k = max(1, 2 * low), k + 1
            chosen = chosen[counts[chosen] > low]
        at, low, length, level = (np.concatenate(x) for x in zip(*parts, strict=True))
        seed = _mixed(keys[at] + level.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        doc, count, time = docs[at], counts[at], np.zeros(len(at))
        until, rate = limit[doc], 1.0 / (registers * length)
        first = np.full(len(todo) * registers, np.inf)
        while len(seed):
            seed = seed + _MULTIPLY
            drawn = _mixed(seed)
            time = time - np.log(((drawn >> np.uint64(11)) + 0.5) * 2.0**-53) * rate
            alive = np.flatnonzero(time <= until)
            seed, time, doc, until, rate = seed[alive], time[alive], doc[alive], until[alive], rate[alive]
            count, low, length = count[alive], low[alive], length[alive]
            place = _mixed(drawn[alive] ^ np.uint64(0xA5A5A5A5DEADBEEF))
            register = ((place >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            on = low + 1 + ((place & np.uint64(0xFFFFFFFF)) * length.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            hit = on <= count
            np.minimum.at(first, (doc * registers + register)[hit], time[hit])
        first = first.reshape(len(todo), registers)
        full = np.isfinite(first).all(axis=1)
        out[todo[full]] = first[full]
        todo, factor = todo[~full], factor * 2
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of a signature (row: document)."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    keys = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]) * _MULTIPLY
    for k in range(rows):
        keys = _mixed((keys ^ bits[:, :, k]) * _MULTIPLY)
    return keys.view(np.int64)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _signed(df: DataFrame, key: str, text: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per document its key, the digest of its text, and its bands (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = list(texts_of(batch, "text"))
            bags = [shingles(x, shingle) for x in texts]
            keys = band_keys(signatures(bags, bands * rows), rows).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("key")),
                    pa.array([hashlib.md5(x.encode()).digest() for x in texts], pa.binary()),
                    pa.array([k if len(b[0]) else None for k, b in zip(keys, bags, strict=True)], pa.list_(pa.int64())),
                ],
                names=["key", "text_key", "bands"],
            )

    ship_package(df.sparkSession)
    plain = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return plain.mapInArrow(run, f"key {plain.schema['key'].dataType.simpleString()}, text_key binary, bands array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose texts overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("text_a", "text_b"))
            good = [overlap(x.as_py(), y.as_py(), shingle) >= similarity for x, y in zip(a, b, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sides = pairs.join(texts.select(F.col("text_key").alias("b"), F.col("text").alias("text_b")), "b")
    sides = sides.join(texts.select(F.col("text_key").alias("a"), F.col("text").alias("text_a")), "a")
    return sides.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _tokens(text: str, shingle: int) -> np.ndarray:
    """One token per shingle and occurrence: multisets overlap as these sets do."""
    keys, counts = shingles(text, shingle)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(np.repeat(keys, counts) + number.astype(np.uint64) * _MULTIPLY)


def _prefix_pairs(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs of ``texts`` (``text_key, class, text``) in different classes that may be similar enough.

    Tokens are ordered by the number of texts that hold them. Two sets of ``n`` and ``m`` tokens that
    overlap enough share ``(n + m) * s / (1 + s)`` of them; at the first they share, both must have
    that many left. So a token at place ``i`` of ``n`` only serves partners of up to
    ``(n - i) * (1 + s) / s - n`` tokens, and for partners of its own size or more (``short``) its
    place lies among the rarest ninth (for a similarity of 0.8). What differs from all others fills
    these places, so a text that is close to none meets none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_tokens(x, shingle) for x in texts_of(batch, "text")]
            sizes = [len(x) for x in found]
            at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            kept = [batch.column(batch.schema.get_field_index(c)).take(at) for c in ("text_key", "class")]
            tokens = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.repeat(sizes, sizes).astype(np.int64)), pa.array(tokens)], names=["text_key", "class", "n", "token"]
            )

    tokens = texts.select("text_key", "class", "text").mapInArrow(run, "text_key binary, class binary, n bigint, token bigint")
    tokens = materialize(tokens, "tokens")
    mixed = F.min("class") != F.max("class")
    held = tokens.groupBy("token").agg(F.count("*").alias("texts"), mixed.alias("mixed"))
    place = F.row_number().over(Window.partitionBy("text_key").orderBy("texts", "token")) - 1
    ranked = tokens.join(held, "token").withColumn("place", place)
    reach = (F.col("n") - F.col("place")) * ((1 + similarity) / similarity) - F.col("n") + 1e-6
    rows = ranked.where("mixed").withColumns({"reach": reach, "short": reach >= F.col("n")})
    rows = materialize(rows.where(reach >= similarity * F.col("n") - 1), "prefixes")
    least = rows.where("short").groupBy("token").agg(F.min("n").alias("least"))
    rows = rows.join(least, "token").where("short OR reach >= least").drop("least")
    rows = materialize(rows, "prefixes")
    several = rows.groupBy("token").agg(mixed.alias("mixed")).where("mixed").select("token")
    rows = rows.join(several, "token")
    others = rows.select("token", F.col("class").alias("other")).distinct()
    left = rows.where("short").join(others, "token").where("class != other")
    left = left.select("token", "other", F.col("text_key").alias("a"), F.col("n").alias("n_a"), F.col("reach").alias("reach_a"))
    right = rows.select("token", F.col("class").alias("other"), F.col("text_key").alias("b"), "n", "reach")
    pairs = left.join(right, ["token", "other"]).where("n_a <= n AND n <= reach_a AND n_a <= reach")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(members: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Classes ``(node, class)`` of the texts that have a link; no link inside a bucket is lost.

    First every member of a bucket is compared with one: the one that shares most buckets with others,
    which is what copies of one text are copies of. Buckets that still hold several classes
    are compared by their rarest tokens.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    weights = members.join(sizes, "bucket").groupBy("text_key").agg(F.sum("n").alias("weight"))
    weights = materialize(weights, "weights")
    centre = F.max(F.struct("weight", "text_key"))["text_key"]
    centres = members.join(weights, "text_key").groupBy("bucket").agg(centre.alias("a"))
    pairs = members.join(centres, "bucket").where("a != text_key")
    pairs = pairs.select(F.least("a", "text_key").alias("a"), F.greatest("a", "text_key").alias("b")).distinct()
    links = materialize(_verified(pairs, texts, shingle, similarity), "links")

    # What is linked to the same text is in one class: the heaviest neighbour (or itself) stands for it.
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    heavy = ends.groupBy("b").agg(F.count("*").alias("n")).join(weights.select(F.col("text_key").alias("b"), "weight"), "b")
    ends = join_counted(ends, heavy, ["b"], "n", 2 * links.count(), {"b": F.col("a")})
    ends = ends.select(F.col("a").alias("text_key"), "weight", F.col("b").alias("class"))
    own = weights.select("text_key", "weight", F.col("text_key").alias("class"))
    heads = ends.unionByName(own).groupBy("text_key").agg(F.max(F.struct("weight", "class"))["class"].alias("class"))
    rows = materialize(members.join(heads, "text_key"), "buckets")
    mixed = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high")
    left = rows.join(mixed.select("bucket"), "bucket").select("text_key", "class").distinct()
    left = materialize(texts.join(left, "text_key"), "unresolved")
    pairs = materialize(_prefix_pairs(left, shingle, similarity), "pairs")
    more = materialize(_verified(pairs, texts, shingle, similarity), "links")
    return materialize(connected_components(links.unionByName(more)), "classes")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``(key, text_key, class_id, keeper)`` for every row of ``df``.

    Rows are in one class when a chain of texts links them whose neighbours are equal or overlap in
    at least ``similarity`` of their shingles (weighted Jaccard, words split at white space). ``class_id``
    is the smallest key of the class (null if all are null). ``keeper`` marks the smallest key of the
    class with the smallest digest; repeated rows of that key and text all carry the mark. A text
    without words, null included, is no copy of anything and its row is a class of its own, of its
    own key. Other columns are not looked at; an empty table gives an empty result.
    """
    signed = materialize(_signed(df, key, text, shingle, bands, rows), "signatures")
    worded = signed.where("bands IS NOT NULL")
    distinct = worded.groupBy("text_key").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    distinct = materialize(distinct, "texts")
    placed = distinct.select("text_key", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = materialize(placed.join(shared, "bucket").select("bucket", "text_key"), "buckets")

    wanted = members.select("text_key").distinct().join(distinct.select("text_key", "key"), "text_key")
    wanted = wanted.select("text_key", F.coalesce(F.col("key").cast("string"), F.lit("")).alias("name"))
    full = df.select(
        _text_key(F.col(text)).alias("text_key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text")
    )
    texts = full.join(wanted, ["text_key", "name"], "left_semi").select("text_key", "text").dropDuplicates(["text_key"])
    classes = _links(members, materialize(texts, "candidates"), shingle, similarity)

    named = distinct.select("text_key", "key").join(classes.withColumnRenamed("node", "text_key"), "text_key", "left")
    named = named.withColumn("class", F.coalesce("class", "text_key"))
    best = F.min(F.struct(F.col("key").isNull().alias("missing"), "key", "text_key"))
    heads = named.groupBy("class").agg(best.alias("best"))
    named = named.join(heads, "class").select(
        "text_key", F.col("best.key").alias("class_id"), F.col("best.text_key").alias("best_text")
    )
    out = worded.select("key", "text_key").join(named, "text_key")
    keeper = F.col("key").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("best_text"))
    out = out.select("key", "text_key", "class_id", keeper.alias("keeper"))
    alone = signed.where("bands IS NULL").select("key", "text_key", F.col("key").alias("class_id"), F.lit(True).alias("keeper"))
    return out.unionByName(alone).withColumnRenamed("key", key)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class of ``near_duplicates``, with the columns of ``df``.

    Of rows that repeat the kept key and text the smallest stays, by the other columns.
    Every row without words stays.
    """
    found = near_duplicates(df, key, text, **options)
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    wanted = found.where("keeper").select(F.hex("text_key").alias("nd_text"), name.alias("nd_name")).distinct()
    marked = df.withColumns({"nd_text": F.hex(_text_key(F.col(text))), "nd_name": name})
    chosen = marked.join(wanted, ["nd_text", "nd_name"], "left_semi")
    worded = F.col(text).rlike(r"[^\x20\x09-\x0D]")
    others = [c for c, kind in df.dtypes if c not in (key, text) and not kind.startswith("map")]
    order = Window.partitionBy("nd_text", "nd_name").orderBy(*(others or ["nd_name"]))
    place = F.when(worded, F.row_number().over(order)).otherwise(1)
    return chosen.withColumn("nd_place", place).where("nd_place = 1").drop("nd_text", "nd_name", "nd_place")
