"""Byte-pair encoding and decoding with a vocabulary file of the ``tokenizers`` format.

Method: the symbols of a word form a doubly linked list, all mergeable neighbours stand in a
priority queue by merge rank and place, and entries whose pair has changed meanwhile are skipped.
Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflux.llm.common import TwoGenerationCache, ship_package, slices, texts_of

VOCABULARY = "word_bpe_49k.json"
#: Words whose encoding a worker remembers (about 250 bytes each, two generations): 100 MB beside the merges.
CACHED_WORDS = 200_000


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary lies; a path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


@dataclass(frozen=True)
class Characters:
    """Where the tables of the tokenizer library and Python's disagree about single characters.

    ``classes``: first and last code point of a range and the class the library has it in (``L`` letter, ``N`` number,
    ``S`` space, ``O`` other); ``lower``: characters and what the library lower-cases them to.
    """

    classes: tuple[tuple[int, int, str], ...] = ()
    lower: tuple[tuple[str, str], ...] = ()

    def of(self, wanted: Callable[[str], bool]) -> str:
        """The ranges of some classes, as they stand inside a set of a pattern."""
        return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b, kind in self.classes if wanted(kind))


@lru_cache(maxsize=2)
def characters(path: str) -> Characters:
    """Asks the library about every code point, once on the driver; versions of Unicode differ in about a thousand."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and not chr(c).isascii()]
    text, theirs = "".join(every), {}
    for _, (start, end) in library.pre_tokenizer.pre_tokenize_str(text):
        # one run of letters, one number, or one run of others; a letter joins one before it, a number none
        joined = library.pre_tokenizer.pre_tokenize_str("a" + text[start])
        kind = "L" if len(joined) == 1 else "N" if len(library.pre_tokenizer.pre_tokenize_str(text[start] * 2)) == 2 else "O"
        theirs.update(dict.fromkeys(range(start, end), kind))
    ours = regex.compile(r"(?P<L>\p{L})|(?P<N>\p{N})|(?P<S>\p{White_Space})|(?P<O>.)", regex.DOTALL)
    classes: list[tuple[int, int, str]] = []
    for m in ours.finditer(text):
        code, kind = ord(m.group()), theirs.get(m.start(), "S")
        if m.lastgroup != kind:
            first = classes.pop()[0] if classes and classes[-1][1:] == (code - 1, kind) else code
            classes.append((first, code, kind))
    lower = tuple(
        (c, low) for c in every
        if not c.isspace() and unicodedata.is_normalized("NFC", c) and (low := library.normalizer.normalize_str(c)) != c.replace("Σ", "σ").lower()
    )
    return Characters(tuple(classes), lower)


class WordBpe:
    """Encoder and decoder for byte-level word vocabularies whose last symbol carries a suffix."""

    def __init__(self, path: str, characters: Characters = Characters()):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        # left * size + right -> rank; merged[rank] is what the two become
        self.size = max(vocab.values()) + 1
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left] * self.size + vocab[right]] = rank
            self.merged.append(vocab[left + right])
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {number: text for text, number in (vocab | added).items()}
        self.added = added
        self.added_pattern = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.split = regex.compile(pattern)
        # texts with a character that the two sides see differently take a slower way
        self.lower = dict(characters.lower)
        odd = characters.of(lambda kind: True) + "".join(rf"\U{ord(c):08x}" for c in self.lower)
        self.odd = regex.compile(f"[{odd}]") if odd else None
        for name, kind in ((r"\p{White_Space}", "S"), (r"\p{L}", "L"), (r"\p{N}", "N")):
            gone, come = characters.of(lambda k: k != kind), characters.of(lambda k: k == kind)  # noqa: B023
            pattern = pattern.replace(name, f"[{f'[{name}--[{gone}]]' if gone else name}{come}]")
        self.careful_split = regex.compile(pattern, regex.V1)
        self.words = TwoGenerationCache(self.encode_word, CACHED_WORDS)

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Symbols of one word after all merges, lowest rank first, leftmost first among equals."""
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        rank_of, merged, size, n = self.ranks.get, self.merged, self.size, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        bits = n.bit_length()
        place = (1 << bits) - 1
        queue = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            if (rank := rank_of(left * size + right)) is not None:
                queue.append(rank << bits | i - 1)
            left = right
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & place
            j = after[i]
            left = ids[i]
            if left < 0 or j < 0 or (rank := rank_of(left * size + ids[j])) is None:
                continue
            new = merged[entry >> bits]
            if merged[rank] != new:
                continue  # stale: one of the two has been merged with another neighbour
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (rank := rank_of(new * size + ids[k])) is not None:
                    heappush(queue, rank << bits | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(ids[h] * size + new)) is not None:
                heappush(queue, rank << bits | h)
        return tuple([x for x in ids if x >= 0])

    def _encode_plain(self, text: str) -> Iterator[tuple[int, ...]]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if self.odd is not None and self.odd.search(text):
                text = "".join(self.lower.get(c) or c.replace("Σ", "σ").lower() for c in text)
                return map(self.words.__getitem__, self.careful_split.findall(text))
            text = text.replace("Σ", "σ")  # letters are lower-cased one by one
        return map(self.words.__getitem__, self.split.findall(text.lower()))

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return list(chain.from_iterable(self._encode_plain(text)))
        out, end = [], 0
        for found in self.added_pattern.finditer(text):
            out.extend(chain.from_iterable(self._encode_plain(text[end : found.start()])))
            out.append(self.added[found.group()])
            end = found.end()
        out.extend(chain.from_iterable(self._encode_plain(text[end:])))
        return out

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings one after the other, a blank between; unknown ids are left out."""
        try:
            return " ".join(map(self.strings.__getitem__, ids))
        except KeyError:
            return " ".join(self.strings[x] for x in ids if x in self.strings)


@lru_cache(maxsize=2)
def load(path: str, characters: Characters = Characters()) -> WordBpe:
    return WordBpe(path, characters)


IDS = (T.ArrayType(T.IntegerType(), False), pa.list_(pa.field("element", pa.int32(), False)))
TEXT = (T.StringType(), pa.string())


def _with_columns(df: DataFrame, added: dict[str, tuple[T.DataType, pa.DataType]], make) -> DataFrame:
    """Adds columns in one pass; ``make`` gives a function from a batch to their values, column by column."""
    ship_package(df.sparkSession)
    keep = [c for c in df.columns if c not in added]
    schema = T.StructType([*(f for f in df.schema if f.name in keep), *(T.StructField(c, kind) for c, (kind, _) in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in slices(batches):
            columns = [pa.array(values, arrow) for values, (_, arrow) in zip(each(batch), added.values(), strict=True)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*keep, *added])

    return df.mapInArrow(run, schema)


def _ready(vocabulary: str, characters: Characters) -> WordBpe:
    bpe = load(vocabulary_path(vocabulary), characters)
    bpe.words.take_over()
    return bpe


def encode(df: DataFrame, text: str = "text", out: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds ``out``: token ids of the whole text as an array; replaces a column of that name.

    Null and empty texts give an empty array. Repeated rows are encoded like any other. The
    strings of special tokens in a text become those tokens.
    """

    known = characters(vocabulary_path(vocabulary))

    def make():
        bpe = _ready(vocabulary, known)
        return lambda batch: [[bpe.encode(x) for x in texts_of(batch, text)]]

    return _with_columns(df, {out: IDS}, make)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds ``out``: the text of an array of token ids; null and empty arrays give an empty text."""

    def make():
        bpe = load(vocabulary_path(vocabulary))

        def each(batch: pa.RecordBatch) -> list[list[str]]:
            return [[bpe.decode(x.as_py() or []) for x in batch.column(batch.schema.get_field_index(ids))]]

        return each

    return _with_columns(df, {out: TEXT}, make)


def encode_and_decode(
    df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Adds ``ids`` as ``encode`` and ``decoded`` as ``decode`` do, in one pass with one worker per task."""

    known = characters(vocabulary_path(vocabulary))

    def make():
        bpe = _ready(vocabulary, known)

        def each(batch: pa.RecordBatch) -> list[list]:
            coded = [bpe.encode(x) for x in texts_of(batch, text)]
            return [coded, list(map(bpe.decode, coded))]

        return each

    return _with_columns(df, {ids: IDS, decoded: TEXT}, make)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document its number of tokens and digests of its ids and of the decoded text."""
    coded = encode_and_decode(df.select(F.col(key).alias("key"), F.col(text).alias("text")), vocabulary=vocabulary)
    return coded.select(
        F.col("key").alias(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
