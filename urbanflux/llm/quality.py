"""Quality rules from counts of words and from how well a public vocabulary fits the text.

A tokenizer with byte fallback spells text it was made for with few, varied tokens. Characters per
token, the share of tokens that are single fallback bytes, and the entropy of the tokens are
measured per document; each language, or else script, has a band for every measure, and a document
outside one of them is rejected. Fixed bands are outer limits; inside them, a language's or script's own
documents set narrower ones, by median and quartiles among documents of like numbers of tokens.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.bpe import vocabulary_path
from urbanflux.llm.common import TwoGenerationCache, ship_package, slices, texts_of
from urbanflux.session import materialize

VOCABULARY = "piece_bpe_32k.model"
CACHED_WORDS = 120_000
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 0.3
SYMBOLS = "#*$%&|<>"
#: How far a measure may lie from the median, in standard deviations estimated from the quartiles.
DEVIATIONS = 3.0
#: Documents that a language or script needs, of like size or of all, to set its own band.
LEAST_DOCUMENTS = 100
#: Per measure the steps a unit in which it is counted, its largest value, and the least standard deviation.
RESOLUTION = {"chars_per_token": (500, 16, 0.02), "fallback_share": (1000, 1, 0.01), "token_entropy": (1000, 1, 0.005)}


@dataclass(frozen=True)
class Band:
    """What a document may measure; ``entropy`` is relative to that of all-different tokens."""

    min_chars: float
    max_chars: float
    max_fallback: float
    min_entropy: float


#: By language code.
LANGUAGE_BANDS = {
    "en": Band(1.6, 7.0, 0.05, 0.40),
    "de": Band(1.5, 7.0, 0.08, 0.40),
    "fr": Band(1.4, 7.0, 0.08, 0.40),
    "es": Band(1.4, 7.0, 0.08, 0.40),
}
#: By the script of most letters, where the language is unknown.
SCRIPT_BANDS = {
    "LATIN": Band(1.2, 7.0, 0.15, 0.40),
    "CYRILLIC": Band(1.1, 7.0, 0.15, 0.40),
    "GREEK": Band(0.8, 5.0, 0.40, 0.35),
    "CJK": Band(0.3, 4.0, 0.75, 0.30),
    "": Band(0.25, 8.0, 0.95, 0.25),
}


@dataclass(frozen=True)
class Measures:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    n_tokens: int
    chars_per_token: float
    fallback_share: float
    token_entropy: float
    band: str


@lru_cache(maxsize=4096)
def _script(char: str) -> str:
    return unicodedata.name(char, "").split(" ")[0]


def script_of(text: str) -> str:
    """The script of most letters, as far as it has a band; else the empty text."""
    seen = Counter()
    for char, n in Counter(text).items():
        if char.isalpha():
            name = _script(char)
            seen["CJK" if name in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL") else name] += n
    best = max(seen, key=lambda s: (seen[s], s), default="")
    return best if best in SCRIPT_BANDS else ""


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rows = np.zeros(n, np.uint64)
    for k in range(window):
        rows = (rows ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        rows ^= rows >> np.uint64(29)
    order = np.argsort(rows, kind="stable")
    same = rows[order[1:]] == rows[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(n, bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(found)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


class Judge:
    """Measures of one text after the other; remembers the tokens of frequent words."""

    def __init__(self, vocabulary: str, languages: dict[str, Band], scripts: dict[str, Band]):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.words = TwoGenerationCache(self.tokens_of, CACHED_WORDS)
        self.languages, self.scripts = languages, scripts

    def tokens_of(self, word: bytes) -> tuple[int, ...]:
        return tuple(self.pieces.encode(word.decode(errors="replace")))

    def measure(self, text: str, lang: str | None) -> Measures:
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.strip(" \t\n\r\v\f")]
        n, blanks = len(words), sum(map(text.count, " \t\n\r\v\f"))
        repeated = repeated_words(words)
        failed = n < MIN_WORDS or repeated > MAX_REPEATED * n
        tokens = np.fromiter(chain.from_iterable(map(self.words.__getitem__, words)), np.int32)
        chars = fallback = entropy = 0.0
        if len(tokens):
            counts = np.bincount(tokens)
            shares = counts[counts > 0] / len(tokens)
            chars = (len(text) - blanks) / len(tokens)
            fallback = float(self.is_byte[tokens].mean())
            most = np.log2(min(len(tokens), len(self.is_byte)))
            entropy = float(-(shares * np.log2(shares)).sum() / most) if most else 1.0
        name = lang if lang in self.languages else script_of(text)
        band = self.languages.get(name) or self.scripts.get(name, self.scripts[""])
        fits = band.min_chars <= chars <= band.max_chars and fallback <= band.max_fallback and entropy >= band.min_entropy
        return Measures(
            n, len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            failed, bool(fits and not failed), len(tokens), chars, fallback, entropy, name,
        )


TYPES = {"int": ("long", pa.int64()), "bool": ("boolean", pa.bool_()), "float": ("double", pa.float64()), "str": ("string", pa.string())}


def judge_quality(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    vocabulary: str = VOCABULARY,
    languages: dict[str, Band] | None = None,
    scripts: dict[str, Band] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Adds the fields of ``Measures`` to ``columns``, by default all; columns of these names are replaced.

    ``kept`` documents pass the base rules, the fixed bands, and the bands that all rows of their
    language or script set; fewer than ``LEAST_DOCUMENTS`` set none. Null and empty texts have no words,
    fail the base rules and are not kept. An unknown or null language goes by script. Repeated rows get
    equal results; an empty table stays empty.
    """
    measured = materialize(_measured(df, text, lang, vocabulary, languages, scripts, columns), "measures")
    names, like = measured.columns, _like(F.col("n_tokens"))
    limits = corpus_bands(measured)
    found = measured.withColumn("quality_like", like)
    for kind, rows in (("like", limits.where("quality_like >= 0")), ("all", limits.where("quality_like < 0").drop("quality_like"))):
        rows = rows.select(F.col("band"), *(["quality_like"] if kind == "like" else []), *(F.col(c).alias(f"quality_{kind}_{c}") for c in LIMITS))
        found = found.join(F.broadcast(rows), ["band", "quality_like"] if kind == "like" else ["band"], "left")
    limit = {c: F.coalesce(f"quality_like_{c}", f"quality_all_{c}") for c in LIMITS}
    fits = F.coalesce(F.col("chars_per_token").between(limit["min_chars"], limit["max_chars"]), F.lit(True))
    fits &= F.coalesce(F.col("fallback_share") <= limit["max_fallback"], F.lit(True))
    fits &= F.coalesce(F.col("token_entropy") >= limit["min_entropy"], F.lit(True))
    return found.withColumn("kept", F.col("kept") & fits).select(*names)


LIMITS = ("min_chars", "max_chars", "max_fallback", "min_entropy")


def _like(tokens: Column) -> Column:
    """Documents of like numbers of tokens: those between two powers of two."""
    return F.floor(F.log2(F.greatest(tokens, F.lit(1)).cast("double"))).cast("int")


def corpus_bands(measured: DataFrame) -> DataFrame:
    """``band, quality_like`` and ``LIMITS``, from all rows that pass the base rules.

    Values are counted in steps of ``RESOLUTION``, so the result does not depend on any order. The
    class -1 holds documents of every size, whose entropies are not comparable.
    """
    values = [
        F.struct(F.lit(name).alias("name"), F.round(F.least(F.col(name), F.lit(float(most))) * steps).cast("int").alias("step"))
        for name, (steps, most, _) in RESOLUTION.items()
    ]
    sized = measured.where("NOT base_failed").select("band", F.explode(F.array(F.lit(-1), _like(F.col("n_tokens")))).alias("quality_like"), *RESOLUTION)
    counts = sized.select("band", "quality_like", F.explode(F.array(*values)).alias("x")).groupBy("band", "quality_like", "x.name", "x.step").count()
    group = Window.partitionBy("band", "quality_like", "name")  # holds steps, not documents
    counts = counts.withColumn("below", F.sum("count").over(group.orderBy("step"))).withColumn("n", F.sum("count").over(group))
    at = lambda q: F.min(F.when(F.col("below") >= F.col("n") * q, F.col("step")))
    found = counts.where(F.col("n") >= LEAST_DOCUMENTS).groupBy("band", "quality_like", "name")
    found = found.agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    steps = F.create_map(*(F.lit(x) for name, r in RESOLUTION.items() for x in (name, float(r[0]))))
    least = F.create_map(*(F.lit(x) for name, r in RESOLUTION.items() for x in (name, r[2])))
    reach = DEVIATIONS * F.greatest((F.col("q3") - F.col("q1")) / 1.349 / steps[F.col("name")], least[F.col("name")])
    middle = F.col("q2") / steps[F.col("name")]
    found = found.select("band", "quality_like", "name", (middle - reach).alias("low"), (middle + reach).alias("high"))
    of = lambda name, side: F.max(F.when(F.col("name") == name, F.col(side)))
    return found.groupBy("band", "quality_like").agg(
        of("chars_per_token", "low").alias("min_chars"),
        of("chars_per_token", "high").alias("max_chars"),
        of("fallback_share", "high").alias("max_fallback"),
        F.when(F.col("quality_like") >= 0, of("token_entropy", "low")).alias("min_entropy"),
    )


def _measured(df: DataFrame, text: str, lang: str, vocabulary: str, languages, scripts, columns) -> DataFrame:
    """All of ``Measures``, ``kept`` by the fixed bands alone."""
    ship_package(df.sparkSession)
    names = [f.name for f in fields(Measures)]
    keep = [c for c in (df.columns if columns is None else columns) if c not in names]
    kinds = [TYPES[f.type] for f in fields(Measures)]
    schema = df.select(*keep).schema
    for name, (kind, _) in zip(names, kinds, strict=True):
        schema = schema.add(name, kind)
    languages, scripts = languages or LANGUAGE_BANDS, scripts or SCRIPT_BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(vocabulary_path(vocabulary), tuple(languages.items()), tuple(scripts.items()))
        judge.words.take_over()
        for batch in slices(batches):
            langs = batch.column(batch.schema.get_field_index(lang)).to_pylist()
            found = [judge.measure(x, a) for x, a in zip(texts_of(batch, text), langs, strict=True)]
            added = [pa.array([getattr(m, c) for m in found], kind) for c, (_, kind) in zip(names, kinds, strict=True)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*keep, *names])

    return df.mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _judge(vocabulary: str, languages: tuple, scripts: tuple) -> Judge:
    return Judge(vocabulary, dict(languages), dict(scripts))
