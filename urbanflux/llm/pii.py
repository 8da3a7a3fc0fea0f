"""Personal data: strict patterns, and boosted trees over the candidates of looser ones.

Strict matches always count. High-recall generators propose further spans, which overlap: addresses with spelt-out
signs, dotted numbers, and every grouping of neighbouring digit groups in a run of digits that has the size of a card
or phone number. What is known of a candidate (its size and grouping, a check digit, what stands around it) has few
levels, so the corpus shrinks to counts per combination of levels, and gradient boosting fits depth-two trees to these.

Only strict matches are known to be right; all other candidates are unlabelled, not wrong. The trees never see what
makes a match strict (the plus sign, the at sign, brackets), so they learn how candidates like strict ones look and
stand; the share of strict ones among right ones, estimated on a second fold of the documents, turns their probability
into that of being right and sets the threshold per kind. Of chosen candidates that overlap, the best one stays.
Trees and thresholds are plain column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Strict patterns, written so that no text makes them scan a run of characters again and again.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a strict match.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: High-recall generators and the kinds that each proposes; the last one finds runs of digits.
GENERATORS = {
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@| ?[\[(](?:at|AT)[\])] ?)[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]++)*+": ("email",),
    r"(?<![0-9A-Za-z.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3,5}+": ("ip",),
    r"(?<![0-9A-Za-z+(-])[+(]?[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+": ("card", "phone"),
}
#: Digits of a number that a grouping may have, and groups that it may join.
SIZES = {"card": (13, 19), "phone": (7, 15)}
MOST_GROUPS = 8
#: A candidate counts from this probability of being right on.
LEAST_PROBABILITY = 0.5
TREES, RATE = 24, 0.3
#: Levels of each feature; their product bounds the table of counts.
LEVELS = {"digits": 8, "groups": 5, "valid": 2, "words": 5, "before": 3, "after": 3}
CONTEXT = {
    "email": "mail|contact|write|from",
    "ip": "ip|addr|host|server",
    "card": "card|visa|credit|account|pay",
    "phone": "phone|tel|call|fax|mobile",
}
WINDOW = 24

SPAN = "struct<kind:int,start:bigint,end:bigint,text:string>"


def _located(text: Column, pattern: str, matches: Column) -> Column:
    """Start, end and text of all matches: their lengths and those of the pieces between add up."""
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), matches.alias("m"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["0"])
        end = start + F.length(pair["1"])
        found = F.struct(start.alias("start"), end.alias("end"), pair["1"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    pairs = F.transform(pairs, lambda x: F.struct(x["p"].alias("0"), x["m"].alias("1")))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, zero, step, lambda s: s["out"])).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number is right."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((n - i) % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return F.rlike(text, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    n = F.length(_digits(text))
    if kind == "phone":
        return n.between(8, 15)
    return F.when(n.between(16, 19), luhn(_digits(text))).otherwise(False)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span["text"])


def _typed(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), 0)


def _groupings(run: Column) -> Column:
    """Neighbouring digit groups of a run, joined in every way that has the size of a card or phone number.

    Card groups stand one blank or hyphen apart. A phone number takes a plus sign or bracket before it along, and only its
    first group may be a single digit.
    """
    places = F.sequence(F.lit(0), F.length(run["text"]) - 1)

    def bounds(chars: Column) -> Column:
        digit = lambda i: F.get(chars, i).between("0", "9")
        begins = F.filter(places, lambda i: digit(i) & ((i == 0) | ~F.coalesce(digit(i - 1), F.lit(False))))
        ends = F.filter(places, lambda i: digit(i) & ~F.coalesce(digit(i + 1), F.lit(False)))
        return F.arrays_zip(begins.alias("begin"), F.transform(ends, lambda i: i + 1).alias("end"))

    def joined(groups: Column, a: Column, b: Column) -> Column:
        of = F.slice(groups, a + 1, b - a + 1)
        size = F.aggregate(of, F.lit(0), lambda total, g: total + g["end"] - g["begin"])
        start, end = F.get(groups, a)["begin"], F.get(groups, b)["end"]
        before = F.substr(run["text"], start, F.lit(1))  # places count from 1 there
        signed = start - F.when((start > 0) & before.isin("+", "("), 1).otherwise(0)
        spans = []
        for kind, begin in (("card", start), ("phone", signed)):
            inside = F.substr(run["text"], begin + 1, end - begin)
            shape = r"^[0-9]+(?:[\x20-][0-9]+)*$" if kind == "card" else r"^[+(]?[0-9]+(?:[^0-9]+[0-9]{2,})*$"
            found = F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), (run["start"] + begin).alias("start"), (run["start"] + end).alias("end"), inside.alias("text")
            )
            spans.append(F.when(size.between(*SIZES[kind]) & F.rlike(inside, F.lit(shape)), found))
        return F.filter(F.array(*spans), lambda x: x.isNotNull())

    def every(groups: Column) -> Column:
        last = lambda a: F.least(a + MOST_GROUPS, F.size(groups)) - 1
        several = lambda a: F.flatten(F.transform(F.sequence(a, last(a)), lambda b: joined(groups, a, b)))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(groups) - 1), several))

    return _let(F.split(run["text"], ""), lambda chars: _let(bounds(chars), every))


def _with_matches(df: DataFrame) -> DataFrame:
    """Adds strict spans (``pii_base``) and candidates (``pii_loose``) to rows with ``pii_text``."""
    text, none = F.col("pii_text"), F.array().cast("array<string>")
    for i, (kind, pattern) in enumerate(STRICT.items()):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        df = df.withColumn(f"pii_m{i}", F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(none))
    for i, pattern in enumerate(GENERATORS):
        df = df.withColumn(f"pii_g{i}", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    strict = []
    for i, (kind, pattern) in enumerate(STRICT.items()):
        spans = _located(text, pattern, F.col(f"pii_m{i}"))
        strict.append(_typed(kind, F.filter(spans, _is_valid(kind))))
    loose = []
    none = F.array().cast(f"array<{SPAN}>")
    for i, (pattern, kinds) in enumerate(GENERATORS.items()):
        df = df.withColumn(f"pii_l{i}", _located(text, pattern, F.col(f"pii_g{i}")))
        found = F.col(f"pii_l{i}")
        if len(kinds) > 1:
            found = F.when(F.size(found) > 0, F.flatten(F.transform(found, _groupings))).otherwise(none)
        if kinds == ("ip",):  # whose parts exceed a byte is no address, wherever it stands
            found = F.filter(found, _is_valid("ip"))
        loose.append(found if len(kinds) > 1 else _typed(*kinds, found))
    df = df.withColumn("pii_base", F.concat(*strict)).withColumn("pii_loose", F.concat(*loose))
    return df.drop(*(f"pii_{a}{i}" for a in "mgl" for i in range(4)))


def _features(text: Column, span: Column) -> Column:
    """Levels of what is known of a candidate, as a struct named like ``LEVELS``; blind for the signs of strict matches."""
    inside, start, end, kind = span["text"], span["start"], span["end"], span["kind"]
    # a country code in front, with or without its sign, says nothing of the number behind it
    number = F.when(kind == 3, F.regexp_replace(inside, r"^(?:\+[0-9]{1,3}(?![0-9])|[0-9]{1,3}(?= ?\())[ .-]*", "")).otherwise(inside)
    n = F.length(_digits(number))
    size = F.least(start, F.lit(WINDOW).cast("long")).cast("int")
    near = F.lower(F.substr(text, (start + 1).cast("int") - size, size))
    words = F.lit(0)
    for i, k in enumerate(KINDS):
        words = F.when(F.rlike(near, F.lit(rf"\b(?:{CONTEXT[k]})")), i + 1).otherwise(words)
    before = F.substr(near, size, F.lit(1))
    after = F.substr(text, (end + 1).cast("int"), F.lit(1))
    side = lambda c: F.when((c == "") | F.rlike(c, F.lit(r"\s")), 0).when(F.rlike(c, F.lit(r"[\p{L}\p{N}_]")), 2).otherwise(1)
    digits = F.when(n <= 7, 0).when(n <= 9, 1).when(n == 10, 2).when(n == 11, 3).when(n <= 12, 4).when(n <= 15, 5).when(n <= 19, 6).otherwise(7)
    domain = F.rlike(inside, F.lit(r"(?i)(?:@|[\[(]at[\])]).*(?:\.|[\[(]dot[\])])"))
    valid = F.when(kind == 2, luhn(_digits(inside))).otherwise(True)
    return F.struct(
        kind.alias("kind"),
        F.when(kind == 0, domain.cast("int")).otherwise(digits).alias("digits"),
        F.when(kind == 0, 0).otherwise(F.least(F.regexp_count(number, F.lit("[0-9]+")), F.lit(4))).alias("groups"),
        valid.cast("int").alias("valid"),
        words.alias("words"),
        side(before).alias("before"),
        side(after).alias("after"),
    )


@dataclass(frozen=True)
class Model:
    """Per kind its trees, the score it starts from, and the score from which a candidate counts.

    A tree is ``((feature, level), (feature, level, low, high), (feature, level, low, high))``: the
    first split (below level or not) chooses the second, which chooses the value.
    """

    start: tuple[float, ...]
    trees: tuple[tuple, ...]
    threshold: tuple[float, ...]

    def score(self, kind: int, levels: dict[str, int]) -> float:
        total = self.start[kind]
        for (f, cut), left, right in self.trees[kind]:
            g, at, low, high = left if levels[f] < cut else right
            total += low if levels[g] < at else high
        return total

    def margin(self, features: Column) -> Column:
        """By how much the score of a candidate exceeds the threshold of its kind; null where there is none."""

        def leaf(node: tuple) -> Column:
            return F.when(features[node[0]] < node[1], F.lit(node[2])).otherwise(F.lit(node[3]))

        found = F.lit(None).cast("double")
        for kind, trees in enumerate(self.trees):
            if math.isinf(self.threshold[kind]):
                continue
            total = F.lit(self.start[kind] - self.threshold[kind])
            for (f, cut), left, right in trees:
                total = total + F.when(features[f] < cut, leaf(left)).otherwise(leaf(right))
            found = F.when(features["kind"] == kind, total).otherwise(found)
        return found


def _best_split(rows: list[tuple]) -> tuple[float, str, int, float, float]:
    """The split of ``(levels, gradient, hessian)`` rows that gains most, with both leaf values."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (-1.0, next(iter(LEVELS)), 0, g / (h + 1.0), g / (h + 1.0))
    for f, n in LEVELS.items():
        sums = [[0.0, 0.0] for _ in range(n)]
        for levels, gradient, hessian in rows:
            sums[levels[f]][0] += gradient
            sums[levels[f]][1] += hessian
        gl = hl = 0.0
        for cut in range(1, n):
            gl, hl = gl + sums[cut - 1][0], hl + sums[cut - 1][1]
            gr, hr = g - gl, h - hl
            gain = gl * gl / (hl + 1.0) + gr * gr / (hr + 1.0)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut, gl / (hl + 1.0), gr / (hr + 1.0))
    return best


def fit(counts: list[dict], trees: int = TREES, rate: float = RATE, least: float = LEAST_PROBABILITY) -> Model:
    """Boosted trees from counts ``{kind, fold, positive, unlabelled, <levels>}``.

    Fold 1 fits the trees to tell positive from unlabelled candidates. If those that are right are positive with
    probability ``c``, one that is positive with probability ``p`` is right with ``p / c``; fold 0 says ``c``, the mean
    ``p`` of its positive ones. A kind without positive candidates in both folds gets no threshold.
    """
    start, grown, limits = [], [], []
    for kind in range(len(KINDS)):
        own = [r for r in counts if r["kind"] == kind]
        own.sort(key=lambda r: (r["fold"], *(r[f] for f in LEVELS)))
        train = [r for r in own if r["fold"]]
        good, bad = sum(r["positive"] for r in train), sum(r["unlabelled"] for r in train)
        base = math.log((good + 0.5) / (bad + 0.5))
        model = Model((base,) * len(KINDS), tuple(() for _ in KINDS), (math.inf,) * len(KINDS))
        mine: list[tuple] = []
        scores = [base] * len(train)
        for _ in range(trees if good else 0):
            rows = []
            for r, s in zip(train, scores, strict=True):
                p = 1 / (1 + math.exp(-s))
                n = r["positive"] + r["unlabelled"]
                rows.append((r, r["positive"] - n * p, n * p * (1 - p)))
            _, f, cut, *_ = _best_split(rows)
            sides = [[r for r in rows if (r[0][f] < cut) is left] for left in (True, False)]
            leaves = []
            for side in sides:
                _, g, at, low, high = _best_split(side)
                leaves.append((g, at, rate * low, rate * high))
            tree = ((f, cut), *leaves)
            mine.append(tree)
            step = Model((0.0,) * len(KINDS), ((tree,),) * len(KINDS), ())
            scores = [s + step.score(kind, r) for r, s in zip(train, scores, strict=True)]
        model = Model((base,) * len(KINDS), (tuple(mine),) * len(KINDS), ())
        held = [(r["positive"], 1 / (1 + math.exp(-model.score(kind, r)))) for r in own if not r["fold"] and r["positive"]]
        share = sum(n * p for n, p in held) / sum(n for n, _ in held) if held and good else 0.0
        level = least * share
        limit = math.log(level / (1 - level)) if 0 < level < 1 else math.inf
        start.append(base)
        grown.append(tuple(mine))
        limits.append(limit)
    return Model(tuple(start), tuple(grown), tuple(limits))


def _prepared(df: DataFrame, text: str) -> DataFrame:
    return _with_matches(df.withColumn("pii_text", F.coalesce(F.col(text), F.lit(""))))


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def train(df: DataFrame, text: str = "text") -> Model:
    """Fits a model to all rows of ``df``; repeated rows count as often as they stand there.

    Null and empty texts and other columns teach nothing; without strict matches, as in an empty table, the model
    adds no spans. Candidates that overlap a strict match are parts of it and teach nothing either. Only the counts per combination of levels, at most twice their product times the four kinds,
    reach the driver.
    """
    found = _prepared(df.select(F.col(text).alias("text")), "text").where(F.size("pii_loose") > 0)
    fold = (F.crc32(F.col("pii_text").cast("binary")) % 2).cast("int")
    base = F.col("pii_base")

    def labelled(spans: Column, label: int) -> Column:
        return F.transform(spans, lambda s: F.struct(_features(F.col("pii_text"), s).alias("f"), F.lit(label).alias("y")))

    strict = labelled(F.array_intersect("pii_loose", base), 1)
    rest = labelled(F.filter("pii_loose", lambda s: ~F.exists(base, lambda b: _touches(s, b))), 0)
    rows = found.select(fold.alias("fold"), F.explode(F.concat(strict, rest)).alias("x"))
    counts = rows.select("fold", "x.f.*", "x.y").groupBy("fold", "kind", *LEVELS)
    counts = counts.agg(F.sum("y").alias("positive"), F.sum(1 - F.col("y")).alias("unlabelled"))
    return fit([r.asDict() for r in counts.collect()])


def find_personal_data(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``base_spans`` and ``spans``, arrays of ``kind, start, end, text`` in order of kind and start.

    Places count code points from 0, ends are exclusive. ``spans`` holds the strict matches and the
    candidates that reach the model's threshold and touch none of them, nor a better candidate: one further above its threshold,
    then longer, of an earlier kind, further in front. Null counts as the empty text and gives empty arrays, repeated
    rows get equal ones, an empty table stays empty. Columns of these names are replaced; names that start with
    ``pii_`` are reserved.
    """
    found = _prepared(df, text)
    base, source = F.col("pii_base"), F.col("pii_text")
    apart = F.filter("pii_loose", lambda s: ~F.exists(base, lambda b: _touches(s, b)))
    # features are computed once per candidate, not once per mention in a tree, margins not once per comparison
    known = F.transform(apart, lambda s: F.struct(s.alias("s"), _features(source, s).alias("f")))

    def rank(x: Column) -> Column:
        size = x["s"]["end"] - x["s"]["start"]
        return F.struct(model.margin(x["f"]).alias("margin"), size.alias("size"), (-x["s"]["kind"]).alias("kind"), (-x["s"]["start"]).alias("start"))

    ranked = F.transform(known, lambda x: F.struct(rank(x).alias("rank"), x["s"].alias("s")))
    none = F.array().cast("array<struct<rank:struct<margin:double,size:bigint,kind:int,start:bigint>,s:" + SPAN + ">>")
    reached = F.filter(ranked, lambda x: x["rank"]["margin"] >= 0)
    found = found.withColumn("pii_chosen", F.when(F.size("pii_loose") > 0, reached).otherwise(none))
    best = F.filter("pii_chosen", lambda x: ~F.exists("pii_chosen", lambda o: _touches(x["s"], o["s"]) & (o["rank"] > x["rank"])))
    apart = F.transform(best, lambda x: x["s"])
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    shown = lambda spans: F.transform(
        spans, lambda s: F.struct(name(s).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"))
    )
    found = found.withColumns({"base_spans": shown(base), "spans": shown(F.array_sort(F.concat(base, apart)))})
    return found.drop("pii_text", "pii_base", "pii_loose", "pii_chosen")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substr(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        added = F.concat(state["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] < state["at"], state["out"]).otherwise(added).alias("out")
        )

    done = F.aggregate(ordered, zero, step)
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))).otherwise(text)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
