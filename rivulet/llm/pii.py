"""Personal data by candidate gradient boosting, in DataFrame expressions.

Strict patterns with checks (digit sums, number ranges, digit counts) give the base spans, which always stay. Looser
patterns propose more, overlapping spans of four kinds. Each candidate becomes format features (digits, groups, marks,
checks that it passes) and context features (characters beside it, a cue word before it). Boosted trees of depth
two, one ensemble per kind, score it; a logistic fit on templates held out from boosting calibrates the score, and
the kind's threshold is the lowest calibrated score at which held-out precision reaches `PRECISION`.

The trees are fitted on the driver on a few hundred rows that a rule writes (`templates`), whose features the same
expressions compute; there are no labelled spans in the tables. Scoring is a CASE expression over a document's
own array of candidates: no shuffle, no user functions. A place in a text is found from the lengths of what a pattern
matches and of what lies between, by running sums in chunks; spans within base spans are found along the sorted order of
both; what lies beside a candidate, and what stays between redacted spans, is read from pieces of the text. Patterns are possessive and
start only where a run starts. So time is linear in a text's length and in its number of spans.

Defined results
- null text: as empty, no spans. Repeated rows, equal and null ids: each row is read alone.
- a whole text of any length is read. Spans count code points, the end is exclusive.
- empty table: empty result. `find` reads the id and the text alone; `redact` keeps docs' own columns.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Values in a chunk of a running sum; code points in a piece of a text.
CHUNK, PIECE = 128, 1024

_LOCAL = "[A-Za-z0-9._%+-]"
#: Base patterns: what a plain leftmost search for the pattern in the comment finds.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Text that has to occur for a kind's patterns to be tried: a necessary condition of every base span and loose pattern.
NEEDED = {
    "email": r"@|[(\[](?:at|AT)[)\]]",
    "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]|::[0-9A-Fa-f]",
    "card": r"[0-9][\x20.-]{0,2}[0-9][\x20.-]{0,2}[0-9][\x20.-]{0,2}[0-9]",
    "phone": r"\+[0-9]|(?<![0-9])00[1-9]|[0-9]{3}[\x20).-]{1,2}[0-9]{3}",
}
_HEX = "[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"
#: Looser patterns of each kind.
LOOSE = {
    "email": [
        r"(?<![^\x20\x09-\x0D<>(),;:\"])[^\x20\x09-\x0D<>(),;:\"@]++@[^\x20\x09-\x0D<>(),;:\"@.]++(?:\.[^\x20\x09-\x0D<>(),;:\"@.]++)++",
        rf"(?<!{_LOCAL}){_LOCAL}++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
    ],
    "ip": [
        r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
        # with '::', for one group at least; both sides have seven at most together
        rf"(?<![0-9A-Za-z:.])(?![0-9A-Fa-f]{{1,4}}:(?:[0-9A-Fa-f]{{0,4}}:){{7}}[0-9A-Fa-f])(?:{_HEX}::(?:{_HEX})?|::{_HEX})(?![0-9A-Za-z:]|\.[0-9])",
        r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",
    ],
    "card": [r"(?<![0-9])[0-9]{4}(?:[\x20.-]{0,2}[0-9]{4}){2}[\x20.-]{0,2}[0-9]{1,7}+(?![0-9])", r"(?<![0-9])3[0-9]{3}[\x20.-]{0,2}[0-9]{6}[\x20.-]{0,2}[0-9]{5}(?![0-9])"],
    "phone": [r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"(?<![0-9])00[1-9][0-9]{0,2}(?:[\x20.()-]{1,2}[0-9]{2,5}){2,5}(?![0-9])"],
}
CUES = {
    "email": r"(?i)(?:mail|contact|write|reach|send)[^A-Za-z0-9]{0,12}(?:to|at|is|me)?[^A-Za-z0-9]{0,4}$",
    "ip": r"(?i)(?:\bip|host|server|address|from|ping)[^A-Za-z0-9]{0,12}(?:is|at)?[^A-Za-z0-9]{0,4}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|payment|pan)[^0-9]{0,16}$",
    "phone": r"(?i)(?:tel|phone|call|mobile|fax|cell|dial)[^0-9]{0,12}$",
}
#: Words before a number that say it is something else.
DENIALS = r"(?i)(?:version|\bv|order|invoice|serial|build|section|chapter|isbn|sku|ref|id)[^0-9A-Za-z]{0,6}$"


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def one(i: Column) -> Column:
        x = F.substring(digits, n - i + F.lit(1), F.lit(1)).cast("int")
        return F.when(i % 2 == 1, x).otherwise(x * 2 - F.when(x > 4, F.lit(9)).otherwise(F.lit(0)))

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one), F.lit(0), lambda a, b: a + b)
    return (n > 0) & (total % 10 == 0)


def _octets(text: Column) -> Column:
    """All parts between dots are at most 255, however many zeros lead."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return _octets(m)
    if kind == "card":
        return (n >= 13) & (n <= 19) & F.when((n >= 13) & (n <= 19), _luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: what a lambda refers to is computed anew for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """array<int> of values (not below 0) merged up to each place, by sum or maximum. Arrays grow within chunks of `CHUNK` values
    and along the chunks alone, so that time is linear for any number a text can have."""

    def along(v: Column) -> Column:
        start = F.struct(F.lit(0).alias("last"), F.array().cast("array<int>").alias("all"))
        step = lambda acc, x: F.struct(merge(acc["last"], x).alias("last"), F.array_append(acc["all"], merge(acc["last"], x)).alias("all"))
        return F.aggregate(v, start, step, lambda acc: acc["all"])

    def chunked(v: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int")), lambda i: along(F.slice(v, i * CHUNK + F.lit(1), F.lit(CHUNK))))
        return _let(many, lambda w: F.flatten(F.zip_with(w, _shifted(along(F.transform(w, lambda c: F.element_at(c, -1)))), lambda c, before: F.transform(c, lambda x: merge(before, x)))))

    return _let(values, lambda v: F.when(F.size(v) > CHUNK, chunked(v)).otherwise(along(v)))


def _shifted(running: Column) -> Column:
    """Running values before each place: 0 first, the last one gone."""
    return _let(running, lambda r: F.concat(F.array(F.lit(0)), F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0)))))


def _places(text: Column, pattern: str) -> Column:
    """array<struct<s,e,m>> of a pattern's matches: start, end, match."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(pairs: Column) -> Column:
        ends = _running(F.transform(pairs, lambda x: F.length(x["g"]) + F.length(x["m"])), lambda a, b: a + b)
        return F.zip_with(pairs, ends, lambda x, e: F.struct((e - F.length(x["m"])).alias("s"), e.alias("e"), x["m"].alias("m")))

    # what follows the last match has no match of its own
    pairs = F.filter(F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), lambda x: x["m"].isNotNull())
    return _let(pairs, placed)


def _distinct(places: Column) -> Column:
    """Places in order, each once."""
    return _let(F.sort_array(places), lambda v: F.filter(v, lambda x, i: (i == 0) | (F.get(v, i - 1) != x)))


def _outside(places: Column, base: Column) -> Column:
    """The places that no span of base contains: of all base spans that start no later, the furthest end falls short."""
    ofbase = F.transform(base, lambda b: F.struct(b["s"].alias("s"), F.lit(0).alias("c"), b["e"].alias("e"), F.lit(None).cast("string").alias("m")))

    def own(p: Column) -> Column:
        return F.transform(p, lambda c: F.struct(c["s"].alias("s"), F.lit(1).alias("c"), c["e"].alias("e"), c["m"].alias("m")))

    def judged(both: Column) -> Column:
        reach = _running(F.transform(both, lambda x: F.when(x["c"] == 0, x["e"]).otherwise(F.lit(0))), lambda a, b: F.greatest(a, b))
        left = F.filter(F.zip_with(both, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), lambda y: (y["x"]["c"] == 1) & (y["r"] < y["x"]["e"]))
        return F.transform(left, lambda y: F.struct(y["x"]["s"].alias("s"), y["x"]["e"].alias("e"), y["x"]["m"].alias("m")))

    return _let(places, lambda p: F.when((F.size(p) > 0) & (F.size(base) > 0), _let(F.sort_array(F.concat(ofbase, own(p))), judged)).otherwise(p))


def _pieces(text: Column) -> Column:
    """The text in pieces of `PIECE` code points, so that a place is reached without a walk from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from start to end (exclusive), read from the pieces it lies in; '' where it is empty."""
    first = F.floor(start / PIECE).cast("int")
    part = F.slice(pieces, first + F.lit(1), F.floor(end / PIECE).cast("int") - first + F.lit(1))
    return F.when(end > start, F.substring(F.array_join(part, ""), start % PIECE + F.lit(1), end - start)).otherwise(F.lit(""))


def _none() -> Column:
    return F.array().cast("array<struct<s:int,e:int,m:string>>")


#: Features of a candidate, all integers.
FEATURES = ("digits", "groups", "marks", "plus", "paren", "luhn", "octets", "sized", "word_before", "word_after", "cue", "denial", "ascii", "top", "same")


def _features(kind: str, pieces: Column, c: Column) -> Column:
    m = c["m"]
    before = _between(pieces, F.greatest(c["s"] - F.lit(32), F.lit(0)), c["s"])
    after = _between(pieces, c["e"], c["e"] + F.lit(1))
    d = _digits(m)
    n = F.length(d)
    flag = lambda x: x.cast("int")
    return F.struct(
        n.alias("digits"),
        F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))).alias("groups"),
        _count(m, r"[\x20.-]").alias("marks"),
        flag(F.substring(m, 1, 1) == "+").alias("plus"),
        flag(m.contains("(")).alias("paren"),
        flag(F.when((n >= 13) & (n <= 19), _luhn(d)).otherwise(F.lit(False))).alias("luhn"),
        flag(F.when(m.rlike(r"^[0-9]+(\.[0-9]+){3}$"), _octets(m)).otherwise(m.contains(":"))).alias("octets"),
        flag((n >= 9) & (n <= 15)).alias("sized"),
        flag(before.rlike(r"[\p{L}\p{N}_]$")).alias("word_before"),
        flag(after.rlike(r"^[\p{L}\p{N}_]")).alias("word_after"),
        flag(before.rlike(CUES[kind])).alias("cue"),
        flag(before.rlike(DENIALS)).alias("denial"),
        flag(~m.rlike(r"[^\x21-\x7E\x20]")).alias("ascii"),
        flag(m.rlike(r"[A-Za-z]{2,}$")).alias("top"),
        flag(d.rlike(r"^([0-9])\1*$")).alias("same"),
    )


@dataclass
class Ensemble:
    """Trees of depth two: (feature, cut, left, right), left and right (feature, cut, low, high); and a calibration."""

    start: float
    trees: list[tuple]
    slope: float
    offset: float
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, cut, left, right in self.trees:
            for side, at in ((left, x[:, f] <= cut), (right, x[:, f] > cut)):
                g, edge, low, high = side
                out[at] += np.where(x[at, g] <= edge, low, high)
        return out

    def column(self, c: Column) -> Column:
        """Calibrated probability of a candidate's features."""
        leaf = lambda t: F.when(c[FEATURES[t[0]]] <= t[1], F.lit(t[2])).otherwise(F.lit(t[3]))
        trees = [F.when(c[FEATURES[f]] <= cut, leaf(left)).otherwise(leaf(right)) for f, cut, left, right in self.trees]
        raw = reduce(lambda a, b: a + b, trees, F.lit(self.start))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(raw * self.slope + self.offset)))


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, float]:
    """Gain, feature and cut of the best split of gradients g with curvatures h."""
    best = (-1.0, 0, 0.0)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            at = x[:, f] <= cut
            gain = g[at].sum() ** 2 / (h[at].sum() + 1) + g[~at].sum() ** 2 / (h[~at].sum() + 1)
            if gain > best[0] + 1e-12:
                best = (float(gain), f, float(cut))
    return best


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = 24, rate: float = 0.4) -> Ensemble:
    """Newton boosting on two rows of three; the third is held out for calibration and threshold."""
    out = np.arange(len(y)) % 3 == 2
    share = (y[~out].sum() + 1) / ((~out).sum() + 2)
    model = Ensemble(float(np.log(share / (1 - share))), [], 1.0, 0.0, 0.5)
    f, a, b = np.full((~out).sum(), model.start), x[~out], y[~out]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = b - p, p * (1 - p)
        _, top, cut = _split(a, g, h)
        sides = []
        for at in (a[:, top] <= cut, a[:, top] > cut):
            _, k, edge = _split(a[at], g[at], h[at])
            leaves = [rate * float(g[at][s].sum() / (h[at][s].sum() + 1)) for s in (a[at][:, k] <= edge, a[at][:, k] > edge)]
            sides.append((k, edge, *leaves))
        model.trees.append((top, cut, *sides))
        f = model.raw(a)
    z, t = model.raw(x[out]), y[out]
    slope, offset = 1.0, 0.0
    for _ in range(200):  # Platt's fit, lightly held to slope 1
        p = 1 / (1 + np.exp(-(slope * z + offset)))
        slope += 0.02 * (float(((t - p) * z).mean()) - 0.05 * (slope - 1))
        offset += 0.1 * float((t - p).mean())
    model.slope, model.offset = max(slope, 0.1), offset
    p = 1 / (1 + np.exp(-(model.slope * z + model.offset)))
    cuts = [c for c in np.unique(p) if t[p >= c].mean() >= PRECISION]
    model.threshold = max(0.5, float(min(cuts)) - 1e-9) if cuts else 1.0
    return model


def _checked(rng: random.Random, n: int, good: bool, lead: str = "4") -> str:
    """n digits whose Luhn sum is right or wrong."""
    d = [int(c) for c in lead] + [rng.randrange(10) for _ in range(n - len(lead) - 1)]
    total = sum(x if i % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
    last = -total % 10
    return "".join(map(str, d)) + str(last if good else (last + rng.randrange(1, 10)) % 10)


def templates(n: int = 90, seed: int = 2) -> list[tuple[str, str, int]]:
    """(kind, text, label): texts with one place a loose pattern proposes, written by rule."""
    rng, short = random.Random(seed), random.Random(seed + 1)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.randrange(3, 9)))
    num = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    hexed = lambda k: ":".join(f"{short.randrange(1, 65536):x}" for _ in range(k))
    rows = []
    for i in range(n):
        a, b, tail = word(), word(), rng.choice([".", "", " " + word(), ", " + word()])
        say = lambda cues: f"{a} {rng.choice(cues)} " if rng.random() < 0.5 else f"{a} {b} "
        mail, phone, card, host = say(["e-mail:", "contact", "write to"]), say(["call", "tel.", "phone:"]), say(["card", "visa", "credit card:"]), say(["host", "ip", "from"])
        number = say(["order", "invoice", "serial", "ref", "id"])
        rows += [
            ("email", f"{mail}{word()}é.{word()}@{word()}.example.com{tail}", 1),
            ("email", f"{mail}{word()} (at) {word()} (dot) com{tail}", 1),
            ("email", f"{mail}{word()}[at]{word()}.org{tail}", 1),
            ("email", f"{a} {word()}=@{word()}.{num(2)}{tail}", 0),
            ("email", f"{a} «{num(2)}@{num(1)}.{num(2)}»{tail}", 0),
            ("email", f"{a} {num(2)} [at] {num(2)}.{num(2)}{tail}", 0),
            ("ip", f"{host}{':'.join(f'{rng.randrange(4096, 65536):x}' for _ in range(8))}{tail}", 1),
            ("ip", f"{host}{short.choice(['2001:db8', 'fe80', hexed(short.randrange(1, 4))])}::{short.choice(['1', hexed(short.randrange(1, 4))])}{tail}", 1),
            ("ip", f"{a} {''.join(short.choices('abcdef', k=short.randrange(1, 5)))}::{''.join(short.choices('abcdef', k=short.randrange(1, 5)))}{tail}", 0),
            ("ip", f"{host}{'.'.join(str(rng.randrange(1, 256)) for _ in range(4))}{tail}", 1),
            ("ip", f"{a} version {rng.randrange(9)}.{rng.randrange(9)}.{rng.randrange(300, 999)}.{rng.randrange(9)}{tail}", 0),
            ("ip", f"{number}{rng.randrange(256, 999)}.{num(3)}.{num(3)}.{num(3)}{tail}", 0),
            ("card", f"{card}{'.'.join(x[k : k + 4] for k in range(0, 16, 4))}{tail}" if (x := _checked(rng, 16, True)) else "", 1),
            ("card", f"{card}{'  '.join(x[k : k + 4] for k in range(0, 16, 4))}{tail}" if (x := _checked(rng, 16, True, "5")) else "", 1),
            ("card", f"{number}{_checked(rng, 16, False, num(1))}{tail}", 0),
            ("card", f"{a} {_checked(rng, rng.randrange(13, 20), False, num(1))}{tail}", 0),
            ("card", f"{card}{num(4)} {num(4)} {num(4)} {num(2)}{tail}", 0),
            ("phone", f"{phone}({rng.randrange(200, 999)}) {num(3)}-{num(4)}{tail}", 1),
            ("phone", f"{phone}{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{num(4)}{tail}", 1),
            ("phone", f"{phone}00{rng.randrange(20, 99)} {num(3)} {num(3)} {num(4)}{tail}", 1),
            ("phone", f"{number}{num(3)}.{num(3)}.{num(4)}{tail}", 0),
            ("phone", f"{number}00{rng.randrange(1, 9)}-{num(2)}-{num(2)}{tail}", 0),
            ("phone", f"{a}{num(3)} {num(3)} {num(4)}{word()}", 0),
        ]
    return rows


def _candidates(kind: str, text: Column) -> Column:
    found = [_places(text, p) for p in LOOSE[kind]]
    return _distinct(F.concat(*found))


_fitted: dict[str, Ensemble] = {}


def ensembles(spark: SparkSession) -> dict[str, Ensemble]:
    """The fitted ensembles; once per driver process."""
    if not _fitted:
        _fitted.update(_fit(spark))
    return _fitted


def _fit(spark: SparkSession) -> dict[str, Ensemble]:
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(templates())], "i long, kind string, text string, label int")
    rows = rows.coalesce(1)
    out = {}
    for kind in KINDS:
        x = rows.where(F.col("kind") == kind).select("i", "text", "label", F.explode(_candidates(kind, F.col("text"))).alias("c"))
        found = x.select("i", "label", _features(kind, _pieces(F.col("text")), F.col("c")).alias("f")).orderBy("i").collect()
        order = np.random.default_rng(3).permutation(len(found))
        out[kind] = boosted(np.array([tuple(found[k]["f"]) for k in order], np.float64), np.array([found[k]["label"] for k in order], np.float64))
    return out


def with_spans(df: DataFrame, text: str, models: dict[str, Ensemble] | None = None) -> DataFrame:
    """Adds _base and _spans to df: arrays of struct<k,s,e>, by kind and start. text: name of a column without nulls."""
    models = models or ensembles(df.sparkSession)
    t = F.col(text)
    names = df.columns
    df = df.select("*", *(F.when(t.rlike(NEEDED[k]), F.filter(_places(t, BASE[k]), functools.partial(_passes, k))).otherwise(_none()).alias(f"_b{i}") for i, k in enumerate(KINDS)))
    base = [F.transform(F.col(f"_b{i}"), functools.partial(_kinded, i)) for i in range(len(KINDS))]
    df = df.withColumn("_base", F.concat(*base))

    def added(i: int, kind: str) -> Column:
        def judged(outside: Column) -> Column:
            scored = _let(_pieces(t), lambda p: F.transform(outside, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _features(kind, p, c).alias("f"))))
            taken = F.filter(scored, lambda c: models[kind].column(c["f"]) >= models[kind].threshold)
            return F.when(F.size(outside) > 0, F.transform(taken, functools.partial(_kinded, i))).otherwise(F.array().cast("array<struct<k:int,s:int,e:int>>"))

        taken = _let(_outside(_candidates(kind, t), F.col("_base")), judged)
        return F.when(t.rlike(NEEDED[kind]), taken).otherwise(F.array().cast("array<struct<k:int,s:int,e:int>>"))

    df = df.select(*names, "_base", *(added(i, k).alias(f"_a{i}") for i, k in enumerate(KINDS)))
    spans = F.sort_array(F.concat("_base", *(f"_a{i}" for i in range(len(KINDS)))))
    return df.select(*names, "_base", spans.alias("_spans"))


def _passes(kind: str, c: Column) -> Column:
    return _valid(kind, c["m"])


def _kinded(i: int, c: Column) -> Column:
    return F.struct(F.lit(i).alias("k"), c["s"].alias("s"), c["e"].alias("e"))


def told(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all, as text), n_added."""
    df = with_spans(docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text")), "text")
    counts = [F.size(F.filter("_base", functools.partial(_of, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return df.select("doc_id", *counts, F.sha2(told(F.col("_base")), 256).alias("base_sha256"), told(F.col("_spans")).alias("spans"), (F.size("_spans") - F.size("_base")).cast("long").alias("n_added"))


def _of(i: int, x: Column) -> Column:
    return x["k"] == i


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in brackets; spans that overlap become one, of the first one's kind."""
    name = lambda k: F.element_at(F.array(*(F.lit(f"[{x.upper()}]") for x in KINDS)), k + 1)
    order = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def parts(pieces: Column, v: Column, reach: Column) -> Column:
        """What is written for each span, if it starts no earlier than all before it end, and what follows the last."""
        each = F.zip_with(v, _shifted(reach), lambda x, at: F.when(x["s"] >= at, F.concat(_between(pieces, at, x["s"]), name(x["k"]))).otherwise(F.lit("")))
        return F.array_append(each, _between(pieces, F.element_at(reach, -1), F.length(text)))

    ends = lambda v: _running(F.transform(v, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    written = _let(_pieces(text), lambda p: _let(order, lambda v: _let(ends(v), lambda r: F.array_join(parts(p, v, r), ""))))
    return F.when(F.size(spans) > 0, written).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with the text's spans redacted and its length, where docs have that column, as it now is. A null text stays."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), whole_text(docs[text_col]).alias("text"))
    rows = with_spans(rows, "text").withColumn("text", redacted(F.col("text"), F.col("_spans")))
    old = F.col(f"row.`{text_col}`")
    new = {text_col: F.when(old.isNotNull(), F.col("text")).alias(text_col)}
    if length_col in docs.columns:
        new[length_col] = F.when(old.isNotNull(), F.length("text")).otherwise(F.col(f"row.`{length_col}`")).cast(docs.schema[length_col].dataType).alias(length_col)
    return rows.select(*(new.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns))
