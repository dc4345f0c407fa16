r"""Personal data by candidate gradient boosting, as DataFrame operations only.

Base spans are found by fixed patterns and checks, leftmost first and non-overlapping per kind; a
match that fails its check is dropped as a whole. That loses data that stands beside other
digits: two card numbers in a row, or a telephone number before an address of a computer. So

1. generators propose tight spans of each kind wherever one could begin, also inside what the base
   patterns dropped and in forms these do not know (cards of 14 and 15 digits, telephones without
   +, addresses with "(at)"); they overlap each other and the base spans;
2. each candidate has small whole-number features of its format and of its context. Whether it
   passes the check of its kind is none of them: what fails is never added, and what passes is
   judged by the rest;
3. candidates of all documents are counted by their features, which is one row for each
   combination that occurs, at most ``CELLS``. Base spans are positive. A candidate that fails its
   check stands for ``CHANCE`` numbers that would pass it by accident in that place, as negative;
   so does a telephone without + that no word of telephones precedes, for one;
4. decoys are planted among them (``planted``): positives moved into places that speak against
   them, such as words, identifiers, serial numbers, versions and longer numbers;
5. documents are parted by a hash of the text: boosted trees are fitted on the counts of one part,
   and on the other, by kind, scores are turned into shares of right candidates (isotonic
   regression). The lowest score with a share of ``PRECISION`` is the kind's threshold;
6. candidates at or above it are added, best score first, where no span is yet.

Base spans always stay. Offsets are code points, ends exclusive. Null text is empty and has no
spans; repeated rows are judged alike. Without any positive candidate of a kind, none is added;
where one of the two parts has none of a kind, both serve for fitting or for the threshold. Texts of
any length are read whole, but of the context only ``LEFT`` and ``RIGHT`` code points are judged, so a
longer number is seen as far as these reach. Other columns play no part; ``redact`` keeps them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.scratch import stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, in a form that never goes back over what it has read.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates, by kind.
TIGHT = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|3[0-9]{3}([\x20-]?)[0-9]{6}\2[0-9]{4,5})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){1,3}(?![0-9]|\.[0-9])|(?<![0-9+.()-])(?:\([0-9]{2,4}\)[\x20-]?|0[0-9]{2,4}[\x20/-]|[0-9]{3}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9]|[.-][0-9])",
}
OCTET = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
#: Words that speak for a kind, anywhere in the context before, and words of other numbers right before.
NAMED = {
    "email": r"(?i)(?:mail|contact|write|address)",
    "ip": r"(?i)(?:host|server|address|login|\bip\b)",
    "card": r"(?i)(?:card|visa|credit|master|amex|account|konto|carte|tarjeta|karte|\bpay)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobil|contact|\bruf)",
}
OTHER = r"(?i)(?:version|release|build|serial|order|invoice|isbn|sku|model|part|section|\bref|\bno|\bid|\bv)[\x20:.#=]*$"
#: What goes on before or after a candidate that is part of a longer number, by kind.
LOOSE = {
    "ip": (r"[0-9]\.$", r"^\.[0-9]"),
    "card": (r"(?:^|[^.0-9])[0-9]+[\x20-]?$", r"^[\x20-]?[0-9]++(?!\.[0-9])"),
}
FEATURES = ("kind", "digits", "before", "after", "parts", "plus", "named", "other", "few", "loose")
CELLS = 4 * 24 * 5 * 5 * 4 * 2 * 2 * 2 * 2 * 2 * 3 * 2
#: For each candidate that fails its check, so many pass it by accident: one number in ten passes Luhn's.
CHANCE = {"email": 0.0, "ip": 1 / 20, "card": 1 / 9, "phone": 1 / 4}
#: Decoys of each sort for one positive, telephones planted without +, and positives planted without
#: the word that speaks for them: lists have it before the first only, where the context is cut.
DECOYS, PLAIN, LISTED = 0.05, 0.2, 0.5
PRECISION = 0.8
#: One document in ``PARTS`` sets thresholds and is not fitted.
PARTS = 3
ROUNDS, DEPTH, RATE = 30, 3, 0.4
#: Code points of context read before and after a candidate.
LEFT, RIGHT = 24, 24


def running_sums(values: Column) -> Column:
    """Inclusive sums of an array, by doubling: as many passes as its length has binary digits."""
    steps = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1))

    def double(sums: Column, step: Column) -> Column:
        back = F.pow(F.lit(2), step).cast("int")
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - back), F.lit(0)))

    return F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), values, double)


def with_matches(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """``name``: an array of ``start, stop, text, left, right`` of all matches.

    Matches come from one function and the gaps between them from another; both read a pattern
    the same way, so the lengths of gaps and matches add up to places.
    """
    found, gaps, ends = (f"__{name}_{x}" for x in ("found", "gaps", "ends"))
    df = df.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(F.col(text), pattern)))
    lengths = F.transform(F.col(found), lambda m, i: F.length(m) + F.length(F.get(F.col(gaps), i)))
    df = df.withColumn(ends, F.when(F.size(found) > 0, running_sums(lengths)))

    def span(m: Column, i: Column) -> Column:
        stop = F.get(F.col(ends), i)
        return F.struct(
            (stop - F.length(m)).alias("start"),
            stop.alias("stop"),
            m.alias("text"),
            F.right(F.get(F.col(gaps), i), F.lit(LEFT)).alias("left"),
            F.left(F.get(F.col(gaps), i + 1), F.lit(RIGHT)).alias("right"),
        )

    return df.withColumn(name, F.transform(F.col(found), span)).drop(found, gaps, ends)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: str, text: Column) -> Column:
    """The check of a base match."""
    digits = digits_of(text)
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda x: x.rlike(OCTET))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _tight_passes(kind: str, text: Column) -> Column:
    """The check of a generated candidate: as for a base match, and cards of 14 and 15 digits too."""
    if kind == "card":
        return luhn(digits_of(text))
    return passes(kind, text)


def _side(letter: Column) -> Column:
    """0 blank or nothing, 1 letter, 2 digit, 3 mark of a sentence, 4 any other sign."""
    blank = (letter == "") | letter.rlike(r"^\s$")
    return F.when(blank, 0).when(letter.rlike(r"^\p{L}$"), 1).when(letter.rlike("^[0-9]$"), 2).when(letter.rlike(r"""^[.,;:!?()"'\[\]<>]$"""), 3).otherwise(4)


def _features(kind: str, x: Column) -> dict[str, Column]:
    text, digits = x["text"], digits_of(x["text"])
    values = {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.least(F.length(digits), F.lit(23)),
        "before": _side(F.right(x["left"], F.lit(1))),
        "after": _side(F.left(x["right"], F.lit(1))),
        "parts": F.when(text.rlike(r"[()]"), 3).when(text.rlike(r"\."), 2).when(text.rlike(r"[\x20-]"), 1).otherwise(0),
        "plus": F.startswith(text, F.lit("+")).cast("int"),
        "named": x["left"].rlike(NAMED[kind]).cast("int"),
        "other": x["left"].rlike(OTHER).cast("int"),
        "few": (F.size(F.array_distinct(F.split(digits, ""))) < 4).cast("int"),
    }
    return {name: F.coalesce(value, F.lit(0)).cast("int") for name, value in values.items()}


def _sides(kind: str, x: Column) -> Column:
    """On which sides a longer number goes on: 1 before, 2 after, 3 both."""
    if kind not in LOOSE:
        return F.lit(0)
    before, after = LOOSE[kind]
    return F.coalesce(x["left"].rlike(before).cast("int") + 2 * x["right"].rlike(after).cast("int"), F.lit(0))


def _loose(candidates: str) -> Column:
    """The candidates with ``loose`` 1 where a side is not taken by a candidate of another kind."""

    def one(x: Column) -> Column:
        other = lambda c: (c["kind"] != x["kind"]) & (c["valid"] == 1)
        before = F.exists(candidates, lambda c: other(c) & (c["start"] < x["start"]) & (c["stop"] >= x["start"] - 1))
        after = F.exists(candidates, lambda c: other(c) & (c["stop"] > x["stop"]) & (c["start"] <= x["stop"] + 1))
        free = (x["loose"].bitwiseAND(F.lit(1)).cast("boolean") & ~before) | (x["loose"].bitwiseAND(F.lit(2)).cast("boolean") & ~after)
        return F.when(x["loose"] == 0, x).otherwise(x.withField("loose", free.cast("int")))

    some = F.exists(candidates, lambda c: c["loose"] > 0)
    return F.when(some, F.transform(candidates, one)).otherwise(F.col(candidates))


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``base`` (``kind, start, stop``) and ``candidates`` (those, features, valid, label).

    ``valid`` says whether the check of the kind is passed. ``label`` is 1 for base spans, 0 where
    the check fails, and null where it is open. A candidate that overlaps a base span without being
    one is left out. ``part`` is the document's part, 0 for the one that sets thresholds.
    """
    names = [f"{sort}_{kind}" for sort in ("base", "tight") for kind in KINDS]
    rows = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for name in names:
        sort, kind = name.split("_")
        rows = with_matches(rows, "__text", (BASE if sort == "base" else TIGHT)[kind], f"__{name}")
    place = "struct<kind:int,start:int,stop:int>"

    def where(kind: str):
        return lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")).cast(place)

    def checked(kind: str):
        return lambda x: passes(kind, x["text"])

    for kind in KINDS:
        rows = rows.withColumn(f"__kept_{kind}", F.filter(F.col(f"__base_{kind}"), checked(kind)))
    rows = rows.withColumn("base", F.concat(*[F.transform(F.col(f"__kept_{kind}"), where(kind)) for kind in KINDS]))

    def described(kind: str, labelled, sides=lambda x: F.lit(0)):
        def one(x: Column) -> Column:
            valid = F.coalesce(_tight_passes(kind, x["text"]), F.lit(False)).cast("int")
            features = _features(kind, x) | {"loose": sides(x), "valid": valid}
            named = [value.alias(name) for name, value in features.items() if name != "kind"]
            label = labelled(valid).cast("int").alias("label")
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"], x["stop"], *named, label)

        return one

    def code(x: Column) -> Column:  # a place as one long, which sets of an array are fast on
        return F.shiftleft(x["start"].cast("long"), 32) + x["stop"]

    def apart(n: Column) -> Column:
        start, stop = F.shiftright(n, 32), n.bitwiseAND(F.lit((1 << 32) - 1))
        return ~F.exists("base", lambda b: (b["start"] < stop) & (start < b["stop"]))

    for kind in KINDS:  # most candidates are base spans; only the others are compared one by one
        seen, known = (F.transform(F.col(f"__{sort}_{kind}"), code) for sort in ("tight", "kept"))
        rows = rows.withColumn(f"__new_{kind}", F.filter(F.array_except(seen, known), apart))

    def proposed(kind: str) -> Column:
        def is_new(x: Column) -> Column:
            return F.exists(F.col(f"__new_{kind}"), lambda n: n == code(x))

        good = F.transform(F.col(f"__kept_{kind}"), described(kind, lambda valid: F.lit(1)))
        tight = F.when(F.size(f"__new_{kind}") > 0, F.filter(F.col(f"__tight_{kind}"), is_new))
        rest = F.transform(tight, described(kind, lambda valid: F.when(valid == 0, 0), lambda x: _sides(kind, x)))
        return F.concat(good, F.coalesce(rest, F.slice(good, 1, 0)))

    rows = rows.withColumn("candidates", F.concat(*[proposed(kind) for kind in KINDS]))
    rows = rows.withColumn("candidates", _loose("candidates"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("__text"), F.lit(PARTS)).cast("int"))
    return rows.drop("__text", *[f"__{x}" for x in names], *[f"__{x}_{kind}" for x in ("kept", "new") for kind in KINDS])


@dataclass
class Trees:
    """Boosted regression trees on the log-odds; ``least`` is the threshold of each kind."""

    start: float
    trees: list
    least: list[float]

    def score(self, x: Column) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, at, low, high = node
            return F.when(x[FEATURES[feature]] <= at, value(low)).otherwise(value(high))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + value(tree)
        return total

    def value(self, cell: tuple) -> float:
        def leaf(node) -> float:
            while not isinstance(node, float):
                feature, at, low, high = node
                node = low if cell[feature] <= at else high
            return node

        return self.start + sum(leaf(tree) for tree in self.trees)

    def chosen(self, candidates: str) -> Column:
        """The candidates to add with their scores, best first."""
        open_ = F.filter(candidates, lambda c: F.isnull(c["label"]) & (c["valid"] == 1))
        scored = F.transform(open_, lambda c: F.struct((-self.score(c)).alias("low"), _place(c).alias("at")))
        least = F.array(*[F.lit(v) for v in self.least])
        return F.array_sort(F.filter(scored, lambda c: -c["low"] >= F.get(least, c["at"]["kind"])))


def _place(c: Column) -> Column:
    return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"))


def profile(candidates: DataFrame) -> list[tuple]:
    """Candidates of all rows counted by part, features and label: (part, features, rows, label)."""
    each = candidates.select("part", F.explode("candidates").alias("x")).select("part", "x.*")
    cells = each.groupBy("part", *FEATURES, "label").agg(F.count("*").alias("n"))
    found = [(r["part"], tuple(r[f] for f in FEATURES), r["n"], r["label"]) for r in cells.toLocalIterator()]
    return sorted(found, key=lambda c: (c[0], c[1], -1 if c[3] is None else c[3]))


def _moved(cell: tuple, **values: int) -> tuple:
    return tuple(values.get(name, value) for name, value in zip(FEATURES, cell))


def planted(cells: list[tuple]) -> list[tuple]:
    """What is learned from: (part, features, negatives, positives), planted cases among them."""
    known = []
    for part, cell, n, label in cells:
        kind, at = KINDS[cell[0]], dict(zip(FEATURES, cell))
        if label == 0:
            known.append((part, cell, n * CHANCE[kind], 0.0))
        elif label is None and kind == "phone" and not at["plus"] and not at["named"]:
            known.append((part, cell, float(n), 0.0))
        elif label == 1:
            real = [(cell, float(n))] + [(_moved(cell, named=0), n * LISTED)] * at["named"]
            if kind == "phone":
                real.append((_moved(cell, plus=0, named=1), n * PLAIN))
            for place, weight in real:
                known.append((part, place, 0.0, weight))
                wrong = [_moved(place, before=side, named=0) for side in (1, 2, 4)]
                wrong += [_moved(place, after=side, named=0) for side in (1, 2, 4)]
                wrong += [_moved(place, other=1, named=0)]
                known += [(part, bad, weight * DECOYS, 0.0) for bad in wrong]
                if kind in LOOSE and not at["loose"]:
                    known += [(part, _moved(place, loose=1, named=named), weight * DECOYS, 0.0) for named in (0, 1)]
    return known


def fit(cells: list[tuple]) -> Trees:
    """Newton boosting of shallow trees on one part, thresholds from the other."""
    known = planted(cells)
    fitted, held = ([], [])
    for k in range(len(KINDS)):
        mine = [c for c in known if c[1][0] == k]
        for side, rows in ((fitted, [c for c in mine if c[0]]), (held, [c for c in mine if not c[0]])):
            side += rows if any(c[3] for c in rows) else mine
    if not any(c[3] for c in known):
        return Trees(0.0, [], [math.inf] * len(KINDS))
    x = np.array([c[1] for c in fitted])
    n, y = np.array([c[2] + c[3] for c in fitted]), np.array([c[3] for c in fitted])
    each = np.array([n[x[:, 0] == k].sum() for k in range(len(KINDS))])
    alike = 1000 / np.where(each > 0, each, 1)[x[:, 0]]  # kinds count alike, however rare
    n, y = n * alike, y * alike
    base = (y.sum() + 1) / (n.sum() + 2)
    start = math.log(base / (1 - base))
    score, trees = np.full(len(n), start), []

    def grow(rows: np.ndarray, depth: int):
        p = 1 / (1 + np.exp(-score))
        g, h = np.where(rows, y - n * p, 0), np.where(rows, n * p * (1 - p), 0)
        gain, best = 0.0, None
        for f in range(x.shape[1] if depth else 0):
            for at in np.unique(x[rows, f])[:-1]:
                low = x[:, f] <= at
                a, b = g[low].sum() ** 2 / (h[low].sum() + 1), g[~low].sum() ** 2 / (h[~low].sum() + 1)
                if a + b > gain + 1e-9:
                    gain, best = a + b, (f, int(at), low)
        if best is None or gain <= g.sum() ** 2 / (h.sum() + 1) + 1e-9:
            step = RATE * g.sum() / (h.sum() + 1)
            change[rows] = step
            return float(step)
        f, at, low = best
        return f, at, grow(rows & low, depth - 1), grow(rows & ~low, depth - 1)

    for _ in range(ROUNDS):
        change = np.zeros(len(n))
        trees.append(grow(np.ones(len(n), bool), DEPTH))
        score = score + change
    model = Trees(start, trees, [])
    model.least = [_threshold([(model.value(c[1]), c[2] + c[3], c[3]) for c in held if c[1][0] == k]) for k in range(len(KINDS))]
    return model


def _threshold(cases: list[tuple]) -> float:
    """The lowest score whose share of positives, made to rise with the score, is ``PRECISION``.

    Neighbouring scores are pooled until shares rise (pool adjacent violators).
    """
    sums: dict[float, list[float]] = {}
    for score, n, y in cases:
        total = sums.setdefault(round(score, 9), [0.0, 0.0])
        total[0] += n
        total[1] += y
    pools: list[list[float]] = []
    for score in sorted(sums):
        pools.append([score, *sums[score]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, n, y = pools.pop()
            pools[-1][1] += n
            pools[-1][2] += y
    good = [low for low, n, y in pools if n > 0 and y >= PRECISION * n]
    return min(good) - 1e-6 if good else math.inf


def all_spans(trees: Trees) -> Column:
    """Base spans and the candidates that the trees select, by kind and start."""
    ranked = trees.chosen("candidates")

    def add(kept: Column, c: Column) -> Column:
        at = c["at"]
        taken = F.exists(kept, lambda k: (k["start"] < at["stop"]) & (at["start"] < k["stop"]))
        return F.when(taken, kept).otherwise(F.concat(kept, F.array(at)))

    empty = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    return F.array_sort(F.concat("base", F.aggregate(ranked, empty, add)))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or each group of overlapping spans, replaced by its kind."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("wide"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(state: Column, s: Column) -> Column:
        stop = -s["wide"]
        before = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        more = F.concat(state["parts"], F.array(before, F.get(names, s["kind"])))
        return F.when(
            s["start"] >= state["at"], F.struct(stop.alias("at"), more.alias("parts"))
        ).otherwise(F.struct(F.greatest(state["at"], stop).alias("at"), state["parts"].alias("parts")))

    done = lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(text, s["at"] + 1))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(order, state, cut, done))


def redact(docs: DataFrame) -> DataFrame:
    """The rows with personal data in ``text`` replaced, and ``n_chars`` where there is one."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = with_candidates(rows.withColumn("text", F.col("row.text"))).drop("text")
    found = stored(found, "candidates")  # patterns and features are worked out once, in a plan of their own
    spans = found.withColumn("spans", all_spans(fit(profile(found)))).withColumn("text", F.col("row.text"))
    made = spans.withColumn("text", redacted(F.col("text"), F.col("spans")))
    value = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.when(F.col("row.n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return made.select(*[value[c].alias(c) for c in docs.columns])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``; texts are read once, the candidates are kept in between."""
    found = stored(with_candidates(docs.select("doc_id", "text")).select("doc_id", "base", "candidates", "part"), "candidates")
    return found.select("doc_id", "base", all_spans(fit(profile(found))).alias("spans"))


def op9_personal_data(spark, sf_dir):
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    kinds = F.transform("base", lambda b: b["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    base = F.sha2(written(F.array_sort("base")), 256).alias("base_sha256")
    return found.select("doc_id", *count, base, written(F.col("spans")).alias("spans"))
