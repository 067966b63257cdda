"""Personal data: candidate spans, boosted trees on format and context, calibrated thresholds.

Two kinds of generators propose spans. Strict ones (``BASE``) are checked by rule and always
kept. Loose ones (``LOOSE``) propose whatever looks a little like an address or a number;
their spans may overlap the strict ones. A written-out address that is one by the strict
rule once its words are signs again is added at once, whatever the trees say, if it shows
that it means an address (``_written``). All other loose spans are described by a few discrete
features of their form and of the text beside them, the rule's own evidence left out. Trees
are boosted to tell which of them a strict rule confirms, on the counts of each combination
of features over all the text: a table whose size is bound by the features' values. Those
that no rule confirms, but that score above the threshold at which enough of the candidates
of their kind are confirmed, are added. A kind with fewer than ``SUPPORT`` held-out candidates
above any cut has no threshold: of it nothing is added by score.

Everything that touches rows is built-in functions; patterns run in time linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_AT = "[A-Za-z0-9._%+-]"
#: Strict generators and what a text must have for them to be tried. Where a kind's given
#: pattern could try every start within a run, or recurse once per digit, an equal one is
#: used that can't: a match begins where its run does or where the last one ended, and runs
#: of too few or too many digits, which the rule would drop, are passed over.
BASE = {
    "email": (rf"(?:\G|(?<!{_AT})){_AT}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
        "[0-9][0-9 -]{14}",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Loose generators: a written-out or spaced address, and any grouped number.
LOOSE = {
    "loose_email": (
        rf"(?<!{_AT}){_AT}++(?: ?[\[(]at[\])] ?| at | ?@ ?)[A-Za-z0-9-]++"
        r"(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]++){1,4}",
        r"@|[\[(]at[\])]| at ",  # each match has one of these
    ),
    "loose_number": (
        r"(?<![0-9])(?<![0-9][ .-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![ .-]?[0-9])",
        r"[0-9][\x20().-]{0,2}[0-9][\x20().-]{0,2}[0-9]",
    ),
}
#: Words before a span that announce it.
CUES = (
    r"(?i)(?:tel|phone|fon|mobil|cell|call|fax|mail|contact|kontakt|correo|courriel|card|karte|carte|tarjeta"
    r"|visa|\bip\b|host|server|address|adresse)\w{0,6}\W{0,3}$"
)
BEFORE, AFTER = 24, 8
#: Features of a loose span; ``digits`` is a number, the others are names.
FEATURES = ("kind", "digits", "form", "separator", "bracket", "cue", "glued")
ROUNDS, RATE = 30, 0.3
#: Share of the candidates above a threshold that a strict rule must confirm, and their number.
CONFIRMED, SUPPORT = 0.9, 50


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a number of 2 digits or more is right."""
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    return (
        F.aggregate(
            F.sequence(F.lit(1), F.length(digits)), F.lit(0),
            lambda total, i: total + F.when(i % 2 == 1, F.substr(digits, -i, F.lit(1)).cast("int"))
            .otherwise(doubled(F.substr(digits, -i, F.lit(1)).cast("int"))),
        ) % 10 == 0
    )


def _holds(kind: Column, text: Column) -> Column:
    """Whether a strict match passes the rule of its kind."""
    n = F.length(_digits(text))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", text.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
        .when(kind == "card", n.between(16, 19) & F.when(n >= 2, _luhn(_digits(text))).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
    )


def _candidates(df: DataFrame, id_col: str, text_col: str, generators: dict) -> DataFrame:
    """(row, id, gen, ord, gap, text, before, after): all matches of each generator, in order.

    ``gap`` counts the characters since the generator's last match. A row without any match
    comes once, with nulls.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select(
        "row", "id", "text",
        *[F.when(F.col("text").rlike(quick), F.regexp_extract_all("text", F.lit(pattern), 0)).alias(gen)
          for gen, (pattern, quick) in generators.items()],
    )
    rows = rows.select(
        "row", "id", *generators,
        *[F.when(F.size(gen) > 0, F.split("text", pattern, -1)).alias(f"gaps_{gen}")
          for gen, (pattern, _) in generators.items()],
    )

    def found(gen: str) -> Column:
        gaps = F.col(f"gaps_{gen}")
        each = F.transform(
            F.col(gen),
            lambda m, i: F.struct(
                F.lit(gen).alias("gen"), i.alias("ord"), F.char_length(F.get(gaps, i)).alias("gap"), m.alias("text"),
                F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"),
            ),
        )
        return F.coalesce(F.when(F.size(gen) > 0, each), F.slice(each, 1, 0), F.array().cast(_FOUND))

    return rows.select("row", "id", F.explode_outer(F.concat(*[found(gen) for gen in generators])).alias("c")).select(
        "row", "id", "c.*"
    )


_FOUND = "array<struct<gen:string,ord:int,gap:int,text:string,before:string,after:string>>"


#: What stands for '@' and '.' in a loose address.
_WRITTEN_AT, _WRITTEN_DOT = r" ?[\[(]at[\])] ?| at | ?@ ?", r" ?[\[(]dot[\])] ?| dot "


def _written(text: Column, before: Column) -> Column:
    """Whether a loose address is a strict one once its words are signs again.

    'look at example.org' has the same form, so that ' at ' alone is not enough: a bracket, a
    written dot or a label before the span (as in 'mail: ') must show that an address is meant.
    The last part must be letters, as 'open at 10.30' is none.
    """
    plain = F.regexp_replace(F.regexp_replace(text, _WRITTEN_AT, "@"), _WRITTEN_DOT, ".")
    meant = text.rlike(rf"@|[\[(]|{_WRITTEN_DOT}") | before.rlike(r"(?i)(?:mail|contact|kontakt|correo|courriel|address|adresse)\w{0,6}\s?[:=]\s?$")
    return meant & plain.rlike(rf"^{_AT}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){{0,3}}\.[A-Za-z]{{2,}}$")


def _described(spans: DataFrame) -> DataFrame:
    """Loose spans with their features, and whether a strict rule confirms them (``y``)."""
    text, before, after = F.col("text"), F.col("before"), F.col("after")
    is_email = F.col("gen") == "loose_email"
    n = F.least(F.length(_digits(text)), F.lit(20))
    form = (
        F.when(is_email, F.when(text.contains("@"), "at").otherwise("words"))
        .when(text.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), "quad")
        .when(text.rlike(r"^[0-9]+$"), "plain")
        .when(text.rlike(r"(?:^|[^0-9])[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}$"), "3-3-4")
        .when(text.rlike(r"^[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}$"), "4-4-4-4")
        .otherwise("other")
    )
    described = spans.withColumns({"form": form, "digits": F.when(is_email, 0).otherwise(n)}).withColumns(
        {
            "kind": F.when(is_email, "email").when(F.col("form") == "quad", "ip").when(F.col("digits") >= 13, "card").otherwise("phone"),
            "separator": F.when(text.rlike(r"^[^ .()-]*$"), "none").when(text.contains(" "), "space").when(text.contains("-"), "hyphen").otherwise("dot"),
            "bracket": F.when(text.rlike(r"[(\[]"), "yes").otherwise("no"),
            "cue": F.when(before.rlike(CUES), "yes").otherwise("no"),
            "glued": F.when(before.rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]"), "yes").otherwise("no"),
        }
    )
    strict = {
        "email": text.rlike(rf"^{_AT}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){{1,4}}$") | _written(text, before),
        "ip": _holds(F.lit("ip"), text),
        "card": text.rlike(r"^[0-9](?:[ -]?[0-9])+$") & _holds(F.lit("card"), text),
        "phone": before.endswith("+") & _holds(F.lit("phone"), text),
    }
    confirmed = reduce(lambda rest, kind: F.when(F.col("kind") == kind, strict[kind]).otherwise(rest), KINDS, F.lit(False))
    return described.withColumn("y", confirmed.cast("int"))


@dataclass(frozen=True)
class Model:
    """Trees as (test, tree or value, tree or value), and a threshold for each kind."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self) -> Column:
        """Sum of the trees; a test is (feature, value), equality or, for ``digits``, at most."""

        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            (name, value), yes, no = tree
            test = F.col(name) <= value if name == "digits" else F.col(name) == value
            return F.when(test, of(yes)).otherwise(of(no))

        return reduce(lambda a, b: a + b, map(of, self.trees), F.lit(float(self.base)))

    def selected(self) -> Column:
        score = self.score()
        return reduce(
            lambda rest, item: F.when(F.col("kind") == item[0], score >= item[1]).otherwise(rest),
            sorted(self.thresholds.items()), F.lit(False),
        )


def _boosted(columns: dict[str, np.ndarray], n: np.ndarray, yes: np.ndarray, depth: int = 2) -> tuple[float, list, np.ndarray]:
    """Trees by Newton steps on the log loss, over weighted rows."""
    rate = min(max(yes.sum() / n.sum(), 1e-4), 1 - 1e-4)
    base = float(np.log(rate / (1 - rate)))
    z, trees = np.full(len(n), base), []
    tests = [(name, value) for name in FEATURES for value in sorted(set(columns[name].tolist()))]
    masks = {t: columns[t[0]] <= t[1] if t[0] == "digits" else columns[t[0]] == t[1] for t in tests}

    def grow(rows, g, h, left):
        value = lambda m: g[m].sum() / (h[m].sum() + 1.0)
        gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
        best = max(((gain(rows & masks[t]) + gain(rows & ~masks[t]), t) for t in tests), default=None) if left else None
        if best is None or best[0] <= gain(rows) + 1e-6:
            return float(RATE * value(rows))
        test = best[1]
        return test, grow(rows & masks[test], g, h, left - 1), grow(rows & ~masks[test], g, h, left - 1)

    def at(tree, rows, out):
        if isinstance(tree, tuple):
            at(tree[1], rows & masks[tree[0]], out)
            at(tree[2], rows & ~masks[tree[0]], out)
        else:
            out[rows] += tree

    every = np.ones(len(n), bool)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        tree = grow(every, yes - n * p, n * p * (1 - p), depth)
        trees.append(tree)
        at(tree, every, z)
    return base, trees, z


def fit(df: DataFrame, text_col: str, confirmed: float = CONFIRMED) -> Model:
    """Boost on the candidates of all texts, and set the thresholds on a held-out half of them.

    What comes to the driver is a row per combination of features, at most about 50,000.
    Without candidates nothing is ever added.
    """
    spans = _candidates(df.select(F.lit(0).alias("_id"), F.col(text_col)), "_id", text_col, LOOSE)
    half = F.pmod(F.xxhash64("text", "before"), F.lit(2)).alias("half")
    counts = (
        _described(spans.where(F.col("gen").isNotNull()))
        .groupBy(*FEATURES, half)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("yes"))
        .collect()
    )
    counts.sort(key=lambda r: tuple(map(str, r)))
    train, test = [r for r in counts if r["half"] == 0], [r for r in counts if r["half"] == 1]
    if not train or not test:
        return Model()
    columns = {name: np.array([r[name] for r in train + test]) for name in FEATURES}
    n, yes = (np.array([float(r[c]) for r in train + test]) for c in ("n", "yes"))
    learnt = np.arange(len(n)) < len(train)
    base, trees, z = _boosted(columns, n * learnt, yes * learnt)
    thresholds = {}
    for kind in KINDS:
        rows = np.flatnonzero(~learnt & (columns["kind"] == kind))
        for cut in np.unique(z[rows][z[rows] >= 0])[::-1]:
            above = rows[z[rows] >= cut]
            if n[above].sum() >= SUPPORT and yes[above].sum() < confirmed * n[above].sum():
                break
            if n[above].sum() >= SUPPORT:
                thresholds[kind] = float(cut) - 1e-9
    return Model(base, trees, thresholds)


def find(df: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """One row per row of ``df``: id, base, spans; arrays of (kind, start, end) in order.

    ``base`` has the strict spans and ``spans`` also those that the model adds, none of which
    overlaps a strict one. Places count characters, the end exclusive; kinds are numbered as
    in ``KINDS``. A null text counts as empty and has none. Other columns are left behind.
    """
    found = _candidates(df, id_col, text_col, BASE | LOOSE).repartition("row")
    length = F.char_length("text")
    upto = Window.partitionBy("row", "gen").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("end", F.sum(F.col("gap") + length).over(upto)).withColumn("start", F.col("end") - length)
    strict = F.coalesce(F.col("gen").isin(*KINDS), F.lit(False))
    described = _described(placed).withColumn("strict", strict)
    kind = F.when(strict, F.col("gen")).otherwise(F.col("kind"))
    sure = (F.col("gen") == "loose_email") & (F.col("y") == 1)
    judged = described.withColumn("keep", F.coalesce(F.when(strict, _holds(F.col("gen"), F.col("text"))).otherwise(model.selected() | sure), F.lit(False)))
    rows = judged.select(
        "row", "id", "start", "end", (strict & F.col("keep")).alias("is_base"), "keep",
        reduce(lambda rest, at: F.when(kind == KINDS[at], at).otherwise(rest), range(len(KINDS)), F.lit(None)).alias("kind"),
    )
    before = (Window.unboundedPreceding, -1)
    forth = Window.partitionBy("row").orderBy("start", F.desc("is_base"), "end").rowsBetween(*before)
    back = Window.partitionBy("row").orderBy(F.desc("start"), "is_base", F.desc("end")).rowsBetween(*before)
    free = (
        F.coalesce(F.max(F.when(F.col("is_base"), F.col("end"))).over(forth) <= F.col("start"), F.lit(True))
        & F.coalesce(F.min(F.when(F.col("is_base"), F.col("start"))).over(back) >= F.col("end"), F.lit(True))
    )
    span = F.struct("kind", "start", "end")
    return (
        rows.withColumn("free", free)
        .groupBy("row")
        .agg(
            F.first("id").alias(id_col),
            F.array_sort(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
            F.array_sort(F.collect_list(F.when(F.col("is_base") | (F.col("keep") & F.col("free")), span))).alias("spans"),
        )
        .drop("row")
    )


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda k: F.get(F.array(*map(F.lit, KINDS)), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mask: str = "*") -> Column:
    """``text`` with the characters of its spans replaced by ``mask``."""
    cut = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))),
        F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.struct(
            F.concat(
                a["done"], F.substr(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int")),
                F.repeat(F.lit(mask), (s["end"] - F.greatest(s["start"], a["at"])).cast("int")),
            ).alias("done"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
    )
    return F.concat(cut["done"], F.substr(text, (cut["at"] + 1).cast("int")))
