"""Personal data by candidate gradient boosting, in DataFrame expressions alone.

High-recall generators propose spans; boosted depth-2 trees score each proposal from its format and the words before it;
a span is taken when its score reaches its kind's calibrated threshold. Trees are learnt from a labelled sample that
`labelled_sample` makes by rule (`sample_rows`, a documented bound), whose features come from the same expressions that
serve the documents, and become one CASE expression. Spans of the four base kinds are exact formats: they stay
whatever the trees say. A text is read in place: no shuffle, and the work of a row depends on that row.

Defined results: a null text counts as empty; rows are independent, so repeated rows repeat their results and rows with a
null doc_id are kept; a text of any length is read whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _spans
from skylattice.llm._shared import documents

#: The base kinds as Java patterns. Possessive repeats and look-behinds keep long runs linear; they find the
#: same matches as the plain forms because what follows a run is never of the run's class.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
BASE = ("email", "ip", "card", "phone")

#: The generators of further spans: kind and Java pattern. Repeats are bounded only where the format is: telephone and identity
#: numbers, hardware and version 6 addresses by their groups, an account number (IBAN) by its 34 characters.
GENERATORS = {
    "email_spelt": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[-.\x20/])[0-9]{3,4}[-.\x20][0-9]{3,4}(?![0-9A-Za-z]|[-.][0-9])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![0-9A-Za-z])",
    "hardware": r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}+(?![0-9A-Fa-f:-])",
    "ip6": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}+(?![0-9A-Fa-f:])",
}
KINDS = (*BASE, *GENERATORS)

#: Words that speak for a kind, or against personal data, in the 40 code points before a proposal.
_FOR = r"(?i)(?:tel|phone|fax|mobile|call|cell|ssn|social|security|iban|bank|account|konto|mail|contact|write|reach|mac|device|adapter|ipv?6|host|address|adresse|t[eé]l[eé]phone|tel[eé]fono|ring|text)[^A-Za-z]*+(?:[A-Za-z]{1,8}[^A-Za-z]{1,3}){0,3}+$"
_AGAINST = r"(?i)(?:version|release|part|isbn|issue|order|invoice|ticket|section|chapter|page|score|ratio|sku|serial|model|law|article|meet|look|time|uuid|hash|build)[^A-Za-z]*+(?:[A-Za-z]{1,8}[^A-Za-z]{1,3}){0,3}+$"
_CONTEXT = 40

FEATURES = ("kind", "digits", "length", "spoken_for", "spoken_against", "valid", "brackets", "mixed_separators", "same_digit", "after_digit")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 14 to 19 digits have the Luhn checksum."""
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = F.lit(0)
    for k in range(1, 21):
        total = total + F.substring(doubled if k % 2 else padded, k, 1).cast("int")
    return total % 10 == 0


def _iban(found: Column) -> Column:
    """Whether the letters and digits have the remainder 1 modulo 97."""
    bare = F.translate(found, " ", "")
    moved = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))
    return (
        F.aggregate(
            F.split(moved, ""),
            F.lit(0),
            lambda a, c: F.when(c == "", a).when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
        )
        == 1
    )


def base_spans(text: Column) -> Column:
    """The spans of the base kinds; matches that fail their check are dropped."""
    email = _spans.matches(text, EMAIL, F.instr(text, "@") > 0)
    ip = F.filter(_spans.matches(text, IP), lambda s: s["found"].rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"))
    card = F.filter(_spans.matches(text, CARD), lambda s: _luhn(_digits(s["found"])))
    phone = F.filter(_spans.matches(text, PHONE, F.instr(text, "+") > 0), lambda s: F.length(_digits(s["found"])).between(10, 15))
    return F.concat(*[_spans.labelled(spans, kind, n) for n, (kind, spans) in enumerate(zip(BASE, (email, ip, card, phone), strict=True))])


def proposals(text: Column) -> Column:
    """The generators' spans, which may overlap each other and the base spans, each with its features."""
    found = F.concat(*[_spans.labelled(_spans.matches(text, pattern), kind, len(BASE) + n) for n, (kind, pattern) in enumerate(GENERATORS.items())])

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    def features(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["begin"] - _CONTEXT + 1, F.lit(1)).cast("int"), F.least(s["begin"], F.lit(_CONTEXT)).cast("int"))
        digits = _digits(s["found"])
        valid = (
            F.when(s["kind"] == "iban", _iban(s["found"]))
            .when(s["kind"] == "national_id", ~s["found"].rlike("^(?:000|666|9)") & ~s["found"].rlike("00[- ][0-9]{4}$|0000$"))
            .when(s["kind"] == "phone_local", digits.rlike("^(?:0[1-9]|[2-9])") & F.length(digits).between(8, 12))
            .when(s["kind"] == "email_spelt", s["found"].rlike(r"(?:\.|\bdot\b[\])]?\x20?)[A-Za-z]{2,12}$") & s["found"].rlike(r"[\[(]|\bdot\b"))
            .otherwise(~s["found"].rlike("^(?:[0-9]{2}[:-]){5}[0-9]{2}$"))
        )
        return F.struct(
            s["n"].alias("n"),
            s["kind"].alias("kind"),
            s["begin"].alias("begin"),
            s["stop"].alias("stop"),
            s["found"].alias("found"),
            F.array(
                s["n"],
                F.length(digits),
                F.char_length(s["found"]),
                flag(before.rlike(_FOR)),
                flag(before.rlike(_AGAINST)),
                flag(valid),
                flag(s["found"].rlike(r"[\[(]")),
                flag(s["found"].rlike(r"-") & s["found"].rlike(r"[.\x20]")),
                flag(digits.rlike(r"^([0-9])\1*$")),
                flag(before.rlike(r"[0-9][^A-Za-z]*$")),
            ).alias("features"),
        )

    return F.transform(found, features)


# -- the trees


@dataclass(frozen=True)
class Trees:
    """Depth-2 trees with integer leaves (10,000 to one log-odds) and the threshold of each kind."""

    trees: tuple[tuple, ...]
    thresholds: dict[int, int]

    def score(self, features: Column) -> Column:
        total = F.lit(0)
        for (f, t), low, high in self.trees:
            sides = [F.when(F.get(features, F.lit(g)) <= u, F.lit(a)).otherwise(F.lit(b)) for (g, u), a, b in (low, high)]
            total = total + F.when(F.get(features, F.lit(f)) <= t, sides[0]).otherwise(sides[1])
        return total

    def score_row(self, row: list[int]) -> int:
        total = 0
        for (f, t), low, high in self.trees:
            (g, u), a, b = low if row[f] <= t else high
            total += a if row[g] <= u else b
        return total

    def taken(self, n: Column, score: Column) -> Column:
        chosen = F.lit(1 << 30)
        for kind, threshold in self.thresholds.items():
            chosen = F.when(n == kind, F.lit(threshold)).otherwise(chosen)
        return score >= chosen


def _split(rows: list[tuple[list[int], float, float]]) -> tuple[float, tuple[int, int]]:
    """The split of (features, gradient, hessian) rows with the largest gain."""
    g_all, h_all = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (0.0, (0, 1 << 30))
    for f in range(len(FEATURES)):
        sums: dict[int, list[float]] = {}
        for x, g, h in rows:
            s = sums.setdefault(x[f], [0.0, 0.0])
            s[0] += g
            s[1] += h
        g_low = h_low = 0.0
        for value in sorted(sums)[:-1]:
            g_low, h_low = g_low + sums[value][0], h_low + sums[value][1]
            gain = g_low**2 / (h_low + 1) + (g_all - g_low) ** 2 / (h_all - h_low + 1) - g_all**2 / (h_all + 1)
            if gain > best[0] + 1e-9:
                best = (gain, (f, value))
    return best


def boost(sample: list[tuple[list[int], int]], rounds: int = 24, rate: float = 0.3) -> tuple[tuple, ...]:
    """Gradient boosting on the logistic loss."""
    from math import exp

    scores, trees = [0] * len(sample), []
    for _ in range(rounds):
        p = [1 / (1 + exp(-s / 10_000)) for s in scores]
        rows = [(x, y - q, q * (1 - q)) for (x, y), q in zip(sample, p, strict=True)]
        _, (f, t) = _split(rows)
        sides = []
        for side in ([r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]):
            _, (g, u) = _split(side)
            leaves = []
            for leaf in ([r for r in side if r[0][g] <= u], [r for r in side if r[0][g] > u]):
                leaves.append(round(10_000 * rate * sum(r[1] for r in leaf) / (sum(r[2] for r in leaf) + 1)))
            sides.append(((g, u), *leaves))
        tree = ((f, t), *sides)
        trees.append(tree)
        one = Trees((tree,), {})
        scores = [s + one.score_row(x) for s, (x, _) in zip(scores, sample, strict=True)]
    return tuple(trees)


def calibrate(trees: tuple[tuple, ...], sample: list[tuple[list[int], int]], precision: float) -> dict[int, int]:
    """For each kind the least score from which on the sample's share of true spans is at least `precision`."""
    out = {}
    for n in range(len(BASE), len(KINDS)):
        scored = sorted(((Trees(trees, {}).score_row(x), y) for x, y in sample if x[0] == n), reverse=True)
        true, chosen = 0, 1 << 30
        for k, (score, y) in enumerate(scored, 1):
            true += y
            if (k == len(scored) or scored[k][0] < score) and true >= precision * k:
                chosen = score
        out[n] = chosen
    return out


#: The sample's rule: for each kind sentences that hold a value of it, and sentences in which a like string means something else.
_SENTENCES = {
    "email_spelt": (("Contact me: {}", "write to {} please", "mail {}", "{} is my address", "reach us by {}"), ("we meet {} later", "look {} now", "they were {} again")),
    "phone_local": (("call {} today", "Tel. {}", "phone: {}", "my mobile is {}", "fax {}", "ring me on {}"), ("order {} shipped", "invoice no {}", "version {} is out", "part {} fits", "the score was {}", "section {} says")),
    "national_id": (("SSN {}", "social security number: {}", "my ssn is {}", "{} is hers"), ("part no {}", "isbn {}", "serial {}", "ticket {} closed", "model {}")),
    "iban": (("IBAN {}", "account: {}", "pay to {}", "bank details {}"), ("serial {}", "part {} fits", "hash {}", "model {}")),
    "hardware": (("MAC {}", "device address {}", "adapter {} is up", "host {} joined"), ("at time {}", "ratio {}", "build {}", "uuid {}")),
    "ip6": (("host {} answered", "IPv6 address {}", "from {} to there", "ip {}"), ("hash {}", "time {} passed", "build {}", "ratio {}")),
}


def _value(rnd: random.Random, kind: str, true: bool) -> str:
    def d(n: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def w(n: int) -> str:
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    if kind == "email_spelt":
        at, dot = rnd.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", ".")])
        return f"{w(6)}{at}{w(6)}{dot}{rnd.choice(['com', 'org', 'de', 'net'])}" if true else f"{w(4)} at {w(5)}.{w(3).title()}"
    if kind == "phone_local":
        a = rnd.choice("23456789") + d(2)
        return rnd.choice([f"({a}) {d(3)}-{d(4)}", f"{a}-{d(3)}-{d(4)}", f"{a}.{d(3)}.{d(4)}", f"0{d(2)} {d(4)} {d(4)}"]) if true else rnd.choice([f"{d(3)}-{d(3)}-{d(4)}", f"{d(2)}.{d(3)}.{d(3)}", f"{d(4)} {d(4)} {d(4)}", "000-000-0000"])
    if kind == "national_id":
        return f"{rnd.randint(100, 665)}-{rnd.randint(10, 99)}-{rnd.randint(1000, 9999)}" if true else rnd.choice([f"9{d(2)}-{d(2)}-{d(4)}", f"000-{d(2)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}"])
    if kind == "iban":
        body = d(18)
        check = 98 - int(body + "131400") % 97 if true else rnd.randint(10, 99)
        s = f"DE{check:02d}{body}"
        return s if rnd.random() < 0.5 else " ".join(s[k : k + 4] for k in range(0, len(s), 4))
    if kind == "hardware":
        return ":".join(rnd.choice("0123456789abcdef") + rnd.choice("abcdef") for _ in range(6)) if true else ":".join(d(2) for _ in range(6))
    return ":".join("".join(rnd.choice("0123456789abcdef") for _ in range(4)) for _ in range(8))


def labelled_sample(sample_rows: int, seed: int) -> list[tuple[str, str, int]]:
    """(kind, sentence, label) by rule; the number of rows is the bound on what the trees are fitted to."""
    rnd, rows = random.Random(seed), []
    kinds = list(_SENTENCES)
    for k in range(sample_rows):
        kind, label = kinds[k % len(kinds)], (k // len(kinds)) % 2
        # now and then a value stands in the other kind of sentence, so that neither format nor context decides alone
        value = _value(rnd, kind, bool(label) if rnd.random() < 0.9 else True)
        rows.append((kind, rnd.choice(_SENTENCES[kind][1 - label]).format(value), label))
    return rows


def fit(spark: SparkSession, sample_rows: int = 2400, seed: int = 7, precision: float = 0.95) -> Trees:
    """Trees on one half of the sample, thresholds on the other."""
    rows = labelled_sample(sample_rows, seed)
    lines = F.lit("\n".join(text for _, text, _ in rows))
    table = spark.range(1).select(F.posexplode(F.split(lines, "\n")).alias("row", "text"))
    found = table.select("row", F.explode(F.transform(proposals(F.col("text")), lambda s: s["features"])).alias("features")).collect()
    sample = [([*r.features], rows[r.row][2] if KINDS[r.features[0]] == rows[r.row][0] else 0, r.row) for r in found]
    learn = [(x, y) for x, y, row in sample if (row // 12) % 2 == 0]
    check = [(x, y) for x, y, row in sample if (row // 12) % 2 == 1]
    trees = boost(learn)
    return Trees(trees, calibrate(trees, check, precision))


def detect(docs: DataFrame, trees: Trees, text_col: str = "text") -> Column:
    """An expression: the spans of a text, base and taken, each (n, kind, begin, stop, found)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    taken = F.filter(proposals(text), lambda s: trees.taken(s["n"], trees.score(s["features"])))
    plain = F.transform(taken, lambda s: F.struct(s["n"].alias("n"), s["kind"].alias("kind"), s["begin"].alias("begin"), s["stop"].alias("stop"), s["found"].alias("found")))
    return F.concat(base_spans(text), plain)


def digests(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), detect(docs, trees, text_col).alias("found"))
    base = F.filter("found", lambda s: s["n"] < len(BASE))
    counts = [F.size(F.filter("found", _spans.is_kind(n))).cast("long").alias(f"n_{kind}") for n, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_spans.listed(base), 256).alias("base_sha256"), _spans.listed(F.col("found")).alias("spans"))


def redacted(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows with their spans replaced by [KIND]; a null text stays null."""
    spans = detect(docs, trees, text_col)
    return docs.withColumn(text_col, _spans.let(spans, lambda s: _spans.redact(F.col(text_col), s, lambda kind: F.concat(F.lit("["), F.upper(kind), F.lit("]")))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), fit(spark))
