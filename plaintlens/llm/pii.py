"""Personal data by weak supervision: labelers vote, expectation maximisation weighs them, a span classifier decides.

Candidates are all matches of the base patterns, passing their check or not, and matches of wider shapes
(spelled-out mail addresses, national phone numbers, identity numbers, names after a form of address).
Regex, gazetteer and context labelers vote 1, 0 or abstain on each candidate. Expectation
maximisation over the vote patterns of each kind estimates how reliable each labeler is, its abstaining included, and how
likely each pattern is personal data; a logistic span classifier is then trained on these soft labels over votes
and shape features, so that it also judges by features no labeler votes on. Base spans always stay;
the classifier adds wider candidates that touch no base span.

All work on text is built-in expressions in one read. Votes and features have few distinct values, so
training works on a table of their patterns (at most 3**6 x kinds x lengths rows, whatever the input); only its
sums reach the driver.

Base patterns are written with possessive runs and a look-behind, so that no start inside a run is
tried again and long runs take linear time and no stack; they match what the plain forms match.

Defined cases: null text counts as empty and has no span. Repeated rows and null ids are treated like any row. An empty
table gives an empty result, and without candidates nothing is trained. Extra columns take no part. Spans are
code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import store, text_of

KINDS = ("email", "ip", "card", "phone", "id", "name")
BASE = 4
WINDOW = 40
THRESHOLD = 0.5
ROUNDS = 30

_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions that every text with a match meets.
HINTS = {
    "email": r"@[A-Za-z0-9-]+\.",
    "ip": r"[0-9]\.[0-9]+\.[0-9]",
    "card": PATTERNS["card"],
    "phone": r"\+[0-9]",
}
WIDE = {
    "email": r"[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]\x20?(?i:dot)\x20?[\])])\x20?[A-Za-z]{2,12})++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\b\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?",
}

# fixed values of the gazetteers and cues
DOMAINS = """com org net edu gov mil int info biz name pro mobi tel travel jobs museum aero coop asia cat app dev blog shop store
online site tech cloud email example test"""
#: Any two letters are taken for the domain of a country.
COUNTRY = "[a-z]{2}"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 353 358 380 420"
GIVEN_NAMES = """james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan
joseph jessica thomas sarah charles karen daniel nancy peter paul anna maria hans klaus julia marie jean pierre
jose juan carlos carmen luis ana pedro sofia laura emma christopher lisa matthew betty anthony sandra mark margaret
steven ashley andrew kimberly george emily edward donna brian michelle kevin carol ronald amanda timothy melissa jason
deborah jeffrey stephanie ryan rebecca jacob sharon gary cynthia nicholas kathleen eric amy jonathan angela stephen
larry justin helen scott brandon benjamin samuel gregory alexander frank patrick raymond jack dennis
jerry wolfgang ursula monika petra stefan andreas sabine martin heike jurgen gisela friedrich sebastian johanna
francois nathalie isabelle philippe sylvie nicolas camille antoine chantal jacques claire louis
francisco antonio manuel javier isabel pilar teresa miguel rafael fernando lucia elena diego pablo alejandro"""
CUES = r"(?i)\b(?:tel|telephone|telefon|phone|call|mobile|cell|fax|contact|kontakt|e-?mail|mail|write|reach|address|card|visa|mastercard|credit|pay|ip|host|ssn|social|passport|name|signed|dear)\b"
AGAINST = r"(?i)\b(?:order|invoice|isbn|issn|version|release|page|price|total|ref|sku|line|figure|table|section|chapter|serial|build|doi)\b[^\p{L}]*$"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: their text, start, end, and what stands before and after.

    The parts between matches give the positions, so one pass over the parts counts code points.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    nothing = F.from_json(F.lit("[]"), "array<struct<hit: string, start: long, end: long, before: string>>")

    def put(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(F.coalesce(pair["hit"], F.lit("")))
        one = F.struct(pair["hit"].alias("hit"), start.alias("start"), end.alias("end"), F.right(pair["gap"], F.lit(WINDOW)).alias("before"))
        return F.struct(end.alias("at"), F.when(pair["hit"].isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(one))).alias("done"))

    start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("done"))
    paired = F.zip_with(gaps, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    return F.aggregate(paired, start, put, lambda s: s["done"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a run of digits is a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    """The base check of a match."""
    count = F.char_length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return F.when(count.between(13, 19), luhn(_digits(hit))).otherwise(False)
    return count.between(9, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0)


def votes(kind: str, base: bool, hit: Column, before: Column) -> list[Column]:
    """One vote of each labeler: check, shape, gazetteer, context, counter-context, border."""
    never, count = F.lit(False), F.char_length(_digits(hit))
    check = _vote(passes(kind, hit), ~passes(kind, hit)) if base else F.lit(None).cast("int")
    shape = {
        "email": _vote(hit.rlike(r"^[A-Za-z0-9]"), hit.rlike(r"^[^A-Za-z0-9]")),
        "ip": _vote(hit.rlike(r"^[1-9][0-9]*(?:\.(?:0|[1-9][0-9]*)){3}$"), hit.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(hit.rlike("^[3-6]"), hit.rlike("^[0]")),
        "phone": _vote(count.between(10, 13), ~count.between(9, 15)),
        "id": _vote(~hit.rlike("^(?:000|666|9)|-00-|-0000$"), hit.rlike("^(?:000|666|9)|-00-|-0000$")),
        "name": _vote(hit.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}{2,}$"), never),
    }[kind]
    gazetteer = {
        "email": _vote(F.lower(hit).rlike(rf"(?:\.|dot\W*)(?:{COUNTRY}|{'|'.join(DOMAINS.split())})$"), hit.rlike(r"[0-9]$")),
        "ip": _vote(never, hit.rlike(r"^(?:0|10|127|192\.168)\.")),
        "card": _vote(hit.rlike("^(?:4|5[1-5]|3[47]|6011)"), never),
        "phone": _vote(hit.rlike(rf"^\+(?:{'|'.join(CALLING_CODES.split())})\b"), never),
        "id": _vote(never, hit.rlike("^(?:123-45-6789|111-11-1111)$")),
        "name": _vote(F.lower(hit).rlike(rf"\b(?:{'|'.join(GIVEN_NAMES.split())})\b"), never),
    }[kind]
    return [
        check, shape, gazetteer,
        _vote(before.rlike(CUES), never),
        _vote(never, before.rlike(AGAINST)),
        _vote(before.rlike(r"(?:^|[\s(\[{<\"',;:|])$"), before.rlike(r"[\p{L}\p{N}_/.#=-]$")),
    ]


LABELERS = 6


def _candidates(kind: str, base: bool, spans: Column) -> Column:
    def one(span: Column) -> Column:
        cast = [v.cast("int") for v in votes(kind, base, span["hit"], span["before"])]
        size = F.char_length(span["hit"])
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), span["start"].alias("start"), span["end"].alias("end"),
            (passes(kind, span["hit"]) if base else F.lit(False)).alias("sure"),
            F.array(*cast).alias("votes"),
            F.when(size < 10, 0).when(size < 16, 1).when(size < 24, 2).otherwise(3).alias("length"),
        )

    return F.transform(spans, one)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidate spans of every row, with votes and features; one read of the texts."""
    empty = F.from_json(F.lit("[]"), "array<struct<hit: string, start: long, end: long, before: string>>")
    text = F.col("__text")
    found = docs.select("doc_id", text_of("text").alias("__text")).select(
        "doc_id",
        *(F.when(text.rlike(HINTS[k]), located(text, PATTERNS[k])).otherwise(empty).alias(f"__{k}") for k in PATTERNS),
        *(F.when(text.rlike(WIDE[k]), located(text, WIDE[k])).otherwise(empty).alias(f"__wide_{k}") for k in WIDE),
    )
    parts = [_candidates(k, True, F.col(f"__{k}")) for k in PATTERNS] + [_candidates(k, False, F.col(f"__wide_{k}")) for k in WIDE]
    return found.select("doc_id", F.concat(*parts).alias("found"))


def estimated(patterns: list[tuple[int, tuple, int]], rounds: int = ROUNDS) -> tuple[list[float], dict[int, list[list[tuple[float, float]]]]]:
    """Expectation maximisation over patterns of (kind, votes, count).

    Returns the probability that each pattern is personal data, and for each kind and labeler the shares on personal
    and on other spans of its three outcomes: 0, 1, and abstaining. Abstaining says something too: a labeler that
    only ever votes 1 tells most by the share of spans it votes on. Each kind has its own rates, as a labeler
    that knows nothing of a kind always abstains there, and that must not weigh on the others.
    """
    chance = []
    for _, votes_of, _ in patterns:
        cast = [v for v in votes_of if v is not None]
        chance.append((sum(cast) + 0.5) / (len(cast) + 1))
    rates: dict[int, list[list[tuple[float, float]]]] = {}
    for _ in range(rounds):
        rates, prior = {}, {}
        for kind in {k for k, _, _ in patterns}:
            mine = [(c, v, n) for c, (k, v, n) in zip(chance, patterns, strict=True) if k == kind]
            on, off = sum(c * n for c, _, n in mine) + 1, sum((1 - c) * n for c, _, n in mine) + 1
            prior[kind], rates[kind] = on / (on + off), []
            for j in range(LABELERS):
                # a labeler is assumed better than chance until the votes say otherwise
                sums = {0: [1.0, 4.0], 1: [4.0, 1.0], None: [2.5, 2.5]}
                for c, v, n in mine:
                    sums[v[j]][0] += c * n
                    sums[v[j]][1] += (1 - c) * n
                totals = [sum(x[side] for x in sums.values()) for side in (0, 1)]
                rates[kind].append([(sums[o][0] / totals[0], sums[o][1] / totals[1]) for o in (0, 1, None)])
        chance = []
        for kind, votes_of, _ in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for v, outcomes in zip(votes_of, rates[kind], strict=True):
                odds += math.log(outcomes[2 if v is None else v][0] / outcomes[2 if v is None else v][1])
            chance.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return chance, rates


def _features(votes_of: list, kind: int, length: int) -> list[float]:
    row = [1.0]
    for v in votes_of:
        row += [float(v == 1), float(v == 0)]
    row += [float(kind == k) for k in range(len(KINDS))]
    return row + [float(length == k) for k in range(4)]


def classifier(rows: list[tuple[list, int, int, int]], rounds: int = 300) -> list[float]:
    """Weights of the span classifier: logistic regression on soft labels, by gradient steps on pattern counts.

    rows: votes, kind, length and count of each feature pattern.
    """
    by_votes: dict[tuple, int] = {}
    for v, kind, _, n in rows:
        by_votes[kind, tuple(v)] = by_votes.get((kind, tuple(v)), 0) + n
    patterns = [(*p, n) for p, n in sorted(by_votes.items(), key=str)]
    soft = {(k, v): c for (k, v, _), c in zip(patterns, estimated(patterns)[0], strict=True)}
    data = [(_features(v, k, s), soft[k, tuple(v)], n) for v, k, s, n in sorted(rows, key=str)]
    weights, total = [0.0] * len(data[0][0]), sum(n for _, _, n in data)
    memory = [1e-8] * len(weights)
    for _ in range(rounds):
        slope = [1e-4 * w for w in weights]
        for x, y, n in data:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * f for w, f in zip(weights, x, strict=True))))))
            for i, f in enumerate(x):
                if f:
                    slope[i] += (p - y) * n / total
        for i, s in enumerate(slope):
            memory[i] += s * s
            weights[i] -= 0.3 * s / math.sqrt(memory[i])
    return weights


def probability(weights: list[float], span: Column) -> Column:
    """The classifier's probability for a candidate, as an expression."""
    total = F.lit(weights[0])
    for j in range(LABELERS):
        vote = F.get(span["votes"], F.lit(j))
        total = total + F.when(vote == 1, weights[1 + 2 * j]).when(vote == 0, weights[2 + 2 * j]).otherwise(0.0)
    at = 1 + 2 * LABELERS
    total = total + F.get(F.array(*map(F.lit, weights[at : at + len(KINDS)])), span["kind"])
    total = total + F.get(F.array(*map(F.lit, weights[at + len(KINDS) :])), span["length"])
    return 1 / (1 + F.exp(-total))


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base and spans: arrays of (kind number, start, end), by kind, then start."""
    found = store(candidates(docs))
    spans = found.select(F.explode("found").alias("span")).select("span.votes", "span.kind", "span.length")
    rows = [tuple(r) for r in spans.groupBy("votes", "kind", "length").count().collect()]
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.sort_array(F.transform(F.filter("found", lambda s: s["base"] & s["sure"]), plain))
    out = found.withColumn("base", base)
    if not rows:
        return out.select("doc_id", "base", F.col("base").alias("spans"))
    weights = classifier(rows)

    def added(span: Column) -> Column:
        clear = ~F.exists("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
        return ~span["base"] & clear & (probability(weights, span) >= threshold)

    more = F.transform(F.filter("found", added), plain)
    return out.select("doc_id", "base", F.sort_array(F.concat("base", more)).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans, of every row."""
    found = personal_data(docs)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
