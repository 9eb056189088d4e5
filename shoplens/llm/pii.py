"""Personal data by weak supervision, in DataFrame expressions only.

Candidate spans come from the base patterns and from looser ones.  Labelers
vote on every candidate: the strict pattern, gazetteers (top-level domains,
issuer and calling codes, reserved networks, credential words), the words
before it, its inner shape and its neighbours.  Expectation-maximisation over
the counts of vote patterns (at most kinds * 3 ** labelers of them, whatever
the input) estimates each labeler's reliability and each pattern's
probability.  With these probabilities as soft labels a naive Bayes span
classifier is trained on shape, length and context features, and decides on
the candidates that are not base matches.  Base matches always stay.

Spans are found per row; no row is exploded in the final pass and nothing but
the two bounded count tables is collected.

Defined results: NULL and empty texts have no spans; repeated rows get equal
spans; with no candidates at all only base rules apply; an empty table gives
no rows; other columns are kept by ``mask_documents`` and ignored otherwise;
very long texts are searched whole, with work linear in their matches but for
the loop over overlapping spans and masking, which are quick up to tens of
thousands of spans.  The loose candidates' patterns have length limits, the
base patterns have none: no base match is lost by them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import let

KINDS = ("email", "ip", "card", "phone", "secret")  # order within equal starts
LABELERS = 5
ABSTAIN = 2
FEATURES = 5
BUCKETS = 64

# The base patterns.  Possessive and anchored to run starts, they
# find what the plain forms find without backtracking over long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser candidates beside them.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?[\[(.](?:dot|DOT)?[\])]?\x20?[A-Za-z0-9-]{1,63}+)+",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?i:(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api_?key)\x20?[=:]\x20?)\"?[A-Za-z0-9+/_-]{8,}+\"?|(?<![A-Za-z0-9])[A-Z0-9]{20}(?![A-Za-z0-9])",
}
# Gazetteers and cue words.
DOMAINS = r"\.(?:com|org|net|edu|gov|info|biz|io|de|fr|es|uk|eu|us|it|nl|ch|at|ca|au|jp|cn|in|br|mx|example)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
CALLING = r"^\+?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^(?:0|127|255|22[4-9]|23[0-9]|24[0-9])\."
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|correo|courriel|kontakt|mailto)\W*\w*\W*$",
    "ip": r"(?i)(?:\bip|host|server|address|client|dirección|adresse)\W*\w*\W*$",
    "card": r"(?i)(?:card|visa|credit|mastercard|amex|tarjeta|carte|karte)\W*\w*\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|whatsapp|teléfono|téléphone|telefon)\W*\w*\W*$",
    "secret": r"(?i)(?:password|key|secret|credential|login|token)\W*\w*\W*$",
}
AGAINST = r"(?i)(?:version|section|isbn|order|invoice|figure|table|page|chapter|release)\W*\w*\W*$"


def matches(text: Column, pattern: str) -> Column:
    """``start, end, match, left, right`` of all matches (code points), with the text around them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def place(m: Column, p: Column) -> Column:
        pairs = F.transform(
            m,
            lambda x, i: F.struct(
                x.alias("match"),
                F.length(F.get(p, i)).alias("gap"),
                F.right(F.get(p, i), F.lit(40)).alias("left"),
                F.substring(F.get(p, i + 1), 1, 1).alias("right"),
            ),
        )
        return let(pairs, located)

    def located(pairs: Column) -> Column:
        """Starts as sums of the lengths before, by blocks: no array grows match by match."""

        def total(part: Column) -> Column:
            return F.aggregate(part, F.lit(0), lambda a, x: a + x)

        def ends(blocks: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("out"))

            def step(acc: Column, x: Column) -> Column:
                return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))

            return F.aggregate(blocks, start, step, lambda acc: acc["out"])

        def spans(sizes: Column, before: Column) -> Column:
            def span(x: Column, i: Column) -> Column:
                block = F.shiftright(i, BLOCK_BITS)
                first = F.shiftleft(block, BLOCK_BITS)
                begin = F.get(before, block) + total(F.slice(sizes, first + 1, i - first)) + x["gap"]
                return let(
                    begin,
                    lambda at: F.struct(
                        at.alias("start"),
                        (at + F.length(x["match"])).alias("end"),
                        x["match"].alias("match"),
                        x["left"].alias("left"),
                        x["right"].alias("right"),
                    ),
                )

            return F.transform(pairs, span)

        def with_sizes(sizes: Column) -> Column:
            numbers = F.sequence(F.lit(0), F.shiftright(F.size(sizes), BLOCK_BITS))
            blocks = F.transform(
                numbers, lambda k: total(F.slice(sizes, F.shiftleft(k, BLOCK_BITS) + 1, F.lit(1 << BLOCK_BITS)))
            )
            return let(ends(blocks), lambda before: spans(sizes, before))

        return let(F.transform(pairs, lambda x: x["gap"] + F.length(x["match"])), with_sizes)

    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(SPAN)).otherwise(let(pieces, lambda p: place(m, p))))


BLOCK_BITS = 6  # matches of a block, whose lengths are summed anew for each of them
SPAN = "array<struct<start:int,end:int,match:string,left:string,right:string>>"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))

    def worth(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(figures, worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def is_valid(kind: str, match: Column) -> Column:
    """The base rule of a kind."""
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(ABSTAIN)


def votes(kind: str, s: Column, valid: Column) -> Column:
    """The labelers' votes on a candidate: 1, 0 or abstain."""
    m, never = s["match"], F.lit(False)
    if kind == "email":
        strict, gazetteer = m.rlike(r"^[^@]{1,64}@[^@]+\.[A-Za-z]{2,24}$"), _vote(F.lower(m).rlike(DOMAINS), never)
        shape = _vote(~m.contains("..") & m.rlike(r"^[A-Za-z0-9]"), m.contains(".."))
    elif kind == "ip":
        strict, gazetteer = m.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.|$)){4}$"), _vote(~m.rlike(RESERVED), m.rlike(RESERVED))
        shape = _vote(m.rlike(r"[0-9]{2,}\.[0-9]+\.[0-9]+\.[0-9]{2,}"), F.length(m) <= 7)
    elif kind == "card":
        strict, gazetteer = valid, _vote(digits(m).rlike(ISSUERS), ~digits(m).rlike(ISSUERS))
        shape = _vote(m.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7})$"), F.length(m) > 25)
    elif kind == "phone":
        strict, gazetteer = m.startswith("+") & valid, _vote(m.rlike(CALLING) & m.startswith("+"), never)
        shape = _vote(m.rlike(r"[ ().-]"), F.length(m) > 24)
    else:
        strict = m.rlike(r"[A-Za-z].*[0-9]|[0-9].*[A-Za-z]")
        gazetteer = _vote(F.lower(m).rlike(r"password|passwd|pwd|token|secret|key") | m.startswith("AKIA"), never)
        shape = _vote(F.length(m) >= 16, F.length(m) < 12)
    context = _vote(s["left"].rlike(CUES[kind]), s["left"].rlike(AGAINST))
    glued = s["left"].rlike(r"[\p{L}0-9@/_-]$") | s["right"].rlike(r"^[\p{L}0-9@/_]")
    return F.array(
        F.when(strict, 1).otherwise(0), gazetteer, context, shape, F.when(glued, 0).otherwise(1)
    )


def features(s: Column) -> Column:
    """Feature buckets of the final classifier: shape, length, digits, neighbours, word before."""
    form = F.regexp_replace(F.regexp_replace(F.regexp_replace(s["match"], r"[0-9]+", "9"), r"\p{L}+", "a"), r"\s+", " ")
    word = F.lower(F.regexp_extract(s["left"], r"(\p{L}+)[^\p{L}]*$", 1))
    near = F.concat(F.right(s["left"], F.lit(1)), s["right"])

    def bucket(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")

    return F.array(
        bucket(F.substring(form, 1, 12)),
        F.least(F.length(s["match"]), F.lit(BUCKETS - 1)),
        F.least(F.length(digits(s["match"])), F.lit(BUCKETS - 1)),
        bucket(F.regexp_replace(near, r"\p{L}", "a")),
        bucket(word),
    )


def _judge(number: int, loose: bool, judged: bool):
    kind = KINDS[number]

    def judge(s: Column) -> Column:
        valid = is_valid(kind, s["match"])
        fields = [
            F.lit(number).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            (F.lit(False) if loose else valid).alias("base"),
        ]
        if judged:
            fields += [votes(kind, s, valid).alias("votes"), features(s).alias("features")]
        return F.struct(*fields)

    return judge


def candidates(text: Column, judged: bool = True) -> Column:
    """All candidate spans: kind number, start, end, base flag; with votes and features if ``judged``."""
    figure = text.rlike("[0-9]")
    needed = {
        ("email", False): text.contains("@"),
        ("email", True): text.rlike(r"[\[(](?:at|AT)[\])]"),
        ("phone", False): text.contains("+"),
    }
    lists = []
    for number, kind in enumerate(KINDS):
        for pattern, loose in ((BASE.get(kind), False), (LOOSE.get(kind), True)):
            if pattern is None:
                continue
            found = F.when(needed.get((kind, loose), figure), matches(text, pattern)).otherwise(F.array().cast(SPAN))
            if kind == "card":  # runs of fewer digits than a card's are no candidates
                found = F.filter(found, lambda s: F.length(digits(s["match"])) >= 13)
            lists.append(F.transform(found, _judge(number, loose, judged)))
    return F.concat(*lists)


# ---------------------------------------------------------------- training


@dataclass
class SpanModel:
    """Log odds by kind, feature and bucket; prior log odds by kind."""

    weights: list[float]
    priors: list[float]
    reliabilities: dict[str, list[tuple[float, float]]]


def pattern_probabilities(counts: dict[tuple[int, ...], float], rounds: int = 40):
    """EM over vote patterns of one kind: probability per pattern, labeler (hit, false alarm) rates.

    Two hidden classes, votes independent given the class; abstaining says
    nothing.  Rates start and are held (by pseudo counts) at better than chance.
    """
    rates = [(0.8, 0.2)] * LABELERS
    prior = 0.5
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for pattern in counts:
            yes, no = math.log(prior), math.log(1 - prior)
            for v, (hit, false) in zip(pattern, rates):
                if v != ABSTAIN:
                    yes += math.log(hit if v else 1 - hit)
                    no += math.log(false if v else 1 - false)
            posterior[pattern] = 1 / (1 + math.exp(min(700.0, max(-700.0, no - yes))))
        total = sum(counts.values())
        prior = (sum(n * posterior[p] for p, n in counts.items()) + 1) / (total + 2)
        new = []
        for j in range(LABELERS):
            votes_ = [(p[j], n, posterior[p]) for p, n in counts.items() if p[j] != ABSTAIN]
            hit = (sum(n * q for v, n, q in votes_ if v) + 4) / (sum(n * q for _, n, q in votes_) + 5)
            false = (sum(n * (1 - q) for v, n, q in votes_ if v) + 1) / (sum(n * (1 - q) for _, n, q in votes_) + 5)
            new.append((min(0.999, hit), max(0.001, false)))
        rates = new
    return posterior, rates


def _pattern_code(v: Column) -> Column:
    return F.aggregate(v, F.lit(0), lambda acc, x: acc * 3 + x)


def train_spans(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Votes, EM and the span classifier over every whole text of ``docs``."""
    spans = docs.select(F.explode(candidates(F.coalesce(F.col(text_col), F.lit("")), judged=True)).alias("s"))
    spans = spans.select("s.kind", "s.features", "s.base", _pattern_code(F.col("s.votes")).alias("pattern"))
    # one pass over the texts: counts of (kind, pattern, feature, bucket), bounded in size
    table = (
        spans.select("kind", "pattern", "base", F.posexplode("features").alias("feature", "bucket"))
        .groupBy("kind", "pattern", "base", "feature", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    weights = [0.0] * (len(KINDS) * FEATURES * BUCKETS)
    priors, reliabilities = [], {}
    for number, kind in enumerate(KINDS):
        own = [r for r in table if r["kind"] == number]
        counts: dict[tuple[int, ...], float] = {}
        for r in own:
            if r["feature"] == 0:
                pattern = tuple(r["pattern"] // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS))
                counts[pattern] = counts.get(pattern, 0) + r["n"]
        posterior, rates = pattern_probabilities(counts) if counts else ({}, [])
        reliabilities[kind] = rates
        yes = [[0.5] * BUCKETS for _ in range(FEATURES)]
        no = [[0.5] * BUCKETS for _ in range(FEATURES)]
        for r in own:
            pattern = tuple(r["pattern"] // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS))
            p = 1.0 if r["base"] else posterior[pattern]
            yes[r["feature"]][r["bucket"]] += r["n"] * p
            no[r["feature"]][r["bucket"]] += r["n"] * (1 - p)
        all_yes, all_no = sum(yes[0]), sum(no[0])
        priors.append(math.log(all_yes / all_no))
        for f in range(FEATURES):
            for b in range(BUCKETS):
                weights[(number * FEATURES + f) * BUCKETS + b] = math.log(yes[f][b] / sum(yes[f])) - math.log(
                    no[f][b] / sum(no[f])
                )
    return SpanModel(weights, priors, reliabilities)


# ---------------------------------------------------------------- finding


def find_spans(text: Column, model: SpanModel, bar: float = 0.9) -> Column:
    """``start, kind, end, base`` of all spans by start, then kind.

    Base matches stay; another candidate stays if the classifier gives it
    ``bar`` or more and it does not touch a base match.  Numbers that fail the
    octet or check-digit rule are no addresses or cards, however they look:
    they serve as negatives in training and are never added.
    """
    weights, priors = F.lit(model.weights), F.lit(model.priors)
    line = math.log(bar / (1 - bar))

    def odds(s: Column) -> Column:
        return F.aggregate(
            F.transform(s["features"], lambda b, f: F.get(weights, (s["kind"] * FEATURES + f) * BUCKETS + b)),
            F.get(priors, s["kind"]),
            lambda acc, w: acc + w,
        )

    def choose(found: Column) -> Column:
        kept = F.filter(found, lambda s: s["base"])
        added = F.filter(
            found,
            lambda s: ~s["base"]
            & ~s["kind"].isin(KINDS.index("ip"), KINDS.index("card"))
            & ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
            & (odds(s) >= line),
        )
        return F.array_sort(
            F.transform(
                F.concat(kept, added),
                lambda s: F.struct(
                    s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base")
                ),
            )
        )

    return let(candidates(text, judged=True), choose)


def _joined(spans: Column) -> Column:
    kinds = F.lit(list(KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find_personal_data(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts, base digest and all spans of every whole text."""
    model = train_spans(docs, text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), find_spans(F.coalesce(F.col(text_col), F.lit("")), model).alias("spans")
    )

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == number))).cast("long")

    return rows.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])],
        F.sha2(_joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping ones as one)."""
    model = train_spans(docs, text_col)
    kinds = F.lit([f"[{k.upper()}]" for k in KINDS])

    def mask(text: Column, spans: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            fresh = s["start"] >= acc["at"]
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(
                    fresh,
                    F.concat(
                        acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(kinds, s["kind"])
                    ),
                )
                .otherwise(acc["out"])
                .alias("out"),
            )

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(
            spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
        )

    text = F.col(text_col)
    masked = let(
        find_spans(F.coalesce(text, F.lit("")), model), lambda s: F.when(F.size(s) > 0, mask(text, s)).otherwise(text)
    )
    return docs.withColumn(text_col, masked)
