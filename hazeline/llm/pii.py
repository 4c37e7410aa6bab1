"""Personal data by weak supervision, in column expressions.

Patterns propose spans: those of the base rules, matches that fail a base rule, and looser
forms. Five labelers vote on every proposal (+1, -1 or 0): the base rule, a gazetteer of
domains, country codes and issuers, words to the left, the characters at the borders, and
the grouping of the digits. Corpus-wide counts of vote patterns, a bounded table whatever
the input, give each labeler's reliability by expectation-maximisation, and a logistic span
classifier is trained on the resulting beliefs. Base spans always stay; another proposal is
kept if the classifier is sure of it and it overlaps no base span.

Positions come from cutting the text at the pattern: gaps and matches alternate, so running
lengths give code points. No row leaves the JVM; only the counts of vote patterns come to
the driver, where a few hundred rows are worked on in plain Python.

Edge cases: a null text counts as empty; without proposals nothing is added; repeated rows
get equal results and count each; null doc_ids stay; very long texts are read whole, their
spans in parts, so that many spans do not cost their square; other columns are not read.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import all_matches, sha256, text_or_empty
from hazeline.session import write_and_reread

KINDS = ["email", "ip", "card", "phone"]
#: A run of local-part characters is entered at its start, or where the last match ended;
#: from inside it no match could begin that does not begin there too.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,64}(?: ?(?:[\[(](?:dot|DOT)[\])]|\.) ?[A-Za-z0-9-]{1,64}){1,4}",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
#: No match of a pattern without one of these; a cheap look before the expensive one.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_NEEDS = {"email": r"[\[(](?:at|AT)[\])]", "phone": r"[0-9][ .-][0-9]{4}"}

PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Gazetteers, by kind: what a plausible value looks like.
DOMAINS = r"\.(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|it|nl|at|ch|us|ca|mx|ar|co|example)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6(?:011|4|5))"
COUNTRIES = r"^(?:1|7|2[07]|2[1-689][0-9]|3[0-469]|3[578][0-9]|4[0134-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[7-9][0-9]|8[1246]|8[05789][0-9]|9[0-58]|9[679][0-9])"
RESERVED = r"^0*(?:0|127|2[2-5][0-9])\."
#: Words to the left that speak for a kind, and words that speak against any.
FOR = {
    "email": r"mail|contact|kontakt|contacto|correo|courriel|write to|schreib",
    "ip": r"\bip\b|host|server|serveur|servidor|address|adresse|login from",
    "card": r"card|visa|amex|karte|carte|tarjeta|credit|kredit",
    "phone": r"phone|tel\b|tel[.:]|telefon|teléfono|téléphone|call|mobile|handy|móvil|fax|whatsapp",
}
AGAINST = r"version|isbn|invoice|order no|ticket|build|rev\b|section|chapter"
CONTEXT = 40
LABELERS = ["rule", "gazetteer", "context", "border", "grouping"]
ROUNDS = 50
#: Spans of a document that are worked on together.
PART_SIZE = 128
#: How sure the classifier must be of a span that no base rule covers.
SURE = 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d >= "5", d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _rule(kind: str, value: Column) -> Column:
    """The base rule of a kind on a match of its pattern."""
    count = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(count.between(13, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        known = F.lower(value).rlike(DOMAINS) | F.lower(value).rlike(r"[\[(. ](?:com|org|net|edu)$")
    elif kind == "ip":
        known = ~value.rlike(RESERVED)
    elif kind == "card":
        known = _digits(value).rlike(ISSUERS)
    else:
        known = ~value.startswith("+") | _digits(value).rlike(COUNTRIES)
    return _vote(known, ~known)


def _grouping(kind: str, value: Column) -> Column:
    """Digits in the groups people write, against one digit over and over."""
    same = _digits(value).rlike(r"^([0-9])\1*$")
    if kind == "card":
        return _vote(~same & value.rlike(r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"), same)
    if kind == "phone":
        return _vote(~same & value.rlike(r"[0-9]{3}[ .-][0-9]{4}$|[0-9]{2}[ .-][0-9]{2}$"), same)
    return _vote(F.lit(False), F.lit(False))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(items: Column) -> Column:
    """An array in parts of PART_SIZE, so that no step copies more than one part."""
    last = F.floor((F.size(items) - 1) / PART_SIZE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * PART_SIZE + 1, PART_SIZE))
    return F.when(F.size(items) > 0, cut).otherwise(F.slice(F.array(items), 1, 0))


def _cut(text: Column, pattern: str, needs: str) -> Column:
    """``{start, end, value}`` of all matches, leftmost and without overlap."""
    gaps = F.split(text, pattern, -1)
    zipped = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        all_matches(text, pattern),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    none = F.array().cast("array<struct<start: int, end: int, value: string>>")

    def step(acc, one):
        start = acc["at"] + one["gap"]
        end = start + F.length(one["value"])
        span = F.struct(start.alias("start"), end.alias("end"), one["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def placed(part):
        """Spans of a part, counted from its own beginning."""
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)

    def moved(parts):
        """The parts' spans, each moved by what the parts before it take."""
        shift = lambda i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda a, p: a + p["at"])
        by = lambda s, n: F.struct((s["start"] + n).alias("start"), (s["end"] + n).alias("end"), s["value"].alias("value"))
        return F.flatten(F.transform(parts, lambda p, i: _let(shift(i), lambda n: F.transform(p["spans"], lambda s: by(s, n)))))

    spans = _let(F.transform(_parts(zipped), placed), moved)
    return F.when(text.rlike(needs), spans).otherwise(none)


def _proposals(text: Column, kind: str, loose: bool) -> Column:
    spans = _cut(text, LOOSE[kind], LOOSE_NEEDS[kind]) if loose else _cut(text, PATTERNS[kind], NEEDS[kind])

    def judged(s):
        value, left = s["value"], F.lower(F.substr(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
        before = F.substr(text, s["start"], F.when(s["start"] > 0, F.lit(1)).otherwise(0))
        after = F.substr(text, s["end"] + 1, F.lit(1))
        base = F.lit(False) if loose else _rule(kind, value)
        glued = before.rlike(r"[A-Za-z0-9_]") | after.rlike(r"[A-Za-z0-9_]")
        votes = [
            F.lit(0) if loose else _vote(base, ~base),
            _gazetteer(kind, value),
            _vote(left.rlike(FOR[kind]), left.rlike(AGAINST)),
            _vote(~glued, glued),
            _grouping(kind, value),
        ]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            base.alias("base"),
            F.lit(loose).alias("loose"),
            *[v.alias(name) for v, name in zip(votes, LABELERS)],
        )

    return F.transform(spans, judged)


def proposed(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: every proposal with its votes, by kind and start; one pass over the text."""
    text = F.col("text")
    arrays = [_proposals(text, kind, False) for kind in KINDS] + [_proposals(text, kind, True) for kind in LOOSE]
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.select("doc_id", F.sort_array(F.concat(*arrays)).alias("spans"))


def vote_counts(proposals: DataFrame) -> list[tuple]:
    """How often each pattern of kind, looseness and votes occurs: at most 8 * 3 ** 5 rows."""
    columns = ["kind", "loose", *LABELERS]
    seen = proposals.select(F.explode("spans").alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in columns])
    return [tuple(row) for row in seen.count().collect()]


def beliefs(counts: list[tuple]) -> list[float]:
    """How likely each vote pattern is personal data, by expectation-maximisation.

    Labelers vote independently given the truth, with reliabilities of their own for each
    kind. They begin as, and are weakly held at, right three times in four.
    """
    begin = {(1, 1): 0.6, (1, 0): 0.25, (1, -1): 0.15, (0, 1): 0.15, (0, 0): 0.25, (0, -1): 0.6}
    chance = {(k, j, y, v): begin[y, v] for k in range(len(KINDS)) for j in range(len(LABELERS)) for y in (0, 1) for v in (-1, 0, 1)}
    prior = {k: 0.5 for k in range(len(KINDS))}
    belief = [0.5] * len(counts)
    for _ in range(ROUNDS):
        for i, (kind, _, *votes, _) in enumerate(counts):
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(math.log(chance[kind, j, 1, v] / chance[kind, j, 0, v]) for j, v in enumerate(votes))
            belief[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        held = 4.0  # samples' worth of the starting values
        total = {(k, y): 0.0 for k in prior for y in (0, 1)}
        seen = {key: held * begin[key[2], key[3]] for key in chance}
        for (kind, _, *votes, n), b in zip(counts, belief):
            for y, share in ((1, b), (0, 1 - b)):
                total[kind, y] += n * share
                for j, v in enumerate(votes):
                    seen[kind, j, y, v] += n * share
        chance = {(k, j, y, v): seen[k, j, y, v] / (total[k, y] + held) for k, j, y, v in chance}
        prior = {k: (total[k, 1] + 2) / (total[k, 1] + total[k, 0] + 4) for k in prior}
    return belief


def _features(kind: int, loose: bool, votes) -> list[tuple]:
    """Names of the features that a proposal has."""
    return [("kind", kind), ("loose", kind, bool(loose)), *[(kind, LABELERS[j], v) for j, v in enumerate(votes) if v]]


def classifier(counts: list[tuple], belief: list[float]) -> dict[tuple, float]:
    """Weights of a logistic span classifier fitted to the beliefs by gradient descent."""
    weights = {f: 0.0 for kind, loose, *votes, _ in counts for f in _features(kind, loose, votes)}
    amount = sum(row[-1] for row in counts)
    for _ in range(400):
        slope = {f: 0.0 for f in weights}
        for (kind, loose, *votes, n), b in zip(counts, belief):
            own = _features(kind, loose, votes)
            p = 1 / (1 + math.exp(-sum(weights[f] for f in own)))
            for f in own:
                slope[f] += (b - p) * n / amount
        for f in weights:
            weights[f] += 2.0 * (slope[f] - 1e-4 * weights[f])
    return weights


def _probability(weights: dict[tuple, float], span: Column) -> Column:
    total = F.lit(0.0)
    for f, w in sorted(weights.items(), key=repr):
        if f[0] == "kind":
            has = span["kind"] == f[1]
        elif f[0] == "loose":
            has = (span["kind"] == f[1]) & (span["loose"] == f[2])
        else:
            has = (span["kind"] == f[0]) & (span[f[1]] == f[2])
        total = total + F.when(has, F.lit(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def found(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: what is personal data, by kind and start, ``base`` where a base rule says so."""
    proposals = write_and_reread(proposed(docs), "pii")
    counts = vote_counts(proposals)
    weights = classifier(counts, beliefs(counts)) if counts else {}

    def meets(parts, s):
        """Whether a base span overlaps: parts that lie apart from the span are passed over."""
        apart = lambda p: (p["low"] >= s["end"]) | (p["high"] <= s["start"])
        over = lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        return F.exists(parts, lambda p: ~apart(p) & F.exists(p["spans"], over))

    def bounded(part):
        low, high = F.array_min(F.transform(part, lambda b: b["start"])), F.array_max(F.transform(part, lambda b: b["end"]))
        return F.struct(low.alias("low"), high.alias("high"), part.alias("spans"))

    def stays(s, parts):
        possible = ~((s["kind"] == KINDS.index("ip")) & (s["rule"] == -1))  # no address has a part over 255
        sure = possible & (_probability(weights, s) >= SURE)
        return s["base"] | F.when(~s["base"] & sure, ~meets(parts, s)).otherwise(False)

    base = F.transform(_parts(F.filter("spans", lambda b: b["base"])), bounded)
    kept = _let(base, lambda parts: F.filter(F.col("spans"), lambda s: stays(s, parts)))
    return proposals.withColumn("spans", kept)


def scanned(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of spans of every document, and the number of all spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
    base = F.filter("spans", lambda s: s["base"])
    number = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found(docs).select(
        "doc_id",
        *[number(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        sha256(written(base)).alias("base_sha256"),
        written("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
