"""Secret scan: patterns, and character Markov models of random and of ordinary strings.

The patterns label samples: what they match is random, running text around it is ordinary.
From each kind, all documents' pairs of neighbouring characters are counted (one small table
a task, summed), which gives two first-order Markov models. A long token that no pattern
covers is a secret if its log-likelihood ratio of random against ordinary is high enough,
both in all and per character.

Edge cases: a null text counts as empty; empty texts and tables have no spans; without any
labelled sample the random model is uniform; repeated rows give equal results; very long
texts are read whole, token by token; other columns are not read, or kept as they are by ``redacted``.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import id_text, sha256, text_or_empty

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: The runs of [0-9a-f]+ that are long enough.
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Every ASSIGN match has one of these, in either case.
HINTS = ("passw", "secret", "token", "api")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Log-likelihood ratio, in nats, that makes a token a secret: in all, and for each character.
LEAST_RATIO, LEAST_EACH = 30.0, 2.0
#: What each row of a model is smoothed with, as a count: all characters alike, since a random
#: string may be of any alphabet, or the kind's own frequencies, since ordinary text has few digits.
SMOOTHING = {"random": 400.0, "ordinary": 20.0}

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
SIZE = len(LETTERS) + 1  # class 0: anything else, the signs between an identifier's words among it, and borders
CLASS = np.zeros(256, dtype=np.int64)
CLASS[list(LETTERS.encode())] = np.arange(1, SIZE)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """What the patterns find, as ``(start, end, kind)``, by start and kind."""
    out = []
    lower = text.lower()
    if any(h in lower for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def _pairs(text: str) -> np.ndarray:
    """Pairs of neighbouring character classes of a string with its borders."""
    classes = CLASS[np.frombuffer(f" {text} ".encode(), dtype=np.uint8)]
    return classes[:-1] * SIZE + classes[1:]


def _undecided(text: str) -> list[tuple[int, int]]:
    """Long tokens of letters and digits, which may be secrets and teach neither model."""
    return [m.span() for m in TOKEN.finditer(text) if not m[0].isalpha() and any(map(str.isdigit, m[0]))]


def _count(text: str, random: np.ndarray, ordinary: np.ndarray) -> None:
    at, rest = 0, []
    base = base_spans(text)
    for start, end, kind in base:
        if kind != "assign":
            random += np.bincount(_pairs(text[start:end]), minlength=SIZE * SIZE)
    for start, end in sorted([span[:2] for span in base] + _undecided(text)):
        if start > at:
            rest.append(text[at:start])
        at = max(at, end)
    rest.append(text[at:])
    ordinary += np.bincount(_pairs(" ".join(rest)), minlength=SIZE * SIZE)


@dataclass
class Model:
    """Log-likelihood ratio of each pair of character classes."""

    ratio: np.ndarray

    def of(self, token: str) -> float:
        return float(self.ratio[_pairs(token)].sum())

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """The patterns' spans and those that the models add, by start and kind."""
        base = base_spans(text)
        added = []
        for m in TOKEN.finditer(text):
            token = m[0]
            if token.isdigit() or any(m.start() < end and start < m.end() for start, end, _ in base):
                continue
            ratio = self.of(token)
            if ratio >= LEAST_RATIO and ratio >= LEAST_EACH * len(token):
                added.append((m.start(), m.end(), "markov"))
        return sorted(base + added, key=_order)


def model_of(counts: dict[str, np.ndarray]) -> Model:
    logs = {}
    for kind, table in counts.items():
        own = table.reshape(SIZE, SIZE).sum(axis=0) + 1
        rest = own / own.sum() if kind == "ordinary" else 1 / SIZE
        table = table.reshape(SIZE, SIZE) + SMOOTHING[kind] * rest
        logs[kind] = np.log(table / table.sum(axis=1, keepdims=True))
    return Model((logs["random"] - logs["ordinary"]).ravel())


def trained(docs: DataFrame) -> Model:
    """Counts pairs over all documents; a table of 2 * SIZE ** 2 numbers comes back."""

    def counted(batches):
        tables = {kind: np.zeros(SIZE * SIZE, dtype=np.int64) for kind in SMOOTHING}
        for batch in batches:
            for text in batch["text"]:
                _count(text, **tables)
        for kind, table in tables.items():
            (places,) = np.nonzero(table)
            yield pd.DataFrame({"kind": kind, "pair": places, "n": table[places]})

    pairs = docs.select(text_or_empty().alias("text")).mapInPandas(counted, "kind string, pair int, n long")
    counts = {kind: np.zeros(SIZE * SIZE) for kind in SMOOTHING}
    for row in pairs.groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():
        counts[row["kind"]][row["pair"]] = row["n"]
    return model_of(counts)


def found(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, spans``: array of ``{start, end, kind}`` over whole texts, in code points."""
    model = model or trained(docs)

    def run(batches):
        for batch in batches:
            spans = [[{"start": a, "end": b, "kind": k} for a, b, k in model.spans(t)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": spans})

    schema = "doc_id string, spans array<struct<start: int, end: int, kind: string>>"
    rows = docs.select(id_text(), text_or_empty().alias("text")).mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def scanned(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Counts, digest and list of spans of every document."""
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found(docs, model).select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        sha256(written(base)).alias("base_sha256"),
        written("spans").alias("spans"),
    )


def redacted(docs: DataFrame, model: Model | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The documents with a mark in place of each secret; ``n_chars`` follows the text."""
    model = model or trained(docs)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if text is None or not (spans := model.spans(text)):
                out.append(text)
                continue
            parts, at = [], 0
            for start, end, _ in spans:
                if start >= at:
                    parts += [text[at:start], mark]
                at = max(at, end)
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out, dtype=object)

    changed = docs.withColumn("text", clean("text"))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed
