"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are all runs of three and of four bytes of its lower-cased UTF-8, each
hashed to one of BUCKETS rows of an embedding table. A text is the mean of its rows, and a
linear softmax over it gives the languages. Both tables are trained together by stochastic
gradient descent in numpy, on a bounded sample; a temperature fitted on a part of the sample
that training did not see turns the softmax into probabilities, and the lowest of them that
keeps the share of right answers is the threshold of rejection.

For scoring, embeddings and output weights are multiplied once, so a text costs one lookup
per subword, added for a block of texts at a time.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; without learned
languages every text is ``und``; of equally likely languages the first by name; repeated rows
get equal results; very long texts are hashed whole, in blocks; other columns are not read.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.llm.common import held_out, id_text
from hazeline.session import write_and_reread

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
WIDTH = 12
#: Documents of each language in the sample at most, and of all languages, unless there are more languages than that.
SAMPLE_EACH, SAMPLE = 700, 3_500
EPOCHS, BATCH, RATE = 12, 64, 2.0
#: Bytes hashed at once, which bounds the working arrays of a very long text.
BLOCK = 1 << 20
#: Of the answers that stand, this share is to be right.
RIGHT = 0.99
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def _buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of three and of four bytes, by the byte they begin at."""
    d = data.astype(np.uint32)
    three = d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)
    four = (three[:-1] ^ np.uint32(0x5BD1E995)) + d[3:] * np.uint32(0x27D4EB2F)
    mix = lambda h: ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS)
    return mix(three), mix(four)


def _bytes(text: str) -> np.ndarray:
    """The text with a space on either side, so that its ends are subwords too; never under four bytes."""
    return np.frombuffer(f" {text.lower()}  ".encode(), dtype=np.uint8)


def subword_counts(text: str) -> np.ndarray:
    """How often each bucket occurs in a whole text."""
    data, counts = _bytes(text), np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data) - 3, BLOCK):
        for buckets in _buckets(data[at : at + BLOCK + 3]):
            counts += np.bincount(buckets, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    languages: list[str]
    lookup: np.ndarray  # one row of language margins per bucket
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, text: str) -> np.ndarray:
        data, total, count = _bytes(text), np.zeros(len(self.languages)), 0
        for at in range(0, len(data) - 3, BLOCK):
            for buckets in _buckets(data[at : at + BLOCK + 3]):
                for k in range(len(self.languages)):
                    total[k] += self.lookup[k][buckets].sum()
                count += len(buckets)
        return softmax((total / max(count, 1) + self.bias)[None] / self.temperature)[0]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        p = self.probabilities(text)
        return self.languages[int(np.argmax(p))], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    """``x``: rows of subword shares, of the sample; every eighth row calibrates."""
    random = np.random.default_rng(7)
    kinds = len(languages)
    if not kinds:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), 1.0, 0.0)
    spare = np.arange(len(y)) % 8 == 7
    train = np.flatnonzero(~spare)
    weights = np.bincount(y[train], minlength=kinds)
    weights = (len(train) / np.maximum(weights, 1) / kinds)[y]
    embed = random.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out = random.normal(0, 0.1, (WIDTH, kinds)).astype(np.float32)
    bias = np.zeros(kinds, dtype=np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(train)
        for at in range(0, len(train), BATCH):
            rows = order[at : at + BATCH]
            hidden = x[rows] @ embed
            error = softmax(hidden @ out + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error *= weights[rows, None] / len(rows)
            back = error @ out.T
            out -= rate * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            # a bucket's gradient is as small as its share of a text; the larger step evens that out
            embed -= rate * 50 * (x[rows].T @ back)
    lookup = (embed @ out).T.astype(np.float64)
    z = x[spare] @ lookup.T + bias if spare.any() else np.zeros((0, kinds))
    temperature, least = 1.0, 0.0
    if len(z):
        true = y[spare]
        loss = lambda t: -np.mean(np.log(softmax(z / t)[np.arange(len(z)), true] + 1e-12))
        temperature = float(min(np.geomspace(0.02, 20, 60), key=loss))
        p = softmax(z / temperature)
        top, right = p.max(axis=1), p.argmax(axis=1) == true
        order = np.argsort(-top)
        share = np.cumsum(right[order]) / np.arange(1, len(z) + 1)
        good = np.flatnonzero(share >= RIGHT)
        least = float(top[order][good[-1]]) if len(good) else 1.0
    return Model(languages, lookup, bias.astype(np.float64), temperature, least)


def trained(docs: DataFrame) -> Model:
    """Learns from text and language of documents that are not held out.

    Every language is learned. Languages share SAMPLE evenly, up to SAMPLE_EACH and at least
    one document each, those of the smallest hashes of their ids; the ids are chosen before
    any text is read. The sample is put in the order of the hashes, so that the fit is the same
    however the rows are dealt.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    ids = known.select("doc_id", "lang").distinct()
    sizes = write_and_reread(ids.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    kinds = sizes.count()
    if not kinds:
        return fit(np.zeros((0, BUCKETS), dtype=np.float32), np.zeros(0, dtype=int), [])
    each = min(SAMPLE_EACH, max(1, SAMPLE // kinds))
    drawn = F.xxhash64("doc_id", F.lit("language"))
    # so many of the smallest hashes that the wanted ones are among them but for a chance of e ** -50
    share = (4 * each + 50) / F.col("n")
    few = ids.join(F.broadcast(sizes), "lang").where(drawn < (share * 2 - 1) * 2.0**63)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "doc_id"))
    chosen = few.withColumn("place", place).where(F.col("place") <= each).select("doc_id", "lang")
    # rows of one id and language, should there be several, count as the least text
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def counted(batches):
        for batch in batches:
            counts = [subword_counts(t) for t in batch["text"]]
            places = [np.flatnonzero(c) for c in counts]
            own = batch[["drawn", "doc_id", "lang"]]
            yield own.assign(at=places, n=[c[p] for c, p in zip(counts, places)])

    rows = (
        texts.select(drawn.alias("drawn"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
        .mapInPandas(counted, "drawn long, doc_id long, lang string, at array<int>, n array<long>")
        .toPandas()
        .sort_values(["drawn", "doc_id", "lang"], ignore_index=True)
    )
    languages = sorted(set(rows["lang"]))
    x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    for i, (at, n) in enumerate(zip(rows["at"], rows["n"])):
        x[i, np.asarray(at)] = np.asarray(n) / np.sum(n)
    y = np.array([languages.index(lang) for lang in rows["lang"]], dtype=int)
    return fit(x, y, languages)


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Language and score of every whole text; ``rejected`` where the score is under the model's threshold."""
    model = model or trained(docs)

    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": [lang for lang, _ in found],
                    "score": [score for _, score in found],
                    "rejected": [score < model.least or lang == UNKNOWN for lang, score in found],
                }
            )

    schema = "doc_id string, held_out boolean, lang_pred string, score double, rejected boolean"
    rows = docs.select(id_text(), held_out().alias("held_out"), "text").mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
