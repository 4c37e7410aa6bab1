"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Each paragraph (a line) is hashed to a wide vector and a document is the sum of its
paragraphs' vectors, lane by lane modulo a power of two. Sums do not depend on order, and a
paragraph is inserted or deleted by adding or subtracting its vector (``inserted``,
``deleted``), without the rest of the text.

A vector has two parts. Eight lanes of 32 bits are hashes of the whole paragraph: documents
with the same multiset of paragraphs agree in them, others hardly ever. The other lanes count
set bits over the hashes of the paragraph's pieces of up to PIECE words. Twice a count less
the number of pieces is a random projection of the multiset of pieces, so the cosine of two
documents' projections estimates how alike they are.

Lanes of the second part lie two to a long, 32 bits apart, so one addition serves two. A text
of two gigabytes, the most that a column holds, has fewer pieces than a lane counts.

Edge cases: a null text counts as empty and has one empty paragraph without pieces; the
likeness of two documents without pieces is 1, of one with and one without is 0; of a single
document the next is itself; rows with equal id and text count as one place in the order and
each gives its row; null ids come last; very long texts count whole; other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import keyed, sha256, text_or_empty
from hazeline.llm.sharding import ranked

#: Words of a piece at most; pieces do not cross lines.
PIECE = 8
#: Whole-paragraph lanes, of 32 bits.
WHOLE = 8
#: Bits between lanes that share a long, shifts per hash, and hashes per piece.
GAP, HASHES = 32, 2
PACKED = GAP * HASHES
LANES = 2 * PACKED
BELOW_32 = (1 << 32) - 1
ONES = 1 | 1 << GAP
LANE = (1 << GAP) - 1
SPACES = r"[\x20\x09\x0B-\x0D]+"


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def pieces(lines: Column) -> Column:
    """Hashes of all runs of up to PIECE words, counted from each line's start."""

    def of(line):
        return _let(
            F.array_remove(F.split(line, SPACES, -1), ""),
            lambda words: F.when(
                F.size(words) > 0,
                F.transform(
                    F.sequence(F.lit(0), F.floor((F.size(words) - 1) / PIECE).cast("int")),
                    lambda i: F.xxhash64(F.array_join(F.slice(words, i * PIECE + 1, PIECE), " ")),
                ),
            ).otherwise(F.array().cast("array<long>")),
        )

    return F.flatten(F.transform(lines, of))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _summed(lines: Column, hashes: Column) -> Column:
    longs = lambda numbers: F.array(*[F.lit(n).cast("long") for n in numbers])
    whole = F.transform(
        longs(range(WHOLE)),
        lambda seed: F.aggregate(
            lines,
            F.lit(0).cast("long"),
            lambda a, line: (a + F.xxhash64(line, seed).bitwiseAND(F.lit(BELOW_32))).bitwiseAND(F.lit(BELOW_32)),
        ),
    )

    def packed(own):
        count = lambda j: lambda a, h: a + F.shiftright(h, j).bitwiseAND(F.lit(ONES))
        return F.array(*[F.aggregate(own, F.lit(0).cast("long"), count(j)) for j in range(GAP)])

    number = F.array(F.size(hashes).cast("long"))
    more = [_let(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))), packed) for k in range(1, HASHES)]
    return F.concat(whole, number, packed(hashes), *more)


def vector(text: Column) -> Column:
    """The sum over all paragraphs: whole-paragraph lanes, the number of pieces, packed lanes."""
    return _let(paragraphs(text), lambda lines: _let(pieces(lines), lambda hashes: _summed(lines, hashes)))


def inserted(total: Column, paragraph: Column) -> Column:
    """The vector of a document with one more paragraph."""
    return F.zip_with(total, vector(paragraph), _added(1))


def deleted(total: Column, paragraph: Column) -> Column:
    """The vector of a document without one of its paragraphs."""
    return F.zip_with(total, vector(paragraph), _added(-1))


def _added(sign: int):
    # Packed lanes never borrow from each other: a document's counts are no less than its paragraph's.
    # Whole lanes are brought back by `reduced`.
    return lambda a, b: a + sign * b


def reduced(total: Column) -> Column:
    """A vector with its whole-paragraph lanes modulo 2 ** 32."""
    return F.transform(total, lambda v, i: F.when(i < WHOLE, F.pmod(v, F.lit(1 << 32))).otherwise(v))


def written(total: Column) -> Column:
    """The fingerprint as text: hexadecimal lanes, in order."""
    return F.array_join(F.transform(total, lambda v, i: F.lpad(F.hex(v), F.when(i < WHOLE, 8).otherwise(16), "0")), "")


def projection(total: Column) -> Column:
    """The LANES signed lanes, as doubles."""
    number = F.get(total, F.lit(WHOLE))
    lane = lambda v, k: (F.shiftright(v, GAP * k).bitwiseAND(F.lit(LANE)) * 2 - number).cast("double")
    return F.flatten(
        F.transform(F.slice(total, WHOLE + 2, PACKED), lambda v: F.array(*[lane(v, k) for k in range(2)]))
    )


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two projections, not below 0; 1 for equal vectors."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    both = _let(
        F.struct(projection(a).alias("a"), projection(b).alias("b")),
        lambda p: F.struct(dot(p["a"], p["b"]).alias("ab"), dot(p["a"], p["a"]).alias("aa"), dot(p["b"], p["b"]).alias("bb")),
    )
    cosine = _let(
        both,
        lambda d: F.when((d["aa"] > 0) & (d["bb"] > 0), d["ab"] / F.sqrt(d["aa"] * d["bb"])).otherwise(F.lit(0.0)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, vector, fingerprint`` of every document."""
    total = docs.select("doc_id", vector(text_or_empty()).alias("vector"))
    return total.withColumn("fingerprint", written(F.col("vector")))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The last third of a text is replaced by the beginning of the next document's, in the
    order of descending ids. The order is found over ids alone; texts are shuffled once, and
    of each next text only the part that is needed moves again.
    """
    versioned = keyed(docs)
    order = versioned.select("id_key", "version", "doc_id", F.length("text").alias("n_chars")).distinct()
    order = order.withColumn("backward", F.coalesce(-F.col("doc_id"), F.lit((1 << 63) - 1)))
    places, rows = ranked(order, "backward", "id_key", "version", label="order")
    following = places.select(
        ((F.col("place") + max(rows, 1) - 1) % max(rows, 1)).alias("place"),
        F.col("id_key").alias("next_key"),
        F.col("version").alias("next_version"),
    )
    needs = places.join(following, "place").select(
        "doc_id",
        F.col("id_key").alias("of_key"),
        F.col("version").alias("of_version"),
        "next_key",
        "next_version",
        "n_chars",
        F.floor(F.col("n_chars") / 3).cast("int").alias("take"),
    )
    # one shuffle serves both joins: each reads the same three columns, and vectors are made after it
    whole = versioned.select("id_key", "version", "text")
    ends = (
        whole.join(needs, (F.col("id_key") == F.col("next_key")) & (F.col("version") == F.col("next_version")))
        .select(
            *["doc_id", "of_key", "of_version", "n_chars", "take"],
            F.substr("text", F.lit(1), "take").alias("tail"),
            vector(F.col("text")).alias("next_vector"),
        )
        .dropDuplicates(["of_key", "of_version"])
    )
    on_own = (F.col("id_key") == F.col("of_key")) & (F.col("version") == F.col("of_version"))
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars") - F.col("take")), F.col("tail"))
    both = whole.join(ends, on_own).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), vector(F.col("text")).alias("vector"), "next_vector", edited.alias("edited")
    )
    both = both.select("*", sha256(F.col("edited")).alias("edited_sha256"), vector(F.col("edited")).alias("edited_vector"))
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("vector")).alias("fingerprint"),
        written(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )
