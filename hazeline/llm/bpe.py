"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

A word is the byte-level spelling of a pre-token plus an end mark. Aho-Corasick finds the
longest token that starts at each position; tokens are taken left to right, and a token is
kept only if the pair with its predecessor is compatible, i.e. no merge would have crossed
their border. A token that cannot stand is replaced by its next shorter prefix, and a
position from which nothing works is closed, so each position is entered a bounded number of
times and the result equals that of applying the merges by rank.

Edge cases: null text counts as empty and gives no ids; empty text gives no ids and empty
decoded text; repeated rows give equal results; other columns are not read.
"""

import hashlib
import json
import re
import struct
import unicodedata

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.common import id_text

#: Ends a word; it is no letter of the byte-level alphabet.
END = "\n"
#: Distinct runs of non-space text remembered by one worker, and pairs of tokens, about 80 MB;
#: beyond them the memory starts anew.
REMEMBERED, PAIRS = 250_000, 150_000
#: Rows of an output batch, whose ids take many times the room of their texts.
ROWS = 512
#: Ids decoded at once, which bounds the working arrays of a very long text.
DECODED_AT_ONCE = 1 << 18
#: Words whose bytes are their own letters.
PLAIN = re.compile(r"[!-~]+").fullmatch
WHITE = regex.compile(r"\p{White_Space}+")
SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    letters = {b: chr(b) for b in plain}
    return [letters[b] if b in letters else chr(next(others)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs, as plain lists (a few MB).

    Raises on a file of another kind, rather than encode it wrongly.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, normal, pre = whole["model"], whole["normalizer"], whole["pre_tokenizer"]
    kinds = [n["type"] for n in normal["normalizers"]]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: not a lower-casing BPE with word ends")
    if whole["decoder"] is not None or whole["post_processor"] is not None or model["byte_fallback"]:
        raise ValueError(f"{path}: decoder, post-processor and byte fallback are not covered")
    if [p["type"] for p in pre["pretokenizers"]] != ["Split", "ByteLevel"]:
        raise ValueError(f"{path}: pre-tokenizer is not covered")
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    size = 1 + max([*model["vocab"].values(), *special.values()])
    tokens = [""] * size
    for content, number in [*model["vocab"].items(), *special.items()]:
        tokens[number] = content
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {
        "tokens": tokens,
        "merges": [(model["vocab"][a], model["vocab"][b], model["vocab"][(a + b)]) for a, b in merges],
        "special": special,
        "split": pre["pretokenizers"][0]["pattern"]["Regex"],
    }


class Codec:
    """Encoder and decoder of one vocabulary, built once in a worker."""

    def __init__(self, vocabulary: dict):
        self.tokens = vocabulary["tokens"]
        self.special = vocabulary["special"]
        self.words = regex.compile(vocabulary["split"].replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.letters = byte_letters()
        named = set(self.special.values())
        self.spelled = {
            (t[:-4] + END if t.endswith("</w>") else t): i for i, t in enumerate(self.tokens) if t and i not in named
        }
        self.automaton = ahocorasick.Automaton()
        for spelling, number in self.spelled.items():
            self.automaton.add_word(spelling, (number, len(spelling)))
        self.automaton.make_automaton()
        self.length = {number: len(spelling) for spelling, number in self.spelled.items()}
        self.shorter = self._next_prefixes()
        # rank of the merge that made a token; tokens no merge makes come first
        self.rank = {c: r for r, (_, _, c) in enumerate(vocabulary["merges"])}
        self.merged = {(a, b): r for r, (a, b, _) in enumerate(vocabulary["merges"])}
        self.halves = {c: (a, b) for a, b, c in vocabulary["merges"]}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        pieces = [(t + " ").encode() for t in self.tokens]
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, pieces)])

    def _next_prefixes(self) -> dict[int, int]:
        """The longest proper prefix of each token that is itself a token."""
        shorter = {}
        for spelling, number in self.spelled.items():
            for n in range(len(spelling) - 1, 0, -1):
                if (prefix := self.spelled.get(spelling[:n])) is not None:
                    shorter[number] = prefix
                    break
        return shorter

    def fits(self, first: int, second: int) -> bool:
        """Whether merging by rank leaves the border between two neighbouring tokens standing.

        Both tokens are taken apart from the last merge back. Whenever the two parts at
        the border could merge earlier than the merges that built their surroundings, the
        border would have been crossed.
        """
        pair = (first, second)
        if (known := self.compatible.get(pair)) is not None:
            return known
        limit, answer = len(self.merged), True  # merges of this rank and later are undone
        while True:
            if self.merged.get(pair, limit) < limit:
                answer = False
                break
            left, right = pair
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                break
            if a > b:
                limit, pair = a, (self.halves[left][1], right)
            else:  # merges of one rank go from the left, so the border's came before the right token's
                limit, pair = b + 1, (left, self.halves[right][0])
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        self.compatible[first, second] = answer
        return answer

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers."""
        spelled = word + END if PLAIN(word) else "".join([self.letters[b] for b in word.encode()]) + END
        whole = self.spelled.get(spelled)
        if whole is not None and self._reachable(whole):
            return struct.pack("<I", whole)
        size = len(spelled)
        longest: list[int | None] = [None] * size
        for end, (number, length) in self.automaton.iter(spelled):
            start = end - length + 1
            if longest[start] is None or length > self.length[longest[start]]:
                longest[start] = number
        open_at = bytearray(b"\x01") * (size + 1)
        open_at[size - 1] = 0  # the end mark never stands alone
        chosen: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            last = chosen[-1] if chosen else None
            while token is not None:
                end = at + self.length[token]
                if open_at[end] and (last is None or self.fits(last, token)):
                    break
                token = self.shorter.get(token)
            if token is not None:
                chosen.append(token)
                at += self.length[token]
                token = longest[at] if at < size else None
                continue
            if not chosen:
                raise ValueError(f"no tokens spell {word!r}")
            open_at[at] = 0
            token = chosen.pop()
            at -= self.length[token]
        return struct.pack(f"<{len(chosen)}I", *chosen)

    def _reachable(self, token: int) -> bool:
        """Whether merging by rank builds this token from its own bytes."""
        if token not in self.halves:
            return True
        left, right = self.halves[token]
        key = (token, -1)
        if key not in self.compatible:
            self.compatible[key] = (
                self._reachable(left) and self._reachable(right) and self._survives(left, right, self.rank[token])
            )
        return self.compatible[key]

    def _survives(self, left: int, right: int, rank: int) -> bool:
        """Whether the border of a merge's halves stands until that merge."""
        kept = self.merged.pop((left, right))
        saved, self.compatible = self.compatible, {}
        try:
            return self.fits(left, right)
        finally:
            self.merged[(left, right)] = kept
            self.compatible = saved

    def encode(self, text: str) -> bytes:
        parts, at = [], 0
        for mark in self.marks.finditer(text):
            parts.append(self._plain(text[at : mark.start()]))
            parts.append(np.array([self.special[mark[0]]], dtype="<u4").tobytes())
            at = mark.end()
        parts.append(self._plain(text[at:]))
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # letter by letter where the lower case of a letter would depend on its neighbours
        text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        # no pre-token holds white space; str.split takes four control characters for it that are none
        chunks = text.split() if SEPARATORS.isdisjoint(text) else WHITE.split(text)
        known, out = self.known, []
        for chunk in chunks:
            ids = known.get(chunk)
            if ids is None:
                ids = b"".join([self.encode_word(word) for word in self.words.findall(chunk)])
                if len(chunk) < 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' spellings with a space between, as UTF-8, gathered through the offset table."""
        parts = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[at : at + DECODED_AT_ONCE].astype(np.int64)
            starts = self.offsets[some]
            lengths = self.offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            where = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
            parts.append(self.blob[where].tobytes())
        return b"".join(parts)[:-1]


_CODECS: dict[str, Codec] = {}


def _codec(key: str, shared) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def encoded(spark: SparkSession, docs: DataFrame, path: str, keep_ids: bool = False, text: str = "text") -> DataFrame:
    """Each document's ids, their digest and the digest of the decoded text.

    ``path`` names the tokenizer file; the driver reads it and broadcasts its lists, a few
    MB whatever the input. With ``keep_ids`` the ids themselves are a column ``token_ids``.
    """
    vocabulary = read_vocabulary(path)
    shared = spark.sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(json.dumps(vocabulary, sort_keys=True).encode()).hexdigest()

    def run(batches):
        codec = _codec(key, shared)
        names = ["n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * keep_ids]
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some, rows = batch.iloc[at : at + ROWS], []
                for content in some["text"]:
                    ids = codec.encode(content or "")
                    numbers = np.frombuffer(ids, dtype="<u4")
                    digests = [hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(numbers)).hexdigest()]
                    rows.append([len(numbers), *digests, *[numbers.view(np.int32)] * keep_ids])
                out = pd.DataFrame(rows, columns=names)
                out.insert(0, "doc_id", some["doc_id"].to_numpy())
                yield out

    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids
    rows = docs.select(id_text(), F.col(f"`{text}`").alias("text")).mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
