"""Token counts of whole texts, also of huge ones, as the tokenizer library gives them.

No token reaches across an ASCII white-space character: the pattern that cuts texts into words never matches
one, no canonical composition involves one, and no special token contains one. Such places are the stable
boundaries.

* A huge text is encoded in overlapping chunks, with offsets. Neighbouring chunks are spliced at a boundary in
  their overlap, where both encodings must agree token by token on a stretch before it. If there is
  no such boundary the overlap is doubled, back to the last splice if need be, and then the chunk; a
  text without any boundary ends up as one chunk.
* Other texts are cut at every boundary, and each worker remembers the counts of a bounded number of words.

Null counts as empty: no bytes, no tokens. Repeated documents are counted one by one.
"""

from __future__ import annotations

import os
from bisect import bisect_left

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import Remembered, column, ship_package, whole_row

MODEL = "word_bpe_49k.json"
HUGE = 1 << 15  # characters
CHUNK = 1 << 14
OVERLAP = 256
AGREEING_TOKENS = 8
TOKEN_LIMIT = 2048
REMEMBERED_WORDS = 300_000
REMEMBERED_LENGTH = 64
BOUNDARIES = frozenset(" \t\n\r")
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")


class Chunk:
    """The tokens of text[start:end], by where they lie in the whole text."""

    def __init__(self, tokenizer, text: str, start: int, end: int):
        encoding = tokenizer.encode(text[start:end], add_special_tokens=False)
        self.start, self.end = start, end
        self.ids = encoding.ids
        self.starts = [start + a for a, _ in encoding.offsets]

    def before(self, place: int) -> int:
        """How many tokens start before a place."""
        return bisect_left(self.starts, place)


def splice(text: str, left: Chunk, right: Chunk) -> int | None:
    """A boundary in the overlap, as far right as possible, before which both chunks agree."""
    for place in range(min(left.end, right.end) - 1, right.start, -1):
        if text[place] not in BOUNDARIES:
            continue
        a, b = left.before(place), right.before(place)
        size = min(AGREEING_TOKENS, b)
        same = slice(a - size, a), slice(b - size, b)
        if (
            size
            and a >= size
            and left.ids[same[0]] == right.ids[same[1]]
            and left.starts[same[0]] == right.starts[same[1]]
        ):
            return place
    return None


def count_huge(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, by overlapping chunks."""
    total, done = 0, 0  # tokens before the last splice, and where it is
    left = Chunk(tokenizer, text, 0, min(chunk, len(text)))
    while left.end < len(text):
        shared, place = overlap, None
        while place is None and left.end - shared > done:
            start = left.end - shared
            right = Chunk(tokenizer, text, start, min(start + max(chunk, 2 * shared), len(text)))
            place = splice(text, left, right)
            shared *= 2
        if place is not None and place > done:
            total += left.before(place) - left.before(done)
            left, done = right, place
        else:  # no boundary since the last splice: a longer chunk from there
            size = 2 * (left.end - done)
            left = Chunk(tokenizer, text, done, min(done + size, len(text)))
    return total + len(left.ids) - left.before(done)


class Words:
    """Token counts of words (in bytes, without white space), with those met before remembered."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known = Remembered(self._count_word, REMEMBERED_WORDS, REMEMBERED_LENGTH)

    def _count_word(self, word: bytes) -> int:
        # A letter and a full stop or comma after it are never one token.
        if len(word) > 1 and word[-1:] in (b".", b",") and word[-2] in LETTERS:
            return self.known[word[:-1]] + self.known[word[-1:]]
        text = word.decode("utf-8", "surrogatepass")
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        self.known.settle()
        raw = text.encode("utf-8", "surrogatepass")
        # The tokenizer takes lower case, except that special strings are matched as they stand.
        words = raw.split() if b"<|" in raw else raw.lower().split()
        return sum(map(self.known.__getitem__, words))


_LOADED: dict[str, tuple] = {}


def load(model: str) -> tuple:
    """The tokenizer of a file, or of a name among the public ones, and its words; once per worker."""
    if model not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = model if os.path.exists(model) else public_tokenizers.path(model)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[model] = tokenizer, Words(tokenizer)
    return _LOADED[model]


def count_tokens(text: str | None, model: str = MODEL) -> int:
    tokenizer, words = load(model)
    text = text or ""
    return count_huge(tokenizer, text) if len(text) > HUGE else words.count(text)


def with_counts(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """`doc` (each row as it was) with `n_tokens`."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(t, model) for t in texts], dtype="int64")

    return docs.select(whole_row(docs).alias("doc"), count(column(text)).alias("n_tokens"))


def report(docs: DataFrame, model: str = MODEL, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    return with_counts(docs.select("doc_id", "text"), model=model).select(
        "doc.doc_id",
        F.coalesce(F.octet_length("doc.text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
