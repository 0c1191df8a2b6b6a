"""SentencePiece BPE encoding by backtracking, and decoding.

A text is cut where no piece can reach across: between two characters that stand side by side in no piece, as
before a space mark that follows another character. Characters outside the vocabulary stand alone and
become byte pieces. Each part is encoded thus:

1. Aho-Corasick gives the pieces that start at every place; the longest is tried first.
2. A piece may follow its predecessor only if merging the two texts from scratch gives these two
   pieces again. A sequence whose neighbours are all compatible is the one that merging finds. Merges
   inside the two pieces were recorded when the model was loaded; merging them side by side means to
   replay what happens at the edge where they meet.
3. Where no piece fits, the place is marked in a bitfield as failed, the last piece is taken back and its
   next shorter rival is tried. No place is left twice, so the work is linear in the text.

Pieces of space marks share one score, so their order is by place and not by piece, and compatibility of
neighbours is not enough; parts with a run of space marks are merged from scratch with a heap.

Parts recur, so each worker remembers a bounded number of them. Null text counts as empty: no tokens.
Long texts are handled part by part; a part without any cut takes a few bytes per character.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import re

import ahocorasick
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import Remembered, column, only_mine, ship_package, whole_row

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED_PARTS = 160_000
REMEMBERED_PAIRS = 300_000
REMEMBERED_LENGTH = 64  # longer parts are not kept
NONE = -1  # no piece
COUNTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceBpe:
    """A merge-type SentencePiece model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        ordinary = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.id_of = {model.id_to_piece(i): i for i in ordinary}
        self.text_of = {i: piece for piece, i in self.id_of.items()}
        self.score = {piece: model.get_score(i) for piece, i in self.id_of.items()}
        bytes_ = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        self.byte_ids = [bytes_[b] for b in range(256)]
        self.longest = max(map(len, self.id_of))
        self.characters = frozenset(piece for piece in self.id_of if len(piece) == 1)
        self.neighbours = frozenset(p[i : i + 2] for p in self.id_of for i in range(len(p) - 1))
        # What each id is when decoded, in UTF-8.
        self.bytes_of = {str(i).encode(): piece.replace(SPACE, " ").encode() for piece, i in self.id_of.items()}
        self.bytes_of |= {str(i).encode(): bytes([b]) for b, i in bytes_.items()}
        self.bytes_of |= {str(i).encode(): b"" for i in ids if model.is_control(i)}
        self.bytes_of |= {str(i).encode(): " ⁇ ".encode() for i in ids if model.is_unknown(i)}
        self.text_id = {piece: str(i) for piece, i in self.id_of.items()}
        # A piece that merging its own text does not give can never be in a result.
        self.edges: dict[str, tuple[list, list] | None] = {}
        for piece in self.id_of:
            merges: list[tuple[int, str, str]] = []
            if self.merge(piece, merges) == [piece]:
                self.edges[piece] = self._edges(piece, merges)
        # Pieces that can be in a result, by number.
        self.usable = list(self.edges)
        self.number = {piece: number for number, piece in enumerate(self.usable)}
        self.length = list(map(len, self.usable))
        self.ids = [self.text_id[piece] for piece in self.usable]
        self.shorter = list(map(self._shorter, self.usable))
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.number.items():
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        # For each piece, as far as asked: of another and its shorter rivals, the first that may follow it.
        self.follows: list[dict[int, int]] = [{} for _ in self.usable]
        self.asked = 0
        # Ids of texts with a space mark before them, and of texts as they stand.
        self.marked = Remembered(self._after_space, REMEMBERED_PARTS, REMEMBERED_LENGTH)
        self.bare = Remembered(self._as_it_stands, REMEMBERED_PARTS, REMEMBERED_LENGTH)

    def _shorter(self, piece: str) -> int:
        """The number of the longest other piece that the piece starts with, NONE without one."""
        return next((self.number[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.number), NONE)

    def _edges(self, piece: str, merges: list[tuple[int, str, str]]) -> tuple[list, list] | None:
        """What stands at the left and at the right end of a piece while it is merged, each with the score
        of the merge that takes it away. None if scores do not fall from merge to merge."""
        scores = [self.score[left + right] for _, left, right in merges]
        if any(a <= b for a, b in zip(scores, scores[1:], strict=False)):
            return None
        size = len(piece)
        first = [(left, s) for (at, left, _), s in zip(merges, scores, strict=True) if at == 0]
        last = [
            (right, s)
            for (at, left, right), s in zip(merges, scores, strict=True)
            if at + len(left) + len(right) == size
        ]
        return [*first, (piece, -math.inf)], [*last, (piece, -math.inf)]

    def merge(self, text: str, merges: list[tuple[int, str, str]] | None = None) -> list[str]:
        """Merging from scratch: the best pair first, the leftmost of equal ones.

        `merges` receives place, left and right text of each merge.
        """
        symbols: list[str] = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        score = self.score
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(symbols):
                both = symbols[left] + symbols[after[left]]
                if both in score:
                    heapq.heappush(queue, (-score[both], left, both))

        for place in range(len(symbols) - 1):
            offer(place)
        while queue:
            _, left, both = heapq.heappop(queue)
            right = after[left]
            if not symbols[left] or right >= len(symbols) or symbols[left] + symbols[right] != both:
                continue  # one of the two has merged with another meanwhile
            if merges is not None:
                merges.append((left, symbols[left], symbols[right]))
            symbols[left], symbols[right] = both, ""
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return [s for s in symbols if s]

    def meet(self, left: str, right: str) -> bool:
        """Whether merging two pieces side by side gives these two again.

        Until something merges across the edge both are merged as they are alone. What stands there on either
        side merges if that scores better than what takes one of them away; of equals the left one is first.
        A piece scores worse than its parts, so both have come about by then.
        """
        before, after = self.edges[left], self.edges[right]
        if before is None or after is None:
            return self.merge(left + right) == [left, right]
        score = self.score.get
        for a, a_goes in before[1]:
            for b, b_goes in after[0]:
                both = score(a + b)
                if both is not None and both > a_goes and both >= b_goes:
                    return False
        return True

    def compatible(self, left: int, right: int) -> int:
        """The first of `right` and its shorter rivals that may follow `left`."""
        if self.asked >= REMEMBERED_PAIRS:
            self.asked = 0
            for known in self.follows:
                known.clear()
        self.asked += 1
        fits = right
        while fits != NONE and not self.meet(self.usable[left], self.usable[fits]):
            fits = self.shorter[fits]
        self.follows[left][right] = fits
        return fits

    def backtrack(self, part: str) -> list[int]:
        """Numbers of the pieces of a part that has only characters of the vocabulary and no run of space marks."""
        size, length, shorter = len(part), self.length, self.shorter
        longest = [0] * size
        for end, number in self.automaton.iter(part):  # the longest match of a place comes last
            longest[end + 1 - length[number]] = number
        follows = self.follows
        failed = None
        found: list[int] = []
        place, piece, known = 0, longest[0], None
        while True:
            if known is not None:  # not at the start
                fits = known.get(piece)
                piece = self.compatible(found[-1], piece) if fits is None else fits
            if piece != NONE:
                end = place + length[piece]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    found.append(piece)
                    if end == size:
                        return found
                    place, known = end, follows[piece]
                    piece = longest[end]
                    continue
                piece = shorter[piece]
            while piece == NONE:
                failed = failed or bytearray((size >> 3) + 1)
                failed[place >> 3] |= 1 << (place & 7)
                taken = found.pop()
                place -= length[taken]
                piece = shorter[taken]
            known = follows[found[-1]] if found else None

    def encode_part(self, part: str) -> str:
        """Ids of a part without cuts, joined by commas."""
        whole = self.number.get(part)
        if whole is not None:
            return self.ids[whole]
        if len(part) == 1 and part not in self.characters:
            return ",".join([str(self.byte_ids[b]) for b in part.encode("utf-8", "surrogatepass")])
        if SPACE * 2 in part:
            return ",".join([self.text_id[p] for p in self.merge(part)])
        return ",".join(map(self.ids.__getitem__, self.backtrack(part)))

    def uncut(self, text: str) -> bool:
        """Whether a text need not be cut: letters of the vocabulary alone, and ASCII or not many."""
        letters = text.isalpha() and (len(text) <= REMEMBERED_LENGTH or text.isascii())
        return letters and self.characters.issuperset(text)

    def cut(self, text: str) -> list[str]:
        """The parts of a text that no piece reaches out of; not all of them where there is nothing but letters."""
        if self.uncut(text):
            return [text]
        neighbours = self.neighbours
        if text[-2:] not in neighbours and self.uncut(text[:-1].removeprefix(SPACE)):
            return [text[:-1], text[-1]]  # a word and its punctuation
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in neighbours]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def _after_space(self, text: str) -> str:
        if self.uncut(text):
            return self.encode_part(SPACE + text)
        first, *others = self.cut(SPACE + text)
        if not others:
            return self.encode_part(first)
        return ",".join([self.marked[first[1:]], *map(self.bare.__getitem__, others)])

    def _as_it_stands(self, text: str) -> str:
        parts = self.cut(text)
        return self.encode_part(text) if len(parts) == 1 else ",".join(map(self.bare.__getitem__, parts))

    def encode(self, text: str) -> str:
        """Ids of a text, joined by commas."""
        if not text:
            return ""
        self.marked.settle()
        self.bare.settle()
        if SPACE in text or "  " in text or text[0] == " " or " \n" in text or text[-1] == " ":
            marked = SPACE + text.replace(" ", SPACE)
            found = map(self.bare.__getitem__, re.findall(f"{SPACE}+[^{SPACE}]*", marked))
        else:
            # Line ends are byte pieces, so the first word of a line stands by itself.
            lines = text.split("\n")
            line_end = str(self.byte_ids[10])
            found = []
            for number, line in enumerate(lines):
                first, *others = line.split(" ")
                if number:
                    found.append(line_end)
                if first or not number:
                    found.append((self.bare if number else self.marked)[first])
                found.extend(map(self.marked.__getitem__, others))
        return ",".join(found)

    def decode(self, ids: str) -> str:
        """The text of comma-joined ids; the space mark put before the text is taken off."""
        if not ids:
            return ""
        first, *others = ids.encode().split(b",")
        start = self.bytes_of[first]
        if start.startswith(b" ") and self.text_of.get(int(first), "").startswith(SPACE):
            start = start[1:]
        return (start + b"".join(map(self.bytes_of.__getitem__, others))).decode("utf-8", "replace")


_LOADED: dict[str, PieceBpe] = {}


def load(model: str) -> PieceBpe:
    """The model of a file, or of a name among the public tokenizers; once per worker."""
    if model not in _LOADED:
        _LOADED[model] = PieceBpe(model if os.path.exists(model) else public_tokenizers.path(model))
    return _LOADED[model]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def round_trip(texts: pd.Series, model: str) -> pd.DataFrame:
    only_mine(_LOADED.clear)
    bpe, rows = load(model), []
    for text in texts:
        ids = bpe.encode(text or "")
        rows.append((ids.count(",") + 1 if ids else 0, sha256(ids), sha256(bpe.decode(ids))))
    return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])


def encoded(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """`doc` (each row as it was) with `ids`, its piece ids."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids_of(texts: pd.Series) -> pd.Series:
        bpe = load(model)
        return pd.Series([[int(i) for i in ids.split(",") if i] for ids in map(bpe.encode, texts.fillna(""))])

    return docs.select(whole_row(docs).alias("doc"), ids_of(column(text)).alias("ids"))


def decoded(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows with `decoded`, the text of their ids (null where there are none)."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def text_of(lists: pd.Series) -> pd.Series:
        bpe = load(model)
        return pd.Series([None if x is None else bpe.decode(",".join(map(str, x))) for x in lists])

    return rows.withColumn("decoded", text_of(column(ids)))


def report(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return with_digests(docs.select("doc_id", "text"), model).select("doc.doc_id", "digest.*")


def with_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """`doc` (each row as it was) with `digest`: token count and hashes of ids and decoded text."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(COUNTS)
    def digest(texts: pd.Series) -> pd.DataFrame:
        return round_trip(texts, model)

    return docs.select(whole_row(docs).alias("doc"), digest(column("text")).alias("digest"))
