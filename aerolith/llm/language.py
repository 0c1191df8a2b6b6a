"""Language identification by unigram models that sum over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum,
over all ways to cut it into pieces, of the product of their probabilities; the forward algorithm gives it
without listing the cuts. A text's likelihood is the product over its words.

Fitting is expectation maximisation: the words of the training texts are counted per language by Spark; tasks
compute expected piece counts of their words by forward and backward sums; these are added per
language and piece, so that the driver sees at most languages x vocabulary numbers.

Training may use a bounded sample: about `TRAIN_ROWS` rows per language, chosen by a hash of the key, with their
whole texts. Rows with null language or text are no examples. A text that is null or has no letter is `und`
with score 0, and so is every text if there are no examples. Repeated rows are answered one by one; equal
likelihoods go to the language that sorts first.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, only_mine, ship_package, stored, whole_row

VOCABULARY = "piece_bpe_32k.model"
UNDECIDED = "und"
TRAIN_ROWS = 1000
ROUNDS = 3
SMOOTHING = 0.01  # added to each expected count
UNKNOWN = 1e-7  # probability of a character outside the vocabulary, in every language
WORD = re.compile(r"[^\W\d_]+")
START = "▁"
SUMMED_LENGTH = 32  # longer words are summed in logarithms, one by one
WORDS_AT_ONCE = 4096  # summed side by side
REMEMBERED_WORDS = 200_000
BATCH = 256  # texts whose new words are summed together
MIN_SCORE = 0.5


def words_of(text: str | None) -> list[str]:
    found = WORD.findall((text or "").lower())
    return found if any(c.isalpha() for word in found for c in word) else []


class Vocabulary:
    """The pieces that start at each place of a word, by Aho-Corasick."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        odd = (model.is_byte, model.is_control, model.is_unknown)
        self.pieces = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not any(kind(i) for kind in odd)
        ]
        self.unknown = len(self.pieces)  # number of the stand-in for other characters
        self.known = {piece for piece in self.pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for number, piece in enumerate(self.pieces):
            self.automaton.add_word(piece, (number << 16) - (len(piece) << 8))
        self.automaton.make_automaton()

    def matches(self, word: str) -> list[int]:
        """All pieces inside a short marked word, each as one number: piece, start and end in 16, 8 and 8 bits."""
        word = START + word
        found = [code + (end + 1) * 257 for end, code in self.automaton.iter(word)]
        if not self.known.issuperset(word):
            own = self.unknown << 16
            found += [own + (i << 8) + i + 1 for i, c in enumerate(word) if c not in self.known]
        return found

    def long_matches(self, word: str) -> list[tuple[int, int, int]]:
        """(end, start, piece) of all pieces inside a marked word of any length, by their ends."""
        word = START + word
        found = []
        for end, code in self.automaton.iter(word):
            piece = -(-code >> 16)
            found.append((end + 1, end + 1 - (((piece << 16) - code) >> 8), piece))
        found += [(i + 1, i, self.unknown) for i, c in enumerate(word) if c not in self.known]
        return sorted(found)


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    if name not in _VOCABULARIES:
        path = name if os.path.exists(name) else public_tokenizers.path(name)
        _VOCABULARIES[name] = Vocabulary(path)
    return _VOCABULARIES[name]


class _Lattice:
    """The cuts of many short words at once: matches sorted by where they end."""

    def __init__(self, vocab: Vocabulary, words: list[str]):
        flat: list[int] = []
        counts = []
        for word in words:
            found = vocab.matches(word)
            flat += found
            counts.append(len(found))
        codes = np.array(flat, np.int64)
        self.word = np.repeat(np.arange(len(words)), counts)
        self.end, self.start, self.piece = codes & 255, (codes >> 8) & 255, codes >> 16
        self.last = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        self.size = len(words)

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """Sums over all cuts up to each place: word x place x language."""
        sums = np.zeros((self.size, int(self.last.max()) + 1, chance.shape[1]))
        sums[:, 0] = 1.0
        for end, here in self._steps(self.end):
            part = sums[self.word[here], self.start[here]] * chance[self.piece[here]]
            np.add.at(sums[:, end], self.word[here], part)
        return sums

    def backward(self, chance: np.ndarray) -> np.ndarray:
        """Sums over all cuts from each place to the end."""
        sums = np.zeros((self.size, int(self.last.max()) + 1, chance.shape[1]))
        sums[np.arange(self.size), self.last] = 1.0
        for start, here in reversed(list(self._steps(self.start))):
            part = sums[self.word[here], self.end[here]] * chance[self.piece[here]]
            np.add.at(sums[:, start], self.word[here], part)
        return sums

    def _steps(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(places, kind="stable")
        values, firsts = np.unique(places[order], return_index=True)
        for value, here in zip(values, np.split(order, firsts[1:]), strict=True):
            yield int(value), here


def _long_word(vocab: Vocabulary, word: str, chance: np.ndarray) -> np.ndarray:
    """Log-likelihoods of one word of any length; only the sums a piece can reach back to are held."""
    logs = np.log(chance)
    sums = np.full((len(word) + 2, chance.shape[1]), -np.inf)
    sums[0] = 0.0
    for end, start, piece in vocab.long_matches(word):
        sums[end] = np.logaddexp(sums[end], sums[start] + logs[piece])
    return sums[-1]


def _long_shares(vocab: Vocabulary, word: str, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces inside one word of any length, and how often each is expected, by sums in logarithms."""
    logs, found = np.log(chance), vocab.long_matches(word)
    ahead, behind = np.full((2, len(word) + 2), -np.inf)
    ahead[0] = behind[-1] = 0.0
    for end, start, piece in found:
        ahead[end] = np.logaddexp(ahead[end], ahead[start] + logs[piece])
    for end, start, piece in sorted(found, key=lambda match: -match[1]):
        behind[start] = np.logaddexp(behind[start], behind[end] + logs[piece])
    ends, starts, pieces = np.array(found).T
    return pieces, np.exp(ahead[starts] + logs[pieces] + behind[ends] - ahead[-1])


class Model:
    """Piece probabilities of each language, and the scores of words met so far."""

    def __init__(self, languages: list[str], chance: np.ndarray, vocabulary_name: str):
        self.languages, self.chance, self.vocabulary_name = languages, chance, vocabulary_name
        self.key = uuid.uuid4().hex
        # Scores of words met lately, and of those met before them.
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))
        self.older: tuple[dict[str, int], np.ndarray] = {}, self.scores

    def _learn(self, words: list[str]) -> None:
        """Put the scores of new words at the end of the table."""
        places, scores = self.older
        again = [w for w in words if w in places]
        rows = [scores[[places[w] for w in again]]]
        fresh = [w for w in words if w not in places] if again else words
        vocab = vocabulary(self.vocabulary_name)
        short = [w for w in fresh if len(w) < SUMMED_LENGTH]
        for first in range(0, len(short), WORDS_AT_ONCE):
            part = short[first : first + WORDS_AT_ONCE]
            lattice = _Lattice(vocab, part)
            rows.append(np.log(lattice.forward(self.chance)[np.arange(len(part)), lattice.last]))
        long = [w for w in fresh if len(w) >= SUMMED_LENGTH]
        rows += [_long_word(vocab, w, self.chance)[None] for w in long]
        first = len(self.places)
        self.places |= {w: first + i for i, w in enumerate(again + short + long)}
        self.scores = np.concatenate([self.scores, *rows])

    def likelihoods(self, texts: list[list[str]]) -> np.ndarray:
        """Log-likelihood of each text (as words) in each language."""
        if len(self.places) > REMEMBERED_WORDS // 2:
            self.older = self.places, self.scores
            self.places, self.scores = {}, self.scores[:0]
        counts = [Counter(words) for words in texts]
        found = [[self.places.get(word) for word in count] for count in counts]
        new: dict[str, None] = {}
        for count, where in zip(counts, found, strict=True):
            if None in where:
                new |= {word: None for word, i in zip(count, where, strict=True) if i is None}
        if new:
            self._learn(list(new))
        sums = np.zeros((len(texts), len(self.languages)))
        for row, (count, where) in enumerate(zip(counts, found, strict=True)):
            if None in where:
                where = [self.places[w] if i is None else i for w, i in zip(count, where, strict=True)]
            if where:
                sums[row] = np.fromiter(count.values(), np.float64, len(where)) @ self.scores[where]
        return sums

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        labels, scores = [], []
        for first in range(0, len(texts), BATCH):
            words = [words_of(text) for text in texts.iloc[first : first + BATCH]]
            if self.languages:
                logs = self.likelihoods(words)
                best = logs.argmax(axis=1)
                sure = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, found in enumerate(words):
                decided = bool(found) and bool(self.languages)
                labels.append(self.languages[best[i]] if decided else UNDECIDED)
                scores.append(float(sure[i]) if decided else 0.0)
        return pd.DataFrame({"lang_pred": labels, "score": scores})


_MODELS: dict[str, Model] = {}


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: a fifth of all keys. Null keys are not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, key: str, text: str, lang: str, rows: int) -> DataFrame:
    """`lang`, `text` of about `rows` rows per language, chosen by a hash of the key."""
    usable = docs.filter(
        column(key).isNotNull() & ~held_out(column(key)) & column(lang).isNotNull() & column(text).isNotNull()
    )
    counts = usable.groupBy(column(lang).alias("lang")).agg(F.count("*").alias("size")).collect()
    if not counts:
        return usable.select(column(lang).alias("lang"), column(text).alias("text"))
    buckets = 1 << 30
    share = F.create_map(
        *[F.lit(x) for r in counts for x in (r["lang"], min(buckets, -(-rows * buckets // r["size"])))]
    )
    chosen = F.pmod(F.xxhash64(column(key).cast("string")), F.lit(buckets)) < share[column(lang)]
    return usable.filter(chosen).select(column(lang).alias("lang"), column(text).alias("text"))


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = TRAIN_ROWS,
    vocabulary_name: str = VOCABULARY,
) -> Model:
    """Piece probabilities from the labelled rows that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    chosen = training_rows(docs, key, text, lang, rows)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["text"].map(words_of)
            yield pd.DataFrame({"lang": batch["lang"], "word": words}).explode("word").dropna()

    counted = stored(
        chosen.mapInPandas(split, "lang string, word string")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .repartition("word"),
        "words",
    )
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    vocab = vocabulary(vocabulary_name)
    size = len(vocab.pieces)
    chance = np.full((size + 1, len(languages)), 1.0 / size)
    chance[size] = UNKNOWN
    for _ in range(ROUNDS if languages else 0):
        sent = spark.sparkContext.broadcast(chance)  # languages x vocabulary

        def expect(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own, total = vocabulary(vocabulary_name), None
            chance = sent.value
            for batch in batches:
                long = batch["word"].str.len() >= SUMMED_LENGTH
                for row in batch[long].itertuples():
                    which = languages.index(row.lang)
                    pieces, share = _long_shares(own, row.word, chance[:, which])
                    added = np.bincount(pieces * len(languages) + which, share * row.n, chance.size)
                    total = added if total is None else total + added
                batch = batch[~long]
                for first in range(0, len(batch), 4096):
                    part = batch.iloc[first : first + 4096]
                    lattice = _Lattice(own, part["word"].tolist())
                    ahead, behind = lattice.forward(chance), lattice.backward(chance)
                    which = part["lang"].map(languages.index).to_numpy()
                    column_of = which[lattice.word]
                    weight = part["n"].to_numpy() / behind[np.arange(len(part)), 0, which]
                    share = (
                        ahead[lattice.word, lattice.start, column_of]
                        * chance[lattice.piece, column_of]
                        * behind[lattice.word, lattice.end, column_of]
                        * weight[lattice.word]
                    )
                    cell = lattice.piece * len(languages) + column_of
                    added = np.bincount(cell, share, chance.size)
                    total = added if total is None else total + added
            if total is not None:
                cells = np.flatnonzero(total)
                yield pd.DataFrame({"cell": cells, "amount": total[cells]})

        expected = counted.mapInPandas(expect, "cell long, amount double")
        sums = expected.groupBy("cell").agg(F.sum("amount").alias("amount")).toPandas()
        counts = np.zeros(chance.size)
        counts[sums["cell"].to_numpy(np.int64)] = sums["amount"]
        counts = counts.reshape(chance.shape)[:size] + SMOOTHING
        chance = np.concatenate([counts / counts.sum(axis=0), chance[size:]])
        sent.destroy()
    return Model(languages, chance, vocabulary_name)


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`doc` (each row as it was) with `guess`: lang_pred and score."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.key, model.languages, model.chance, model.vocabulary_name)
    )

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        key, *parts = sent.value
        only_mine(_MODELS.clear)
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Model(*parts)
        return _MODELS[key].predict(texts)

    return docs.select(whole_row(docs).alias("doc"), guess(column(text)).alias("guess"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    return predicted(docs.select("doc_id", "text"), fit(docs)).select(
        "doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "guess.lang_pred", "guess.score"
    )


def known_language(docs: DataFrame) -> DataFrame:
    """The rows whose language is decided with a score of `MIN_SCORE` or more, as they were."""
    sure = predicted(docs, fit(docs)).filter(
        (F.col("guess.lang_pred") != UNDECIDED) & (F.col("guess.score") >= MIN_SCORE)
    )
    return sure.select("doc.*")
