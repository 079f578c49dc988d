"""Token counts of a unigram tokenizer, without tokens: a Viterbi search that carries counts only.

The tokenizer: blanks become ``SPACE``, one is put in front unless the text begins with it, and the
text is cut before each; every such word is split into the vocabulary pieces of the highest summed
score.  An Aho-Corasick automaton lists all pieces in a word by their end, the longest first.  Of
equal sums the piece that begins first wins, sums are added from the left in double precision, and
a character that is no piece costs the lowest score less ``UNKNOWN_PENALTY`` and counts one token
per UTF-8 byte (one in all for neighbours, if the vocabulary has no byte pieces): the rules of the
public unigram tokenizers.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import words

# Fixed values of the tokenizer format.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers before it starts anew.
REMEMBERED = 300_000

FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a public sentencepiece model file, in the order of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def shared_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary read on the driver (a file of a few MB) for all tasks."""
    return spark.sparkContext.broadcast(vocabulary(path))


class Counter(dict):
    """Token count of a word, computed when first asked for; forgets all when it is full."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        # As for the tokenizer, the last of equal pieces counts.
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.by_byte = all(f"<0x{byte:02X}>" in names for byte in range(256))

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = count = self.count(word)
        return count

    def count(self, word: str) -> int:
        n = len(word)
        best, tokens = [0.0] * (n + 1), [0] * (n + 1)
        # Whether the best path to here ends in an unknown character.
        strange = [False] * (n + 1)
        done, top, single = 0, None, False

        def close(end: int) -> None:
            """Offer the single unknown character that ends here, after all pieces."""
            nonlocal top
            if not single and (top is None or self.unknown + best[end - 1] > top):
                top = self.unknown + best[end - 1]
                if self.by_byte:
                    more = len(word[end - 1].encode())
                else:
                    more = 0 if strange[end - 1] else 1
                tokens[end], strange[end] = tokens[end - 1] + more, True
            best[end] = top

        for last, (length, score) in self.automaton.iter(word) if n else ():
            end = last + 1
            while done < end - 1:
                done += 1
                close(done)
                top, single = None, False
            start = end - length
            candidate = score + best[start]
            if top is None or candidate > top:
                top, tokens[end], strange[end] = candidate, tokens[start] + 1, False
            single = single or length == 1
        while done < n:
            done += 1
            close(done)
            top, single = None, False
        return tokens[n]


def tokens_of(counter: Counter, text: str | None) -> tuple[int, int]:
    """Numbers of words and tokens of a text."""
    if not text:
        return 0, 0
    marked = text.replace(" ", SPACE)
    parts = marked.split(SPACE)
    if marked.startswith(SPACE):
        parts = parts[1:]
    return len(parts), sum([counter[SPACE + part] for part in parts])


_counters: dict[int, Counter] = {}


def token_counts(
    docs: DataFrame, pieces: Broadcast, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``row`` (the kept columns) and ``found`` (n_words, n_tokens) for every row.

    Null and empty texts have no words and no tokens.  Whole texts are counted; a word is searched in
    time linear in its length.  Repeated rows are counted each, an empty table gives no rows.
    """

    def found(column: pa.Array) -> pa.StructArray:
        # One automaton per Python worker.
        counter = _counters.get(id(pieces.value))
        if counter is None:
            counter = _counters[id(pieces.value)] = Counter(pieces.value)
        counts = [tokens_of(counter, text) for text in column.to_pylist()]
        grid = np.array(counts, np.int64).reshape(-1, 2)
        return pa.StructArray.from_arrays([pa.array(grid[:, 0]), pa.array(grid[:, 1])], FOUND.names)

    return words.per_text(docs, text, FOUND, found, keep)
