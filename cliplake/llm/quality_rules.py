"""Quality rules: plain signals of a text, and a line model that tells content from boilerplate.

The line model is a linear-chain conditional random field with two labels per line.  Its weights are
fitted on a bounded sample of labelled documents (``SAMPLE`` documents of at most ``SAMPLE_BYTES``
bytes and ``SAMPLE_LINES`` line breaks, the smallest hashes of their ids): all lines of a document of low quality count as boilerplate,
those of a good one as content, repeats of earlier lines as boilerplate.  Viterbi decoding then
labels the lines of every whole text, and the share of words in content lines decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

SAMPLE, SAMPLE_BYTES, SAMPLE_LINES = 2000, 20_000, 500
#: Share of words in content lines from which a text is kept.
CONTENT_SHARE = 0.5
WINDOW = 3

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SHOUT = _BYTES == 33
_FIRST_BYTE = (_BYTES & 0xC0) != 0x80

FEATURES = (
    "always", "one or two words", "up to five words", "symbols for a tenth of the words",
    "symbols for half of the words", "mostly capitals", "many digits", "ends a sentence",
    "repeats a line", "mostly repeated windows", "exclamation marks for half of the words",
    "very long words",
)

FOUND = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")]
    + [T.StructField("lines", T.ArrayType(T.LongType()))]
)


def _covered(hashes: np.ndarray, rows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Which words lie in a window of WINDOW words that its text holds twice or more."""
    windows = words.shingles(hashes, WINDOW)
    n = len(windows)
    out = np.zeros(len(hashes), bool)
    if not n:
        return out
    inside = np.flatnonzero(np.arange(n) + WINDOW <= firsts[rows[:n] + 1])
    bits = max(1, int(len(firsts)).bit_length())
    keys = (rows[inside].astype(np.uint64) << np.uint64(64 - bits)) | (windows[inside] >> np.uint64(bits))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    at = inside[counts[inverse] > 1]
    for step in range(WINDOW):
        out[at + step] = True
    return out


def _inside(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def signals(column: pa.Array) -> dict[str, np.ndarray]:
    """Signals by row, and of each line: its row, its number of words and its features as bits."""
    data, bounds = words.utf8(column)
    hashes, starts, ends = words.runs(data, bounds, words.NOT_SPACE)
    firsts = words.row_ranges(starts, bounds)
    rows = words.row_of(firsts)
    covered = _covered(hashes, rows, firsts)
    line_hash, line_start, line_end = words.runs(data, bounds, words.IN_LINE)
    in_line = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    full = in_line > 0
    line_hash, line_start, line_end, n = line_hash[full], line_start[full], line_end[full], in_line[full]
    line_firsts = words.row_ranges(line_start, bounds)
    line_rows = words.row_of(line_firsts)
    repeat = np.zeros(len(n), bool)
    if len(n):
        order = np.lexsort((line_start, line_hash, line_rows))
        same = (line_hash[order][1:] == line_hash[order][:-1]) & (line_rows[order][1:] == line_rows[order][:-1])
        repeat[order[1:]] = same
    first_word = np.searchsorted(starts, line_start)
    repeated = _inside(covered, first_word, first_word + n)
    of_line = lambda table: _inside(table[data], line_start, line_end)
    symbols, shouts, digits = of_line(_SYMBOL), of_line(_SHOUT), of_line(_DIGIT)
    upper, lower = of_line(_UPPER), of_line(_LOWER)
    chars = of_line(_FIRST_BYTE & words.NOT_SPACE)
    last = data[ends[first_word + n - 1] - 1] if len(n) else np.empty(0, np.uint8)
    bits = [
        np.ones(len(n), bool), n <= 2, n <= 5, 10 * symbols >= n, 2 * symbols >= n, upper > lower,
        3 * digits > chars, np.isin(last, list(b".!?")), repeat, 2 * repeated > n, 2 * shouts >= n,
        chars > 12 * n,
    ]
    mask = np.zeros(len(n), np.int64)
    for i, bit in enumerate(bits):
        mask |= bit.astype(np.int64) << i
    in_rows = lambda table: _inside(table[data], bounds[:-1], bounds[1:])
    return {
        "n_words": np.diff(firsts),
        "word_chars": in_rows(_FIRST_BYTE & words.NOT_SPACE),
        "n_symbols": in_rows(_SYMBOL),
        "n_dup_lines": words.sums_by_row(repeat, line_firsts),
        "n_repeat_words": words.sums_by_row(covered, firsts),
        "line_firsts": line_firsts,
        "line_words": n,
        "line_features": mask,
    }


class LineModel:
    """Weights of the features for "content" against "boilerplate", and of the four transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray) -> None:
        self.weights, self.transitions = weights, transitions
        bits = np.arange(1 << len(FEATURES))[:, None] >> np.arange(len(FEATURES)) & 1
        #: The weight of every combination of features.
        self.by_mask = (bits @ weights).tolist()

    def decode(self, masks: list[int]) -> list[bool]:
        """Best label sequence (True: content); content wins ties."""
        (bb, bc), (cb, cc) = self.transitions.tolist()
        plain, content, back = 0.0, 0.0, []
        for i, mask in enumerate(masks):
            if i:
                from_plain = (plain + bb > content + cb, plain + bc > content + cc)
                plain, content = max(plain + bb, content + cb), max(plain + bc, content + cc)
                back.append(from_plain)
            content += self.by_mask[mask]
        labels = [content >= plain]
        for from_plain in reversed(back):
            labels.append(not from_plain[1 if labels[-1] else 0])
        return labels[::-1]


def fit_lines(texts: list[tuple[list[int], list[int]]], rounds: int = 150, rate: float = 0.1) -> LineModel:
    """Maximum likelihood (with a small quadratic penalty) of (feature bits, labels) sequences.

    Texts go from long to short, so that step t is on the first ``active[t]`` of them; features are
    summed by combination.  Memory is a few numbers per text and line of the longest one.
    """
    texts = sorted(((m, y) for m, y in texts if m), key=lambda text: -len(text[0]))
    k = len(FEATURES)
    if not texts:
        return LineModel(np.zeros(k), np.zeros((2, 2)))
    lengths = np.array([len(m) for m, _ in texts])
    longest, n = int(lengths[0]), len(texts)
    masks = np.zeros((longest, n), np.int64)
    gold = np.zeros((longest, n), np.int64)
    real = np.arange(longest)[:, None] < lengths
    for i, (m, y) in enumerate(texts):
        masks[: len(m), i], gold[: len(m), i] = m, y
    active = real.sum(1).tolist()
    combined = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)
    step = real[1:]
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (gold[:-1][step], gold[1:][step]), 1)
    seen = np.bincount(masks[real], gold[real], 1 << k) @ combined
    last = (lengths - 1, np.arange(n))
    theta = np.zeros(k + 4)
    mean, spread = np.zeros(k + 4), np.zeros(k + 4)
    for turn in range(1, rounds + 1):
        weights, trans = theta[:k], theta[k:].reshape(2, 2)
        # Scores of boilerplate and content by line and text.
        emit = np.zeros((2, longest, n))
        emit[1] = (combined @ weights)[masks]
        alpha, beta = emit.copy(), np.zeros_like(emit)
        for t in range(1, longest):
            on = slice(0, active[t])
            for to in (0, 1):
                alpha[to, t, on] += np.logaddexp(alpha[0, t - 1, on] + trans[0, to], alpha[1, t - 1, on] + trans[1, to])
        for t in range(longest - 2, -1, -1):
            on = slice(0, active[t + 1])
            ahead = emit[:, t + 1, on] + beta[:, t + 1, on]
            for from_ in (0, 1):
                beta[from_, t, on] = np.logaddexp(trans[from_, 0] + ahead[0], trans[from_, 1] + ahead[1])
        total = np.logaddexp(alpha[0][last], alpha[1][last])
        node = np.exp(alpha[1] + beta[1] - total)
        expected = np.bincount(masks[real], node[real], 1 << k) @ combined
        edges = np.array([
            [np.exp(alpha[a, :-1] + trans[a, b] + emit[b, 1:] + beta[b, 1:] - total)[step].sum() for b in (0, 1)]
            for a in (0, 1)
        ])
        gradient = np.concatenate((seen - expected, (pairs - edges).ravel())) / real.sum() - 1e-4 * theta
        # Adam, upwards.
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**turn)) / (np.sqrt(spread / (1 - 0.999**turn)) + 1e-9)
    return LineModel(theta[:k], theta[k:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> LineModel:
    """Fit the line model on the bounded sample; without labelled rows every line is content."""
    known = labels.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").alias("label")).where(
        "label in (0, 1) and _id is not null"
    )
    # Twice as many ids as documents, as some texts are too long.
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(2 * SAMPLE)
    own = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text")).where(
        (F.octet_length("text") <= SAMPLE_BYTES)
        & (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) <= SAMPLE_LINES)
    )
    sample = own.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "_id", "text").limit(SAMPLE)
    rows = sample.select("text", "label").collect()
    if not rows:
        return LineModel(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    of = signals(pa.array([row["text"] for row in rows], pa.string()))
    sequences, masks = [], of["line_features"].tolist()
    repeat = 1 << FEATURES.index("repeats a line")
    for row, lo, hi in zip(rows, of["line_firsts"][:-1], of["line_firsts"][1:], strict=True):
        own_masks = masks[lo:hi]
        sequences.append((own_masks, [int(row["label"] == 1 and not m & repeat) for m in own_masks]))
    return fit_lines(sequences)


def judged(docs: DataFrame, model: Broadcast, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns), the signals, base_failed, content_share and kept for every row.

    A null or empty text has no words and fails.  Lines end at line breaks, lines without a word have
    no label; equal texts get equal verdicts; whole texts are read; an empty table gives no rows.
    """

    def found(column: pa.Array) -> pa.StructArray:
        of, line_model = signals(column), model.value
        masks = of["line_features"].tolist()
        labels: list[bool] = []
        for lo, hi in zip(of["line_firsts"][:-1].tolist(), of["line_firsts"][1:].tolist(), strict=True):
            if lo < hi:
                labels += line_model.decode(masks[lo:hi])
        flags = np.array(labels, bool)
        content = words.sums_by_row(of["line_words"] * flags, of["line_firsts"])
        values = [*(of[name] for name in FOUND.names[:5]), content]
        lines = words.list_column(pa.array(flags.astype(np.int64)), np.diff(of["line_firsts"]))
        return pa.StructArray.from_arrays([*(pa.array(v, pa.int64()) for v in values), lines], FOUND.names)

    n = F.col("found.n_words")
    failed = (n < 50) | (100 * F.col("found.n_repeat_words") > 50 * n)
    share = F.when(n > 0, F.col("found.content_words") / n).otherwise(F.lit(0.0))
    return words.per_text(docs, text, FOUND, found, keep, 4 << 20).select(
        "row",
        *[F.col("found")[name].alias(name) for name in FOUND.names[:5]],
        failed.alias("base_failed"),
        share.alias("content_share"),
        (~failed & (share >= CONTENT_SHARE)).alias("kept"),
        F.col("found.lines").alias("line_labels"),
    )
