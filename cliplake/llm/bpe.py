"""Byte-level BPE encoding by speculation: propose greedily, verify pairs, merge only what fails.

A text is cut at the added tokens of the model, then into words by the model's pattern.  For every
new word the longest vocabulary entries are laid end to end.  Such a proposal is the true encoding
exactly when no merge would ever cross the border of two neighbours.  While a token is built up from
its bytes, its last piece runs through the right spine of its merge tree and its first piece
through the left spine; each piece lives from its own merge until its parent's.  A merge of rank m
crosses the border if it joins a right-spine piece and a left-spine piece that both still live at m
(of equal ranks the merge further left comes first, so the left piece must live beyond m, the right
one may end with it).  This is tested for all new neighbour pairs at once, with arrays; the
answers are remembered per pair.  A word with a failing pair is merged exactly, with a heap.

Only models whose merges are in rank order, one per token, can be checked this way: ``Model`` looks.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

# Fixed value of the format: how byte-level models cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words and pairs that a task remembers before it starts anew.
REMEMBERED_WORDS = 400_000
REMEMBERED_PAIRS = 4_000_000
#: Longest word, in bytes, that is merged together with others.
SHORT = 64
#: Longest text, in characters, whose words are listed at once.
LISTED = 1 << 22
#: Tokens whose bytes are gathered at once.
SPELT = 1 << 17
NEVER = np.iinfo(np.int32).max

ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([T.StructField("text", T.StringType())])


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Model:
    """Bytes, merges and added tokens of a byte-level BPE model file (plain data, for broadcasts)."""

    def __init__(self, content: str) -> None:
        told = json.loads(content)
        bpe, cutter = told["model"], told["pre_tokenizer"]
        plain = told["normalizer"] is None and cutter["type"] == "ByteLevel" and cutter["use_regex"]
        if not plain or cutter["add_prefix_space"] or bpe.get("dropout") or bpe.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE model")
        names = byte_names()
        self.added = {token["content"]: token["id"] for token in told["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        ids = bpe["vocab"]
        size = max([*ids.values(), *self.added.values()], default=-1) + 1
        #: Bytes of every token, None for ids that no token has.
        self.bytes: list[bytes | None] = [None] * size
        for name, number in ids.items():
            self.bytes[number] = bytes(names[c] for c in name)
        for content, number in self.added.items():
            self.bytes[number] = content.encode()
        pairs = [p.split(" ") if isinstance(p, str) else p for p in bpe["merges"]]
        #: (left, right, merged) by rank.
        self.merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int32).reshape(-1, 3)
        self.single = np.full(256, -1, np.int32)
        for character, byte in names.items():
            self.single[byte] = ids.get(character, -1)
        if (self.single < 0).any():
            raise ValueError("a byte has no token")


def shared_model(spark: SparkSession, path: str) -> Broadcast:
    """The model file (a few MB) read on the driver, for all tasks."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(Model(file.read()))


class Merges:
    """Pair ranks, merge trees and the test of neighbours, as arrays."""

    def __init__(self, model: Model) -> None:
        left, right, merged = model.merges.T.astype(np.int64)
        self.size = n = len(model.bytes)
        ranks = np.arange(len(merged), dtype=np.int32)
        made = np.full(n, -1, np.int32)
        made[merged] = ranks
        # Trees need one merge for each token, after those of its parts.
        self.regular = len(np.unique(merged)) == len(merged) and bool(
            ((made[left] < ranks) & (made[right] < ranks)).all()
        )
        keys = left * n + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], ranks[order]
        self.merged = merged.astype(np.int32)
        self.table = dict(zip(keys.tolist(), ranks.tolist(), strict=True))
        self.made = made
        self.spines = [self._spine(part, made) for part in (right, left)]
        #: Tokens that the merges build from their own bytes without crossing inside.
        self.sound = np.zeros(n, bool)
        self.sound[model.single] = True
        clean = self.unbroken(left, right, ranks)
        for rank, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), merged.tolist(), strict=True)):
            self.sound[c] = clean[rank] and self.sound[a] and self.sound[b]

    def _spine(self, part: np.ndarray, made: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pieces at the edge of every token, outermost first, and the rank that ends each."""
        piece, end = np.arange(self.size, dtype=np.int64), np.full(self.size, NEVER, np.int32)
        levels = []
        while (piece >= 0).any():
            levels.append((piece, end))
            rank = np.where(piece >= 0, made[piece], -1)
            end = np.where(rank >= 0, rank, -1).astype(np.int32)
            piece = np.where(rank >= 0, part[rank], -1) if len(part) else np.full(self.size, -1)
        return levels

    def unbroken(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (of a rank below ``limit``) crosses the border of tokens a and b."""
        good = np.ones(len(a), bool)
        if not len(self.keys):
            return good
        for x_of, x_end in self.spines[0]:
            x, xe = x_of[a], x_end[a]
            some = np.flatnonzero(good & (x >= 0))
            if not len(some):
                break
            for y_of, y_end in self.spines[1]:
                some = some[y_of[b[some]] >= 0]
                if not len(some):
                    break
                key = x[some] * self.size + y_of[b[some]]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = self.ranks[at]
                bad = (self.keys[at] == key) & (rank < xe[some]) & (rank <= y_end[b[some]])
                if limit is not None:
                    bad &= rank < limit[some]
                good[some[bad]] = False
        return good

    def ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def exact_all(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short words at once: in each round every word makes its next merge.

        Takes and gives flat tokens and the size of each word.
        """
        tokens, sizes = tokens.astype(np.int64), sizes.copy()
        if not len(self.keys) or not len(tokens):
            return tokens.astype(np.int32), sizes
        word = np.repeat(np.arange(len(sizes)), sizes)
        done_words, done_tokens = [], []
        ranks = np.full(len(tokens), NEVER, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        ranks[inner] = self.ranked(tokens[inner], tokens[inner + 1])
        while len(tokens):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(starts, append=len(word)))
            open_ = least < NEVER
            if not open_.all():
                done_words.append(word[~open_])
                done_tokens.append(tokens[~open_])
                tokens, word, ranks, least = tokens[open_], word[open_], ranks[open_], least[open_]
                if not len(tokens):
                    break
            lowest = np.flatnonzero(ranks == least)
            left = lowest[np.diff(word[lowest], prepend=-1) != 0]
            tokens[left] = self.merged[ranks[left]]
            # The right part goes; the pairs of the merged token are looked up again.
            ranks[left] = NEVER
            kept = np.ones(len(tokens), bool)
            kept[left + 1] = False
            left = (np.cumsum(kept) - 1)[left]
            tokens, word, ranks = tokens[kept], word[kept], ranks[kept]
            for at in (left - 1, left):
                at = at[(at >= 0) & (at + 1 < len(word))]
                at = at[word[at] == word[at + 1]]
                ranks[at] = self.ranked(tokens[at], tokens[at + 1])
        word, tokens = np.concatenate(done_words), np.concatenate(done_tokens)
        order = np.argsort(word, kind="stable")
        return tokens[order].astype(np.int32), np.bincount(word, minlength=len(sizes))

    def exact(self, tokens: list[int]) -> list[int]:
        """The same for one word of any length: the lowest rank, then the leftmost pair, from a heap."""
        n, size, rank_of = len(tokens), self.size, self.table
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = rank_of.get(tokens[i] * size + tokens[i + 1])
            if rank is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        merged = self.merged
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or rank_of.get(tokens[i] * size + tokens[j]) != rank:
                continue
            tokens[i], tokens[j] = int(merged[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = rank_of.get(tokens[i] * size + tokens[k])
                if found is not None:
                    heapq.heappush(heap, (found, i))
            h = before[i]
            if h >= 0:
                found = rank_of.get(tokens[h] * size + tokens[i])
                if found is not None:
                    heapq.heappush(heap, (found, h))
        return [token for token in tokens if token >= 0]


class Trie:
    """Longest vocabulary entry from every byte of a buffer, all bytes at once."""

    def __init__(self, entries: list[tuple[bytes, int]]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        accept = [-1]
        for entry, token in entries:
            node = 0
            for byte in entry:
                key = (node, byte)
                if key not in nodes:
                    nodes[key] = len(accept)
                    accept.append(-1)
                node = nodes[key]
            accept[node] = token
        keys = np.array([node * 256 + byte for node, byte in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.accept = np.array(accept, np.int32)

    def longest(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token and length of the longest entry at each byte; ``ends`` is where its word ends."""
        token, length = np.full(len(data), -1, np.int32), np.ones(len(data), np.int64)
        at, node, depth = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(at):
            key = node * 256 + data[at + depth]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[found] == key
            at, node, depth = at[goes], self.nodes[found[goes]], depth + 1
            ended = self.accept[node] >= 0
            token[at[ended]] = self.accept[node[ended]]
            length[at[ended]] = depth
            inside = at + depth < ends[at]
            at, node = at[inside], node[inside]
        return token, length


class Encoder:
    """Encodes texts; remembers words and neighbour pairs."""

    def __init__(self, model: Model) -> None:
        self.model, self.merges = model, Merges(model)
        # An added token is found in the text first, and is no entry of words.
        added = set(model.added.values())
        entries = [(b, i) for i, b in enumerate(model.bytes) if b and i not in added]
        self.trie = Trie(entries)
        self.cutter = regex.compile(PATTERN)
        by_length = sorted(filter(None, model.added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.pair_keys, self.pair_good = np.empty(0, np.int64), np.empty(0, bool)
        #: Words proposed and words whose proposal failed, for tests and tuning.
        self.proposed = self.failed = 0
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def _segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Text between added tokens, and the added token that follows."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield text[at : found.start()], self.model.added[found[0]]
            at = found.end()
        yield text[at:], None

    def _lists(self, segment: str) -> Iterator[list[str]]:
        """The words of a segment, of a very long one in parts."""
        if len(segment) <= LISTED:
            yield self.cutter.findall(segment)
            return
        found = self.cutter.finditer(segment)
        while part := [match[0] for match in islice(found, 1 << 18)]:
            yield part

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each has."""
        out, counts = [], np.zeros(len(texts), np.int64)
        pending: list[str] = []
        owners: list[int] = []
        lengths: list[int] = []

        def flush() -> None:
            ids, sizes = self._words(pending)
            out.append(ids)
            np.add.at(counts, np.repeat(np.array(owners, np.int64), lengths), sizes)
            pending.clear(), owners.clear(), lengths.clear()

        for row, text in enumerate(texts):
            for segment, token in self._segments(text) if text else ():
                for part in self._lists(segment):
                    pending.extend(part)
                    owners.append(row)
                    lengths.append(len(part))
                    if len(pending) > 1 << 18:
                        flush()
                if token is not None:
                    flush()
                    out.append(np.array([token], np.int32))
                    counts[row] += 1
        flush()
        return np.concatenate(out), counts

    def _words(self, listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the listed words, flat, and how many each has."""
        if len(self.known) > REMEMBERED_WORDS:
            self._forget()
        new = list(set(listed).difference(self.known))
        if new:
            self._learn(new)
        if not listed:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        which = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))
        starts, sizes = self.bounds[which], self.bounds[which + 1] - self.bounds[which]
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))], sizes

    def _learn(self, new: list[str]) -> None:
        raw = [word.encode("utf-8", "replace") for word in new]
        edges = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(word) for word in raw], out=edges[1:])
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.repeat(edges[1:], np.diff(edges))
        token, length = self.trie.longest(data, ends)
        # Greedy chains: from the start of each word to the byte after each match.
        step, chain, at, total = length.tolist(), [], 0, len(data)
        while at < total:
            chain.append(at)
            at += step[at]
        places = np.array(chain, np.int64)
        tokens = token[places]
        firsts = np.searchsorted(places, edges)
        word = np.repeat(np.arange(len(new)), np.diff(firsts))
        bad = ~self.merges.sound[tokens] if self.merges.regular else np.ones(len(tokens), bool)
        if len(tokens) > 1 and self.merges.regular:
            inner = np.flatnonzero(word[1:] == word[:-1])
            inner = inner[~(bad[inner] | bad[inner + 1])]
            bad[inner] |= ~self._compatible(tokens[inner], tokens[inner + 1])
        failing = np.unique(word[bad])
        self.proposed += len(new)
        self.failed += len(failing)
        tokens, sizes = self._repaired(tokens, np.diff(firsts), failing, data, edges)
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, tokens))

    def _repaired(self, tokens, sizes, failing, data, edges) -> tuple[np.ndarray, np.ndarray]:
        """Put the exact tokens of the failing words in place of their proposals."""
        long = np.diff(edges)[failing] > SHORT
        short = failing[~long]
        lengths = edges[short + 1] - edges[short]
        inside = np.repeat(edges[short] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        found, counts = self.merges.exact_all(self.model.single[data[inside]], lengths)
        right = np.ones(len(sizes), bool)
        right[failing] = False
        flat = [tokens[np.repeat(right, sizes)], found]
        owner = [np.repeat(np.flatnonzero(right), sizes[right]), np.repeat(short, counts)]
        sizes = sizes.copy()
        sizes[short] = counts
        for word in failing[long].tolist():
            ids = self.merges.exact(self.model.single[data[edges[word] : edges[word + 1]]].tolist())
            flat.append(np.array(ids, np.int32))
            owner.append(np.full(len(ids), word))
            sizes[word] = len(ids)
        return np.concatenate(flat)[np.argsort(np.concatenate(owner), kind="stable")], sizes

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pairs stand; each pair is tested once."""
        if not len(a):
            return np.ones(0, bool)
        keys, back = np.unique(a.astype(np.int64) * self.merges.size + b, return_inverse=True)
        at = np.searchsorted(self.pair_keys, keys)
        met = np.zeros(len(keys), bool)
        inside = at < len(self.pair_keys)
        met[inside] = self.pair_keys[at[inside]] == keys[inside]
        good = np.ones(len(keys), bool)
        good[met] = self.pair_good[at[met]]
        fresh = keys[~met]
        if len(fresh):
            good[~met] = self.merges.unbroken(*np.divmod(fresh, self.merges.size))
            if len(self.pair_keys) > REMEMBERED_PAIRS:
                self.pair_keys, self.pair_good, at = fresh, good[~met], None
            else:
                self.pair_keys = np.insert(self.pair_keys, at[~met], fresh)
                self.pair_good = np.insert(self.pair_good, at[~met], good[~met])
        return good[back]


class Spelling:
    """Bytes of all tokens, end to end, from which texts are gathered without an object per token."""

    def __init__(self, model: Model) -> None:
        # The last entry, of no bytes, stands for ids that the model does not have.
        known = [*(spelt or b"" for spelt in model.bytes), b""]
        self.data = np.frombuffer(b"".join(known), np.uint8)
        self.lengths = np.fromiter(map(len, known), np.int64, len(known))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def texts(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts that flat ids spell; each text has as many ids as ``sizes`` says."""
        ids = np.where((ids >= 0) & (ids < len(self.lengths)), ids, len(self.lengths) - 1)
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.lengths[ids], out=ends[1:])
        spelt = np.empty(ends[-1], np.uint8)
        for at in range(0, len(ids), SPELT):
            some = ids[at : at + SPELT]
            lo, hi = ends[at], ends[at + len(some)]
            shift = np.repeat(self.starts[some] - ends[at : at + len(some)], self.lengths[some])
            spelt[lo:hi] = self.data[shift + np.arange(lo, hi)]
        bounds = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        raw, cuts = memoryview(spelt), ends[bounds].tolist()
        return [str(raw[lo:hi], "utf-8", "replace") for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


_encoders: dict[int, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    """One encoder per Python worker and model."""
    found = _encoders.get(id(shared.value))
    if found is None:
        found = _encoders[id(shared.value)] = Encoder(shared.value)
    return found


def encode(docs: DataFrame, model: Broadcast, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``found`` (ids) for every row.

    Null and empty texts have no ids.  Strings of added tokens inside a text become those tokens.
    Whole texts are encoded, repeated rows each; an empty table gives no rows.  The kept columns
    travel in one struct, so any names may occur.  A word of n bytes costs n log n at most.
    """

    def found(column: pa.Array) -> pa.StructArray:
        ids, counts = _encoder(model).encode(column.to_pylist())
        return pa.StructArray.from_arrays([words.list_column(pa.array(ids), counts)], ["ids"])

    return words.per_text(docs, text, ENCODED, found, keep)


def decode(encoded: DataFrame, model: Broadcast, ids: str = "ids", limit: int = 1 << 21) -> DataFrame:
    """The input's columns as ``row``, and ``found`` with the text that its ids spell.

    Bytes that form no character become U+FFFD.  A null list and an empty one give an empty text;
    null ids and ids that the model does not have are passed over.
    """
    schema = T.StructType(
        [T.StructField("row", T.StructType(encoded.schema.fields)), T.StructField("found", DECODED)]
    )
    packed = encoded.select(
        F.struct(*[F.col(f"`{name}`") for name in encoded.columns]).alias("row"),
        F.col(f"`{ids}`").cast("array<int>").alias("ids"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(model.value)
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes.astype(np.int64)) // limit
            edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                flat = pc.fill_null(lists.slice(lo, hi - lo).flatten(), -1).to_numpy(zero_copy_only=False)
                texts = spelling.texts(flat, sizes[lo:hi])
                spelt = pa.StructArray.from_arrays([pa.array(texts, pa.string())], ["text"])
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), spelt], ["row", "found"])

    return packed.mapInArrow(run, schema)
