"""BPE encoding and decoding with a tokenizer file of word-end BPE kind.

A word's symbols sit in a linked row; a segment tree over the adjacent pairs
holds ``rank * width + position`` per pair, so its root is always the leftmost
lowest-ranked merge. A merge changes at most three leaves (the merged pair and
its two neighbours), each in O(log n), until the root says that no pair is
mergeable. The trees of many words of like length are rows of one array, and
every step merges once in each of them; a word too long for that has a tree of
its own. A worker keeps the words that it has met in two tables of bounded
size: when the newer is full it becomes the older, from which words that are met
again move to the new one, so frequent words are merged once. Texts of any
length are handled whole, a part of some thousand words at a time.

Defined results: a null text encodes as the empty text (no ids) and decodes to
the empty string; ties of rank merge the leftmost pair first; repeated rows
and extra columns pass through unchanged (an output name that the input has
already is refused with ``ValueError``); an empty table gives an empty table.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CACHED = 300_000      # words, and pieces between spaces, in either of a worker's two tables
MAX_LETTERS = 24 << 20    # characters of them
ROW_SYMBOLS = 65          # longest word, in symbols, whose tree is a row of an array
ROWS_SYMBOLS = 1 << 20    # symbols, padding included, of the rows that are merged together
PART_CHARS = 1 << 20      # characters of text that are cut into pieces at a time
PART_ROWS = 1000          # texts taken from an Arrow batch at a time
NONE = 1 << 62            # a leaf or root without a mergeable pair
SEPARATORS = "\x1c\x1d\x1e\x1f"   # white space to str.split, but not to the word pattern

#: The byte-level alphabet (printable Latin-1 bytes stand for
#: themselves, the others for 256, 257, ... in order).
PRINTABLE = (range(ord("!"), ord("~") + 1), range(ord("¡"), ord("¬") + 1), range(ord("®"), ord("ÿ") + 1))


def byte_alphabet() -> list[str]:
    kept = set(chain(*PRINTABLE))
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in kept else chr(256 + extra))
        extra += b not in kept
    return out


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to ``symbols``, always the leftmost of the lowest rank.

    ``ranks`` maps a pair of symbols to (rank, merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    get = ranks.get
    width = 1 << (n - 2).bit_length() if n > 2 else 1     # leaves: one for each adjacent pair
    none = NONE
    tree = [none] * (2 * width)
    for i in range(n - 1):
        found = get((symbols[i], symbols[i + 1]))
        if found is not None:
            tree[width + i] = found[0] * width + i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    if tree[1] == none:
        return symbols
    symbols = list(symbols)
    after = list(range(1, n + 1))                          # next live symbol; n ends the row
    before = list(range(-1, n - 1))

    def put(leaf: int, value: int) -> None:
        k = width + leaf
        if tree[k] == value:
            return
        tree[k] = value
        while k > 1:
            other = tree[k ^ 1]
            if other < value:
                value = other
            k >>= 1
            if tree[k] == value:
                return
            tree[k] = value

    while (root := tree[1]) != none:
        i = root % width
        j = after[i]
        symbols[i] = get((symbols[i], symbols[j]))[1]
        nxt = after[i] = after[j]
        symbols[j] = -1
        if j < n - 1:
            put(j, none)
        if nxt < n:
            before[nxt] = i
            found = get((symbols[i], symbols[nxt]))
            put(i, none if found is None else found[0] * width + i)
        else:
            put(i, none)
        prev = before[i]
        if prev >= 0:
            found = get((symbols[prev], symbols[i]))
            put(prev, none if found is None else found[0] * width + prev)
    return [s for s in symbols if s >= 0]


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count places) of every span, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class Merges:
    """Merge rules as sorted arrays, for rows of words at once."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 20 | b for a, b in ranks], np.int64)
        order = np.argsort(keys)
        values = np.array(list(ranks.values()), np.int64).reshape(-1, 2)
        self.keys = np.append(keys[order], 1 << 62)
        self.rank = np.append(values[order, 0], 0)
        self.made = np.zeros(int(values[:, 0].max()) + 1 if len(values) else 1, np.int64)
        self.made[values[:, 0]] = values[:, 1]

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """rank * width + place of the pairs; NONE where a pair has no rule
        or its right symbol is missing (-1)."""
        key = (left << 20) | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (right >= 0), self.rank[at] * width + place, NONE)

    def rows(self, symbols: np.ndarray) -> np.ndarray:
        """Merge every row of ``symbols`` (padded with -1); merged symbols
        stand at the place of their first, -1 elsewhere."""
        count, n = symbols.shape
        width = 1 << max(0, (n - 2).bit_length())
        row = width + 2                                    # one place beyond the last symbol, and one for "none before"
        s = np.full((count, row), -1, np.int64)
        s[:, :n] = symbols
        tree = np.full((count, 2 * width), NONE, np.int64)
        place = np.arange(width)
        tree[:, width:] = np.where(s[:, :width] >= 0, self.leaves(s[:, :width], s[:, 1:width + 1], place, width), NONE)
        for level in range(width.bit_length() - 2, -1, -1):
            at = 1 << level
            tree[:, at:2 * at] = np.minimum(tree[:, 2 * at:4 * at:2], tree[:, 2 * at + 1:4 * at:2])
        after = np.broadcast_to(np.minimum(np.arange(1, row + 1), width + 1), (count, row)).ravel().copy()
        before = np.broadcast_to(np.arange(-1, row - 1) % row, (count, row)).ravel().copy()
        s, tree = s.ravel(), tree.ravel()
        live = np.arange(count)
        while True:
            root = tree[live * (2 * width) + 1]
            go = root != NONE
            live, root = live[go], root[go]
            if not len(live):
                return s.reshape(count, row)
            base, trunk = live * row, live * (2 * width)
            i = root & (width - 1)
            j = after[base + i]
            merged = self.made[root // width]
            s[base + i], s[base + j] = merged, -1
            k = after[base + j]
            after[base + i] = k
            before[base + k] = i
            h = before[base + i]                           # row - 1 where none is before: its symbol is -1
            gone = np.minimum(j, width - 1)
            changes = [(gone, np.where(j < width, NONE, tree[trunk + width + gone])),
                       (i, self.leaves(merged, s[base + k], i, width))]
            left = s[base + h]
            some = left >= 0
            prev = np.where(some, h, i)
            changes.append((prev, np.where(some, self.leaves(left, merged, prev, width), changes[1][1])))
            for place, value in changes:
                node = trunk + width + place
                tree[node] = value
            for place, _ in changes:
                node = width + place
                for _ in range(width.bit_length() - 1):
                    up = node >> 1
                    tree[trunk + up] = np.minimum(tree[trunk + node], tree[trunk + (node ^ 1)])
                    node = up


class _Entries(dict):
    """Numbers of pieces; asking for an unmet one enters it."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.new.append(piece)
        return k


class WordBpe:
    """A tokenizer read from its JSON file (normaliser NFC, white space,
    lower case; words by the file's own pattern; byte-level; word-end BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._require(spec)
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.tokens: list[str | None] = [None] * (max(chain(vocab.values(), (t["id"] for t in spec["added_tokens"]))) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {}
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"]
            self.special[t["content"]] = t["id"]
        self.arrow_tokens = pa.array(self.tokens, pa.string())
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.merges = Merges(self.ranks)
        letters = byte_alphabet()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([vocab.get(c + suffix, -1) for c in letters], np.int64)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words_of = regex.compile(split["pattern"]["Regex"]).findall
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self._clear()
        self.older: tuple = ({}, None, None, None)

    @staticmethod
    def _require(spec: dict) -> None:
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if (spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None
                or spec["model"]["unk_token"] is not None or any(t["normalized"] for t in spec["added_tokens"])):
            raise ValueError("not a word-end BPE tokenizer of the supported form")

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and each word's number
        of ids; words of like length are merged together."""
        data = [w.encode("utf-8") for w in words]
        flat = np.frombuffer(b"".join(data), np.uint8)
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        symbols, last = self.inner[flat], np.cumsum(lengths) - 1
        symbols[last] = self.final[flat[last]]
        if (symbols < 0).any():                            # bytes that the vocabulary does not have
            lengths = np.bincount(np.repeat(np.arange(len(data)), lengths)[symbols >= 0], minlength=len(data))
            symbols = symbols[symbols >= 0]
        starts = np.cumsum(lengths) - lengths
        counts, got = np.zeros(len(data), np.int64), []
        sizes = np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(np.int64)
        for size in np.unique(sizes[lengths > 0]):
            members = np.flatnonzero((sizes == size) & (lengths > 0))
            if (1 << size) + 1 > ROW_SYMBOLS:
                for m in members:
                    ids = merge_symbols(symbols[starts[m]:starts[m] + lengths[m]].tolist(), self.ranks)
                    counts[m] = len(ids)
                    got.append((members[members == m], np.array(ids)))
                continue
            place = np.arange((1 << size) + 1)
            step = max(1, ROWS_SYMBOLS // len(place))
            for own in (members[i:i + step] for i in range(0, len(members), step)):
                inside = place < lengths[own, None]
                at = np.minimum(starts[own, None] + place, len(symbols) - 1)
                merged = self.merges.rows(np.where(inside, symbols[at], -1))
                counts[own] = (merged >= 0).sum(1)
                got.append((own, merged[merged >= 0]))
        out, starts = np.empty(counts.sum(), np.int32), np.cumsum(counts) - counts
        for members, ids in got:
            out[spans(starts[members], counts[members])] = ids
        return out, counts

    def _clear(self) -> None:
        """Tables of what has been met: the ids of entry k are
        ``ids[start[k]:start[k] + count[k]]``."""
        self.index, self.letters = _Entries(), 0
        self.ids = np.empty(1 << 16, np.int32)
        self.start, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def _turn(self) -> None:
        """The table becomes the older one; what was in that is forgotten."""
        self.older = self.index, self.ids[:self.used].copy(), self.start[:len(self.index)].copy(), self.count[:len(self.index)].copy()
        self._clear()

    def _keep(self, entries: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.start[entries] = self.used + np.cumsum(counts) - counts
        self.count[entries] = counts
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _gather(self, entries: np.ndarray) -> np.ndarray:
        """The ids of the entries, one after the other."""
        return self.ids[spans(self.start[entries], self.count[entries])]

    def _room(self) -> None:
        while len(self.index) > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))

    def _move(self, pieces: list[str], first: int) -> list[int]:
        """Take over the ids of new entries that the older table has; returns
        the places in ``pieces`` of the others. Entry ``first`` is the first piece's."""
        self.letters += sum(map(len, pieces))
        index, ids, start, count = self.older
        if not index:
            return list(range(len(pieces)))
        at = np.fromiter((index.get(p, -1) for p in pieces), np.int64, len(pieces))
        held = np.flatnonzero(at >= 0)
        if len(held):
            self._keep(held + first, ids[spans(start[at[held]], count[at[held]])], count[at[held]])
        return np.flatnonzero(at < 0).tolist()

    def _learn(self) -> None:
        """Fill the entries that were met for the first time: words by their
        merges, other pieces (runs without white space) by their words."""
        new, self.index.new = self.index.new, []
        if not new:
            return
        first, find = len(self.index) - len(new), self.index.__getitem__
        self._room()
        joint, parts, lengths, words = [], [], [], []
        for k in self._move(new, first):
            piece = new[k]
            cut = None if piece.isalpha() else self.words_of(piece)
            if cut is None or len(cut) == 1 and cut[0] == piece:
                words.append(k)
            else:
                joint.append(k)
                lengths.append(len(cut))
                parts += map(find, cut)
        inner, self.index.new = self.index.new, []
        self._room()
        inner_words = self._move(inner, first + len(new))
        whole = np.array(words + [len(new) + k for k in inner_words], np.int64) + first
        self._keep(whole, *self.encode_words([new[k] for k in words] + [inner[k] for k in inner_words]))
        if joint:
            entries = np.array(parts, np.int64)
            owner = np.repeat(np.arange(len(joint)), lengths)
            counts = np.bincount(owner, self.count[entries], len(joint)).astype(np.int64)
            self._keep(np.array(joint) + first, self._gather(entries), counts)

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text: no word of the pattern crosses white space."""
        if not text.isascii():
            # the lower case of each character by itself: no final-sigma rule
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in SEPARATORS):
            return self.words_of(text)
        return text.split()

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, ``PART_CHARS`` characters at a time."""
        out, part, size = [], [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size >= PART_CHARS:
                out += self._encode_part(part)
                part, size = [], 0
        return out + self._encode_part(part)

    def _encode_part(self, texts: list[str]) -> list[np.ndarray]:
        cut = []                                           # for each text: ids of special tokens, lists of pieces
        for text in texts:
            if "<|" not in text:
                cut.append([self._cut(text)])
            else:
                cut.append([self.special[p] if p in self.special else self._cut(p) for p in self.cuts(text)])
        if len(self.index) > MAX_CACHED or self.letters > MAX_LETTERS:
            self._turn()
        find = self.index.__getitem__                      # new pieces get an entry, to be filled below
        entries = [[np.fromiter(map(find, p), np.int64, len(p)) if isinstance(p, list) else p for p in parts] for parts in cut]
        self._learn()
        out = []
        for parts in entries:
            got = [self._gather(p) if isinstance(p, np.ndarray) else np.array([p], np.int32) for p in parts]
            out.append(got[0] if len(got) == 1 else np.concatenate(got) if got else np.empty(0, np.int32))
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode_many(self, lists: pa.ListArray) -> pa.Array:
        """Tokens joined by one space (the file names no decoder); ids that
        the vocabulary does not have are left out; a null list is empty."""
        lists = pc.if_else(pc.is_null(lists), pa.scalar([], lists.type), lists) if lists.null_count else lists
        flat, offsets = lists.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).astype(np.int64)
        ids = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False)
        known = (ids >= 0) & (ids < len(self.tokens))
        known[known] = self.arrow_tokens.is_valid().to_numpy(zero_copy_only=False)[ids[known]]
        if not known.all():
            offsets = np.concatenate(([0], np.cumsum(known)))[offsets]
            ids = ids[known]
        words = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.arrow_tokens.take(pa.array(ids)))
        return pc.binary_join(words, " ")

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_many(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer at ``path``, read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _free(df: DataFrame, *names: str) -> None:
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}; choose other output names")


def encode_column(text: Column, path: str) -> Column:
    """``array<int>`` of token ids of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        bpe, lists = load(path), []
        for i in range(0, len(texts), PART_ROWS):
            ids = bpe.encode_many(texts.slice(i, PART_ROWS).to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))))
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """The text of an ``array<int>`` column of token ids (null: empty)."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = load(path)
        parts = [bpe.decode_many(lists.slice(i, PART_ROWS)) for i in range(0, len(lists), PART_ROWS)]
        return pa.concat_arrays(parts).cast(pa.string()) if parts else pa.array([], pa.string())

    return decode(ids)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text_col`` (null: no ids)."""
    _free(df, ids_col)
    return df.withColumn(ids_col, encode_column(df[text_col], path))


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids_col`` stands for."""
    _free(df, text_col)
    return df.withColumn(text_col, decode_column(df[ids_col], path))
