"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The boundaries of the pre-tokens come from a finite automaton run over whole
batches of texts: every code point is mapped to a class by one array lookup,
classes and their right neighbours give a symbol, and each symbol is a
transition function on eight states. Functions compose associatively, so the
automaton runs as a prefix scan. Nearly all symbols are constant functions
(the state after them doesn't depend on the state before), which are their own
prefix composition; only apostrophes of contractions and the letters right
after them are not, and their runs are composed by doubling. No regular
expression is involved. The byte slices between boundaries go through a cache
of merged pairs; byte offsets of the tokens are kept for decoding.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np

LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE = range(6)
#: Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters that form a token with a preceding apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# symbols of the automaton
S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_WHITE, S_LAST_BLANK, S_QUOTE1, S_QUOTE2 = range(8)
FIRST = 8  # added to the symbol of a text's first code point
# states: what the token at hand is
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AFTER_SPACE, TWO_LEFT, ONE_LEFT = range(8)

#: Symbol by class, and by class + 8 where white space or the text's end follows.
SYMBOL_OF = np.array([S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_LAST_BLANK, S_OTHER, 0, 0,
                      S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_WHITE, S_OTHER], np.uint8)

_classes: np.ndarray | None = None
_tables: tuple[np.ndarray, np.ndarray] | None = None


def code_point_classes() -> np.ndarray:
    """Class of every code point, built once per process.

    Letters and numbers are asked from the tokenizer library, as its Unicode
    tables may be newer or older than Python's: it encodes only what its
    pattern matches.
    """
    global _classes
    if _classes is None:
        import tiktoken
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        every = "".join(map(chr, points))
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            only = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            found = only.decode_bytes(only.encode_ordinary(every)).decode()
            table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
        table[WHITE_SPACE] = BLANK
        table[32] = SPACE
        table[39] = QUOTE
        _classes = table
    return _classes


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """``(next state, starts a token)`` by ``state * 16 + symbol``."""
    global _tables
    if _tables is None:
        go, cut = np.zeros((8, 16), np.uint8), np.ones((8, 16), bool)
        fresh = [IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, CLOSED, ONE_LEFT, TWO_LEFT]
        go[:, :8] = fresh
        go[:, FIRST:] = fresh
        for state, symbols in ((IN_LETTERS, [S_LETTER]), (IN_NUMBERS, [S_NUMBER]), (IN_WHITE, [S_WHITE]),
                               (IN_OTHERS, [S_OTHER, S_QUOTE1, S_QUOTE2]),
                               (AFTER_SPACE, [S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2])):
            cut[state, symbols] = False
        for state in (IN_OTHERS, AFTER_SPACE):
            go[state, [S_QUOTE1, S_QUOTE2]] = IN_OTHERS
        go[TWO_LEFT, :8], go[ONE_LEFT, :8] = ONE_LEFT, CLOSED
        cut[[TWO_LEFT, ONE_LEFT], :8] = False
        _tables = go.ravel(), cut.ravel()
    return _tables


def symbols_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of concatenated texts; ``first`` holds the index of each text's first code point."""
    kinds = code_point_classes()[points]
    n = len(points)
    last = np.append(first[1:], n) - 1  # of each text
    white = (kinds - np.uint8(SPACE)) < 2
    before_white = np.empty(n, np.uint8)
    before_white[:-1] = white[1:]
    before_white[last] = True
    out = SYMBOL_OF[kinds + (before_white << 3)]
    quotes = np.flatnonzero(kinds == QUOTE)
    quotes = quotes[quotes < last[np.searchsorted(first, quotes, "right") - 1]] if len(quotes) else quotes
    if len(quotes):
        ends = last[np.searchsorted(first, quotes, "right") - 1]
        one = points[quotes + 1]
        out[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = S_QUOTE1
        two = np.where(quotes + 2 <= ends, points[np.minimum(quotes + 2, n - 1)], 0)
        for a, b in TWO_LETTERS:
            out[quotes[(one == ord(a)) & (two == ord(b))]] = S_QUOTE2
    out[first] += FIRST
    return out


def token_starts(symbols: np.ndarray) -> np.ndarray:
    """Indices of the code points that start a pre-token, by the scan described above."""
    go, cut = transitions()
    n = len(symbols)
    after = go[symbols]  # from the closed state: right wherever the function is constant
    quotes = np.flatnonzero((symbols == S_QUOTE1) | (symbols == S_QUOTE2) | (symbols == FIRST + S_QUOTE1) | (symbols == FIRST + S_QUOTE2))
    if len(quotes):
        open_ = np.unique(np.concatenate([quotes, quotes + 1, quotes[symbols[quotes] % 8 == S_QUOTE2] + 2]))
        functions = go.reshape(8, 16)[:, symbols[open_]].T  # state -> state
        run = np.cumsum(np.append(True, open_[1:] != open_[:-1] + 1)) - 1
        span, longest = 1, int(np.bincount(run).max())
        while span < longest:  # prefix composition by doubling, within runs of neighbours
            joined = np.take_along_axis(functions[span:], functions[:-span].astype(np.intp), axis=1)
            same = run[span:] == run[:-span]
            functions = functions.copy()
            functions[span:][same] = joined[same]
            span *= 2
        begins = open_[np.searchsorted(run, run)]
        entry = np.where(begins > 0, after[begins - 1], CLOSED)
        after[open_] = functions[np.arange(len(open_)), entry]
    at = symbols.copy()
    at[1:] += after[:-1] << 4
    return np.flatnonzero(cut[at])


def pre_tokens(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """``(bytes, ends, counts)``: the texts' UTF-8, where each pre-token ends in it, how many each text has."""
    joined = "".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not joined:
        return b"", np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    begins = np.cumsum(sizes) - sizes
    starts = token_starts(symbols_of(points, begins[sizes > 0]))
    raw = joined.encode()
    if len(raw) == len(points):
        offsets = starts
    else:
        width = (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF) + 1
        offsets = (np.cumsum(width, dtype=np.int64) - width)[starts]
    counts = np.diff(np.searchsorted(starts, np.append(begins, len(points))))
    return raw, np.append(offsets[1:], len(raw)), counts


class Pairs(dict):
    """Cache from two adjacent tokens to the token that joins them, or the vocabulary's size if there is none."""

    def __init__(self, ranks: dict[bytes, int], values: list[bytes], most: int = 2_000_000):
        super().__init__()
        self.ranks, self.values, self.most = ranks, values, most

    def __missing__(self, pair: tuple[int, int]) -> int:
        if len(self) >= self.most:
            self.clear()
        self[pair] = joined = self.ranks.get(self.values[pair[0]] + self.values[pair[1]], len(self.values))
        return joined


class Encoder(dict):
    """Cache from a pre-token to its ids (packed little-endian unsigned 32-bit).

    ``ranks`` maps the bytes of each token to its id, which is also its merge
    priority. The cache is emptied when it holds ``most`` pre-tokens, which
    bounds memory and leaves results as they are. ``merge`` may replace the
    pair merging by another function from a pre-token to its ids. ``added``
    maps strings that are one token wherever a text holds them to their ids:
    the leftmost first, the longest of those that begin there. They are cut out
    before pre-tokenisation.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = 1_000_000, merge=None, added: dict[str, int] | None = None):
        super().__init__()
        self.ranks, self.most, self.merge = ranks, most, merge or self.merged
        self.added = added or {}
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.values = [b""] * (max([*ranks.values(), *self.added.values()]) + 1)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in self.added.items())]:
            self.values[i] = token
        self.of_byte = [ranks[bytes([b])] for b in range(256)]
        self.pairs = Pairs(ranks, self.values)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        packed = array("I", self.merge(piece)).tobytes()
        if len(piece) <= 64:
            self[piece] = packed
        return packed

    def merged(self, piece: bytes) -> list[int]:
        """Byte pair merging: the adjacent pair of the lowest rank first, the leftmost of equals."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 48:
            return self._merged_long(piece)
        never, found = len(self.values), self.pairs
        parts = list(map(self.of_byte.__getitem__, piece))
        pairs = [found[a, b] for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < never:
            i = pairs.index(low)
            parts[i] = low
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = found[low, parts[i + 1]]
            if i:
                pairs[i - 1] = found[parts[i - 1], low]
        return parts

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same over a linked list with a heap, for long pre-tokens."""
        ranks, n = self.ranks, len(piece)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def pair(i: int):
            j = end[i]
            return ranks.get(piece[i:end[j]]) if j < n else None

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two has grown since
            j = end[i]
            alive[j] = False
            end[i] = end[j]
            if end[i] < n:
                before[end[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k, end[end[k]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str], at_once: int = 1 << 20) -> Iterator[np.ndarray]:
        """The ids of each text, in order; texts go through the scan in groups of about ``at_once`` characters."""
        if self.apart is None:
            yield from self._encode_plain(texts, at_once)
            return
        parted = [self.apart.split(text) for text in texts]  # the text between added tokens, and each of these
        plain = self._encode_plain([x for parts in parted for x in parts[::2]], at_once)
        for parts in parted:
            ids = [next(plain)]
            for token in parts[1::2]:
                ids += [np.array([self.added[token]], "<u4"), next(plain)]
            yield ids[0] if len(ids) == 1 else np.concatenate(ids)

    def _encode_plain(self, texts: list[str], at_once: int) -> Iterator[np.ndarray]:
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > at_once:
                yield from self._encode_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, texts: list[str], step: int = 1 << 18) -> Iterator[np.ndarray]:
        raw, ends, counts = pre_tokens(texts)
        at = done = 0
        for count in counts.tolist():
            packed = []
            for k in range(done, done + count, step):
                stops = ends[k:min(k + step, done + count)].tolist()
                begins = [at, *stops[:-1]]
                packed.append(b"".join(map(self.__getitem__, [raw[a:b] for a, b in zip(begins, stops)])))
                at = stops[-1]
            done += count
            yield np.frombuffer(packed[0] if len(packed) == 1 else b"".join(packed), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``; an id outside the vocabulary raises IndexError."""
        return b"".join(map(self.values.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in its text, and at the end the text's length."""
        out = np.zeros(len(ids) + 1, np.int64)
        if len(ids):
            np.cumsum(np.fromiter((len(self.values[i]) for i in ids.tolist()), np.int64, len(ids)), out=out[1:])
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a rank file, or from a tokenizer file of a byte-level BPE model."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        back = byte_of_letter()
        return {bytes(map(back.__getitem__, token)): i for token, i in vocabulary.items() if all(c in back for c in token)}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def byte_of_letter() -> dict[str, int]:
    """The usual printable stand-ins of byte-level vocabularies, back to their bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, fast: bool = False) -> Encoder:
    """One encoder per process and vocabulary. ``fast``: misses of the cache are merged by the tokenizer library's core."""
    key = (path, fast)
    if key not in _encoders:
        ranks, added = read_ranks(path), {}
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                listed = [t for t in json.load(f).get("added_tokens", []) if t["content"]]
            if any(t.get(k) for t in listed for k in ("single_word", "lstrip", "rstrip")):
                raise ValueError("added tokens that depend on their surroundings are not supported")
            added = {t["content"]: t["id"] for t in listed}
            ranks = {t: i for t, i in ranks.items() if i not in added.values()}
        merge = None
        if fast:
            import tiktoken
            core = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe
            merge = core.encode_single_piece
        _encoders[key] = Encoder(ranks, merge=merge, added=added)
    return _encoders[key]
