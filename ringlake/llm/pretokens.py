"""Splitting text into pretokens with a finite-state transducer, many texts at once.

Library tokenizers cut a text into pretokens by a pattern and then merge inside each.
The cutting is done here by a small transducer over character classes whose input
symbols already look one or two characters ahead.  Its run over a long string is a
parallel prefix scan: the string is cut into chunks, every chunk is a map from start
state to end state, the maps are composed by doubling, and a last pass replays each
chunk from its true start state.  Each pretoken gets a 64-bit hash; a bounded lexicon
remembers what is known about those seen before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Surrogates cannot occur in a valid text, so they can mark ends.
DOC_END, SPECIAL = "\ud800", "\ud801"
MAX_CHARS = 1_000_000  # characters of texts that are joined into one run; a longer text is a run of its own

L, N, O, A1, A2, W, W_SPACE, W_OTHER, STOP = range(9)
FRESH, LETTERS, DIGITS, OTHERS, BLANKS, JOINING, ONE_MORE, TWO_MORE = range(8)
STATES, SYMBOLS = 8, 16
CONTINUE, START, DROP = 0, 1, 2

# --- fixed values: contractions that are pretokens of their own -----------------------
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")


_CLASSES: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """Class of every code point (letter, number, white space, other)."""
    global _CLASSES
    if _CLASSES is None:
        _CLASSES = _asked_classes()
    return _CLASSES


def install_classes(classes: np.ndarray) -> None:
    """Take the table that the driver has made; it always has one byte for each code point."""
    global _CLASSES
    _CLASSES = classes


def _asked_classes() -> np.ndarray:
    """The classes, asked of the library's own pattern engine."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    place = np.array(points, dtype=np.int64)
    classes = np.full(0x110000, O, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", L), (r"\p{N}+", N), (r"\s+", W)):
        found = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(everything)
        for _, (start, end) in found:
            classes[place[start:end]] = kind
    classes[ord(DOC_END)] = classes[ord(SPECIAL)] = STOP
    return classes


def _table(rules: dict[tuple[int, int], tuple[int, int]], fresh: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Flat tables of next state and output by (symbol, state); ``fresh`` holds wherever a rule does not."""
    following = np.zeros((SYMBOLS, STATES), dtype=np.uint8)
    output = np.full((SYMBOLS, STATES), DROP, dtype=np.uint8)
    for symbol in range(9):
        for state in range(STATES):
            following[symbol, state], output[symbol, state] = rules.get((state, symbol), fresh[symbol])
    return following.ravel(), output.ravel()


_SHARED = {
    L: (LETTERS, START), N: (DIGITS, START), O: (OTHERS, START), A1: (ONE_MORE, START), A2: (TWO_MORE, START),
    STOP: (FRESH, DROP),
}
_RUNS = {
    (LETTERS, L): (LETTERS, CONTINUE),
    (OTHERS, O): (OTHERS, CONTINUE), (OTHERS, A1): (OTHERS, CONTINUE), (OTHERS, A2): (OTHERS, CONTINUE),
    **{(ONE_MORE, s): (FRESH, CONTINUE) for s in (L,)},
    **{(TWO_MORE, s): (ONE_MORE, CONTINUE) for s in (L,)},
}


@dataclass(frozen=True)
class Splitter:
    """A pretoken pattern.  ``spaces``: a blank joins what follows and white space is kept; otherwise it is dropped."""

    spaces: bool

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.spaces:
            blank = {W: (FRESH, DROP), W_SPACE: (FRESH, DROP), W_OTHER: (FRESH, DROP)}
            return _table(_RUNS, {**_SHARED, N: (FRESH, START), **blank})
        joined = {L: LETTERS, N: DIGITS, O: OTHERS, A1: OTHERS, A2: OTHERS}
        rules = {
            **_RUNS,
            (DIGITS, N): (DIGITS, CONTINUE),
            (BLANKS, W): (BLANKS, CONTINUE),
            **{(JOINING, symbol): (state, CONTINUE) for symbol, state in joined.items()},
        }
        blank = {W: (BLANKS, START), W_SPACE: (JOINING, START), W_OTHER: (FRESH, START)}
        return _table(rules, {**_SHARED, **blank})

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Input symbols: classes with what follows taken in.  The last point is an end."""
        symbols = character_classes()[points]
        follows = symbols[1:]
        if self.spaces:
            # White space before something that is not: the last of its run.
            last = (symbols[:-1] == W) & (follows != W) & (follows != STOP)
            blank = points[:-1] == ord(" ")
            symbols[:-1][last & blank] = W_SPACE
            symbols[:-1][last & ~blank] = W_OTHER
        quotes = np.flatnonzero(points[:-1] == ord("'"))
        if len(quotes):
            fold = (lambda p: p) if self.spaces else (lambda p: np.where((p >= 65) & (p <= 90), p + 32, p))
            one = fold(points[quotes + 1])
            two = fold(points[np.minimum(quotes + 2, len(points) - 1)])
            short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
            long = np.zeros(len(quotes), dtype=bool)
            for a, b in LONG_ENDINGS:
                long |= (one == ord(a)) & (two == ord(b))
            symbols[quotes[long]] = A2
            symbols[quotes[short]] = A1
        return symbols


def run_transducer(symbols: np.ndarray, following: np.ndarray, output: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Output of every step from the fresh state, by composing the chunks' state maps in a prefix scan."""
    n = len(symbols)
    chunks = max(1, -(-n // chunk))
    padded = np.full(chunks * chunk, STOP, dtype=np.uint8)
    padded[:n] = symbols
    steps = np.ascontiguousarray(padded.reshape(chunks, chunk).T) << 3
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
    for step in steps:
        maps = following[step[:, None] | maps]
    reach = 1
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.zeros(chunks, dtype=np.uint8)
    state[1:] = maps[:-1, FRESH]
    out = np.empty((chunk, chunks), dtype=np.uint8)
    for i, step in enumerate(steps):
        at = step | state
        out[i] = output[at]
        state = following[at]
    return np.ascontiguousarray(out.T).ravel()[:n]


@dataclass
class Pretokens:
    """Pretokens of joined texts: where they start and end, their hashes, and the first pretoken of each text."""

    joined: str
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray
    specials: np.ndarray  # places of special strings, in pretokens before them

    def text_of(self, i: int) -> str:
        return self.joined[self.starts[i] : self.ends[i]]


_POWERS = np.ones(1, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 1024), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POWERS = np.cumprod(grown)
    return _POWERS


def split_texts(texts: list[str], splitter: Splitter) -> Pretokens:
    """Cut texts in which special strings are already replaced by ``SPECIAL``."""
    joined = "".join([t + DOC_END for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = run_transducer(splitter.symbols(points), *splitter.tables())
    marks = np.flatnonzero(out != CONTINUE)
    begins = out[marks] == START
    starts = marks[begins]
    ends = np.append(marks[1:], len(points))[begins]
    if len(starts):
        lengths = ends - starts
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        weighed = (points[np.repeat(starts, lengths) + inside].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[inside]
        hashes = np.add.reduceat(weighed, np.cumsum(lengths) - lengths)
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        hashes[hashes == 0] = 1
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    text_ends = np.flatnonzero(points == ord(DOC_END))
    firsts = np.searchsorted(starts, np.concatenate([[0], text_ends[:-1] + 1]) if len(text_ends) else [])
    specials = np.searchsorted(starts, np.flatnonzero(points == ord(SPECIAL)))
    return Pretokens(joined, starts, ends, hashes, firsts.astype(np.int64), specials)


class Lexicon:
    """Hash to row number, by open addressing in arrays; forgets everything when it is full."""

    def __init__(self, bits: int = 21):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.rows = np.zeros(1 << self.bits, dtype=np.int32)
        self.used = 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is not known."""
        rows = np.full(len(hashes), -1, dtype=np.int32)
        slots, open_ = self._slots(hashes), np.arange(len(hashes))
        mask = (1 << self.bits) - 1
        while len(open_):
            keys = self.keys[slots]
            hit = keys == hashes[open_]
            rows[open_[hit]] = self.rows[slots[hit]]
            on = ~hit & (keys != 0)
            slots, open_ = (slots[on] + 1) & mask, open_[on]
        return rows

    def has_room(self, more: int) -> bool:
        return self.used + more <= (1 << self.bits) * 6 // 10

    def add(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        """Distinct hashes that are not in yet."""
        self.used += len(hashes)
        slots, mask = self._slots(hashes), (1 << self.bits) - 1
        while len(hashes):
            free = np.flatnonzero(self.keys[slots] == 0)
            taken, which = np.unique(slots[free], return_index=True)
            placed = free[which]
            self.keys[taken], self.rows[taken] = hashes[placed], rows[placed]
            left = np.ones(len(hashes), dtype=bool)
            left[placed] = False
            hashes, rows, slots = hashes[left], rows[left], slots[left]
            lost = self.keys[slots] != 0
            slots = np.where(lost, (slots + 1) & mask, slots)


def runs_of(texts: list[str], limit: int = MAX_CHARS):
    """Consecutive slices of ``texts`` of at most ``limit`` characters, or of one text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]
