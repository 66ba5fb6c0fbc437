"""Pre-token split of GPT-2's pattern, as a deterministic transducer over character classes.

The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+.  It needs one
character of lookahead at most, so a 13-state machine finds every token's first character once the next
character is known.  Texts are laid end to end and cut into chunks of equal length.  Each chunk becomes a map
from the state before it to the state after it; all maps are built in lockstep, combined by a parallel prefix
scan, and then every chunk is run from its own known state.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import regex
from tokenizers import pre_tokenizers

SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, ONE, R, V, LL, E, END = range(12)
N_CLASSES = 12
START, IN_L, IN_N, IN_O, AP, AP_R, AP_V, AP_L, DONE, SP1, SPN, WS1, WSN = range(13)
N_STATES = 13
LETTERS = (LETTER, ONE, R, V, LL, E)
PENDING = (AP_R, AP_V, AP_L)
CHUNK = 128
LANES = 3


@functools.cache
def class_table() -> np.ndarray:
    """Class of each code point.

    Python's and regex's Unicode versions differ from that of the tokenizer libraries.  Where the two disagree on a code
    point, the library's own splitter says what it is.
    """
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    newer = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\uffff" for c in range(0x110000))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, every):
            newer[m.start() : m.end()] = kind
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in np.flatnonzero(table != newer).tolist():
        joins = lambda before: len(split(before + chr(c))) == 1  # noqa: E731, B023
        table[c] = LETTER if joins("a") else NUMBER if joins("1") else OTHER
    table[[c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]] = BLANK
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", ONE), ("r", R), ("v", V), ("l", LL), ("e", E)):
        for c in chars:
            table[ord(c)] = kind
    return table


def _step(q: int, c: int) -> int:
    if c == END:
        return START
    if c == SPACE:
        return SPN if q in (SP1, SPN, WS1, WSN) else SP1
    if c == BLANK:
        return WSN if q in (SP1, SPN, WS1, WSN) else WS1
    if c == NUMBER:
        return IN_N
    if c == OTHER:
        return IN_O
    if c == QUOTE:
        return IN_O if q in (IN_O, AP, SP1, SPN) else AP
    if q == AP:
        return {ONE: DONE, R: AP_R, V: AP_V, LL: AP_L}.get(c, IN_L)
    if q in (AP_R, AP_V) and c == E or q == AP_L and c == LL:
        return DONE
    return IN_L


def _starts(p: int, c: int) -> tuple[bool, bool]:
    """Whether a token starts at this character, and whether one is now known to start at the one before."""
    before = p in PENDING and not (_step(p, c) == DONE)
    if c == END:
        return False, before
    if c in (SPACE, BLANK):
        return p not in (SP1, SPN, WS1, WSN), before
    if p == SP1:
        return False, False
    if p == SPN:
        return False, True
    if p == WS1:
        return True, False
    if p == WSN:
        return True, True
    s = _step(p, c)
    if s == IN_L:
        return p != IN_L and p not in PENDING, before
    if s == IN_N:
        return p != IN_N, before
    if s == IN_O:
        return p not in (IN_O, AP), before
    return s == AP, before


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat tables by state * N_CLASSES + class: next state, start here, start one before."""
    step = np.array([_step(q, c) for q in range(N_STATES) for c in range(N_CLASSES)], np.uint8)
    here, before = np.array([_starts(q, c) for q in range(N_STATES) for c in range(N_CLASSES)]).T
    return step, here.copy(), before.copy()


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), by doubling."""
    maps, d = maps.copy(), 1
    while d < len(maps):
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d], axis=1)
        d *= 2
    return maps


@functools.cache
def lanes() -> tuple[np.ndarray, np.ndarray]:
    """The states that each class can lead to, three at most; and which of these each state reaches by it."""
    step = tables()[0].reshape(N_STATES, N_CLASSES)
    reached = [np.unique(step[:, c]) for c in range(N_CLASSES)]
    ends = np.array([np.resize(r, LANES) for r in reached], np.uint8)
    return ends, np.array([np.searchsorted(r, step[:, c]) for c, r in enumerate(reached)], np.uint8)


def states_before(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """State before each character, from START at the first.

    Whatever the state before a chunk, its first character leaves three possible states, so three lanes hold the
    whole state map of the chunk.
    """
    step = tables()[0]
    ends, lane_of = lanes()
    rows = -(-len(classes) // chunk)
    grid = np.full(rows * chunk, END, np.uint8)
    grid[: len(classes)] = classes
    columns = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    seen = np.empty((LANES, chunk, rows), np.uint8)
    state = np.ascontiguousarray(ends[columns[0]].T)
    for i in range(1, chunk):
        seen[:, i] = state
        state = step[state * np.uint8(N_CLASSES) + columns[i]]
    which = lane_of[columns[0]]
    start = np.zeros(rows, np.uint8)
    start[1:] = scan(np.take_along_axis(state.T, which, axis=1))[:-1, START]
    lane = which[np.arange(rows), start]
    out = seen[0]
    for k in range(1, LANES):
        np.copyto(out, seen[k], where=lane == k)
    out[0] = start
    return np.ascontiguousarray(out.T).reshape(-1)[: len(classes)]


def split(texts: list[str], chunk: int = CHUNK) -> list[list[bytes]]:
    """The pattern's matches in each text, in order, as UTF-8."""
    if not texts:
        return []
    big = "\n".join(texts) + "\n"
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    classes = class_table()[np.frombuffer(big.encode("utf-32-le"), "<u4")]
    classes[ends] = END
    _, here, before = tables()
    at = states_before(classes, chunk) * np.uint8(N_CLASSES) + classes
    first = here[at]
    first[:-1] |= before[at[1:]]
    first[ends] = True
    data = np.frombuffer(big.encode(), np.uint8)
    where = np.flatnonzero(first)
    cut = [0, *(np.searchsorted(where, ends) + 1).tolist()]
    if len(data) > len(classes):
        where = np.flatnonzero((data & 0xC0) != 0x80)[where]
    # 0xFF is in no UTF-8 text: it marks the starts for one split.
    marked = np.empty(len(data) + len(where), np.uint8)
    marks = where + np.arange(len(where))
    rest = np.ones(len(marked), bool)
    rest[marks] = False
    marked[marks], marked[rest] = 0xFF, data
    pieces = marked.tobytes().split(b"\xff")
    return [pieces[a + 1 : b] for a, b in zip(cut, cut[1:])]
