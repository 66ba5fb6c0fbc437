"""Byte-pair encoding by prefix dynamic programming, and a token-counting transducer built on the same rule.

A sequence of tokens is the encoding of its bytes exactly if each adjacent pair is the encoding of its own bytes.
So each byte prefix has one valid last token, and the encoding of any prefix is read off by stepping back.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable

#: Entries after which a worker drops a cache and starts anew, which bounds memory and changes no result.
CACHE_ENTRIES = 300_000
#: Bytes of a chunk of a long piece, bytes before it from which its lanes begin, and how many begin there.
CHUNK, WARM, LANES = 256, 64, 3


def load_tiktoken(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: character to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary (bytes to id) and the rank of each merge."""

    def __init__(self, vocab: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int] | None = None):
        self.vocab, self.pairs = vocab, pairs
        self.bytes_of = {i: b for b, i in vocab.items()}

    @classmethod
    def from_tiktoken(cls, path: str) -> Merges:
        return cls(load_tiktoken(path))

    @classmethod
    def from_json(cls, path: str) -> tuple[Merges, list[str]]:
        """Merges of a byte-level BPE file, and the strings of its added tokens."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        back = byte_alphabet()
        raw = lambda s: bytes(back[c] for c in s)
        added = [t["content"] for t in model["added_tokens"]]
        vocab = {raw(t): i for t, i in model["model"]["vocab"].items() if t not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        return cls(vocab, {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(merges)}), added

    def rank(self, a: bytes, b: bytes) -> int | None:
        return self.vocab.get(a + b) if self.pairs is None else self.pairs.get((a, b))

    def merge(self, data: bytes, stop: int = 1) -> list[bytes]:
        """The encoding by definition: the lowest rank merges first, leftmost on a tie, down to stop parts."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class PairRule:
    """Which token may follow which, and which tokens end at a byte; answers are kept."""

    def __init__(self, merges: Merges):
        self.merges, self.known, self.made = merges, {}, {}
        self.prefixes = {t[:k] for t in merges.vocab for k in range(len(t) + 1)}
        #: Nodes: the longest suffix of the input that is a token's prefix; the tokens that end there, longest first.
        self.node_of: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.ends: list[tuple[tuple[int, int], ...]] = []
        self.moves: list[dict[int, int]] = []
        self.node(b"")

    def node(self, text: bytes) -> int:
        if (i := self.node_of.get(text)) is None:
            i = self.node_of[text] = len(self.texts)
            self.texts.append(text)
            vocab = self.merges.vocab
            self.ends.append(tuple((vocab[text[k:]], len(text) - k) for k in range(len(text)) if text[k:] in vocab))
            self.moves.append({})
        return i

    def move(self, node: int, byte: int) -> int:
        """The node after one more byte."""
        text = self.texts[node] + bytes((byte,))
        while text not in self.prefixes:
            text = text[1:]
        to = self.moves[node][byte] = self.node(text)
        return to

    def origin(self, token: int) -> tuple[int, int, int] | None:
        """Rank of the merge that makes a token, and its two parts (-1 for a byte); None if its bytes encode otherwise."""
        if token not in self.made:
            data, vocab = self.merges.bytes_of[token], self.merges.vocab
            if len(data) == 1:
                self.made[token] = (-1, -1, -1)
            else:
                parts = self.merges.merge(data, stop=2)
                rank = self.merges.rank(*parts) if len(parts) == 2 else None
                self.made[token] = None if rank is None or b"".join(parts) not in vocab else (rank, *(vocab[p] for p in parts))
        return self.made[token]

    def stays(self, left: int, right: int) -> bool:
        """Whether no merge crosses from left to right: undo the later merge beside the border, again and again."""
        text, rank_of = self.merges.bytes_of, self.merges.rank
        left_goes = right_goes = float("inf")
        while True:
            rank = rank_of(text[left], text[right])
            if rank is not None and rank < left_goes and rank <= right_goes:
                return False
            made_left, made_right = self.origin(left), self.origin(right)
            if made_left[0] > made_right[0]:
                left_goes, left = made_left[0], made_left[2]
            elif made_right[0] < 0:
                return True
            else:
                right_goes, right = made_right[0], made_right[1]

    def valid(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay as they are; a of -1 is the start of the piece."""
        key = (a << 32) + b
        if (got := self.known.get(key)) is None:
            got = self.origin(b) is not None and (a < 0 or self.stays(a, b))
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            self.known[key] = got
        return got


class PrefixTable:
    """The last token of each prefix of one growing piece of bytes."""

    def __init__(self, rule: PairRule, data: bytes = b""):
        self.rule, self.data, self.last, self.length, self.node = rule, b"", [-1], [0], [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; nothing before them changes."""
        last, length, nodes = self.last, self.length, self.node
        moves, ends, known = self.rule.moves, self.rule.ends, self.rule.known
        node, i = nodes[-1], len(last)
        for byte in more:
            to = moves[node].get(byte)
            node = self.rule.move(node, byte) if to is None else to
            for t, n in ends[node]:
                before = last[i - n]
                ok = known.get((before << 32) + t)
                if ok or ok is None and self.rule.valid(before, t):
                    last.append(t)
                    length.append(n)
                    nodes.append(node)
                    break
            else:
                raise ValueError(f"no token for byte {byte}")
            i += 1
        self.data += more

    def truncate(self, size: int) -> None:
        self.data = self.data[:size]
        del self.last[size + 1 :], self.length[size + 1 :], self.node[size + 1 :]

    def reset(self, data: bytes) -> None:
        """Become the table of data, keeping the rows of the common prefix."""
        same, old = 0, self.data
        most = min(len(old), len(data))
        while same < most and old[same] == data[same]:
            same += 1
        self.truncate(same)
        self.append(data[same:])

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many rows were computed anew.

        Rows behind the edit are kept once as many rows in a row as the longest token has bytes agree with the old
        ones: a row looks no further back than that.
        """
        old_data, old_last, old_length, old_node = self.data, self.last[:], self.length[:], self.node[:]
        shift, reach = len(new) - (end - start), max(map(len, self.rule.merges.vocab))
        self.truncate(start)
        self.append(new)
        rest, agree, made = old_data[end:], 0, len(new)
        for k in range(len(rest)):
            self.append(rest[k : k + 1])
            made += 1
            i = len(self.last) - 1
            agree = agree + 1 if self.last[i] == old_last[i - shift] and self.length[i] == old_length[i - shift] else 0
            if agree > reach:
                self.data += rest[k + 1 :]
                self.last += old_last[i - shift + 1 :]
                self.length += old_length[i - shift + 1 :]
                self.node += old_node[i - shift + 1 :]
                break
        return made

    def ids(self, size: int | None = None) -> list[int]:
        """Encoding of the first size bytes, or of all."""
        out, i = [], len(self.data) if size is None else size
        while i:
            out.append(self.last[i])
            i -= self.length[i]
        return out[::-1]


class Encoder:
    """Encodes texts that are split into pieces, each piece by its prefix table."""

    def __init__(self, merges: Merges, split: Callable[[list[str]], list[list[bytes]]]):
        self.merges, self.split, self.rule = merges, split, PairRule(merges)
        self.table = PrefixTable(self.rule)
        self.kept: dict[bytes, bytes] = {}
        self.bytes_of_name = {b"%d" % i: b for b, i in merges.vocab.items()}

    def learn(self, pieces: list[list[bytes]]) -> dict[bytes, bytes]:
        """Encode the pieces not seen before, in byte order so that neighbours share prefixes."""
        fresh = set().union(*pieces)
        if len(self.kept) > CACHE_ENTRIES:
            self.kept = {}
        kept, table = self.kept, self.table
        for piece in sorted(fresh.difference(kept)):
            table.reset(piece)
            kept[piece] = str(table.ids()).replace(",", "")[1:-1].encode()
        self.table.reset(b"")
        return self.kept

    def forget(self) -> None:
        """Drop what was kept, so that an idle worker holds little."""
        self.kept = {}
        self.rule.known = {}

    def encode_joined(self, texts: list[str]) -> list[bytes]:
        """Decimal ids of each text, joined by single spaces."""
        pieces = self.split(texts)
        kept = self.learn(pieces)
        return [b" ".join(map(kept.__getitem__, p)) for p in pieces]

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_joined([text])[0].split()]

    def decode_joined(self, joined: bytes) -> bytes:
        return b"".join(map(self.bytes_of_name.__getitem__, joined.split()))


class CountTransducer:
    """Deterministic byte transducer whose transitions carry the change in the number of tokens.

    A state is the longest suffix of the input that a token may still continue, with the last token and the relative
    count of each prefix in that window: all that later bytes can depend on.  States and transitions are compiled when
    first reached and kept; beyond a bound the machine starts anew.
    """

    def __init__(self, merges: Merges):
        self.rule = PairRule(merges)
        self.continued = {t[:k] for t in merges.vocab for k in range(len(t))}
        self.kept_node: dict[int, int] = {}
        self.clear()

    def clear(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        #: For each state: byte to (next state, change).
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.intern((0, (-1,), (0,)))

    def intern(self, state: tuple) -> int:
        if (i := self.ids.get(state)) is None:
            i = self.ids[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return i

    def window(self, node: int) -> int:
        """The node of the longest suffix that a token may still continue."""
        if (to := self.kept_node.get(node)) is None:
            text = self.rule.texts[node]
            while text not in self.continued:
                text = text[1:]
            to = self.kept_node[node] = self.rule.node(text)
        return to

    def compile(self, s: int, byte: int) -> tuple[int, int]:
        rule, (node, lasts, counts) = self.rule, self.states[s]
        full = rule.moves[node].get(byte)
        if full is None:
            full = rule.move(node, byte)
        known = rule.known
        for t, n in rule.ends[full]:
            before = lasts[-n]
            ok = known.get((before << 32) + t)
            if ok or ok is None and rule.valid(before, t):
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        now = counts[-n] + 1
        to = self.window(full)
        size = len(rule.texts[to])
        state = (to, (*lasts, t)[-size - 1 :], (*[c - now for c in counts[len(counts) - size :]], 0))
        move = self.moves[s][byte] = (self.intern(state), now)
        return move

    def run(self, s: int, data: bytes) -> tuple[int, int]:
        """State after data, and the change in the number of tokens, from state s."""
        moves, n = self.moves, 0
        for byte in data:
            move = moves[s].get(byte) or self.compile(s, byte)
            s, n = move[0], n + move[1]
        return s, n

    def count_all(self, pieces: list[bytes]) -> list[int]:
        """Tokens in the encoding of each piece; pieces in byte order share the work on common prefixes."""
        out, before = [], b""
        path = [(0, 0)]
        for piece in pieces:
            if len(self.states) > CACHE_ENTRIES:
                self.clear()
                before, path = b"", [(0, 0)]
            if len(piece) > CHUNK:
                out.append(self.count_long(piece))
                continue
            same, most = 0, min(len(before), len(piece))
            while same < most and before[same] == piece[same]:
                same += 1
            del path[same + 1 :]
            moves, (s, n) = self.moves, path[same]
            for byte in piece[same:]:
                move = moves[s].get(byte) or self.compile(s, byte)
                s, n = move[0], n + move[1]
                path.append((s, n))
            out.append(n)
            before = piece
        return out

    def chunk_map(self, chunk: bytes, entries: set[int]) -> dict[int, tuple[int, int]]:
        """State before the chunk to state after it and change in the number of tokens, for some states before it."""
        return {s: self.run(s, chunk) for s in entries}

    def count_long(self, data: bytes, chunk: int = 0) -> int:
        """Tokens of one long piece: chunks' state maps, built apart, are composed by a parallel prefix scan.

        A chunk's map has a lane for each state that the machine is in when it begins a little earlier, at LANES places:
        encodings fall into step soon.  Where the state that comes in has no lane after all, the chunk is run from it.
        """
        chunk = chunk or CHUNK
        starts = range(0, len(data), chunk)
        known: dict[tuple[bytes, bytes], dict] = {}
        maps = []
        for a in starts:
            ahead, part = data[max(0, a - WARM) : a], data[a : a + chunk]
            if (ahead, part) not in known:
                entries = {self.run(0, ahead[k:])[0] for k in range(LANES)} if a else {0}
                known[ahead, part] = self.chunk_map(part, entries)
            maps.append(known[ahead, part])
        prefixes = scan_maps(maps)
        state = total = 0
        for a, part, one in zip(starts, prefixes, maps):
            if 0 in part:
                state, total = part[0]
            else:
                to, n = one[state] if state in one else self.run(state, data[a : a + chunk])
                state, total = to, total + n
        return total


def scan_maps(maps: list[dict]) -> list[dict]:
    """Inclusive prefix composition of partial maps from state to (state, number), by doubling; numbers add up."""
    maps, d = list(maps), 1
    while d < len(maps):
        maps[d:] = [{s: (g[to][0], n + g[to][1]) for s, (to, n) in f.items() if to in g} for f, g in zip(maps, maps[d:])]
        d *= 2
    return maps


class TokenCounter:
    """Token counts of whole texts: pieces by the pre-token transducer, tokens by the byte transducer.

    A piece begins in the start state whatever came before it, so as a chunk of the text its map is constant, and such maps
    compose to the sum of their counts; they are kept by piece.
    """

    def __init__(self, merges: Merges, specials: list[str], split: Callable[[list[str]], list[list[bytes]]]):
        self.machine, self.split = CountTransducer(merges), split
        self.specials = sorted(specials, key=len, reverse=True)
        self.kept: dict[bytes, int] = {}

    def parts(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, and how many of these there are; the leftmost, then longest, counts."""
        if not any(s in text for s in self.specials):
            return [text], 0
        out, at, n = [], 0, 0
        while True:
            found = min(((i, -len(s), s) for s in self.specials if (i := text.find(s, at)) >= 0), default=None)
            if found is None:
                return [*out, text[at:]], n
            out.append(text[at : found[0]])
            at, n = found[0] + len(found[2]), n + 1

    def forget(self) -> None:
        """Drop what was kept, so that an idle worker holds little."""
        self.kept = {}
        self.machine.clear()
        self.machine.rule.known = {}

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.parts(t) for t in texts]
        pieces = self.split([p for parts, _ in cut for p in parts])
        fresh = set().union(*pieces)
        if len(self.kept) > CACHE_ENTRIES:
            self.kept = {}
        kept, new = self.kept, sorted(fresh.difference(self.kept))
        kept.update(zip(new, self.machine.count_all(new)))
        rest, out = iter(pieces), []
        for parts, n in cut:
            out.append(n + sum(sum(map(kept.__getitem__, next(rest))) for _ in parts))
        return out
