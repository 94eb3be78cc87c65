"""Files as streams of bytes inside tasks, for what Spark's readers cannot tell: hashes, headers, archives.

Memory is one block, whatever the size of a file. Tasks open files through the file system that the address
names, so a shared store works like a shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyarrow import fs

BLOCK = 1 << 20
_BOM = b"\xef\xbb\xbf"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of an address; without a scheme, or with file:, a local path."""
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(path)


def blocks(stream) -> Iterator[bytes]:
    while block := stream.read(BLOCK):
        yield block


# ---- quotes ----
#
# A quote opens a field only where the field starts; inside, a second quote right behind a closing one goes on. So a
# scan is in one of three states: inside quotes, at a start (of a field, or right behind a closing quote, which goes
# on alike), or past the start of a field, where quotes mean nothing. What a byte does depends on nothing else, so a
# block maps each state to a state, and maps combine: blocks can be scanned apart, in any order.

INSIDE, START, PAST = 0, 1, 2
_QUOTE, _COMMA, _BREAK = b'",\n'


def _step(quoted: int, start: int, past: int) -> int:
    """A map of the three states as one number."""
    return quoted * 9 + start * 3 + past


def _image(step: int, state: int) -> int:
    return step // (9, 3, 1)[state] % 3


#: What a quote does, by what stands before it: right behind another quote, behind a comma or break, anything else.
_BEHIND_QUOTE, _BEHIND_END, _LATER = _step(START, INSIDE, PAST), _step(START, INSIDE, INSIDE), _step(START, PAST, PAST)
_SAME = _step(INSIDE, START, PAST)
_KIND = np.full(256, _LATER, np.uint8)
_KIND[[_COMMA, _BREAK]], _KIND[_QUOTE] = _BEHIND_END, _BEHIND_QUOTE
_IMAGES = np.array([[_image(f, s) for f in range(27)] for s in (INSIDE, START, PAST)], np.uint8)
#: _THEN[27 * f + g]: first f, then g.
_THEN = np.array([_step(*(_image(g, _image(f, s)) for s in (INSIDE, START, PAST))) for f in range(27) for g in range(27)], np.uint8)


def _running(steps: np.ndarray) -> np.ndarray:
    """Each step with all before it: stretches are run side by side, then joined."""
    n = len(steps)
    wide = max(1, int(n**0.5))
    high = -(-n // wide)
    table = np.full(high * wide, _SAME, np.uint8)
    table[:n] = steps
    table = np.ascontiguousarray(table.reshape(high, wide).T)
    index = np.empty(high, np.intp)
    for j in range(1, wide):
        np.multiply(table[j - 1], 27, out=index, casting="unsafe", dtype=np.intp)
        index += table[j]
        np.take(_THEN, index, out=table[j])
    before = np.full(high, _SAME, np.intp)
    for i in range(1, high):
        before[i] = _THEN[27 * before[i - 1] + table[-1, i - 1]]
    return _THEN[27 * before[None, :] + table].T.ravel()[:n]


def _bits(mask: np.ndarray) -> np.ndarray:
    """A mask as bits in 64-bit words, the first one lowest."""
    packed = np.packbits(mask, bitorder="little")
    return np.append(packed, np.zeros(-len(packed) % 8, np.uint8)).view(np.uint64)


def _places(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def _next(bits: np.ndarray) -> np.ndarray:
    """Every bit one place further."""
    moved = bits << np.uint64(1)
    moved[1:] |= bits[:-1] >> np.uint64(63)
    return moved


def _odd(bits: np.ndarray) -> np.ndarray:
    """1 where an odd number of bits is set up to here."""
    out = bits.copy()
    for by in (1, 2, 4, 8, 16, 32):
        out ^= out << np.uint64(by)
    carried = np.bitwise_xor.accumulate(out >> np.uint64(63))
    out[1:] ^= np.uint64(0) - carried[:-1]
    return out


class BlockQuotes:
    """The quotes of one block, whatever the state it begins in."""

    def __init__(self, block: bytes):
        self._data = data = np.frombuffer(block, np.uint8)
        self._ended, self._quoted = block[-1:] in (b",", b"\n"), block[-1:] == b'"'
        self._any = b'"' in block
        self._breaks = _bits(data == _BREAK)
        if self._any:
            self._quotes = _bits(data == _QUOTE)
            self._turns = _odd(self._quotes)
            before = _next(_bits(data == _COMMA) | self._breaks | self._quotes)
            before[0] |= np.uint64(1)
            self._closing = self._quotes & ~before  # these close a field or mean nothing
        self._after: np.ndarray | None = None

    def _simple(self, state: int) -> bool:
        """No stray quote: they open and close in turn."""
        return state != PAST and not (self._closing & (self._turns if state else ~self._turns)).any()

    def _all(self) -> tuple[np.ndarray, np.ndarray]:
        """(places of the quotes, what all up to each do)."""
        if self._after is None:
            self._at = _places(self._quotes)
            kind = _KIND[self._data[self._at - 1]]
            if self._at[0] == 0:
                kind[0] = _BEHIND_QUOTE  # the state before says it all
            self._after = np.append(np.uint8(_SAME), _running(kind))
        return self._at, self._after

    def end(self, state: int) -> int:
        """The state behind the block."""
        n = len(self._data)
        if self._any:
            if self._simple(state):
                state ^= int(self._turns[(n - 1) >> 6] >> np.uint64((n - 1) & 63)) & 1
            else:
                state = int(_IMAGES[state][self._all()[1][-1]])
        if not n or self._quoted or state == INSIDE:
            return state
        return START if self._ended else PAST

    def _inside(self, state: int) -> np.ndarray:
        """The line breaks inside quotes, as bits."""
        if not self._any:
            return self._breaks if state == INSIDE else np.zeros_like(self._breaks)
        if self._simple(state):
            return self._breaks & (self._turns if state else ~self._turns)
        places, after = self._all()
        at = _places(self._breaks)
        inside = np.zeros(64 * len(self._breaks), bool)
        inside[at] = _IMAGES[state][after[np.searchsorted(places, at)]] == INSIDE
        return _bits(inside)

    def lines(self, state: int) -> np.ndarray:
        """Where records end."""
        return _places(self._breaks & ~self._inside(state))

    def breaks(self, state: int) -> bool:
        """A line break lies inside quotes."""
        return bool(self._inside(state).any())


class QuoteMap:
    """What a range of bytes does to each state, block by block: (end, breaks) per state it may begin in."""

    def __init__(self):
        self.end = [INSIDE, START, PAST]
        self.breaks = [False, False, False]

    def feed(self, block: bytes) -> None:
        quotes = BlockQuotes(block)
        done = {state: (quotes.end(state), quotes.breaks(state)) for state in set(self.end)}
        for i, state in enumerate(self.end):
            self.end[i] = done[state][0]
            self.breaks[i] |= done[state][1]


class RecordScan:
    """Follows CSV records through a file, block by block.

    `header` is the first record that isn't blank, without byte-order mark; `breaks` tells whether a quoted field
    holds a line break.
    """

    def __init__(self):
        self.breaks = False
        self.end = START  # the state behind all bytes so far
        self._mark = bytearray()  # the first bytes, until it is clear whether they are a byte-order mark
        self._begun = False
        self._head: bytearray | None = bytearray()

    @property
    def headed(self) -> bool:
        """The header is known."""
        return self._head is None

    def feed(self, block: bytes) -> None:
        if not self._begun:
            self._mark += block
            if _BOM.startswith(self._mark):
                return
            block, self._begun = bytes(self._mark).removeprefix(_BOM), True
        quotes = BlockQuotes(block)
        if self._head is not None:
            self._find_head(block, quotes)
        self.breaks = self.breaks or quotes.breaks(self.end)
        self.end = quotes.end(self.end)

    def _find_head(self, block: bytes, quotes: BlockQuotes) -> None:
        begun = 0
        for here in quotes.lines(self.end):
            self._head += block[begun:here]
            begun = here + 1
            self._close_head()
            if self._head is None:
                return
        self._head += block[begun:]

    def _close_head(self) -> None:
        if bytes(self._head).strip():
            self.header_bytes, self._head = bytes(self._head), None
        else:
            self._head.clear()

    @property
    def header(self) -> str | None:
        if self._head is not None:
            if not self._begun:
                self._head += bytes(self._mark).removeprefix(_BOM)
            self._close_head()
        if self._head is not None:
            return None
        return self.header_bytes.decode("utf-8").strip("\r\n \t")
