"""Units of texts that tokenizers encode one by one, and a store of what a worker has worked out for them.

A unit ends before a blank that a visible character follows and no blank precedes, and around a
single line end between visible characters. Byte-level BPE cuts a text there before it merges,
and no piece of a SentencePiece BPE model reaches over such a place, so the ids of a text are those of
its units behind each other. All other white space stays inside units.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from portmart.llm import text as X

BLANK, LINE_END = 0x20, 0x0A
# visible ASCII, and first bytes of longer characters none of which is white space
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False


_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
    """The first byte of every unit of the rows ``offsets`` deals ``data`` into. ``marks`` (a flag per byte): also
    before such a byte that follows an ASCII letter."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        blank = np.flatnonzero(data[1:-1] == BLANK) + 1
        cut[blank[(data[blank - 1] != BLANK) & _VISIBLE[data[blank + 1]]]] = True
        line = np.flatnonzero(data[1:-1] == LINE_END) + 1
        line = line[(data[line - 1] > BLANK) & (data[line - 1] < 0x7F) & _VISIBLE[data[line + 1]]]
        # both neighbours must be of the same row
        line = line[np.searchsorted(offsets, line - 1, "right") == np.searchsorted(offsets, line + 1, "right")]
        cut[line] = cut[line + 1] = True
        if marks is not None:
            cut[1:-1] |= _LETTER[data[:-1]] & marks[data[1:]]
        ends = offsets[(offsets > 0) & (offsets < n)]
        cut[ends - 1] &= data[ends - 1] != BLANK  # its follower is of the next row
    cut[offsets] = True
    return np.flatnonzero(cut[:n])


def gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the lists ``which`` behind each other, their sizes) of lists ``flat[starts[i]:starts[i + 1]]``."""
    size = starts[which + 1] - starts[which]
    end = np.cumsum(size)
    at = np.repeat(starts[which] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
    return flat[at], size


class Lists:
    """A growing table of lists of numbers."""

    def __init__(self, dtype):
        self.flat, self.starts = np.zeros(0, dtype), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.flat, self.starts, which)

    def keep(self, which: np.ndarray) -> None:
        self.flat, size = self.take(which)
        self.starts = np.concatenate([[0], np.cumsum(size)])


class Store:
    """Numbers for units, by content. ``work(units)`` adds a row for each new unit to the owner's
    tables, ``forget(numbers)`` cuts them to these rows, in this order; that happens when more than
    ``limit`` units are known, and those met last stay."""

    def __init__(self, work: Callable[[list[bytes]], None], forget: Callable[[np.ndarray], None], limit: int = 250_000, marks: np.ndarray | None = None):
        self.work, self.forget, self.limit, self.marks = work, forget, limit, marks
        self.known: dict[int, int] = {}
        self.last = np.zeros(0, np.int64)

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of every unit, index of each row's first unit)."""
        if len(self.known) > self.limit:
            names = list(self.known)
            stay = np.unique(self.last)
            self.forget(stay)
            self.known = {names[i]: n for n, i in enumerate(stay.tolist())}
        start = unit_starts(data, offsets, self.marks)
        first = np.searchsorted(start, offsets)
        end = np.append(start[1:], len(data))
        sums = X.running(data.astype(np.uint64) + np.uint64(1), X.BASES[1])
        h = X.mix(X.between(sums, start, end, X.BASES[1]) + (end - start).astype(np.uint64) * np.uint64(X.BASES[0]))
        own, at, which = np.unique(h, return_index=True, return_inverse=True)
        names = own.tolist()
        number = np.fromiter((self.known.get(k, -1) for k in names), np.int64, len(names))
        new = np.flatnonzero(number < 0)
        if len(new):
            raw, a, b = data.tobytes(), start[at[new]].tolist(), end[at[new]].tolist()
            self.work([raw[i:j] for i, j in zip(a, b)])
            number[new] = len(self.known) + np.arange(len(new))
            self.known.update(zip(own[new].tolist(), number[new].tolist()))
        self.last = number
        return number[which], first


# byte-level BPE writes each byte as one letter: printable bytes as themselves, the others as
# U+0100 and on, in order
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
LETTER_BYTES = {c: b for b, c in BYTE_LETTERS.items()}
_MARKS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"


class ByteBpe:
    """Ids of units by a ``tokenizers`` file. A run of letters, with a blank in front or not, is one
    piece of the text and goes straight to the model; so does what stands before closing marks."""

    def __init__(self, path: str, special_tokens: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens  # True: their strings are ordinary text
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks: dict[str, list[int]] = {}
        self.letter = {b: c for b, c in BYTE_LETTERS.items() if c != chr(b)}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def closing(self) -> np.ndarray:
        """Marks that end a run of letters for this tokenizer, for ``unit_starts``: all but the apostrophe, which may
        begin a piece of letters, and what follows a letter within an added token."""
        out = np.zeros(256, bool)
        inside = {y for t in self.added for x, y in zip(t, t[1:]) if x.isalpha()}
        out[[ord(c) for c in _MARKS if c not in inside]] = True
        return out

    def ids(self, units: list[bytes]) -> list[list[int]]:
        tokenize, whole, marks, letter, added = self.tokenizer.model.tokenize, self.whole, self.marks, self.letter, self.added
        blank, out = BYTE_LETTERS[BLANK], []
        for unit in units:
            head = unit[0] == BLANK
            word = unit[1:] if head else unit
            if word.isalpha():  # ASCII letters only
                word = word.decode()
                out.append([t.id for t in tokenize(blank + word if head else word)])
                continue
            word, tail = word.decode(), ""
            if not word.isalpha():
                core = word.rstrip(_MARKS)
                tail = word[len(core):]
                if not core.isalpha() or any(t in word for t in added):
                    out.append(whole(unit.decode()))
                    continue
                word = core
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letter)
            found = [t.id for t in tokenize(blank + word if head else word)]
            if tail:
                if tail not in marks:
                    if len(marks) > 10_000:
                        marks.clear()
                    marks[tail] = whole(tail)
                found += marks[tail]
            out.append(found)
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of every entry, by id; those of added tokens are their string's."""
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            out[i] = bytes(LETTER_BYTES[c] for c in name) if all(c in LETTER_BYTES for c in name) else name.encode()
        return out


class PieceBpe:
    """Ids of units by a SentencePiece BPE model that puts one blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.line = self.model.encode("\n")  # the blank in front, the line end

    def ids(self, units: list[bytes]) -> list[list[int]]:
        """A unit's first blank is the one that the model puts in front."""
        asked = [(u[1:] if u[:1] == b" " else b"\n" + u).decode() for u in units]
        out = self.model.encode(asked, num_threads=1)
        for i, u in enumerate(units):
            if u[:1] != b" ":
                out[i] = out[i][len(self.line):]
            elif len(u) == 1:
                out[i] = self.line[:1]
        return out

    def token_bytes(self) -> list[bytes]:
        model = self.model
        return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
                for i in range(model.get_piece_size())]
