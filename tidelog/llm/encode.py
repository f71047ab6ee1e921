"""Token ids of whole texts by a public byte-level tokenizer, with a bounded memory of encoded pieces."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa

REMEMBERED = 800_000  # pieces a process remembers at most, about 200 bytes each
KEPT = 150_000  # of these, those learned first stay for the next task: common pieces come early
TOGETHER = 2000  # pieces that are encoded as one text
CUT = 1 << 20  # code points that are cut at once, or one text
NOT_ALONE = b""
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WHITE = " \t\n\r\v\f"
WORDS = re.compile(r"\A[^ ]*| [^ ]*")
SPACE, BLANK, LETTER, NUMBER, OTHER, UNSURE = range(6)  # kinds of characters; the first two are WHITE

_encoders: dict[tuple[str, int, int], "Encoder"] = {}


@cache
def kinds() -> np.ndarray:
    """The kind of each code point, the last entry for all from 65,536 on.

    Letters, numbers and others are those on which Unicode 3.2 and Python's Unicode agree, so that they are the same to a
    tokenizer of any version between.
    """
    out = np.full((1 << 16) + 1, UNSURE, np.uint8)
    names = {"L": LETTER, "N": NUMBER, "M": OTHER, "P": OTHER, "S": OTHER}
    for code in range(1 << 16):
        kind = unicodedata.category(chr(code))[0]
        if kind in names and kind == unicodedata.ucd_3_2_0.category(chr(code))[0]:
            out[code] = names[kind]
    out[[ord(c) for c in WHITE]] = BLANK
    out[ord(" ")] = SPACE
    return out


def begins(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern cuts texts: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

    first tells where texts begin. What stands between WHITE with an unsure character stays in one, for the tokenizer to cut.
    """
    kind = kinds()[np.minimum(codes, 1 << 16)]
    white = kind <= BLANK
    before = np.concatenate([[BLANK], kind[:-1]])
    after_white = (before <= BLANK) & ~first
    last_white = white & ~np.concatenate([white[1:] | first[1:], [True]])
    out = first | np.where(white, ~after_white | last_white, np.where(after_white, before == BLANK, kind != before))
    quote = np.flatnonzero((codes == ord("'")) & out)
    if len(quote):
        inside, tail = ~np.append(first, [True, True]), np.append(codes, [0, 0])
        one = np.where(inside[quote + 1], tail[quote + 1], 0)
        two = np.where(inside[quote + 1] & inside[quote + 2], tail[quote + 2], 0)
        three = np.any([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")], axis=0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        out[quote[short | three] + 1] = False
        out[quote[three] + 2] = False
        after = np.concatenate([quote[short] + 2, quote[three] + 3])
        out[after[after < len(out)]] = True
    unsure = kind == UNSURE
    if unsure.any():
        starts = ~white & (after_white | first)
        run = np.cumsum(starts)
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[unsure]] = True
        out &= white | starts | ~mixed[run]
    return out


def pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, one text after another, and the number of each text's pieces."""
    whole = "".join(texts)
    codes, ends = np.frombuffer(whole.encode("utf-32-le"), "<u4"), np.cumsum([len(t) for t in texts])
    first = np.zeros(len(codes) + 1, bool)
    first[0], first[ends] = True, True
    starts = np.flatnonzero(begins(codes, first[:-1])) if len(codes) else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    data = whole.encode()
    if len(data) > len(codes):
        starts = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)[starts]
    bounds = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data)), counts


def words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """As pieces, cut before each space."""
    cut = list(map(WORDS.findall, texts))
    return pa.array(list(chain.from_iterable(cut)), pa.large_string()), np.array(list(map(len, cut)))


def groups(texts: list[str]) -> Iterator[list[int]]:
    """Places of texts that are cut at once."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > CUT:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        yield group


class Encoder:
    """ids(texts) equals tokenizer.encode(text, add_special_tokens=False).ids for each text.

    A text is cut where the tokenizer's own pattern cuts it, so that a word is learned once whatever stands around it;
    pieces are encoded alone and remembered. With another pattern than the byte-level one, a text is cut at its spaces: a
    space begins a piece, unless white space meets white space. Texts with such runs then, with white space that is not in
    WHITE around a piece, or with a special token's name, are given to the tokenizer whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, kept: int = KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.widths = self.byte_lengths()
        self.remembered, self.kept = remembered, kept
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.byte_level = told.get("normalizer") is None and BYTE_LEVEL.items() <= (told.get("pre_tokenizer") or {}).items()
        self.cut = pieces if self.byte_level else words

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Remember the ids of each part; none for a part that cannot be taken alone.

        Many parts are encoded as one text, with a line feed before those that have no space; the bytes that each id
        covers tell where a part ends.
        """
        joined, alone = [], []
        for part in parts:
            body = part.removeprefix(" ")
            if body and not body[0].isspace() and not body[-1].isspace():
                (joined if self.byte_level or body is not part else alone).append(part)
            elif self.byte_level and not part.strip(WHITE):
                alone.append(part)
            else:
                self.known[part] = NOT_ALONE
        self.known.update(zip(alone, self._whole(alone)))
        for at in range(0, len(joined), TOGETHER):
            some = joined[at:at + TOGETHER]
            bare = np.array([part[0] != " " for part in some])
            text = "".join([part if part[0] == " " else "\n" + part for part in some])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            covered = np.cumsum(self.widths[ids])
            ends = np.cumsum([len(part.encode()) for part in some]) + np.cumsum(bare)
            stops = np.searchsorted(covered, ends) + 1
            starts = np.concatenate([[0], stops[:-1]]) + bare
            fits = len(ids) and covered[-1] == ends[-1] and (covered[stops - 1] == ends).all()
            if fits and (covered[starts[bare] - 1] == np.concatenate([[0], ends[:-1]])[bare] + 1).all():
                data, size = ids.tobytes(), self.dtype.itemsize
                found = [data[a:b] for a, b in zip((starts * size).tolist(), (stops * size).tolist())]
            else:
                found = self._whole(some)
            self.known.update(zip(some, found))

    def _found(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.known.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            if len(self.known) + len(missing) > self.remembered:
                self.trim()
            self._learn([parts[i] for i in missing])
            for i in missing:
                found[i] = self.known[parts[i]]
        return found

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        for group in groups(texts):
            cut, counts = self.cut([texts[i] for i in group])
            cut = cut.dictionary_encode()
            found = self._found(cut.dictionary.to_numpy(zero_copy_only=False).tolist())
            taken = pa.array(found, pa.large_binary()).take(cut.indices)
            places = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1]
            ids = np.frombuffer(taken.buffers()[2] or b"", self.dtype, places[-1] // self.dtype.itemsize)
            ends = np.cumsum(counts)
            lost = np.diff(np.searchsorted(np.flatnonzero(np.diff(places) == 0), ends), prepend=0) > 0
            stops = places[ends] // self.dtype.itemsize
            for i, a, b, whole in zip(group, [0, *stops.tolist()], stops.tolist(), lost.tolist()):
                if not whole and not any(s in texts[i] for s in self.special):
                    out[i] = ids[a:b]
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, data in zip(left, self._whole([texts[i] for i in left])):
            out[i] = np.frombuffer(data, self.dtype)
        return out

    def trim(self) -> None:
        """Give memory back: what is left are the `kept` pieces learned first."""
        if len(self.known) > self.kept:
            self.known = dict(islice(self.known.items(), self.kept))

    def byte_lengths(self) -> np.ndarray:
        """Bytes that each id covers: a byte-level token has one letter per byte, a special one stands for its name."""
        out = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            out[number] = len(token.encode()) if token in self.special else len(token)
        return out


def encoder(path: str, remembered: int = REMEMBERED, kept: int = KEPT) -> Encoder:
    """This process's encoder for a tokenizer file; each executor reads the file from its own installation."""
    key = (path, remembered, kept)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
