"""SentencePiece encoding and decoding of whole texts, by longest matches, compatibility of neighbours and backtracking.

A merge-type encoding is the only sequence of pieces of a text in which every two neighbours are compatible: taken apart
merge by merge, last merge first, no earlier merge would have joined something across their border. So a text can be
encoded from left to right: the longest piece is tried first, then its prefixes, and where none fits, the piece before is
taken back. Positions from which nothing led on are marked and not entered again, which keeps the work in proportion to
the length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.encode import tokenizer_path
from tidelog.llm.text import type_of

SPACE = "▁"  # stands for a space inside pieces
MODEL = "piece_bpe_32k.model"
REMEMBERED = 1_000_000  # parts of texts whose ids a worker remembers at most, about 200 bytes each
KEPT = 500_000  # of these, those learned first stay when there are more: common parts come early
LONGEST = 40  # letters of a part that is remembered
PAIRS = 500_000  # pairs of neighbours of which a worker remembers what fits, at most
STEP = 256  # texts that are looked up at once
NOBODY = "�"
NEVER = 1 << 60

_models: dict[str, "Pieces"] = {}


class Pieces:
    """ids(texts) and text(ids) as sentencepiece's encode and decode of a BPE model with byte fallback have them.

    Pieces of equal score, such as runs of spaces, have no order among themselves: the left one of two possible merges comes
    first. They are merged after all others, in one walk over what backtracking gives. Refused are models of another kind:
    those that change texts beyond the mark for spaces before them, have no byte pieces, have letters inside pieces that are
    no pieces, or pieces of equal score before or inside others.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        byte = {i: int(names[i][3:5], 16) for i in range(size) if model.is_byte(i)}
        self.plain = [i for i in range(size) if not (i in byte or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if len(byte) != 256 or model.encode(" a  b ", out_type=str) != model.encode("▁a▁▁b▁", out_type=str) or model.decode(model.encode("  a  b ")) != "  a  b ":
            raise ValueError("only models that keep texts as they are, with byte pieces")
        self.byte_ids = [i for i, _ in sorted(byte.items(), key=lambda x: x[1])]
        names = [name.replace(SPACE, " ") for name in names]  # texts that stay in one byte a letter are shorter and quicker
        self.names = {i: names[i] for i in self.plain}
        self.ids_by_name = {names[i]: i for i in self.plain}
        self.length = [len(n) for n in names]
        self.spoken = [self._spoken(model, i, names[i], byte) for i in range(size)]
        self.byte_of = byte
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        score = [model.get_score(i) for i in range(size)]
        merged = sorted((i for i in self.plain if self.length[i] > 1), key=lambda i: -score[i])
        alike = Counter(score[i] for i in merged)
        late = [i for i in merged if alike[score[i]] > 1]
        merged = merged[:len(merged) - len(late)]
        if len({score[i] for i in late}) > 1 or any(alike[score[i]] > 1 or any(names[j] in names[i] for j in late) for i in merged):
            raise ValueError("only models whose merges have an order")
        if any(c not in self.ids_by_name for i in merged + late for c in names[i]):
            raise ValueError("only models whose letters are pieces")
        self.late = {}  # merges of equal score, by their halves
        for i in late:
            for cut in range(1, len(names[i])):
                a, b = self.ids_by_name.get(names[i][:cut]), self.ids_by_name.get(names[i][cut:])
                if a is not None and b is not None:
                    self.late[a, b] = i
        self.mergeable = {a for a, _ in self.late}
        self.rank = [-1] * size  # place in the order of merges; letters are there from the start
        for place, i in enumerate(merged):
            self.rank[i] = place
        self.halves: list[tuple[int, int] | None] = [None] * size  # the two pieces that a merge joins
        self.joined: dict[tuple[int, int], int] = {}
        self.shorter = [-1] * size  # the longest piece that begins a piece
        self.fits: dict[int, int] = {}
        self._learn_merges(merged)
        self.parts = self._cutter()
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _spoken(model, i: int, name: str, byte: dict[int, int]) -> bytes:
        """The bytes that a piece stands for inside a text."""
        if i in byte:
            return bytes([byte[i]])
        if model.is_control(i):
            return b""
        return (" ⁇ " if model.is_unknown(i) else name).encode()

    def _learn_merges(self, merged: list[int]) -> None:
        """In the order of merges: the halves of each piece, and the automaton of pieces that merging can reach."""
        import ahocorasick

        reached = {c: i for c, i in self.ids_by_name.items() if len(c) == 1}
        for i in merged:
            name = self.names[i]
            for cut in range(len(name) - 1, 0, -1):
                a, b = reached.get(name[:cut]), reached.get(name[cut:])
                if a is not None and b is not None and self._compatible(a, b):
                    self.halves[i] = (a, b)
                    self.joined[a, b] = i
                    reached[name] = i
                    break
        self.automaton = ahocorasick.Automaton()
        self.letters = {name: i for name, i in reached.items() if len(name) == 1}
        for name, i in reached.items():
            if len(name) > 1:
                self.automaton.add_word(name, i)
            self.shorter[i] = next((reached[name[:n]] for n in range(len(name) - 1, 0, -1) if name[:n] in reached), -1)
        self.automaton.make_automaton()

    def _cutter(self) -> re.Pattern:
        """Parts that no piece can cross: before a space that follows another letter, and around tabs and line ends."""
        ends = "".join(c for c in "\t\n\r" if c not in self.ids_by_name)
        if any(" " in name.lstrip(" ") for name in self.names.values()):
            return re.compile("(?s).+")
        return re.compile(f" *[^ {ends}]+| +" + (f"|[{ends}]" if ends else ""))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging keeps a and b apart: undo their merges at the border, the later one first, and look for a merge
        across it that would have come earlier. Of equal merges the left one comes first."""
        rank, halves, joined = self.rank, self.halves, self.joined
        limit = NEVER
        while True:
            across = joined.get((a, b))
            if across is not None and rank[across] < limit:
                return False
            if rank[a] > rank[b]:
                limit = rank[a]
                a = halves[a][1]
            elif halves[b] is not None:
                limit = rank[b] + 1
                b = halves[b][0]
            else:
                return True

    def _fitting(self, last: int, token: int) -> int:
        """The longest of token and the pieces that begin it that is compatible with last before it; -1 if none is."""
        while token >= 0 and not self._compatible(last, token):
            token = self.shorter[token]
        return token

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text without regard to its begin; letters that are no pieces become their bytes."""
        length = self.length
        longest = [*map(self.letters.get, part), None]  # from each place
        for end, i in self.automaton.iter(part):  # by their ends, so the longest comes last
            longest[end - length[i] + 1] = i
        fits, shorter = self.fits, self.shorter
        size = len(part)
        failed = bytearray(size + 1)
        out: list[int] = []  # ids, or -1 for a letter that is no piece
        at, token, last = 0, longest[0], -1
        while at < size:
            if token is None:
                out.append(-1)
                at, last = at + 1, -1
                token = longest[at]
                continue
            while token >= 0:
                if last >= 0:
                    key = last << 32 | token
                    token = fits.get(key, -2)
                    if token == -2:
                        token = fits[key] = self._fitting(last, key & 0xFFFFFFFF)
                    if token < 0:
                        break
                if not failed[at + length[token]]:
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = at + length[token], token
                token = longest[at]
            else:  # nothing fits here: take the piece before back, and try a shorter one in its place
                failed[at] = 1
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]
        if -1 in out:
            ids, at = [], 0
            for token in out:
                ids += [token] if token >= 0 else [self.byte_ids[b] for b in part[at].encode()]
                at += length[token] if token >= 0 else 1
            out = ids
        return out if self.mergeable.isdisjoint(out) else self._merge_late(out)

    def _merge_late(self, ids: list[int]) -> list[int]:
        """Merges of equal score, always the leftmost possible one: all before the last id taken is settled."""
        out: list[int] = []
        for i in ids:
            while out and (joined := self.late.get((out[-1], i))) is not None:
                out.pop()
                i = joined
            out.append(i)
        return out

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        if len(self.fits) > PAIRS:
            self.fits.clear()
        found = {part: np.array(self.encode_part(part), self.dtype).tobytes() for part in parts}
        if len(self.known) + len(found) > REMEMBERED:
            self.known = dict(islice(self.known.items(), KEPT))
        self.known.update((part, ids) for part, ids in found.items() if len(part) <= LONGEST)
        return found

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin or end; an empty text has none."""
        out = []
        for at in range(0, len(texts), STEP):
            cut = [self.parts.findall(" " + text.replace(SPACE, " ")) if text else [] for text in texts[at:at + STEP]]
            found = [list(map(self.known.get, parts)) for parts in cut]
            new = {part for parts, ids in zip(cut, found) if None in ids for part, i in zip(parts, ids) if i is None}
            if new:
                learned = self._learn(list(new))
                found = [[learned[p] if i is None else i for p, i in zip(parts, ids)] if None in ids else ids for parts, ids in zip(cut, found)]
            out += [np.frombuffer(b"".join(ids), self.dtype) for ids in found]
        return out

    def text(self, ids: list[int]) -> str:
        """The text of ids: marks become spaces, but for the one at the begin; bytes that are no letter become U+FFFD each."""
        parts = list(map(self.spoken.__getitem__, ids))
        if b"" not in parts:
            out = b"".join(parts)
            try:
                return (out[1:] if out[:1] == b" " and ids[0] in self.names else out).decode()
            except UnicodeDecodeError:
                pass
        return self._mended(ids)

    def _mended(self, ids: list[int]) -> str:
        """As text(), for ids with control pieces, which part the bytes around them, or with bytes that belong to no letter."""
        out, run, begun = [], b"", False
        for i in [*ids, None]:
            if i is not None and i in self.byte_of:
                run += self.spoken[i]
                continue
            while run:
                size = next((n for n in range(1, min(4, len(run)) + 1) if _letter(run[:n])), 0)
                out.append(run[:size].decode() if size else NOBODY)
                run = run[size or 1:]
                begun = True
            if i is not None and self.spoken[i]:
                name = self.spoken[i].decode()
                out.append(name[1:] if not begun and i in self.names and name[0] == " " else name)
                begun = True
        return "".join(out)


def _letter(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def pieces(path: str) -> Pieces:
    """This process's tables for a model file; each executor reads the file from its own installation."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, carry: list[str] | None = None, text_col: str = "text", path: str | None = None) -> DataFrame:
    """(*carry, ids array<int>, decoded string): the ids of every whole text and the text that they stand for.

    One pass, no shuffle; rows stay where they are and each is encoded by itself, so a lost task is just run again. A null
    text is an empty one: no ids, and the empty text. Repeated rows and null ids are rows like others. A very long text
    takes memory in proportion to its length; what a worker remembers of words is bounded. carry: columns of docs (doc_id
    by default); one that is called ids or decoded is refused.
    """
    carry = ["doc_id"] if carry is None else carry
    if {"ids", "decoded"} & set(carry):
        raise ValueError("carry has a column called ids or decoded")
    path = path or tokenizer_path(MODEL)
    kept = ", ".join(f"`{c}` {type_of(docs, c)}" for c in carry)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            ids = model.ids([t or "" for t in batch.column(len(carry)).to_pylist()])
            decoded = [model.text(i.tolist()) for i in ids]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry)], lists, pa.array(decoded, pa.string())], [*carry, "ids", "decoded"])

    wanted = docs.select(*carry, F.col(text_col).alias("_text"))
    return wanted.mapInArrow(task, ", ".join(p for p in (kept, "ids array<int>, decoded string") if p))
