"""Encoding whole texts with the tokenizers library, one encoding a distinct word.

Most words of a corpus recur. Texts are cut into words where they lie, as a column of bytes, and the words of a run of texts are
made distinct by Arrow. A worker keeps the ids of words that it has met, and the parts of all new words go to the library's model in one call. Only the library's own parts make ids: its
normaliser, pre-tokenizer and model for a word that is new, its encode() for a text that the word rule does not fit.
"""

from __future__ import annotations

import gc
import re
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import WorkerTable

#: A space with a character other than white space on both sides: a tokenizer that joins a space to the word after it cuts there.
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Words, and parts of words, that a worker keeps in each of two generations.
MOST_WORDS, MOST_PARTS = 400_000, 50_000
#: Longer words are not kept.
LONGEST = 64
#: Below this, all letters are such for the pre-tokenizer's Unicode tables as for Python's.
LATIN_END = "ɐ"
MARKS = frozenset(".,;:!?")
#: Kinds of bytes. WIDE ones start a character that may be white space.
SPACE, LINE_END, CONTROL, WIDE, MARK, PLAIN, OTHER = range(7)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[:32] = CONTROL
for _bytes, _kind in ((b" ", SPACE), (b"\n", LINE_END), (b"\xc2\xe1\xe2\xe3", WIDE), (b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", MARK), (b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", PLAIN)):
    KINDS[[*_bytes]] = _kind
#: The first two bytes of white space beyond ASCII, and of other characters: U+0085, U+00A0, U+1680, U+2000 to U+207F, U+3000 to U+303F.
WIDE_WHITE = [0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380]
#: Line ends as spaces, and in lower case too.
FLAT = bytes.maketrans(b"\n", b" ")
FLAT_LOWER = bytes.maketrans(b"\nABCDEFGHIJKLMNOPQRSTUVWXYZ", b" abcdefghijklmnopqrstuvwxyz")


class Kept:
    """Results by argument, in two generations: when the young one is full it becomes the old one, and what is asked for again
    moves to the new young one. Memory is bounded, results don't change."""

    def __init__(self, most: int) -> None:
        self.most, self.young, self.old = most, {}, {}

    def get(self, keys: list[str]) -> list[bytes | None]:
        """Results, None for those that are not kept."""
        found = [*map(self.young.get, keys)]
        if self.old:
            again = [(i, y) for i, x in enumerate(found) if x is None and (y := self.old.get(keys[i])) is not None]
            for i, y in again:
                found[i] = y
            self.keep([keys[i] for i, _ in again], [y for _, y in again])
        return found

    def keep(self, keys: list[str], values: list[bytes]) -> None:
        if len(self.young) + len(keys) > self.most:
            self.old, self.young = self.young, {}
        if max(map(len, keys), default=0) <= LONGEST:
            self.young.update(zip(keys[: self.most], values, strict=False))
        else:
            self.young.update([(k, v) for k, v in zip(keys[: self.most], values, strict=False) if len(k) <= LONGEST])


class Encoder:
    """Ids of texts, 32 bits each."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.before, self.normalizer = self.tokenizer.model, self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        self.bare = Tokenizer(self.model)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        plain = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        probe = plain("Go on, x2 é\nOn")
        #: "drop": white space only separates. "join": a space belongs to the word after it, a line end to none. "": texts are encoded whole.
        dropped = plain(" \n") == [] and probe == plain("Go") + plain("on,") + plain("x2") + plain("é") + plain("On")
        self.kind = "drop" if dropped else "join" if probe == plain("Go") + plain(" on,") + plain(" x2") + plain(" é") + plain("\n") + plain("On") else ""
        #: what the pre-tokenizer makes of a single character
        self.shown = Shown(self.before) if self.before is not None else {}
        #: whether Latin letters, and a mark after them, are parts of their own for this pre-tokenizer
        self.simple = self.before is not None and [x for x, _ in self.before.pre_tokenize_str(" ab,")][-2:] in (["Ġab", ","], ["ab", ","])
        self.lowers, self.lead = self.normalizer is not None and plain("ON, Go") == plain("on, go"), "Ġ" if self.kind == "join" else ""
        suffix = getattr(self.model, "end_of_word_suffix", None) or ""
        self.sizes = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.sizes[i] = len(token.removesuffix(suffix))
        self.parts, self.words = Kept(MOST_PARTS), Kept(MOST_WORDS)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def parts_of(self, word: str) -> tuple[str, ...] | str:
        """What the library's normaliser and pre-tokenizer make of a word, as it stands in the text; a single part by itself."""
        if self.simple:
            # Latin letters, and a mark after them
            lead, plain = (self.lead, word[1:]) if word[:1] == " " else ("", word)
            if plain.isalpha() and plain.isascii():
                return lead + (plain.lower() if self.lowers else plain)
            body, mark = (plain[:-1], plain[-1:]) if plain[-1:] in MARKS else (plain, "")
            if body.isalpha() and (body.isascii() or max(body) < LATIN_END) and (self.normalizer is None or body.isascii() or body.islower() and unicodedata.is_normalized("NFC", body)):
                body = lead + (body.lower() if self.lowers else body).translate(self.shown)
                return (body, mark) if mark else body
        if self.normalizer is not None:
            word = self.normalizer.normalize_str(word)
        return tuple(x for x, _ in self.before.pre_tokenize_str(word))

    def model_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of parts by the library's model, one call for all. Where a part ends is told by the lengths of the tokens; if they
        don't add up (a token for unknown characters), each part is encoded by itself."""
        if not parts:
            return []
        ids = np.array(self.bare.encode_batch_fast([parts], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype=np.uint32)
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        until = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(until, ends)
        if len(ids) == 0 or cuts[-1] != len(ids) - 1 or (until[np.minimum(cuts, len(ids) - 1)] != ends).any():
            return [array("I", [x.id for x in self.model.tokenize(p)]).tobytes() for p in parts]
        raw, cuts = ids.tobytes(), ((cuts + 1) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = self.words.get(words)
        new = [i for i, x in enumerate(found) if x is None]
        names = [words[i] for i in new]
        cut = [*map(self.parts_of, names)]
        lone = [p for p in cut if type(p) is str]
        parts = list({x for p in cut if type(p) is tuple for x in p})
        known = dict(zip(parts, self.parts.get(parts), strict=True))
        missing = [x for x, ids in known.items() if ids is None]
        made = self.model_ids(lone + missing)
        rest = made[len(lone) :]
        known.update(zip(missing, rest, strict=True))
        self.parts.keep(missing, rest)
        singles = iter(made)
        values = [next(singles) if type(p) is str else b"".join([known[x] for x in p]) for p in cut]
        for i, x in zip(new, values, strict=True):
            found[i] = x
        self.words.keep(names, values)
        return found

    def odd_texts(self, data: np.ndarray, kinds: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Numbers of texts that the word rule may not fit."""
        at, raw = [], data.tobytes() if self.added else b""
        if self.kind == "join":
            # white space other than single spaces and line ends with words around them
            white = (kinds == SPACE) | (kinds == LINE_END)
            at.append(np.flatnonzero(white[:-1] & white[1:]))
            edges = np.concatenate([cuts[:-1], cuts[1:] - 1])[np.tile(np.diff(cuts) > 0, 2)]
            at += [edges[white[edges]], np.flatnonzero(kinds == CONTROL)]
            first = np.flatnonzero(kinds[:-1] == WIDE)
            at.append(first[np.isin(data[first].astype(np.int32) << 8 | data[first + 1], WIDE_WHITE)])
        for token in self.added:
            found = -1
            while (found := raw.find(token.encode(), found + 1)) >= 0:
                at.append(np.array([found]))
        return np.unique(np.searchsorted(cuts, np.concatenate(at), side="right") - 1) if at else np.empty(0, dtype=np.int64)

    def odd_ids(self, text: str) -> bytes:
        """Ids of a text that the word rule may not fit."""
        if not self.kind or any(x in text for x in self.added):
            return self.whole(text)
        first, *rest = INNER_SPACE.split(text) if self.kind == "join" else [text]
        pieces = [first, *(" " + x for x in rest)]
        ids = dict(zip(each := list(dict.fromkeys(pieces)), self.word_ids(each), strict=True))
        return b"".join([ids[x] for x in pieces])

    def encode(self, texts: pa.Array | list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i, and end if given, are ids[offsets[i]:offsets[i + 1]]."""
        if isinstance(texts, list):
            texts = pa.array(texts, type=pa.large_string())
        n = len(texts)
        wide = pa.types.is_large_string(texts.type)
        _, offsets, buffer = texts.buffers()
        cuts = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(buffer, dtype=np.uint8)[cuts[0] : cuts[-1]] if n and buffer is not None else np.empty(0, dtype=np.uint8)
        cuts = cuts - cuts[0]
        if self.kind == "drop":
            data = np.frombuffer(data.tobytes().translate(FLAT_LOWER if self.lowers else FLAT), dtype=np.uint8)
        kinds = KINDS[data]
        odd = self.odd_texts(data, kinds, cuts) if self.kind else np.arange(n)
        # where words start: at a space, at a line end and after it, at a run of marks between a letter and white space, and where texts do
        starts = np.zeros(len(data) + 1, dtype=bool)
        breaks = starts[:-1]
        np.less_equal(kinds, LINE_END, out=breaks)
        mark = kinds == MARK
        marks = np.flatnonzero(mark[1:] & (kinds[:-1] == PLAIN)) + 1
        closed = np.zeros(len(data) + 1, dtype=bool)  # white space, and the end of a text
        closed[:-1] = breaks
        closed[cuts] = True
        stops = np.flatnonzero(closed[:-1] | ~mark) if len(marks) else marks  # where a run of marks ends before
        after = np.append(stops, len(data))[np.searchsorted(stops, marks, side="right")]
        marks = marks[closed[after] & ~closed[marks]]
        lines = np.flatnonzero(kinds == LINE_END)
        breaks[marks] = True
        starts[lines + 1] = True
        starts[cuts] = True
        if len(odd):  # each of these is one word
            inside = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(inside, cuts[odd], 1)
            np.add.at(inside, cuts[odd + 1], -1)
            starts &= np.cumsum(inside) == 0
            starts[cuts] = True
        at = np.flatnonzero(starts)
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        which, runs = np.asarray(words.indices), np.searchsorted(at, cuts)
        with no_collection():
            names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
            alone = {int(i) for i in which[runs[odd[runs[odd] < runs[odd + 1]]]]} if len(odd) else set()
            if alone:
                ids: list[bytes] = [b""] * len(names)
                common = [i for i in range(len(names)) if i not in alone]
                for i, x in zip(common, self.word_ids([names[i] for i in common]), strict=True):
                    ids[i] = x
                for i in alone:
                    ids[i] = self.odd_ids(names[i])
            else:
                ids = self.word_ids(names)
        if end is not None:
            which, runs, ids = np.insert(which, runs[1:], len(ids)), runs + np.arange(n + 1), [*ids, np.uint32(end).tobytes()]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        source = np.cumsum(sizes) - sizes
        until = np.concatenate([[0], np.cumsum(sizes[which])])
        narrow = np.int32 if until[-1] + sizes.sum() < 2**31 else np.int64
        places = np.repeat((source[which] - until[:-1]).astype(narrow), sizes[which])
        places += np.arange(len(places), dtype=narrow)
        return until[runs], np.frombuffer(b"".join(ids), dtype=np.uint32)[places]


@contextmanager
def no_collection() -> Iterator[None]:
    """Within, many small objects are made and none of them in a cycle; looking for cycles would take a third of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Shown(dict):
    """What a pre-tokenizer makes of a single character, by its number."""

    def __init__(self, before: object) -> None:
        self.before = before

    def __missing__(self, c: int) -> str:
        found = self[c] = "".join(x for x, _ in self.before.pre_tokenize_str(chr(c)))
        return found


_encoders = WorkerTable(dict)


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file; Spark uses worker processes again, and so their words."""
    known = _encoders.get()
    if path not in known:
        known[path] = Encoder(path)
    return known[path]


def groups_of(texts: pa.Array, most_bytes: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about most_bytes bytes each, one text at least."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and size + n > most_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
