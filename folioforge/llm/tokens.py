"""Token ids of whole texts, by a vocabulary file of the tokenizers library.

Byte-level BPE never merges across a single space between two visible characters, so a text
is cut there and every different piece is looked up once per batch and encoded once per worker:
natural text repeats most of them.
The pieces give exactly the ids of the whole text.  A text that holds the string of an added
token, which the library matches before all else, is encoded whole.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Pieces remembered by a worker in each of two generations, and the longest worth remembering.
CACHE_PIECES = 300_000
CACHE_LENGTH = 32
START_PIECES = 50_000
#: Words whose tokens the library hands over as Python objects at once.
WORDS_AT_ONCE = 4096
#: All but the apostrophe, with which the usual pattern begins units of letters.
MARKS = string.punctuation.replace("'", "")

_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
#: How byte-level vocabularies spell bytes: visible ones as themselves, the others from 256 on.
BYTE_LETTERS = {**{b: b for b in _VISIBLE}, **{b: 256 + i for i, b in enumerate(_HIDDEN)}}

BLANK = chr(BYTE_LETTERS[ord(" ")])
SPELLING = "".join(chr(BYTE_LETTERS[b]) for b in range(256))

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Blanks that may stand next to other white space or at an end, or white space but for line ends.
RUNS_OF_SPACE = r"\A | \z|  | \n|\n |[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ENCODERS: dict[int, Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Vocabulary(NamedTuple):
    content: str
    byte_level: bool  # spelled in byte letters, cut by the usual pattern, without a normalizer
    id_type: str  # the smallest unsigned type, of 16 or 32 bits, that holds every id
    added: tuple[str, ...]  # strings of added tokens
    normalized: bool  # texts may get such strings only by the normalizer


def read_vocabulary(path: str | None = None) -> Vocabulary:
    with open(path or default_vocabulary(), encoding="utf-8") as source:
        content = source.read()
    layout = json.loads(content)
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    byte_level = layout["normalizer"] is None and (
        layout["pre_tokenizer"] or {}).items() >= usual.items()
    top = max([*layout["model"]["vocab"].values(), *(t["id"] for t in layout["added_tokens"])])
    added = tuple(t["content"] for t in layout["added_tokens"])
    normalized = layout["normalizer"] is not None and any(
        t.get("normalized", True) for t in layout["added_tokens"])
    return Vocabulary(content, byte_level, "<u2" if top < 1 << 16 else "<u4", added, normalized)


def share_vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary for the tasks: a file of a known, fixed size."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The texts cut at single blanks between visible characters, and the number of pieces of each.

    The blanks are left out; every text has a piece, if an empty one.
    """
    cut: list[pa.Array] = []
    counts = np.empty(len(texts), np.int64)
    # A blank next to other white space belongs to a run, which must stay whole.
    whole = pa.array(texts, pa.large_string())
    odd = pc.match_substring_regex(whole, RUNS_OF_SPACE).to_pylist()
    begins = [0, *(i for i in range(1, len(texts)) if odd[i] != odd[i - 1]), len(texts)]
    for i, j in zip(begins, begins[1:]):
        if odd[i]:
            split = pa.array([_BETWEEN.split(text) for text in texts[i:j]], pa.list_(pa.large_string()))
        else:
            split = pc.split_pattern(whole[i:j], " ")
        cut.append(split.flatten())
        counts[i:j] = pc.list_value_length(split)
    return pa.concat_arrays(cut), counts


def gathered(parts: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts that the codes name, one behind the other, and where each part begins;
    the last number is the end."""
    put = parts.take(pa.array(codes))
    _, offsets, data = put.buffers()
    begins = np.frombuffer(offsets, np.int64, len(codes) + 1) >> 2
    return np.frombuffer(data or b"", "<u4", int(begins[-1])), begins


def visible(part: str) -> bool:
    """Whether a part holds no white space, but for one blank in front."""
    word = part[1:] if part[:1] == " " else part
    return word.split() == [word]


class Known:
    """Strings and their ids in Arrow arrays, which take a fifth of a dictionary's memory."""

    def __init__(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self.names)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names.to_pylist())

    def places(self, wanted: pa.Array) -> np.ndarray:
        """Where each of the strings stands; -1 if it does not."""
        return pc.fill_null(pc.index_in(wanted, value_set=self.names), -1).to_numpy().astype(np.int64)

    def add(self, names: pa.Array, ids: pa.Array) -> None:
        self.names = pa.concat_arrays([self.names, names])
        self.ids = pa.concat_arrays([self.ids, ids])


class Encoder:
    def __init__(self, vocabulary: Vocabulary, most: int | None = None) -> None:
        self.most = most or CACHE_PIECES  # in each of two generations
        # Spark runs a worker per core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.content)
        self.model = self.tokenizer.model
        self.added, self.normalized = vocabulary.added, vocabulary.normalized
        # Words joined by line ends must not spell an added token.
        self.joined = not self.normalized and not any("\n" in token for token in self.added)
        # By piece without the blank in front of it and marks behind it: those met since the last
        # change, and those met before it.  What is met again is taken over, so common pieces are
        # never forgotten.
        self.cache, self.older = Known(), Known()
        self.marks: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}  # words without a blank in front
        (self.line_end,) = self._each(["\n"])
        self.byte_level = vocabulary.byte_level

    def _each(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", found.ids).tobytes() for found in encoded]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of parts without white space inside, encoded as the lines of one text.

        A line end between visible characters is a token of its own, so the ids of the parts
        stand between those of the line ends.
        """
        if not self.joined:
            return self._each(words)
        ids = np.array(self.tokenizer.encode("\n".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(ids == np.frombuffer(self.line_end, "<u4")[0])
        if len(self.line_end) != 4 or len(ends) != len(words) - 1:
            return self._each(words)
        raw = ids.tobytes()
        begin = [0, *(4 * ends + 4).tolist()]
        return [raw[i:j] for i, j in zip(begin, [*(4 * ends).tolist(), len(raw)])]

    def _unit(self, unit: str) -> bytes:
        if unit.isascii():  # letters or marks, which are spelled as themselves
            spelled = unit.replace(" ", BLANK)
        else:
            spelled = unit.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, piece: str) -> bytes | None:
        """Ids of letters with marks behind them, by the tokenizer's model; else None.

        Letters, with the blank in front, and marks are one unit each to the tokenizer, so its
        model is asked for them alone; the ids are those of ``encode`` at a third of the cost.
        """
        stem = piece.rstrip(MARKS)
        blank = stem[:1] == " "
        word = stem[1:] if blank else stem
        if not self.byte_level or not word.isalpha():
            return None
        ids = None if blank else self.starts.get(word)
        if ids is None:
            ids = self._unit(stem)
            if not blank and len(word) <= CACHE_LENGTH:
                if len(self.starts) > START_PIECES:
                    self.starts.clear()
                self.starts[word] = ids
        return ids + self._marks(piece[len(stem) :]) if len(stem) < len(piece) else ids

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[marks] = self._unit(marks)
        return self.marks[marks]

    def _words(self, words: list[str]) -> pa.Array:
        """Ids of words of letters with a blank in front of each, by the tokenizer's model."""
        tokenize = self.model.tokenize
        ids, counts = array("I"), []
        for i in range(0, len(words), WORDS_AT_ONCE):
            raw = "\n".join([" " + word for word in words[i : i + WORDS_AT_ONCE]]).encode()
            spelled = codecs.charmap_decode(raw, "strict", SPELLING)[0].split(SPELLING[10])
            found = [tokenize(word) for word in spelled]
            counts += map(len, found)
            ids.extend([t.id for t in chain.from_iterable(found)])
        offsets = np.zeros(len(words) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        return pa.Array.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(offsets << 2), pa.py_buffer(ids.tobytes())])

    def _learn(self, unknown: pa.Array) -> None:
        """Remember different pieces without marks behind them, but for those that need marks.

        Marks behind a letter or number are a unit of their own, so they do not change what is in front.
        """
        places = self.older.places(unknown)
        again = places >= 0
        self.cache.add(unknown.filter(pa.array(again)), self.older.ids.take(pa.array(places[again])))
        new = unknown.filter(pa.array(~again & (pc.utf8_length(unknown).to_numpy() <= CACHE_LENGTH)))
        letters = pc.utf8_is_alpha(new) if self.byte_level else pa.array(np.zeros(len(new), bool))
        words = new.filter(letters)
        others = [p for p in new.filter(pc.invert(letters)).to_pylist() if p[-1:].isalnum() and "\n" not in p]
        self.cache.add(words, self._words(words.to_pylist()))
        self.cache.add(pa.array(others, pa.large_string()),
                       pa.array(self._ids([" " + p for p in others]), pa.large_binary()))

    def _behind_blanks(self, names: list[str]) -> pa.Array:
        """Ids of different pieces, which come without the blank in front of them.

        Pieces are looked up and remembered without marks behind them.  Of lines without white
        space the first is looked up so; the others have no blank in front of them.
        """
        whole = pa.array(names, pa.large_string())
        firsts, nexts = list(names), {}
        lined = pc.match_substring(whole, "\n").to_numpy(zero_copy_only=False) & self.byte_level
        for i in np.flatnonzero(lined).tolist():
            if all(map(visible, lines := names[i].split("\n"))):
                firsts[i], nexts[i] = lines[0], lines[1:]
        if nexts:
            whole = pa.array(firsts, pa.large_string())
        stems = pc.ascii_rtrim(whole, MARKS) if self.byte_level else whole
        places = self.cache.places(stems)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            wanted, n = stems.take(pa.array(missing)), len(self.cache)
            self._learn(pc.unique(wanted))
            fresh = Known()
            fresh.add(self.cache.names[n:], self.cache.ids[n:])
            found = fresh.places(wanted)
            places[missing] = np.where(found < 0, -1, found + n)
        marks = pc.binary_length(whole).to_numpy() - pc.binary_length(stems).to_numpy()
        # What is left is asked for as it is, marks included.
        left = np.flatnonzero(places < 0)
        marks[left] = 0
        places[left] = len(self.cache) + np.arange(len(left))
        extra = self._ids([" " + firsts[i] for i in left.tolist()])
        ids = pa.concat_arrays([self.cache.ids, pa.array(extra, pa.large_binary())]).take(pa.array(places))
        # Behind it: marks, then the next lines.
        tails = [b""]
        behind = np.zeros(len(names), np.int64)
        at = np.flatnonzero(marks)
        behind[at] = 1 + np.arange(len(at))
        tails += [self._marks(firsts[i][-n:]) for i, n in zip(at.tolist(), marks[at].tolist())]
        starts = list(dict.fromkeys(chain.from_iterable(nexts.values())))
        known = dict(zip(starts, self._ids(starts)))
        for i, lines in nexts.items():
            tails.append(self.line_end.join([tails[behind[i]], *(known[line] for line in lines)]))
            behind[i] = len(tails) - 1
        rest = pa.array(tails, pa.large_binary()).take(pa.array(behind))
        return pc.binary_join_element_wise(ids, rest, pa.scalar(b"", pa.large_binary()))

    def _ids(self, wanted: list[str]) -> list[bytes]:
        """Ids of pieces, blanks in front included."""
        found: list[bytes | None] = []
        words, others = [], []
        for i, piece in enumerate(wanted):
            ids = self._word(piece)
            if ids is None and "\n" in piece and all(map(visible, parts := piece.split("\n"))):
                lines = [self._word(p) if k == 0 or p[0] != " " else None for k, p in enumerate(parts)]
                ids = None if None in lines else self.line_end.join(lines)
            if ids is None:
                (words if visible(piece) else others).append(i)
            found.append(ids)
        for places, encode in ((words, self._together), (others, self._each)):
            if places:
                for i, ids in zip(places, encode([wanted[i] for i in places])):
                    found[i] = ids
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text as unsigned 32-bit integers."""
        whole = [i for i, text in enumerate(texts)
                 if self.normalized or any(token in text for token in self.added)]
        if not whole:
            return self._by_pieces(texts)
        others = sorted(set(range(len(texts))) - set(whole))
        found = dict(zip(others, self._by_pieces([texts[i] for i in others])))
        # One at a time: a batch of long texts would hold all their tokens at once.
        found.update((i, np.frombuffer(self._each([texts[i]])[0], "<u4")) for i in whole)
        return [found[i] for i in range(len(texts))]

    def _by_pieces(self, texts: list[str]) -> list[np.ndarray]:
        """Different pieces are looked up once for all texts, whose ids are put together from them."""
        if not texts:
            return []
        if len(self.cache) > self.most:
            self.older, self.cache = self.cache, Known()
        cut, counts = pieces(texts)
        begins = np.cumsum(counts) - counts
        met = cut.dictionary_encode()
        codes = met.indices.to_numpy().astype(np.int64)
        # A text's first piece has no blank in front.
        heads = cut.take(pa.array(begins)).to_pylist()
        codes[begins] = len(met.dictionary) + np.arange(len(texts))
        ids = self._behind_blanks(met.dictionary.to_numpy(zero_copy_only=False).tolist())
        found, places = gathered(
            pa.concat_arrays([ids, pa.array(self._ids(heads), pa.large_binary())]), codes)
        places = [*places[begins].tolist(), len(found)]
        return [found[i:j] for i, j in zip(places, places[1:])]


def encoder(vocabulary: Broadcast) -> Encoder:
    """This worker's encoder for the vocabulary; kept for later tasks."""
    key = zlib.crc32(vocabulary.value.content.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary.value)
    return _ENCODERS[key]
