"""Token ids from the tokenizers library, fast enough for many small words.

Both vocabularies cut a text into units that are encoded independently of each
other, so ids are kept per unit and most units are looked up. A unit of plain
letters with closing punctuation goes straight to the library's merge model;
every other unit goes through its whole encoder. The table of known units is
bounded and emptied when full. ``WordBpe.encode_all`` takes many texts at once:
a unit that occurs often is looked up once, and its word and its punctuation
are known apart, so a word is merged once however it is written.

Ids are little-endian unsigned 32-bit integers in one bytes object.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np

#: units kept per Python worker, some 150 MB
KNOWN = 600_000
#: units looked up together
AT_ONCE = 1 << 18

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: ASCII marks but the apostrophe; a run of them is one piece under both patterns
MARKS = r"!-&(-/:-@\[-`{-~"
#: the same characters one by one
EACH_LETTER, EACH_MARK = ("".join(re.findall(f"[{kind}]", "".join(map(chr, range(256))))) for kind in (LETTERS, MARKS))
#: Python takes these controls for white space, the vocabularies do not
CONTROLS = re.compile("[\x1c-\x1f]")


class KnownUnits(dict):
    """Unit to its ids; ``find`` is called once for a unit that is not known."""

    def __init__(self, find: Callable[[str], bytes], most: int = KNOWN):
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self.find(unit)
        if len(unit) <= 64:
            self[unit] = ids
        return ids

    def keep(self, found: dict[str, bytes]) -> None:
        """Adds units whose ids were found otherwise."""
        for unit, ids in found.items():
            if len(self) >= self.most:
                self.clear()
            if len(unit) <= 64:
                self[unit] = ids


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def picked(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The parts ``which`` of ``ids``, one behind the other; parts have ``sizes`` and lie one behind the other too."""
    begins, taken = np.cumsum(sizes) - sizes, sizes[which]
    shift = begins[which] - (np.cumsum(taken) - taken)
    return ids[np.repeat(shift, taken) + np.arange(int(taken.sum()))]


@lru_cache(maxsize=None)
def byte_alphabet() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    ascending order, take the characters from U+0100 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b) if b in own else chr(next(spare)) for b in range(256))


def as_alphabet(text: str) -> str:
    if text.isascii() and " " not in text and text.isprintable():
        return text
    alphabet = byte_alphabet()
    return "".join([alphabet[b] for b in text.encode("utf-8", "replace")])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBpe:
    """Byte-level BPE by a file of ranks, through the tokenizers library.

    Every way to put a token together from two others is a merge, ordered by
    the token's rank, and a piece that is a token itself is taken whole.
    """

    _letters = re.compile(rf"( ?[{LETTERS}]+)([{MARKS}]*)")
    #: white space and what follows it: no piece of the pattern reaches past the end of one
    _units = re.compile(r"\s*\S+|\s+")
    _units_by_controls = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.ranks = read_ranks(path)
        alphabet = byte_alphabet()
        name = {token: "".join(alphabet[b] for b in token) for token in self.ranks}
        merges = [
            (name[token[:i]], name[token[i:]])
            for token in sorted(self.ranks, key=self.ranks.__getitem__)
            for i in range(1, len(token))
            if token[:i] in name and token[i:] in name
        ]
        self.tokenizer = Tokenizer(models.BPE(
            vocab={name[t]: r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        self.model = self.tokenizer.model
        self.known = KnownUnits(self._find)

    def _find(self, unit: str) -> bytes:
        plain = self._letters.fullmatch(unit)
        if plain is None:
            return packed(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        return packed([t.id for piece in plain.groups() if piece for t in self.model.tokenize(as_alphabet(piece))])

    def encode(self, text: str) -> bytes:
        units = self._units_by_controls if CONTROLS.search(text) else self._units
        return b"".join(map(self.known.__getitem__, units.findall(text)))

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids, and for each the characters it covers; the parts of a split character all cover it whole."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return found.ids, found.offsets


class WordBpe:
    """BPE with word ends, lower case and without white space, from a tokenizers file.

    Ids are those of the library's plain call, which gives the string of a special token in a text that token's
    id. ``guarded``: such strings are ordinary text, so that a document cannot forge a special token.
    """

    _letters = re.compile(rf"([{LETTERS}]+)([{MARKS}]*)")
    _units_by_controls = re.compile(r"[\S\x1c-\x1f]+")

    def __init__(self, path: str, guarded: bool = False, units: int = KNOWN):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = guarded
        self.model = self.tokenizer.model
        self.known = KnownUnits(self._find, units)

    def _find(self, unit: str) -> bytes:
        plain = self._letters.fullmatch(unit)
        if plain is None:
            return packed(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        word, marks = plain.groups()
        parts = (word.lower(), marks)
        return packed([t.id for piece in parts if piece for t in self.model.tokenize(as_alphabet(piece))])

    @cached_property
    def _joined(self):
        """The model's merges for words with a space between them, and whether an id ends a word."""
        from tokenizers import Tokenizer, pre_tokenizers

        merges = Tokenizer(self.model)
        merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary, suffix = self.tokenizer.get_vocab(), self.model.end_of_word_suffix
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        return merges, last

    def _find_words(self, words: list[str]) -> list[bytes]:
        """The ids of each of ``words``, which are plain letters in lower case, by one call of the library."""
        merges, last = self._joined
        spelled = " ".join([word if word.isascii() else as_alphabet(word) for word in words])
        ids = np.array(merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * np.flatnonzero(last[ids]) + 4
        if ends.size != len(words):  # a vocabulary without word ends
            return [self._find(word) for word in words]
        flat, edges = ids.tobytes(), ends.tolist()
        return [flat[a:b] for a, b in zip([0, *edges], edges)]

    def _units(self, text: str) -> list[str]:
        return self._units_by_controls.findall(text) if CONTROLS.search(text) else text.split()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self._units(text)))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``texts``, one text behind the other, and where each ends; the same as by ``encode``."""
        listed = [self._units(text) for text in texts]
        units = list(chain.from_iterable(listed))
        parts = [self._encode_units(units[at:at + AT_ONCE]) for at in range(0, len(units), AT_ONCE)]
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(sizes for _, sizes in parts)]))
        last = np.cumsum([len(units) for units in listed], dtype=np.int64)
        return np.concatenate([np.zeros(0, "<u4"), *(ids for ids, _ in parts)]), ends[last]

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``units``, one unit behind the other, and how many each has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        coded = pa.array(units, pa.large_string()).dictionary_encode()
        distinct, letters = coded.dictionary, rf"\A[{LETTERS}]+\z"
        # a unit of plain letters and marks behind them is two pieces, any other is one and an empty one
        stems = pc.utf8_rtrim(distinct, EACH_MARK)
        plain = pc.match_substring_regex(stems, letters)
        words = pc.if_else(plain, pc.utf8_lower(stems), distinct)
        marks = pc.if_else(plain, pc.utf8_ltrim(distinct, EACH_LETTER), pa.scalar("", pa.large_string()))
        pieces = pa.concat_arrays([words, marks]).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        missing = [i for i, ids in enumerate(found) if ids is None]
        lettered = pc.match_substring_regex(pieces.dictionary, letters).to_numpy(zero_copy_only=False).tolist()
        joined = [i for i in missing if lettered[i]]
        for i, ids in zip(joined, self._find_words([names[i] for i in joined]), strict=True):
            found[i] = ids
        for i in missing:
            if found[i] is None:
                found[i] = self._find(names[i])
        self.known.keep({names[i]: found[i] for i in missing})
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pairs = pieces.indices.to_numpy().reshape(2, -1)
        ids = picked(np.frombuffer(b"".join(found), "<u4"), sizes, pairs.T.ravel())
        sizes, which = sizes[pairs].sum(axis=0), coded.indices.to_numpy()
        return picked(ids, sizes, which), sizes[which]


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker, kept between tasks."""
    return ByteBpe(path, pattern)


@lru_cache(maxsize=4)
def word_bpe(path: str, guarded: bool = False, units: int = KNOWN) -> WordBpe:
    return WordBpe(path, guarded, units)


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """The columns of Arrow batches as tuples, a few rows at a time so that long texts are not held twice."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)
