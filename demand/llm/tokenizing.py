"""Token ids of whole texts with the ``tokenizers`` library, one call per *distinct* piece of text.

Both tokenizers used here split a text before any merge, and some places are always split: white space for the
word tokenizer (it drops white space), a single space between two other characters for the byte tokenizer (it
starts the next piece). Cutting there and encoding each distinct piece once gives the ids of the whole text. A text
whose spaces are not all of that kind is encoded whole. New pieces that start with a space go to the byte tokenizer
many to a line, as such a line is split at the same places. Trailing punctuation after a letter or digit is a piece too. ``tests/llm`` holds this against plain
encoding.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from demand.llm.common import flat, span_index, string_array

CACHE_PIECES = 400_000
#: A space that is not alone between two other characters.
ODD_SPACE = r"^ | $|[\s\p{Z}\x{1C}-\x{1F}\x{85}] | [\s\p{Z}\x{1C}-\x{1F}\x{85}]"
#: Punctuation that is split from a letter or digit before it.
TAIL = ".,!?;:#$%&*|"
ENDS_IN_LETTER = r"[A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]$"
#: How byte tokenizers write a space, and how many pieces that start with one are encoded as one line.
SPACE = "\u0120"
LINE = 64
_loaded: dict[str, "Coder"] = {}


def tokenizer_path(name: str) -> str:
    """Path of a vocabulary file that every executor has installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _is_led(piece: str) -> bool:
    """One space and then a word without white space at its ends."""
    return piece[:1] == " " and len(piece) > 1 and not piece[1].isspace() and not piece[-1].isspace() and " " not in piece[1:]


def _cut(ids: np.ndarray, size: list[int]) -> list[bytes]:
    raw, at, out = ids.tobytes(), 0, []
    for n in size:
        out.append(raw[at:at + 4 * n])
        at += 4 * n
    return out


class Coder:
    """A tokenizer with the ids of the pieces seen last: two generations, the older is dropped when the younger is full."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(vocabulary.values()) + 1, bool)
        self.leads[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def coded(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """(ids of all texts in a row, ids per text), each text by itself."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(lists), "<u4"), [len(x) for x in lists]

    def led(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of pieces that ``_is_led``, ``LINE`` of them in one text: it is split at their spaces, so a token that
        starts with a space starts a piece. None for all if the tokens do not part so."""
        raw, _ = self.coded(["".join(pieces[i:i + LINE]) for i in range(0, len(pieces), LINE)])
        start = np.flatnonzero(self.leads[raw])
        if len(start) != len(pieces) or start[0]:
            return [None] * len(pieces)
        return _cut(raw, np.diff(np.append(start, len(raw))).tolist())

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, ids per piece)."""
        if len(self.young) > CACHE_PIECES:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = [young.get(p) or old.get(p) for p in pieces]
        new = [i for i, x in enumerate(found) if x is None]
        in_line = [i for i in new if _is_led(pieces[i])]
        for i in range(0, len(in_line), 20_000):
            part = in_line[i:i + 20_000]
            for j, x in zip(part, self.led([pieces[j] for j in part]), strict=True):
                found[j] = x
        new = [i for i in new if found[i] is None]
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            raw, size = self.coded([pieces[j] for j in part])
            for j, x in zip(part, _cut(raw, size), strict=True):
                found[j] = x
        young.update((p, x) for p, x in zip(pieces, found, strict=True) if len(p) <= 32)
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        return np.frombuffer(b"".join(found), "<u4"), size


def forget() -> None:
    """Drop the remembered pieces: for a task that ends, as its worker goes on with other work."""
    for coder in _loaded.values():
        coder.young, coder.old = {}, {}


def _coder(path: str) -> Coder:
    """Once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Coder(path)
    return _loaded[path]


def _strings(column) -> list[str]:
    """Python strings of pieces without spaces."""
    if len(column) < 2:
        return column.to_pylist()
    whole = pa.ListArray.from_arrays([0, len(column)], column)
    return pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")


def _split_tails(words):
    """(stems, tails) of distinct words: trailing punctuation after a letter or digit is a piece of its own."""
    stems = pc.utf8_rtrim(words, TAIL)
    plain = pc.match_substring_regex(stems, ENDS_IN_LETTER)
    stems = pc.if_else(plain, stems, words)
    tails = pc.if_else(plain, words, "")
    raw, at = flat(tails)
    _, stem_at = flat(stems)
    keep = np.where(np.diff(at) > 0, np.diff(stem_at), 0)  # bytes of the stem, cut from the front of the word
    size = np.diff(at) - keep
    cut = raw[span_index(at[:-1] + keep, size)]
    return stems, string_array(cut, np.concatenate([[0], np.cumsum(size)]))


def encode(column, path: str, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, ids per text) of a string column without nulls.

    ``spaced``: spaces belong to the piece after them (byte tokenizer); else white space is dropped and
    capitals are lowered (word tokenizer).
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    column = column.cast(pa.large_string())
    if spaced:
        whole = pc.match_substring_regex(column, ODD_SPACE)
        split = pc.split_pattern(pc.if_else(whole, "", column), " ")
    else:
        whole = pa.array(np.zeros(n, bool))
        split = pc.ascii_split_whitespace(column)
    values, bounds = split.flatten(), split.offsets.to_numpy()
    coded = values.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    stems, tails = [x.dictionary_encode() for x in _split_tails(coded.dictionary)]
    stem, tail = stems.indices.to_numpy(zero_copy_only=False).astype(np.int64), tails.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    count = np.diff(bounds)
    if spaced:  # the first piece of a text has no space before it
        pieces = _strings(stems.dictionary)
        first = bounds[:-1][count > 0]
        lead, where = np.unique(number[first], return_inverse=True)
        number[first] = len(stem) + where
        pieces = [" " + w for w in pieces] + [pieces[i] for i in stem[lead].tolist()]
        stem = np.concatenate([stem, len(stems.dictionary) + np.arange(len(lead))])
        tail = np.concatenate([tail, tail[lead]])
    else:
        lowered = pc.ascii_lower(stems.dictionary).dictionary_encode()
        pieces, stem = _strings(lowered.dictionary), lowered.indices.to_numpy(zero_copy_only=False).astype(np.int64)[stem]
    odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    if len(odd):  # such a text is one piece of its own (its split gave one empty piece)
        number[bounds[odd]] = len(stem) + np.arange(len(odd))
        stem = np.concatenate([stem, len(pieces) + np.arange(len(odd))])
        nothing = len(tails.dictionary)
        tail = np.concatenate([tail, np.full(len(odd), nothing)])
        pieces += column.take(pa.array(odd)).to_pylist()
        ends = [*_strings(tails.dictionary), ""]
    else:
        ends = _strings(tails.dictionary)
    ids, size = _coder(path).ids(pieces + ends)
    start = np.cumsum(size) - size
    both = np.stack([stem, len(pieces) + tail], axis=1).ravel()  # stem and tail of each distinct word
    ids, size = ids[span_index(start[both], size[both])], size[both].reshape(-1, 2).sum(axis=1)
    start = np.cumsum(size) - size
    out = ids[span_index(start[number], size[number])]
    total = np.concatenate([[0], np.cumsum(size[number])])
    return out, total[bounds[1:]] - total[bounds[:-1]]


def with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    size = count + 1
    stop = np.cumsum(size)
    out = np.full(int(stop[-1]) if len(stop) else 0, end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[stop - 1] = False
    out[inside] = ids
    return out, size
