"""Encoding by the tokenizers library with a bounded cache of pieces that never influence each other.

Both pre-tokenizers cut at white space, so a text's ids are the ids of its space-bounded pieces in order.
Arrow cuts a batch, finds its distinct pieces and puts their ids in the pieces' places; Python meets each distinct
piece of a batch once. Pieces seen before come from the cache; the library encodes all others.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Unicode white space as the library's patterns understand it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACED = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
#: Marks that end many words; both patterns cut between letters and a run of them.
TAIL = ".,;:!?%$&*#|"
# Latin letters, which are their own normal form; not the dotted I, whose small form ends in a mark.
_WORD = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
#: Pieces in each of the cache's two generations, and the longest piece that is kept.
GENERATION, LONGEST = 250_000, 48


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file of that name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the files: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}


_LETTER = byte_letters()


class Encoder:
    """``ids(texts)``: little-endian unsigned 32-bit ids of each text, as the library alone gives them.

    ``spaced``: pieces keep the space before them (byte-level vocabularies); else white space is dropped and
    letters are lower-cased by the file itself.
    """

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.letters = {ord(c): "".join(_LETTER[b] for b in c.encode()) for c in map(chr, [*range(33), *range(127, 0x250)])}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that aren't cached; plain Latin words need the library's merges only, no normal form or pattern."""
        out, rest, model, letters = [b""] * len(pieces), [], self.tokenizer.model, self.letters
        for i, p in enumerate(pieces):
            own = p if self.spaced else p.lower()
            word = own[1:] if own[:1] == " " else own
            # Where both are Latin letters, each has one lower case, and its normal form is itself.
            if word.isalpha() and (p.isascii() or not _BEYOND_LATIN.search(p + own)):
                found = [t.id for t in model.tokenize(own.replace(" ", letters[32]) if own.isascii() else own.translate(letters))]
                out[i] = struct.pack(f"<{len(found)}I", *found)
            else:
                rest.append(i)
        if rest:
            for i, ids in zip(rest, self.whole([pieces[i] for i in rest])):
                out[i] = ids
        return out

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces, and where each text's begin (one more at the end); a piece may be empty."""
        if self.spaced:
            cut = [_SPACED.findall(t) for t in texts.to_pylist()]
            ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
            return pa.array([p for pieces in cut for p in pieces], pa.string()), np.concatenate([[0], ends])
        for mark in "\n\t\r":  # the file's normal form makes all white space spaces
            texts = pc.replace_substring(texts, mark, " ")
        cut = pc.split_pattern(texts, " ")
        pieces, bounds = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        # Only where no mark follows a letter: a small j and a caron have a normal form of one letter, a capital has not.
        return pc.if_else(pc.string_is_ascii(pieces), pc.ascii_lower(pieces), pieces), bounds - bounds[0]

    def _known(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces as binary values."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        young, old = self.young, self.old
        found = [young.get(p) for p in names]
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            p = names[i]
            if p in old:
                found[i] = young[p] = old[p]
            else:
                new.append(i)
        for i, ids in zip(new, self._new([names[i] for i in new])):
            found[i] = ids
            if len(names[i]) <= LONGEST:
                young[names[i]] = ids
        if len(young) > GENERATION:
            self.old, self.young = young, {}
        return pa.array(found, pa.large_binary())

    def _split(self, pieces: pa.Array) -> pa.Array:
        """Two values for each piece: Latin letters and the closing marks after them, or the piece and nothing."""
        stems = pc.ascii_rtrim(pieces, TAIL)
        size, stem = (pc.binary_length(x).to_numpy() for x in (pieces, stems))
        word = pc.match_substring_regex(stems, _WORD).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        both = np.empty(2 * len(pieces) + 1, np.int32)
        both[::2], both[1::2] = ends, ends[:-1] + np.where(word, stem, size)
        at = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset] if len(pieces) else 0
        return pa.StringArray.from_buffers(2 * len(pieces), pa.py_buffer(both), (pieces.buffers()[2] or pa.py_buffer(b"")).slice(at))

    def ids(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        special = pc.match_substring(texts, "<|")  # may hold a special token, which is found before any cut
        odd = pc.indices_nonzero(special).to_pylist()
        pieces, bounds = self._cut(pc.if_else(special, "", texts) if odd else texts)
        pieces = pieces.dictionary_encode()
        parts = self._split(pieces.dictionary).dictionary_encode()
        # The ids of a piece are those of its two parts in a row.
        places, data = _values(self._known(parts.dictionary).take(parts.indices))
        own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) // 2, [None, pa.py_buffer(places[::2].copy()), data])
        places, data = _values(own.take(pieces.indices))
        ends, data = places[bounds].tolist(), memoryview(data)
        out = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
        if odd:
            for i, ids in zip(odd, self.whole(texts.take(pa.array(odd)).to_pylist())):
                out[i] = ids
        return out


def _values(found: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.Buffer]:
    """Where the values begin (one more at the end) and the buffer that holds them."""
    _, places, data = found.buffers()
    first = found.offset
    return np.frombuffer(places, np.int64)[first:first + len(found) + 1], data or pa.py_buffer(b"")


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this Python worker; its cache lives on between tasks."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]


def forget() -> None:
    """Drop the caches of this Python worker: the tasks of another operator need the memory."""
    _ENCODERS.clear()
