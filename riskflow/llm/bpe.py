"""BPE encoding and decoding with forced boundaries.

Two bytes that no vocabulary token has side by side can't be joined by any merge: between them every encoding has a
cut. So a word splits at such places, its fragments are encoded independently (the same fragments occur again and
again, so a bounded cache holds their ids), and the ids are concatenated. The last fragment ends in the mark of the word's end.

The order of work is the vocabulary file's: special tokens, normal form C, white space, lower case, the pattern,
fragments, merges. Decoding joins the tokens of the ids by spaces, as the library does for a file without decoder.

Null texts count as empty and have no ids. Each row is answered on its own, so repeated rows, repeated ids and
null ids stay as they are; an empty table gives no rows. Other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.encode import byte_letters
from riskflow.llm.tables import slices, texts_of

#: Words and fragments in each of a cache's two generations; longer words aren't kept.
WORDS, LONGEST = 150_000, 48
#: Letters without a cut beyond which pairs are kept in a heap; the rank of a pair that isn't merged.
LONG, NONE = 256, 1 << 60
_LATIN = re.compile("[^\x00-\\u024f]")


class Vocabulary:
    """A BPE file with word ends: ``encode`` and ``decode``; ``inside`` holds the byte pairs found within tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model = held["model"]
        self.suffix = model["end_of_word_suffix"]
        self.id_of: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {self.id_of[a] << 20 | self.id_of[b]: i for i, (a, b) in enumerate(merges)}
        self.joined = [self.id_of[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.token = {i: t for t, i in (self.id_of | self.special).items()}
        self.letter = byte_letters()
        self.letters = [self.letter[b] for b in range(256)]
        bare = (t[:-len(self.suffix)] if t.endswith(self.suffix) else t for t in self.id_of)
        self.inside = {t[i:i + 2] for t in bare for i in range(len(t) - 1)}
        self.words_in = regex.compile(held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.cut_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.parts: dict[tuple[str, bool], bytes] = {}

    def fragments(self, word: str) -> list[str]:
        """The word (in file letters) cut at every pair of bytes that no token has inside."""
        at = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.inside]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])]

    def merged(self, fragment: str, ends: bool) -> bytes:
        """Ids of a fragment: the lowest-ranked pair is merged, the leftmost of equals first, until no pair has a rank."""
        marks = list(fragment)
        if ends:
            marks[-1] += self.suffix
        ids = [self.id_of[m] for m in marks]
        if len(ids) > LONG:
            return self._merged_long(ids)
        rank = self.rank.get
        ranks = [rank(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            i = ranks.index(best)
            ids[i:i + 2] = [self.joined[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 20 | ids[i], NONE)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 20 | ids[i + 1], NONE)
        return np.array(ids, "<u4").tobytes()

    def _merged_long(self, ids: list[int]) -> bytes:
        """The same with a heap of pairs, for runs of thousands of letters without a cut."""
        n, rank = len(ids), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 20 | ids[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = self.joined[r], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank(ids[x] << 20 | ids[y], NONE)) != NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of one normalised word; its fragments are encoded independently."""
        letters = self.letters
        cut = self.fragments("".join([letters[b] for b in word.encode("utf-8", "surrogatepass")]))
        ids = []
        for k, fragment in enumerate(cut):
            key = (fragment, k == len(cut) - 1)
            found = self.parts.get(key)
            if found is None:
                found = self.merged(*key)
                if len(self.parts) >= WORDS:
                    self.parts.clear()
                if len(fragment) <= LONGEST:
                    self.parts[key] = found
            ids.append(found)
        return b"".join(ids)

    def normal(self, text: str) -> str:
        """Normal form C, then lower case letter by letter (the file's own spaces only part words)."""
        if not _LATIN.search(text):  # such letters are in normal form, and each has its own lower case
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join([c.lower() for c in text])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if "<|" in text:
            cut = self.cut_special.split(text)
            return b"".join(self._plain(p) if i % 2 == 0 else self.special[p].to_bytes(4, "little") for i, p in enumerate(cut))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        young, old, out = self.young, self.old, []
        for chunk in self.normal(text).split(" "):
            if not chunk:
                continue
            ids = young.get(chunk)
            if ids is None:
                ids = old.get(chunk)
                if ids is None:
                    ids = b"".join([self.word(w) for w in self.words_in(chunk)])
                if len(chunk) <= LONGEST:
                    if len(young) >= WORDS:
                        self.old, self.young = young, {}
                        young, old = self.young, self.old
                    young[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist() if i in token])


_HELD: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this Python worker; its caches live on between tasks."""
    if path not in _HELD:
        _HELD[path] = Vocabulary(path)
    return _HELD[path]


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "word_bpe_49k.json", digests: bool = False) -> DataFrame:
    """Per document: doc_id, ids (array) and decoded text; with ``digests`` n_tokens, ids_sha256, decoded_sha256 instead."""

    def answer(batches):
        from riskflow.llm.encode import tokenizer_path

        vocab = vocabulary(tokenizer_path(tokenizer))
        for batch in slices(batches):
            ids = [vocab.encode(t) for t in texts_of(batch.column(1))]
            if digests:
                columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                           pa.array([hashlib.sha256(vocab.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in ids], pa.string())]
            else:
                columns = [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([vocab.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], names=names)

    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    names = ["doc_id", *(k.split(" ")[0] for k in kinds.split(", "))]
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(answer, f"doc_id long, {kinds}")
