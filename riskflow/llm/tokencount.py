"""Token counts by heap-and-linked-list byte-pair merging.

A word's bytes are its first symbols, linked in a list; a heap holds the ranks of all adjacent pairs that can be merged. The
lowest-ranked pair (the leftmost of equals) is popped and merged in the list, and the pairs with its new neighbours are
pushed. Pairs that have changed since are skipped when popped. The count is the number of first symbols less the
merges; no list of ids is made for a text. Counts of words, and of the pieces between spaces, are kept in bounded caches.

The order of work is the vocabulary file's: special strings (one token each), normal form C, white space, lower case, the
pattern, bytes, merges, for files with word ends; special strings, the pattern with the space before a word, bytes and merges
for byte-level files.

Null texts count as empty and have no tokens. Each row is counted on its own, so repeated rows, repeated ids and null ids stay as
they are; an empty table gives no rows. A word of any length is counted in time n log n. Other columns of the input are left alone.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.encode import byte_letters, tokenizer_path
from riskflow.llm.tables import slices, texts_of

#: Entries in each of a cache's two generations; longer words and pieces aren't kept.
KEPT, LONGEST = 200_000, 48
#: The public pattern of byte-level vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLACE = 40  # bits of a heap entry below the rank
_COMPOSED = re.compile("[^\x00-ɏ]")


class Cache:
    """Counts by text in two generations: what isn't asked for while a generation fills is forgotten."""

    def __init__(self, count):
        self.count, self.young, self.old = count, {}, {}

    def __call__(self, text: str) -> int:
        found = self.young.get(text)
        if found is None:
            found = self.old.get(text)
            if found is None:
                found = self.count(text)
            if len(text) <= LONGEST:
                if len(self.young) >= KEPT:
                    self.old, self.young = self.young, {}
                self.young[text] = found
        return found


class Counter:
    """``count(text)``: tokens of a whole text by a byte-pair file, with word ends or byte-level."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model = held["model"]
        ids = model["vocab"]
        self.ends = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.symbol = [ids[letters[b]] for b in range(256)]
        self.last = [ids[letters[b] + self.ends] for b in range(256)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Both symbols of a pair in one number: its rank and the symbol that it becomes.
        self.merge = {ids[a] << 20 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        special = sorted((t["content"] for t in held["added_tokens"]), key=len, reverse=True)
        self.cut_special = re.compile("|".join(re.escape(s) for s in special)).split
        self.words_in = regex.compile(held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if self.ends else BYTE_LEVEL).findall
        self.word = Cache(self.merged)
        self.piece = Cache(lambda piece: sum(map(self.word, self.words_in(piece))))

    def merged(self, word: str) -> int:
        """Symbols that are left of a word when no adjacent pair can be merged any more."""
        raw = word.encode("utf-8", "surrogatepass")
        n, merge = len(raw), self.merge
        symbols = [self.symbol[b] for b in raw[:-1]]
        symbols.append(self.last[raw[-1]])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [found[0] << _PLACE | i for i in range(n - 1) if (found := merge.get(symbols[i] << 20 | symbols[i + 1]))]
        heapq.heapify(heap)
        merges, place = 0, (1 << _PLACE) - 1
        while heap:
            top = heapq.heappop(heap)
            i = top & place
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            found = merge.get(symbols[i] << 20 | symbols[j])
            if found is None or found[0] != top >> _PLACE:
                continue  # one of the two has been merged meanwhile
            merges += 1
            symbols[i], symbols[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merge.get(symbols[i] << 20 | symbols[k]):
                    heapq.heappush(heap, found[0] << _PLACE | i)
            h = before[i]
            if h >= 0 and (found := merge.get(symbols[h] << 20 | symbols[i])):
                heapq.heappush(heap, found[0] << _PLACE | h)
        return n - merges

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self.plain(text)
        cut = self.cut_special(text)
        return len(cut) - 1 + sum(map(self.plain, cut))

    def plain(self, text: str) -> int:
        if not self.ends:
            return sum(map(self.word, self.words_in(text)))
        if _COMPOSED.search(text):
            text = unicodedata.normalize("NFC", text)
            # lower case goes letter by letter: the form of a sigma doesn't depend on its place
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        else:  # these letters are composed, and each has its own lower case
            text = text.lower()
        known, piece, total = self.piece.young.get, self.piece, 0
        for p in text.replace("\n", " ").split(" "):
            if p:
                found = known(p)
                if found is None:
                    found = piece(p)
                    known = piece.young.get
                total += found
        return total


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this Python worker; its caches live on between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, and over_limit where it has more than ``limit`` tokens. One pass, no shuffle."""

    def counted(batches):
        own = counter(tokenizer_path(tokenizer))
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            tokens = [own.count(t) for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
