"""Toxicity by the nearest labelled examples: exact TF-IDF cosine of passages over a block-max inverted index.

One insult drowns in the vector of a long text, so a text has two views, and the greater of their probabilities is its score. One is a
passage: of all its windows of ``passage`` words (a shorter text is one window) the one whose words speak most for the label, the first of equals. The other
is of all windows: every word of the whole text, weighed by what the best window over it speaks as a share of what the passage does, so that a second
passage counts as much as it speaks. How much a word speaks is its smoothed log odds among the examples, never below 0; for an example's own views
without its own label. Examples are held by their passages. ``passage=0`` takes whole texts, which are one view.

Terms are words of letters, all of them; bytes from 128 on count as letters, digits don't. The examples are at most ``examples``
labelled documents (the lowest hashes of their ids, of the share that isn't held out). Document frequencies of the examples' words are counted
over whole texts of all documents; a word of no example counts as of one row, which touches lengths only. Weights are
(1 + ln tf) * ln(1 + N / df), of length 1 over all words of the passage.

Distinct passages are put in order of likeness (by the rarest of their words that at least ``SHARED`` of them have) and cut into blocks of ``BLOCK``. A term lists
its blocks with its largest weight in each; terms in at least ``HEAVY`` of the blocks have these as rows of a matrix. A query sums them to a bound for each block,
scores the few blocks with the highest bounds, and then every other block whose bound reaches the k-th cosine: the neighbours are the exact ones. Whole texts have so
many words that bounds spare little; for them all cosines are summed. Equal passages are held once. Equal cosines go by the example's place.

The vote weighs each neighbour by 1 / (1.02 - cosine). Votes are turned into probabilities by isotonic regression on the examples'
own votes, each found without itself, for each view on its own. A document without any word of the examples has no direction: its score is the
smoothed share of toxic ones among the examples without one. Evidence are the passage's neighbours and the number of its terms found.

Null texts count as empty and have no terms. Rows with null ids or null labels aren't examples; null ids are scored and count
as not held out. Repeated rows get equal scores. Without examples the score is 0.5, with one kind of label the smoothed base
rate. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskflow.llm.fm import labelled
from riskflow.llm.tables import fresh, slices, stored, texts_of
from riskflow.llm.words import LETTERS, joined, word_hashes

EXAMPLES, NEIGHBOURS, BLOCK, THRESHOLD = 20_000, 15, 8, 0.5
#: Words of a passage, and examples' worth of smoothing in a word's odds (chosen by the examples' own votes without themselves).
PASSAGE, SMOOTH = 16, 5.0
#: Blocks scored first, and error allowed for in comparisons of sums.
FIRST, MARGIN = 4, 1e-9
#: Share of the passages from which a word puts them in order, and of the blocks from which its blocks are a row of a matrix.
SHARED, HEAVY = 0.002, 0.1
#: Share of the distinct passages from which a word's weights are a row of a matrix, where all cosines are summed.
FREQUENT = 0.03
#: Postings (or cells) looked at together, rows an executor hands on together.
AT_ONCE, HANDED = 1 << 17, 1 << 16
#: Examples whose own votes a task finds, and answers a worker keeps at hand.
VOTES, REMEMBERED = 500, 20_000


def _counted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    if not len(h):
        return o, h, np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
    return o[at], h[at], np.diff(np.concatenate([at, [len(h)]]))


def spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Terms:
    """Terms, looked up by hash: hashes are uniform, so their leading bits lead to a term or two."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))

    def __getstate__(self) -> dict:
        return {"hashes": self.hashes}

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for others."""
        if not hasattr(self, "_first"):
            bits = max(1, len(self.hashes).bit_length())
            self._shift = np.uint64(64 - bits)
            self._first = np.searchsorted(self.hashes >> self._shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        bucket = (hashes >> self._shift).astype(np.int64)
        at, end = self._first[bucket], self._first[bucket + 1]
        out = np.full(len(hashes), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], hashes[left]
        while len(left):
            there = self.hashes[at] == wanted
            out[left[there]] = at[there]
            on = np.flatnonzero(~there & (at + 1 < end))
            left, at, end, wanted = left[on], at[on] + 1, end[on], wanted[on]
        return out


def odds(toxic: np.ndarray, rows: np.ndarray, share: float) -> np.ndarray:
    """How much words speak for the label that ``share`` of the examples have, as whole numbers: their sums don't depend on order."""
    found = np.log((toxic + SMOOTH * share) / (rows - toxic + SMOOTH * (1 - share))) - np.log(share / (1 - share))
    return np.round(np.maximum(found, 0) * (1 << 20)).astype(np.int64)


def passages(bounds: np.ndarray, speak: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words, and first words after them, of the texts' passages."""
    starts, stops = bounds[:-1].copy(), bounds[1:].copy()
    long = np.flatnonzero(stops - starts > size) if size else []
    if len(long):
        total = np.concatenate([[0], np.cumsum(speak)])
        sums = total[size:] - total[:-size]
        for i in long.tolist():
            starts[i] += int(np.argmax(sums[starts[i]:stops[i] - size + 1]))
        stops[long] = starts[long] + size
    return starts, stops


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, ends = joined(texts)
    hashes, bounds, _ = word_hashes(data, ends, LETTERS)
    return hashes, bounds


def _passage_counts(hashes: np.ndarray, bounds: np.ndarray, speak: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term hash, count) of each distinct term of each text's passage."""
    starts, stops = passages(bounds, speak, size)
    return _counted(hashes[spans(starts, stops - starts)], np.repeat(np.arange(len(starts)), stops - starts))


def attention(bounds: np.ndarray, speak: np.ndarray, size: int) -> np.ndarray:
    """For each word, what the best window over it speaks as a share of what its text's best window does."""
    starts, stops = bounds[:-1], bounds[1:]
    total, n = np.concatenate([[0], np.cumsum(speak)]), len(speak)
    best, first = np.full(n, -1), np.arange(n)
    whole = np.flatnonzero(first + size <= np.repeat(stops, stops - starts))  # where windows begin
    best[whole] = total[whole + size] - total[whole]
    width = 1
    while width < size:  # the most of the last ``width`` windows that began
        step = min(width, size - width)
        best[step:] = np.maximum(best[step:], best[:-step])
        width += step
    out, long = np.ones(n), np.flatnonzero(stops - starts > size)
    at = spans(starts[long], (stops - starts)[long])
    if len(at):
        sizes = (stops - starts)[long]
        most = np.maximum.reduceat(best[at], np.cumsum(sizes) - sizes)
        out[at] = (best[at] + 1) / np.repeat(most + 1, sizes)  # the added one: all may say nothing
    return out


def _all_windows(hashes: np.ndarray, bounds: np.ndarray, speak: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term hash, weight before its idf) of each distinct term of each whole text."""
    heed, owner = attention(bounds, speak, size), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    if not len(h):
        return o, h, np.empty(0)
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
    return o[at], h[at], (1 + np.log(np.diff(np.append(at, len(h))))) * np.maximum.reduceat(heed[order], at)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (lowest vote, probability) of the best non-decreasing fit, each share smoothed by one of either label."""
    values, back = np.unique(x, return_inverse=True)
    n, pos = np.bincount(back).astype(float), np.bincount(back, y)
    pools: list[list[float]] = []
    for v, c, p in zip(values, n, pos):
        pools.append([v, c, p])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            _, c2, p2 = pools.pop()
            pools[-1][1] += c2
            pools[-1][2] += p2
    smoothed = np.maximum.accumulate(np.array([(p + 0.5) / (c + 1) for _, c, p in pools]))
    return np.array([v for v, _, _ in pools]), smoothed


@dataclass
class Index:
    """The examples' words, example by example and word by word."""

    terms: Terms  # words of the examples
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    k: int
    single_idf: float = 0.0  # of words of no example
    speak: np.ndarray = field(default=None)  # what the words say for the label
    passage: int = 0
    bag_term: np.ndarray = field(default=None)  # of the distinct examples, in order of likeness, then by term
    bag_count: np.ndarray = field(default=None)
    bag_starts: np.ndarray = field(default=None)
    bag_norm: np.ndarray = field(default=None)
    same: np.ndarray = field(default=None)  # examples by distinct example, then place
    same_starts: np.ndarray = field(default=None)
    steps: tuple[np.ndarray, np.ndarray] = field(default=None)
    wide_steps: tuple[np.ndarray, np.ndarray] = field(default=None)  # of the votes of all windows
    blank: float = 0.5
    constant: float | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}  # workers make the postings themselves

    def build(self, owner: np.ndarray, term: np.ndarray, count: np.ndarray) -> None:
        bounds = np.searchsorted(owner, np.arange(len(self.ids) + 1)).tolist()
        self.gather((term[a:b], count[a:b]) for a, b in zip(bounds, bounds[1:]))

    def gather(self, bags: Iterable[tuple[np.ndarray, np.ndarray]]) -> None:
        """Take (terms, counts) of each example, one at a time: the driver has little memory."""
        number: dict[bytes, int] = {}
        of, terms, counts, norms = [], [], [], []
        for term, count in bags:
            term, count = term.astype(np.int32), count.astype(np.int32)
            of.append(number.setdefault(blake2b(term.tobytes() + count.tobytes(), digest_size=16).digest(), len(number)))
            if of[-1] == len(terms):
                terms.append(term)
                counts.append(count)
                norms.append(max(float(np.sqrt((((1 + np.log(count)) * self.idf[term]) ** 2).sum())), 1e-12))
        df = np.bincount(np.concatenate([np.empty(0, np.int32), *terms]), minlength=len(self.idf))
        order = sorted(range(len(terms)), key=lambda i: (sorted((int(df[t]), int(t)) for t in terms[i] if df[t] > max(1, SHARED * len(terms))), i))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        of = place[np.array(of, np.int64)]
        self.same = np.argsort(of, kind="stable")
        self.same_starts = np.searchsorted(of[self.same], np.arange(len(number) + 1))
        self.bag_norm, self.bag_starts = np.array(norms)[order], np.concatenate([[0], np.cumsum([len(terms[i]) for i in order])])
        self.bag_term = np.concatenate([terms[i] for i in order])
        self.bag_count = np.concatenate([counts[i] for i in order])

    def _prepare(self) -> None:
        """Postings by term and example, the blocks that each term is in, and its largest weight there."""
        self._size, n = BLOCK, len(self.bag_norm)
        self._blocks = -(-n // BLOCK)
        order = np.argsort(self.bag_term, kind="stable")
        self._post_vector = np.repeat(np.arange(n), np.diff(self.bag_starts))[order]
        term = self.bag_term[order]
        self._post_weight = (1 + np.log(self.bag_count[order])) * self.idf[term] / self.bag_norm[self._post_vector]
        block = self._post_vector // BLOCK
        self._first = np.flatnonzero(np.diff(term, prepend=-1).astype(bool) | np.diff(block, prepend=-1).astype(bool))
        self._counts = np.diff(np.append(self._first, len(term)))
        self._block = block[self._first]
        self._most = np.maximum.reduceat(self._post_weight, self._first) if len(term) else np.empty(0)
        self._starts = np.searchsorted(term[self._first], np.arange(len(self.idf) + 1))
        self._df = np.bincount(term, minlength=len(self.idf))
        lists = np.diff(self._starts)
        heavy = np.flatnonzero(lists > HEAVY * self._blocks)
        self._row = np.full(len(self.idf), -1)
        self._row[heavy] = np.arange(len(heavy))
        self._heavy_entry = np.full((len(heavy), self._blocks), -1)  # few words are in that many blocks
        entry = spans(self._starts[heavy], lists[heavy])
        self._heavy_entry[np.repeat(np.arange(len(heavy)), lists[heavy]), self._block[entry]] = entry
        self._heavy_most = np.where(self._heavy_entry >= 0, np.append(self._most, 0)[self._heavy_entry], 0)
        self.scored_blocks = self.all_blocks = 0

    def search(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, cosines) of the k nearest with any common term, by cosine, then place, for each of n queries."""
        if not hasattr(self, "_most"):
            self._prepare()
        bounds, out = np.searchsorted(owner, np.arange(n + 1)), []
        visits = np.concatenate([[0], np.cumsum(np.bincount(owner, self._df[term], minlength=n).astype(np.int64) + self._blocks)])
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(visits, visits[low] + AT_ONCE, side="right")) - 1)
            a, b = bounds[low], bounds[high]
            out += self._nearest(owner[a:b] - low, term[a:b], weight[a:b], high - low, k)
            low = high
        return out

    def _nearest(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        row = self._row[term]
        light, heavy = np.flatnonzero(row < 0), np.flatnonzero(row >= 0)
        first = self._starts[term[light]]
        sizes = self._starts[term[light] + 1] - first
        entry = spans(first, sizes)
        lists = entry, np.repeat(owner[light] * self._blocks, sizes) + self._block[entry], np.repeat(weight[light], sizes)
        rows = np.searchsorted(owner[heavy], np.arange(n + 1)), row[heavy], weight[heavy]
        query = np.zeros((n, len(self._heavy_entry)))
        query[owner[heavy], rows[1]] = rows[2]
        bound = np.bincount(lists[1], lists[2] * self._most[entry], minlength=n * self._blocks).reshape(n, self._blocks) + query @ self._heavy_most
        most = min(self._blocks, -(-k // self._size) + FIRST)
        chosen = np.zeros(bound.shape, bool)
        np.put_along_axis(chosen, np.argpartition(bound, self._blocks - most, axis=1)[:, self._blocks - most:], True, axis=1)
        chosen &= bound > 0
        query, vector, cosine = self._cosines(lists, rows, chosen)
        least = self._kth(query, cosine, n, k)
        rest = (bound >= (least * (1 - MARGIN))[:, None]) & (bound > 0) & ~chosen
        if rest.any():
            more = self._cosines(lists, rows, rest)
            near = more[2] >= least[more[0]] * (1 - MARGIN)
            query, vector, cosine = (np.concatenate([x, y[near]]) for x, y in zip((query, vector, cosine), more))
        self.scored_blocks += int(chosen.sum() + rest.sum())
        self.all_blocks += chosen.size
        return self._ranked(query, vector, cosine, n, k)

    def search_all(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """What ``search`` finds, for queries of so many words that bounds leave few blocks out: by the cosines of all distinct examples."""
        if not hasattr(self, "_most"):
            self._prepare()
        if not hasattr(self, "_dense"):
            frequent = np.flatnonzero(self._df > FREQUENT * len(self.bag_norm))
            self._dense_row, self._post_starts = np.full(len(self.idf), -1), np.concatenate([[0], np.cumsum(self._df)])
            self._dense_row[frequent] = np.arange(len(frequent))
            self._dense = np.zeros((len(frequent), self._blocks * self._size))
            at = spans(self._post_starts[frequent], self._df[frequent])
            self._dense[np.repeat(np.arange(len(frequent)), self._df[frequent]), self._post_vector[at]] = self._post_weight[at]
        bounds, out, width = np.searchsorted(owner, np.arange(n + 1)), [], self._dense.shape[1]
        visits = np.concatenate([[0], np.cumsum(np.bincount(owner, np.where(self._dense_row[term] < 0, self._df[term], 0), minlength=n).astype(np.int64) + width)])
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(visits, visits[low] + 8 * AT_ONCE, side="right")) - 1)
            part = slice(bounds[low], bounds[high])
            out += self._nearest_of_all(owner[part] - low, term[part], weight[part], high - low, k)
            low = high
        return out

    def _nearest_of_all(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        row, width = self._dense_row[term], self._dense.shape[1]
        rare, frequent = np.flatnonzero(row < 0), np.flatnonzero(row >= 0)
        query = np.zeros((n, len(self._dense)))
        query[owner[frequent], row[frequent]] = weight[frequent]
        sizes = self._df[term[rare]]
        sums = query @ self._dense
        at = spans(self._post_starts[term[rare]], sizes)
        sums += np.bincount(np.repeat(owner[rare] * width, sizes) + self._post_vector[at], np.repeat(weight[rare], sizes) * self._post_weight[at], minlength=n * width).reshape(n, width)
        least = np.zeros(n)
        if self._blocks >= k:  # k groups, of one example from each stretch, have one that reaches it
            least = np.partition(sums.reshape(n, self._size, self._blocks).max(axis=1), self._blocks - k, axis=1)[:, self._blocks - k]
        query, vector = np.divmod(np.flatnonzero(sums >= np.maximum(least * (1 - MARGIN), np.nextafter(0, 1))[:, None]), max(width, 1))
        return self._ranked(query, vector, sums[query, vector], n, k)

    def _ranked(self, query: np.ndarray, vector: np.ndarray, cosine: np.ndarray, n: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k best of each query's candidates."""
        least = self._kth(query, cosine, n, k)
        near = np.flatnonzero(cosine >= least[query] * (1 - MARGIN))
        near = near[np.argsort(query[near], kind="stable")]
        cut, vector, cosine = np.searchsorted(query[near], np.arange(n + 1)), vector[near], np.round(np.minimum(cosine[near], 1.0), 12)
        return [self._best(vector[a:b], cosine[a:b], k) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def _cosines(self, lists: tuple, rows: tuple, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, distinct example, cosine) of all that have a common term in the chosen blocks."""
        chosen = chosen.ravel()
        (entry, cell, weight), (cut, row, said) = lists, rows
        pairs, number = np.flatnonzero(chosen), np.cumsum(chosen) - 1
        keep = np.flatnonzero(chosen[cell])
        query, block = pairs // self._blocks, pairs % self._blocks
        count = cut[query + 1] - cut[query]
        word = spans(cut[query], count)
        found = self._heavy_entry[row[word], np.repeat(block, count)]
        there = np.flatnonzero(found >= 0)
        entry = np.concatenate([entry[keep], found[there]])
        pair = np.concatenate([number[cell[keep]], np.repeat(np.arange(len(pairs)), count)[there]])
        weight, sizes = np.concatenate([weight[keep], said[word[there]]]), self._counts[entry]
        at = spans(self._first[entry], sizes)
        slot = np.repeat(pair * self._size, sizes) + self._post_vector[at] % self._size
        sums = np.bincount(slot, np.repeat(weight, sizes) * self._post_weight[at], minlength=len(pairs) * self._size)
        hit = np.flatnonzero(sums)
        pair = hit // self._size
        return query[pair], block[pair] * self._size + hit % self._size, sums[hit]

    @staticmethod
    def _kth(query: np.ndarray, cosine: np.ndarray, n: int, k: int) -> np.ndarray:
        """Each query's k-th cosine, 0 where there are fewer."""
        order = np.lexsort((-cosine, query))
        cut = np.searchsorted(query[order], np.arange(n + 1))
        out, enough = np.zeros(n), np.flatnonzero(np.diff(cut) >= k)
        out[enough] = cosine[order[cut[enough] + k - 1]]
        return out

    def _best(self, vector: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        copies = np.minimum(self.same_starts[vector + 1] - self.same_starts[vector], k)
        example, cosine = self.same[spans(self.same_starts[vector], copies)], np.repeat(cosine, copies)
        rank = np.lexsort((example, -cosine))[:k]
        return example[rank], cosine[rank]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of one query's k nearest."""
        return self._without(*self.search(np.zeros(len(terms), np.int64), terms, weights, 1, self.k + 1)[0], without)

    def _without(self, examples: np.ndarray, cosines: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        keep = examples != without
        return examples[keep][:self.k], cosines[keep][:self.k]

    def weigh(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, term number, weight) of the passages' words that examples have, of length 1 over all words."""
        return self._weigh(*self._spoken(texts))

    def _spoken(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """The texts' words, where each text begins, and how much the words speak."""
        hashes, bounds = _words(texts)
        return hashes, bounds, np.append(self.speak, 0)[self.terms.places(hashes)] if self.passage else None

    def _weigh(self, hashes: np.ndarray, bounds: np.ndarray, speak: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, hashes, count = _passage_counts(hashes, bounds, speak, self.passage)
        return self._directed(owner, hashes, 1 + np.log(count), len(bounds) - 1)

    def widely(self, hashes: np.ndarray, bounds: np.ndarray, speak: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, term number, weight) of the whole texts' words that examples have: every window counts, by what it speaks."""
        return self._directed(*_all_windows(hashes, bounds, speak, self.passage), len(bounds) - 1)

    def _directed(self, owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number = self.terms.places(hashes)
        weight = weight * np.append(self.idf, self.single_idf)[number]
        norm = np.maximum(np.sqrt(np.bincount(owner, weight * weight, minlength=n)), 1e-12)
        known = np.flatnonzero(number >= 0)
        return owner[known], number[known], weight[known] / norm[owner[known]]

    def wide_votes(self, hashes: np.ndarray, bounds: np.ndarray, speak: np.ndarray | None, examples: np.ndarray | None = None) -> list[float | None]:
        """The votes of all windows of texts longer than a passage (of ``examples`` without themselves); None for others, and without neighbours."""
        long = np.flatnonzero(np.diff(bounds) > self.passage) if self.passage else np.empty(0, np.int64)
        out: list[float | None] = [None] * (len(bounds) - 1)
        if len(long):
            sizes = np.diff(bounds)[long]
            at = spans(bounds[:-1][long], sizes)
            owner, term, weight = self.widely(hashes[at], np.concatenate([[0], np.cumsum(sizes)]), speak[at])
            for i, near in zip(long.tolist(), self.search_all(owner, term, weight, len(long), self.k + (examples is not None))):
                near = self._without(*near, -1 if examples is None else examples[i])
                out[i] = self.vote(*near) if len(near[0]) else None
        return out

    def vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        weight = 1 / (1.02 - cosines)
        return float((weight * self.labels[examples]).sum() / weight.sum())

    def own_votes(self, examples: np.ndarray) -> list[tuple[int, float]]:
        """Examples that have neighbours besides themselves, and their votes without themselves."""
        of = np.empty(len(self.ids), np.int64)
        of[self.same] = np.repeat(np.arange(len(self.bag_norm)), np.diff(self.same_starts))
        out = []
        for low in range(0, len(examples), VOTES):
            chosen = examples[low:low + VOTES]
            vector = of[chosen]
            sizes = self.bag_starts[vector + 1] - self.bag_starts[vector]
            at, owner = spans(self.bag_starts[vector], sizes), np.repeat(np.arange(len(chosen)), sizes)
            term = self.bag_term[at].astype(np.int64)
            weight = (1 + np.log(self.bag_count[at])) * self.idf[term] / self.bag_norm[vector][owner]
            for i, near in zip(chosen.tolist(), self.search(owner, term, weight, len(chosen), self.k + 1)):
                near = self._without(*near, i)
                if len(near[0]):
                    out.append((i, self.vote(*near)))
        return out

    def bare(self) -> np.ndarray:
        """Examples without a direction."""
        empty = np.flatnonzero(np.diff(self.bag_starts) == 0)
        return self.same[spans(self.same_starts[empty], np.diff(self.same_starts)[empty])]

    def settle(self, votes: list[tuple[int, float]]) -> None:
        """Probabilities from each example's own vote, and the share of toxic ones without a direction."""
        bare = self.bare()
        self.blank = float((self.labels[bare].sum() + 0.5) / (len(bare) + 1 + (len(bare) == 0)))
        self.steps = isotonic(np.array([v for _, v in votes]), self.labels[[i for i, _ in votes]].astype(float)) if votes else (np.zeros(1), np.array([self.blank]))

    def probability(self, vote: float, steps: tuple[np.ndarray, np.ndarray] | None = None) -> float:
        at, share = steps or self.steps
        return float(share[max(0, np.searchsorted(at, vote, side="right") - 1)])

    def score(self, texts: list[str]) -> list[tuple[float, np.ndarray, np.ndarray, int]]:
        """(score, neighbours' ids, cosines, terms found) of each text; equal texts are answered once, from a bounded memory."""
        if self.constant is not None:
            return [(self.constant, np.empty(0, np.int64), np.empty(0), 0)] * len(texts)
        known = self.__dict__.setdefault("_known", {})
        keys = [blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        new = {key: t for key, t in zip(keys, texts) if key not in known}
        out = {key: known[key] for key in keys if key in known}
        if new:
            spoken = self._spoken(list(new.values()))
            owner, term, weight = self._weigh(*spoken)
            sizes = np.bincount(owner, minlength=len(new)).tolist()
            wide = self.wide_votes(*spoken) if self.wide_steps else [None] * len(new)
            for key, size, vote, (examples, cosines) in zip(new, sizes, wide, self.search(owner, term, weight, len(new), self.k)):
                found = self.probability(self.vote(examples, cosines)) if len(examples) else self.blank
                if vote is not None:
                    found = max(found, self.probability(vote, self.wide_steps))
                out[key] = (found, self.ids[examples], cosines, size) if len(examples) else (found, np.empty(0, np.int64), np.empty(0), 0)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[key] = out[key]
        return [out[key] for key in keys]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text_col: str = "text", examples: int = EXAMPLES, k: int = NEIGHBOURS,
        passage: int = PASSAGE) -> Index:
    """The index of at most ``examples`` labelled documents; frequencies are counted over all of ``docs``."""
    spark = docs.sparkSession
    chosen = labelled(docs.select("doc_id", text_col), labels, label, [text_col], examples).select("d_id", "text", "y")
    # At most ``examples`` rows: their places are small work for one task.
    sample = stored(chosen.withColumn("place", F.row_number().over(Window.orderBy("d_id", "y", "text")) - 1), "examples")
    sample = sample.repartition(spark.sparkContext.defaultParallelism, "place")
    kinds = sample.agg(F.count(F.lit(1)), F.coalesce(F.count_if(F.col("y") > 0), F.lit(0))).first()
    if not kinds[0] or kinds[1] in (0, kinds[0]):
        return Index(Terms(np.empty(0)), np.empty(0), np.empty(0), np.empty(0), k, constant=(kinds[1] + 1) / (kinds[0] + 2))

    def words(batches):
        for batch in slices(batches):
            hashes, bounds = _words(texts_of(batch.column(1)))
            owner, term, _ = _counted(hashes, np.repeat(np.arange(batch.num_rows), np.diff(bounds)))
            marked = (batch.column(2).to_numpy() > 0)[owner]
            distinct, back = np.unique(term, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(np.bincount(back, marked, len(distinct)).astype(np.int64)),
                                              pa.array(np.bincount(back, minlength=len(distinct)).astype(np.int64))], names=["term", "toxic", "n"])

    # the examples' distinct words: a few for each of at most ``examples`` rows
    found = sample.mapInArrow(words, "term long, toxic long, n long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).toArrow()
    hashes = found["term"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    toxic, rows = found["toxic"].to_numpy()[order], found["n"].to_numpy()[order]
    share, terms = kinds[1] / kinds[0], Terms(hashes)
    del found, hashes, order
    sent = spark.sparkContext.broadcast((terms, toxic, rows))

    def bags(batches):
        known, marked, held = sent.value
        for batch in slices(batches):
            hashes, bounds = _words(texts_of(batch.column(1)))
            place, y = known.places(hashes), np.repeat(batch.column(2).to_numpy() > 0, np.diff(bounds))
            owner, term, count = _passage_counts(hashes, bounds, odds(marked[place] - y, held[place] - 1, share), passage)
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(3).cast(pa.int64()), batch.column(0), batch.column(2).cast(pa.int32()), pa.array([known.places(term[a:b]).astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                                              pa.array([count[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], names=["place", "d_id", "y", "terms", "counts"])

    # Arrow's buffers, not row objects: at most ``examples`` passages.
    table = sample.mapInArrow(bags, "place long, d_id long, y int, terms binary, counts binary").toArrow()
    places, numbers = ([v.as_buffer() for chunk in table[c].chunks for v in chunk] for c in ("terms", "counts"))
    held = sorted((place, d, y, i) for i, (place, d, y) in enumerate(zip(*(table[c].to_pylist() for c in ("place", "d_id", "y")))))
    total, df = _frequencies(docs.select(text_col), sent)
    index = Index(terms, np.log(1 + total / np.maximum(df, 1)), np.array([d for _, d, *_ in held], np.int64), np.array([int(y > 0) for _, _, y, _ in held]), k,
                  float(np.log(1 + total)), odds(toxic, rows, share), passage)
    index.gather((np.frombuffer(places[i], np.int32), np.frombuffer(numbers[i], np.int32)) for *_, i in held)
    del table, places, numbers, held, df
    pa.default_memory_pool().release_unused()
    held = index._sent = spark.sparkContext.broadcast(index)  # of at most ``examples`` rows

    def votes(batches):
        for batch in batches:
            found = held.value.own_votes(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([v for _, v in found], pa.float64())], names=["example", "vote"])

    n = len(index.ids)
    voted = spark.range(0, n, 1, -(-n // VOTES)).mapInArrow(votes, "example long, vote double").toArrow().to_pydict()  # one row per example
    index.settle(sorted(zip(voted["example"], voted["vote"])))

    def wide(batches):
        known, marked, rows = sent.value
        for batch in slices(batches):
            hashes, bounds = _words(texts_of(batch.column(1)))
            place, y = known.places(hashes), np.repeat(batch.column(2).to_numpy() > 0, np.diff(bounds))
            examples = batch.column(3).to_numpy()
            found = held.value.wide_votes(hashes, bounds, odds(marked[place] - y, rows[place] - 1, share), examples)
            yield pa.RecordBatch.from_arrays([pa.array(examples, pa.int64()), pa.array(found, pa.float64())], names=["example", "vote"])

    if passage:
        voted = sample.mapInArrow(wide, "example long, vote double").where("vote is not null").toArrow().to_pydict()  # one row per example
        at, votes_of = np.array(voted["example"], np.int64), np.array(voted["vote"])
        index.wide_steps = isotonic(votes_of, index.labels[at].astype(float)) if len(at) else None
    return index


def _frequencies(texts: DataFrame, sent) -> tuple[int, np.ndarray]:
    """The number of rows, and of rows with each of the examples' words; a task sends one sum for each word."""

    def counts(batches):
        terms, rows = sent.value[0], 0
        width = len(terms.hashes)
        sums = np.zeros(width, np.int64)
        for batch in slices(batches):
            hashes, bounds = _words(texts_of(batch.column(0)))
            place = terms.places(hashes)
            here = place >= 0
            distinct = np.unique((np.repeat(np.arange(batch.num_rows), np.diff(bounds)) * width + place)[here])
            sums += np.bincount(distinct % max(width, 1), minlength=width)
            rows += batch.num_rows
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([rows], pa.int64())], names=["term", "n"])
        for at in range(0, len(found), HANDED):
            part = found[at:at + HANDED]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[part])], names=["term", "n"])

    found = texts.mapInArrow(counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most the examples' words
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(sent.value[0].hashes), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), df


def score(docs: DataFrame, index: Index, text_col: str = "text", name: str = "score", evidence: bool = False) -> DataFrame:
    """``docs`` with the score (and the evidence: neighbours, cosines, terms); all other columns pass through."""
    extra = [StructField(name, DoubleType())]
    if evidence:
        from pyspark.sql.types import ArrayType, IntegerType, LongType

        extra += [StructField("neighbours", ArrayType(LongType())), StructField("cosines", ArrayType(DoubleType())), StructField("terms_found", IntegerType())]
    rest = docs.drop(*(f.name for f in extra))
    held = getattr(index, "_sent", None) or docs.sparkSession.sparkContext.broadcast(index)  # of at most ``examples`` rows
    steps, wide_steps, blank = index.steps, index.wide_steps, index.blank  # found after the index was sent
    t, = fresh(rest, "scored_text")

    def run(batches):
        held.value.steps, held.value.wide_steps, held.value.blank = steps, wide_steps, blank
        for batch in slices(batches):
            found = held.value.score(texts_of(batch.column(batch.num_columns - 1)))
            columns = [pa.array([f[0] for f in found], pa.float64())]
            if evidence:
                columns += [pa.array([f[1].tolist() for f in found], pa.list_(pa.int64())), pa.array([f[2].tolist() for f in found], pa.list_(pa.float64())), pa.array([f[3] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *(f.name for f in extra)])

    return rest.withColumn(t, F.col(text_col)).mapInArrow(run, StructType([*rest.schema.fields, *extra]))
