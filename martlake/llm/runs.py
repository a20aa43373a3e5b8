"""Periodic runs in the words of texts, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q, at least `exponent` periods and `least` words long, that no
neighbouring word extends. Per text, words are numbered and the most frequent pair of neighbours is replaced by a new
symbol as long as a pair stands twice. That is done for all texts of a piece at once and in rounds: a round replaces every pair
that no overlapping pair beats in frequency, which gives the grammar that one pair after the other would. What is left of
a text is joined by a balanced tree of symbols that occur once. A run crosses the middle of exactly one symbol of the
derivation around it, so each symbol is searched once, for runs across its middle only: at least two periods lie on one side, so
q words there must equal the next q, and comparisons of hashed ranges tell how far the period reaches. Runs of a
symbol are then put at each place it is derived at, cut ones merge with the whole ones around them, and every result is checked
word by word.

Bounds: a piece is half a megabyte of texts or one longer text; its grammar and tree take a few numbers a word, and
places to search are gone through `CHUNK` at a time. Work grows with words times the depth of the tree.

Defined cases: null and empty texts have no words and no runs, texts of any length are searched whole, repeated rows and ids
are rows of their own, no rows give no rows; other columns are carried along, those with a result's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martlake.llm.common import lean
from martlake.llm.textbytes import NOT_SPACE, distinct, find_words, gather, pieces

#: Places searched at once.
CHUNK = 1 << 20
PRIMES = (np.int64(2147483647), np.int64(2147483629))

RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)


class Grammar:
    """Rules of two symbols each. Symbols below `terminals` are words; `place` is where a rule's words stand first."""

    def __init__(self, words: np.ndarray):
        self.terminals = int(words.max()) + 1 if len(words) else 0
        self.left, self.right, self.place = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.size = np.ones(self.terminals, dtype=np.int64)
        self.rounds: list[tuple[int, int]] = []

    def add(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> int:
        """The number of the first of the new symbols."""
        first = self.terminals + len(self.left)
        self.rounds.append((len(self.left), len(self.left) + len(left)))
        self.left = np.concatenate([self.left, left])
        self.right = np.concatenate([self.right, right])
        self.place = np.concatenate([self.place, place])
        self.size = np.concatenate([self.size, self.size[left] + self.size[right]])
        return first


def re_pair(words: np.ndarray, text: np.ndarray) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """The grammar of texts whose words are numbered apart for each text, the symbols left, and where these start."""
    grammar = Grammar(words)
    symbol, start = words.astype(np.int64), np.arange(len(words))
    # Whether a symbol's pair with the next one may still stand twice; once a pair is alone, it and what becomes of it stay so.
    linked = np.concatenate([text[1:] == text[:-1], [False]]) if len(text) else np.zeros(0, dtype=bool)
    settled: list[tuple[np.ndarray, np.ndarray]] = []
    while linked.any():
        at = np.flatnonzero(linked)
        a, b = symbol[at], symbol[at + 1]
        # In a row of equal symbols every second pair counts, from the left.
        same = a == b
        head = same.copy()
        head[1:] &= ~(same[:-1] & (at[1:] == at[:-1] + 1))
        order = np.arange(len(at))
        first = np.maximum.accumulate(np.where(head, order, 0))
        counted = ~(same & ((order - first) % 2 == 1))
        at, pair = at[counted], (a << 32 | b)[counted]
        pairs, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        often = (counts >= 2)[which]
        linked[at[~often]] = False
        at, which = at[often], which[often]
        removed = np.zeros(len(symbol), dtype=bool)
        if len(at):
            rank = np.empty(len(pairs), dtype=np.int64)
            rank[np.lexsort((pairs, -counts))] = np.arange(len(pairs))
            place_rank = rank[which]
            overlap = at[1:] == at[:-1] + 1
            beaten = np.zeros(len(pairs), dtype=bool)
            beaten[which[:-1][overlap & (place_rank[1:] < place_rank[:-1])]] = True
            beaten[which[1:][overlap & (place_rank[:-1] < place_rank[1:])]] = True
            chosen = ~beaten[which]
            at, which = at[chosen], which[chosen]
            _, example, new = np.unique(which, return_index=True, return_inverse=True)
            example = at[example]
            symbol[at] = grammar.add(symbol[example], symbol[example + 1], start[example]) + new
            linked[at] = linked[at + 1]
            removed[at + 1] = True
        symbol, start, linked = symbol[~removed], start[~removed], linked[~removed]
        alone = ~linked
        alone[1:] &= ~linked[:-1]
        settled.append((symbol[alone], start[alone]))
        symbol, start, linked = symbol[~alone], start[~alone], linked[~alone]
    settled.append((symbol, start))
    symbol, start = (np.concatenate(x) for x in zip(*settled, strict=True))
    order = np.argsort(start)
    return grammar, symbol[order], start[order]


def tree_nodes(start: np.ndarray, end: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Begin, middle and end of the nodes of balanced trees over each text's symbols, one level at a time."""
    while True:
        n = len(start)
        order = np.arange(n)
        head = np.ones(n, dtype=bool)
        head[1:] = text[1:] != text[:-1]
        even = (order - np.maximum.accumulate(np.where(head, order, 0))) % 2 == 0 if n else head
        left = np.flatnonzero(even[:-1] & (text[1:] == text[:-1])) if n else order
        if not len(left):
            return
        yield start[left], start[left + 1], end[left + 1]
        end = end.copy()
        end[left] = end[left + 1]
        keep = np.ones(n, dtype=bool)
        keep[left + 1] = False
        start, end, text = start[keep], end[keep], text[keep]


class Hashes:
    """Equality of ranges of words by polynomial sums modulo two primes; `salt` picks the base."""

    def __init__(self, words: np.ndarray, salt: int):
        rng = np.random.default_rng(987_001 + salt)
        self.sums, self.powers = [], []
        for prime in PRIMES:
            base = int(rng.integers(1 << 20, int(prime)))
            powers = np.ones(1, dtype=np.int64)
            while len(powers) <= len(words):
                powers = np.concatenate([powers, powers * pow(base, len(powers), int(prime)) % prime])
            terms = (words + 1) % prime * powers[: len(words)] % prime
            self.sums.append(np.concatenate([[0], np.cumsum(terms)]) % prime)
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from a on are those from b on, a < b."""
        same = np.ones(len(a), dtype=bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            one = (sums[a + n] - sums[a]) % prime * powers[b - a] % prime
            same &= one == (sums[b + n] - sums[b]) % prime
        return same

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from a and b on (or before them) are equal, up to `most`."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = self.equal(a, b, middle) if forward else self.equal(a - middle, b - middle, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def crossing(
    words: np.ndarray, hashes: Hashes, low: np.ndarray, mid: np.ndarray, high: np.ndarray, least: int, exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs across the middles of ranges of words: the range's number, start, end and period."""
    found = [[], [], [], []]
    span = np.where(high - low >= least, (high - low) // exponent, 0)
    for forward in (True, False):
        most = np.minimum(span, (high - mid if forward else mid - low) // 2)
        edges = np.concatenate([[0], np.cumsum(most)])
        for begin in range(0, int(edges[-1]), CHUNK):
            flat = np.arange(begin, min(begin + CHUNK, int(edges[-1])))
            node = np.searchsorted(edges, flat, side="right") - 1
            q = flat - edges[node] + 1
            m = mid[node]
            # The first and the last word of the period next to the middle.
            if forward:
                maybe = (words[m] == words[m + q]) & (words[m + q - 1] == words[m + 2 * q - 1])
            else:
                maybe = (words[m - 1] == words[m - 1 - q]) & (words[m - q] == words[m - 2 * q])
            node, q, m = node[maybe], q[maybe], m[maybe]
            a = m if forward else m - q
            right = hashes.reach(a, a + q, high[node] - a - q, True)
            left = hashes.reach(a, a + q, a - low[node], False)
            start, end = a - left, a + q + right
            good = (end - start >= np.maximum(least, exponent * q)) & (start < m) & (end > m)
            for out, x in zip(found, (node, start, end, q), strict=True):
                out.append(x[good])
    node, start, end, q = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in found)
    # A multiple of a period gives the same range: the smallest stays.
    order = np.lexsort((q, end, start, node))
    node, start, end, q = node[order], start[order], end[order], q[order]
    fresh = np.ones(len(node), dtype=bool)
    fresh[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[fresh], start[fresh], end[fresh], q[fresh]


def derive(grammar: Grammar, rule: np.ndarray, symbol: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the symbols that `rule` marks (one flag per rule): rule number and first word."""
    holds = np.concatenate([np.zeros(grammar.terminals, dtype=bool), rule])
    for begin, end in grammar.rounds:
        new = slice(grammar.terminals + begin, grammar.terminals + end)
        holds[new] |= holds[grammar.left[begin:end]] | holds[grammar.right[begin:end]]
    found: tuple[list, list] = [], []
    while True:
        inside = holds[symbol]
        symbol, start = symbol[inside], start[inside]
        if not len(symbol):
            break
        number = symbol - grammar.terminals
        own = rule[number]
        found[0].append(number[own])
        found[1].append(start[own])
        left, right = grammar.left[number], grammar.right[number]
        symbol, start = np.concatenate([left, right]), np.concatenate([start, start + grammar.size[left]])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(found[0] or none), np.concatenate(found[1] or none)


def merge(start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of one period that share at least a period are parts of one run."""
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    if not len(q):
        return start, end, q
    group = np.cumsum(np.concatenate([[0], (q[1:] != q[:-1]).astype(np.int64)]))
    wide = np.int64(end.max() + 1)
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    new = np.ones(len(q), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - q[1:])
    heads = np.flatnonzero(new)
    return start[heads], np.maximum.reduceat(end, heads), q[heads]


def find_runs(words: np.ndarray, text: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in texts laid one after another, by start and period.

    `words` are numbers that are apart for each text, `text` says which one a word is in. A period is searched for from the
    side of a middle that holds two of it, which every run of four periods has.
    """
    if exponent < 4:
        raise ValueError("runs are searched from four periods on")
    grammar, symbol, first = re_pair(words, text)
    sizes = grammar.size[symbol]
    middle = grammar.place + grammar.size[grammar.left]
    ends = grammar.place + grammar.size[grammar.terminals :]
    salt = 0
    while True:
        hashes = Hashes(words, salt)
        node, start, end, q = crossing(words, hashes, grammar.place, middle, ends, least, exponent)
        marked = np.zeros(len(grammar.place), dtype=bool)
        marked[node] = True
        number, place = derive(grammar, marked, symbol, first)
        # Every place of a rule gets all runs of the rule.
        begin, stop = np.searchsorted(node, number), np.searchsorted(node, number, side="right")
        which = np.repeat(begin - np.concatenate([[0], np.cumsum(stop - begin)[:-1]]), stop - begin) + np.arange((stop - begin).sum())
        shift = np.repeat(place - grammar.place[number], stop - begin)
        parts = [(start[which] + shift, end[which] + shift, q[which])]
        for low, mid, high in tree_nodes(first, first + sizes, text[first]):
            _, start, end, q = crossing(words, hashes, low, mid, high, least, exponent)
            parts.append((start, end, q))
        start, end, q = merge(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        # Hashes can only make ranges too long; then others are taken.
        if all(np.array_equal(words[s : e - p], words[s + p : e]) for s, e, p in zip(start, end, q, strict=True)):
            order = np.lexsort((q, start))
            return start[order], end[order], q[order]
        salt += 1


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """The other columns with n_words, runs (start, length, period; by start, then period) and the collapsed text.

    The collapsed text is made of the words that no run holds after its first period, joined by one space.
    """
    keep = [c for c in docs.columns if c not in (text_col, *RUNS.names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(len(keep))):
                found = find_words(piece, piece.data, NOT_SPACE)
                raw, edges = gather(piece.data, found.start, found.end - found.start)
                value, values = distinct(raw, edges)
                _, words = np.unique(found.text * np.int64(len(values) + 1) + value, return_inverse=True)
                start, end, q = find_runs(words, found.text, least, exponent)
                # Dropped words, as sums of borders.
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(covered, start + q, 1)
                np.add.at(covered, end, -1)
                stays = np.cumsum(covered[:-1]) == 0
                counts = np.diff(np.searchsorted(start, found.first))
                firsts = np.repeat(found.first[:-1], counts)
                entries = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start - firsts, end - start, q)], names=["start", "length", "period"]
                )
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                arrays = [batch.column(k).slice(piece.first, piece.n) for k in range(len(keep))]
                arrays += [
                    pa.array(np.diff(found.first), pa.int64()),
                    pa.ListArray.from_arrays(offsets, entries),
                    joined(piece.data, found.start[stays], found.end[stays], found.text[stays], piece.n),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *RUNS.names])

    schema = T.StructType([*[docs.schema[c] for c in keep], *RUNS.fields])
    return docs.select(*keep, text_col).mapInArrow(lean(run), schema)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    """The words of each of n texts with one space between them."""
    more = np.zeros(len(start), dtype=np.int64)
    more[:-1] = text[1:] == text[:-1]
    spaced = np.append(data, np.uint8(0x20))
    raw, edges = gather(spaced, start, end - start + more)
    raw[edges[1:][more == 1] - 1] = 0x20
    borders = edges[np.searchsorted(text, np.arange(n + 1))].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(borders), pa.py_buffer(raw)]).cast(pa.string())
