"""Packing of token sequences by cutting-stock column generation.

Every document is its ids and an end id. As many whole sequences as fit are cut off its front; what remains is shorter than a
sequence. The remainders' length histogram (at most `size` - 1 rows, whatever the corpus) goes to the driver, which solves the linear
program of cutting stock: patterns of lengths that fill a sequence, as few sequences as possible. The simplex method starts
with patterns that take the longest lengths first; a knapsack over all capacities prices patterns with the duals, and the best columns enter. It ends when
no pattern prices out, when the objective is within `GAP` of a bound that the tokens or the duals give, or no longer falls.
Each pattern is used a whole number of times, rounded up as far as its documents last, if it leaves at most `SLACK` tokens open.

Documents of one length are ranked, by written task and place in it, and ranks up to a pattern's use go to its places. The
rest, which rounding leaves, is laid end to end by length and rank and cut where a sequence is full; the last of these
sequences is cut into powers of two, which need no padding.
So no document is left out, and only the ends of patterns are padded.

Ids are the tokenizer's, once for each distinct word of a batch: its pre-tokens never hold white space. Plain words of Latin letters
are merged by the same vocabulary read as ranks, which gives the same ids faster; all others go through the `tokenizers` library.
A worker keeps up to `REMEMBER` words.

Bounds: the driver holds one row per length and the patterns, whose places are broadcast (at most `size` patterns of at most
64 different lengths); ranks of lengths are offset by one row per task and length, broadcast if `common.small` says so.

Defined cases: null and empty texts are the end id alone; texts of any length are taken whole; rows that repeat an id are
documents of their own; no rows give no pieces; other columns are left out, names that clash do no harm.
"""

from __future__ import annotations

import json
import math
import os
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.align import decode_table
from martlake.llm.common import lean, small, stored
from martlake.llm.textbytes import NOT_SPACE, distinct, find_words, gather, pieces

GAP, SLACK, ROUNDS, ENTERING, STALLED = 0.0005, 8, 200, 40, 10
REMEMBER, TOGETHER, PIECE = 400_000, 2000, 1 << 21
TINY = 1e-9


# The linear program.


def knapsack(value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity the best total of values by length, and the last length taken (0: one token stays open)."""
    best, last = np.zeros(size + 1), np.zeros(size + 1, dtype=np.int64)
    for c in range(1, size + 1):
        totals = best[c - 1 :: -1][:c] + value[1 : c + 1]
        k = int(np.argmax(totals))
        if totals[k] > best[c - 1]:
            best[c], last[c] = totals[k], k + 1
        else:
            best[c] = best[c - 1]
    return best, last


def pattern_at(last: np.ndarray, capacity: int) -> dict[int, int]:
    """Lengths of the best filling of a capacity, and how often each is in it."""
    found: dict[int, int] = {}
    while capacity > 0:
        length = int(last[capacity])
        if length:
            found[length] = found.get(length, 0) + 1
        capacity -= max(length, 1)
    return found


def columns(value: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, list[dict[int, int]]]:
    """The value of the best pattern, and patterns worth more than one sequence, the best first, each made around another length."""
    best, last = knapsack(value, size)
    totals = value[lengths] + best[size - lengths]
    found, seen = [], set()
    for k in np.argsort(-totals)[: 4 * ENTERING]:
        if totals[k] <= 1 + TINY or len(found) == ENTERING:
            break
        pattern = pattern_at(last, int(size - lengths[k]))
        pattern[int(lengths[k])] = pattern.get(int(lengths[k]), 0) + 1
        key = tuple(sorted(pattern.items()))
        if key not in seen:
            seen.add(key)
            found.append(pattern)
    return float(best[size]), found


def first_patterns(lengths: np.ndarray, need: np.ndarray, size: int) -> Iterator[tuple[dict[int, int], int]]:
    """Patterns that take the longest lengths first, and the length that each uses up.

    No pattern holds a length that an earlier one has used up, so with one pattern for each they are a basis.
    """
    left = need.copy()
    alive = [int(n) for n in lengths]
    row = {n: i for i, n in enumerate(alive)}
    while alive:
        pattern, capacity, end = {}, size, len(alive)
        while capacity and (end := bisect_right(alive, capacity, 0, end)):
            n = alive[end - 1]
            pattern[n] = capacity // n
            capacity -= n * pattern[n]
            end -= 1
        first = min(pattern, key=lambda n: left[row[n]] / pattern[n])
        amount = float(left[row[first]] / pattern[first])
        yield pattern, first
        gone = {first}
        for n, k in pattern.items():
            left[row[n]] -= k * amount
            if left[row[n]] <= TINY:
                gone.add(n)
        alive = [n for n in alive if n not in gone]


class Basis:
    """Patterns of the current solution, one per length, their uses, the duals and the inverse of their matrix."""

    def __init__(self, lengths: np.ndarray, need: np.ndarray, size: int):
        self.row = {int(n): i for i, n in enumerate(lengths)}
        fits = size // lengths
        self.patterns = [{int(n): int(f)} for n, f in zip(lengths, fits, strict=True)]
        self.inverse = np.diag(1.0 / fits)
        self.dual = 1.0 / fits
        self.used = need / fits
        for pattern, first in first_patterns(lengths, need, size):
            self.enter(pattern, self.row[first])

    def worth(self, pattern: dict[int, int]) -> float:
        return sum(float(self.dual[self.row[n]]) * k for n, k in pattern.items())

    def enter(self, pattern: dict[int, int], out: int | None = None) -> None:
        """The pattern takes the place of the one that is used up first, or of a given one."""
        rows = np.array([self.row[n] for n in pattern])
        step = (self.inverse[:, rows] * np.array(list(pattern.values()), dtype=float)).sum(axis=1)
        if out is None:
            able = np.flatnonzero(step > TINY)
            out = int(able[np.argmin(self.used[able] / step[able])])
        amount = self.used[out] / step[out]
        self.used = np.maximum(self.used - amount * step, 0.0)
        self.used[out] = amount
        pivot = self.inverse[out] / step[out]
        self.dual = self.dual + (1.0 - self.worth(pattern)) * pivot
        touched, full = np.flatnonzero(np.abs(step) > TINY), np.flatnonzero(pivot)
        self.inverse[np.ix_(touched, full)] -= np.outer(step[touched], pivot[full])
        self.inverse[out] = pivot
        self.patterns[out] = pattern


def cutting_stock(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], float]]:
    """Patterns of an almost best fractional solution, and how often each is used."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    if not len(lengths):
        return []
    need = np.array([counts[int(n)] for n in lengths], dtype=float)
    basis = Basis(lengths, need, size)
    least = float((lengths * need).sum()) / size
    reached = [basis.used.sum()]
    for _ in range(ROUNDS):
        value = np.zeros(size + 1)
        value[lengths] = basis.dual
        most, entering = columns(value, lengths, size)
        # Duals over the best pattern's value are a lower bound as well.
        bound = max(least, float((need * basis.dual).sum()) / max(most, 1.0))
        if not entering or basis.used.sum() <= bound * (1 + GAP):
            break
        for pattern in entering:
            if basis.worth(pattern) > 1 + TINY:
                basis.enter(pattern)
        reached.append(basis.used.sum())
        if len(reached) > STALLED and reached[-1] > reached[-1 - STALLED] * (1 - GAP / 10):
            break
    return list(zip(basis.patterns, basis.used.tolist(), strict=True))


def packing_plan(counts: dict[int, int], size: int, slack: int = SLACK) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from, to, times, sequence, offset): ranks of a length that go to a pattern, from 0 on without a gap.

    The pattern holds the length `times` in a row from `offset` on; its sequences are numbered from `sequence` on.
    """
    left = dict(counts)
    rows, sequence = [], 0
    order = sorted(cutting_stock(counts, size), key=lambda x: (-x[1], sorted(x[0].items())))
    for pattern, amount in order:
        copies = min([math.ceil(amount - 1e-6), *(left[n] // k for n, k in pattern.items())])
        if copies < 1 or size - sum(n * k for n, k in pattern.items()) > slack:
            continue
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            taken = counts[n] - left[n]
            rows.append((n, taken, taken + copies * k, k, sequence, offset))
            left[n] -= copies * k
            offset += n * k
        sequence += copies
    return rows


def powers_of_two(total: int) -> list[int]:
    """Descending powers of two with this sum."""
    return [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]


# Ids of documents.


#: Characters that need no normal form but lower case, and whose classes no library disputes.
PLAIN = r"[\x21-\x7e\xa1-\u012f\u0131-\u024f]+"
#: Fixed value: the pre-tokens of the vocabulary's file.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "\x01"


def with_word_ends(model: dict):
    """The vocabulary as ranks of bytes, in which a byte that no plain word has stands for the end of a pre-token.

    Ids ascend with the merges that make them, so merging by merge order is merging by the lowest id. None if a file is of
    another kind; then all words go through its own library.
    """
    import tiktoken

    bpe, pre = model["model"], model["pre_tokenizer"]
    split = [p for p in pre.get("pretokenizers", []) if p["type"] == "Split"]
    kinds = [n["type"] for n in (model["normalizer"] or {}).get("normalizers", [])]
    suffix = bpe.get("end_of_word_suffix")
    if not suffix or not split or split[0]["pattern"].get("Regex") != PRE_TOKENS or kinds != ["NFC", "Replace", "Lowercase"]:
        return None
    table = decode_table()
    ranks = {}
    special = {t["content"] for t in model["added_tokens"]}
    for name, i in bpe["vocab"].items():
        if name not in special:
            ends = name.endswith(suffix)
            ranks[bytes(table[c] for c in (name.removesuffix(suffix) if ends else name)) + END.encode() * ends] = i
    merged = [bpe["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in bpe["merges"]]
    if sorted(ranks.values()) != list(range(len(ranks))) or merged != sorted(set(merged)):
        return None
    return tiktoken.Encoding("words", pat_str=rf"[^{END}\n]+{END}|\n", mergeable_ranks=ranks, special_tokens={})


class Words:
    """A tokenizer of the `tokenizers` library, and the ids of the words a worker has met."""

    def __init__(self, path: str):
        # One task, one thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.plain = re.compile((rf"(?!.*(?:{special}))" if special else "") + PLAIN)
        with open(path, encoding="utf-8") as file:
            self.ranked = with_word_ends(json.load(file))
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.known: dict[bytes, bytes] = {}

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit numbers; plain words in one call."""
        plain = [self.ranked is not None and self.plain.fullmatch(w) is not None for w in words]
        found = iter(self._plain([w for w, p in zip(words, plain, strict=True) if p]))
        rest = [w for w, p in zip(words, plain, strict=True) if not p]
        others = iter([e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)])
        return [next(found) if p else np.array(next(others), dtype="<u4").tobytes() for p in plain]

    def _plain(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        text = self.pre_tokens.sub(rf"\g<0>{END}", "\n".join(words).lower())
        ids = np.array(self.ranked.encode_ordinary(text), dtype="<u4")
        own = ids != self.ranked.encode_single_token("\n")
        edges = 4 * np.concatenate([[0], np.cumsum(own)[~own], [own.sum()]])
        raw = ids[own].tobytes()
        return [raw[i:j] for i, j in zip(edges.tolist(), edges[1:].tolist(), strict=False)]

    def ids(self, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and where those of each begin (one offset more than words)."""
        value, values = distinct(raw, edges)
        new = [v for v in values if v not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            new = values
        for i in range(0, len(new), TOGETHER):
            group = new[i : i + TOGETHER]
            self.known.update(zip(group, self.encode([w.decode() for w in group]), strict=True))
        found = [self.known[v] for v in values]
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table = np.frombuffer(b"".join(found), dtype="<u4")
        return gather(table, (np.cumsum(length) - length)[value], length[value])


_loaded: dict[str, Words] = {}


def word_ids(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


CODED = "doc_id long, part int, rank long, whole_before long, n_ids long, rest int, ids binary"


def coded(docs: DataFrame, path: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Each document's ids (little-endian unsigned 32-bit), and its place among those of its task with the same rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        part = TaskContext.get().partitionId()
        seen, whole = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for piece in pieces(batch.column(1), PIECE):
                found = find_words(piece, piece.data, NOT_SPACE)
                raw, edges = gather(piece.data, found.start, found.end - found.start)
                ids, begins = words.ids(raw, edges)
                # The end id goes behind each text's ids.
                last = begins[found.first[1:]]
                data = np.insert(ids, last, np.uint32(end_id))
                borders = np.concatenate([[0], last + np.arange(1, piece.n + 1)])
                n_ids = np.diff(borders)
                rest, full = n_ids % size, n_ids // size
                order = np.argsort(rest, kind="stable")
                heads = np.searchsorted(rest[order], rest[order])
                rank = np.empty(piece.n, dtype=np.int64)
                rank[order] = np.arange(piece.n) - heads
                rank += seen[rest]
                seen += np.bincount(rest, minlength=size)
                before = whole + np.cumsum(full) - full
                whole += int(full.sum())
                buffers = [None, pa.py_buffer(4 * borders), pa.py_buffer(data)]
                arrays = [
                    batch.column(0).slice(piece.first, piece.n),
                    pa.array(np.full(piece.n, part), pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (rank, before, n_ids)],
                    pa.array(rest, pa.int32()),
                    pa.Array.from_buffers(pa.large_binary(), piece.n, buffers).cast(pa.binary()),
                ]
                names = ["doc_id", "part", "rank", "whole_before", "n_ids", "rest", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(lean(run), CODED)


# Places of documents.


def packed(
    docs: DataFrame, path: str, end_id: int = 1, size: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    Sequences are numbered from 0 without a gap: those of one document, those of patterns, those of the rest.
    """
    spark = docs.sparkSession
    documents = stored(coded(docs, path, end_id, size, id_col, text_col), "packing-ids")
    lengths = stored(
        documents.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"n_ids div {size}")).alias("whole")),
        "packing-lengths",
    )
    # At most `size` rows.
    totals = lengths.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole")).collect()
    counts = {r["rest"]: r["n"] for r in totals if r["rest"] > 0}
    whole = sum(r["whole"] for r in totals)
    plan = packing_plan(counts, size)
    taken = {n: 0 for n in counts}
    for n, _, end, *_ in plan:
        taken[n] = max(taken[n], end)
    patterns = max((s + (end - begin) // k for _, begin, end, k, s, _ in plan), default=0)
    # Rests not in a pattern, laid end to end: the first place of each length.
    laid, total = [], 0
    for n in sorted(counts, reverse=True):
        laid.append((n, taken[n], total))
        total += n * (counts[n] - taken[n])
    even, tail = total - total % size, powers_of_two(total % size)
    borders = [even + sum(tail[:i]) for i in range(len(tail))]

    ranked = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select("part", "rest", F.coalesce(F.sum("n").over(ranked), F.lit(0)).alias("earlier"))
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = lengths.groupBy("part").agg(F.sum("whole").alias("whole"))
    wholes = wholes.select("part", F.coalesce(F.sum("whole").over(parts), F.lit(0)).alias("whole_earlier"))
    offsets = stored(offsets.join(wholes, "part"), "packing-offsets")
    d = documents.join(small(offsets), ["part", "rest"]).withColumn("rank", F.col("rank") + F.col("earlier"))

    # Small by construction: one row per length, and at most 64 per pattern.
    places = spark.createDataFrame(plan, "n int, begin long, stop long, times int, sequence long, at int")
    places = places.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("begin", "stop", "times", "sequence", "at"))).alias("places"))
    rests = spark.createDataFrame(laid, "n int, taken long, laid long")
    fixed = F.broadcast(stored(rests.join(places, "n", "left"), "packing-places"))
    d = d.join(fixed, d["rest"] == fixed["n"], "left")

    last = F.lit(whole + patterns)
    place = F.get(F.filter("places", lambda p: (p["begin"] <= F.col("rank")) & (F.col("rank") < p["stop"])), F.lit(0))
    within = F.col("rank") - place["begin"]
    first = (F.col("n_ids") - F.col("rest")).cast("long")
    piece = lambda start, length, sequence, offset: F.struct(
        *[x.cast("long").alias(n) for x, n in ((start, "start"), (length, "length"), (sequence, "sequence_id"), (offset, "offset"))]
    )
    in_pattern = F.array(
        piece(first, F.col("rest"), F.lit(whole) + place["sequence"] + quotient(within, place["times"]), place["at"] + within % place["times"] * F.col("rest"))
    )
    at = F.col("laid") + (F.col("rank") - F.col("taken")) * F.col("rest")
    # Where a sequence of the rest begins within this document: at a multiple of the size, or at one of the powers.
    ends = F.array((quotient(at, size) + 1) * size, *[F.lit(b).cast("long") for b in borders])
    inside = F.filter(ends, lambda x: (x > at) & (x < at + F.col("rest")))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(at), inside)))
    stops = F.concat(F.slice(cuts, 2, F.size(cuts)), F.array(at + F.col("rest")))

    def laid_piece(cut, i):
        later = sum((F.when(cut >= b, 1).otherwise(0) for b in borders[1:]), F.lit(0))
        begin = F.when(cut < even, cut - cut % size).otherwise(
            F.greatest(F.lit(even), *[F.when(cut >= b, F.lit(b)).otherwise(F.lit(even)) for b in [even, *borders]])
        )
        return piece(first + cut - at, F.get(stops, i) - cut, last + quotient(cut, size) + later, cut - begin)

    pieces_of_rest = F.when(F.col("rest") == 0, F.array().cast(PIECES)).when(
        F.col("rank") < F.col("taken"), in_pattern
    ).otherwise(F.transform(cuts, laid_piece))
    count = quotient(F.col("n_ids"), size)
    whole_pieces = F.transform(
        F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<long>")),
        lambda i: piece(i * size, F.lit(size), F.col("whole_earlier") + F.col("whole_before") + i, F.lit(0)),
    )
    cut = d.select("doc_id", "ids", "n_ids", F.explode(F.concat(whole_pieces, pieces_of_rest)).alias("p"))
    ids = F.expr("substring(ids, cast(4 * p.start + 1 as int), cast(4 * p.length as int))")
    return cut.select("doc_id", "p.start", "p.length", ids.alias("ids"), F.col("n_ids").alias("doc_tokens"), "p.sequence_id", "p.offset")


PIECES = "array<struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>>"


def quotient(x: Column, by: Column | int) -> Column:
    """Whole quotient of whole numbers."""
    return ((x - x % by) / by).cast("long")
