"""Alignment of two tokenizers' tokens over the same texts, by lockstep merging of their byte offsets.

Tokenizer A is a byte-level BPE in a file of the `tokenizers` library (read as ranks, which give the same ids) and reads a space and
the text; B is a SentencePiece BPE that adds the space itself. The tokens of a piece of texts are laid out as byte offsets, A's cut into lanes of `LANE` tokens. One state vector
holds, for each lane, the A and the B token it stands at; a step emits the link of the two, a cut where both end at the same byte,
and moves on whichever ends first, for all lanes at once. Finished lanes are taken out of the vector. A lane begins at
the B token that overlaps its first byte, so long texts are many lanes and every link is emitted once.

Tokens are looked up, not made anew: A's pattern starts a pre-token at a space with a visible character behind it, and none of B's
pieces goes on over a space that follows another character (checked when the model is loaded; otherwise texts are taken whole).
So texts are cut there, and each distinct cut of a batch goes through the libraries once. `REMEMBER` bounds the
cuts a worker keeps; beyond, it starts anew.

Counts over the corpus are sums of pairs of ids, first within each text, then within each task, then by pair; they come back to
the texts by a join, in which the counts are broadcast up to `PAIRS` rows and shuffled beyond.

Defined cases: null and empty texts, and texts whose tokens do not spell the text byte by byte (such as U+2581 or ill-formed
pieces of B), have no tokens: zeros and an empty string; texts of any length are taken whole; strings of special tokens are plain
text; rows that repeat an id are rows of their own; no rows give no rows. Other columns are carried along, but
for those with a result's name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import lean, small, stored
from martlake.llm.textbytes import distinct, gather, pieces

LANE = 256
REMEMBER = 200_000
PAIRS = 1_000_000

#: Cuts that go through a library in one call.
TOGETHER = 2000
#: Fixed value: the pre-tokens of byte-level BPE as the `tokenizers` library has them built in.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: First bytes of characters that may be white space beyond ASCII.
WIDE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)

ALIGNED = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.StringType()),
        *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("link_a", "link_b", "link_n")],
    ]
)


def decode_table() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(model: dict) -> tuple[list[bytes], str]:
    """Bytes of the ids and the pattern of pre-tokens of a byte-level BPE file.

    Where ids ascend with the merges that make them, merging by merge order is merging by the lowest id.
    """
    pre, bpe = model["pre_tokenizer"], model["model"]
    special = {t["content"] for t in model["added_tokens"]}
    table = decode_table()
    names = sorted((i, n) for n, i in bpe["vocab"].items() if n not in special)
    merged = [bpe["vocab"][m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in bpe["merges"]]
    plain = model["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
    if not plain or [i for i, _ in names] != list(range(len(names))) or merged != sorted(set(merged)):
        raise ValueError("not a byte-level BPE whose ids follow its merges")
    return [bytes(table[c] for c in n) for _, n in names], PRE_TOKENS


class Vocabulary:
    """Bytes and decimal names of a tokenizer's ids, laid out for gathering."""

    def __init__(self, tokens: list[bytes]):
        self.start, self.length, self.data = self._laid(tokens)
        self.name_start, self.name_length, self.names = self._laid([str(i).encode() + b"," for i in range(len(tokens))])

    @staticmethod
    def _laid(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = np.array([len(v) for v in values], dtype=np.int64)
        return np.cumsum(length) - length, length, np.frombuffer(b"".join(values), dtype=np.uint8)

    def spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.data, self.start[ids], self.length[ids])


class Grown:
    """An array that is appended to."""

    def __init__(self, kind: type, first: list[int] | None = None):
        self.data = np.zeros(1024, dtype=kind)
        self.n = 0
        self.extend(np.array(first or [], dtype=kind))

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(self.n + len(more), dtype=self.data.dtype)])
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class Tokenizers:
    """Both tokenizers of a worker, and the ids of the cuts they have met."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            tokens, pattern = byte_level(json.load(file))
        self.a = tiktoken.Encoding(a_path, pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_vocabulary = Vocabulary(tokens)
        parts = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_vocabulary = Vocabulary(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(parts)]
        )
        self.cuttable = not any("▁" in p.lstrip("▁") for p in parts)
        self.known: dict[bytes, int] = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.ids = [Grown(np.int32), Grown(np.int32)]
        self.edges = [Grown(np.int64, [0]), Grown(np.int64, [0])]

    def places(self, values: list[bytes]) -> np.ndarray:
        """Where the ids of each cut are kept; cuts not met before go through the libraries."""
        new = [v for v in values if v not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.forget()
            new = values
        new = sorted(new, key=stands_alone)
        together = len(new) - sum(map(stands_alone, new))
        groups = [new[i : min(i + TOGETHER, together)] for i in range(0, together, TOGETHER)] + [[v] for v in new[together:]]
        for k in range(2):
            for group in groups:
                ids, lengths = self.encode(k, group)
                self.edges[k].extend(self.ids[k].n + np.cumsum(lengths))
                self.ids[k].extend(ids)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, values), np.int64, len(values))

    def encode(self, k: int, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts that follow each other, and how many each has; apart, if tokens do not end where the cuts do."""
        text = b"".join(group).decode()
        # B adds the space that the text begins with.
        ids = np.array(self.a.encode_ordinary(text) if k == 0 else self.b.encode(text[1:], num_threads=1), dtype=np.int32)
        if len(group) == 1:
            return ids, np.array([len(ids)])
        ends = np.cumsum((self.a_vocabulary, self.b_vocabulary)[k].length[ids])
        edges = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
        at = np.searchsorted(ends, edges)
        if ends[-1] == edges[-1] and np.array_equal(ends[at], edges):
            return ids, np.diff(at + 1, prepend=0)
        ids, lengths = zip(*(self.encode(k, [v]) for v in group), strict=True)
        return np.concatenate(ids), np.concatenate(lengths)

    def tokens(self, k: int, place: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of tokenizer k for cuts at these places, and the first of each text's (n + 1 offsets from `cuts`)."""
        begin = self.edges[k].data[place]
        ids, edges = gather(self.ids[k].data, begin, self.edges[k].data[place + 1] - begin)
        return ids.astype(np.int64), edges[cuts]


def stands_alone(cut: bytes) -> bool:
    """Whether tokens of this cut could depend on a cut put before or behind it."""
    return cut[-1] in (0x20, 0x81) or len(cut) < 2 or cut[1] <= 0x20 or cut[1] == 0x7F or cut[1] in WIDE_SPACE


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def spaced(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have bytes with a space before each; and the borders of all, where an empty one has none."""
    sizes = np.diff(starts)
    filled = sizes > 0
    borders = np.concatenate([[0], np.cumsum(sizes + filled)])
    out = np.full(borders[-1], 0x20, dtype=np.uint8)
    mark = np.ones(borders[-1], dtype=bool)
    mark[borders[:-1][filled]] = False
    out[mark] = data
    return out, borders


def cut_places(data: np.ndarray, borders: np.ndarray, cuttable: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begins of the cuts, and the number of the first cut of each text (n + 1 entries)."""
    begins = np.zeros(len(data), dtype=bool)
    if cuttable and len(data) > 2:
        follows = data[2:]
        visible = (follows > 0x20) & (follows != 0x7F) & ~np.isin(follows, WIDE_SPACE)
        # Not behind a space, nor behind what may be the sign that B writes for one.
        begins[1:-1] = (data[1:-1] == 0x20) & visible & (data[:-2] != 0x20) & (data[:-2] != 0x81)
    heads = borders[:-1]
    begins[heads[heads < borders[1:]]] = True
    at = np.flatnonzero(begins)
    return at, np.searchsorted(at, borders)


def lockstep(a_end: np.ndarray, b_end: np.ndarray, lanes: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """A and B numbers of the links, and the A and B numbers of tokens that end together (the cuts), in order.

    Offsets ascend over all texts, and every text's last tokens end together. A lane is the A tokens from one of `lanes` to
    before its stop.
    """
    a = lanes.copy()
    begin = np.where(a > 0, a_end[a - 1], 0) if len(a_end) else a
    b = np.searchsorted(b_end, begin, side="right")
    links, cuts = [], []
    while len(a):
        links.append((a, b))
        a_at, b_at = a_end[a], b_end[b]
        both = a_at == b_at
        cuts.append((a[both], b[both]))
        a, b = a + (a_at <= b_at), b + (b_at <= a_at)
        open_ = a < stops
        a, b, stops = a[open_], b[open_], stops[open_]
    none = np.zeros(0, dtype=np.int64)
    link_a, link_b = (np.concatenate(x) for x in zip((none, none), *links, strict=True))
    cut_a, cut_b = (np.sort(np.concatenate(x)) for x in zip((none, none), *cuts, strict=True))
    return link_a, link_b, cut_a, cut_b


def named_groups(words: Tokenizers, ids: list[np.ndarray], cuts: list[np.ndarray], first_cut: np.ndarray) -> pa.Array:
    """`a1,a2|b1;a3|b2` for each text: decimal ids, commas within a side, bars between sides, semicolons between groups."""
    counts = [np.diff(np.concatenate([[-1], c])) for c in cuts]
    group = [np.repeat(np.arange(len(c)), n) for c, n in zip(cuts, counts, strict=True)]
    total = [np.concatenate([[0], np.cumsum(n)]) for n in counts]
    place = [np.arange(len(ids[0])) + total[1][group[0]], np.arange(len(ids[1])) + total[0][group[1] + 1]]
    n = len(ids[0]) + len(ids[1])
    start, length = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    a, b = words.a_vocabulary, words.b_vocabulary
    start[place[0]], length[place[0]] = a.name_start[ids[0]], a.name_length[ids[0]]
    start[place[1]], length[place[1]] = len(a.names) + b.name_start[ids[1]], b.name_length[ids[1]]
    raw, edges = gather(np.concatenate([a.names, b.names]), start, length)
    raw[edges[place[0][cuts[0]] + 1] - 1] = ord("|")
    raw[edges[place[1][cuts[1]] + 1] - 1] = ord(";")
    # The text's last separator goes; texts have as many signs as their tokens' names.
    last = np.concatenate([[0], edges[place[1][cuts[1]] + 1]])[first_cut]
    filled = np.diff(first_cut) > 0
    keep = np.ones(len(raw), dtype=bool)
    keep[last[1:][filled] - 1] = False
    borders = last - np.concatenate([[0], np.cumsum(filled)])
    buffers = [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(raw[keep])]
    return pa.Array.from_buffers(pa.large_string(), len(borders) - 1, buffers).cast(pa.string())


def align_piece(words: Tokenizers, data: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """The columns of ALIGNED for the texts of a piece."""
    n = len(starts) - 1
    text, borders = spaced(data, starts)
    at, cuts = cut_places(text, borders, words.cuttable)
    value, values = distinct(text, np.append(at, len(text)))
    place = words.places(values)[value] if values else value
    ids, first = zip(*(words.tokens(k, place, cuts) for k in range(2)), strict=True)
    # Texts that either tokenizer spells differently have no tokens.
    fits = np.ones(n, dtype=bool)
    for k, vocabulary in enumerate((words.a_vocabulary, words.b_vocabulary)):
        raw, edges = vocabulary.spelled(ids[k])
        ends = edges[first[k]]
        if not np.array_equal(ends, borders) or not np.array_equal(raw, text):
            for i in range(n):
                mine, wanted = raw[ends[i] : ends[i + 1]], text[borders[i] : borders[i + 1]]
                fits[i] &= np.array_equal(mine, wanted)
    kept = [np.repeat(fits, np.diff(f)) for f in first]
    ids = [x[m] for x, m in zip(ids, kept, strict=True)]
    counts = [np.diff(f) * fits for f in first]
    first = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
    ends = [np.cumsum(v.length[x]) for v, x in zip((words.a_vocabulary, words.b_vocabulary), ids, strict=True)]
    # Lanes: every LANE tokens of a text.
    lanes_of = -(-counts[0] // LANE)
    number = np.arange(lanes_of.sum()) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
    lanes = np.repeat(first[0][:-1], lanes_of) + LANE * number
    stops = np.minimum(lanes + LANE, np.repeat(first[0][1:], lanes_of))
    link_a, link_b, cut_a, cut_b = lockstep(ends[0], ends[1], lanes, stops)
    first_cut = np.searchsorted(cut_a, first[0])
    groups = named_groups(words, ids, [cut_a, cut_b], first_cut)
    # Pairs of ids of each text, with how often they are linked.
    owner = np.repeat(np.arange(n), counts[0])[link_a]
    key = (owner << 40) | (ids[0][link_a] << 20) | ids[1][link_b]
    pairs, times = np.unique(key, return_counts=True)
    offsets = pa.array(np.searchsorted(pairs >> 40, np.arange(n + 1)), pa.int32())
    listed = [(pairs >> 20) & 0xFFFFF, pairs & 0xFFFFF, times]
    numbers = [counts[0], counts[1], np.diff(first_cut), np.bincount(owner, minlength=n)]
    return [
        *[pa.array(x, pa.int64()) for x in numbers],
        groups,
        *[pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in listed],
    ]


def aligned(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """The other columns with the counts, the groups as text, and the distinct pairs of linked ids with their numbers."""
    keep = [c for c in docs.columns if c not in (text_col, *ALIGNED.names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizers(a_path, b_path)
        for batch in batches:
            for piece in pieces(batch.column(len(keep))):
                arrays = [batch.column(k).slice(piece.first, piece.n) for k in range(len(keep))]
                arrays += align_piece(words, piece.data, piece.starts)
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *ALIGNED.names])

    schema = T.StructType([*[docs.schema[c] for c in keep], *ALIGNED.fields])
    return docs.select(*keep, text_col).mapInArrow(lean(run), schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """One row per pair of ids: link_count, and whether no other A id is linked with the B id more often."""
    pairs = linked.select(F.explode(F.arrays_zip("link_a", "link_b", "link_n")).alias("l")).groupBy(
        F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b")
    )
    counts = stored(pairs.agg(F.sum("l.link_n").alias("link_count")), "align-counts")
    most = counts.groupBy(F.col("b").alias("to")).agg(F.max("link_count").alias("most"))
    best = counts.join(small(most), F.col("b") == F.col("to"))
    return best.select("a", "b", "link_count", (F.col("link_count") == F.col("most")).alias("is_best"))


def scored(linked: DataFrame, key: str) -> DataFrame:
    """Stored rows of `aligned` with n_best and count_sum in place of the pairs; `key` names a column that tells rows apart."""
    counts = small(pair_counts(linked), PAIRS)
    links = linked.select(F.col(key).alias("key"), F.explode(F.arrays_zip("link_a", "link_b", "link_n")).alias("l"))
    joined = links.join(counts, (F.col("l.link_a") == F.col("a")) & (F.col("l.link_b") == F.col("b")))
    sums = joined.groupBy("key").agg(
        F.sum(F.when(F.col("is_best"), F.col("l.link_n")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("l.link_n") * F.col("link_count")).cast("long").alias("count_sum"),
    )
    rows = linked.drop("link_a", "link_b", "link_n", "n_best", "count_sum").alias("r")
    zero = F.lit(0).cast("long")
    return rows.join(sums.alias("s"), F.col(f"r.{key}") == F.col("s.key"), "left").select(
        "r.*", F.coalesce("s.n_best", zero).alias("n_best"), F.coalesce("s.count_sum", zero).alias("count_sum")
    )
