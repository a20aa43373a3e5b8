"""Byte-level BPE in DuckDB, one in-memory database for each task.

A task splits its texts into words by the tokenizer's pattern and gives the words it has not met yet to a recursive
query. Tokens start as bytes; each step joins the rows of neighbouring tokens with the merge table, finds each word's
lowest rank, and contracts the leftmost pair of that rank, until no word has a pair left. Long words take
several equal pairs in one step where that cannot change the outcome, or their steps would grow with their length.
A word that is itself in the vocabulary is one token.
Decoding joins (document, position, token) rows with the vocabulary and aggregates the bytes in order.

Memory is bounded: words go to the query in groups of `WORDS` and `WORD_BYTES`, tokens are decoded in groups of
`TOKENS`, and the words a task remembers are forgotten beyond `REMEMBER`; a lost task starts again from its texts.

Defined cases: null and empty texts have no tokens and decode to nothing; there are no special tokens, their strings
are ordinary text; repeated rows are encoded each by itself; texts of any length are encoded
whole; an empty table gives no rows; only the text column is read besides those carried along.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martlake.llm.common import lean

#: The limits that bound a task's memory.
WORDS, WORD_BYTES, TOKENS, REMEMBER = 20_000, 400_000, 200_000, 200_000
#: Words of more bytes than this go to the second query.
LONG = 64

# Bytes are stored as code points from 256 on, so that any of them can stand in a VARCHAR.
SHIFT = 256

# One row per unfinished word: its tokens are laid out as rows of positions, joined with the merge table, and the
# leftmost pair of the lowest rank is contracted.
ENCODE = """
WITH RECURSIVE state(word, tokens, done) AS (
  SELECT word, tokens, false FROM start
  UNION ALL
  (WITH pairs AS (
    SELECT word, pos, tokens[pos] AS a, tokens[pos + 1] AS b
    FROM (SELECT word, tokens, unnest(range(1, len(tokens))) AS pos FROM state WHERE NOT done)
  ), best AS (
    SELECT word, min(m.id::BIGINT * 65536 + pos) AS pair
    FROM pairs p JOIN merges m ON m.a = p.a AND m.b = p.b
    GROUP BY word
  )
  SELECT s.word,
    CASE WHEN pair IS NULL THEN tokens
         ELSE tokens[:pair % 65536 - 1] || [(pair // 65536)::INTEGER] || tokens[pair % 65536 + 2:] END,
    pair IS NULL
  FROM state s LEFT JOIN best USING (word)
  WHERE NOT s.done)
)
SELECT word, tokens FROM state WHERE done
"""

# One row per token, for long words: all pairs of the lowest rank are contracted at once, from the left, up to
# and with the first whose new token makes a pair of a still lower rank with a neighbour.
ENCODE_LONG = """
WITH RECURSIVE state(word, pos, token, done) AS (
  SELECT word, unnest(range(len(tokens))), unnest(tokens), false FROM start
  UNION ALL
  (WITH pairs AS (
    SELECT s.*, m.id, min(m.id) OVER (PARTITION BY s.word) AS best
    FROM (SELECT word, pos, token, lag(token) OVER w AS before, lead(token) OVER w AS next,
            lead(token, 2) OVER w AS after
          FROM state WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)) s
    LEFT JOIN merges m ON m.a = s.token AND m.b = s.next
  ), runs AS (
    SELECT *, coalesce(id = best, false) AS hit,
      row_number() OVER (PARTITION BY word ORDER BY pos)
        - row_number() OVER (PARTITION BY word, coalesce(id = best, false) ORDER BY pos) AS run
    FROM pairs
  ), chosen AS (
    SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1 AS taken FROM runs
  ), linked AS (
    SELECT *, CASE WHEN lag(taken, 2) OVER (PARTITION BY word ORDER BY pos) THEN best ELSE before END AS left_token
    FROM chosen
  ), lower AS (
    SELECT l.word, min(l.pos) AS last
    FROM linked l
    LEFT JOIN merges x ON x.a = l.left_token AND x.b = l.id
    LEFT JOIN merges y ON y.a = l.id AND y.b = l.after
    WHERE l.taken AND (x.id < l.id OR y.id < l.id)
    GROUP BY l.word
  ), kept AS (
    SELECT c.*, c.taken AND (w.last IS NULL OR c.pos <= w.last) AS joins
    FROM chosen c LEFT JOIN lower w USING (word)
  ), merged AS (
    SELECT *, lag(joins, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone FROM kept
  )
  SELECT word, pos, CASE WHEN joins THEN id ELSE token END, best IS NULL
  FROM merged WHERE NOT gone)
)
SELECT word, list(token ORDER BY pos) AS tokens FROM state WHERE done GROUP BY word
"""

DECODE = """
SELECT doc, string_agg(v.bytes, '' ORDER BY t.pos) AS text
FROM tokens t JOIN vocabulary v ON v.id = t.id
GROUP BY doc
"""


class Codec:
    """One vocabulary in one database."""

    def __init__(self, path: str, pattern: str):
        self.ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.pattern = regex.compile(pattern)
        self.words: dict[str, bytes] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "150MB"})
        self.db.execute("SET preserve_insertion_order = false")
        self._load()

    def _load(self) -> None:
        ranks = self.ranks
        merges = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        a, b, ids = (pa.array(x, pa.int32()) for x in zip(*merges, strict=True))
        made = pa.table({"a": a, "b": b, "id": ids})
        vocabulary = pa.table(
            {
                "id": pa.array(list(ranks.values()), pa.int32()),
                "bytes": ["".join(chr(SHIFT + x) for x in token) for token in ranks],
            }
        )
        self.db.register("made", made)
        self.db.register("listed", vocabulary)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM made")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM listed")
        self.single = np.array([ranks[bytes([x])] for x in range(256)], dtype=np.int32)

    def learn(self, new: list[str]) -> None:
        """Encode words not met before, a bounded group at a time."""
        short, long = [], []
        for word in new:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words[word] = rank.to_bytes(4, "little")
            else:
                (long if len(raw) > LONG else short).append((word, raw))
        for words, sql in ((short, ENCODE), (long, ENCODE_LONG)):
            i = 0
            while i < len(words):
                j, size = i, 0
                while j < len(words) and j < i + WORDS and (j == i or size + len(words[j][1]) <= WORD_BYTES):
                    size += len(words[j][1])
                    j += 1
                self._merge(words[i:j], sql)
                i = j

    def _merge(self, words: list[tuple[str, bytes]], sql: str) -> None:
        edges = np.concatenate([[0], np.cumsum([len(raw) for _, raw in words])]).astype(np.int32)
        data = np.frombuffer(b"".join(raw for _, raw in words), dtype=np.uint8)
        start = pa.table(
            {
                "word": np.arange(len(words), dtype=np.int32),
                "tokens": pa.ListArray.from_arrays(pa.array(edges), pa.array(self.single[data])),
            }
        )
        self.db.register("start", start)
        found = self.db.sql(sql).to_arrow_table()
        self.db.unregister("start")
        tokens = found["tokens"].combine_chunks()
        raw = tokens.flatten().to_numpy().astype("<u4").tobytes()
        at = 0
        for k, n in zip(found["word"].to_pylist(), tokens.value_lengths().to_pylist(), strict=True):
            self.words[words[k][0]] = raw[at : at + 4 * n]
            at += 4 * n

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(text) for text in texts]
        if len(self.words) > REMEMBER:
            self.words.clear()
        known = self.words
        self.learn([w for w in set().union(*split) if w not in known])
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        out = [b""] * len(ids)
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        i = 0
        while i < len(ids):
            j, total = i, 0
            while j < len(ids) and (j == i or total + lengths[j] <= TOKENS):
                total += lengths[j]
                j += 1
            if total:
                first = np.concatenate([[0], np.cumsum(lengths[i:j])[:-1]])
                rows = pa.table(
                    {
                        "doc": np.repeat(np.arange(i, j, dtype=np.int32), lengths[i:j]),
                        "pos": (np.arange(total) - np.repeat(first, lengths[i:j])).astype(np.int32),
                        "id": np.concatenate(ids[i:j]).astype(np.int32),
                    }
                )
                self.db.register("tokens", rows)
                found = self.db.sql(DECODE).to_arrow_table()
                self.db.unregister("tokens")
                for doc, text in zip(found["doc"].to_pylist(), found["text"].to_pylist(), strict=True):
                    # Code points 256 to 511: the low bytes are what was stored.
                    out[doc] = text.encode("utf-16-le")[::2]
            i = j
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec; a reused worker keeps its tables."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


#: Texts are taken in groups of about this many characters, or one at a time if longer.
GROUP = 400_000


def text_groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= GROUP):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def encoded(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The other columns with `ids` (array of int) and `decoded` (binary, the bytes of the ids), in place of any so named."""
    keep = [c for c in docs.columns if c not in (text_col, "ids", "decoded")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for i, j in text_groups(texts):
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in bpe.encode(texts[i:j])]
                arrays = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(bpe.decode(ids), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "ids", "decoded"])
        bpe.words.clear()

    schema = T.StructType([*[docs.schema[c] for c in keep], *added])
    return docs.select(*keep, text_col).mapInArrow(lean(run), schema)


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and the two checksums, made where the ids are, so that no ids leave a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, sums, back = [], [], []
            for i, j in text_groups(texts):
                raw = bpe.encode(texts[i:j])
                counts += [len(x) // 4 for x in raw]
                sums += [hashlib.sha256(x).hexdigest() for x in raw]
                decoded = bpe.decode([np.frombuffer(x, dtype="<u4") for x in raw])
                back += [hashlib.sha256(x).hexdigest() for x in decoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.words.clear()

    read = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return read.mapInArrow(lean(run), f"doc_id long, {DIGEST}")
