"""Near duplicates: MinHash bands find candidates, odd sketches sift them, full shingle sets decide.

Words are runs of non-white-space bytes with A-Z in lower case; a text's set is its distinct five-word shingles, or
its whole sequence of words if they are fewer. Texts with equal sets form a class and are represented by their
smallest id. Each class has MinHash samples: `ROWS` of them at a time make a band, with so many bands that a link is
missed by all of them with a probability below `MISS`. All samples are folded into an odd sketch, a bitmap in which
each sample flips one bit; the population count of the XOR of two sketches estimates how many samples differ.
Pairs whose count is beyond what a link would show in six standard deviations are dropped, the others are compared
on full sets (64-bit hashes of all shingles).

Links are found without forming all pairs of a bucket. First every class is compared with the leaders (smallest ids) of
its buckets, the likeliest one at first and the others only while they are not yet connected. What remains are buckets
whose members are in several components; these are cut into blocks, sketches are compared block by block
across components only, and the classes with a likely partner are compared on full sets within their
blocks, each block pair handing on a spanning forest of its links. So every pair that shares a band is either connected,
or dropped by its sketch, or decided on full sets.

Defined cases: null and empty texts have an empty set and are linked with nothing; a null id takes no part and is its
own row with a null component; rows that repeat an id are one document, linked by any of its texts; equal texts and
equal sets are linked; texts of any length give all their shingles; an empty table gives no rows; only the id and the text are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import lean, small, stored, unused
from martlake.llm.graph import components, renamed
from martlake.llm.textbytes import (
    LOWER,
    NOT_SPACE,
    find_words,
    hash_words,
    mix,
    pieces,
    window_hashes,
    windows_inside,
)

WIDTH, ROWS, MISS = 5, 4, 1e-6
#: Bits of an odd sketch, in 64-bit words.
SKETCH = 8
#: Classes of a bucket that are compared as one block; a task holds the texts of two blocks at most.
BLOCK = 256
#: Ids of texts to fetch are broadcast up to this many (8 bytes each), and joined by a shuffle beyond.
FETCH = 1_000_000

SIGNATURES = "doc_id long, n_shingles long, low long, high long, bands array<long>, sketch array<long>"


def n_bands(percent: int) -> int:
    share = (percent / 100) ** ROWS
    return math.ceil(math.log(MISS) / math.log1p(-share))


def most_bits(percent: int) -> int:
    """Differing sketch bits that a link hardly ever exceeds: six deviations in samples, four in bits."""
    k, bits, j = n_bands(percent) * ROWS, 64 * SKETCH, percent / 100
    least = max(0.0, j - 6 * math.sqrt(j * (1 - j) / k))
    expected = bits / 2 * (1 - math.exp(-4 * k * (1 - least) / bits))
    return math.ceil(expected + 4 * math.sqrt(expected / 2))


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each piece of a column, the place of its first text and the sorted shingle hashes of its texts."""
    for piece in pieces(texts):
        data = LOWER[piece.data]
        words = find_words(piece, data, NOT_SPACE)
        hashes = hash_words(data, words.start, words.end)
        inside = windows_inside(words, WIDTH)
        shingles = window_hashes(hashes, WIDTH)[inside]
        edges = np.searchsorted(inside, words.first)
        sets = []
        for i in range(piece.n):
            own = shingles[edges[i] : edges[i + 1]]
            if not len(own):
                few = hashes[words.first[i] : words.first[i + 1]]
                own = window_hashes(few, len(few)) if len(few) else own
            sets.append(np.unique(own))
        yield piece.first, sets


def signatures(docs: DataFrame, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, a 128-bit checksum of the set, band keys and odd sketch of every row."""
    bands = n_bands(percent)
    samples = bands * ROWS
    draws = np.random.default_rng(11).integers(1, 1 << 63, size=(2, samples), dtype=np.uint64)
    factors, shifts = draws[0] * np.uint64(2) + np.uint64(1), draws[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            size, low, high = (np.zeros(n, dtype=np.int64) for _ in range(3))
            keys = np.zeros((n, bands), dtype=np.uint64)
            sketch = np.zeros((n, SKETCH), dtype=np.uint64)
            for first, sets in shingle_sets(batch.column(1)):
                for i, own in enumerate(sets):
                    size[first + i] = len(own)
                    digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype=np.int64)
                    low[first + i], high[first + i] = digest
                full = np.array([first + i for i, own in enumerate(sets) if len(own)], dtype=np.int64)
                if not len(full):
                    continue
                everything = np.concatenate([own for own in sets if len(own)])
                starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                for s in range(samples):
                    least = np.minimum.reduceat(everything * factors[s] + shifts[s], starts)
                    bit = mix(least + np.uint64(s))
                    word, place = (bit >> np.uint64(6)) % np.uint64(SKETCH), bit & np.uint64(63)
                    sketch[full, word.astype(np.int64)] ^= np.uint64(1) << place
                    keys[full, s // ROWS] = mix(keys[full, s // ROWS] + least + np.uint64(s))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size),
                    pa.array(low),
                    pa.array(high),
                    lists(keys),
                    lists(sketch),
                ],
                names=["doc_id", "n_shingles", "low", "high", "bands", "sketch"],
            )

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(lean(run), SIGNATURES)


def lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    flat = pa.array(rows.view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), flat)


def differing_bits(a: str, b: str) -> Column:
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the documents that are to be compared; a repeated id may have several texts."""
    wanted = small(nodes, FETCH)
    read = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    return stored(read.join(wanted, "node", "left_semi"), "neardup-texts")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that are links on full sets."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([s for _, sets in shingle_sets(batch.column(k)) for s in sets] for k in (2, 3))
            kept = pa.array([is_link(x, y, percent) for x, y in zip(left, right, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"]
            )

    joined = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return stored(joined.mapInArrow(lean(run), "a long, b long"), "neardup-links")


def labelled(table: DataFrame, column: str, name: str, labels: DataFrame) -> DataFrame:
    """The table with the component of a column of nodes."""
    return renamed(table.withColumn(name, F.col(column)), name, labels.withColumnRenamed("component", "to"))


def grouped(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups from frames that are sorted by the key; a group may span frames."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        change = (frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]).any(axis=1)
        edges = [0, *(np.flatnonzero(change) + 1).tolist()]
        for i, j in zip(edges, edges[1:], strict=False):
            yield frame.iloc[i:j]
        rest = frame.iloc[edges[-1] :]
    if rest is not None and len(rest):
        yield rest


BLOCK_PAIR = ["bucket", "block_a", "block_b"]


def block_pairs(members: DataFrame, n_blocks: Column) -> DataFrame:
    """Members of a bucket, once for each pair of blocks that their own block is in, `side` saying on which side."""
    placed = members.withColumns({"blocks": n_blocks}).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    return other.select(
        "*", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b")
    ).drop("blocks", "other")


def in_blocks(table: DataFrame) -> DataFrame:
    return table.repartition(*BLOCK_PAIR).sortWithinPartitions(*BLOCK_PAIR, "node")


def likely(members: DataFrame, percent: int) -> DataFrame:
    """Members of block pairs that have a likely partner in another component, by size and sketch."""
    most = most_bits(percent)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(frames, BLOCK_PAIR):
            sketch = np.stack(group["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
            size = group["n"].to_numpy()
            label = group["label"].to_numpy()
            own = group["own"].to_numpy()
            within = group["block_a"].iat[0] == group["block_b"].iat[0]
            hit = np.zeros(len(group), dtype=bool)
            for i in range(len(group)):
                others = (label != label[i]) & (within | (own != own[i]))
                others &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
                if others.any():
                    bits = np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1)
                    hit[i] = (bits <= most).any()
            if hit.any():
                yield group.loc[hit, [*BLOCK_PAIR, "node", "label", "own"]]

    schema = "bucket long, block_a int, block_b int, node long, label long, own int"
    columns = [*BLOCK_PAIR, "node", "label", "own", "n", "sketch"]
    return in_blocks(members.select(*columns)).mapInPandas(lean(run), schema)


def forest(members: DataFrame, percent: int) -> DataFrame:
    """Links within block pairs across components, on full sets, no more than connect them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(frames, BLOCK_PAIR):
            sets = [s for _, part in shingle_sets(pa.array(group["text"], pa.string())) for s in part]
            nodes, labels, own = (group[c].tolist() for c in ("node", "label", "own"))
            within = group["block_a"].iat[0] == group["block_b"].iat[0]
            root = {x: x for x in labels}

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            out = []
            for i in range(len(nodes)):
                for j in range(i):
                    x, y = find(labels[i]), find(labels[j])
                    if x != y and (within or own[i] != own[j]) and is_link(sets[i], sets[j], percent):
                        root[max(x, y)] = min(x, y)
                        out.append((nodes[i], nodes[j]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    columns = [*BLOCK_PAIR, "node", "label", "own", "text"]
    return in_blocks(members.select(*columns)).mapInPandas(lean(run), "a long, b long")


def links_of(classes: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of all classes that are linked to a smaller one."""
    rows = classes.select(F.col("rep").alias("node"), F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("count"))
    # Read from files, either side of the join has a shuffle of its own, so a crowded bucket can be split.
    shared = stored(buckets.filter("count > 1"), "neardup-buckets")
    members = stored(rows.join(shared, "bucket").select("bucket", "node", "leader", "count"), "neardup-members")
    pairs = members.filter("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("shared"))
    sizes = classes.select("rep", "n", "sketch")
    sifted = (
        pairs.join(sizes.select(F.col("rep").alias("node"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "node")
        .join(sizes.select(F.col("rep").alias("leader"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "leader")
        .filter(similar_sizes(F.col("n_a"), F.col("n_b"), percent))
        .withColumn("bits", differing_bits("s_a", "s_b"))
        .filter(F.col("bits") <= most_bits(percent))
    )
    pairs = stored(
        sifted.groupBy(F.col("node").alias("a"), F.col("leader").alias("b")).agg(F.min("bits").alias("bits")), "neardup-pairs"
    )
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = texts_of(docs, stored(ends, "neardup-ends"), id_col, text_col)
    likeliest = stored(pairs.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("best")).select("a", "best.b"), "neardup-best")
    links = verified(likeliest, texts, percent)
    labels = components(links)
    others = labelled(labelled(pairs.join(likeliest, ["a", "b"], "left_anti"), "a", "la", labels), "b", "lb", labels)
    more = verified(stored(others.filter("la <> lb").select("a", "b"), "neardup-pairs"), texts, percent)
    if more.limit(1).count():
        links = stored(links.unionAll(more), "neardup-links")
        labels = components(links)
    # Buckets of three or more whose members are in several components: all pairs with the leader are decided.
    left = stored(labelled(members.filter("count > 2").select("bucket", "node"), "node", "label", labels), "neardup-left")
    mixed = left.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("count"))
    open_ = left.join(mixed.filter("x <> y").select("bucket", "count"), "bucket")
    open_ = open_.join(sizes.withColumnRenamed("rep", "node"), "node")
    chosen = stored(likely(block_pairs(open_, F.ceil(F.col("count") / BLOCK)), percent), "neardup-likely")
    if chosen.limit(1).count():
        texts = texts_of(docs, stored(chosen.select("node").distinct(), "neardup-ends"), id_col, text_col)
        found = stored(forest(chosen.join(texts, "node"), percent), "neardup-links")
        if found.limit(1).count():
            labels = components(stored(links.unionAll(found), "neardup-links"))
    return labels


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; links at a similarity of `percent` or more."""
    signed = stored(signatures(docs, percent, id_col, text_col), "neardup-signatures")
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(
        full.groupBy("low", "high").agg(
            F.min("doc_id").alias("rep"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
            F.any_value("sketch").alias("sketch"),
        ),
        "neardup-classes",
    )
    labels = links_of(classes, docs, percent, id_col, text_col)
    rows = signed.select("doc_id", "n_shingles", "low", "high")
    owned = rows.join(classes.select("low", "high", "rep"), ["low", "high"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    owned = stored(owned.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("rep")), "neardup-owned")
    # An id with several texts joins their classes.
    several = owned.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"))
    bridges = several.filter("a <> b").select("a", "b")
    result = labelled(owned, "rep", "component", labels)
    bridged = stored(labelled(labelled(bridges, "a", "la", labels), "b", "lb", labels).select(F.col("la").alias("a"), F.col("lb").alias("b")), "neardup-bridges")
    if bridged.limit(1).count():
        result = renamed(result, "component", components(bridged).withColumnRenamed("component", "to"))
    return result.select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """The documents with one row of each group of near duplicates, that with the smallest id, with their columns.

    Rows are told apart by a number of their own, so equal rows, rows that share an id and rows without one are compared like
    all others; an id comes before none, and of equal ids the first in the order of the table. Rows without a word are in
    no group and stay.
    """
    row = unused(docs) + "row"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "neardup-rows")
    judged = near_duplicates(rows, percent, id_col=row).select(F.col("doc_id").alias("row"), "component_id")
    judged = stored(judged, "neardup-judged")
    grouped = judged.groupBy("component_id").count().filter("count > 1").select("component_id")
    members = judged.join(grouped, "component_id").join(rows.select(F.col(row).alias("row"), F.col(id_col).alias("id")), "row")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    dropped = members.join(first, "component_id").filter(F.col("row") != F.col("first.row")).select(F.col("row").alias(row))
    return rows.join(small(stored(dropped, "neardup-dropped"), FETCH), row, "left_anti").select(*docs.columns)
