"""Quality rules whose cutoffs come from labelled holdouts, with a bound on false rejections.

Every text gives counts over all of its words and lines; a rule compares one ratio of them with a cutoff. For each
stratum (language) and rule a fixed grid of cutoffs is tested from lenient to strict on the good rows of the holdout
whose base rules pass. A cutoff is certified if the exact binomial (Clopper-Pearson) upper bound on its rate of
false rejections is at most `risk / rules`; testing stops at the first failure (fixed-sequence testing, which needs
no correction over cutoffs), and the error probability is divided by rules times strata (Bonferroni). So with
probability `1 - error` all strata at once lose at most `risk` of their good documents to all rules together.
Of the certified cutoffs the most lenient is taken that rejects nearly as much of the bad holdout as the
strictest: beyond it, strictness would only cost. A stratum with too few labels certifies nothing and keeps everything
its base rules keep.

Defined cases: a null text counts as empty and fails the base rules (fewer than 50 words); a null stratum is a
stratum of its own; rows that repeat an id are judged each by its own text, and an id that is labelled several times
counts once, as bad if any label says so; so do rows of one labelled id and equal texts, at the largest ratio; null labels are
no labels; no labels, or no rows, certify nothing; texts of any length are counted whole; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import lean, small, stored, unused
from martlake.llm.textbytes import (
    NOT_SPACE,
    count_code_points,
    find_words,
    hash_words,
    pieces,
    span_sums,
    window_hashes,
    windows_inside,
)

SYMBOLS = np.array([chr(b) in "#*$%&|<>" for b in range(256)])
UPPER = np.array([65 <= b <= 90 for b in range(256)])
LOWERCASE = np.array([97 <= b <= 122 for b in range(256)])

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_letters".split()
)
FEATURES = "doc_id long, stratum string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS)

#: The ratio of each rule: (name, counted, out of). Large is bad. Each rule more leaves less risk to every other.
RULES = (
    ("symbols", "n_symbols", "n_words"),
    ("repeats", "n_repeat_words", "n_words"),
    ("capitals", "n_upper", "n_letters"),
)
#: Ratios are compared in 64 steps per unit, up to 4: a finite grid, the same for every corpus.
STEPS, TOP = 64, 256

RISK, ERROR = 0.05, 0.05
#: A stricter cutoff must reject this much more of the bad holdout to be worth it.
GAIN = 0.05


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    seen: set[bytes] = set()
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    seen.update(lines)
    return len(lines), len(lines) - len(seen)


def count_batch(texts: pa.Array) -> dict[str, np.ndarray]:
    out = {c: np.zeros(len(texts), dtype=np.int64) for c in COUNTS}
    for piece in pieces(texts):
        data, bounds = piece.data, piece.starts
        words = find_words(piece, data, NOT_SPACE)
        here = slice(piece.first, piece.first + piece.n)
        out["n_words"][here] = np.diff(words.first)
        # White space is ASCII, so code points of words are code points less white space.
        out["word_chars"][here] = count_code_points(data, bounds) - span_sums(~NOT_SPACE[data], bounds)
        for name, marked in (("n_symbols", SYMBOLS), ("n_upper", UPPER)):
            out[name][here] = span_sums(marked[data], bounds)
        out["n_letters"][here] = out["n_upper"][here] + span_sums(LOWERCASE[data], bounds)
        hashes = window_hashes(hash_words(data, words.start, words.end), 3)
        inside = windows_inside(words, 3)
        found = hashes[inside]
        edges = np.searchsorted(inside, words.first)
        raw = data.tobytes()
        for i in range(piece.n):
            k = piece.first + i
            out["n_lines"][k], out["n_dup_lines"][k] = duplicate_lines(raw[bounds[i] : bounds[i + 1]])
            own = found[edges[i] : edges[i + 1]]
            if len(own) < 2:
                continue
            order = np.argsort(own)
            ranked = own[order]
            same = ranked[1:] == ranked[:-1]
            if not same.any():
                continue
            again = np.zeros(len(own), dtype=bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            covered = np.zeros(len(own) + 2, dtype=bool)
            for shift in range(3):
                covered[shift : shift + len(own)] |= again
            out["n_repeat_words"][k] = covered.sum()
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts of every whole text, with its id and stratum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_batch(batch.column(3))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(counts[c]) for c in COUNTS]],
                names=["doc_id", "stratum", "text_hash", *COUNTS],
            )

    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col),
    )
    return read.mapInArrow(lean(run), FEATURES)


def base_failed(mark: str = "") -> Column:
    words = F.col(f"{mark}n_words")
    return (words < 50) | (100 * F.col(f"{mark}n_repeat_words") > 50 * words)


def step(counted: str, total: str) -> Column:
    """Where a ratio stands on the grid; 0 only if nothing was counted."""
    ratio = F.ceil(F.col(counted) * STEPS / F.greatest(F.col(total), F.lit(1)))
    return F.least(ratio, F.lit(TOP)).cast("int")


def upper_bound_holds(rejected: int, n: int, risk: float, error: float) -> bool:
    """Whether the exact upper confidence bound (level 1 - error) on a rejection rate is at most `risk`.

    That is so if at most `rejected` of n would be seen with probability `error` or less, were the rate `risk`.
    """
    if n == 0 or rejected >= n:
        return False
    k = np.arange(rejected + 1)
    steps = np.log(n - k[:-1]) - np.log(k[1:]) + np.log(risk) - np.log1p(-risk)
    logs = n * np.log1p(-risk) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return bool(top + np.log(np.exp(logs - top).sum()) <= np.log(error))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, error: float, gain: float = GAIN) -> int:
    """The largest step that is kept, from counts of good and bad rows per step; TOP rejects nothing."""
    n = int(good.sum())
    certified = [TOP]
    for cut in range(TOP - 1, -1, -1):
        if not upper_bound_holds(int(good[cut + 1 :].sum()), n, risk, error):
            break
        certified.append(cut)
    caught = [int(bad[cut + 1 :].sum()) for cut in certified]
    enough = caught[-1] - gain * bad.sum()
    return next(cut for cut, hits in zip(certified, caught, strict=True) if hits >= enough)


def cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with labels: the largest kept step of each rule."""
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    holdout = counts.filter(~base_failed()).join(marked, "doc_id")
    # A trial is a labelled id, and equal texts are one trial, bad if any label says so: else repeated rows would certify cutoffs.
    steps = [step(a, b).alias(name) for name, a, b in RULES]
    names = [name for name, _, _ in RULES]
    worst = [F.max(name).alias(name) for name in names]
    texts = holdout.select("doc_id", "stratum", "text_hash", "quality", *steps)
    texts = texts.groupBy("stratum", "text_hash").agg(F.min("doc_id").alias("doc_id"), F.min("quality").alias("quality"), *worst)
    trials = texts.groupBy("stratum", "doc_id").agg(F.min("quality").alias("quality"), *worst)
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("at")) for name in names]))
    grid = (
        trials.select("stratum", "quality", rules.alias("r"))
        .groupBy("stratum", "r.rule", "r.at")
        .agg(
            F.count(F.when(F.col("quality") > 0, 1)).alias("good"),
            F.count(F.when(F.col("quality") <= 0, 1)).alias("bad"),
        )
    )
    grid = stored(grid, "quality-grid")  # at most rules x steps rows for each stratum
    strata = grid.select("stratum").distinct().count()
    share, level = risk / len(RULES), error / (len(RULES) * max(strata, 1))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        chosen = {"stratum": [rows["stratum"].iloc[0]]}
        for name, _, _ in RULES:
            own = rows[rows["rule"] == name]
            good, bad = np.zeros(TOP + 1, dtype=np.int64), np.zeros(TOP + 1, dtype=np.int64)
            np.add.at(good, own["at"].to_numpy(), own["good"].to_numpy())
            np.add.at(bad, own["at"].to_numpy(), own["bad"].to_numpy())
            chosen[name] = [choose_cutoff(good, bad, share, level)]
        return pd.DataFrame(chosen)

    schema = "stratum string, " + ", ".join(f"{name} int" for name, _, _ in RULES)
    return grid.groupBy("stratum").applyInPandas(choose, schema)


def judge(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """The counts with base_failed, the first rule that rejects (or null) and kept."""
    c, t = counts.alias("c"), small(stored(limits, "quality-cutoffs")).alias("t")
    joined = c.join(t, F.col("c.stratum").eqNullSafe(F.col("t.stratum")), "left")
    reason = F.coalesce(*[F.when(step(a, b) > F.col(f"t.{name}"), F.lit(name)) for name, a, b in RULES])
    judged = joined.withColumns({"base_failed": base_failed(), "rejected_by": reason})
    kept = ~F.col("base_failed") & F.col("rejected_by").isNull()
    return judged.select("c.*", "base_failed", "rejected_by", kept.alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Counts and verdict for every document."""
    counts = stored(features(docs), "quality-counts")
    return judge(counts, cutoffs(counts, labels, risk, error))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that the rules keep, with their columns. They are counted again rather than shuffled with their texts."""
    counts = stored(features(docs), "quality-counts")
    limits = small(stored(cutoffs(counts, labels, risk, error), "quality-cutoffs"))
    mark = unused(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_batch(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(counts[c]) for c in COUNTS]],
                names=[*batch.schema.names, *[mark + c for c in COUNTS]],
            )

    schema = T.StructType([*docs.schema.fields, *[T.StructField(mark + c, T.LongType()) for c in COUNTS]])
    k, t = docs.mapInArrow(lean(run), schema).alias("k"), limits.alias("t")
    joined = k.join(t, F.col("k.lang").cast("string").eqNullSafe(F.col("t.stratum")), "left")
    rejected = base_failed(mark)
    for name, a, b in RULES:
        rejected = rejected | F.coalesce(step(mark + a, mark + b) > F.col(f"t.{name}"), F.lit(False))
    return joined.filter(~rejected).select(*[F.col(f"k.`{c}`") for c in docs.columns])
