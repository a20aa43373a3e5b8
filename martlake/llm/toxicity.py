"""Toxicity by compression: which of two zstandard dictionaries makes a text's windows shorter.

One dictionary is trained on toxic text, one on ordinary text, from a bounded sample of labelled rows (`DOCS`
whole texts per class, those with the smallest hash of the id). Toxic texts are mostly ordinary prose,
so the toxic dictionary is trained on the parts of them that hold byte strings far more common there than in
ordinary texts. Every whole text is lower-cased and cut into windows of `WINDOW` words, `STRIDE` words apart; each
window is compressed with either dictionary, and the bytes that the toxic one saves are its evidence. A text's
features are its largest savings, the number and share of windows that save more than ordinary windows do, its
mean saving, and the number of windows, since the largest of many is large by chance; a logistic curve fitted on
labelled texts that the dictionaries have not seen turns them into a score, moved so that at most `FALSE_ALARMS` of
the ordinary ones reach one half. Those texts are compressed whole, in tasks and window by window as all others are;
the driver sees how often each saving occurs in them. Of the half that the dictionaries are trained on it holds the texts,
and every window of an ordinary one is a sample of its dictionary.

Labels, language, source and id are not read when a text is scored. Defined cases: null and empty texts have no
windows and get the score of a text without evidence; an id that is labelled several times counts as toxic if any
label says so; null labels are left out; without texts of both classes every score is 0; rows that repeat an id
are scored each by its own text; texts of any length are scored whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import lean, unused
from martlake.llm.textbytes import LOWER, pieces

#: Words of a window, and from the start of one to the next.
WINDOW, STRIDE = 6, 3
#: Texts per class in the sample that dictionaries and curve are fitted on, and the tasks its curve's half is spread over.
DOCS, TASKS = 3000, 24
#: Sizes of the dictionaries' own content, and the compression level.
TOXIC_SIZE, ORDINARY_SIZE, LEVEL = 2048, 8192, 6
#: Length of the byte strings that are compared between the classes, and the log odds ratio by which those that mark
#: toxic text are more common there, after taking off so many standard errors.
GRAM, CONTRAST, DOUBT = 6, 1.5, 2.0
#: How many of the largest savings are features, and the share of ordinary windows that save more than chance.
BEST, CHANCE = 3, 0.001
#: At most this share of ordinary texts may score 0.5 or more.
FALSE_ALARMS = 0.008


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    chance: float = 0.0  # saved bytes that ordinary windows hardly ever exceed
    weights: np.ndarray | None = None  # for each feature, and a constant at the end


def spaced(text: bytes) -> bytes:
    return b" " + b" ".join(text.split()) + b" "


def windows(text: bytes) -> list[bytes]:
    words = text.split()
    starts = range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE) if words else ()
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in starts]


class Lengths:
    """Compressors of one model, made once per task."""

    def __init__(self, model: Model):
        self.pair = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                level=LEVEL,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for content in (model.toxic, model.ordinary)
        ]

    def saved(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        toxic, ordinary = self.pair[0].compress, self.pair[1].compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float64)


def features(saved: np.ndarray, chance: float) -> np.ndarray:
    out = np.zeros(BEST + 4)
    if len(saved):
        best = np.maximum(np.sort(saved)[::-1][:BEST], 0)
        out[: len(best)] = best / 8
        over = saved > chance
        out[BEST:] = np.log1p(over.sum()), over.mean() * 8, saved.mean(), np.log1p(len(saved)) / 4
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, classes weighted equally, with a small penalty on all but the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = logistic(x @ w)
        slope = x.T @ (weight * (y - p)) - ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(bend, slope)
        w += move
        if np.abs(move).max() < 1e-9:
            break
    return w


def grams(text: bytes) -> np.ndarray:
    """Every GRAM bytes in a row, as numbers."""
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    n = max(len(codes) - GRAM + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        out = (out << np.uint64(8)) | codes[k : k + n]
    return out


def marked_runs(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The parts of toxic texts made of byte strings that far more toxic texts hold than ordinary ones."""
    (keys, a), (others, found) = (
        np.unique(np.concatenate([np.unique(grams(t)) for t in texts]), return_counts=True)
        for texts in (toxic, ordinary)
    )
    b = np.zeros(len(keys))
    if len(others):
        at = np.minimum(np.searchsorted(others, keys), len(others) - 1)
        b = np.where(others[at] == keys, found[at], 0)
    odds = np.log((a + 0.5) / (len(toxic) - a + 0.5)) - np.log((b + 0.5) / (len(ordinary) - b + 0.5))
    kept = keys[odds - DOUBT * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= CONTRAST]
    samples = []
    for text in toxic:
        hits = np.isin(grams(text), kept)
        covered = np.zeros(len(text) + 2, dtype=np.int8)
        for k in range(GRAM):
            covered[k + 1 : k + 1 + len(hits)] |= hits
        edges = np.flatnonzero(np.diff(covered))
        runs = [text[i:j] for i, j in edges.reshape(-1, 2)]
        samples += [b"".join(runs[i : i + 4]) for i in range(0, len(runs), 4)]
    return [s for s in samples if len(s) >= 8]


def dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; samples too few to train on are its content as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def lowered(text: str | None) -> bytes:
    return spaced((text or "").encode().lower())


def learn(texts: list[tuple[bytes, int]]) -> Model | None:
    """The dictionaries, from (text, toxic) rows; without rows of both classes there are none."""
    toxic, ordinary = ([t for t, y in texts if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        return None
    samples = marked_runs(toxic, ordinary)
    base = dictionary(ORDINARY_SIZE, [w for t in ordinary for w in windows(t)])
    # With the ordinary content behind its own, the toxic dictionary differs only by what toxic text adds.
    return Model(dictionary(TOXIC_SIZE, samples) + base, base)


def calibrate(model: Model, saved: list[np.ndarray], y: np.ndarray) -> Model:
    """The model with its curve, from the savings of whole texts that the dictionaries have not seen."""
    if not 0 < y.sum() < len(y):
        return Model(b"", b"")
    model.chance = float(np.quantile(np.concatenate([s for s, k in zip(saved, y) if not k]), 1 - CHANCE))
    x = np.array([features(s, model.chance) for s in saved])
    model.weights = fit_curve(x, y)
    # Move the constant so that few ordinary texts reach a score of one half.
    level = np.quantile(x[y == 0] @ model.weights[:-1] + model.weights[-1], 1 - FALSE_ALARMS)
    model.weights[-1] -= max(level, 0.0) + 1e-6
    return model


def fit(rows: list[tuple[str | None, int]]) -> Model:
    """A model from (text, toxic) rows: dictionaries from every other one, the curve from the rest."""
    texts = [(lowered(t), int(y > 0)) for t, y in rows]
    model = learn(texts[::2])
    if model is None:
        return Model(b"", b"")
    lengths = Lengths(model)
    held = texts[1::2]
    return calibrate(model, [lengths.saved(t) for t, _ in held], np.array([y for _, y in held], dtype=np.float64))


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: checksum of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS) -> Model:
    """Fit on the labelled rows that are not held out. The sample is the only thing the driver sees."""
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = [
        marked.filter(F.col("toxic") > 0 if k else F.col("toxic") <= 0)
        .select("doc_id", F.lit(k).alias("toxic"), F.xxhash64("doc_id").alias("draw"))
        .orderBy("draw", "doc_id")
        .limit(docs_per_class)
        for k in (1, 0)
    ]
    sample = chosen[0].unionAll(chosen[1])
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0)
    keys = texts.select("doc_id").join(F.broadcast(sample), "doc_id").distinct().select("draw", "doc_id", "toxic")
    schema, keys = keys.schema, sorted(tuple(r) for r in keys.collect())

    def half(keys: list[tuple]) -> DataFrame:
        chosen = F.broadcast(docs.sparkSession.createDataFrame(keys, schema))
        # Copies of an id could exceed the bound; one text of each is enough to learn from.
        return texts.join(chosen, "doc_id").groupBy("doc_id", "toxic", "draw").agg(F.min("text").alias("text"))

    rows = sorted((r["draw"], r["doc_id"], r["text"], r["toxic"]) for r in half(keys[::2]).collect())
    model = learn([(lowered(text), toxic) for _, _, text, toxic in rows])
    if model is None:
        return Model(b"", b"")
    found = sorted(savings(half(keys[1::2]), model).collect(), key=lambda r: (r["draw"], r["doc_id"]))
    saved = [np.repeat(np.array(r["saved"], dtype=np.float64), r["times"]) for r in found]
    return calibrate(model, saved, np.array([r["toxic"] for r in found], dtype=np.float64))


def savings(texts: DataFrame, model: Model) -> DataFrame:
    """How many windows of each whole text save how many bytes; texts themselves are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(model)
        for batch in batches:
            pairs = [np.unique(lengths.saved(lowered(t)).astype(int), return_counts=True) for t in batch.column(3).to_pylist()]
            columns = [pa.array([x.tolist() for x in column], pa.list_(pa.int64())) for column in zip(*pairs)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(columns or [pa.array([], pa.list_(pa.int64()))] * 2)],
                names=["doc_id", "draw", "toxic", "saved", "times"],
            )

    read = texts.select(F.col("doc_id").cast("long"), "draw", "toxic", "text").repartition(TASKS)
    return read.mapInArrow(lean(run), "doc_id long, draw long, toxic int, saved array<long>, times array<long>")


def score_texts(texts: pa.Array, model: Model, lengths: Lengths | None) -> np.ndarray:
    scores = np.zeros(len(texts))
    if lengths is None:
        return scores
    for piece in pieces(texts):
        raw = LOWER[piece.data].tobytes()
        bounds = piece.starts
        x = [features(lengths.saved(raw[bounds[i] : bounds[i + 1]]), model.chance) for i in range(piece.n)]
        scores[piece.first : piece.first + piece.n] = logistic(np.array(x) @ model.weights[:-1] + model.weights[-1])
    return scores


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """The rows of a table with the score of each text, in a last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(model) if model.weights is not None else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score_texts(texts, model, lengths))], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = train(docs, labels)
    read = docs.select("doc_id", "text")
    scored = with_score(read, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents predicted not to be toxic, with their columns."""
    model = model or train(docs, labels)
    name = unused(docs) + "score"
    return with_score(docs, model, name=name).filter(F.col(name) < 0.5).select(*docs.columns)
