"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import align, html, licenses, mixing, neardup, packing, quality, runs, sharding, tokens, toxicity, urls, vectors
from martlake.llm.common import small, stored, table

QUERIES = {}
ORACLES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_odd_sketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op2_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", "rejected_by")


@query
def op3_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.byte_shards(table(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Checksums: the usual table of 256 remainders, made from its polynomial, and one step per byte.
ORACLES["op3_byte_shards"] = """
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)
              ORDER BY n) AS t
  FROM range(256) AS r(n)
), rows AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                   lambda h: ('0x' || h)::BIGINT),
                    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT),
        4294967295::BIGINT) AS text_crc32
  FROM documents, crc
), placed AS (
  SELECT *, sum(size) OVER w - size AS byte, row_number() OVER w AS n, sum(size) OVER () AS total
  FROM rows
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT *, ((2 * byte + size) * 8 // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  n - min(n) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


@query
def op4_sql_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tokens.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "text", "source")
    sizes = mixing.sized(mixing.keyed(rows, "key", "doc_id", "text"), "key")
    plan = small(stored(mixing.mix_plan(sizes), "mix-plan"))
    s, p = sizes.alias("s"), plan.alias("p")
    draw = F.element_at(mixing.draws(F.col("s.key")), F.col("p.seed") + 1)
    return s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select(
        "s.doc_id",
        "s.size",
        "p.source_size",
        "p.target",
        (F.col("s.size") * mixing.copies(F.col("p.rate"), draw)).alias("taken"),
    )


_DRAWS = ", ".join(
    f"('0x' || substr(md5('{k}:' || key), {1 + 8 * i}, 8))::BIGINT" for k in range(mixing.SEEDS // 4) for i in range(4)
)
ORACLES["op5_source_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')),
              row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM sized GROUP BY source
), shared AS (
  SELECT *, 3 * source_size AS most, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS rest,
    sum(weight) OVER later AS weights, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW earlier AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    later AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), open AS (
  SELECT place, rest, weights FROM shared WHERE most * weights > weight * rest ORDER BY place LIMIT 1
), targets AS (
  SELECT s.source, source_size,
    CASE WHEN o.place IS NULL OR s.place < o.place THEN most::DOUBLE
         ELSE (weight * o.rest)::DOUBLE / o.weights::DOUBLE END AS target
  FROM shared s LEFT JOIN open o ON true
), drawn AS (
  SELECT doc_id, size, t.source, source_size, target, unnest(range(16)) AS seed, unnest([{_DRAWS}]) AS draw,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, (size * (floor(rate) + CASE WHEN draw < (rate - floor(rate)) * 4294967296.0::DOUBLE THEN 1 ELSE 0 END))::BIGINT
    AS taken
  FROM drawn
), seeds AS (
  SELECT source, seed FROM (
    SELECT source, seed, abs(sum(taken)::DOUBLE - any_value(target)) AS miss FROM counted GROUP BY source, seed)
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1
)
SELECT doc_id, size, source_size, target, taken
FROM counted c JOIN seeds s ON c.source IS NOT DISTINCT FROM s.source AND c.seed = s.seed
"""


@query
def op6_tag_path_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_texts(table(spark, folder, "pages"))


@query
def op7_license_join(spark: SparkSession, folder: str) -> DataFrame:
    scanned = licenses.license_scan(table(spark, folder, "documents"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op8_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op9_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_url_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"))


@query
def op11_lockstep_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    linked = align.aligned(table(spark, folder, "documents").select("doc_id", "text"), *paths)
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    linked = linked.withColumns({"groups_sha256": groups, "row": F.monotonically_increasing_id()})
    return align.scored(stored(linked.drop("groups"), "aligned"), key="row").drop("row")


@query
def op12_column_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.packed(table(spark, folder, "documents"), path, end_id=1, size=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def looped(docs: DataFrame) -> DataFrame:
    """Texts of the ids that the contract picks, with their words from a certain one on repeating; others as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    # A column of its own: inside the lambda the words would be taken apart anew for each place.
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({mixing.WORD})"), F.lit(1)))
    split = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"), F.size(words).alias("n"))
    a = (F.col("g") % F.greatest("n", F.lit(1))).cast("int")
    p = (F.floor((F.col("n") - a) / (3 + F.col("g") % 8)) + 1).cast("int")
    cut = split.select("*", a.alias("a"), p.alias("p"))
    places = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.array_join(F.transform(places, lambda i: F.get("words", at(i))), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op13_grammar_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(looped(table(spark, folder, "documents")), least=6, exponent=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("run"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    start, length, period = -F.col("run.col2"), F.col("run.length"), -F.col("run.col3")
    return digest.select(
        "doc_id",
        "n_runs",
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
