"""URL filter: host and path rules, and for what no rule fits the ratio of two character language models.

Accepted and rejected URLs (host and path) each train a variable-order Markov model of up to `ORDER` preceding
characters. Counts of all orders come from one table of distinct windows of ORDER + 1 characters; Witten-Bell smoothing
mixes each order with the next lower one, down to a uniform share, in proportion to how many different characters
have followed the context. The log-likelihood ratio of every window is one row of a table, and a URL's score is the
mean over its characters. A fifth of the labelled URLs, by checksum, is kept from the counts and calibrates the cutoff:
at most `FALSE_REJECTIONS` of the accepted ones may fall below it, and it is at most 0.

Each distinct URL counts once, so a URL repeated any number of times is neither a hot key nor a heavier example.
Everything is DataFrame work: windows are exploded, counted with partial sums, and joined by their text.

Defined cases: a null URL or one without `://` has an empty host and path, fits no rule, has no score and is allowed;
without accepted and rejected examples there is no score and what no rule fits is allowed; characters that a
model has not seen keep a uniform share; rows that repeat an id are judged each by its own URL; URLs of any
length are scored whole; an empty table gives no rows; only the id and the URL are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import small, stored

#: Fixed values: (verdict, host, path); a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Words of hosts that make a URL an example of rejected ones, whatever rule it fits.
REJECTED_WORDS = ("casino", "bets", "adult", "spam")

ORDER = 4
#: The uniform share below order 0: one of so many characters.
CHARACTERS = 256
#: Stands before the first character; no URL holds it.
START = "\u0002"
FALSE_REJECTIONS = 0.01

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first `://`, or empty."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Columns host, path, rule and ruled (the rule's verdict) beside page_id; rule and ruled null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    host, path = F.col("host"), F.col("path")
    fits = [
        ((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered
    ]
    return pages.withColumns(
        {
            "rule": F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ordered, strict=True)]),
            "ruled": F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ordered, strict=True)]),
        }
    )


def window_rows(subjects: DataFrame) -> DataFrame:
    """One row per character of each subject: the window that ends with it."""
    padded = F.concat(F.lit(START * ORDER), F.col("subject"))
    places = F.sequence(F.lit(1), F.length("subject"))
    windows = F.transform(places, lambda i: F.substring(padded, i, F.lit(ORDER + 1)))
    return subjects.filter(F.length("subject") > 0).select("*", F.explode(windows).alias("window"))


def window_ratios(counts: DataFrame) -> DataFrame:
    """(window, accepted, rejected) counts to (window, ratio): log-likelihood under accepted less under rejected."""
    lower = None
    for order in range(ORDER + 1):
        event = F.substring("window", ORDER + 1 - order, order + 1)
        events = counts.groupBy(event.alias("event")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
        )
        context = F.substring("event", 1, order)
        events = events.withColumn("context", context)
        contexts = events.groupBy("context").agg(
            *[F.sum(c).alias(f"{c}_all") for c in ("accepted", "rejected")],
            *[F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in ("accepted", "rejected")],
        )
        joined = events.join(small(contexts, 1000) if order < 2 else contexts, "context")
        if lower is None:
            joined = joined.withColumns({f"{c}_below": F.lit(1.0 / CHARACTERS) for c in ("accepted", "rejected")})
        else:
            joined = joined.withColumn("tail", F.substring("event", 2, order)).join(lower, "tail")

        def share(c: str) -> Column:
            total = F.col(f"{c}_all") + F.col(f"{c}_kinds")
            mixed = (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_below")) / total
            return F.when(total > 0, mixed).otherwise(F.col(f"{c}_below"))

        shares = joined.select(
            F.col("event").alias("tail"), share("accepted").alias("accepted_below"), share("rejected").alias("rejected_below")
        )
        lower = stored(shares, f"url-order{order}")  # at most one row per distinct window
    return lower.select(
        F.col("tail").alias("window"), (F.log("accepted_below") - F.log("rejected_below")).alias("ratio")
    )


def scores(subjects: DataFrame) -> DataFrame:
    """(subject, accepted, rejected) examples and others to (subject, score); null flags are no examples.

    Only distinct subjects may be given. Those held out for calibration are scored but not counted.
    """
    held = F.crc32(F.col("subject").cast("binary")) % 5 == 0
    counted = subjects.select(
        "subject",
        F.when(~held & F.col("accepted"), 1).otherwise(0).cast("long").alias("accepted"),
        F.when(~held & F.col("rejected"), 1).otherwise(0).cast("long").alias("rejected"),
    )
    windows = window_rows(counted)
    counts = windows.groupBy("window").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    ratios = window_ratios(stored(counts, "url-windows"))
    rows = windows.select("subject", "window").join(small(stored(ratios, "url-ratios")), "window")
    return rows.groupBy("subject").agg(F.avg("ratio").alias("score"))


def cutoff(scored: DataFrame) -> float | None:
    """From (subject, accepted, rejected, score): the lowest score to keep, or None without examples of both."""
    held = F.crc32(F.col("subject").cast("binary")) % 5 == 0
    row = scored.agg(
        F.count(F.when(F.col("accepted"), 1)).alias("accepted"),
        F.count(F.when(F.col("rejected"), 1)).alias("rejected"),
        F.percentile_approx(F.when(F.col("accepted") & held, F.col("score")), FALSE_REJECTIONS, 10_000).alias("cut"),
    ).first()
    if not row["accepted"] or not row["rejected"]:
        return None
    return min(0.0, row["cut"]) if row["cut"] is not None else 0.0


def judge_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    rejected_words: tuple[str, ...] = REJECTED_WORDS,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the model's score, for every row."""
    url = F.col(url_col)
    read = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = with_rules(read, rules).withColumn("subject", F.concat("host", "path"))
    bad = F.lit(False)
    for word in rejected_words:
        bad = bad | F.col("host").contains(word)
    examples = ruled.select(
        "subject",
        (F.coalesce(F.col("ruled") == "allow", F.lit(False)) & ~bad).alias("accepted"),
        (F.coalesce(F.col("ruled") == "block", F.lit(False)) | bad).alias("rejected"),
    )
    # Two hosts and paths may join to one subject; it is then rejected if either is.
    subjects = examples.groupBy("subject").agg(F.max("rejected").alias("rejected"), F.max("accepted").alias("accepted"))
    subjects = stored(
        subjects.select("subject", "rejected", (F.col("accepted") & ~F.col("rejected")).alias("accepted")), "url-subjects"
    )
    scored = stored(subjects.join(scores(subjects), "subject"), "url-scores")
    least = cutoff(scored)
    below = F.lit(False) if least is None else F.coalesce(F.col("score") < least, F.lit(False))
    verdict = F.coalesce(F.col("ruled"), F.when(below, F.lit("block")).otherwise(F.lit("allow")))
    judged = ruled.join(scored.select("subject", "score"), "subject", "left")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
