"""Quality rules per document and per host.

Each document is measured; a host (the column ``source``) has, for each rule, a share of documents that
fail it. The shares of small hosts are shrunk towards the shares of all hosts by a beta prior that is
fitted to the hosts by moments. Hosts whose shrunk share passes a limit get a verdict, which is joined
back to their documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import SPACE_CHARS, stored, words

#: Words of a window that counts as repeated.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Limits of the rules. Shares are of a host's documents, after shrinking."""

    #: A host of which this share fails a rule loses the documents that fail the rule.
    rule_share: float = 0.5
    #: A host of which this share fails any rule loses all its documents.
    host_share: float = 0.8


def _window_hashes(text_words: Column) -> Column:
    """A 64-bit hash of each window of words, in order."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(text_words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(text_words, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(text_words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, source, text``) measured: ``doc_id, source``, and the columns ``MEASURES``.

    Null and empty texts have no words. The words are the runs of non-space characters. Windows are
    compared by their hashes: equal ones are neighbours after sorting, and the starts of windows found at least
    twice, in order, cover up to ``WINDOW`` words each, less what the next start covers.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE_CHARS, "") != "")
    df = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words(text).alias("w"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    df = df.select(
        "doc_id",
        "source",
        "word_chars",
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("w")).alias("h"),
    )
    sorted_windows = F.when(
        F.size("h") > F.size(F.array_distinct("h")),
        F.sort_array(F.arrays_zip(F.col("h").alias("h"), F.sequence(F.lit(0), F.size("h") - 1).alias("at"))),
    )
    df = df.withColumn("s", sorted_windows)
    starts = F.sort_array(
        F.filter(
            F.transform(
                F.col("s"),
                lambda x, i: F.when(
                    (x["h"] == F.get(F.col("s"), i - 1)["h"]) | (x["h"] == F.get(F.col("s"), i + 1)["h"]), x["at"]
                ),
            ),
            lambda at: at.isNotNull(),
        )
    )
    df = df.withColumn("starts", starts)
    covered = F.aggregate(
        F.transform(
            F.col("starts"),
            lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), i + 1) - at, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return df.select("doc_id", "source", *MEASURES[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Whether a document fails, by rule."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > n,
        "word_length": (n > 0) & ~F.col("word_chars").between(2 * n, 20 * n),
    }


def _prior(fails: str, docs: str = "n_docs") -> list[Column]:
    """Sums over hosts from which the prior of one rule follows."""
    return [
        F.sum(fails).alias(f"sum_{fails}"),
        F.sum(F.col(fails) * F.col(fails) / F.col(docs)).alias(f"square_{fails}"),
    ]


def _alpha_beta(hosts: int, n: float, n2: float, fails: float, square: float) -> tuple[float, float]:
    """Beta prior by moments: the mean share, and the spread between hosts beyond that of chance.

    The weight of the prior lies between 1 and 10,000 documents.
    """
    mean = (fails + 0.5) / (n + 1.0)
    chance = mean * (1.0 - mean)
    spread = square - fails * fails / n - (hosts - 1) * chance
    room = (n - n2 / n - (hosts - 1)) * chance
    share = spread / room if room > 0 else 0.0
    weight = min(max(1.0 / share - 1.0, 1.0), 10_000.0) if share > 0 else 10_000.0
    return mean * weight, (1.0 - mean) * weight


def host_verdicts(measured: DataFrame, limits: Limits) -> DataFrame | None:
    """One row per host: ``host``, and for each rule and ``any`` whether its shrunk share passes the limit.

    None if no document has a host. The sums over all hosts are the one row that comes to the driver.
    """
    checks = rules()
    any_rule = F.greatest(*[c.cast("int") for c in checks.values()])
    hosts = (
        measured.where(F.col("source").isNotNull())
        .groupBy(F.col("source").alias("host"))
        .agg(
            F.count("*").alias("n_docs"),
            F.sum(any_rule).alias("any"),
            *[F.sum(c.cast("int")).alias(name) for name, c in checks.items()],
        )
    )
    names = ["any", *checks]
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("n"),
        F.sum(F.col("n_docs") * F.col("n_docs").cast("double")).alias("n2"),
        *[c for name in names for c in _prior(name)],
    ).first()
    if not sums["hosts"]:
        return None
    columns = []
    for name in names:
        a, b = _alpha_beta(sums["hosts"], sums["n"], sums["n2"], sums[f"sum_{name}"], sums[f"square_{name}"])
        share = (F.col(name) + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
        columns.append((share >= (limits.host_share if name == "any" else limits.rule_share)).alias(f"bad_{name}"))
    return hosts.select("host", *columns)


def judge(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``MEASURES``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than 10 words, or over a fifth of the words in repeated windows. ``kept``: not
    ``base_failed``, not of a host that loses all documents, and failing no rule that its host is
    condemned for. Documents without a host are judged by ``base_failed`` alone. Rows that repeat are
    judged each; columns other than ``doc_id, source, text`` are ignored.

    The measures are written to the shared folder once, as hosts and documents are both made from them.
    A hot host is aggregated before the shuffle, and the join with the verdicts is split where it is skewed.
    """
    limits = limits or Limits()
    checks = rules()
    measured = stored(measures(docs), "measures")
    verdicts = host_verdicts(measured, limits)
    # Written, so that its true size decides how it is joined.
    verdicts = stored(verdicts, "host_verdicts") if verdicts is not None else None
    base = checks["few_words"] | checks["repeats"]
    if verdicts is None:
        lost = F.lit(False)
        joined = measured
    else:
        lost = F.coalesce(F.col("bad_any"), F.lit(False))
        for name, fails in checks.items():
            lost = lost | (fails & F.coalesce(F.col(f"bad_{name}"), F.lit(False)))
        joined = measured.join(verdicts, measured["source"] == verdicts["host"], "left")
    return joined.select("doc_id", *MEASURES, base.alias("base_failed"), (~base & ~lost).alias("kept"))
