"""Quality rules by weak supervision (operator 7), DataFrame functions only.

Every rule looks at figures of a text and votes good (1), bad (-1) or abstains
(0). No rule decides by itself: expectation-maximisation estimates, without
labels, how often each rule votes each way on good and on bad documents (its
accuracies) and how common good documents are; a document's verdict is its
posterior probability of being good under these estimates.

The votes of all documents are counted by pattern first, so a round of
expectation-maximisation is one small aggregate over at most ``3 ** rules``
patterns, whatever the number of documents. It starts from a plain reading of the
votes (a document is bad if any rule says so) and ends when the likelihood of the
votes no longer grows. Every probability starts from ``PRIOR`` documents dealt
evenly, a fixed number, so that none is 0; the data decide everything else. Of the
two classes found, the good one is that whose documents get fewer bad votes. Only
the sums of a round (six a rule) reach the driver.

Base figures (words are split at ASCII white space): ``word_chars``,
``n_symbols``, ``n_dup_lines``, ``n_repeat_words``. Windows of eight words are
compared by a 64-bit hash of their words' 64-bit hashes. A document fails the
base rules with fewer than 20 words or over 30 % of repeated words.

Defined results: a null or empty text has no words, fails and is not kept; texts
are read whole; rows with a null id or repeated rows are judged as they come;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, col, materialized, table

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Documents that every class and vote is believed to have before any is seen.
PRIOR = 1.0
#: The estimate has converged when a round raises the log-likelihood by less than
#: this share of it; it is an error if ``ROUNDS`` rounds do not get there.
CONVERGED = 1e-7
ROUNDS = 1000
KEEP = 0.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by name, over the columns of ``figures``."""
    length = _share("word_chars", "n_words")
    symbols = _share("n_symbols", "n_words")
    lines = _share("n_dup_lines", "n_lines")
    repeats = _share("n_repeat_words", "n_words")
    upper = _share("n_upper", "word_chars")
    variety = _share("n_distinct_words", "n_words")
    marks = _share("n_marks", "n_words")
    odd = _share("n_odd_chars", "n_words")
    return {
        "word_length": _vote((length < 2) | (length > 15), length.between(3, 10)),
        "symbols": _vote(symbols > 0.15, symbols < 0.02),
        "lines": _vote(lines > 0.4, lines == 0),
        "repeats": _vote(repeats > 0.3, repeats == 0),
        "upper_case": _vote(upper > 0.35, upper < 0.15),
        "variety": _vote(variety < 0.15, variety > 0.3),
        "marks": _vote(marks > 0.3, marks < 0.05),
        "odd_chars": _vote(odd > 0.15, odd < 0.03),
    }


def figures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The figures of every row (see the module's notes)."""
    t = F.col("text")
    df = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(rf"[^{SPACE}]"))
    df = df.select(
        "doc_id",
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.translate(t, _UPPER, ""))).cast("long").alias("n_upper"),
        (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long").alias("n_marks"),
        F.length(F.regexp_replace(t, r"[\p{L}\p{M}\p{N}\s.,;:'\"()-]+", "")).cast("long").alias("n_odd_chars"),
        lines.alias("lines"),
        # space at either end leaves an empty part
        F.transform(F.filter(F.split(t, rf"[{SPACE}]+", -1), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"),
    )
    df = df.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        "n_upper",
        "n_marks",
        "n_odd_chars",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))
            ),
        ).alias("wins"),
    )
    # only texts with a window that occurs twice are looked at in order
    twice = F.size("wins") > F.size(F.array_distinct("wins"))
    order = F.array_sort(F.transform("wins", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = df.withColumn("order", F.when(twice, order)).drop("wins")

    def same(k, j):
        return F.coalesce(F.get("order", k)["w"] == F.get("order", j)["w"], F.lit(False))

    marked = F.array_sort(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size("order") - 1), lambda k: same(k, k - 1) | same(k, k + 1)),
            lambda k: F.get("order", k)["i"],
        )
    )
    df = df.withColumn("marked", F.when(F.col("order").isNotNull(), marked)).drop("order")
    # a window covers eight words, or as many as lie before the next window
    covered = F.aggregate(
        F.col("marked"),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"].cast("long"),
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("marked")


@dataclass
class Estimate:
    """``good``: share of good documents. ``votes[rule][class][vote + 1]``:
    probability of the vote in class 0 (bad) or 1 (good)."""

    good: float
    votes: dict[str, list[list[float]]]

    def _logs(self) -> list[Column]:
        """Log of each class's share times the probability of its votes."""
        out = []
        for k, share in enumerate((1 - self.good, self.good)):
            total = F.lit(math.log(share))
            for name, classes in self.votes.items():
                bad, none, good = (math.log(p) for p in classes[k])
                v = F.col(f"vote_{name}")
                total = total + F.when(v == -1, bad).when(v == 0, none).otherwise(good)
            out.append(total)
        return out

    def posterior(self) -> Column:
        """The probability of good, over vote columns."""
        bad, good = self._logs()
        return 1 / (1 + F.exp(bad - good))

    def likelihood(self) -> Column:
        """The log-likelihood of a row's votes."""
        bad, good = self._logs()
        return F.greatest(bad, good) + F.log1p(F.exp(-F.abs(bad - good)))


def _start(names: list[str]) -> Column:
    """The first guess at the posterior: bad if any rule says so."""
    bad = F.lit(False)
    for n in names:
        bad = bad | (F.col(f"vote_{n}") == -1)
    return F.when(bad, 0.1).otherwise(0.9)


def estimate(votes: DataFrame, names: list[str]) -> Estimate | None:
    """Expectation-maximisation over the vote columns; ``None`` for no rows."""
    columns = [f"vote_{n}" for n in names]
    patterns = materialized(votes.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    posterior, likelihood, found, before = _start(names), F.lit(0.0), None, None
    for _ in range(ROUNDS):
        weight = {0: F.col("n") * (1 - F.col("p")), 1: F.col("n") * F.col("p")}
        sums = [F.sum("n").alias("n"), F.sum(weight[1]).alias("good"), F.sum(F.col("n") * F.col("l")).alias("likelihood")]
        for name in names:
            for k in (0, 1):
                for v in (-1, 0, 1):
                    hit = F.col(f"vote_{name}") == v
                    sums.append(F.sum(F.when(hit, weight[k]).otherwise(0.0)).alias(f"{name}_{k}_{v}"))
        row = patterns.withColumns({"p": posterior, "l": likelihood}).agg(*sums).first()
        if not row["n"]:
            return None
        if before is not None and row["likelihood"] - before < CONVERGED * abs(before):
            return _oriented(found)
        before = row["likelihood"] if found else None
        table_ = {}
        for name in names:
            counts = [[row[f"{name}_{k}_{v}"] + PRIOR / 3 for v in (-1, 0, 1)] for k in (0, 1)]
            table_[name] = [[c / sum(cs) for c in cs] for cs in counts]
        found = Estimate((row["good"] + PRIOR) / (row["n"] + 2 * PRIOR), table_)
        posterior, likelihood = found.posterior(), found.likelihood()
    raise RuntimeError(f"no convergence in {ROUNDS} rounds")


def _oriented(e: Estimate) -> Estimate:
    """The estimate with the class of fewer bad votes as the good one."""
    bad, good = (sum(classes[k][0] for classes in e.votes.values()) for k in (0, 1))
    if good <= bad:
        return e
    return Estimate(1 - e.good, {n: classes[::-1] for n, classes in e.votes.items()})


def quality(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """The figures, ``base_failed``, the votes, ``quality`` (posterior
    probability) and ``kept`` of every row of ``docs``."""
    votes = rules()
    judged = materialized(
        figures(docs, doc_id=doc_id, text=text)
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumns({f"vote_{n}": v.cast("int") for n, v in votes.items()}),
        "quality-votes",
    )
    found = estimate(judged, list(votes))
    posterior = found.posterior() if found else F.lit(0.0)
    return judged.withColumn("quality", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep)
    )


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Query: figures and verdict of every document."""
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
