"""Quality rules as a bitmask ledger: measure once, judge by versioned policies.

Every rule is evaluated once for each document. The ledger keeps what was
measured and one bit for each failed rule; a policy is a mask of bits that
reject. Another policy, or the same policy without one rule, is then a bitwise
operation on the ledger, without reading the texts again.

Null text has no words and no lines. A null ``doc_id`` stays null; repeated
rows get a row each. Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.llm.common import BLANKS, let, words_of

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

#: Rules by bit: name and the failing condition over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars > 15 * n_words or 2 * word_chars < 3 * n_words"),
    ("upper_case", "2 * n_upper > word_chars"),
    ("no_lines", "n_lines = 0"),
)
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document with any of these failures is dropped."""

    version: str
    rejects: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
        return sum(bits[name] for name in self.rejects)


POLICIES = {
    p.version: p
    for p in (
        Policy("v1", BASE_RULES),
        Policy("v2", (*BASE_RULES, "symbols", "repeated_lines", "word_length", "upper_case")),
    )
}


def _repeated_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text.

    Windows are compared by hash. Only texts that have two equal hashes go on
    to sort (hash, place); neighbours with the same hash are the repeats, and
    each covers up to the next one's place.
    """
    last = F.size(words) - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def covered(placed: Column) -> Column:
        repeats = F.filter(
            placed,
            lambda e, j: F.coalesce(F.get(placed, j - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(placed, j + 1)["h"] == e["h"], F.lit(False)),
        )
        return let(
            F.sort_array(F.transform(repeats, lambda e: e["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, covered))

    return F.when(last < 0, F.lit(0)).otherwise(let(hashes, count))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    rows = docs.select(
        "doc_id",
        let(
            words_of(F.col("text")),
            lambda w: F.struct(
                F.size(w).alias("n_words"),
                F.length(F.array_join(w, "")).alias("word_chars"),
                _repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        let(
            lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
        ).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"),
    )
    return rows.select(
        "doc_id",
        *[
            F.col(f"{path}{name}").cast("long").alias(name)
            for path, name in (
                ("w.", "n_words"),
                ("w.", "word_chars"),
                ("", "n_symbols"),
                ("l.", "n_dup_lines"),
                ("w.", "n_repeat_words"),
                ("l.", "n_lines"),
                ("", "n_upper"),
            )
        ],
    )


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``fail_bits``: bit i is set where rule i fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, condition) in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs).withColumn("fail_bits", total.cast("long"))


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def judge(rows: DataFrame, policy: Policy = POLICIES["v2"]) -> DataFrame:
    """``base_failed`` and ``kept`` by a policy; base failures are never kept."""
    base = passes(POLICIES["v1"])
    return rows.withColumns({"base_failed": ~base, "kept": base & passes(policy)})


def ablations(rows: DataFrame, policy: Policy = POLICIES["v2"]) -> DataFrame:
    """For each rule of a policy: failures, sole failures, and documents kept without the rule.

    The ledger shrinks to one row per distinct mask in the map tasks; rules
    times masks rows meet after that. An empty ledger gives no rows.
    """
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    index = {name: i for i, (name, _) in enumerate(RULES)}
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << index[r]).cast("long").alias("bit")) for r in policy.rejects]
    )
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    each = counts.select("n", hit.alias("hit"), F.explode(rules).alias("r"))
    rest = F.col("hit").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    summed = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        summed(F.col("hit").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        summed(F.col("hit") == F.col("r.bit")).alias("n_sole"),
        summed(F.col("hit") == 0).alias("n_kept"),
        summed(rest == 0).alias("n_kept_without"),
        F.bit_or("hit").alias("seen_bits"),
    )
