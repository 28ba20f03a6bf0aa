"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit.

``ledger`` measures whole texts and stores, for each document, the measurements and a
mask of failed rules. Policies are named masks; applying one, or asking what a rule
alone costs, is integer arithmetic on the mask and never reads a text again.

Nulls and empty texts have no words and fail ``few_words``. Repeated rows are judged
one by one. Other columns of the input are dropped, so none can clash. ``judged`` shows
beside each document the one rule that it would need to be without (null if it is kept,
or if several rules reject it), and how many documents that rule alone costs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import Rolling, utf8

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rules in the order of their bits; a new rule gets the next bit, none is ever reused.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

#: What a version of the policy rejects. Versions are only added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def covered(words: list[bytes], roll: Rolling) -> int:
    """Words that lie in a window found at least twice in this text."""
    if len(words) <= WINDOW:
        return 0
    own = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    runs = roll.runs(roll.sums(own), WINDOW)
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[: len(runs)] += twice
    edge[WINDOW : WINDOW + len(runs)] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measured(texts: pa.Array) -> pa.Array:
    roll = Rolling()
    found = []
    for raw in texts:
        text = raw.as_py().decode()
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        found.append(
            {
                "n_words": len(words),
                "word_chars": len(text) - sum(map(text.count, SPACE)),
                "n_symbols": sum(map(text.count, SYMBOLS)),
                "n_lines": len(lines),
                "n_dup_lines": len(lines) - len(set(lines)),
                "n_repeat_words": covered(words, roll),
            }
        )
    return pa.array(found, pa.struct([(x, pa.int64()) for x in MEASURES]))


def measures(text: Column) -> Column:
    return F.arrow_udf(measured, ", ".join(f"{x} long" for x in MEASURES))(text)


def failures() -> Column:
    """The mask of failed rules."""
    bits = [F.when(F.expr(RULES[name]), F.lit(bit)).otherwise(F.lit(0)) for name, bit in BITS.items()]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total.cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed``, one row per row of ``docs``."""
    told = docs.select("doc_id", measures(utf8("text")).alias("m")).select("doc_id", "m.*")
    return told.withColumn("failed", failures())


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def rejected_by(failed: Column, policy: str) -> Column:
    return failed.bitwiseAND(F.lit(mask(policy))) != 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that it alone rejects.

    The ledger is first counted by mask, of which there are at most 2 to the number of
    rules; everything after works on those counts.
    """
    counts = book.groupBy("failed").agg(F.count("*").alias("n"))
    rules = book.sparkSession.createDataFrame([(name, BITS[name]) for name in POLICIES[policy]], "rule string, bit long")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failed").bitwiseAND(F.lit(mask(policy))) == F.col("bit")
    return (
        counts.join(F.broadcast(rules), hit)
        .groupBy("rule")
        .agg(F.sum("n").alias("n_failed"), F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"))
    )


def sole(failed: Column, policy: str) -> Column:
    """The name of the only rule of the policy that a document fails; null if none or several."""
    hit = failed.bitwiseAND(F.lit(mask(policy)))
    return F.coalesce(*[F.when(hit == BITS[name], F.lit(name)) for name in POLICIES[policy]])


def judged(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """A ledger with ``sole_rule`` and ``n_sole``: the documents that an ablation of it brings back.

    ``book`` is read twice, so it should be stored. What is joined has a row per rule at most.
    """
    cost = ablations(book, policy).select(F.col("rule").alias("sole_rule"), F.col("n_only").alias("n_sole"))
    return book.withColumn("sole_rule", sole(F.col("failed"), policy)).join(F.broadcast(cost), "sole_rule", "left")


def accepted(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their columns; one scan, no shuffle."""
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row")
    judged = docs.select(row, measures(utf8("text")).alias("m")).select("row", "m.*")
    return judged.where(~rejected_by(failures(), policy)).select("row.*")
