"""Rule bitmask ledger: every quality rule is evaluated once per document.

``evaluate_rules`` stores the measurements and one failure bit per rule.
Policies are versioned sets of rules, i.e. bit masks over the stored bits, so a
new policy or an ablation never reads a text again.

Defined results: a null text counts as empty and has no words; an empty table
gives an empty ledger; a repeated row gives a ledger row each time; other columns
are ignored. Everything is built-in expressions on one row, so no document is
ever split and nothing is shuffled before ``ablations``, which first reduces the
ledger to one count per distinct bit set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import let, words

#: Rule name -> SQL condition over the measurements under which a document fails.
#: The position in this table is the bit, so rules are only ever appended.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_dup_lines > 3 and 2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}

#: Policy version -> names of the rules that reject a document.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": tuple(RULES),
}
CURRENT_POLICY = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask_of(rule_names, rules=RULES) -> int:
    bits = list(rules)
    return sum(1 << bits.index(name) for name in rule_names)


def _words_in_repeats(tokens: Column) -> Column:
    """Words lying in a 3-word window that the text has twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("window"),
            i.alias("at"),
        ),
    )

    def covered(ordered: Column) -> Column:
        # Equal windows are neighbours once sorted.
        again = F.filter(
            ordered,
            lambda x, j: F.coalesce(F.get(ordered, j - 1)["window"] == x["window"], F.lit(False))
            | F.coalesce(F.get(ordered, j + 1)["window"] == x["window"], F.lit(False)),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))))

    return F.when(F.size(tokens) >= 3, let(F.array_sort(windows), covered)).otherwise(0)


def _measured(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))

    def of_words(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            _words_in_repeats(tokens).cast("long").alias("n_repeat_words"),
        )

    def of_lines(kept: Column) -> Column:
        return F.struct(
            F.size(kept).cast("long").alias("n_lines"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        let(words(text), of_words).alias("words"), let(lines, of_lines).alias("lines"), symbols.cast("long").alias("n_symbols")
    )


def evaluate_rules(docs: DataFrame, rules=RULES, keep=("doc_id",)) -> DataFrame:
    """The ledger: columns ``keep`` of ``docs`` as struct ``row``, ``MEASURES``, and ``fail_bits``.

    ``keep=None`` keeps all columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    measured = docs.select(row.alias("row"), _measured(F.coalesce(F.col("text"), F.lit(""))).alias("m"))
    flat = measured.select(
        "row", "m.words.n_words", "m.words.word_chars", "m.n_symbols", "m.lines.n_lines", "m.lines.n_dup_lines",
        "m.words.n_repeat_words",
    )
    bits = F.lit(0).cast("long")
    for bit, condition in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return flat.withColumn("fail_bits", bits)


def passes(rule_names, rules=RULES) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(rule_names, rules)).cast("long")) == 0


def ablations(ledger: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """Per policy and rule: documents failing it, rejected by the policy, and rejected by this rule alone.

    ``rejected_without_it`` is what the policy would still reject if the rule were dropped.
    """
    cases = F.array(*[
        F.struct(
            F.lit(policy).alias("policy"), F.lit(name).alias("rule"),
            F.lit(mask_of(names, rules)).cast("long").alias("mask"), F.lit(mask_of([name], rules)).cast("long").alias("bit"),
        )
        for policy, names in policies.items() for name in names
    ])
    counts = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cased = counts.select("fail_bits", "n", F.explode(cases).alias("c")).select("fail_bits", "n", "c.*")
    failing = F.col("fail_bits").bitwiseAND(F.col("mask"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return cased.groupBy("policy", "rule").agg(
        total(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failed_rule"),
        total(failing != 0).alias("rejected"),
        total(failing == F.col("bit")).alias("rejected_by_it_alone"),
        total((failing != 0) & (failing != F.col("bit"))).alias("rejected_without_it"),
    )
