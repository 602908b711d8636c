"""Quality rules as a bitmask ledger: every rule is evaluated once, policies read its bits.

Only DataFrame functions stand on this path.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import fresh

BLANK = r"\x20\x09-\x0D"
SPACE = f"[{BLANK}]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps_words", "n_mark_words", "n_alpha_words")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once; a name in a lambda is never inlined again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _with_repeat_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """``df`` with ``name``: how many of ``words`` are in windows of three that the text holds twice or more, the first included.

    A window's key is its hash with its place in the low bits, so sorting plain numbers brings alike windows
    together; only those that share a hash with a neighbour are then compared by their words.
    """
    mask, keys, alike = (fresh(c, df) for c in ("_mask", "_keys", "_alike"))
    w = F.col(words)
    place = lambda x: x.bitwiseAND(F.col(mask)).cast("int")
    shared = lambda x, i: F.coalesce(x.bitwiseXOR(F.get(keys, i)).between(0, F.col(mask)), F.lit(False))
    key = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.bitwise_not(F.col(mask))).bitwiseOR(i)
    staged = df.withColumn(mask, F.expr(f"shiftleft(1L, length(bin(size({words})))) - 1")).withColumn(keys, F.sort_array(F.transform(w, key)))
    window = lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i"))
    some = F.filter(keys, lambda x, i: (place(x) < F.size(w) - 2) & (shared(x, i + 1) | ((i > 0) & shared(x, i - 1))))
    staged = staged.withColumn(alike, F.array_sort(F.transform(some, lambda x: window(place(x)))))
    same = lambda x, i: F.coalesce(reduce(Column.__and__, (x[c] == F.get(alike, i)[c] for c in "abc")), F.lit(False))
    twice = F.filter(alike, lambda x, i: same(x, i + 1) | ((i > 0) & same(x, i - 1)))
    at = F.array_sort(F.transform(twice, lambda x: x["i"]))
    # Each window adds the words that the window before it in the text has not covered yet.
    covered = _let(at, lambda p: F.aggregate(F.transform(p, lambda x, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), x - F.get(p, k - 1)))), F.lit(0), lambda s, x: s + x))
    return staged.withColumn(name, covered).drop(mask, keys, alike)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``measures`` (long each); a null text has no words, so all are 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines, repeated = (fresh(c, docs) for c in ("_words", "_lines", "_repeated"))
    held = docs.withColumn(words, F.filter(F.split(text, SPACE), lambda w: w != "")).withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(rf"[^{BLANK}]")))
    held = _with_repeat_words(held, words, repeated)
    count = lambda test: F.size(F.filter(words, test))
    values = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.col(repeated),
        "n_lines": F.size(lines),
        "n_caps_words": count(lambda w: w.rlike(r"[A-Z]") & ~w.rlike(r"[a-z]")),
        "n_mark_words": F.regexp_count(text, F.lit(rf"[#*$%&|<>!][^{BLANK}]*+")),  # one match for each word with a mark
        "n_alpha_words": count(lambda w: w.rlike(r"[A-Za-z\x{80}-\x{10FFFF}]")),
    }
    return held.withColumn("measures", F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])).drop(words, lines, repeated)


@dataclass(frozen=True)
class Rule:
    """A failure test over the measures, kept at one bit of the ledger."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "10 * n_symbols > n_words"),
    Rule(3, "marked_words", "100 * n_mark_words > 20 * n_words"),
    Rule(4, "shouting", "100 * n_caps_words > 30 * n_words"),
    Rule(5, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(6, "short_words", "word_chars < 3 * n_words"),
    Rule(7, "long_words", "word_chars > 12 * n_words"),
    Rule(8, "few_letter_words", "100 * n_alpha_words < 70 * n_words"),
)
BASE = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "v1": BASE,
    "v2": tuple(r.name for r in RULES),
}


def mask_of(names) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measures, failures long) for every row: bit i of ``failures`` is set if rule i fails.

    Null and empty texts fail too_few_words; repeated rows get a row each; an empty table an empty
    ledger; other columns are ignored.  Texts are read whole.
    """
    table = measured(spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))), "_text").drop("_text").select("doc_id", "measures", "measures.*")
    failures = None
    for r in RULES:
        bit = F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long"))
        failures = bit if failures is None else failures.bitwiseOR(bit)
    return table.select("doc_id", "measures", failures.alias("failures"))


def apply_policy(entries: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``kept``: no rule of the policy fails."""
    return entries.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0)


def ablation(entries: DataFrame, policy: str = "v2") -> DataFrame:
    """(rule, rejected, rejected_alone) under a policy: what it rejects, and what only it rejects.

    One pass over the ledger's bits; no text is read again.
    """
    under = F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long"))
    used = [r for r in RULES if r.name in POLICIES[policy]]
    counts = entries.select(under.alias("bits")).agg(*[f for r in used for f in (
        F.count_if(F.col("bits").bitwiseAND(F.lit(1 << r.bit).cast("long")) != 0).alias(f"{r.name}_any"),
        F.count_if(F.col("bits") == F.lit(1 << r.bit)).alias(f"{r.name}_alone"))])
    rows = [F.struct(F.lit(r.name).alias("rule"), F.col(f"{r.name}_any").alias("rejected"), F.col(f"{r.name}_alone").alias("rejected_alone")) for r in used]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
