"""Quality rules as a bitmask ledger.

``ledger`` reads every whole text once, measures it and stores one bit per failed rule.
Policies are versioned masks over those bits (``POLICIES``): applying another version, or
asking what each rule contributes (``ablation``), works on the stored bits alone and never
reads a text again. The ablation counts equal bit patterns first (at most 2**rules rows,
partial aggregation before the shuffle) and combines the patterns bitwise.

Defined cases: a null text counts as empty; no words fails ``few_words`` only (ratios over
zero words do not fail); repeated rows are measured each on its own; other columns pass
through, and a column named like a measurement is replaced; an empty table gives an empty
ledger.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import WordHashes, byte_values, map_rows, window_hashes

WINDOW = 8  # words of a window whose repetition counts
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
LOWER = bytes(range(ord("a"), ord("z") + 1))
UPPER = bytes(range(ord("A"), ord("Z") + 1))

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_shouts", "n_stutters",
)

# rule name -> SQL condition over the measures that means "fails"; the bit is the position.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "upper_case": "n_upper > n_lower",
    "shouting": "10 * n_shouts > 3 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "stuttering": "5 * n_stutters > n_words",  # words equal to the word before
    # of texts that are mostly in Latin letters; one acronym says nothing about another script
    "upper_case_latin": "n_upper > n_lower and 2 * (n_upper + n_lower) > word_chars",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


# version -> bits that reject
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | mask("symbols", "upper_case", "shouting"),
    "v2": sum(BIT.values()) - mask("upper_case_latin"),
    "v3": sum(BIT.values()) - mask("upper_case"),
}
CURRENT = "v3"


def measure(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    """All measures of one text, in the order of MEASURES."""
    words = text.split()  # bytes.split() cuts at exactly [\x20\x09-\x0D]
    n = len(words)
    points = len(text) - _continuations(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    each = hashes.of(words)
    covered = 0
    if n > WINDOW:
        w = window_hashes(each, WINDOW)
        order = np.argsort(w)
        s = w[order]
        same = np.zeros(len(s) + 1, bool)
        np.equal(s[1:], s[:-1], out=same[1:-1])
        starts = order[same[1:] | same[:-1]]
        if len(starts):
            edge = np.zeros(n + 1, np.int32)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + WINDOW, -1)
            covered = int(np.count_nonzero(np.cumsum(edge[:n])))
    return (
        n,
        points - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        covered,
        len(lines),
        len(text) - len(text.translate(None, UPPER)),
        len(text) - len(text.translate(None, LOWER)),
        sum(x.endswith(b"!") for x in words) if b"!" in text else 0,
        int(np.count_nonzero(each[1:] == each[:-1])),
    )


# UTF-8 continuation bytes
CONTINUATION = bytes(range(0x80, 0xC0))


def _continuations(text: bytes) -> int:
    return 0 if text.isascii() else len(text) - len(text.translate(None, CONTINUATION))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus one long column per measure."""

    def make():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            rows = [measure(b or b"", hashes) for b in byte_values(batch.column(text))]
            columns = zip(*rows, strict=True) if rows else [[] for _ in MEASURES]
            return {name: pa.array(c, pa.int64()) for name, c in zip(MEASURES, columns, strict=True)}

        return step

    return map_rows(docs, make, [T.StructField(m, T.LongType()) for m in MEASURES], by=text)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the measures and ``fail_bits`` (bit k: the k-th rule of RULES fails)."""
    bits = sum((F.when(F.expr(c), BIT[r]).otherwise(0) for r, c in RULES.items()), F.lit(0))
    return measures(docs, text).withColumn("fail_bits", bits.cast("long"))


def apply_policy(entries: DataFrame, version: str = CURRENT, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """A ledger plus ``kept``: no bit of the policy is set."""
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policies[version])) == 0)


def ablation(entries: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, ``rejected`` by the policy, ``failed`` by the rule,
    ``only`` (rejected by nothing but this rule: what dropping the rule would give back)."""
    patterns = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    asked = [(v, m, r, BIT[r]) for v, m in policies.items() for r in RULES if m & BIT[r]]
    # every pattern row is asked the same fixed list of (policy, rule)
    asks = F.array(*(
        F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"),
                 F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit"))
        for v, m, r, b in asked
    ))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return (
        patterns.select("fail_bits", "n", F.inline(asks))
        .groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("documents"),
            count(hit != 0).alias("rejected"),
            count(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
            count(hit == F.col("bit")).alias("only"),
        )
    )


def query(docs: DataFrame) -> DataFrame:
    """Digest of the ledger under the current policy, one row per document."""
    out = apply_policy(ledger(docs.select("doc_id", "text")))
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "fail_bits",
    )


ship_by_value(__name__)
