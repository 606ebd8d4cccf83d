"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps, per document,
the measurements and one integer whose bit *b* says that rule *b* failed; it is
written to the shared folder.  A *policy* is a versioned mask: a document is
kept under it iff ``failed & mask = 0``.  Because the stored ledger holds all
bits, a new policy, or the effect of dropping one rule from it (an ablation),
is a bitwise expression over it -- the texts are not read again.

:func:`judged` stores the ledger beside its documents, so that a policy takes
effect as a filter on the stored bits: no join moves a text, and rows with
equal or NULL ids are each judged by their own text.

Defined results: a NULL or empty text has no words and fails ``few_words``;
very long texts are measured whole; repeated rows get equal ledger rows; an
empty table gives an empty ledger; ids are whole numbers (a text id that is
none is an error); :func:`ledger` ignores extra columns, :func:`judged` and
:func:`apply_policy` keep them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import SPACE, byte_set, mix64, small_batches, text_slices, written

#: Rule names by bit.
RULES = ("few_words", "repeated_trigrams", "symbol_heavy", "repeated_lines", "odd_word_length", "few_letters",
         "bullet_lines", "cut_lines")
#: Policies by version: names of the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_trigrams"),
    "v1": ("few_words", "repeated_trigrams", "symbol_heavy", "repeated_lines", "odd_word_length", "few_letters"),
    "v2": RULES,
}
CURRENT = "v1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
            "n_bullet_lines", "n_cut_lines")
LEDGER = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", failed int"

_SYMBOL = byte_set(b"#*$%&|<>")
# code points that count as letters: ASCII letters and every lead byte of a longer sequence
_LETTER = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC2, 0xF5)))


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES.index(r) for r in rules)


def _distinct(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its count of equal (doc, key), and the number of distinct keys per doc."""
    k = mix64(key + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first, inv, cnt = np.unique(k, return_index=True, return_inverse=True, return_counts=True)
    return cnt[inv], first


def _first(buf: np.ndarray, at: np.ndarray, marks: tuple[bytes, ...]) -> np.ndarray:
    """Whether one of the marks stands at each place."""
    out = np.zeros(len(at), bool)
    padded = np.concatenate([buf, np.zeros(3, np.uint8)])
    for m in marks:
        hit = np.ones(len(at), bool)
        for k, c in enumerate(m):
            hit &= padded[at + k] == c
        out |= hit
    return out


def measure(t) -> dict[str, np.ndarray]:
    """Measurements of some texts (:class:`kerbside.llm.common.Texts`)."""
    inside = ~SPACE[t.buf]
    lead = (t.buf & 0xC0) != 0x80
    doc, s, e = t.runs(inside)
    n_words = np.bincount(doc, minlength=t.n)
    # lines that hold a word, equal to an earlier line of the text
    ld, ls, le = t.lines()
    has = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ld, ls, le = ld[has], ls[has], le[has]
    n_lines = np.bincount(ld, minlength=t.n)
    # lines that begin with a bullet, lines that end in an ellipsis
    bullet = _first(t.buf, s[np.searchsorted(s, ls)], (b"-", b"*", "\u2022".encode()))
    end = e[np.searchsorted(s, le) - 1]
    cut = _first(t.buf, end - 3, (b"...", "\u2026".encode())) & (end - 3 >= ls)
    _, first = _distinct(ld, t.hashes(ls, le))
    n_dup = n_lines - np.bincount(ld[first], minlength=t.n)
    # words inside a 3-word window that the text holds at least twice
    h = t.hashes(s, e)
    rep = np.zeros(len(s), bool)
    if len(s) >= 3:
        same = doc[2:] == doc[:-2]
        tri = mix64(mix64(h[:-2] * np.uint64(3)) + mix64(h[1:-1] * np.uint64(5)) + h[2:])[same]
        at = np.flatnonzero(same)
        cnt, _ = _distinct(doc[at], tri)
        at = at[cnt > 1]
        rep[at] = rep[at + 1] = rep[at + 2] = True
    return {
        "n_words": n_words, "word_chars": t.sums(inside & lead), "n_symbols": t.sums(_SYMBOL[t.buf]),
        "n_dup_lines": n_dup, "n_repeat_words": np.bincount(doc[rep], minlength=t.n), "n_lines": n_lines,
        "n_letters": t.sums(_LETTER[t.buf]), "n_bullet_lines": np.bincount(ld[bullet], minlength=t.n),
        "n_cut_lines": np.bincount(ld[cut], minlength=t.n),
    }


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """Failure bits from the measurements; every rule is evaluated for every document."""
    words, some = m["n_words"], m["n_words"] > 0
    fails = {
        "few_words": words < 50,
        "repeated_trigrams": 100 * m["n_repeat_words"] > 50 * words,
        "symbol_heavy": 4 * m["n_symbols"] > words,
        "repeated_lines": (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"]),
        "odd_word_length": some & ((m["word_chars"] < 2 * words) | (m["word_chars"] > 25 * words)),
        "few_letters": some & (2 * m["n_letters"] < m["word_chars"]),
        "bullet_lines": some & (10 * m["n_bullet_lines"] > 9 * m["n_lines"]),
        "cut_lines": some & (10 * m["n_cut_lines"] > 3 * m["n_lines"]),
    }
    return sum(fails[r].astype(np.int32) << b for b, r in enumerate(RULES))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *MEASURES, "failed"]
    for b in batches:
        for i, j, t in text_slices(b.column(1)):
            m = measure(t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i).cast(pa.int64()), *(pa.array(m[k], pa.int64()) for k in MEASURES),
                 pa.array(failures(m), pa.int32())], names=names)


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The stored ledger, one row per document: ``doc_id``, the measurements, ``failed`` (rule bits)."""
    small_batches(docs.sparkSession)
    return written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
                   .mapInArrow(_rows, LEDGER), "quality-ledger")


def kept(policy: str = CURRENT, failed: str = "failed"):
    """Column: the document passes every rule of the policy."""
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(led: DataFrame, policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(policy, rule, n_failed, n_only): per policy and rule, documents that fail
    the rule, and those that only this rule rejects (kept if it were dropped).
    Bitwise sums over the ledger in one aggregation; no text is read."""
    policies = policies or POLICIES
    out = []
    for name, rules in policies.items():
        m = mask(rules)
        for r in rules:
            bit = 1 << RULES.index(r)
            hit = F.col("failed").bitwiseAND(F.lit(m))
            out += [(name, r, F.sum((hit.bitwiseAND(F.lit(bit)) != 0).cast("long")), F.sum((hit == bit).cast("long")))]
    one = led.agg(F.array(*[
        F.struct(F.lit(n).alias("policy"), F.lit(r).alias("rule"), F.coalesce(a, F.lit(0)).alias("n_failed"),
                 F.coalesce(b, F.lit(0)).alias("n_only")) for n, r, a, b in out]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


#: Name of the stored ledger's column beside the documents' own.
_OF = "__ledger"


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``__ledger`` (measurements and ``failed``), stored: each text is
    read once.  The documents' columns are numbered there, so that no name clashes."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kind = T.StructType([*(T.StructField(m, T.LongType()) for m in MEASURES), T.StructField("failed", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, t in text_slices(b.column(at)):
                m = measure(t)
                led = pa.StructArray.from_arrays(
                    [*(pa.array(m[k], pa.int64()) for k in MEASURES), pa.array(failures(m), pa.int32())], names=[*MEASURES, "failed"])
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, led], names=[*b.schema.names, _OF])

    return written(numbered.mapInArrow(run, T.StructType([*numbered.schema.fields, T.StructField(_OF, kind)])), "judged-documents")


def apply_policy(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that the policy keeps by the stored bits."""
    return judged(docs, text).where(kept(policy, f"{_OF}.failed")).drop(_OF).toDF(*docs.columns)
