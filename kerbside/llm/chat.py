"""Collapse of cumulative conversation snapshots, and chat rendering.

Chat logs often hold a conversation again and again, each time with a few
more turns.  Every turn gets the digest of the conversation up to and
including it (a rolling sum of position-salted turn hashes, two 32-bit
halves summed in 64 bits, next to the number of turns); a conversation whose
full digest is the digest of a proper prefix of another one is a snapshot.
An anti-join on (turns, digest) keeps the maximal conversations, which are
then rendered.  Window functions run over (conversation, turn order), the
distinct prefixes and the equal conversations are map-side combined, so a
first turn or a whole conversation that a third of the log shares is one row
per task in the shuffle.  A conversation is gathered only to be rendered, as
it then is one text.  DataFrame functions only.

Defined results: turns are ordered by turn, then role, then text, NULLs
first; repeated rows are turns of their own; NULL roles and texts differ
from empty ones in the digest and render as ``unknown`` and empty; rows with
a NULL id form one conversation; of equal conversations the one with the
smallest id stays and counts its copies; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import written

#: Control markers of the rendered form; in a turn's own text they are broken up.
START, END = "<|im_start|>", "<|im_end|>"


def _turns(conv: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
                                           F.col("text").asc_nulls_first())
    return conv.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                       F.col(text).alias("text")).withColumn("i", F.row_number().over(w).cast("long"))


def prefix_digests(conv: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv, i, a, b, more): digest (i, a, b) of the first i turns; more: turns follow."""
    h = F.xxhash64("i", "role", F.col("role").isNull(), "text", F.col("text").isNull())
    w = Window.partitionBy("conv").orderBy("i")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = _turns(conv, conv_id, turn, role, text).select("conv", "i", h.alias("h"))
    return t.select("conv", "i", F.sum(F.shiftrightunsigned("h", 32)).over(run).alias("a"),
                    F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).over(run).alias("b"),
                    F.lead("i").over(w).isNotNull().alias("more"))


def maximal(conv: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, n_turns, n_copies): conversations that are no prefix of another one."""
    d = written(prefix_digests(conv, conv_id, turn, role, text), "turn-digests")
    full = d.where(~F.col("more")).groupBy("i", "a", "b").agg(F.min("conv").alias("conv"),
                                                              F.count("*").alias("n_copies"))
    prefixes = d.where("more").select("i", "a", "b").distinct()
    return full.join(prefixes, ["i", "a", "b"], "left_anti").select("conv", F.col("i").alias("n_turns"), "n_copies")


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def rendered(conv: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered): one row per maximal conversation."""
    keep = maximal(conv, conv_id, turn, role, text).withColumnRenamed("conv", "kept")
    t = _turns(conv, conv_id, turn, role, text)
    one = F.concat(F.lit(START), _safe(F.coalesce(F.col("role"), F.lit("unknown"))), F.lit("\n"),
                   _safe(F.coalesce(F.col("text"), F.lit(""))), F.lit(END))
    lists = t.select("conv", "i", one.alias("s")).join(keep, F.col("conv").eqNullSafe(F.col("kept")), "left_semi") \
        .groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("x"))
    return lists.join(keep, F.col("conv").eqNullSafe(F.col("kept"))) \
        .select(F.col("conv").alias("conv_id"), "n_turns", "n_copies",
                F.array_join(F.transform("x", lambda p: p["s"]), "\n").alias("rendered"))
