"""Cross-site boilerplate lines, by distinct-site spread.

A line is boilerplate when it stands on at least ``min_sites`` distinct
sites.  One HyperLogLog sketch of the sites per line hash is built and
merged by aggregation.  Lines whose estimate is clearly above the threshold
are decided by the sketch; lines near it get an exact distinct count.  One
document keeps each boilerplate line (the smallest id among its holders);
it is removed from all others, so a text that exists only as copies is not
lost altogether.

DataFrame functions only.  A line on a third of all rows is one group of
partial aggregates (a sketch, a minimum), and the joins on the line hash are
plain equi-joins that adaptive execution splits; no list per line is built,
only the removed positions of one document.

Defined results: lines are compared after trimming blanks, tabs and carriage
returns; blank lines are never boilerplate; a NULL text stays NULL with no
lines; a NULL site counts as one site; rows with equal id and text are
treated alike (if they hold a line first, all of them keep it); an empty
table gives an empty result; extra columns stay, also those whose names
clash with ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import row_key, written

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 10
#: log2 of the sketch size (standard error 1.6 %), and the relative band around
#: the threshold inside which the count is made exact (six standard errors).
LG_K, BAND = 12, 0.10


def _lines(text: str) -> Column:
    return F.split(F.col(text).cast("string"), "\n", -1)


def _hash() -> Column:
    return F.xxhash64(F.btrim(F.col("line"), F.lit(" \t\r")))


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """(key, doc, site, pos, h): one row per line that is not blank."""
    return docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).alias("doc"),
                       F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"),
                       F.posexplode(_lines(text)).alias("pos", "line")) \
        .where(F.btrim(F.col("line"), F.lit(" \t\r")) != "").select("key", "doc", "site", "pos", _hash().alias("h"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, doc_id: str = "doc_id",
                text: str = "text", site: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lines, spread): occurrences of the lines whose sketch reaches the lower
    edge of the band, and per such line (h, n_sites or NULL, exact, doc, key):
    the boilerplate lines with the document that keeps each."""
    lines = line_table(docs, doc_id, text, site)
    sketch = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("s"))
    est = sketch.select("h", F.hll_sketch_estimate("s").alias("est")).where(F.col("est") >= min_sites * (1 - band))
    # written first: the join then has plain exchanges below it, which can be split for a hot line
    found = written(lines.join(written(est, "line-spread"), "h"), "line-candidates")
    near = F.col("est") <= min_sites * (1 + band)
    exact = found.where(near).groupBy("h").agg(F.countDistinct("site").alias("n_sites")) \
        .where(F.col("n_sites") >= min_sites)
    sure = found.where(~near).select("h", F.lit(None).cast("long").alias("n_sites")).distinct()
    keeper = found.groupBy("h").agg(F.min(F.struct("doc", "key")).alias("first"))
    spread = exact.unionByName(sure).join(keeper, "h").select("h", "n_sites", F.col("first.key").alias("keeper"))
    return found, written(spread, "boilerplate")


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, doc_id: str = "doc_id",
                text: str = "text", site: str = "source", lines_col: str = "n_lines",
                removed_col: str = "n_removed") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, and two more
    columns: lines of the text before (blank ones too) and lines removed."""
    found, spread = boilerplate(docs, min_sites, band, doc_id, text, site)
    cut = found.join(spread, "h").where(F.col("key") != F.col("keeper")) \
        .groupBy("key").agg(F.collect_set("pos").alias("cut")) \
        .select(F.col("key").alias("__ld_key"), F.col("cut").alias("__ld_cut"))
    j = docs.withColumn("__ld_key", row_key(doc_id, text)).join(cut, "__ld_key", "left")
    gone = F.coalesce(F.size("__ld_cut"), F.lit(0))
    rest = F.array_join(F.filter(_lines(text), lambda x, i: ~F.array_contains(F.col("__ld_cut"), i)), "\n")
    # every right-hand side is computed from the columns as they were read
    new = {text: F.when(F.col("__ld_cut").isNull(), F.col(text)).otherwise(rest),
           lines_col: F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long"), removed_col: gone.cast("long")}
    new[lines_col] = F.when(F.col(text).isNull(), F.lit(0)).otherwise(new[lines_col]).cast("long")
    new[removed_col] = F.when(F.col("__ld_cut").isNull(), F.lit(0)).otherwise(F.size("__ld_cut")).cast("long")
    cols = [new.pop(c).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return j.select(*cols, *[v.alias(k) for k, v in new.items()])
