"""Near-duplicate texts by consistent weighted sampling over TF-IDF shingles.

Shingles are five consecutive words (lower case, white space between); a
shingle's weight in a text is its count times
``1 + DAMP * (1 - ln(df + SMOOTH) / ln(n + SMOOTH))`` -- a smoothed and damped
inverse document frequency -- with document frequencies counted over all
texts.  Improved consistent weighted sampling
draws ``BANDS * ROWS`` samples per text; texts that agree on a whole band
are compared by their weighted Jaccard similarity, and pairs that reach the
threshold are links.  Classes are the connected components.

How it runs:

* Texts are dealt into blocks of some MB by a hash of (id, text).
* Each block sends its distinct shingle fingerprints, sorted and
  gap-coded, to the ranges of the hash space; a range adds up document
  frequencies and answers each block with one small code per fingerprint.
  A fingerprint has so many bits that two shingles of the corpus rarely meet.
* A text can only have a link if at least 0.8 of its weight lies on shingles
  that another text has, too (the weights both texts share are a part of
  that), so other texts -- most of a corpus -- are not sampled.  This bound
  loses nothing.
* Equal texts are one node.  Each bucket compares its members with one
  leader; members outside the leader's component are leaders in later rounds,
  until each was one.  So every link between texts that share a bucket counts,
  while members that are in one component by then are not compared: a group of
  thousands of near copies costs about one comparison a member.  The rounds
  compare a block of leaders with a slice of members at a time, and give only
  the links found; no list of a bucket's pairs is made.

Defined results: a NULL text equals an empty one; texts without words equal
only each other; a text of fewer than five words is one shingle; repeated
rows are copies of each other; NULL ids are allowed and a class of them alone
has a NULL id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE, Texts, mix64, small_batches, text_slices, written

WORDS, SIMILARITY = 5, 0.8
#: 12 bands of 3 samples miss a pair of similarity 0.8 with probability 0.0002.
BANDS, ROWS = 12, 3
#: Leaders of a bucket (about) in the first round after its own, and their growth by round.
FIRST_LEADERS, LEADER_GROWTH = 64, 16
#: Smoothing keeps a text's own shingles from outweighing those of a pair, damping
#: those of a text from outweighing what a large group of near copies shares.
SMOOTH, DAMP = 9.0, 0.5
#: Bytes of text of one block, and fingerprints of one range of the hash space.
BLOCK_BYTES, RANGE_ROWS = 8 << 20, 2 << 20
#: Bytes of the weight vectors of one group of comparisons.
GROUP_BYTES = 8 << 20

_LN_STEP = 64.0


# ---------------------------------------------------------------- one block

def shingles(t: Texts, bits: int, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, fingerprint, count), sorted by text and fingerprint."""
    doc, s, e = t.runs(~SPACE[t.buf])
    h = t.hashes(s, e)
    n = np.bincount(doc, minlength=t.n)
    first = np.cumsum(n) - n
    k = np.minimum(n, words)  # words of a shingle
    m = np.where(n > 0, n - k + 1, 0)  # shingles of a text
    of = np.repeat(np.arange(t.n), m)
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(m) - m, m)
    fp = np.zeros(len(of), np.uint64)
    for j in range(words):
        use = k[of] > j
        fp[use] = mix64(fp[use] * np.uint64(0x9E3779B97F4A7C15) + h[at[use] + j] + np.uint64(j + 1))
    fp >>= np.uint64(64 - bits)
    o = np.lexsort((fp, of))
    of, fp = of[o], fp[o]
    new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(fp, prepend=np.uint64(0)) != 0))
    return of[new], fp[new], np.diff(np.append(new, len(of)))


def _block_shingles(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = []
    for i, _, t in text_slices(texts):
        of, fp, tf = shingles(t, bits)
        out.append((of + i, fp, tf))
    z = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (z, z.astype(np.uint64), z)


def _planes(x: np.ndarray) -> bytes:
    """Integers as byte planes (no more than the largest needs): compresses well."""
    k = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([k]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()


def _unplanes(b: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, : b[0]] = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], n).T
    return out.reshape(-1).view("<u8")


def _send(bits: int, ranges: int):
    def run(t: pa.Table) -> pa.Table:
        _, fp, _ = _block_shingles(t.column("text").combine_chunks(), bits)
        fp, n = np.unique(fp, return_counts=True)
        cut = np.searchsorted(fp, (np.arange(ranges + 1, dtype=object) * (1 << bits) // ranges)[:-1].astype(np.uint64))
        cut = np.append(cut, len(fp))
        block = t.column("block")[0].as_py()
        rows = [(r, block, int(b - a), _planes(np.diff(fp[a:b], prepend=np.uint64(0))), _planes(n[a:b]))
                for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        cols = list(zip(*rows)) or [[]] * 5
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(cols, types)], names=["range", "block", "n", "gaps", "counts"])
    return run


def _answer(t: pa.Table) -> pa.Table:
    """Document frequency code of each fingerprint that each block sent: 0 for
    one text, else its logarithm in steps of 1/64."""
    n = t.column("n").to_pylist()
    fp = [np.cumsum(_unplanes(b, k)) for b, k in zip(t.column("gaps").to_pylist(), n)]
    cnt = np.concatenate([_unplanes(b, k) for b, k in zip(t.column("counts").to_pylist(), n)])
    _, inv = np.unique(np.concatenate(fp), return_inverse=True)
    df = np.bincount(inv, weights=cnt)[inv]
    code = np.ceil(np.log(df) * _LN_STEP).astype("<u2")
    ends = np.cumsum(n)
    blobs = [zlib.compress(code[e - k: e].tobytes(), 1) for k, e in zip(n, ends)]
    return pa.table([t.column("block"), t.column("range"), pa.array(blobs, pa.binary())], names=["block", "range", "codes"])


def _gamma_table(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, from its distribution function."""
    x = np.linspace(0, 40, 4_000_001)
    return np.interp((np.arange(n) + 0.5) / n, 1 - np.exp(-x) * (1 + x), x)


def signatures(of: np.ndarray, fp: np.ndarray, weight: np.ndarray, samples: int = BANDS * ROWS) -> np.ndarray:
    """Improved consistent weighted samples, one row per text that occurs in
    ``of`` (sorted): hash of the sampled (fingerprint, level)."""
    start = np.flatnonzero(np.diff(of, prepend=-1))
    size = np.diff(np.append(start, len(of)))
    g = _gamma_table()
    ratio, log_c, lw = g.astype(np.float32), np.log(g).astype(np.float32), np.log(weight).astype(np.float32)
    out = np.zeros((len(start), samples), np.uint64)
    for k in range(samples):
        u = mix64(fp + np.uint64((k + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        r = ratio[(u & np.uint64(0xFFFF)).astype(np.int64)]
        lc = log_c[((u >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        beta = (u >> np.uint64(40)).astype(np.float32) * np.float32(2.0 ** -24)
        level = np.floor(lw / r + beta)
        a = lc - r * (level - beta + 1)
        least = np.minimum.reduceat(a, start)
        at = np.flatnonzero(a == np.repeat(least, size))
        at = at[np.searchsorted(at, start)]  # first of equal ones: the smaller fingerprint
        out[:, k] = mix64(fp[at] * np.uint64(3) + level[at].astype(np.int64).astype(np.uint64))
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    x = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        x = mix64(x * np.uint64(5) + sig[:, r::ROWS][:, :BANDS] + np.uint64(r))
    return x.view(np.int64)


_CANDIDATES = "node binary, bands array<long>, fps binary, weights binary"


def _sample(bits: int, n_docs: int, similarity: float):
    def run(docs: pa.Table, codes: pa.Table) -> pa.Table:
        names = ["node", "bands", "fps", "weights"]
        types = (pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        of, fp, tf = _block_shingles(docs.column("text").combine_chunks(), bits) if docs.num_rows else ([], [], [])
        if not len(of):
            return pa.table([pa.array([], t) for t in types], names=names)
        parts = codes.select(["range", "codes"]).sort_by("range").column("codes").to_pylist()
        code = np.concatenate([np.frombuffer(zlib.decompress(b), "<u2") for b in parts])
        _, inv = np.unique(fp, return_inverse=True)
        code = code[inv]
        df = np.exp(code / _LN_STEP)
        w = tf * (1 + DAMP * (1 - np.minimum(np.log(df + SMOOTH) / np.log(n_docs + SMOOTH), 1)))
        n = docs.num_rows
        total, shared = np.bincount(of, w, n), np.bincount(of, w * (code > 0), n)
        may = (total > 0) & (shared >= similarity * total * (1 - 1e-9))
        use = may[of]
        of, fp, w = of[use], fp[use], w[use]
        if not len(of):
            return pa.table([pa.array([], t) for t in types], names=names)
        start = np.flatnonzero(np.diff(of, prepend=-1))
        ends = np.append(start[1:], len(of))
        band = _bands(signatures(of, fp, w))
        w = w.astype("<f4")
        cols = (docs.column("node").take(pa.array(of[start])).to_pylist(), band.tolist(),
                [fp[a:b].tobytes() for a, b in zip(start, ends)], [w[a:b].tobytes() for a, b in zip(start, ends)])
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


# ---------------------------------------------------------------- Spark jobs

def _norm(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


def node(text: str) -> Column:
    """128-bit digest of a text: equal texts are one node."""
    return F.unhex(F.md5(_norm(text)))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(node, bands, fps, weights): nodes that may have a link, once each."""
    small_batches(docs.sparkSession)
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    n_docs, total = size["n"], size["b"] or 0
    bits = min(64, max(32, (total // 4).bit_length() + 14))
    blocks, ranges = total // BLOCK_BYTES + 1, total // 6 // RANGE_ROWS + 1
    d = docs.select(node(text).alias("node"), _norm(text).alias("text"),
                    F.pmod(F.xxhash64(doc_id, _norm(text)), F.lit(blocks)).cast("int").alias("block"))
    d = d.repartition(blocks, "block")
    sent = d.groupBy("block").applyInArrow(_send(bits, ranges), "range int, block int, n long, gaps binary, counts binary")
    codes = sent.groupBy("range").applyInArrow(_answer, "block int, range int, codes binary")
    got = d.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(_sample(bits, n_docs, similarity), _CANDIDATES)
    return written(written(got, "near-candidates").dropDuplicates(["node"]), "near-nodes")


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = dict(zip(b.schema.names, b.columns))
        sims = []
        for fa, wa, fb, wb in zip(*(c[k].to_pylist() for k in ("fps_a", "w_a", "fps_b", "w_b"))):
            fa, wa, fb, wb = np.frombuffer(fa, "<u8"), np.frombuffer(wa, "<f4"), np.frombuffer(fb, "<u8"), np.frombuffer(wb, "<f4")
            _, i, j = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
            low = float(np.minimum(wa[i], wb[j]).sum(dtype=np.float64))
            sims.append(low / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - low))
        yield pa.RecordBatch.from_arrays([c["a"], c["b"], pa.array(sims, pa.float64())], names=["a", "b", "similarity"])


def similarities(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, similarity): weighted Jaccard of each pair of nodes."""
    va = nodes.select(F.col("node").alias("a"), F.col("fps").alias("fps_a"), F.col("weights").alias("w_a"))
    vb = nodes.select(F.col("node").alias("b"), F.col("fps").alias("fps_b"), F.col("weights").alias("w_b"))
    return pairs.join(va, "a").join(vb, "b").select("a", "b", "fps_a", "w_a", "fps_b", "w_b") \
        .mapInArrow(_similar, "a binary, b binary, similarity double")


def buckets(nodes: DataFrame) -> DataFrame:
    """(k, node, lead, c, bytes): members of each bucket of two nodes or more (nodes
    that agree on a band), with the bucket's leader and number of members."""
    one = nodes.select("node", (F.octet_length("fps") + F.octet_length("weights")).alias("bytes"),
                       F.posexplode("bands").alias("i", "h")).select(F.xxhash64("i", "h").alias("k"), "node", "bytes")
    lead = one.groupBy("k").agg(F.min(F.struct(F.xxhash64("node").alias("x"), "node")).alias("m"),
                                F.count("*").alias("c")).where("c > 1").select("k", F.col("m.node").alias("lead"), "c")
    return written(one.join(lead, "k").select("k", "node", "lead", "c", "bytes"), "near-buckets")


def _against(similarity: float):
    """Links between the leaders and the members of buckets, as pairs of roots."""
    def run(leaders: pa.Table, members: pa.Table) -> pa.Table:
        leaders, members = leaders.sort_by("k"), members.sort_by("k")
        lk, mk = leaders.column("k").to_numpy(), members.column("k").to_numpy()
        l_fps, l_w, l_root = (leaders.column(c).to_pylist() for c in ("fps", "weights", "root"))
        m_fps, m_w, m_root = (members.column(c).to_pylist() for c in ("fps", "weights", "root"))
        out = set()
        for k in np.unique(lk):
            at, to = int(np.searchsorted(mk, k, "left")), int(np.searchsorted(mk, k, "right"))
            if at == to:
                continue
            n = np.array([len(x) // 8 for x in m_fps[at:to]])
            fp, w = np.frombuffer(b"".join(m_fps[at:to]), "<u8"), np.frombuffer(b"".join(m_w[at:to]), "<f4").astype(np.float64)
            own = np.repeat(np.arange(to - at), n)
            total = np.bincount(own, w, to - at)
            o = np.argsort(fp, kind="stable")
            fp, w, own = fp[o], w[o], own[o]
            for j in np.flatnonzero(lk == k):
                lf, lw = np.frombuffer(l_fps[j], "<u8"), np.frombuffer(l_w[j], "<f4").astype(np.float64)
                lo, hi = np.searchsorted(fp, lf, "left"), np.searchsorted(fp, lf, "right")
                hits = hi - lo
                idx = np.arange(hits.sum()) + np.repeat(lo - (np.cumsum(hits) - hits), hits)
                low = np.bincount(own[idx], np.minimum(w[idx], np.repeat(lw, hits)), to - at)
                for i in np.flatnonzero(low >= similarity * (lw.sum() + total - low)):
                    if m_root[at + i] != l_root[j]:
                        out.add((min(l_root[j], m_root[at + i]), max(l_root[j], m_root[at + i])))
        cols = list(zip(*sorted(out))) or [[], []]
        return pa.table([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])
    return run


def _round(open_: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): roots linked by a comparison of this round's leaders with the
    members of their buckets.  A large bucket is dealt into slices of members
    and blocks of leaders of some MB each; small ones share a group."""
    per = open_.groupBy("k").agg(
        F.sum("bytes").alias("m"), F.sum(F.when(F.col("now"), F.col("bytes")).otherwise(0)).alias("l")).where("l > 0")
    groups = (per.agg(F.sum("m")).first()[0] or 0) // GROUP_BYTES + 1
    ml, ll = F.floor(F.col("m") / GROUP_BYTES) + 1, F.floor(F.col("l") / GROUP_BYTES) + 1
    per = written(per.select("k", ml.cast("int").alias("slices"), ll.cast("int").alias("blocks")), "near-groups")
    alone = F.col("slices") * F.col("blocks") > 1
    g = F.when(alone, F.col("k")).otherwise(F.pmod("k", F.lit(groups))).alias("g")
    x = open_.join(per, "k").select(g, "k", "node", "root", "lead", "now", "slices", "blocks",
                                    F.xxhash64("node").alias("x"))
    vec = nodes.select("node", "fps", "weights")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def side(rows: DataFrame, s: Column, t: Column) -> DataFrame:
        same = [F.col(c).alias(c) for c in ("g", "k", "root", "fps", "weights")]  # aliased: both sides come from one frame
        return rows.join(vec, "node").select(*same, s.alias("s"), t.alias("t"))

    lead = side(x.where("now"), every("slices"), F.pmod("x", "blocks").cast("int"))
    rest = side(x.where("node != lead"), F.pmod("x", "slices").cast("int"), every("blocks"))
    return lead.groupBy("g", "s", "t").cogroup(rest.groupBy("g", "s", "t")) \
        .applyInArrow(_against(similarity), "a binary, b binary").distinct()


def labels(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of the nodes with links: the components of all pairs of
    nodes that share a bucket and are similar.

    The members of each bucket are first compared with its leader.  Then
    members outside the leader's component become leaders, too, in rounds of
    growing size, until each of them was one: a pair of different components
    always holds such a member, so no link between components is left out,
    and pairs inside a component are not compared."""
    b = buckets(nodes)
    stars = b.where("node != lead").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    lab = components(written(similarities(stars, nodes).where(F.col("similarity") >= similarity), "links-0"))
    was, share = 0, FIRST_LEADERS
    while True:
        u = F.shiftrightunsigned(F.xxhash64("k", "node"), 11) / F.lit(2.0 ** 53) * F.col("c")
        main = lab.select(F.col("node").alias("lead"), F.col("root").alias("main"))
        m = b.join(lab, "node", "left").join(main, "lead", "left") \
            .withColumns({"root": F.coalesce("root", "node"), "main": F.coalesce("main", "lead")})
        left = (F.col("root") != F.col("main")) & (u >= was)
        m = written(m.select("k", "node", "lead", "c", "bytes", "root", left.alias("left"),
                             (left & (u < share)).alias("now")), "near-open")
        b = m.join(m.where("left").select("k").distinct(), "k", "left_semi")
        if m.where("left").isEmpty():
            return lab
        new = written(_round(b, nodes, similarity), "links")
        if not new.isEmpty():
            up = components(new).select(F.col("node").alias("old"), F.col("root").alias("up"))
            moved = lab.join(up, F.col("root") == F.col("old"), "left").select("node", F.coalesce("up", "root").alias("root"))
            alone = up.join(lab, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("up").alias("root"))
            lab = written(moved.unionByName(alone), "labels")
        b = b.select("k", "node", "lead", "c", "bytes")
        was, share = share, share * LEADER_GROWTH


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component.  Labels go to
    neighbours and then jump to their label's label; each round is written."""
    e = edges.select("a", "b")
    e = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    lab = written(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = e.join(lab.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        low = lab.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "m").alias("low"))
        jump = lab.select(F.col("node").alias("low"), F.col("root").alias("far"))
        nxt = low.join(jump, "low").select("node", F.least("low", "far").alias("root"),
                                           (F.least("low", "far") != F.col("root")).alias("moved"))
        nxt = written(nxt, "labels")
        lab = nxt.select("node", "root")
        if nxt.where("moved").isEmpty():
            return lab


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the least id of its
    class), class_size, node, class_node."""
    nodes = candidates(docs, doc_id, text, similarity)
    comp = labels(nodes, similarity)
    d = docs.select(F.col(doc_id).alias("doc_id"), node(text).alias("node"))
    d = d.join(comp, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("class_node"))
    d = written(d, "near-members")
    # copies are a map-side combined count, also a class that a third of the rows is in
    per = d.groupBy("class_node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    per = written(per, "near-classes")  # a plain side: the join can then be split for a hot class
    return d.join(per, "class_node").select("doc_id", "class_id", "class_size", "node", "class_node")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (all columns as they are) with one row of each class: the one
    with the least id (then the least text digest, then any of equal rows)."""
    c = classes(docs, doc_id, text, similarity)
    best = c.groupBy("class_node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "node")).alias("m"),
                                       F.count("*").alias("n"))
    best = written(best.select(F.xxhash64(F.col("m.doc_id"), F.col("m.z"), F.col("m.node")).alias("__nd_key")), "near-kept")
    key = F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), node(text))
    kept = docs.withColumn("__nd_key", key).join(best, "__nd_key", "left_semi")
    rows = c.select(F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("node")).alias("__nd_key")) \
        .join(best, "__nd_key", "left_semi").count()
    if rows > best.count():  # equal id and text: only then one of them must be picked
        kept = kept.dropDuplicates(["__nd_key"])
    return kept.drop("__nd_key")
