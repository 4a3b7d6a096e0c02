"""SuperMinHash near-duplicate detection: banding, verification, union-find grouping.

1. Texts become sets of hashed word shingles. Texts with one word sequence are
   one node (the smallest id); the rest of the work is on nodes.
2. A SuperMinHash signature per node: each element draws a random permutation
   step by step (Fisher-Yates), step j offering the rank j + r at one position;
   steps stop as soon as every position holds a smaller rank.
3. Bands of the signature are bucket keys. Buckets of one node are dropped.
4. Inside a bucket no all-pairs list is made. Every node is first tested on the
   full sets against one pivot (the smallest member of a bucket; of its pivots
   the one it shares most buckets with), and accepted links are grouped by
   union-find. Buckets whose members are by then in one component are finished.
   Components that meet in an unfinished bucket are gathered around the largest
   of them, once for all buckets, and their members compared block by block
   inside tasks: pairs whose signatures agree in ``LEAST_EQUAL`` positions are
   confirmed there on the full sets, and only links that connect leave it.

Lower case is A-Z only; words are runs without ASCII white space. Null texts and
texts without words have an empty set and no links; texts with fewer words than
a shingle have one shingle, the whole sequence. Rows with a null id keep a null
component and take no part; rows with one id and different texts are one
document with the links of both (each row shows its own set size). An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import keep, keep_bucketed, partitions, prepare
from laborlens.llm.rolling import U, mix, prefix_of, span

WORDS = 5
#: per cent; a link needs 100 * intersection >= THRESHOLD * union
THRESHOLD = 75
BANDS, ROWS = 40, 4
#: at similarity 0.75 a link escapes all bands with probability (1 - 0.75**4)**40 < 3e-7
POSITIONS = BANDS * ROWS
#: a link of similarity 0.75 has 120 equal positions of 160, standard deviation below 5.5; this is six of them less
LEAST_EQUAL = 87
ELEMENTS_PER_STEP = 40_000
MEMBERS_PER_GROUP = 256
MEMBERS_PER_CELL = 2048
ROWS_PER_STEP = 512


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending (uint64)."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=n)
    end = np.cumsum(lens + 1) - 1
    start = end - lens
    h = prefix_of(np.frombuffer(b" ".join(words), dtype=np.uint8))
    k = min(k, n)
    return np.unique(span(h, start[:n - k + 1], end[k - 1:]))


def sequence_digest(text: str | None) -> bytes | None:
    """Equal for texts with the same word sequence; None without words."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def super_minhash(sets: list[np.ndarray], m: int = POSITIONS) -> np.ndarray:
    """One signature row of ``m`` 16-bit values per set (empty sets: zeros)."""
    out = np.zeros((len(sets), m), dtype=np.uint16)
    at, held = [], 0
    for i, s in enumerate(sets):
        if len(s):
            at.append(i)
            held += len(s)
        if at and (held >= ELEMENTS_PER_STEP or i == len(sets) - 1):
            out[at] = _signatures([sets[j] for j in at], m)
            at, held = [], 0
    return out


def _signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    e = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full((len(sets), m), np.inf)
    perm = None
    for j in range(m):
        r = mix(e ^ U((2 * j + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        k = (j + (r & U(0xFFFFF)) % U(m - j)).astype(np.int64)
        rank = j + (r >> U(20)).astype(np.float64) * 2.0 ** -44
        if perm is None:  # step 0 of the identity
            place = k
        else:
            row = np.arange(len(e))
            place = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
            perm[:, j] = place
        np.minimum.at(best.reshape(-1), doc * m + place, rank)
        if j + 1 == m:
            break
        # documents whose every position holds a rank that later steps can't beat are done
        alive = (best >= j + 1).any(axis=1)
        if not alive.any():
            break
        stay = alive[doc]
        if perm is None:
            e, doc, k = e[stay], doc[stay], k[stay]
            perm = np.tile(np.arange(m, dtype=np.uint16), (len(e), 1))
            row = np.arange(len(e))
            perm[row, k] = 0
            perm[:, 0] = k
        elif not stay.all():
            e, doc, perm = e[stay], doc[stay], perm[stay]
    return (mix(best.view(np.uint64)) & U(0xFFFF)).astype(np.uint16)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_STEP):
            rows = batch.slice(at, ROWS_PER_STEP)
            texts = rows.column(1).to_pylist()
            sets = [shingles(t) for t in texts]
            sigs = super_minhash(sets)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sequence_digest(t) for t in texts], pa.binary()),
                pa.array([g.tobytes() if len(s) else None for s, g in zip(sets, sigs, strict=True)], pa.binary()),
            ], names=["d", "n", "seq", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = batch.slice(at, 4096)
            if not rows.num_rows:
                continue
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=np.uint16)
            # one uint64 per band: its four 16-bit values
            keys = np.ascontiguousarray(sig.reshape(-1, POSITIONS)).view(np.uint64).reshape(-1, BANDS)
            keys = mix(mix(keys.copy()) + np.arange(1, BANDS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.view(np.int64).ravel()),
                pa.array(np.repeat(rows.column("d").to_numpy(), BANDS)),
                pa.array(np.repeat(rows.column("n").to_numpy(), BANDS))], names=["key", "d", "n"])


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """The exact test on two full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _verify(left: pa.Table, right: pa.Table) -> pa.Table:
    pivots = [shingles(t) for t in right["head_text"].to_pylist()]
    a, b = [], []
    for y, t in zip(left["d"].to_pylist(), left["t"].to_pylist(), strict=True):
        s = shingles(t)
        if any(linked(p, s) for p in pivots):
            a.append(right["head"][0].as_py())
            b.append(y)
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _local_union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's links: each node with its smallest reachable node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rx, ry = find(x), find(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
    pairs = [(x, find(x)) for x in list(parent)]
    pairs = [(x, r) for x, r in pairs if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())],
                                     names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node's smallest reachable node (roots not listed).

    Union-find inside every partition first, then alternating large-star and
    small-star steps over what is left, each written to the shared folder."""
    n = partitions(links.sparkSession)
    e = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
             .repartition(n, "a").mapInArrow(_local_union, "a long, b long"), "links")
    before = None
    while True:
        # large star: every neighbour above a node goes to the node's smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: every neighbour below a node, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = keep(small, "stars")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        # done when nothing changes and every node has one link, to its root
        if state == before or (state[0] == state[2] and not e.join(
                e.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()):
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among ``pairs`` (p, d), on the full sets; a pivot's members are tested in bounded groups."""
    sizes = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_GROUP).alias("groups"))
    dealt = pairs.join(sizes, "p").withColumn("g", F.pmod(F.xxhash64("d"), F.col("groups")))
    members = dealt.join(texts, "d").select("p", "g", "d", "t")
    heads = (sizes.select(F.col("p").alias("head"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"))
        .join(texts.select(F.col("d").alias("head"), F.col("t").alias("head_text")), "head"))
    return (members.groupBy("p", "g").cogroup(heads.groupBy("head", "part")).applyInArrow(_verify, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    seen = keep(rows.mapInArrow(_describe, "d long, n long, seq binary, sig binary"), "minhash-rows")
    # one node for each word sequence: its smallest id
    known = seen.where(F.col("d").isNotNull() & F.col("seq").isNotNull())
    nodes = known.groupBy("seq").agg(F.min("d").alias("node"))
    member = keep(known.select("d", "seq").distinct().join(nodes, "seq").select("d", "node"), "minhash-members")
    lead = (known.join(member.where("d = node").select("d").distinct(), "d", "left_semi")
            .groupBy("d", "seq").agg(F.first("n").alias("n"), F.first("sig").alias("sig")))
    links = _links(rows, lead.select("d", "n", "sig"))
    copies = member.where("d <> node").select(F.col("d").alias("a"), F.col("node").alias("b"))
    root = components(links.unionByName(copies))
    component = F.coalesce("root", "d")
    return (seen.join(root, F.col("d") == F.col("node"), "left")
            .select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(component == F.col("d"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the smallest id of their group, all columns as they are.

    Rows with one id are one document: they stay or go together."""
    gone = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"))
    left = rows.join(gone.hint("shuffle_hash"), F.col("id") == F.col("gone"), "left_anti")
    return left.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _links(rows: DataFrame, lead: DataFrame) -> DataFrame:
    """Confirmed links among nodes; together they connect every two linked nodes that share a bucket."""
    spark = rows.sparkSession
    keyed = lead.mapInArrow(_bands, "key long, d long, n long")
    shared_keys = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    buckets = keep(keyed.join(shared_keys, "key"), "minhash-buckets")
    wanted = buckets.select("d").distinct()
    texts = keep_bucketed(rows.join(wanted, "d").where(F.col("t").isNotNull()).select("d", "t"),
                          "minhash_texts", partitions(spark), "d")
    # most nodes are linked to the pivot (a bucket's smallest member) that they share most buckets with
    pivots = buckets.groupBy("key").agg(F.min_by(F.struct("d", "n"), "d").alias("p"))
    pairs = (buckets.join(pivots, "key").where("d <> p.d")
             # sizes further apart than the threshold can't be linked
             .where(F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * THRESHOLD)
             .groupBy(F.col("p.d").alias("p"), "d").agg(F.count(F.lit(1)).alias("bands")))
    likely = pairs.groupBy("d").agg(F.max_by("p", F.struct("bands", -F.col("p"))).alias("p")).select("p", "d")
    found = keep(_confirm(likely, texts), "minhash-links")
    # buckets whose members are in one component by now are finished; only (bucket, component) rows go on
    root = components(found)
    nodes = keep(_labelled(buckets.select("d", "n").distinct(), root), "minhash-nodes")
    size = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    held = keep(_labelled(buckets.select("key", "d"), root).select("key", "root").distinct().join(size, "root"),
                "minhash-open")
    hubs = (held.groupBy("key").agg(F.max(F.struct("m", "root")).alias("hub"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("key", F.col("hub.root").alias("hub")))
    # components that meet in some bucket, gathered around the largest component of the bucket
    near = held.join(hubs, "key").select("hub", "root").distinct()
    rows = near.join(nodes, "root").join(lead.select("d", "sig"), "d")
    major = F.col("root") == F.col("hub")
    count = near.join(size, "root").groupBy("hub").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(major, F.col("m"))) / MEMBERS_PER_CELL)).alias("of_hub"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(~major, F.col("m"))) / MEMBERS_PER_CELL)).alias("of_rest"))
    rows = rows.join(count, "hub")
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    cell = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"),
                                             j.cast("long").alias("j"), side.cast("int").alias("side"))
    place = lambda c: F.pmod(F.xxhash64("d"), F.col(c))
    zero, one = F.lit(0), F.lit(1)
    # a block of the hub's members meets all others; the others meet each other block by block
    cells = F.when(major, F.array(cell(0, place("of_hub"), zero, zero))).otherwise(F.concat(
        F.transform(upto("of_hub"), lambda i: cell(0, i, zero, one)),
        F.transform(upto("of_rest"), lambda o: cell(1, F.least(place("of_rest"), o), F.greatest(place("of_rest"), o),
                                                    F.when(o < place("of_rest"), one).otherwise(zero)))))
    dealt = (rows.join(texts, "d").select("hub", "d", "n", "root", "sig", "t", F.explode(cells).alias("cell"))
             .select("hub", "cell.*", "d", "n", "root", "sig", "t"))
    more = (dealt.repartition(partitions(spark), "hub", "kind", "i", "j").sortWithinPartitions("hub", "kind", "i", "j", "d")
            .mapInArrow(_close, "a long, b long"))
    return found.unionByName(more)


CELL = ("hub", "kind", "i", "j")


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links of one cell that connect components. A cell's rows come together; its two
    sides are compared, or one block with itself: sizes, then signatures, then the full sets.
    A link merges its components in the cell, so pairs inside one are not looked at again."""
    held: list[pa.Table] = []

    def links(t: pa.Table) -> pa.RecordBatch:
        d, n, side = (t[c].to_numpy() for c in ("d", "n", "side"))
        root = t["root"].to_numpy().copy()
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(len(d), POSITIONS)
        sets: dict[int, np.ndarray] = {}

        def full(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(t["t"][i].as_py())
            return sets[i]

        itself = t["kind"][0].as_py() == 1 and t["i"][0].as_py() == t["j"][0].as_py()
        left = np.arange(len(d)) if itself else np.flatnonzero(side == 1)
        right = left if itself else np.flatnonzero(side == 0)
        if len(left) > len(right):
            left, right = right, left
        a, b = [], []
        for k, x in enumerate(left.tolist()):
            y = right[k + 1:] if itself else right
            y = y[(root[y] != root[x]) & (np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * THRESHOLD)]
            equal = (sig[y] == sig[x]).sum(axis=1)
            y = y[equal >= LEAST_EQUAL][np.argsort(-equal[equal >= LEAST_EQUAL], kind="stable")]
            for z in y.tolist():  # the likeliest first
                if root[z] != root[x] and linked(full(x), full(z)):
                    a.append(min(d[x], d[z]))
                    b.append(max(d[x], d[z]))
                    root[root == root[z]] = root[x]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cell = np.stack([batch.column(c).to_numpy() for c in CELL])
        bounds = [0, *(np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        if held and any(held[-1][c][0].as_py() != batch.column(c)[0].as_py() for c in CELL):
            yield links(pa.concat_tables(held))
            held = []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            held.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
            if hi < batch.num_rows:
                yield links(pa.concat_tables(held))
                held = []
    if held:
        yield links(pa.concat_tables(held))


def _labelled(rows: DataFrame, root: DataFrame) -> DataFrame:
    return (rows.join(root, F.col("d") == F.col("node"), "left")
            .withColumn("root", F.coalesce("root", "d")).drop("node"))
