"""Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf. Inside its group leaves stand in ascending order, and a
node is labelled with the interval of leaf ranks that it covers, so one node is
another's ancestor exactly if its interval contains the other's. The levels of
a group's tree are dealt into bands: a band holds the nodes over at most
``SPAN`` units of the band below, and all of them share one bucket, the span's
number. Up: the nodes of a bucket are hashed level by level and its top node is
a unit of the next band. Down: a bucket's units and nodes meet the bucket's top
node, which brings the proof of everything above it; ancestors are attached by
containment, and the siblings of a node are what its parent's interval covers
without its own. Each row is shuffled twice in all, each band holds 1/SPAN of
the rows of the one below, and no task holds more than one bucket at a time. The groups'
top nodes are the leaves of one more tree, whose top is the root.

Order: groups by UTF-8 bytes, null first; in a group by the order column, nulls
first, rows that agree in it by digest. Rows equal in all of that may take any
place among themselves: they have equal digests, so no digest of the tree
depends on it. Null fields are ``-``, others their UTF-8 length, ``:`` and
their text. An empty table has no leaves, no root and gives an empty result;
columns not named as fields are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlens.llm.common import keep, partitions, prepare

#: leaf ranks that a bucket covers in units of its band, at most
SPAN = 256
STEPS = "array<struct<left:string,right:string>>"


def leaf_digest(*fields: Column) -> Column:
    """sha256 over the fields, each ``-`` if null, else its UTF-8 length, ``:`` and its text."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition number, and each row's place among its partition's rows of the group (rows come sorted by group)."""
    part, group, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = np.empty(batch.num_rows, np.int64)
        for i, g in enumerate(batch.column("g").to_pylist()):
            group, n = g, (n + 1 if g == group else 0)
            places[i] = n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()),
                                          pa.array(places)], names=[*batch.schema.names, "part", "place"])


def ranked(rows: DataFrame, name: str) -> DataFrame:
    """g, key, digest, carry -> g, n (rows of g), lo = hi = rank in g, digest, carry."""
    spark = rows.sparkSession
    # equal rows are dealt out by where they were read: they may take any place among themselves
    order = ["g", "key", "digest", "salt"]
    dealt = (rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
             .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("salt"))
    shape = dealt.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("place")).schema
    kept = keep(dealt.mapInArrow(_place, shape), f"merkle-{name}")
    each = Window.partitionBy("g")
    bases = (kept.groupBy("g", "part").agg(F.count(F.lit(1)).alias("c"))  # at most one row per group and partition
             .select("g", "part", F.sum("c").over(each).alias("n"), (F.sum("c").over(each.orderBy("part")) - F.col("c")).alias("base")))
    rank = F.col("base") + F.col("place")
    return kept.join(bases, ["g", "part"]).select("g", "n", rank.alias("lo"), rank.alias("hi"), "digest", "carry")


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def _climb(fanout: int, band: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).sort_by("lo")
        lo, hi, digest = (t.column(c).to_pylist() for c in ("lo", "hi", "digest"))
        group, n, unit = t.column("g")[0].as_py(), t.column("n")[0].as_py(), fanout ** (band * levels)
        units, up = -(-n // unit), levels
        if units <= fanout ** levels:  # the whole group is in this bucket: stop when one node is left
            up = next(k for k in range(levels + 1) if fanout ** k >= units)
        out = []
        for level in range(1, up + 1):
            cut = range(0, len(lo), fanout)
            lo, hi, digest = ([lo[i] for i in cut], [hi[min(i + fanout, len(hi)) - 1] for i in cut],
                              [_digest(digest[i:i + fanout]) for i in cut])
            out += [(group, n, band * levels + level, a, b, d, level == up) for a, b, d in zip(lo, hi, digest, strict=True)]
        if up == 0:
            out.append((group, n, band * levels, lo[0], hi[0], digest[0], True))
        yield pa.RecordBatch.from_pylist([dict(zip(NODE_COLS, r, strict=True)) for r in out], schema=NODE_ARROW)
    return run


NODE_COLS = ["g", "n", "level", "lo", "hi", "digest", "top"]
NODE = "g string, n long, level int, lo long, hi long, digest string, top boolean"
NODE_ARROW = pa.schema([("g", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("lo", pa.int64()),
                        ("hi", pa.int64()), ("digest", pa.string()), ("top", pa.bool_())])


class Tree:
    """The groups' trees: per band its units and its nodes, and one top node per group."""

    def __init__(self, rows: DataFrame, fanout: int, name: str):
        self.fanout, self.name = fanout, name
        self.levels = max(1, next(k for k in range(1, 64) if fanout ** (k + 1) > SPAN))
        units = ranked(rows, name)
        longest = units.agg(F.max("n")).first()[0] or 0  # one number
        self.units, self.nodes = [], []
        while not self.units or fanout ** (len(self.units) * self.levels) < longest:
            band = len(self.units)
            nodes = keep(units.select("g", "n", "lo", "hi", "digest").groupBy("g", self.bucket(band))
                         .applyInArrow(_climb(fanout, band, self.levels), NODE), f"merkle-{name}-band{band}")
            self.units.append(units)
            self.nodes.append(nodes)
            units = nodes.where(F.col("top") & ~self.whole()).select("g", "n", "lo", "hi", "digest")
        self.tops = reduce(DataFrame.unionByName, [
            n.where(F.col("top") & self.whole()).withColumn("band", F.lit(b)) for b, n in enumerate(self.nodes)])

    def bucket(self, band: int) -> Column:
        return F.expr(f"lo div {self.fanout ** ((band + 1) * self.levels)}L")

    @staticmethod
    def whole() -> Column:
        """The interval covers the whole group."""
        return (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)

    def node_table(self) -> DataFrame:
        """Every node above the units of its band: g, n, level, lo, hi, digest."""
        return reduce(DataFrame.unionByName, self.nodes).select(*NODE_COLS[:-1])

    def proofs(self, above: DataFrame) -> DataFrame:
        """carry, digest, top and proof of every row; ``above``: g, band, top (digest of the
        group's top node) and path (its own proof) of every group."""
        down = None
        for band in reversed(range(len(self.units))):
            tops = (self.nodes[band].where(F.col("top") & self.whole()).select("g", "level", "lo", "hi", "digest")
                    .join(above.where(F.col("band") == band).select("g", "top", "path"), "g"))
            level = (band + 1) * self.levels
            inner = self.nodes[band].where(~F.col("top")).select(
                "g", "level", "lo", "hi", "digest", F.lit(None).cast("string").alias("top"), F.lit(None).cast(STEPS).alias("path"))
            right = inner.unionByName(tops)
            if down is not None:
                right = right.unionByName(down.select("g", F.lit(level).alias("level"), "lo", "hi", "digest", "top", "path"))
            units = self.units[band]
            if band:
                units = units.withColumn("carry", F.struct(F.lit(0).alias("none")))
            units = units.select("g", "lo", "hi", "digest", "carry")
            shape = units.select("*", F.lit("").alias("top"), F.lit(None).cast(STEPS).alias("path")).schema
            down = (units.groupBy("g", self.bucket(band))
                    .cogroup(right.groupBy("g", self.bucket(band))).applyInArrow(_descend, shape))
            if band:
                down = keep(down, f"merkle-{self.name}-down{band}")
        return down


def _descend(left: pa.Table, right: pa.Table) -> pa.Table:
    """Attach to each unit of a bucket the siblings along its ancestors, then the proof of the bucket's top node."""
    left = left.sort_by("lo")
    nodes = right.sort_by([("level", "descending"), ("lo", "ascending")])
    level, path = nodes.column("level").to_numpy(), nodes.column("path")[0].as_py()
    lo, hi, digest = nodes.column("lo").to_numpy(), nodes.column("hi").to_numpy(), nodes.column("digest").to_pylist()
    cuts = [*np.flatnonzero(np.diff(level, prepend=level[0] + 1)).tolist(), len(level)]
    layers = [(lo[a:b], hi[a:b], digest[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    units = (left.column("lo").to_numpy(), left.column("hi").to_numpy(), left.column("digest").to_pylist())
    above, paths = layers[0], [[(s["left"], s["right"]) for s in path]]
    lone = len(units[0]) == 1 and len(layers) == 1 and digest[0] == units[2][0]  # the unit itself is the group's top
    for layer in [] if lone else [*layers[1:], units]:
        parent = np.searchsorted(above[0], layer[0], side="right") - 1
        if (layer[1] > above[1][parent]).any():
            raise ValueError("a node's interval lies in no interval of the level above")
        first, end = np.searchsorted(parent, parent, side="left").tolist(), np.searchsorted(parent, parent, side="right").tolist()
        # the parent's interval without the node's own: the nodes before it and after it
        paths = [[("".join(layer[2][a:i]), "".join(layer[2][i + 1:b])), *paths[p]]
                 for i, (a, b, p) in enumerate(zip(first, end, parent.tolist(), strict=True))]
        above = layer
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    steps = pa.StructArray.from_arrays([pa.array([s[c] for p in paths for s in p], pa.string()) for c in (0, 1)],
                                       names=["left", "right"])
    top = [t for t in nodes.column("top").to_pylist() if t is not None][0]
    return (left.append_column("top", pa.array([top] * len(left), pa.string()))
            .append_column("path", pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)))


class Manifest:
    """The built manifest: ``root``, ``nodes()`` (labelled nodes), ``proofs()`` (one per row)."""

    def __init__(self, groups: Tree, tops: Tree, root: str | None):
        self.groups, self.tops, self.root = groups, tops, root

    def nodes(self) -> DataFrame:
        """tree ('group' or 'root'), g (group key: 'n' for null, 'v' and the value otherwise), n, level, lo, hi, digest."""
        return (self.groups.node_table().withColumn("tree", F.lit("group"))
                .unionByName(self.tops.node_table().withColumn("tree", F.lit("root"))))

    def proofs(self) -> DataFrame:
        """carry, leaf, subroot, root, proof (array of the digests left and right, leaf level first)."""
        at_root = self.tops.tops.select("g", "band", F.col("digest").alias("top"), F.lit(None).cast(STEPS).alias("path"))
        empty = F.array().cast(STEPS)
        subroots = self.tops.proofs(at_root.withColumn("path", empty))
        above = subroots.select(F.col("carry.g").alias("g"), F.col("carry.band").alias("band"),
                                F.col("digest").alias("top"), "path")
        above = keep(above, "merkle-subroots")
        return self.groups.proofs(above).select(
            "carry", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(self.root).alias("root"),
            F.col("path").alias("proof"))


def build_manifest(docs: DataFrame, fields: list[str], group_col: str, order_col: str, carry: list[Column],
                   fanout: int = 2) -> Manifest:
    """Build the manifest of ``docs``: leaves over ``fields``, a tree per value of
    ``group_col`` in ascending ``order_col``, one tree over the groups. ``carry`` are
    the columns that travel with each leaf to its proof."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    prepare(docs.sparkSession)
    group = F.col(group_col).cast("string")
    rows = docs.select(F.when(group.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), group)).alias("g"),
                       F.col(order_col).alias("key"), leaf_digest(*[F.col(f) for f in fields]).alias("digest"),
                       F.struct(*carry).alias("carry"))
    groups = Tree(rows, fanout, "groups")
    tops = Tree(groups.tops.select(F.lit("").alias("g"), F.col("g").alias("key"), "digest", F.struct("g", "band").alias("carry")),
                fanout, "root")
    root = tops.tops.select("digest").first()  # one row
    return Manifest(groups, tops, root[0] if root else None)


def verified_proofs(spark: SparkSession, manifest: Manifest, claimed: Column) -> DataFrame:
    """The proofs with ``folded_root`` (from the claimed leaf and the siblings) and ``verified``."""
    rows = manifest.proofs().withColumn("folded_root", fold(claimed, F.col("proof")))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))



def manifest_sql(docs: str = "documents") -> str:
    """DuckDB twin of the two-way manifest over ``docs`` with every seventh row (by crc32 of its
    id) tampered: trees level by level, siblings looked up per leaf and level, proofs folded as lists."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"

    byte = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)), xor(c, x))"
    crc = (f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda k: ascii(k)::BIGINT), "
           f"lambda c, x: {byte}, 4294967295::BIGINT))")

    def levels(name: str, start: str, by: str) -> str:
        key = f"{by}, " if by else ""
        return f"""{name} AS ({start} UNION ALL
           SELECT {key}level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM {name}
           WHERE n > 1 GROUP BY {key}level, idx // 2, n)"""

    def steps(tree: str, place: str, depth: str, extra: str) -> str:
        return f"""SELECT l.id, '{tree}' AS tree, s.level, CASE WHEN b.digest IS NULL THEN 'N' WHEN ({place} >> s.level) % 2 = 1
                     THEN 'L' || b.digest ELSE 'R' || b.digest END AS step
                   FROM (SELECT *, unnest(range(0, {depth})) AS level FROM leaves) s JOIN leaves l ON s.id = l.id
                   LEFT JOIN {tree} b ON b.level = s.level AND b.idx = xor({place} >> s.level, 1) {extra}"""
    return f"""
    WITH RECURSIVE plain AS MATERIALIZED (
      SELECT doc_id, lang, {leaf('n_chars')} AS leaf, CASE WHEN {crc} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS changed FROM {docs}),
    numbered AS MATERIALIZED (
      SELECT *, (row_number() OVER () - 1)::BIGINT AS id, (dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1)::BIGINT AS g,
             (row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS idx,
             (count(*) OVER (PARTITION BY lang))::BIGINT AS n FROM plain),
    {levels('up', "SELECT g, 0::BIGINT AS level, idx, leaf AS digest, n FROM numbered", "g")},
    nodes AS MATERIALIZED (SELECT * FROM up),
    subroots AS MATERIALIZED (SELECT g, digest, level AS depth, (count(*) OVER ())::BIGINT AS n FROM nodes WHERE n = 1),
    {levels('rise', "SELECT 0::BIGINT AS level, g AS idx, digest, n FROM subroots", "")},
    tops AS MATERIALIZED (SELECT * FROM rise),
    leaves AS MATERIALIZED (SELECT l.*, s.digest AS subroot, s.depth, (SELECT max(level) FROM tops) AS height
                            FROM numbered l JOIN subroots s ON l.g = s.g),
    found AS ({steps('nodes', 'l.idx', 'depth', 'AND b.g = l.g')} UNION ALL {steps('tops', 'l.g', 'height', '')}),
    proofs AS (SELECT id, list(step ORDER BY tree, level) AS steps FROM found GROUP BY id),
    folded AS (SELECT l.*, coalesce(p.steps, []) AS steps, list_reduce(coalesce(p.steps, []), lambda a, s: CASE s[1]
                 WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END,
                 coalesce(l.changed, l.leaf)) AS folded_root FROM leaves l LEFT JOIN proofs p ON l.id = p.id)
    SELECT doc_id, leaf, subroot, r.digest AS root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
           folded_root, folded_root = r.digest AS verified
    FROM folded, (SELECT digest FROM tops WHERE n = 1) r"""
