"""Merkle manifest of a dataset, with a witness for every row.

Rows are the leaves of one tree per group, the roots of the groups the leaves
of a top tree. A node is the hash of `ARITY` consecutive nodes below it (fewer
at the end of a level), until one remains. Hashes are lowercase hex SHA-256 of
the hex texts below them.

Witnesses grow while leaves are appended: a node that is completed takes the
nodes on its left in its run, and each later one of the run extends the
witnesses of those before it. A task appends one aligned block of
ARITY ** DEPTH leaves; the roots of the blocks are leaves of the next round,
and their witnesses continue those of the rows. No task holds more than one
block, whatever the size of a group.

Nulls and odd rows: a null field is written `-`, so a null and an empty text
are different leaves; a null group is a group of its own and the first. Rows
with the same id are ordered by their hash, and equal rows are leaves of their
own. An empty table has no rows and no root; a single row is its own root, with
an empty witness. Other columns are neither read nor hashed, so their names do
not matter.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketally.plans.scratch import stored

ARITY = 3
#: Levels a task appends at once: 3 ** 8 = 6,561 leaves with some 0.5 kB of witness each.
DEPTH = 8

#: One level of a witness: the hashes before and after the node in its run, 32 bytes each.
WITNESS = "array<struct<left:binary,right:binary>>"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field_text(c: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]), 256))


class Tree:
    """An open tree that leaves are appended to one by one."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.leaves: list[int] = []
        self.runs: list[list[int]] = []  # by level: the nodes that have no parent yet
        self.digest: list[bytes] = []  # by node, as are the next three
        self.left: list[bytes] = []
        self.right: list[bytes] = []
        self.parent: list[int] = []

    def append(self, digest: bytes) -> None:
        self.leaves.append(len(self.digest))
        self._complete(digest, 0)

    def _complete(self, digest: bytes, level: int) -> int:
        """A new node: its run's earlier nodes are its witness, and it is theirs."""
        if level == len(self.runs):
            self.runs.append([])
        run, node = self.runs[level], len(self.digest)
        self.digest.append(digest)
        self.left.append(b"".join(self.digest[i] for i in run))
        self.right.append(b"")
        self.parent.append(-1)
        for i in run:
            self.right[i] += digest
        run.append(node)
        if len(run) == self.arity:
            self._close(level)
        return node

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        text = b"".join(self.digest[i].hex().encode() for i in run)
        parent = len(self.digest)
        for i in run:
            self.parent[i] = parent
        self._complete(hashlib.sha256(text).digest(), level + 1)

    def finish(self, height: int | None) -> bytes:
        """Close all runs up to one node, which may be raised to `height`; its hash."""
        level = 0
        while level != height and (len(self.runs[level]) > 1 or any(self.runs[level + 1 :]) or height is not None):
            if self.runs[level]:
                self._close(level)
            level += 1
        return self.digest[self.runs[level][0]]

    def witnesses(self) -> pa.Array:
        """The witness of each leaf, from the leaf up."""
        left, right, at = [], [], [0]
        for node in self.leaves:
            while self.parent[node] >= 0:
                left.append(self.left[node])
                right.append(self.right[node])
                node = self.parent[node]
            at.append(len(left))
        levels = pa.StructArray.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["left", "right"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), levels)


def numbered(df: DataFrame, group: str, order: list[str], spread: list[str] | None = None) -> DataFrame:
    """Add `pos`, from 0 within the group, and `total`, the group's rows.

    Rows are ranged over tasks by group and order, so a group of any size is
    spread; a row's place is its place in its task plus what earlier tasks hold
    of the group. `spread` names the first columns of the order that are enough
    to range by, where the others are long. The group is never null.
    """
    ranged = df.repartitionByRange(group, *(spread or order)).sortWithinPartitions(group, *order)
    ranged = stored(ranged.withColumn("row", F.monotonically_increasing_id()), "ranged")
    rows = ranged.withColumn("task", F.shiftright("row", 33))
    held = rows.groupBy("task", group).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    by_task = Window.partitionBy(group).orderBy("task")
    starts = held.select(
        "task",
        group,
        "first",
        (F.sum("n").over(by_task.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.sum("n").over(Window.partitionBy(group)).alias("total"),
    )
    placed = rows.join(starts, ["task", group])
    pos = F.col("row") - F.col("first") + F.coalesce("before", F.lit(0))
    return placed.select(*df.columns, pos.alias("pos"), "total")


def _blocks(nodes: DataFrame, group: str, arity: int, depth: int) -> DataFrame:
    """Append every block; add `block`, `witness` and the block's root `top`."""
    size = arity**depth
    sorted_nodes = (
        nodes.withColumn("block", F.expr(f"pos div {size}"))
        .repartition(group, "block")
        .sortWithinPartitions(group, "block", "pos")
    )
    columns = sorted_nodes.columns

    def finished(rows: pa.Table, tree: Tree) -> pa.RecordBatch:
        small = rows.column("total")[0].as_py() <= size
        top = tree.finish(None if small else depth)
        whole = rows.combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*whole.columns, tree.witnesses(), pa.array([top] * len(tree.leaves), pa.binary())], [*columns, "witness", "top"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, tree, parts = None, None, []
        for batch in batches:
            keys = list(zip(batch.column(group).to_pylist(), batch.column("block").to_pylist(), strict=True))
            digests = batch.column("digest").to_pylist()
            begin = 0
            for i, (key, digest) in enumerate(zip(keys, digests, strict=True)):
                if key != open_key:
                    if i > begin:
                        parts.append(batch.slice(begin, i - begin))
                    if tree:
                        yield finished(pa.Table.from_batches(parts), tree)
                    open_key, tree, parts, begin = key, Tree(arity), [], i
                tree.append(digest)
            parts.append(batch.slice(begin))
        if tree:
            yield finished(pa.Table.from_batches(parts), tree)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_nodes.schema)
    return sorted_nodes.mapInArrow(run, f"{fields}, witness {WITNESS}, top binary")


def trees(nodes: DataFrame, group: str, *, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """Add `witness` and `top`, the root of its group, to nodes of (group, pos, total, digest).

    One round per `depth` levels of the largest group; a round has the roots of
    the last one's blocks as its leaves.
    """
    size = arity**depth
    low = stored(_blocks(nodes, group, arity, depth), "blocks")
    blocks = low.where((F.col("total") > size) & (F.col("pos") % size == 0)).select(
        group, F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"), F.col("top").alias("digest")
    )
    if blocks.isEmpty():
        return low.drop("block")
    high = trees(blocks, group, arity=arity, depth=depth)
    high = high.select(group, F.col("pos").alias("block"), F.col("witness").alias("higher"), F.col("top").alias("root"))
    joined = low.join(high, [group, "block"], "left")
    witness = F.concat("witness", F.coalesce("higher", F.array().cast(WITNESS)))
    return joined.select(*nodes.columns, witness.alias("witness"), F.coalesce("root", "top").alias("top"))


def manifest(leaves: DataFrame, *, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """Add `subroot`, `root` and `witness` (to the root) to leaves of (part, doc_id, digest, ...).

    `part` is the group as text, never null. Leaves ascend by doc_id, groups by
    their text in bytes.
    """
    placed = numbered(leaves, "part", ["doc_id", "digest"])
    grown = stored(trees(placed, "part", arity=arity, depth=depth), "witnesses")
    subroots = grown.where("pos = 0").select(F.lit("").alias("all"), F.col("part").alias("name"), F.col("top").alias("digest"))
    top = trees(numbered(subroots, "all", ["name"]), "all", arity=arity, depth=depth)
    top = top.select(F.col("name").alias("part"), F.col("witness").alias("higher"), F.col("top").alias("root"))
    return grown.join(top, "part").select(
        *leaves.columns, F.col("top").alias("subroot"), "root", F.concat("witness", "higher").alias("witness")
    )


def hex_text(c) -> Column:
    return F.lower(F.hex(c))


def folded(leaf: Column, witness) -> Column:
    """The root that a leaf (hex text) and a witness lead to."""
    return F.aggregate(
        witness, leaf, lambda acc, level: F.sha2(F.concat(hex_text(level["left"]), acc, hex_text(level["right"])), 256)
    )


def proof(witness) -> Column:
    """The hash of all siblings of a witness, from the leaf up, left to right."""
    texts = F.transform(witness, lambda level: hex_text(F.concat(level["left"], level["right"])))
    return F.sha2(F.array_join(texts, ""), 256)


def group_text(c: str) -> Column:
    """A group as text that keeps its order in bytes; null is first."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document's leaf, roots and proof, and whether its text, line breaks gone in half of them, still verifies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    told = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(told, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select(
        group_text("source").alias("part"),
        "doc_id",
        leaf_hash(*[F.col(c) for c in FIELDS]).alias("digest"),
        leaf_hash(*[F.col(c) for c in FIELDS[:-1]], text).alias("found"),
    )
    grown = manifest(stored(leaves, "leaves"))
    told_root = folded(hex_text("found"), "witness")
    return grown.select(
        "doc_id",
        hex_text("digest").alias("leaf"),
        hex_text("subroot").alias("subroot"),
        hex_text("root").alias("root"),
        proof("witness").alias("proof_sha256"),
        told_root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of an integer's decimal digits, the check of the same name in zlib; `{0}` is the integer.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda r, b: xor(r >> 8, crc_table.t[CAST(xor(r & 255, b) AS INTEGER) + 1])))"""

SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, x: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY n) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n) q),
docs AS (
    SELECT doc_id, coalesce('=' || source, '') AS part,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS whole,
        CASE WHEN coalesce({CRC32.format("doc_id")} % 2 = 0, FALSE) THEN replace(text, chr(10), '') ELSE text END AS told
    FROM documents, crc_table),
leaves AS (
    SELECT doc_id, part, sha256(head || whole) AS leaf,
        sha256(head || coalesce(strlen(told) || ':' || told, '-')) AS told_leaf,
        row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST) - 1 AS pos
    FROM docs),
nodes AS (
    SELECT 0 AS level, part, pos, leaf AS h FROM leaves
    UNION ALL
    SELECT level + 1, part, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM nodes) q WHERE n > 1 GROUP BY level, part, pos // 3),
subroots AS (
    SELECT part, h, row_number() OVER (ORDER BY encode(part)) - 1 AS pos, max_level
    FROM (SELECT *, max(level) OVER (PARTITION BY part) AS max_level FROM nodes) q WHERE level = max_level),
tops AS (
    SELECT 0 AS level, pos, h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) q WHERE n > 1 GROUP BY level, pos // 3),
sides AS (
    SELECT a.level, a.part, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
    FROM nodes a JOIN subroots s ON s.part = a.part AND a.level < s.max_level
    JOIN nodes b ON b.level = a.level AND b.part = a.part AND b.pos // 3 = a.pos // 3 GROUP BY ALL),
top_sides AS (
    SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
    FROM tops a JOIN tops b ON b.level = a.level AND b.pos // 3 = a.pos // 3
    WHERE a.level < (SELECT max(level) FROM tops) GROUP BY ALL),
steps AS (
    SELECT doc_id, level, l, r FROM leaves JOIN sides ON sides.part = leaves.part AND sides.pos = leaves.pos // CAST(pow(3, level) AS BIGINT)
    UNION ALL
    SELECT doc_id, s.max_level + t.level, t.l, t.r FROM leaves JOIN subroots s ON s.part = leaves.part
    JOIN top_sides t ON t.pos = s.pos // CAST(pow(3, t.level) AS BIGINT)),
fold AS (
    SELECT doc_id, told_leaf AS h, 0 AS level FROM leaves
    UNION ALL
    SELECT fold.doc_id, sha256(steps.l || fold.h || steps.r), fold.level + 1
    FROM fold JOIN steps ON steps.doc_id = fold.doc_id AND steps.level = fold.level),
proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, count(*) AS n FROM steps GROUP BY doc_id)
SELECT leaves.doc_id, leaf, subroots.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
    fold.h AS folded_root, fold.h = root.h AS verified
FROM leaves JOIN subroots ON subroots.part = leaves.part
CROSS JOIN (SELECT h FROM tops WHERE level = (SELECT max(level) FROM tops)) root
LEFT JOIN proofs ON proofs.doc_id = leaves.doc_id
JOIN fold ON fold.doc_id = leaves.doc_id AND fold.level = coalesce(proofs.n, 0)"""
