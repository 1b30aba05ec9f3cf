"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts are sets of word shingles; two link when their Jaccard similarity reaches
a threshold, given as a ratio of whole numbers so that it is exact. Equal sets
form one class and are joined once. Each class's shingles are ordered by how
common they are, the rarest first. Two linked sets of n and m shingles share at
least L of the first n - ceil(t n) + L and m - ceil(t m) + L. Every class
picks its own L, from 1 to `LONGEST`, by the least estimated cost: the
occurrences it has to look up plus the candidates it has to verify. Candidates
sharing fewer than L prefix shingles are dropped before verification. Where two
sets meet, the sizes of both tell how many shingles a link must share, so only
the first n - that + L and m - that + L count.

How common a shingle is comes from a sketch of counters over all documents, of
a fixed size; a rough count costs time, never a link.

A group of many near copies shares its prefixes. So links are first sought
between each member of a prefix list and single members of it (up to `STARS` times:
first the one that shares most with others, then other ones each time, `CENTRES`
of them among the lists of a group), and linked classes become one component;
lists of two sets that cannot link are dropped. The adaptive join then covers every pair of different components. No
link between components can be lost, and within one there is nothing left to find.

Nulls and odd rows: a null text or one without words has no shingles, links
with nothing and is its own component. Repeated rows come back as often as they
went in. A null doc_id is kept; its component is the smallest doc_id of the
others it is linked with, or null. An empty table gives an empty result.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from laketally.llm import text as T
from laketally.plans.scratch import discard, stored

LONGEST = 4
STARS = 3
#: So many members of a group are single ones at a time: its lists are dealt among them.
CENTRES = 4
SKETCH_BITS = 20
SKETCH_PARTS = 64
MAP_BITS = 256
MAP = [f"map{i}" for i in range(MAP_BITS // 64)]
#: No further star once one has found no more than one in FEW of all links so far.
FEW = 10
#: A class of more than one in HOT documents is joined by broadcast: there are fewer than HOT of them.
HOT = 1000


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    return T.shingles(*T.words(column), k)


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counters of shingles by the top bits of their hash, over all documents."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                for found in _sets(part.column("text"), k):
                    np.add.at(total, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        parts = [p.tobytes() for p in total.reshape(SKETCH_PARTS, width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    dealt = docs.select("text").mapInArrow(count, schema).repartition(SKETCH_PARTS, "part")
    total = np.zeros((SKETCH_PARTS, width), np.int64)
    for row in dealt.mapInArrow(add, schema).collect():  # the sketch: a fixed size
        total[row.part] += np.frombuffer(row.counts, np.int64)
    return total.ravel()


def _named(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return T.mixed(found).sum(dtype=np.uint64).tobytes() + T.mixed(found ^ T.STEP).sum(dtype=np.uint64).tobytes()


def named(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, set_id, n_shingles) of every row; set_id is null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                found = _sets(part.column("text"), k)
                names = pa.array([_named(s) if len(s) else None for s in found], pa.binary())
                sizes = pa.array([len(s) for s in found], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), names, sizes], ["doc_id", "set_id", "n_shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, set_id binary, n_shingles long")


def _prefix(found: np.ndarray, counts: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, int]:
    """A set's longest prefix, and its own L."""
    n = len(found)
    need = -(-part * n // whole)
    common = counts[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.lexsort((found, common))[: n - need + LONGEST]
    lookups = np.cumsum(common[order])
    least, own = None, 1
    for length in range(1, min(LONGEST, need) + 1):
        seen = lookups[min(n - need + length, len(lookups)) - 1]
        cost = seen + n / 8 * seen / length**2
        if least is None or cost < least:
            least, own = cost, length
    return found[order], own


def _map(found: np.ndarray) -> np.ndarray:
    """The parity map as MAP_BITS / 64 numbers."""
    odd = np.bincount((found & np.uint64(MAP_BITS - 1)).astype(np.int64), minlength=MAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefixed(docs: DataFrame, counts: np.ndarray, k: int, part: int, whole: int) -> DataFrame:
    """(doc_id, set_id, n, prefix, own, the parity map) of every document with shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # the sketch: a fixed size
    names = ["doc_id", "set_id", "n", "prefix", "own", *MAP]
    kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64(), *[pa.int64()] * len(MAP)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.slices(batch, most=T.SMALL_BYTES):
                rows, where = [], []
                for d, found in enumerate(_sets(piece.column("text"), k)):
                    if len(found):
                        first, own = _prefix(found, shared.value, part, whole)
                        rows.append((_named(found), len(found), first.view(np.int64), own, *_map(found).tolist()))
                        where.append(d)
                if rows:
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    ids = piece.column("doc_id").take(pa.array(where, pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    maps = "".join(f", {m} long" for m in MAP)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, set_id binary, n long, prefix array<long>, own long{maps}")


def whole_sets(docs: DataFrame, k: int) -> DataFrame:
    """(set_id, items) of every document with shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.slices(batch, most=T.SMALL_BYTES):
                found = [s for s in _sets(piece.column("text"), k) if len(s)]
                items = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([_named(s) for s in found], pa.binary()), items], ["set_id", "items"])

    return docs.select("text").mapInArrow(run, "set_id binary, items array<long>")


def _of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids of the column `first`."""
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["first"]), "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """Of stored pairs (a, b) of set ids those that link, by the sizes of intersection and union.

    Only the texts of candidates are taken up again.
    """
    ends = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    firsts = stored(classes.join(ends, "set_id", "left_semi").select("first"), "firsts")
    sets = whole_sets(_of(docs, firsts), k)
    one = sets.select(F.col("set_id").alias("a"), F.col("items").alias("items_a"))
    other = sets.select(F.col("set_id").alias("b"), F.col("items").alias("items_b"))
    shared = F.size(F.array_intersect("items_a", "items_b"))
    linked = shared * whole >= (F.size("items_a") + F.size("items_b") - shared) * part
    found = stored(pairs.join(other, "b").join(one, "a").where(linked).select("a", "b").distinct(), "links")
    discard(firsts)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(set_id, root) of all ends of the edges, by alternating large and small stars."""
    before = None
    edges = stored(edges.select("a", "b"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large")  # every edge has its larger end first
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        used = edges
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(used, large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("set_id"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("set_id"), F.col("b").alias("root"))
            ).distinct()
        before = now


def _alike(one: Callable[[str], Column], other: Callable[[str], Column], part: int, whole: int) -> Column:
    """Whether two sets can link, by their sizes and the parity maps' bound of their difference."""
    differ = sum((F.bit_count(one(m).bitwiseXOR(other(m))) for m in MAP), F.lit(0))
    sizes = F.least(one("n"), other("n")) * whole >= F.greatest(one("n"), other("n")) * part
    return sizes & (differ * (whole + part) <= (one("n") + other("n")) * (whole - part))


def _early(part: int, whole: int) -> Column:
    """Whether a shingle is among the first of both sets, `own` of which any two sets of these sizes that link share."""
    least = (F.col("n") + F.col("n_b")) * part  # of a link's shared shingles, times whole + part
    one, other = F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b")
    return (least <= (one - 1 + F.col("own")) * (whole + part)) & (least <= (other - 1 + F.col("own")) * (whole + part))


def _rooted(entries: DataFrame, links: DataFrame, part: int, whole: int) -> DataFrame:
    """The entries of shingles that more than one component has, with their component; not those of two sets that cannot link."""
    roots = components(links)
    rooted = entries.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    mixed = rooted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows")).where("low <> high")
    many = rooted.join(mixed.where("rows > 2").select("shingle"), "shingle")
    both = rooted.join(mixed.where("rows = 2").select("shingle"), "shingle")
    pair = Window.partitionBy("shingle").orderBy("set_id")  # two rows
    one = F.struct("n", *MAP)
    both = both.withColumn("other", F.coalesce(F.lag(one).over(pair), F.lead(one).over(pair)))
    both = both.where(_alike(F.col, lambda c: F.col(f"other.{c}"), part, whole)).drop("other")
    return stored(many.unionByName(both), "rooted")


def links(docs: DataFrame, classes: DataFrame, prefixes: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """Links (a, b) that connect all linked sets; `prefixes` are as of `prefixed`."""
    # What is shuffled of every shingle is small; what belongs to its set comes to the lists that are left. Two sets of one name only add entries.
    sets = prefixes.select("set_id", "n", "own", *MAP).dropDuplicates(["set_id"]).withColumn("name", F.xxhash64("set_id"))
    exploded = prefixes.select(F.xxhash64("set_id").alias("name"), F.posexplode("prefix").alias("at", "shingle"))
    lists = stored(exploded.groupBy("shingle").agg(F.count("*").alias("rows")).where("rows > 1"), "lists")
    unneeded = F.col("n") - F.ceil(F.col("n") * part / whole)
    level = F.greatest(F.lit(1), F.col("at") - unneeded + 1).alias("level")
    shares = F.sum(F.log2("rows")).over(Window.partitionBy("name")).alias("shares")  # of one set, at most its prefix
    entries = exploded.join(lists, "shingle").select("name", "at", "shingle", shares).join(sets, "name")
    entries = entries.select("set_id", "n", "own", *MAP, "shingle", level, "at", (F.col("shares") / F.col("n")).alias("shares"))
    entries = stored(entries.withColumn("root", F.col("set_id")), "entries")
    alike = _alike(F.col, lambda c: F.col(f"{c}_b"), part, whole) & _early(part, whole)
    maps_b = [F.col(m).alias(f"{m}_b") for m in MAP]
    found, seen = None, []

    def new_pairs(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        for known in seen:  # STARS tables at most
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        seen.append(stored(pairs, "pairs"))
        return seen[-1]

    for star in range(STARS):
        firsts = entries.where("level = 1")
        first = F.xxhash64("set_id", F.pmod("shingle", F.lit(CENTRES)), F.lit(star)) if star else -F.col("shares")
        rank = F.struct(first, "set_id", "root", "n", "at", *MAP)
        centre = firsts.groupBy("shingle").agg(F.min(rank).alias("c"))
        centre = centre.select("shingle", "c.*").select("shingle", F.col("set_id").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), *maps_b)
        met = firsts.join(centre, "shingle").where("root <> root_a").where(alike)
        pairs = met.groupBy("a", F.col("set_id").alias("b")).agg(F.count("*").alias("met"), F.first("own").alias("own"))
        pairs = pairs.where(F.col("met") >= F.least("own", F.lit(2)))  # by chance most share one shingle; what is left out the last join finds
        new = verified(new_pairs(pairs), docs, classes, k, part, whole)
        found = new if found is None else found.unionByName(new)
        if star and new.count() * FEW <= found.count():  # little is left for stars
            break
        used = entries
        entries = _rooted(entries.drop("root", "shares"), found, part, whole)
        discard(used)
    discard(lists)
    names = {"set_id": "b", "n": "n_b", "root": "root_b", "level": "level_b", "at": "at_b"}
    index = entries.select("shingle", *(F.col(old).alias(new) for old, new in names.items()), *maps_b)
    met = entries.where("level <= own").join(index, "shingle").where("level_b <= own AND set_id > b AND root <> root_b").where(alike)
    pairs = met.groupBy(F.col("set_id").alias("a"), "b").agg(F.count("*").alias("met"), F.first("own").alias("own")).where("met >= own")
    last = verified(new_pairs(pairs), docs, classes, k, part, whole)
    discard(entries, *seen)
    return found.unionByName(last)


def rooted_rows(docs: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """(doc_id, set_id, n_shingles, root, component_id) of every row; links are at part / whole or more. A root is one set of the component."""
    T.small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    members = stored(named(docs, k), "members")
    classes = stored(members.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "classes")
    firsts = classes.select("first")
    prefixes = stored(_of(prefixed(docs, sketch(docs, k), k, part, whole), firsts), "prefixes")
    roots = components(links(docs, classes, prefixes, k, part, whole))
    rooted = classes.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named_classes = stored(rooted.join(least, "root").select("set_id", "rows", "root", "component_id"), "named")
    total = members.count()
    hot = F.broadcast(named_classes.where(F.col("rows") * HOT > total).select("set_id", "root", "component_id"))  # fewer than HOT rows
    rest = named_classes.where(F.col("rows") * HOT <= total).select("set_id", "root", "component_id")
    cold = members.join(hot, "set_id", "left_anti")
    told = members.join(hot, "set_id").unionByName(cold.where("set_id IS NOT NULL").join(rest, "set_id"))
    alone = members.where("set_id IS NULL").withColumn("root", F.lit(None).cast("binary")).withColumn("component_id", F.col("doc_id"))
    return told.unionByName(alone)


def joined(docs: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; links are at part / whole or more."""
    return rooted_rows(docs, k, part, whole).select("doc_id", "n_shingles", "component_id")


def _with_sets(docs: DataFrame, k: int) -> DataFrame:
    """(row, set): every row with all its columns as one, and the set_id of its text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                found = pa.array([_named(s) if len(s) else None for s in _sets(part.column("text"), k)], pa.binary())
                row = pa.StructArray.from_arrays(part.columns, names)
                yield pa.RecordBatch.from_arrays([row, found], ["row", "set"])

    return docs.mapInArrow(run, StructType([StructField("row", docs.schema), StructField("set", BinaryType())]))


def one_of_each(docs: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """Of each component the row with the smallest doc_id, then the smallest set; rows without shingles or without a doc_id; repeated rows once."""
    found = rooted_rows(docs, k, part, whole).where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    keep = found.groupBy("root").agg(F.min(F.struct("doc_id", "set_id")).alias("least")).select("least.doc_id", F.col("least.set_id").alias("set"))
    rows = _with_sets(docs.where("doc_id IS NOT NULL"), k)
    chosen = (rows["row.doc_id"] == keep["doc_id"]) & (rows["set"] == keep["set"])
    kept = rows.join(keep, chosen, "left_semi").unionByName(rows.where("set IS NULL"))
    same = Window.partitionBy("row.doc_id", "set", F.when(F.col("set").isNull(), F.col("row.text"))).orderBy("row.text")
    kept = kept.withColumn("at", F.row_number().over(same)).where("at = 1").select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: components of links at 85 of 100 over sets of four words."""
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85, 100)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, eight of ten."""
    return one_of_each(docs, 5, 8, 10)


#: Distinct shingles of `k` words of a column `text`, one of all words where there are fewer; `{0}` is the table with its id.
SHINGLES = """SELECT id, unnest(list_distinct(CASE WHEN len(w) >= {k}
        THEN list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
    FROM (SELECT {id} AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM {table}) q"""

SQL = f"""
WITH RECURSIVE sets AS ({SHINGLES.format(k=4, id="doc_id", table="documents")}),
sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM sets x JOIN sets y ON x.s = y.s AND x.id <> y.id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes m ON m.id = a JOIN sizes n ON n.id = b WHERE 100 * common >= 85 * (m.n + n.n - common)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, r.least) AS component_id
FROM documents LEFT JOIN sizes ON sizes.id = doc_id LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = doc_id"""
