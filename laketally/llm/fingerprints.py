"""Document fingerprints by Order MinHash, in DataFrame functions alone.

A text's k-mers (k code points) are numbered by occurrence. Each numbered k-mer
has a hash, whose remainder puts it into one of `BINS` bins; of each bin the
`TUPLE` least are taken, put back into the order of the text, and hashed as a
tuple. Two fingerprints are as alike as the share of equal tuples among the bins
that either fills. So not only which k-mers two texts share counts, but also
their order, as in edit distance.

All k-mers of a text take part, whatever its length. Those whose hash occurs again
are numbered; the first half of an edited text takes over its document's k-mers.

The edited text of a document takes its end from the next document. Neighbours
come from the ids alone: a running order within ranges of ids, and one row a
range for the steps between them.

Nulls and odd rows: a null text is empty, and empty texts have one fingerprint
of empty bins; two of them are alike (1). A text shorter than k is one k-mer.
Rows with equal doc_id share their next document; of several texts of that one,
the least counts. A null doc_id has no next document: an empty text stands in.
A single document is its own next. An empty table gives an empty result.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketally.plans.scratch import stored

K = 8
BIN_BITS = 5
BINS = 1 << BIN_BITS
TUPLE = 2
#: About so many of a longer text's numbered k-mers are looked at first.
FEW = 448
#: Bits of a place in a key, 31 in longer texts. Two k-mers of one text that agree in all other bits of their numbers
#: are taken for one by the count of occurrences, in a text of n of them with a chance of some n ** 2 in 2 ** 45.
PLACE_BITS = 20
#: Bits of a candidate's place among candidates; where there are more, all are sorted by their whole numbers.
RANK_BITS = 12


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), which is worked out once however often `of` names it."""
    return F.transform(F.array(value), of)[0]


def _places(length: Column) -> Column:
    """0 .. length - 1."""
    return F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(F.array().cast("array<int>"))


def _kmers(text: Column) -> Column:
    """The hash of every k-mer, by place; none where the text is shorter than k."""
    # Bytes are cut at any place at once; a text is looked through from its start.
    data = F.to_binary(text, F.lit("utf-8"))
    plain = lambda b, n: F.transform(F.sequence(F.lit(1), n - K + 1), lambda i: F.xxhash64(F.substring(b, i, F.lit(K))))

    def by_starts(b: Column, at: Column) -> Column:
        kmer = lambda i: F.substring(b, F.get(at, i) + 1, F.get(at, i + K) - F.get(at, i))
        return F.transform(_places(F.size(at) - K), lambda i: F.xxhash64(kmer(i)))

    def found(b: Column) -> Column:
        several = F.octet_length(text) > F.length(text)
        some = F.when(several, _let(_starts(b), lambda at: by_starts(b, at))).otherwise(plain(b, F.octet_length(text)))
        return F.when(F.length(text) >= K, some).otherwise(F.array().cast("array<bigint>"))

    return _let(data, found)


def _starts(data: Column) -> Column:
    """Where each code point of UTF-8 bytes begins, and where the last one ends."""
    more = lambda i: F.substring(data, i + 1, F.lit(1)).between(F.lit(b"\x80"), F.lit(b"\xbf"))
    return F.filter(F.sequence(F.lit(0), F.octet_length(data)), lambda i: ~more(i))


def _whole(text: Column) -> Column:
    """The hashes of a text shorter than k: itself, or none."""
    return F.when(F.length(text) > 0, F.array(F.xxhash64(text))).otherwise(F.array().cast("array<bigint>"))


def hashed(docs: DataFrame, text: str, into: str) -> DataFrame:
    """The rows with a column `into`: the hashes of the text's k-mers, by place."""
    return docs.withColumn(into, F.when(F.length(text) >= K, _kmers(F.col(text))).otherwise(_whole(F.col(text))))


def hashed_edit(docs: DataFrame, text: str, hashes: str, edit: str, into: str) -> DataFrame:
    """The rows with the hashes of the edited text's k-mers; those that lie in what is left of the text are taken over."""
    kept = F.length(text) - F.floor(F.length(text) / 2).cast("int")
    own = F.greatest(kept - K + 1, F.lit(0))
    rest = _kmers(F.substring(F.col(edit), own + 1, F.length(edit)))
    return docs.withColumn(into, F.when(F.length(edit) >= K, F.concat(F.slice(hashes, F.lit(1), own), rest)).otherwise(_whole(F.col(edit))))


def _by_bits(n: Column, of: Callable[[int], Column]) -> Column:
    """of(the bits of a place) in a text of n k-mers."""
    return F.when(n <= 1 << PLACE_BITS, of(PLACE_BITS)).otherwise(of(31))


def _ordered(hashes: Column) -> Column:
    """A key of every k-mer, sorted: the upper bits of its number as a first occurrence, and below them its place."""
    key = lambda h, i, bits: F.xxhash64(h, F.lit(0)).bitwiseAND(F.lit(-(1 << bits))).bitwiseOR(i)
    return F.sort_array(_by_bits(F.size(hashes), lambda bits: F.transform(hashes, lambda h, i: key(h, i, bits))))


def _repeated(ordered: Column, key: Column, p: Column, bits: int) -> Column:
    """Whether the key's k-mer occurs before; null for the first key."""
    return F.get(ordered, p - 1) >= key.bitwiseAND(F.lit(-(1 << bits)))


def _place(key: Column, bits: int) -> Column:
    return key.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _repeats(ordered: Column) -> Column:
    """The keys of every occurrence but the first."""
    again = lambda s, bits: F.filter(s, lambda x, p: _repeated(s, x, p, bits))
    return _let(ordered, lambda s: _by_bits(F.size(s), lambda bits: again(s, bits)))


def _later(hashes: Column, repeats: Column, most: Column, bits: int) -> Column:
    """(g, i) of every occurrence but the first, of numbers up to `most`."""

    def run(s: Column, begins: Column, p: Column, r: Column) -> Column:
        end = F.coalesce(F.get(begins, r + 1), F.size(s))

        def few(h: Column) -> Column:
            nth = F.filter(F.sequence(F.lit(1), end - p), lambda q: F.xxhash64(h, q) <= most)
            return F.transform(nth, lambda q: F.struct(F.xxhash64(h, q).alias("g"), _place(F.get(s, p + q - 1), bits).alias("i")))

        return _let(F.get(hashes, _place(F.get(s, p), bits)), few)

    begins = F.filter(_places(F.size(repeats)), lambda p: ~F.coalesce(_repeated(repeats, F.get(repeats, p), p, bits), F.lit(False)))
    return _let(begins, lambda b: F.flatten(F.transform(b, lambda p, r: run(repeats, b, p, r))))


def _candidates(hashes: Column, ordered: Column, repeats: Column, most: Column) -> Column:
    """(g, i) of the k-mers of numbers g up to `most`, with their places."""

    def found(o: Column, r: Column, h: Column, most: Column, bits: int) -> Column:
        # Mostly the first keys hold all that are wanted.
        head = F.when(F.get(o, F.lit(2 * FEW)) > most, F.slice(o, F.lit(1), F.lit(2 * FEW))).otherwise(o)
        firsts = _let(head, lambda k: F.filter(k, lambda x, p: (x <= most) & ~F.coalesce(_repeated(k, x, p, bits), F.lit(False))))
        number = lambda x: F.xxhash64(F.get(h, _place(x, bits)), F.lit(0))
        named = F.transform(firsts, lambda x: F.struct(number(x).alias("g"), _place(x, bits).alias("i")))
        return F.concat(named, _later(h, r, most, bits))

    def of(bits: int) -> Column:
        return _let(ordered, lambda o: _let(repeats, lambda r: _let(hashes, lambda h: _let(most, lambda m: found(o, r, h, m, bits)))))

    return _by_bits(F.size(hashes), of)


def _bin(g: Column) -> Column:
    return g.bitwiseAND(F.lit(BINS - 1))


def _rank(candidates: Column) -> Column:
    """A key of every candidate, sorted by bin and number: its bin, the upper bits of its number, and where it stands."""
    number = lambda g: F.shiftrightunsigned(g.bitwiseXOR(F.lit(-(2**63))), BIN_BITS).bitwiseAND(F.lit(-(1 << RANK_BITS)))
    key = lambda g, p: F.shiftleft(g.bitwiseXOR(F.lit(BINS // 2)), 64 - BIN_BITS).bitwiseOR(number(g)).bitwiseOR(p)
    return F.sort_array(F.transform(candidates, lambda x, p: key(x.g, p)))


def _least_ranked(candidates: Column, rank: Column) -> Column:
    """The TUPLE least of every bin, by bin."""
    own = lambda key: F.shiftright(key, 64 - BIN_BITS)
    least = _let(rank, lambda s: F.filter(s, lambda x, p: (p < TUPLE) | (own(F.get(s, p - TUPLE)) != own(x))))
    return _let(candidates, lambda c: F.transform(least, lambda x: F.get(c, _place(x, RANK_BITS))))


def _least(candidates: Column) -> Column:
    """The same of any number of candidates."""
    ordered = F.sort_array(F.transform(candidates, lambda x: F.struct(_bin(x.g).alias("b"), x.g.alias("g"), x.i.alias("i"))))
    least = _let(ordered, lambda s: F.filter(s, lambda x, p: (p < TUPLE) | (F.get(s, p - TUPLE).b != x.b)))
    return F.transform(least, lambda x: F.struct(x.g.alias("g"), x.i.alias("i")))


def _bins(taken: Column) -> Column:
    """One hash a bin, of the bin's (g) in the order of the text; null for an empty bin."""

    def in_bin(j: Column) -> Column:
        full = F.size(taken) == BINS * TUPLE
        some = F.when(full, F.slice(taken, j * TUPLE + 1, F.lit(TUPLE))).otherwise(F.filter(taken, lambda x: _bin(x.g) == j))
        ordered = lambda s: F.sort_array(F.transform(s, lambda x: F.struct(x.i.alias("i"), x.g.alias("g"))))
        return _let(some, lambda s: F.when(F.size(s) > 0, F.xxhash64(F.transform(ordered(s), lambda x: x.g))))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), in_bin)


def binned(docs: DataFrame, hashes: str, into: str) -> DataFrame:
    """The rows with a column `into`: an array of one hash a bin, null for an empty bin.

    Each step is a column of its own, so that compiled code sorts what is sorted, as plain numbers: keys, where a
    repeat stands next to its like, and ranks of candidates. Only hashes that occur again are numbered.
    """
    ordered, repeats, some, rank, taken = (f"{into} {name}" for name in ("ordered", "repeats", "some", "rank", "taken"))
    h, o, r, s, k = F.col(hashes), F.col(ordered), F.col(repeats), F.col(some), F.col(rank)
    # The least of a bin are among the least of all: if FEW of these give every bin its TUPLE, they are the same.
    every = F.lit(2**63 - 1)
    below = lambda bits: ((FEW / F.size(h) - 0.5) * 2.0**64).cast("bigint").bitwiseAND(F.lit(-(1 << bits))) - 1
    few = F.when(F.size(h) > FEW, _by_bits(F.size(h), below)).otherwise(every)
    rows = docs.withColumn(ordered, _ordered(h)).withColumn(repeats, _repeats(o)).withColumn(some, _candidates(h, o, r, few))
    rows = rows.withColumn(rank, _rank(s)).withColumn(taken, F.when(F.size(k) <= 1 << RANK_BITS, _least_ranked(s, k)))
    enough = (F.size(taken) == BINS * TUPLE) | ((F.size(h) <= FEW) & F.col(taken).isNotNull())
    whole = F.when(enough, F.col(taken)).otherwise(_least(_candidates(h, o, r, every)))
    return rows.withColumn(into, _let(whole, _bins)).drop(ordered, repeats, some, rank, taken)


def sketched(docs: DataFrame, text: str, into: str) -> DataFrame:
    """The rows with a column `into`: an array of one hash a bin of the text, null for an empty bin."""
    hashes = f"{into} hashes"
    return binned(hashed(docs, text, hashes), hashes, into).drop(hashes)


def alike(one: str, other: str) -> Column:
    """The share of equal bins among those that either fills; 1 where neither fills any."""
    pairs = F.zip_with(one, other, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    filled = F.filter(pairs, lambda p: p.a.isNotNull() | p.b.isNotNull())
    equal = F.size(F.filter(filled, lambda p: p.a == p.b))
    return F.when(F.size(filled) == 0, F.lit(1.0)).otherwise(equal / F.size(filled))


def written(bins: str) -> Column:
    return F.array_join(F.transform(bins, lambda b: F.coalesce(F.lpad(F.hex(b), 16, "0"), F.lit("-"))), "")


def next_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, half): the next smaller id, for the smallest the largest; half of the longest text of the id."""
    sizes = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.floor(F.max(F.length("text")) / 2).cast("int").alias("half"))
    ids = stored(sizes.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ids")
    ranges = ids.groupBy("range").agg(F.max("doc_id").alias("largest"))
    over_ranges = Window.orderBy("range")  # one row a range
    ranges = ranges.select("range", F.lag("largest").over(over_ranges).alias("below"), F.max("largest").over(Window.partitionBy()).alias("top"))
    within = Window.partitionBy("range").orderBy("doc_id")
    found = ids.withColumn("before", F.lag("doc_id").over(within)).join(F.broadcast(ranges), "range")  # one row a range
    return stored(found.select("doc_id", F.coalesce("before", "below", "top").alias("next_id"), "half"), "next")


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_id, edited: the last half of each text replaced by the start of the next document."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = docs.where("doc_id IS NOT NULL")  # both joins take it by doc_id, so texts are shuffled once
    nexts = next_ids(docs)
    wanted = nexts.select(F.col("doc_id").alias("of"), "next_id", "half")
    heads = own.join(wanted, own["doc_id"] == wanted["next_id"]).select("of", "next_id", F.left("text", F.col("half")).alias("head"))
    heads = heads.groupBy("of").agg(F.min("head").alias("head"), F.first("next_id").alias("next_id"))
    full = own.join(heads, own["doc_id"] == heads["of"], "left").select("doc_id", "text", "next_id", "head")
    unnamed = docs.where("doc_id IS NULL").withColumn("next_id", F.col("doc_id")).withColumn("head", F.lit(None).cast("string"))
    full = full.unionByName(unnamed)
    half = F.floor(F.length("text") / 2).cast("int")
    end = F.left(F.coalesce("head", F.lit("")), half)
    return full.select("doc_id", "text", "next_id", F.concat(F.left("text", F.length("text") - half), end).alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document with the bins of its text, its edited text and the next document's."""
    rows = hashed_edit(hashed(edited(docs), "text", "hashes"), "text", "hashes", "edited", "edited_hashes")
    rows = binned(binned(rows, "hashes", "bins"), "edited_hashes", "edited_bins")
    rows = stored(
        rows.select("doc_id", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "bins", "edited_bins"), "bins"
    )
    other = rows.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("next_id")).agg(F.min("bins").alias("next_bins"))
    found = rows.join(other, "next_id", "left")
    empty = F.array_repeat(F.lit(None).cast("long"), BINS)
    return found.withColumn("next_bins", F.coalesce("next_bins", empty))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: fingerprints of all documents and of their edited texts."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written("bins").alias("fingerprint"),
        written("edited_bins").alias("edited_fingerprint"),
        alike("bins", "edited_bins").alias("near_edited"),
        alike("bins", "next_bins").alias("near_next"),
    )
