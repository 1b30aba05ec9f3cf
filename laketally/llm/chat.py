"""Chat formatting into budgeted windows of whole turns.

Turns are taken in order into a window while system turn, history and new turns
stay within the budget. Each window repeats the system turn that opens the
conversation, and the turns that began within `history` tokens before it, or as
many as there is room for. Repeated turns are marked as such and never under the
loss mask, so each assistant text is a target once.

A turn is `<role>text</s>`, a repeated one `<=role>text</s>`. A turn above half
the budget becomes parts: the first is written as a turn, the others as `<[role>text</s>` (`<=[role>` if repeated), and all of them are targets
if it is one. Of an opening system turn in parts, only the first is repeated. In roles and texts the characters & < > [ = are written as `&...;`,
so no control string of a text survives, and reading back is exact.

Tokens are those of the tokenizer for what is written: for head, escaped text and
end of each turn, each encoded on its own. Roles are not split: a turn whose role
takes more than a quarter of the budget is not cut either and may exceed it, alone
but for an opening system turn.

A conversation may hold any share of the rows: running sums are taken in blocks
of `BLOCK` turns by their place, windows are bounded by their tokens and end with
their block, and the digests join windows in two steps.

Nulls and odd rows: a null text or role is empty, and its turn stays. Turns
with equal numbers go by role, then text; null turns come first. Rows with a
null conv_id form one conversation. Repeated rows are turns of their own. An
empty table gives an empty result; columns besides the four are not read.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketally.llm import packing
from laketally.llm.merkle import numbered
from laketally.plans.scratch import stored

BUDGET = 1024
HISTORY = 256
#: Turns of a conversation whose windows are chosen by one task; a window also ends with them.
BLOCK = 4096
#: Characters with a meaning in the template, and how they are written in texts; the first must stay first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&#91;"), ("=", "&#61;"))


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _escaped(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


PIECES = "array<struct<part:long,text:string,tokens:long,skip:long>>"
_PIECES = pa.list_(pa.struct([("part", pa.int64()), ("text", pa.string()), ("tokens", pa.int64()), ("skip", pa.int64())]))


def _cut(texts: list[str], rooms: list[int | None], count) -> list[list[tuple[str, int]]]:
    """Each text in parts of at most its room, with their tokens; halved level by level, all texts together."""
    parts = [[(t, n)] for t, n in zip(texts, count([_escaped(t) for t in texts]), strict=True)]
    over = range(len(texts))
    while True:
        long = [(i, k) for i in over for k, (t, n) in enumerate(parts[i]) if rooms[i] is not None and n > rooms[i] and len(t) > 1]
        if not long:
            return parts
        halves = []
        for i, k in long:
            text = parts[i][k][0]
            halves += [text[: len(text) // 2], text[len(text) // 2 :]]
        sizes = count([_escaped(h) for h in halves])
        pairs = list(zip(halves, sizes, strict=True))
        for at in range(len(long) - 1, -1, -1):  # from the end, so that places hold
            i, k = long[at]
            parts[i][k : k + 1] = pairs[2 * at : 2 * at + 2]
        over = sorted({i for i, _ in long})


def pieces(turns: DataFrame, budget: int) -> DataFrame:
    """The turns with `pieces`: one without text, or the parts of a turn above half the budget; and the tokens of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = packing.encoder(packing.TOKENIZER)
        count = lambda texts: [len(ids) // 4 for ids in encoder.encode(texts)]
        around: dict[str, int] = {}
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            for role in set(roles) - around.keys():
                around[role] = max(count([f"<{mark}{_escaped(role)}>" for mark in ("", "=", "[", "=[")])) + count(["</s>"])[0]
            rooms = [budget // 2 - around[r] if around[r] <= budget // 4 else None for r in roles]
            found = []
            for role, some in zip(roles, _cut(texts, rooms, count), strict=True):
                skip, told = 0, []
                for text, n in some:
                    told.append({"part": len(told), "text": text, "tokens": n + around[role], "skip": skip})
                    skip += n + around[role]
                if len(told) == 1:
                    told[0]["text"] = None
                found.append(told)
            total = pa.array([f[-1]["skip"] + f[-1]["tokens"] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _PIECES), total], [*batch.schema.names, "pieces", "tokens"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema)
    return turns.mapInArrow(run, f"{kinds}, pieces {PIECES}, tokens long")


def _conv(one: DataFrame, other: DataFrame) -> Column:
    return one["conv_id"].eqNullSafe(other["conv_id"])


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (the token at which its new turns begin), formatted, loss (spans of code points), tokens."""
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = stored(pieces(turns, budget), "turns")
    # Blocks are of places, whatever the turns' numbers are; a conversation of any size is spread.
    keyed = turns.withColumns({"key": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "head": F.left("text", F.lit(32))})
    turns = numbered(keyed, "key", ["turn", "role", "head", "text"], spread=["turn", "role", "head"]).drop("key", "head", "total")
    turns = turns.withColumn("block", F.floor(F.col("pos") / BLOCK))
    in_block = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sized = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized.select("conv_id", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    counted = turns.select("*", F.coalesce(F.sum("tokens").over(in_block), F.lit(0)).alias("at_block"))
    same = _conv(counted, offsets) & (counted["block"] == offsets["block"])
    placed = counted.join(offsets, same).select(
        counted["conv_id"], counted["block"], "role", "text", (F.col("offset") + F.col("at_block")).alias("begin"), F.explode("pieces").alias("piece")
    )
    placed = placed.select(
        "conv_id", "block", "role", F.coalesce("piece.text", "text").alias("text"), "piece.part", "piece.tokens", (F.col("begin") + F.col("piece.skip")).alias("at")
    )
    placed = stored(placed, "placed")
    opening = placed.where((F.col("at") == 0) & (F.lower("role") == "system"))

    # Windows of a block: as many pieces as leave room for the opening and the history.
    sizes = placed.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("at", "tokens"))).alias("sizes"))
    said = opening.select("conv_id", F.col("tokens").alias("opening"))
    sizes = sizes.join(said, _conv(sizes, said), "left").select(sizes["conv_id"], "sizes", F.coalesce("opening", F.lit(0)).alias("opening"))
    long = lambda n: F.lit(n).cast("long")
    state = F.struct(long(-1).alias("begin"), long(-1).alias("end"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("out"))
    closed = lambda done: F.concat(done.out, F.array(F.struct(done.begin.alias("begin"), done.end.alias("end"))))

    def add(done, x):
        end = x.at + x.tokens
        fits = (done.begin >= 0) & (end - done.begin <= F.lit(budget - history) - F.col("opening"))
        out = F.when(fits | (done.begin < 0), done.out).otherwise(closed(done))
        return F.struct(F.when(fits, done.begin).otherwise(x.at).alias("begin"), end.alias("end"), out.alias("out"))

    cuts = sizes.select("conv_id", "opening", F.explode(F.aggregate("sizes", state, add, closed)).alias("cut")).select("conv_id", "opening", "cut.begin", "cut.end")
    seen = F.greatest(long(0), F.least(F.lit(history), F.lit(budget) - F.col("opening") - (F.col("end") - F.col("begin"))))
    cuts = cuts.select("conv_id", F.col("begin").alias("window"), F.greatest(long(0), F.col("begin") - seen).alias("since"), "end")
    reach = cuts.select("*", F.explode(F.sequence(F.floor(F.col("since") / budget), F.floor((F.col("end") - 1) / budget))).alias("near"))
    by_place = placed.select("*", F.floor(F.col("at") / budget).alias("of"))
    inside = _conv(by_place, reach) & (by_place["of"] == reach["near"]) & (by_place["at"] >= reach["since"]) & (by_place["at"] < reach["end"])
    columns = ["window", "at", "role", "text", "part", "tokens"]
    dealt = by_place.join(reach, inside).select(by_place["conv_id"], *columns)
    dealt = dealt.unionByName(opening.join(cuts, _conv(opening, cuts)).where("since > 0").select(opening["conv_id"], *columns))
    piece = F.struct("at", "role", "text", (F.col("at") < F.col("window")).alias("seen"), "part", "tokens")
    packed = dealt.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    mark = lambda p: F.concat(F.when(p.seen, F.lit("<=")).otherwise(F.lit("<")), F.when(p.part > 0, F.lit("[")).otherwise(F.lit("")))
    head = lambda p: F.concat(mark(p), escaped(p.role), F.lit(">"))
    body = lambda p: escaped(p.text)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def spanned(done, p):
        start = done.at + F.length(head(p))
        end = start + F.length(body(p))
        target = ~p.seen & (F.lower(p.role) == "assistant")
        spans = F.when(target, F.concat(done.spans, F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(done.spans)
        return F.struct((end + 4).alias("at"), spans.alias("spans"))

    return packed.select(
        "conv_id",
        "window",
        F.array_join(F.transform("pieces", lambda p: F.concat(head(p), body(p), F.lit("</s>"))), "").alias("formatted"),
        F.aggregate("pieces", empty, spanned, lambda done: done.spans).alias("loss"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p.tokens).alias("tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows say: turns, targets under the mask, and characters."""
    turns = F.filter(F.split("formatted", "</s>", -1), lambda t: ~t.startswith("<=") & (t != ""))
    first = lambda t: ~t.startswith("<[")
    role = lambda t: F.regexp_extract(t, "^<([^<>]*)>", 1)
    text = lambda t: F.substring_index(t, ">", -1)
    begun = lambda t: F.when(first(t), F.concat(F.lit("\n"), unescaped(role(t)), F.lit("\n"))).otherwise(F.lit(""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(begun(t), unescaped(text(t)))), "")
    loss = F.array_join(F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s.start + 1, s.end - s.start))), "")
    rows = formatted.select("*", turns.alias("turns")).select(
        "conv_id", "window", F.size(F.filter("turns", first)).cast("long").alias("n"), said.alias("said"), loss.alias("loss"), F.length("formatted").cast("long").alias("chars")
    )
    for step in (64, None):  # many windows of a conversation meet in two steps
        keys = ["conv_id"] if step is None else ["conv_id", F.floor(F.col("window") / (step * BUDGET)).alias("part")]
        joined = F.array_sort(F.collect_list(F.struct("window", "said", "loss")))
        rows = rows.groupBy(*keys).agg(joined.alias("parts"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        rows = rows.select(
            "conv_id",
            (F.lit(0) if step is None else F.col("part")).alias("window"),
            "n",
            F.array_join("parts.said", "").alias("said"),
            F.array_join("parts.loss", "").alias("loss"),
            "chars",
        )
    return rows.select(
        "conv_id",
        F.col("n").alias("n_turns"),
        F.sha2(F.concat(F.expr("substring(said, 2)"), F.lit("\n")), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


OKAY = "</s>[INST] ok [/INST]"


def query(spark, sf_dir: str) -> DataFrame:
    """op9: all conversations and one whose texts hold control strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", OKAY), (-1, 1, "assistant", OKAY)], turns.schema)
    return read_back(windows(turns.unionByName(extra)))
