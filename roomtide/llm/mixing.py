"""Mixing sources to target weights by Pareto order sampling, in DataFrame expressions only.

A document's size is its number of words.  The sources, in code-point order, share all words by
weights that repeat; no target exceeds ``most`` times its source's words, and what is above is
shared again by weight until none is.  A source of S words and target T first takes every document
floor(T / S) whole times.  The rest, a share below one of its words, is a Pareto order sample: a
document with random number U (a keyed hash, so reruns agree) and inclusion probability p ranks by
(U / (1 - U)) / (p / (1 - p)), and the smallest ranks of a stratum are taken, a fixed number of them.

Strata are size classes of a source (single sizes below 64 words, then 32 classes an octave).  From
the largest class down, each gets the number of documents nearest to its share of words, rounded at
random; the words that rounding adds or leaves are handed on to the next smaller class.  So probabilities differ by
stratum, every document's expected share is that of its source, and a source's words come as near
to the target as its smallest documents allow, apart from sizes that differ inside a class.

Scale: the texts are read once, into a staged table of counted (source, id, print, size) rows.  A
source's classes are a bounded number.  A stratum of many documents is cut into ranges of U of
about ``RANGE`` documents, whose counts tell each where its ranks begin, so neither a hot source nor
a hot size meets in one task; equal rows are counted before they are numbered, and numbered in
chunks.

Defined results: null text has size 0; a null source is a source of its own and comes last; documents of
size 0 take nothing; rows equal in id, source and text are interchangeable and are drawn each
by itself; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.runtime import spread, stage

WORD = r"[^\x20\x09-\x0D]+"
RANGE = 1 << 16
WEIGHTS = (5, 2, 1)
MOST = 3


def _of(source: Column) -> Column:
    """Source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def uniform(*parts: Column) -> Column:
    """Random number in [0, 1) from a hash of the parts: 52 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def size_class(size: Column) -> Column:
    """Class of a size, in order of size: the size itself below 64, then 32 classes an octave."""
    shift = F.greatest(F.length(F.bin(size)) - 6, F.lit(0))
    return F.when(size < 64, size).otherwise(shift * 64 + F.call_function("shiftright", size, shift)).cast("long")


def counted(documents: DataFrame) -> DataFrame:
    """of, source, doc_id, print, size, rows: rows equal in all of these, counted; staged."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = documents.select(
        _of(F.col("source")).alias("of"), F.col("source").cast("string").alias("source"), "doc_id",
        F.md5(text.cast("binary")).alias("print"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    return stage(slim.groupBy("of", "source", "doc_id", "print", "size").agg(F.count("*").alias("rows")))


def targets(groups: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """of, source, source_size, weight, target of every source."""
    sizes = groups.groupBy("of", "source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    # Numbered in order without meeting in one task: ranges of sources, then places inside a range.
    ranged = stage(sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    first = parts.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = (F.col("first") + inside - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    weighed = stage(ranged.join(first, F.col("part") == F.col("_part")).select("of", "source", "source_size", weight.alias("weight")))
    rate, known = 0.0, -1
    while True:
        full = F.lit(float(most)) * F.col("source_size") < F.lit(rate) * F.col("weight")
        row = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count(F.when(full, 1))).head()
        if row[3] == known or not row[2]:
            break
        rate, known = (row[0] - most * row[1]) / row[2], row[3]
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.lit(rate) * F.col("weight"))
    return weighed.withColumn("target", target.cast("double"))


def strata(groups: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """of, class, source_size, target, whole, n (documents), take (documents drawn) of every stratum."""
    classes = groups.groupBy("of", size_class(F.col("size")).alias("class")).agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("size")).alias("words"))
    rounding = uniform(F.lit(key), F.col("of"), F.col("class").cast("string"))
    listed = classes.groupBy("of").agg(  # at most 64 + 32 * 57 classes
        F.sort_array(F.collect_list(F.struct("class", "n", "words", rounding.alias("u"))), asc=False).alias("classes"))
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    share = F.when(some, (F.col("target") - whole * F.col("source_size")) / F.col("source_size")).otherwise(0.0)
    kind = "struct<carry:double,out:array<struct<class:bigint,n:bigint,take:bigint>>>"

    def step(state: Column, c: Column) -> Column:
        wanted = F.col("share") * c["words"] + state["carry"]
        mean = c["words"].cast("double") / c["n"]
        drawn = F.when(c["words"] > 0, F.least(F.greatest(F.floor(wanted / mean + c["u"]), F.lit(0)), c["n"])).otherwise(0).cast("long")
        carry = F.when(c["words"] > 0, wanted - drawn * mean).otherwise(wanted)
        out = F.concat(state["out"], F.array(F.struct(c["class"].alias("class"), c["n"].alias("n"), drawn.alias("take"))))
        return F.struct(carry.alias("carry"), out.alias("out")).cast(kind)

    start = F.struct(F.lit(0.0).alias("carry"), F.array().alias("out")).cast(kind)
    drawn = sources.join(listed, "of").withColumn("whole", whole).withColumn("share", share).select(
        "of", "source_size", "target", "whole", F.explode(F.aggregate("classes", start, step)["out"]).alias("c"))
    return drawn.select("of", "source_size", "target", "whole", "c.*")


def numbered(groups: DataFrame, chunk: int = RANGE) -> DataFrame:
    """A row for every document, equal ones told apart by ``occurrence`` from 0; rows of which there
    are very many are numbered in chunks by several tasks."""
    last = F.floor((F.col("rows") - 1) / chunk).cast("long")
    few = groups.where(F.col("rows") <= chunk).withColumn("occurrence", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    chunks = groups.where(F.col("rows") > chunk).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    begin = F.col("_chunk") * chunk
    many = spread(chunks, "of", "doc_id", "print", "_chunk").withColumn(
        "occurrence", F.explode(F.sequence(begin, F.least(begin + chunk, F.col("rows")) - 1))).drop("_chunk")
    return few.unionByName(many)


def plan(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, key: str = "mix-1") -> DataFrame:
    """A row for every document: source, doc_id, print, size, source_size, target, copies, taken."""
    groups = counted(documents)
    drawn = stage(strata(groups, targets(groups, weights, most), key))
    rows = numbered(groups).withColumn("class", size_class(F.col("size")))
    u = uniform(F.lit(key), F.col("of"), F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("n")),
                F.col("print"), F.col("occurrence").cast("string"))
    rows = rows.join(drawn, ["of", "class"]).withColumn("u", u)
    p = F.col("take").cast("double") / F.col("n")
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    # With all or none of a stratum the odds are without bounds; any order will do.
    rows = rows.withColumn("odds", F.when((F.col("take") > 0) & (F.col("take") < F.col("n")), odds).otherwise(F.col("u")))
    ranges = F.floor(F.col("n") / RANGE) + 1
    rows = rows.withColumn("part", F.floor(F.col("u") * ranges))
    # Where the ranks of a range begin; only strata of several ranges need it.
    sizes = rows.where(ranges > 1).groupBy("of", "class", "part").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("of", "class").orderBy("part"))
    before = sizes.select("of", "class", "part", (upto - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("of", "class", "part").orderBy("odds", "u", "doc_id", "print", "occurrence"))
    ranked = rows.join(before, ["of", "class", "part"], "left").withColumn("rank", rank + F.coalesce("_before", F.lit(0)))
    copies = F.col("whole") + (F.col("rank") <= F.col("take")).cast("long")
    return ranked.select("source", "doc_id", "print", "size", "source_size", "target", copies.alias("copies"),
                         (F.col("size") * copies).alias("taken"))


def mixture(documents: DataFrame, drawn: DataFrame) -> DataFrame:
    """``documents``, every row as often as ``drawn`` (of ``plan``) takes it; of equal rows, any."""
    keys = ["_of", "_id", "_print"]
    total = drawn.groupBy(_of(F.col("source")).alias("_of"), F.col("doc_id").alias("_id"), F.col("print").alias("_print")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where(F.col("_copies") > 0)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.struct("*").alias("_row"), _of(F.col("source")).alias("_of"),
                            F.col("doc_id").alias("_id"), F.md5(text.cast("binary")).alias("_print"))
    same = (F.col("a._of") == F.col("b._of")) & F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._print") == F.col("b._print"))
    found = rows.alias("a").join(total.alias("b"), same).select("a.*", "_copies", "_rows")
    each = F.floor(F.col("_copies") / F.col("_rows")).cast("int")
    more = found.where(F.col("_copies") % F.col("_rows") > 0).dropDuplicates(keys).withColumn(
        "_n", (F.col("_copies") % F.col("_rows")).cast("int"))
    both = found.withColumn("_n", each).unionByName(more).where(F.col("_n") > 0)
    return both.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")
