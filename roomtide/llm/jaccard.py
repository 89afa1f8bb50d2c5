"""N-gram Jaccard join: prefix filters under several global token orders, then verification.

A text's set is its distinct n-word shingles.  Texts with equal sets are one class, so copies cost
nothing beyond the first step.  Two classes link when 100 * intersection >= percent * union.

Every order of all tokens gives a filter: linked sets of n tokens share one among their first
``n - ceil(percent * n / 100) + 1``.  The orders here put rare tokens first (exact document
frequency over classes) and break ties by different hashes.  Frequencies are counted by hash range;
a token of frequency one can never be shared, so it fills a place of the prefix but is not kept,
and a class whose prefix is full of such tokens has no candidate.  Candidates come from the first
order's inverted lists, must also share prefix tokens under the other orders, and are verified on
full sets that are computed again from the text of just those documents.

Lists longer than HOT are not paired up at first: each member is verified against LEADS members
that stand in the most such lists, and what these links connect is found before anything else.  After that only members of
different components are paired, in long lists by a join that Spark may split and that tests all
conditions inside.  No list or candidate that could connect anything is dropped.

Defined results: null and blank texts have an empty set and link with nothing; fewer than n words
are one shingle; documents with equal ids are told apart by their sets; a component's id is its
smallest doc_id, null only if all are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.bitmaps import bitmap, slots, unpacked
from roomtide.llm.components import components
from roomtide.llm.names import unused
from roomtide.llm.words import Hasher, mixed, shingle_set, slices, words_of
from roomtide.runtime import stage

ORDERS = 3
HOT = 256
LEADS = 4
RANGE_TOKENS = 4 << 20
FLUSH_TOKENS = 1 << 20
SEEN = 1 << 18
SLICE = 1 << 20


def class_of(values: np.ndarray) -> int:
    """64-bit name of a set, from two sums over its tokens and its size."""
    with np.errstate(over="ignore"):
        name = mixed(np.array([values.sum(), mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum(), len(values)], np.uint64))
        name = mixed(name[:1] + np.uint64(3) * name[1:2] + np.uint64(5) * name[2:3])
    return int(name.view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    """(batch, row, sorted set) of every text."""
    hasher = Hasher()
    for batch in slices(batches, "text", SLICE):
        found = words_of(batch.column("text"), hasher)
        for row in range(batch.num_rows):
            yield batch, row, shingle_set(found.hashes[found.first[row]:found.first[row + 1]], n)


def _texts(documents: DataFrame, *others: str) -> DataFrame:
    return documents.select("doc_id", F.col("text").cast("string").alias("text"), *others)


def classes(documents: DataFrame, n: int, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, class of every row (class null for empty sets), and its long columns ``others``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, sizes, names = None, [], []
        for now, _, values in _sets(batches, n):
            if now is not batch:
                if batch is not None:
                    yield made(batch, sizes, names)
                batch, sizes, names = now, [], []
            sizes.append(len(values))
            names.append(class_of(values) if len(values) else None)
        if batch is not None:
            yield made(batch, sizes, names)

    def made(batch: pa.RecordBatch, sizes: list, names: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), *map(batch.column, others)],
            ["doc_id", "n_shingles", "class", *others])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return _texts(documents, *others).mapInArrow(
        run, ", ".join([f"doc_id {kind}, n_shingles long, class long", *(f"{c} long" for c in others)]))


def _ranged(documents: DataFrame, n: int, ranges: int) -> DataFrame:
    """Tokens of all classes, packed by hash range: range, classes, sizes, counts, tokens (binary).

    A token is the top 48 bits of its hash; tokens that agree there count as one, which can only
    add candidates.  A task holds about FLUSH_TOKENS tokens at a time, and names of the last SEEN
    classes at most: a class that comes again after these is sent again, as from another task.
    """
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, names, seen, total = [], [], set(), 0
        for _, _, values in _sets(batches, n):
            if not len(values):
                continue
            name = class_of(values)
            if name in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(name)
            names.append(name)
            sets.append(values)
            total += len(values)
            if total >= FLUSH_TOKENS:
                yield packed(sets, names)
                sets, names, total = [], [], 0
        if sets:
            yield packed(sets, names)

    def packed(sets: list, names: list) -> pa.RecordBatch:
        tokens = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets], np.uint32)
        sets.clear()
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        # At most 1 << 16 ranges; owners ascend already, so a stable order keeps them so.
        part = (tokens >> shift).astype(np.uint16) if ranges > 1 else np.zeros(len(tokens), np.uint16)
        order = np.argsort(part, kind="stable")
        begin = np.append(0, np.cumsum(np.bincount(part, minlength=ranges)))
        tokens, owner = tokens[order], owner[order]
        del part, order
        tokens >>= np.uint64(16)
        ids = np.array(names, np.int64)
        columns: list[list] = [[], [], [], [], [], []]
        for r in range(ranges):
            own = owner[begin[r]:begin[r + 1]]
            if not len(own):
                continue
            who, counts = np.unique(own, return_counts=True)
            low = tokens[begin[r]:begin[r + 1]]
            for column, value in zip(columns, (
                    r, ids[who].tobytes(), sizes[who].tobytes(), counts.astype(np.uint32).tobytes(),
                    (low >> np.uint64(32)).astype(np.uint16).tobytes(), low.astype(np.uint32).tobytes())):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]],
            ["range", "classes", "sizes", "counts", "high", "low"])

    return _texts(documents).mapInArrow(
        run, "range int, classes binary, sizes binary, counts binary, high binary, low binary")


def _runs(batches: Iterator[pa.RecordBatch], key: str):
    """Consecutive rows with equal key, as (key, list of rows as dicts)."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != now:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


def _shared(ranged: DataFrame, parts: int) -> DataFrame:
    """class, n, tokens, frequencies (binary): the tokens of a range that several classes hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, "range"):
            ids = np.concatenate([np.frombuffer(r["classes"], np.int64) for r in rows])
            sizes = np.concatenate([np.frombuffer(r["sizes"], np.uint32) for r in rows])
            counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows])
            high = np.concatenate([np.frombuffer(r["high"], np.uint16) for r in rows]).astype(np.int64)
            tokens = (high << 32) | np.concatenate([np.frombuffer(r["low"], np.uint32) for r in rows])
            del high
            names, first, which = np.unique(ids, return_index=True, return_inverse=True)
            owner = np.repeat(which.astype(np.int32), counts)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            # Only tokens seen twice matter; drop the rest before anything else.
            twin = tokens[1:] == tokens[:-1]
            keep = np.zeros(len(tokens), bool)
            keep[1:] |= twin
            keep[:-1] |= twin
            tokens, owner = tokens[keep], owner[keep]
            order = np.lexsort((owner, tokens))
            tokens, owner = tokens[order], owner[order]
            # The same class from another task is a copy, not a second holder.
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
            tokens, owner = tokens[new], owner[new]
            _, at, frequency = np.unique(tokens, return_inverse=True, return_counts=True)
            frequency = frequency[at]
            many = frequency > 1
            tokens, owner, frequency = tokens[many], owner[many], frequency[many]
            order = np.argsort(owner, kind="stable")
            tokens, owner, frequency = tokens[order], owner[order], frequency[order].astype(np.uint32)
            who, begin = np.unique(owner, return_index=True)
            ends = np.append(begin[1:], len(owner))
            for at in range(0, len(who), 4096):
                some = slice(at, at + 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[who[some]]), pa.array(sizes[first[who[some]]].astype(np.int64)),
                     pa.array([tokens[a:b].tobytes() for a, b in zip(begin[some], ends[some])], pa.binary()),
                     pa.array([frequency[a:b].tobytes() for a, b in zip(begin[some], ends[some])], pa.binary())],
                    ["class", "n", "tokens", "frequencies"])

    return ranged.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(
        run, "class long, n long, tokens binary, frequencies binary")


def _prefixes(shared: DataFrame, parts: int, percent: int) -> DataFrame:
    """class, n, prefix (of the first order, array of long) and filters (of the others, 16-bit
    tokens as binary) of every class that has a shared token in its prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], []]
        for name, rows in _runs(batches, "class"):
            n = rows[0]["n"]
            tokens = np.concatenate([np.frombuffer(r["tokens"], np.int64) for r in rows])
            often = np.concatenate([np.frombuffer(r["frequencies"], np.uint32) for r in rows])
            places = n - -(-percent * n // 100) + 1 - (n - len(tokens))
            if places <= 0:
                continue
            out[0].append(name)
            out[1].append(n)
            for k in range(ORDERS):
                turn = mixed(tokens.view(np.uint64) + np.uint64(k * 0x632BE59BD9B4E019 & (2**64 - 1)))
                first = tokens[np.lexsort((turn, often))[:places]]
                if k == 0:
                    out[2].append(first.tolist())
                    out[3].append([])
                else:
                    out[3][-1].append(np.unique(mixed(first.view(np.uint64)) >> np.uint64(48)).astype(np.int32).tolist())
            if len(out[0]) >= 1024:
                yield made(out)
                out = [[], [], [], []]
        if out[0]:
            yield made(out)

    def made(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())),
             pa.array(out[3], pa.list_(pa.list_(pa.int32())))], ["class", "n", "prefix", "filters"])

    return shared.repartition(parts, "class").sortWithinPartitions("class").mapInArrow(
        run, "class long, n long, prefix array<long>, filters array<array<int>>")


def _pairs(lists: DataFrame, parts: int, percent: int) -> DataFrame:
    """Pairs of classes in the same list whose roots differ and whose sizes allow a link; no list is
    longer than HOT."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, held = [], [], 0
        for batch in tokens_together(batches):
            token, name, size, root = batch
            begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            for a, b in zip(begin, np.append(begin[1:], len(token))):
                if b - a < 2:
                    continue
                i, j = np.triu_indices(b - a, 1)
                small, large = np.minimum(size[a + i], size[a + j]), np.maximum(size[a + i], size[a + j])
                fits = (100 * small >= percent * large) & (root[a + i] != root[a + j])
                x, y = name[a + i[fits]], name[a + j[fits]]
                left.append(np.minimum(x, y))
                right.append(np.maximum(x, y))
                held += int(fits.sum())
            if held > 1 << 20:
                yield made(left, right)
                left, right, held = [], [], 0
        if held:
            yield made(left, right)

    def tokens_together(batches: Iterator[pa.RecordBatch]):
        """Columns of batches, cut so that a list never spans two."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch.column(c)) for c in ("token", "class", "n", "root")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            cut = int(np.searchsorted(now[0], now[0][-1], "left"))
            rest = [x[cut:] for x in now]
            if cut:
                yield [x[:cut] for x in now]
        if rest is not None:
            yield rest

    def made(left: list, right: list) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return lists.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, "a long, b long").distinct()


def _full_sets(names: DataFrame, documents: DataFrame, n: int) -> DataFrame:
    """class, tokens (array of long) of the classes in ``names``, computed again from the texts.

    A bit map of the wanted classes keeps other documents' sets from being built up and sent.
    """
    wanted = documents.sparkSession.sparkContext.broadcast(bitmap(names, "class"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = unpacked(wanted.value)
        ids, sets, seen = [], [], set()
        for _, _, values in _sets(batches, n):
            name = class_of(values) if len(values) else None
            if name is None or name in seen or not bits[slots(np.array([name], np.int64))[0]]:
                continue
            seen.add(name)
            ids.append(name)
            sets.append(values.view(np.int64))
            if len(ids) >= 256:
                yield made(ids, sets)
                ids, sets = [], []
                if len(seen) > 1 << 18:
                    seen = set()
        if ids:
            yield made(ids, sets)

    def made(ids: list, sets: list) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, sets)])
        flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), flat], ["class", "tokens"])

    found = _texts(documents).mapInArrow(run, "class long, tokens array<long>")
    return stage(found.join(names, "class", "left_semi").groupBy("class").agg(F.first("tokens").alias("tokens")))


def _linked(x: str, y: str, percent: int) -> str:
    """SQL condition: the token arrays of rows x and y have the similarity asked for."""
    common = f"size(array_intersect({x}, {y}))"
    return f"{100 + percent} * {common} >= {percent} * (size({x}) + size({y}))"


def _verified(pairs: DataFrame, prefixes: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Links among candidate pairs: shared prefix tokens under every order, then exact sets."""
    side = prefixes.select("class", "filters")
    both = (pairs.join(side.select(F.col("class").alias("a"), F.col("filters").alias("fa")), "a")
            .join(side.select(F.col("class").alias("b"), F.col("filters").alias("fb")), "b"))
    for k in range(ORDERS - 1):
        both = both.where(F.arrays_overlap(F.col("fa")[k], F.col("fb")[k]))
    kept = stage(both.select("a", "b"))
    needed = stage(kept.select(F.explode(F.array("a", "b")).alias("class")).distinct())
    sets = _full_sets(needed, documents, n)
    met = (kept.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta")), "a")
           .join(sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb")), "b"))
    return stage(met.where(F.expr(_linked("ta", "tb", percent))).select("a", "b"))


def _indexed(documents: DataFrame, rows: DataFrame, n: int, percent: int) -> tuple[DataFrame, int]:
    """Prefixes and filters of every class that shares a prefix token, and the number of tasks."""
    spark = documents.sparkSession
    tokens = rows.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = 64
    while ranges * RANGE_TOKENS < tokens and ranges < 1 << 16:
        ranges *= 2
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 2)
    return stage(_prefixes(_shared(_ranged(documents, n, ranges), parts), parts, percent)), parts


def links(documents: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that link, enough of them to connect every component."""
    prefixes, parts = _indexed(documents, rows, n, percent)
    lists = prefixes.select(F.explode("prefix").alias("token"), "class", "n")
    long = stage(lists.groupBy("token").agg(F.count("*").alias("members")).where(f"members > {HOT}"))
    if long.isEmpty():
        return _verified(_pairs(lists.withColumn("root", F.col("class")), parts, percent), prefixes, documents, n, percent)
    hot = stage(lists.join(long, "token"))
    sets = stage(_full_sets(stage(hot.select("class").distinct()), documents, n).join(
        prefixes.select("class", "prefix", "filters"), "class"))
    # The class with the most long lists, once per hash bucket: likely an original of near copies.
    often = hot.groupBy("class").agg(F.count("*").alias("lists"))
    leads = (hot.join(often, "class")
             .groupBy("token", F.pmod(F.xxhash64("class"), F.lit(LEADS)).alias("bucket"))
             .agg(F.max_by("class", F.struct("lists", "class")).alias("lead"))
             .groupBy("token").agg(F.collect_set("lead").alias("leads")))
    stars = (hot.join(leads, "token").select("class", F.explode("leads").alias("lead"))
             .where("class <> lead").distinct()
             .join(sets.select("class", F.col("tokens").alias("ta")), "class")
             .join(sets.select(F.col("class").alias("lead"), F.col("tokens").alias("tb")), "lead"))
    stars = stage(stars.where(F.expr(_linked("ta", "tb", percent))).select(F.col("class").alias("a"), F.col("lead").alias("b")))
    # Classes that these links connect need no test against each other.
    roots = components(stars).withColumnRenamed("node", "class")
    owned = stage(prefixes.join(roots, "class", "left").select(
        F.explode("prefix").alias("token"), "class", "n", F.coalesce("root", "class").alias("root")))
    short = owned.join(long, "token", "left_anti")
    found = _verified(_pairs(short, parts, percent), prefixes, documents, n, percent)
    named = owned.join(long.select("token"), "token", "left_semi")
    several = named.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    full = stage(named.join(several.select("token"), "token", "left_semi").join(sets, "class"))
    x, y = full.alias("x"), full.alias("y")
    # All conditions stand in the join: a pair is tested at its first common token and becomes a row
    # only if it links.
    shared = " and ".join(f"arrays_overlap(x.filters[{k}], y.filters[{k}])" for k in range(ORDERS - 1))
    rest = x.join(y, F.expr(
        "x.token = y.token and x.class < y.class and x.root <> y.root"
        f" and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {shared}"
        f" and element_at(array_intersect(x.prefix, y.prefix), 1) = x.token"
        f" and {_linked('x.tokens', 'y.tokens', percent)}"))
    rest = stage(rest.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")))
    return found.unionByName(stars).unionByName(rest)


def all_links(documents: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Every pair (a, b) of classes, a < b, that links; ``rows`` are the classes of the documents.

    Members of a long list meet under two keys, the token and one of the second order's prefix,
    and a pair is tested once, at its first token of both: classes that only share a frequent
    token do not meet, and what is left of a hot key is a join that Spark can split.
    """
    prefixes, parts = _indexed(documents, rows, n, percent)
    lists = prefixes.select(F.explode("prefix").alias("token"), "class", "n")
    long = stage(lists.groupBy("token").agg(F.count("*").alias("members")).where(f"members > {HOT}").select("token"))
    short = lists.join(long, "token", "left_anti").withColumn("root", F.col("class"))
    found = _verified(_pairs(short, parts, percent), prefixes, documents, n, percent)
    if long.isEmpty():
        return found
    hot = lists.join(long, "token").select("token", "class", "n")
    sets = stage(_full_sets(stage(hot.select("class").distinct()), documents, n).join(
        prefixes.select("class", "prefix", F.expr("transform(filters, f -> array_distinct(f))").alias("filters")), "class"))
    keyed = hot.join(sets, "class").withColumn("second", F.explode(F.col("filters")[0]))
    x, y = keyed.alias("x"), keyed.alias("y")
    others = " and ".join(f"arrays_overlap(x.filters[{k}], y.filters[{k}])" for k in range(1, ORDERS - 1))
    met = x.join(y, F.expr(
        "x.token = y.token and x.second = y.second and x.class < y.class"
        f" and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
        f" and element_at(array_intersect(x.filters[0], y.filters[0]), 1) = x.second"
        f" and element_at(array_intersect(x.prefix, y.prefix), 1) = x.token and {others or 'true'}"
        f" and {_linked('x.tokens', 'y.tokens', percent)}"))
    rest = stage(met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")))
    # A pair may share a first token in a long list and others in short ones.
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(rest).distinct()


def joined(documents: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The whole join: every document's class and number of links to other texts' classes, and the
    pairs of classes.

    doc_id, n_shingles, class, links: documents of one class have equal sets and link with each
    other and with all documents of the classes that theirs links to.
    """
    rows = stage(classes(documents, n))
    pairs = stage(all_links(documents, rows, n, percent))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_end")).groupBy("_end").agg(F.count("*").alias("links"))
    whole = rows.join(ends, F.col("class") == F.col("_end"), "left").drop("_end")
    return whole.withColumn("links", F.coalesce("links", F.lit(0))), pairs


def _rooted(documents: DataFrame, n: int, percent: int, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, class, root (null for empty sets) of every row, and ``others``."""
    rows = stage(classes(documents, n, others))
    roots = components(links(documents, rows, n, percent))
    return rows.join(roots, rows["class"] == roots["node"], "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("root", "class").alias("root"), *others)


def groups(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class, component_id of every row."""
    rooted = _rooted(documents, n, percent)
    least = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    # A row per component on one side, and components may be large: the join can be split.
    return rooted.join(least, "root", "left").select(
        "doc_id", "n_shingles", "class",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def deduplicated(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group stays: the one with the smallest id; columns unchanged.

    Rows with an empty set all stay.  A null id comes after all others.  Among a group's rows that
    share the smallest id, the least hash of all columns decides; of rows equal in every column one
    stays.
    """
    mark, own, same = unused(documents.columns, "print", "id", "key")
    # Map columns have no hash; rows that differ in them alone count as equal.  Hashes skip nulls, so these are marked.
    hashed = [F.col(f"`{f.name}`") for f in documents.schema.fields if "map<" not in f.dataType.simpleString()]
    printed = documents.withColumn(mark, F.xxhash64(*hashed, *[c.isNull() for c in hashed]))
    rooted = stage(_rooted(printed, n, percent, (mark,)))
    full = rooted.where(F.col("root").isNotNull()).groupBy("root", "doc_id", mark).agg(F.count("*").alias("copies"))
    first = full.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(mark).alias("mark"), "copies")).alias("f"))
    empty = rooted.where("n_shingles = 0").select("doc_id", F.col(mark).alias("mark"), F.lit(1).cast("long").alias("copies")).distinct()
    keys = stage(first.select("f.doc_id", "f.mark", "f.copies").unionByName(empty).select(
        F.col("doc_id").alias(own), F.col("mark").alias(same), "copies"))

    def held(wanted: DataFrame) -> DataFrame:
        return printed.join(wanted, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(mark) == F.col(same)), "left_semi")

    out = held(keys.where("copies = 1"))
    repeated = keys.where("copies > 1")
    if not repeated.isEmpty():
        out = out.unionByName(held(repeated).dropDuplicates(["doc_id", mark]))
    return out.drop(mark)
