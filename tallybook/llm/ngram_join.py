"""Similarity join of documents on the Jaccard likeness of their word shingles, up to connected classes.

Rare-first prefix filtering: shingles are ordered by how often they occur in the corpus, and two documents
can only reach the likeness if they share one of the first n - ceil(t n) + 1 of each. The order comes from
counts of hashed shingles in a table of fixed size that covers all documents; any order gives the same
links, a better one only fewer candidates. Length, position and suffix filters thin the candidates out: the
lengths must be near each other, and what follows the first shared shingle must still suffice, both in
number and in how it spreads over parts of the hash space. What remains is verified once per pair on the
whole sets.

Equal sets are one class from the start, and no group of near copies is expanded into all its pairs:

1. each class is compared with one hub of every prefix shingle it has, and the links are joined up;
2. shingles whose classes are by then all connected are done; in the others only classes that are not
   yet connected are compared, as pairs for small groups, and for large ones as blocks of classes outside
   the group's main component against blocks of the whole group.

Nothing is capped: every pair that passes the filters and is not already connected is verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.llm.components import connected_components
from tallybook.llm.textkit import lean, mix, shingle_sets
from tallybook.session import scratch_dir

COUNTER_BITS = 21
BLOCK = 1 << 14
SMALL_GROUP = 64      # classes of a shingle that are paired row by row; larger groups are compared in blocks
PROBE_BLOCK, TARGET_BLOCK = 512, 2048  # the sets of a probe block are held in memory, targets pass by
PAIR_PART = 512
HEAVY = 4096          # shingles counted so often (or four times the mean) are grouped by aggregates, rarer ones by a window
FILTER_BITS = 26      # at most; 8 MB on the driver and in each worker


def set_hash(shingles: np.ndarray) -> int:
    """64-bit identity of a set of shingles, signed. (Some 10^10 sets make a chance pair of equal ones likely.)"""
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def scan_documents(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, h) per document, and the counters of each task in blocks (block, counts)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, waiting, held = np.zeros(1 << COUNTER_BITS, np.int64), [], 0
        key_type, names = pa.int64(), ["id", "n", "h", "block", "counts"]

        def rows(*columns):
            types = [key_type, pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            key_type = batch.column(0).type
            n, h = [], []
            for _, shingles in shingle_sets(batch.column(1), width):
                n.append(len(shingles))
                h.append(set_hash(shingles))
                waiting.append(_buckets(shingles))
                held += len(shingles)
                if held >= 1 << COUNTER_BITS:
                    counters += np.bincount(np.concatenate(waiting), minlength=len(counters))
                    waiting, held = [], 0
            yield rows(batch.column(0), n, h, [None] * len(n), [None] * len(n))
        if waiting:
            counters += np.bincount(np.concatenate(waiting), minlength=len(counters))
        if counters.any():
            small = counters.astype("<u2" if counters.max() < 1 << 16 else "<u8")
            parts = [small[i:i + BLOCK].tobytes() for i in range(0, len(small), BLOCK)]
            none = [None] * len(parts)
            yield rows(none, none, none, list(range(len(parts))), parts)

    return docs.select("id", "text").mapInArrow(lean(scan), f"id {id_type}, n bigint, h bigint, block int, counts binary")


def add_counters(blocks: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters; its size is fixed by ``COUNTER_BITS``."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, "<u2" if len(counts) == 2 * BLOCK else "<u8").astype(np.int64)
                sums[block] = sums[block] + part if block in sums else part
        if sums:
            parts = [np.minimum(s, (1 << 32) - 1).astype("<u4").tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())],
                                             names=["block", "counts"])

    total = np.zeros(1 << COUNTER_BITS, np.uint32)
    for row in blocks.repartition("block").mapInArrow(lean(add), "block int, counts binary").collect():
        total[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.counts, "<u4")
    return total


def rare_first(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set (sorted by hash) in the corpus-wide order: by count, then by hash."""
    return shingles[np.argsort(counts[_buckets(shingles)], kind="stable")]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefix_rows(docs: DataFrame, counts, width: int, percent: int) -> DataFrame:
    """(token, h, place, suffix, heavy) for the prefix of each set; a set is given once per task.

    ``place`` holds n above and the position below; ``suffix`` two 16-bit numbers: how many of the shingles
    after the position lie in each half of the hash space, or -1 if one does not fit. ``heavy``: the shingle's
    counter has come to ``HEAVY`` and to four times the mean; one that is not heavy stands in fewer rows than that.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        often = max(HEAVY, 4 * counts.value.mean())
        for batch in batches:
            out, held = [], 0
            for _, shingles in shingle_sets(batch.column(0), width):
                n = len(shingles)
                h = set_hash(shingles)
                if not n or h in seen:
                    continue
                seen.add(h)
                ordered = rare_first(shingles, counts.value)
                p = prefix_length(n, percent)
                half = (ordered >> np.uint64(63)).astype(np.int64)
                upper = half.sum() - np.cumsum(half[:p])
                lower = n - 1 - np.arange(p) - upper
                packed = lower | upper << 16
                packed[np.maximum(lower, upper) > 0xFFFF] = -1
                out.append((ordered[:p].view(np.int64), np.full(p, h, np.int64), (n << 32) + np.arange(p), packed,
                            counts.value[_buckets(ordered[:p])] >= often))
                held += p
                if held > 200_000:
                    yield columns(out)
                    out, held = [], 0
            if out:
                yield columns(out)

    def columns(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                          names=["token", "h", "place", "suffix", "heavy"])

    return docs.select("text").mapInArrow(lean(rows), "token bigint, h bigint, place bigint, suffix bigint, heavy boolean")


def shared_members(prefixes: DataFrame) -> DataFrame:
    """(token, h, place, suffix, hub) of the shingles that two or more classes have, once per class; hub: the least class.

    The rows of shingles that are not heavy, nearly all, move once: a group of them is small and stands in one task.
    Those of heavy ones are counted by a partial aggregate and joined, which a task too large is split for.
    """
    light, heavy = prefixes.where("not heavy").drop("heavy"), prefixes.where("heavy").drop("heavy")
    own = Window.partitionBy("token")
    light = light.withColumns({"hub": F.min("h").over(own), "last": F.max("h").over(own)}).where("hub < last").drop("last")
    hubs = heavy.groupBy("token").agg(F.min("h").alias("hub"), F.max("h").alias("last")).where("hub < last").drop("last")
    once = [F.min(c).alias(c) for c in ("place", "suffix", "hub")]
    return light.groupBy("token", "h").agg(*once).unionByName(heavy.join(hubs, "token").groupBy("token", "h").agg(*once))


def may_link(a: str, b: str, percent: int) -> Column:
    """Length, position and suffix filter for two rows that share a prefix shingle.

    Position and suffix bounds hold at the first shingle that a pair shares, so a pair that reaches the
    likeness passes there; passing at any other shared shingle only makes it a candidate once more.
    """
    n = {s: F.shiftright(f"{s}.place", 32) for s in (a, b)}
    left = {s: n[s] - F.col(f"{s}.place").bitwiseAND(F.lit(0xFFFFFFFF)) - 1 for s in (a, b)}
    both, t = n[a] + n[b], 100 + percent
    apart = sum((F.abs(F.shiftrightunsigned(f"{a}.suffix", s).bitwiseAND(F.lit(0xFFFF))
                       - F.shiftrightunsigned(f"{b}.suffix", s).bitwiseAND(F.lit(0xFFFF))) for s in (0, 16)),
                start=F.lit(0))
    return ((100 * F.least(n[a], n[b]) >= percent * F.greatest(n[a], n[b]))
            & (t * (1 + F.least(left[a], left[b])) >= percent * both)
            & ((F.col(f"{a}.suffix") == -1) | (F.col(f"{b}.suffix") == -1)
               | (t * (2 + left[a] + left[b] - apart) >= 2 * percent * both)))


class Probes:
    """The shingles of a block of sets, sorted, to count what another set shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner, self.n = tokens[order], owner[order], len(sets)

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.tokens, tokens), np.searchsorted(self.tokens, tokens, side="right")
        many = high - low
        low, many = low[many > 0], many[many > 0]
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(self.owner[at], minlength=self.n)


def verified(rows: DataFrame, counts, width: int, percent: int) -> DataFrame:
    """Links (a, b) among rows (key, part, probe, h, comp, pos, text): probes of a part against its other rows.

    With ``pos`` (large groups of one shingle) a pair is verified only at the first shingle it shares in the
    order of the corpus, and of the links of a part only those that connect something are returned.
    """

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, ready, early, parent = None, [], None, None, {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def before(shingles, pos):
            return rare_first(shingles, counts.value)[:pos]

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            found = []
            for (_, shingles), key, part, probe, h, comp, pos in zip(shingle_sets(batch.column(6), width), *columns):
                if (key, part) != current:
                    current, waiting, ready, parent = (key, part), [], None, {}
                if set_hash(shingles) != h:  # another row with the id of the class's document
                    continue
                if probe:
                    waiting.append((h, comp, shingles, pos))
                    continue
                if not waiting:
                    continue
                if ready is None:
                    ready = Probes([w[2] for w in waiting])
                    sizes, comps = np.array([len(w[2]) for w in waiting]), np.array([w[1] for w in waiting])
                    early = Probes([before(w[2], w[3]) for w in waiting]) if pos is not None else None
                n = len(shingles)
                open_ = (comps != comp) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
                if early is not None and open_.any() and pos:
                    open_ &= early.shared(before(shingles, pos)) == 0
                if not open_.any():
                    continue
                linked = open_ & ((100 + percent) * ready.shared(shingles) >= percent * (sizes + n))
                for i in np.flatnonzero(linked).tolist():
                    other = waiting[i][0]
                    if find(h) != find(other):
                        parent[find(h)] = find(other)
                        found.append((h, other))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    parts = rows.repartition("key", "part").sortWithinPartitions("key", "part", F.col("probe").desc(), "h")
    return parts.select("key", "part", "probe", "h", "comp", "pos", "text").mapInArrow(lean(check), "a bigint, b bigint")


def marked(ids: DataFrame, n: int) -> np.ndarray:
    """A table of bits, eight a byte, that has the bit of each hash in ``ids`` (at: bigint): the hash's upper bits are its number.

    About 16 bits for each of ``n`` rows, up to ``FILTER_BITS`` in their number's binary digits. It is put together by tasks.
    """
    bits = min(FILTER_BITS, max(10, (16 * n).bit_length()))
    size = 1 << bits - 3

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy()
            np.bitwise_or.at(table, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        blocks = [i for i in range(0, size, BLOCK) if table[i:i + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([table[i:i + BLOCK].tobytes() for i in blocks], pa.binary())],
                                         names=["first", "bytes"])

    places = ids.select(F.shiftrightunsigned("at", 64 - bits).alias("at")).repartition(F.shiftright("at", 3 + BLOCK.bit_length() - 1))
    table = np.zeros(size, np.uint8)
    for row in places.mapInArrow(lean(mark), "first bigint, bytes binary").collect():
        table[row.first:row.first + BLOCK] |= np.frombuffer(row.bytes, np.uint8)
    return table


def among(rows: DataFrame, table) -> DataFrame:
    """The rows whose hash (last column, left out) has its bit in ``table``, the broadcast of ``marked``: all that it was made of, and few others."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = table.value
            at = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64) >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)
            found = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(found))

    return rows.mapInArrow(lean(pick), StructType(rows.schema.fields[:-1]))


class JaccardJoin:
    """The steps of the join, each written to the shared folder and read back."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        self.spark, self.docs, self.width, self.percent = docs.sparkSession, docs, width, percent
        self.folder = scratch_dir(self.spark, "jaccard")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def with_text(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the text of one document of each class.

        The documents are thinned out by a table of bits of bounded size, and only what is left meets the rows by
        id: neither the rows pass through the driver, whatever their number, nor all texts through a shuffle.
        """
        rows = self.keep(rows.join(self.reps, "h"), name)
        own = F.xxhash64("id").alias("at")
        table = self.spark.sparkContext.broadcast(marked(rows.select(own), rows.count()))
        return among(self.docs.select("id", "text", own), table).join(rows.hint("merge"), "id")

    def verify_pairs(self, pairs: DataFrame, name: str) -> DataFrame:
        """Links among pairs (a, b); the pairs of one b are dealt out by parts of about ``PAIR_PART``."""
        pairs = self.keep(pairs, f"{name}-pairs")
        parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIR_PART).alias("parts"))
        none = F.lit(None).cast("bigint").alias("pos")
        targets = pairs.join(parts, "b").select(
            F.col("b").alias("key"), F.pmod(F.xxhash64("a"), "parts").alias("part"), F.lit(False).alias("probe"),
            F.col("a").alias("h"), F.col("a").alias("comp"), none)
        probes = parts.select(
            F.col("b").alias("key"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
            F.lit(True).alias("probe"), F.col("b").alias("h"), F.col("b").alias("comp"), none)
        rows = self.with_text(targets.union(probes), f"{name}-rows")
        return self.keep(verified(rows, self.counts, self.width, self.percent), f"{name}-links")

    def blocks(self, mixed: DataFrame) -> DataFrame:
        """Rows for the large groups: what lies outside a group's main component against all of the group."""
        sizes = mixed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
        main = sizes.groupBy("token").agg(F.max_by("comp", "n").alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"))
        rows = mixed.drop("cnt").join(main, "token").select(
            "token", "h", "comp", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pos"), (F.col("comp") != F.col("main")).alias("outside"),
            F.ceil((F.col("n") - F.col("most")) / PROBE_BLOCK).alias("across"), F.ceil(F.col("n") / TARGET_BLOCK).alias("down"))
        count = lambda c: F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)
        own = lambda c: F.pmod(F.xxhash64("h"), F.col(c))
        probes = rows.where("outside").select("*", F.lit(True).alias("probe"), own("across").alias("i"), F.explode(count("down")).alias("j"))
        targets = rows.select("*", F.lit(False).alias("probe"), F.explode(count("across")).alias("i"), own("down").alias("j"))
        return probes.union(targets).select(F.col("token").alias("key"), (F.col("i") * F.col("down") + F.col("j")).alias("part"),
                                            "probe", "h", "comp", "pos")

    def run(self) -> DataFrame:
        scanned = self.keep(scan_documents(self.docs, self.width), "scan")
        sets = scanned.where("block is null").select("id", "n", "h")
        self.counts = self.spark.sparkContext.broadcast(
            add_counters(scanned.where("block is not null").select("block", "counts")))
        self.reps = sets.where("n > 0").groupBy("h").agg(F.min("id").alias("id"))

        prefixes = self.keep(prefix_rows(self.docs, self.counts, self.width, self.percent), "prefixes")
        members = self.keep(shared_members(prefixes), "members")
        self.remove("prefixes")

        a, b = members.alias("a"), members.alias("b")
        hubs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.hub") == F.col("b.h"))
                      & (F.col("a.h") != F.col("b.h")) & may_link("a", "b", self.percent))
        first = self.verify_pairs(hubs.select(F.col("a.h").alias("a"), F.col("b.h").alias("b")).distinct(), "hub")

        roots = connected_components(first, f"{self.folder}/first").withColumnRenamed("node", "h")
        members = members.join(roots, "h", "left").select("token", "h", "place", "suffix", F.coalesce("root", "h").alias("comp"))
        split = (members.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("cnt"))
                 .where("low < high").select("token", "cnt"))
        mixed = self.keep(members.join(split, "token"), "mixed")
        small = mixed.where(F.col("cnt") <= SMALL_GROUP)
        a, b = small.alias("a"), small.alias("b")
        pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.h") < F.col("b.h"))
                       & (F.col("a.comp") != F.col("b.comp")) & may_link("a", "b", self.percent))
        second = self.verify_pairs(pairs.select(F.col("a.h").alias("a"), F.col("b.h").alias("b")).distinct(), "pair")
        large = self.with_text(self.blocks(mixed.where(F.col("cnt") > SMALL_GROUP)), "block-rows")
        third = self.keep(verified(large, self.counts, self.width, self.percent), "block-links")

        roots = connected_components(first.union(second).union(third), f"{self.folder}/all").withColumnRenamed("node", "h")
        placed = sets.join(roots, "h", "left").withColumn("class", F.coalesce("root", "h"))
        least = placed.where("n > 0").groupBy("class").agg(F.min("id").alias("least"))
        return placed.join(least, "class", "left").select(
            "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def near_duplicate_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5,
                           percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: the id, n_shingles, component_id (least id reachable by links, itself included).

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of ``width``-word shingles
    (A-Z in lower case; a shorter text is one shingle). A null, empty or blank text has an empty set and links
    with nothing. Repeated rows are each returned. A text found only in rows without an id links with equal sets
    alone. An empty table gives no rows. Other columns are left out.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return JaccardJoin(own, width, percent).run().withColumnRenamed("id", id_column)
