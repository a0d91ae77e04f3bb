"""Near-duplicates by min-max hashing: banded signatures propose links, full shingle sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideloom.llm.batches import WordHashes, grams, mixed, signed, text_chunks, with_columns
from rideloom.llm.components import connected
from rideloom.workspace import cut_lineage, drop_unused_shuffles, forget

#: Both ends of each permutation go into the signature: 64 permutations give 32 bands of 4 values. A pair at
#: similarity s shares a band with probability 1 - (1 - s**4)**32; at 0.8 it is missed once in 20 million.
PERMUTATIONS, BAND_ROWS = 64, 4
#: One bit of each signature value makes a sketch of 128 bits; at similarity s bits agree with probability
#: (1 + s) / 2. A pair at 0.8 agrees in fewer than this many once in ten million.
LEAST_AGREEING = 95
#: Pairs of one document that are confirmed in one task.
LEAVES = 256
#: Comparisons left for the last, exhaustive round, per member of a bucket, before another pivot is worth it.
FEW = 8
PIVOT_ROUNDS = 8


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text in lower case (A-Z only)."""
    words = text.lower().split()
    return np.unique(grams(hashes.of(words), size)) if words else np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], permutations: int = PERMUTATIONS) -> np.ndarray:
    """Smallest and largest value of each permutation side by side; a row for each (non-empty) set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    factors = np.random.default_rng(20_11).integers(1 << 62, 1 << 63, permutations, np.uint64) | np.uint64(1)
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    for i, factor in enumerate(factors):
        permuted = values * factor
        out[:, 2 * i] = np.minimum.reduceat(permuted, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signature: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    bands = signature.reshape(len(signature), -1, rows)
    out = mixed(np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2]))
    for i in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return out


def sketches(signature: np.ndarray) -> np.ndarray:
    """One bit of each signature value, those of the smallest and of the largest values in a word each."""
    bits = (mixed(signature) >> np.uint64(63)).reshape(len(signature), -1, 2)
    return (bits << np.arange(bits.shape[1], dtype=np.uint64)[None, :, None]).sum(1, dtype=np.uint64)


def _features(docs: DataFrame, size: int) -> DataFrame:
    """Size, a 128-bit name and the band keys of every document's shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows, texts in text_chunks(batches):
            sets = [shingle_set(t, size, hashes) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            names = np.zeros((2, len(sets)), np.uint64)
            keys, marks = np.zeros((len(sets), 0), np.uint64), np.zeros((2, len(sets)), np.uint64)
            if len(full):
                some = [sets[i] for i in full]
                starts = np.cumsum([0, *sizes[full][:-1]])
                values = np.concatenate(some)
                names[0, full] = np.add.reduceat(mixed(values), starts)
                names[1, full] = np.bitwise_xor.reduceat(mixed(values + np.uint64(0x51ED270B)), starts)
                signature = signatures(some)
                keys = band_keys(signature)
                marks[:, full] = sketches(signature).T
            offsets = np.zeros(len(sets) + 1, np.int32)
            offsets[1:] = np.cumsum((sizes > 0) * (keys.shape[1] if len(full) else 0))
            yield with_columns(
                rows, ["doc_id"], n_shingles=sizes, name_a=signed(names[0]), name_b=signed(names[1]),
                sketch_a=signed(marks[0]), sketch_b=signed(marks[1]),
                bands=pa.ListArray.from_arrays(pa.array(offsets), signed(keys.ravel())))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(
        run, "doc_id long, n_shingles long, name_a long, name_b long, sketch_a long, sketch_b long, bands array<long>")


def _compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The full sets of each pair (``hub``, ``leaf``) side by side.

    Columns: the pair, ``linked`` (at least ``percent`` of their union in common), ``lacks`` (a bit for each of the hub's
    shingles: the leaf has it not) and ``own`` (the leaf's shingles that the hub has not). A text travels to the places where it
    is compared, a hub's once for every ``LEAVES`` of its pairs, so a hub with many pairs is dealt over many tasks and
    no row carries two texts. Sets are built where the texts arrive. Ids with several texts give a row for each of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, sets = WordHashes(), None, []
        for rows, texts in text_chunks(batches):
            out: list[tuple[int, int, bool, np.ndarray, np.ndarray]] = []
            for hub, salt, leaf, text in zip(*(rows.column(i).to_pylist() for i in range(3)), texts, strict=True):
                if (hub, salt) != at:
                    at, sets = (hub, salt), []
                shingles = shingle_set(text, size, hashes)
                if leaf is None:
                    sets.append(shingles)
                    continue
                for other in sets:
                    own, lacks = shingles[~_among(shingles, other)], ~_among(other, shingles)
                    common = len(shingles) - len(own)
                    linked = bool(common) and 100 * common >= percent * (len(other) + len(own))
                    bits = np.packbits(np.concatenate([lacks, np.zeros(-len(lacks) % 64, bool)])).view(np.uint64)
                    out.append((hub, leaf, linked, bits, own))
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)), *(_lists([x[i] for x in out]) for i in (3, 4))],
                names=["hub", "leaf", "linked", "lacks", "own"])

    hubs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / LEAVES).alias("parts"))
    placed = pairs.join(hubs, "hub").select(
        "hub", F.pmod(F.xxhash64("leaf"), F.col("parts")).cast("int").alias("salt"), "leaf", F.col("leaf").alias("doc_id"))
    copies = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("salt"))
    wanted = placed.union(copies.select("hub", "salt", F.lit(None).cast("long"), F.col("hub").alias("doc_id")))
    # The same plan at every size: ids small enough to broadcast here would not be on more data.
    met = texts.hint("merge").join(wanted, "doc_id").select("hub", "salt", "leaf", "text")
    dealt = met.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.asc_nulls_first("leaf"))
    return dealt.mapInArrow(run, "hub long, leaf long, linked boolean, lacks array<long>, own array<long>")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), signed(np.concatenate([np.zeros(0, np.uint64), *values])))


def _among(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sorted ``values`` are in ``others``, also sorted."""
    if not len(others):
        return np.zeros(len(values), bool)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def _links_of(compared: DataFrame) -> DataFrame:
    return compared.filter("linked").select(F.least("hub", "leaf").alias("a"), F.greatest("hub", "leaf").alias("b")).distinct()


def _deviations(compared: DataFrame) -> DataFrame:
    """How each leaf deviates from its hub: the number of its own shingles, those that another leaf has too, and what it lacks.

    Pairs with several texts are left out, and so nothing is concluded about them.
    """
    once = compared.groupBy("hub", "leaf").agg(F.count("*").alias("n"), F.first("own").alias("own"), F.first("lacks").alias("lacks")).filter("n = 1")
    each = once.select("hub", "leaf", F.explode("own").alias("shingle"))
    shared = each.groupBy("hub", "shingle").agg(F.count("*").alias("n")).filter("n > 1")
    told = each.join(shared, ["hub", "shingle"]).groupBy("hub", "leaf").agg(F.count("*").alias("met"))
    return once.join(told, ["hub", "leaf"], "left").select(
        "hub", F.col("leaf").alias("doc"), F.struct(F.size("own").alias("own"), "lacks", F.coalesce("met", F.lit(0)).alias("met")).alias("off"))


def _links(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed pairs that connect whatever the buckets' pairs connect, without listing all pairs.

    ``members`` has ``key``, ``doc``, ``about`` (size and sketch of its set) and ``weight`` (members of all its buckets).
    In every round each bucket compares one pivot with the members outside the pivot's component. The first pivot, the
    bucket's hub, is the member of greatest weight: of texts that were changed here and there the one that the others come
    from meets most of them, so one round settles nearly all. Later pivots are members that are still apart. Buckets
    whose members are in one component are done, and so are members that were a pivot or that cannot link with any member of
    another component: sizes and sketches are too far apart, or their deviations from the hub, known since the first round,
    have too little in common. Once few comparisons are left, a round has linked few, or after ``PIVOT_ROUNDS``, all
    of them are made, so no pair is left out. Tables of a round are removed once the next one has been written.
    """
    weight = F.struct("weight", -F.col("doc"))
    hubs = members.groupBy("key").agg(F.max_by(F.struct("doc", "about"), weight).alias("pivot")).select("key", "pivot.*")
    hubs = cut_lineage(hubs, "hubs")
    all_members = members.join(hubs.select("key", F.col("doc").alias("hub")), "key")
    pairs = cut_lineage(all_members.filter("doc <> hub").select("hub", F.col("doc").alias("leaf")).distinct(), "candidate-pairs")
    compared = cut_lineage(_compared(pairs, texts, size, percent), "compared-pairs")
    found = cut_lineage(_links_of(compared), "links")
    off = cut_lineage(_deviations(compared), "deviations")
    forget(compared)
    drop_unused_shuffles(texts.sparkSession)
    tried, cleared, turn, stale = pairs, hubs.select("key", "doc"), 1, []
    members = all_members
    gained = None
    while True:
        homes = connected(found).select(F.col("node").alias("doc"), "component")
        placed = members.join(homes, "doc", "left").withColumn("at", F.coalesce("component", "doc")).drop("component")
        parted = placed.groupBy("key").agg(
            F.min("at").alias("low"), F.max("at").alias("high"), F.max_by("at", weight).alias("main"),
        ).filter("low < high").select("key", "main")
        inside = cut_lineage(placed.join(parted, "key").join(off, ["hub", "doc"], "left"), "parted-buckets")
        forget(homes, *stale)
        drop_unused_shuffles(texts.sparkSession)
        outside = inside.filter("at <> main").join(cleared, ["key", "doc"], "left_anti")
        outside = cut_lineage(outside.alias("y").join(inside.alias("x"), _may_link(percent, True), "left_semi"), "open-members")
        stale = [inside, outside]
        open_buckets = outside.groupBy("key").agg(F.count("*").alias("apart"))
        sizes = inside.groupBy("key").agg(F.count("*").alias("n")).join(open_buckets, "key")
        left, rows, apart = sizes.agg(F.sum(F.col("apart") * F.col("n")), F.sum("n"), F.sum("apart")).first()
        if not left:
            break
        last = left <= FEW * rows or turn >= PIVOT_ROUNDS or (gained is not None and FEW * gained < apart)
        if last:
            pivots = outside
        else:
            pivots = outside.groupBy("key").agg(F.min_by(
                F.struct("doc", "about", "at", "off"), F.struct(F.xxhash64("doc", F.lit(turn)), "doc")).alias("pivot"))
            pivots = cut_lineage(pivots.select("key", "pivot.*"), "pivots")
            cleared = cleared.union(pivots.select("key", "doc"))
        pairs = cut_lineage(_near(inside, pivots, percent).join(tried, ["hub", "leaf"], "left_anti"), "candidate-pairs")
        new = cut_lineage(_links_of(_compared(pairs, texts, size, percent)), "links")
        found, gained = found.union(new), new.count()
        tried, turn = tried.union(pairs), turn + 1
        if last:
            break
    forget(tried, off, hubs, *stale)
    return found


def _may_link(percent: int, placed: bool):
    """Whether two members ``x`` and ``y`` of a bucket, in different components, may be linked for all that is known.

    With D shingles in one of two sets only and n in both counts together, they are linked if (100 + percent) * D is at
    most (100 - percent) * n. D is the number of the hub's shingles that one of them lacks, and of the own shingles of both
    (beyond the hub's) that the other has not; of these at most as many are common as any other leaf shares.
    """
    agree = 128 - sum(F.bit_count(F.col(f"x.about.{s}").bitwiseXOR(F.col(f"y.about.{s}"))) for s in (
        "sketch_a", "sketch_b"))
    n, m = F.col("x.about.n_shingles"), F.col("y.about.n_shingles")
    meets = (F.col("x.key") == F.col("y.key")) & (F.col("x.doc") != F.col("y.doc"))
    meets &= (100 * n >= percent * m) & (100 * m >= percent * n) & (agree >= LEAST_AGREEING)
    if not placed:
        return meets
    of = lambda side, name: F.col(f"{side}.off.{name}")
    apart = of("x", "own") + of("y", "own") - 2 * F.least(of("x", "met"), of("y", "met"))
    differ = F.aggregate(
        F.zip_with(of("x", "lacks"), of("y", "lacks"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    fits = lambda d: F.coalesce((100 + percent) * d <= (100 - percent) * (n + m), F.lit(True))
    return meets & (F.col("x.at") != F.col("y.at")) & fits(apart) & fits(apart + differ)


def _near(many: DataFrame, few: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that may link: one of the ``few`` as hub, one of the ``many`` as leaf."""
    pairs = many.alias("x").join(few.alias("y"), _may_link(percent, "at" in many.columns))
    return pairs.select(F.col("y.doc").alias("hub"), F.col("x.doc").alias("leaf")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by shingle sets with a Jaccard similarity of ``percent`` or more.

    Columns: ``doc_id``, ``n_shingles`` (distinct shingles of ``size`` words; a shorter text is one shingle),
    ``component_id`` (smallest id that links reach, its own included) and ``kept`` (is that smallest one).
    Texts with equal sets are represented by their smallest id before anything else, so copies cost one row
    each. Null and empty texts have no shingles and no links. Rows with the same id are one node; a null id
    has a null component and is not kept. Set members are compared by 64-bit hashes.
    """
    features = cut_lineage(_features(docs, size), "shingle-features")
    named = features.filter("n_shingles > 0 and doc_id is not null")
    first = cut_lineage(named.groupBy("name_a", "name_b").agg(
        F.min("doc_id").alias("doc"), *[F.first(c).alias(c) for c in ("n_shingles", "sketch_a", "sketch_b", "bands")],
    ), "distinct-sets")
    keyed = first.select(F.explode("bands").alias("key"), "doc")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = cut_lineage(keyed.join(shared, "key"), "shared-buckets")
    about = first.select("doc", F.struct("n_shingles", "sketch_a", "sketch_b").alias("about"))
    weighed = met.withColumn("weight", F.sum("n").over(W.partitionBy("doc"))).drop("n")
    members = cut_lineage(weighed.join(about, "doc"), "bucket-members")
    forget(met)
    ids = members.select(F.col("doc").alias("doc_id")).distinct()
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = cut_lineage(every.hint("merge").join(ids, "doc_id", "left_semi"), "member-texts")  # of all others none is compared
    homes = connected(_links(members, texts, size, percent)).select(F.col("node").alias("doc"), "component")
    forget(members, texts)
    groups = first.select("name_a", "name_b", "doc").join(homes, "doc", "left").select(
        "name_a", "name_b", F.coalesce("component", "doc").alias("component"))
    whole = features.select("doc_id", "n_shingles", "name_a", "name_b").join(groups, ["name_a", "name_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, but for those near-duplicate to a document with a smaller id."""
    gone = near_duplicates(docs, size, percent).filter("not kept and doc_id is not null").select("doc_id")
    return docs.join(cut_lineage(gone, "near-duplicates"), "doc_id", "left_anti").select(docs.columns)
