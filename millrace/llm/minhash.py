"""Near-duplicates by word shingles: SuperMinHash signatures, bands, verified links, components.

Each element of a set ranks all places of the signature by a random permutation of its own, step
by step: in step ``j`` it offers ``j`` plus a fraction to the place that is next in its
permutation, and the smallest offer stays. Offers of one element go to different places, which
makes the estimate less variable than with independent ranks. A step later than the worst offer
that stands cannot change anything, so a document stops there: long ones after one step.

Equal sets are one node. Nodes that agree in a whole band meet in a bucket. Pairs are never
listed there: each member is compared with one pivot of its bucket, the member that meets most
others in all its buckets, which is close to what a group of copies was made from. Nodes of
buckets that still hold several classes are compared on, by a prefix filter that loses no
pair: of two similar sets, the rarest elements of the one and of the other share one, if as
many are taken as may be missing. So a copy with too many changes of its own meets nobody.
Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import prepare, staged
from millrace.llm.graph import components

#: Words in a shingle, least similarity in per cent.
WORDS, PERCENT = 5, 85
#: Bands, places in a band: sets of similarity 0.85 share no band once in 1.3 million times.
BANDS, PLACES = 24, 5
#: Members that one block compares with as many; pairs that one copy of a pivot's set meets.
BLOCK = 2048
#: Nodes whose ids and keys, some 64 bytes each, are sent to every task.
BROADCAST = 1 << 17
#: Sizes of sets whose ratio is below this are one class of sizes.
SIZES = 1.03
#: Shingles whose offers are made at once.
AT_ONCE = 1 << 15

_STEP, _ALL, _MIX = 0x9E3779B97F4A7C15, (1 << 64) - 1, (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all others."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the distinct shingles, sorted."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and the six separators asked for
    each = text.encode("utf-8", "replace").lower().split() if text else []
    if not each:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, each), np.uint64, len(each))
    size = min(words, len(each))
    found = np.full(len(each) - size + 1, size, np.uint64)
    for i in range(size):
        found = _mixed(found + np.uint64(_STEP)) ^ hashes[i : len(each) - size + 1 + i]
    return np.unique(_mixed(found))


def _offer(best: np.ndarray, items: np.ndarray, owner: np.ndarray) -> None:
    """Lower ``best``, one row a document, by the offers of its elements."""
    size, places = best.shape[1], None
    flat = best.reshape(-1)
    for step in range(size):
        bits = _mixed(items + np.uint64((step + 1) * _STEP & _ALL))
        rank = (bits >> _HALF) | (np.uint64(step) << _HALF)
        at = ((bits & _LOW) * np.uint64(size - step) >> _HALF).astype(np.int64) + step
        slot = at if places is None else places[np.arange(len(items)), at]
        np.minimum.at(flat, owner * size + slot, rank)
        # on with those documents that a later step may still change
        on = (best >= np.uint64(step + 1) << _HALF).any(axis=1)[owner]
        if not on.any():
            return
        items, owner, at = items[on], owner[on], at[on]
        places = np.tile(np.arange(size, dtype=np.uint16), (len(items), 1)) if places is None else places[on]
        places[np.arange(len(items)), at] = places[:, step]


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """The SuperMinHash signature of each set that is not empty; one row each."""
    best = np.full((len(sets), size), np.iinfo(np.uint64).max, np.uint64)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= AT_ONCE):
            total += len(sets[end])
            end += 1
        items = np.concatenate(sets[start:end])
        owner = np.repeat(np.arange(end - start), [len(s) for s in sets[start:end]])
        for at in range(0, total, AT_ONCE):
            _offer(best[start:end], items[at : at + AT_ONCE], owner[at : at + AT_ONCE])
        start = end
    return best


def band_keys(found: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = found.reshape(len(found), bands, -1)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for i in range(parts.shape[2]):
        keys = _mixed(keys + np.uint64(_STEP)) ^ parts[:, :, i]
    return _mixed(keys).view(np.int64)


def _sketch(words: int, bands: int, places: int) -> Column:
    """``n, key, bands`` of a text: shingles, a digest of their set, bucket keys (none for an empty set)."""

    @F.arrow_udf("struct<n: bigint, key: binary, bands: array<bigint>>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets = [shingle_set(t.as_py(), words) for t in texts]
            keys = band_keys(signatures(sets, bands * places), bands)
            counts = np.array([len(s) for s in sets], np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[counts > 0].reshape(-1)))
            digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.StructArray.from_arrays([pa.array(counts), digests, lists], ["n", "key", "bands"])

    return sketch


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have that similarity, in whole numbers."""
    low, high = sorted((len(a), len(b)))
    if not low or 100 * low < percent * high:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirmed(percent: int) -> Column:
    @F.arrow_udf("boolean")
    def confirm(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent) for a, b in zip(left, right, strict=True)], pa.bool_())

    return confirm


def _links(pairs: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Those of the distinct pairs ``a, b`` whose sets are similar; sets that many ask for go out in copies."""
    pairs = staged(pairs.distinct(), "pairs")
    hot = pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > block)
    hot = hot.select("b", F.ceil(F.col("n") / block).cast("int").alias("copies"))
    part = F.coalesce(F.pmod(F.xxhash64("a"), F.col("copies")), F.lit(0)).cast("int").alias("part")
    pairs = pairs.join(hot, "b", "left").select("a", "b", part)
    sets = sets.select("node", "hashes")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
    parts = F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)
    right = sets.withColumnRenamed("node", "b").join(hot, "b", "left").select("b", F.col("hashes").alias("right"), F.explode(parts).alias("part"))
    found = left.join(right, ["b", "part"])
    return staged(found.where(_confirmed(percent)("left", "right")).select("a", "b"), "links")


def _sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, n, hashes`` of the wanted nodes, from the text of the row that they are named after."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = [], []
            for node, key, text in zip(*batch.columns, strict=True):
                hashes = shingle_set(text.as_py(), words)
                # other rows may have the same id
                if xxhash.xxh3_128_digest(hashes.tobytes()) == key.as_py():
                    nodes.append(node.as_py())
                    found.append(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array([len(h) for h in found], pa.int64()), pa.array([h.tobytes() for h in found], pa.binary())], ["node", "n", "hashes"]
            )

    wanted = staged(wanted.select("node", "key", F.col("first").alias("doc_id")), "wanted")
    # few enough to go to every task: then no text is moved
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    found = rows.join(few, "doc_id").select("node", "key", "text").mapInArrow(sets, "node long, n long, hashes binary")
    return staged(found.dropDuplicates(["node"]), "sets")


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Elements that similar sets of these sizes share at least."""
    return F.ceil(percent * (n + m) / (100 + percent))


def _prefixes(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``key, side, node, class, n, place``: where nodes that may be similar meet, for all such pairs.

    So in any order of all elements, the first common one of two similar sets is at a place that
    leaves as many as they must share, in the one as in the other. Rare elements come first; those
    that one node alone has count for its places and meet nobody. Sizes go by classes, as more
    have to be taken for partners of other sizes: a key is for one pair of classes, and its sides
    are the two (2 where both are the same).
    """

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, hashes in zip(*batch.columns, strict=True):
                found = np.frombuffer(hashes.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node.as_py(), np.int64)), pa.array(found)], ["node", "element"])

    given = rest.join(sets, "node").select("node", "hashes").mapInArrow(elements, "node long, element long")
    given = staged(given, "elements")
    shared = given.groupBy("element").agg(F.count("*").alias("times")).where("times > 1")
    known = given.join(shared, "element").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("times", "element"))).alias("common"))
    known = known.join(rest, "node").join(sets.select("node", "n"), "node")

    def size_class(size: Column) -> Column:
        return F.floor(F.log(size) / np.log(SIZES)).cast("int")

    own, n = size_class(F.col("n")), F.col("n")
    lowest, highest = size_class(F.ceil(n * percent / 100)), size_class(F.floor(n * 100 / percent))
    known = known.select("*", own.alias("own"), (n - F.size("common")).alias("alone"), F.explode(F.sequence(lowest, highest)).alias("other"))
    # the smallest partner of its class; a hair less, as powers are rounded
    least = F.greatest(F.ceil(F.pow(F.lit(SIZES), F.col("other")) * (1 - 1e-9)), F.ceil(n * percent / 100))
    taken = (n - _overlap(n, least, percent) + 1 - F.col("alone")).cast("int")
    known = known.where(taken > 0).select("node", "class", "n", "own", "other", "alone", F.posexplode(F.slice("common", F.lit(1), taken)).alias("at", "e"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    key = F.xxhash64("e.element", F.least("own", "other"), F.greatest("own", "other"))
    return known.select(key.alias("key"), side.alias("side"), "node", "class", "n", (F.col("alone") + F.col("at")).alias("place"))


def _across(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs that meet on two sides of a key, from two classes: rows outside its largest class with all others.

    A pair may come out several times. It is left out where its elements behind the place are too few.
    """
    rows = staged(rows, "meeting")
    sizes = rows.groupBy("key", "class").agg(F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
    mixed = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"), F.min("low").alias("low"), F.max("high").alias("high"))
    mixed = mixed.where((F.col("n") > F.col("main.n")) & ((F.col("low") < F.col("high")) | (F.col("low") == 2)))
    all_blocks, own_blocks = F.ceil(F.col("n") / block).cast("long"), F.ceil((F.col("n") - F.col("main.n")) / block).cast("long")
    mixed = mixed.select("key", F.col("main.class").alias("main"), all_blocks.alias("all_blocks"), own_blocks.alias("own_blocks"))
    rows = rows.join(mixed, "key")
    own, other = F.pmod(F.xxhash64("node"), F.col("own_blocks")), F.pmod(F.xxhash64("node"), F.col("all_blocks"))
    facing = F.when(F.col("side") == 2, 2).otherwise(1 - F.col("side")).alias("side")
    left = rows.where(F.col("class") != F.col("main")).select(
        "key", facing, F.col("node").alias("a"), F.col("class").alias("c"), F.col("n").alias("s"), F.col("place").alias("p"), own.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("j")
    )
    right = rows.select(
        "key", "side", F.col("node").alias("b"), F.col("class").alias("d"), F.col("n").alias("t"), F.col("place").alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("own_blocks") - 1)).alias("i"), other.alias("j")
    )
    enough = F.least(F.col("s") - F.col("p"), F.col("t") - F.col("q")) >= _overlap(F.col("s"), F.col("t"), percent)
    return left.join(right, ["key", "side", "i", "j"]).where((F.col("c") != F.col("d")) & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(
    df: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, places: int = PLACES, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row.

    ``n_shingles`` is the size of the set of distinct shingles, ``component_id`` the smallest id
    reachable over links of ``percent`` or more common shingles, and ``kept`` says that it is the
    row's own. A text of fewer words is one shingle. Null, empty and blank texts have the empty
    set and are linked with nothing. Equal rows each keep their row; rows of one id are the same
    document to the result, whatever they are linked with. Rows with a null id are counted, but
    link nothing, and have a null ``component_id`` and ``kept``. An empty table gives an empty
    result; other columns, whatever their names, are left out.
    """
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = staged(rows.select("doc_id", _sketch(words, bands, places)("text").alias("s")).select("doc_id", "s.*"), "sketches")
    known = sketched.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # one node for each set; numbered once it is written
    nodes = known.groupBy("key").agg(F.min("doc_id").alias("first"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "first", "n", "bands"), "nodes")
    listed = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = listed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(listed.join(buckets, "bucket"), "members")
    sets = _sets(rows, nodes.join(members.select("node").distinct(), "node"), words)
    # a. members against the pivots of their buckets
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = members.join(weights, "node")
    pivots = weighed.groupBy("bucket").agg(F.max_by("node", F.col("weight") * 4096 + F.pmod(F.xxhash64("node"), F.lit(4096))).alias("pivot"))
    pairs = members.join(pivots, "bucket").where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    classes = components(_links(pairs, sets, percent, block))
    # b. buckets that still hold several classes; a bucket of two was compared in full
    named = members.where("size > 2").select("bucket", "node").join(classes, "node", "left")
    named = named.select("bucket", "node", F.coalesce("root", "node").alias("class"))
    mixed = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    rest = staged(named.join(mixed, "bucket", "left_semi").select("node", "class").distinct(), "rest")
    more = _across(_prefixes(rest, sets, percent), percent, block)
    classes = components(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).union(_links(more, sets, percent, block)))
    rooted = nodes.join(classes, "node", "left").select("key", "first", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("key", "component_id")
    found = sketched.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("key")).alias("key")).join(named, "key", "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
