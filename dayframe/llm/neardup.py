"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

Documents with equal shingle sets form a class, and one representative carries the class on. A
class posts itself under each (coordinate, value) pair of its signature. Two sets with a Jaccard
similarity of at least 0.75 agree on 48 of 64 coordinates on average; pairs that agree on at
least ``MATCHES`` are kept, which misses such a pair about once in a million.

*Prefix merging*: to share ``MATCHES`` values, two classes must meet in the rarest
``shared - MATCHES + 1`` of the values that a class shares with any other. Values that no other
class has never help, and most classes drop out here. *Skip merging*: the frequent values beyond
the prefix are not merged at all; the count of a pair met in a prefix is completed by comparing
the two signatures directly.

A list of m classes is never expanded into m^2 pairs. First every member is paired with one random
pivot of its list; confirmed links join components. Lists that then hold a single component are
done, since links inside it would change nothing. The classes of the other lists form families
(connected through such lists). A family's largest component and its other classes are dealt in
blocks of a few hundred; pairs of blocks, other than those inside the largest component, are
compared in one task each, exactly and on the full sets, which emits at most one link per class.

Every link is confirmed on the full shingle sets: 100 * |A and B| >= 75 * |A or B|.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayframe.sources.sinks import work_tables

from .common import WORD, join_groups, shared_path, stored, text_or_empty
from .tokens import text_slices

WIDTH = 5
COORDINATES = 64
MATCHES = 30
PERCENT = 75
BLOCK = 400  # classes of a family compared at a time
CACHE_WORDS = 1 << 20

SKETCH = "doc_id long, thash long, n_shingles long, fp binary, sig array<long>"
SETS = "c long, shingles array<long>"


def _odd(n: int) -> np.ndarray:
    return np.random.default_rng(20240501).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) \
        + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Hashes of texts' shingles. Words are hashed once per worker while they are remembered; the
    memory is emptied at ``CACHE_WORDS`` words."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct 64-bit hashes of each text's shingles: ``width`` consecutive words,
        or all words of a text with fewer; none without words. A-Z is lower-cased."""
        split = [t.lower().split() for t in texts]  # ASCII only, as bytes
        h = self._hashes([w for s in split for w in s])
        n_full = max(0, len(h) - self.width + 1)
        x = _mixed(h[:n_full])
        for j in range(1, self.width):
            x = _mixed(x + h[j:j + n_full])
        out, at = [], 0
        for s in split:
            n = len(s)
            if n >= self.width:
                one = np.unique(x[at:at + n - self.width + 1])
            elif n:
                short = _mixed(np.array([n], np.uint64))  # never equal to a full shingle's start
                for v in h[at:at + n]:
                    short = _mixed(short + v)
                one = short
            else:
                one = np.empty(0, np.uint64)
            out.append(one)
            at += n
        return out


def signatures(sets: list[np.ndarray], k: int = COORDINATES, step: int = 1 << 14) -> np.ndarray:
    """k MinHash values of each non-empty set: the smallest product with each of k odd multipliers.
    All 64 bits are kept: with fewer, the small values of many millions of sets would meet by
    chance. Sets are handled about ``step`` hashes at a time, to stay in the caches."""
    factors = _odd(k)
    out = np.empty((len(sets), k), np.uint64)
    i = 0
    while i < len(sets):
        j, total = i + 1, len(sets[i])
        while j < len(sets) and total + len(sets[j]) <= step:
            total += len(sets[j])
            j += 1
        every = np.concatenate(sets[i:j])
        sizes = np.array([len(s) for s in sets[i:j]])
        starts = np.cumsum(sizes) - sizes
        for f in range(k):
            out[i:j, f] = np.minimum.reduceat(every * factors[f], starts)
        i = j
    return out


_shinglers: dict[int, Shingler] = {}


def _shingler(width: int) -> Shingler:
    return _shinglers.setdefault(width, Shingler(width))


def sketches(docs: DataFrame, width: int = WIDTH, k: int = COORDINATES) -> DataFrame:
    """A row per document: doc_id, thash (64-bit hash of the text), n_shingles, fp (128-bit digest
    of the shingle set) and sig; fp and sig are NULL without shingles."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        import xxhash
        sh = _shingler(width)
        for ids, texts, hashes in _with_hash(batches):
            sets = sh.sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(sets)
            for i, row in zip(full, signatures([sets[i] for i in full], k) if full else (),
                              strict=True):
                sig[i] = row.view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                         pa.binary()),
                pa.array(sig, pa.list_(pa.int64()))],
                names=["doc_id", "thash", "n_shingles", "fp", "sig"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("thash"))
    return rows.mapInArrow(run, SKETCH)


def _with_hash(batches):
    for b in batches:
        at, hashes = 0, b.column(2).to_pylist()
        for ids, texts in text_slices([b]):
            yield ids, texts, hashes[at:at + len(ids)]
            at += len(ids)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): the smallest node b reachable over the edges (a, b), for every other node a.

    Large-star and small-star steps in turn until every component is a star around its smallest
    node, after a number of rounds that grows with the logarithm of the component's size. Each
    step is a minimum over a node's neighbours; a round shuffles three times and writes once.
    """
    def hung(rows: DataFrame) -> DataFrame:
        return rows.withColumn("m", F.least(F.min("b").over(Window.partitionBy("a")), F.col("a")))

    def large_star(e: DataFrame) -> DataFrame:
        """Larger neighbours hang on the smallest one."""
        both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        return hung(e.select(F.inline(both))).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        """Smaller neighbours and the node itself hang on the smallest one."""
        both = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                       F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        return hung(e).select(F.inline(both)).where("a <> b").distinct()

    def settled(e: DataFrame) -> bool:
        sides = F.array(*[F.struct(F.col(c).alias("node"), F.lit(up).alias("up"), F.lit(1 - up).alias(
            "down")) for c, up in (("a", 1), ("b", 0))])
        nodes = e.select(F.inline(sides)).groupBy("node").agg(
            F.sum("up").alias("up"), F.max("down").alias("down"))
        return nodes.agg(F.count_if(F.col("up") + F.col("down") > 1)).first()[0] == 0

    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                           F.least("a", "b").alias("b"))
    while True:
        current = stored(small_star(large_star(current)), "cc")
        if settled(current):
            return current


def _same(a: str, b: str) -> Column:
    """On how many coordinates two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def prefixes(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(c, key): the postings of the prefixes. ``key`` is a 64-bit hash of coordinate and value; two
    that share it by chance only make a prefix longer."""
    posted = classes.select("c", F.posexplode("sig").alias("coordinate", "value")).select(
        "c", F.xxhash64("coordinate", "value").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    lists = posted.join(shared, "key").groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))  # COORDINATES at most
    rare = F.slice("keys", F.lit(1), F.size("keys") - (matches - 1))
    return lists.where(F.size("keys") >= matches).select("c", F.explode(
        F.transform(rare, lambda x: x["key"])).alias("key"))


def _star_pairs(posts: DataFrame, seed: int = 1) -> DataFrame:
    """Every member of a list with the list's pivot, each pair once."""
    pivots = stored(posts.groupBy("key").agg(F.min_by("c", F.xxhash64("c", "key", F.lit(seed))).alias(
        "p"), F.count("*").alias("n")), "near-pivots")
    both = join_groups(posts, pivots, "key", "n").where("c <> p")
    return both.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()


def _families(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, label, family) of the classes in lists that hold several components."""
    rows = stored(_labelled(posts, labels), "near-labelled")
    mixed = stored(rows.groupBy("key").agg(
        F.min("c").alias("first"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.count("*").alias("n")).where("low < high"), "near-mixed")
    edges = join_groups(rows, mixed, "key", "n").select("first", "c", "label")
    found = stars(edges.select(F.col("first").alias("a"), F.col("c").alias("b")).distinct())
    rows = edges.select("c", "label").distinct().join(found, F.col("c") == F.col("a"), "left")
    return rows.select("c", F.coalesce("b", "c").alias("family"), "label")


def _blocks(families: DataFrame, block: int) -> DataFrame:
    """(family, x, y, side, c, label): every class once for each pair of blocks (x, y) that it takes
    part in; ``side`` says of which block. Classes of the family's largest component (``top``)
    have blocks of their own, which are not paired with each other."""
    sizes = families.groupBy("family", "label").agg(F.count("*").alias("n"))
    top = sizes.groupBy("family").agg(F.max_by("label", F.struct("n", "label")).alias("top"),
                                      F.max("n").alias("n_top"), F.sum("n").alias("n_all"))
    rows = families.join(top, "family")
    blocks = lambda n: F.ceil(n / block)
    n_in, n_out = blocks(F.col("n_top")), blocks(F.col("n_all") - F.col("n_top"))
    is_top = F.col("label") == F.col("top")
    mine = F.when(is_top, n_out + F.pmod(F.xxhash64("c"), n_in)).otherwise(
        F.pmod(F.xxhash64("c"), F.greatest(n_out, F.lit(1))))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(
        F.lit(0).cast("long"), F.when(is_top, n_out - 1).otherwise(n_out + n_in - 1))))
    return rows.select("family", F.least("mine", "other").alias("x"),
                       F.greatest("mine", "other").alias("y"),
                       (F.col("mine") <= F.col("other")).alias("side"), "c", "label")


def block_links(classes: list[int], labels: list[int], first: np.ndarray,
                sets: list[np.ndarray], same: bool, percent: int) -> list[tuple[int, int]]:
    """Links between classes of two blocks (``first`` marks one) or inside one (``same``), where
    they join different components; exact on the full sets. At most one less than the classes."""
    n = len(classes)
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    values, at, times = np.unique(every, return_inverse=True, return_counts=True)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), np.uint8)
    parent = {lab: lab for lab in labels}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    left = np.arange(n) if same else np.nonzero(first)[0]
    right = np.arange(n) if same else np.nonzero(~first)[0]
    if not len(left) or not len(right):
        return out
    take = np.concatenate([at[edge[j]:edge[j + 1]] for j in right])
    starts = np.cumsum(sizes[right]) - sizes[right]
    for i in left:
        own = at[edge[i]:edge[i + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[take], starts, dtype=np.int64)
        mark[own] = 0
        near = common * 100 >= (sizes[i] + sizes[right] - common) * percent
        for j in right[near]:
            a, b = root(labels[i]), root(labels[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((classes[i], classes[j]))
    return out


def _family_links(families: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): the components that further links join."""
    def run(table: pa.Table) -> pa.Table:
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        labels = table["label"].to_pylist()
        found = block_links(
            labels, labels,
            np.array(table["side"].to_pylist(), bool),
            [s.values.to_numpy() for s in table["shingles"]], x == y, percent)
        return pa.table({"a": pa.array([p[0] for p in found], pa.int64()),
                         "b": pa.array([p[1] for p in found], pa.int64())})

    rows = _blocks(families, block).join(sets, "c")
    return rows.groupBy("family", "x", "y").applyInArrow(run, "a long, b long")


def _labelled(posts: DataFrame, labels: DataFrame) -> DataFrame:
    return posts.join(labels, F.col("c") == F.col("a"), "left").select(
        "c", "key", F.coalesce("b", "c").alias("label"))


def _agreeing(pairs: DataFrame, classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs whose signatures agree often enough and whose sizes allow the similarity.

    A pivot of long lists is in very many pairs; both joins are plain ones, whose skewed
    partitions Spark splits.
    """
    side = lambda c: classes.select(F.col("c").alias(c), F.col("sig").alias(
        f"{c}_sig"), F.col("n_shingles").alias(f"{c}_n"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    near = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    return both.where(near).where(_same("a_sig", "b_sig") >= matches).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda c, s: sets.select(F.col("c").alias(c), F.col("shingles").alias(s))
    both = pairs.join(side("b", "b_set"), "b").join(side("a", "a_set"), "a")
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, width: int, repeated: bool) -> DataFrame:
    """The shingle sets of the wanted classes, from the texts of their representatives."""
    def run(batches):
        sh = _shingler(width)
        for ids, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()),
                pa.array([s.view(np.int64) for s in sh.sets(texts)], pa.list_(pa.int64()))],
                names=["c", "shingles"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), text.alias("text"),
                       F.xxhash64(text).alias("__hash"))
    found = rows.join(wanted, F.col("__id").eqNullSafe(F.col("rep.doc_id"))
                      & (F.col("__hash") == F.col("rep.thash"))).select("c", "text")
    found = found.dropDuplicates(["c"]) if repeated else found
    return found.mapInArrow(run, SETS)


def links(docs: DataFrame, sketched: DataFrame, classes: DataFrame, width: int, matches: int,
          percent: int, block: int = BLOCK) -> DataFrame:
    """(a, b): the component b of every class a that is linked with another class, but for the
    components themselves."""
    posts = stored(prefixes(classes, matches), "near-posts")
    active = posts.select("c").distinct().join(classes, "c").select("c", "rep")
    repeated = sketched.groupBy("doc_id", "thash").agg(F.count("*").alias("n")).where(
        "n > 1").limit(1).count() > 0
    sets = stored(_sets(docs, active, width, repeated), "near-sets")
    pairs = _agreeing(_star_pairs(posts), classes, matches, percent)
    found = stored(_confirmed(pairs, sets, percent), "near-links")
    first = stars(found)
    families = stored(_families(posts, first), "near-families")
    more = stars(_family_links(families, sets, percent, block))
    moved = more.select(F.col("a").alias("label"), F.col("b").alias("to"))
    return first.join(moved, F.col("b") == F.col("label"), "left").select(
        "a", F.coalesce("to", "b").alias("b")).unionByName(more)


def near_duplicates(docs: DataFrame, width: int = WIDTH, k: int = COORDINATES,
                    matches: int = MATCHES, percent: int = PERCENT) -> DataFrame:
    """The component of every document: doc_id, thash (64-bit hash of the text), n_shingles,
    component_id (the smallest doc_id reachable over links), kept (doc_id = component_id), head
    (the row equals the component's representative, one of those with the smallest doc_id).

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. Texts without
    words have no shingles and are linked with nothing. NULL doc_id takes part, but is never a
    component's id unless the component has no other; such rows are kept only then. Rows with
    equal doc_id are documents of their own; equal rows are equally kept or not. An empty table
    gives an empty result.
    """
    sketched = stored(sketches(docs, width, k), "near-sketches")
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash")
    classes = stored(sketched.where("n_shingles > 0").groupBy("fp").agg(
        F.min(rep).alias("rep"), F.min("doc_id").alias("first"), F.count("*").alias("size"),
        F.any_value("sig").alias("sig"), F.any_value("n_shingles").alias("n_shingles"))
        .withColumn("c", F.monotonically_increasing_id()), "near-classes")
    labels = links(docs, sketched, classes, width, matches, percent)
    named = classes.select("fp", "size", "c", "first", "rep").join(
        labels, F.col("c") == F.col("a"), "left").withColumn(
        "label", F.coalesce("b", "c"))
    heads = named.groupBy(F.col("label").alias("__label")).agg(
        F.min("first").alias("component_id"), F.min("rep").alias("__head"))
    final = stored(named.join(heads, F.col("label") == F.col("__label")).select(
        "fp", "size", "component_id", "__head"), "near-components")
    rows = sketched.select("doc_id", "thash", "n_shingles", "fp")
    out = join_groups(rows.where("n_shingles > 0"), final, "fp", "size").withColumn(
        "head", F.col("doc_id").eqNullSafe(F.col("__head.doc_id"))
        & (F.col("thash") == F.col("__head.thash")))
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn(
        "head", F.lit(True))
    columns = ["doc_id", "thash", "n_shingles", "component_id", "head"]
    return out.select(columns).unionByName(alone.select(columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each component with all its columns: its representative, and one of equal
    rows of it. Texts without words stay."""
    path = shared_path(docs.sparkSession, "near-found")
    with work_tables(docs.sparkSession):
        result = near_duplicates(docs, **options)
        result.write.parquet(path)
    found = docs.sparkSession.read.schema(result.schema).parquet(path)
    with_words = F.col("n_shingles") > 0
    out = found.where(with_words & ~F.col("head")).select(
        F.col("doc_id").alias("__id"), F.col("thash").alias("__thash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__thash"))
    rows = docs.withColumn("__hash", F.xxhash64(text_or_empty())).join(out, same, "left_anti")
    again = found.where(with_words & F.col("head")).groupBy("doc_id", "thash").agg(
        F.count("*").alias("n")).where("n > 1").limit(1).count()
    if again:
        worded = text_or_empty().rlike(WORD)
        rows = rows.withColumn("__row", F.when(~worded, F.monotonically_increasing_id()))
        rows = rows.dropDuplicates(["doc_id", "__hash", "__row"])
    return rows.select(*docs.columns)
