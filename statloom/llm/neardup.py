"""MinHash near-duplicates with tensored banding.

Two small collections of half keys, each of `HALF` MinHash values, are combined in pairs into table
keys: `SIDE` times `SIDE` tables for 2 * SIDE * HALF MinHash values instead of SIDE * SIDE * 2 * HALF.
Two documents meet if they share a half key of either side. At a similarity of 0.85 the chance to
miss that is about 2 in 100,000. Candidates are confirmed on their full shingle sets.

Documents with equal sets are one node from the start. The node that shares most half keys with others
leads a bucket, and each node is first compared with the best leader it meets only. Buckets that then
hold several components are contested. A node there can only have links if few of its shingles are its
own, and two nodes only if what they may share is enough for their sizes; that is exact and needs
counts only. What is left is compared: the few nodes outside a bucket's largest component with all
others by a join, or, where they are not few, block by block within buckets of `FINE` values that share
none: blocks hold signatures as matrices and full sets, and only links that join components leave as
rows. Values in disjoint buckets are independent, so at a similarity of 0.85 a pair of crowded
buckets is missed about twice in a million, less often than one of few members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx
from statloom.llm.components import components
from statloom.session import materialise

SHINGLE = 5
PERCENT = 85
HALF = 3
SIDE = 12
HASHES = 2 * SIDE * HALF
# A pair at the threshold has fewer equal MinHash values than this about once in a million.
LEAST_EQUAL = 46
FEW = 32
FINE = 4
BLOCK = 2048

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_RNG = np.random.default_rng(5)
FLIPS = _RNG.integers(1 << 63, size=HASHES, dtype=np.uint64)
FACTORS = _RNG.integers(1 << 63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and where those of each text begin."""
    data = LOWER[data]
    starts, ends, owner = tx.words(data, offsets)
    hashes = tx.span_hashes(data, starts, ends)
    n_texts = len(offsets) - 1
    counts = np.bincount(owner, minlength=n_texts)
    whole = np.flatnonzero(tx.complete(owner, SHINGLE))
    shingles, owners = [tx.windows(hashes, SHINGLE)[whole]], [owner[whole]]
    first = np.cumsum(counts) - counts
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        places = first[short]
        value = np.zeros(len(short), dtype=np.uint64)
        for i in range(n):
            value = value * tx.CHAIN + hashes[places + i]
        shingles.append(tx.mix(value ^ np.uint64(n)))
        owners.append(short)
    value, of = np.concatenate(shingles), np.concatenate(owners)
    _, index = np.unique(value ^ tx.mix(of.astype(np.uint64) + np.uint64(1)), return_index=True)
    index = index[np.argsort(of[index], kind="stable")]
    return value[index], np.searchsorted(of[index], np.arange(n_texts + 1))


SIGNATURE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_shingles", "fp1", "fp2")] + [T.StructField("signature", T.ArrayType(T.IntegerType()))]
)


@F.arrow_udf(SIGNATURE)
def signatures(texts: pa.Array) -> pa.Array:
    """Size, 128-bit fingerprint and MinHash values of each text's shingle set."""
    out = []
    for data, offsets in tx.pieces(texts):
        values, bounds = shingle_sets(data, offsets)
        sizes = np.diff(bounds)
        filled = np.flatnonzero(sizes)
        begins = bounds[:-1][filled]
        prints = np.zeros((2, len(sizes)), dtype=np.uint64)
        hashed = np.zeros((len(sizes), HASHES), dtype=np.int32)
        if len(filled):
            for i in range(2):
                prints[i, filled] = np.add.reduceat(tx.mix(values ^ FLIPS[i]), begins)
            for i in range(HASHES):
                least = np.minimum.reduceat(((values ^ FLIPS[i]) * FACTORS[i]) >> np.uint64(32), begins)
                hashed[filled, i] = least.astype(np.uint32).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, hashed.size + 1, HASHES, dtype=np.int32)), pa.array(hashed.ravel()))
        parts = [pa.array(sizes.astype(np.int64)), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)), lists]
        out.append(pa.StructArray.from_arrays(parts, SIGNATURE.names))
    return pa.concat_arrays(out) if out else pa.array([], pa.struct([(f, t) for f, t in zip(SIGNATURE.names, [pa.int64()] * 3 + [pa.list_(pa.int32())])]))


@F.arrow_udf(T.ArrayType(T.LongType()))
def full_sets(texts: pa.Array) -> pa.Array:
    out = []
    for data, offsets in tx.pieces(texts):
        values, bounds = shingle_sets(data, offsets)
        out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64))))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))


def half_keys() -> Column:
    """The half keys of both sides as (side, key)."""
    def one(i: Column) -> Column:
        values = F.slice("signature", i * HALF + 1, F.lit(HALF))
        return F.struct((i >= SIDE).cast("int").alias("side"), F.xxhash64(i, values).alias("half"))

    return F.explode(F.transform(F.sequence(F.lit(0), F.lit(2 * SIDE - 1)), one))


def shared_halves(nodes: DataFrame) -> DataFrame:
    """Per node the half keys of either side that some other node has too, and how many have them."""
    halves = nodes.select("node", half_keys().alias("h")).select("node", "h.*")
    shared = materialise(halves.groupBy("half").count().where("count > 1"), "halves")
    return halves.join(shared, "half").groupBy("node").agg(
        F.sum("count").alias("weight"), *[F.collect_list(F.when(F.col("side") == s, F.col("half"))).alias(f"side{s}") for s in (0, 1)]
    )


def table_keys(halves: DataFrame) -> DataFrame:
    crossed = F.flatten(F.transform("side0", lambda a: F.transform("side1", lambda b: F.xxhash64(a, b))))
    return halves.select("node", "weight", F.explode(crossed).alias("key"))


def fine_keys(nodes: DataFrame) -> DataFrame:
    """Table keys of `FINE` values each, no value in two; a pair at the threshold misses all with
    probability (1 - 0.85 ** 4) ** 18, about 1.7 in a million."""
    key = lambda i: F.struct(F.xxhash64(i, F.slice("signature", i * FINE + 1, F.lit(FINE))).alias("key"), i.alias("fine"))
    return nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(HASHES // FINE - 1)), key)).alias("k")).select("node", "k.*")


def may_link(na: str, ua: str, nb: str, ub: str) -> Column:
    """Whether sizes `n`, of which `u` shingles no other contested node has, allow a link."""
    common = F.least(F.col(na) - F.col(ua), F.col(nb) - F.col(ub))
    return 100 * common >= PERCENT * (F.col(na) + F.col(nb) - common)


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (`a`, `b`) whose sizes allow the similarity and whose signatures come near it."""
    facts = nodes.select("node", "n_shingles", "signature")
    left = facts.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    right = facts.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    return pairs.join(left, "a").join(right, "b").where(fits).withColumn("equal", equal).where(F.col("equal") >= LEAST_EQUAL).select("a", "b", "equal")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links by their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", common)
    return joined.where(100 * F.col("common") >= PERCENT * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


class Links:
    """Confirmed links and the components they form so far."""

    def __init__(self, nodes: DataFrame, sets: DataFrame):
        self.nodes, self.sets = nodes, sets
        self.edges: DataFrame | None = None
        self.labels = nodes.sparkSession.createDataFrame([], "node long, label long")

    def test(self, pairs: DataFrame) -> None:
        """Confirm pairs and join the components of those that are links."""
        self.add(confirm(likely(pairs, self.nodes), self.sets))

    def add(self, links: DataFrame) -> None:
        """Join the components of confirmed links."""
        found = materialise(links, "links")
        if found.isEmpty():
            return
        self.edges = found if self.edges is None else self.edges.unionByName(found)
        self.labels = components(self.edges)


def best_leaders(members: DataFrame) -> DataFrame:
    best = members.groupBy("node").agg(F.max("lead").alias("lead"))
    return best.select(F.col("node").alias("a"), F.col("lead.node").alias("b")).where("a <> b")


def contested(members: DataFrame, labels: DataFrame) -> DataFrame:
    """`key`, `node`, `label` of members of buckets that hold more than one component."""
    labelled = members.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    labelled = materialise(labelled, "labelled")
    several = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return labelled.join(materialise(several.select("key"), "contested-keys"), "key")


def linkable(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Nodes of `members` that may have links, with `n` and `u`: their shingles, and those of them that
    no other of these nodes has."""
    nodes = materialise(members.select("node").distinct(), "contested-nodes")
    every = sets.join(nodes, "node").select("node", F.explode("shingles").alias("shingle"))
    single = every.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    alone = single.groupBy("node").agg(F.count("*").alias("u"))
    sizes = sets.join(nodes, "node").select("node", F.size("shingles").cast("long").alias("n"))
    known = sizes.join(alone, "node", "left").select("node", "n", F.coalesce("u", F.lit(0).cast("long")).alias("u"))
    return known.where(100 * (F.col("n") - F.col("u")) >= PERCENT * F.col("n"))


def divided(members: DataFrame) -> DataFrame:
    """Add whether a member is `outside` its bucket's largest component, how many are, and how many
    members there are; buckets of one component leave."""
    shares = members.groupBy("key", "label").count().groupBy("key")
    stats = shares.agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    stats = materialise(stats.select("key", F.col("top.label").alias("main"), (F.col("all") - F.col("top.count")).alias("n_outside"), F.col("all").alias("n_all")), "divided")
    return members.join(stats, "key").withColumn("outside", F.col("label") != F.col("main")).drop("main")


def outsider_pairs(members: DataFrame) -> DataFrame:
    """Pairs of an outside node and a node of another component that sizes allow."""
    one = members.where("outside").select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("u").alias("ua"))
    other = members.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("u").alias("ub"), "outside")
    new = (F.col("la") != F.col("lb")) & (~F.col("outside") | (F.col("a") < F.col("b")))
    joined = one.join(other, (one["key"] == other["key"]) & new & may_link("na", "ua", "nb", "ub"))
    return joined.select("a", "b").distinct()


def local_links(label: np.ndarray, candidate: np.ndarray, one: np.ndarray, other: np.ndarray, flat: np.ndarray, begins: np.ndarray) -> list[tuple[int, int]]:
    """Links among the candidate pairs (a row of `one`, a column of `other`) that join components of
    `label` which the links before have not joined. Shingles of row i are flat[begins[i] : begins[i + 1]],
    as small numbers."""
    component = np.unique(label, return_inverse=True)[1]
    size = np.diff(begins)
    mine = np.zeros(int(flat.max(initial=-1)) + 1, dtype=bool)
    found = []
    for row, a in enumerate(one):
        near = other[candidate[row]]
        near = near[component[near] != component[a]]
        if not len(near):
            continue
        own = flat[begins[a] : begins[a + 1]]
        mine[own] = True
        stops = np.cumsum(size[near])
        take = np.arange(stops[-1]) + np.repeat(begins[near] - (stops - size[near]), size[near])
        common = np.add.reduceat(mine[flat[take]].astype(np.int64), stops - size[near])
        mine[own] = False
        for b in near[100 * common >= PERCENT * (size[a] + size[near] - common)]:
            if component[b] != component[a]:
                component[component == component[b]] = component[a]
                found.append((a, b))
    return found


def blocked_links(members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components within fine buckets, enough to join all that are linked there.

    A bucket is dealt into blocks of some `BLOCK` members, and every two of its blocks are a group of
    their own, so a bucket of any size is many groups of bounded size. In a group the pairs that sizes
    allow and whose signatures come near the threshold, in the first bucket that they share, are
    confirmed on full sets; a pair of components that earlier links have joined is left out.
    """

    def compared(key: tuple, table: pa.Table) -> pa.Table:
        low, high, fine = (k.as_py() for k in key[1:])
        order = np.argsort(table["node"].to_numpy())
        table = table.take(pa.array(order))
        node, label, block = (table[c].to_numpy() for c in ("node", "label", "block"))
        n, u = table["n"].to_numpy().astype(float), table["u"].to_numpy()
        values = table["signature"].combine_chunks().flatten().to_numpy().reshape(len(node), HASHES)
        shingles = table["shingles"].combine_chunks()
        flat = np.unique(shingles.flatten().to_numpy(), return_inverse=True)[1]
        begins = np.append(0, np.cumsum(shingles.value_lengths().to_numpy()))
        one, other = np.flatnonzero(block == low), np.flatnonzero(block == high)
        candidate = np.zeros((len(one), len(other)), dtype=bool)
        for start in range(0, len(one), 256):
            part = one[start : start + 256]
            equal = np.zeros((len(part), len(other)), dtype=np.int16)
            earlier = np.zeros(equal.shape, dtype=bool)
            for i in range(HASHES):
                same = values[part, i][:, None] == values[other, i]
                equal += same
                bucket = same if i % FINE == 0 else bucket & same
                if i % FINE == FINE - 1 and i // FINE < fine:
                    earlier |= bucket
            common = np.minimum((n - u)[part][:, None], (n - u)[other])
            total = n[part][:, None] + n[other]
            new = (label[part][:, None] != label[other]) & (equal >= LEAST_EQUAL) & ~earlier & (100 * common >= PERCENT * (total - common))
            if low == high:
                new &= part[:, None] < other
            candidate[start : start + 256] = new
        pairs = np.array(local_links(label, candidate, one, other, flat, begins), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    sized = members.withColumn("blocks", F.ceil(F.col("n_all") / BLOCK).cast("int"))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = met.select("key", "fine", "node", "label", "n", "u", "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    facts = nodes.select("node", "signature").join(sets, "node")
    return paired.join(facts, "node").groupBy("key", "low", "high", "fine").applyInArrow(compared, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `doc_id`, `text_hash`, `n_shingles`, `component_id`, `kept`.

    `component_id` is the smallest id reachable over links of at least `PERCENT` percent, `kept` tells
    whether the row has it. Null, empty and blank texts have no shingles and are linked with nothing:
    `component_id` is their own id. Rows with a null id can be linked, but name no component; if no
    reachable row has an id, `component_id` is null and the row is kept. Repeated rows get the same
    result. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), signatures(F.col(text_col).cast("binary")).alias("s"))
    rows = materialise(rows.select("doc_id", "text_hash", "s.*"), "signatures")
    same = ["fp1", "fp2", "n_shingles"]
    groups = rows.where("n_shingles > 0").groupBy(*same).agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("sample"), F.first("signature").alias("signature")
    )
    nodes = materialise(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = link_nodes(nodes, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = materialise(labelled.select("label", *same).join(smallest, "label").drop("label"), "components")
    spoken = rows.where("n_shingles > 0").drop("signature").join(named, same)
    silent = rows.where("n_shingles = 0").drop("signature").withColumn("component_id", F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return spoken.unionByName(silent).select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"))


def link_nodes(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Component labels of the nodes that have links."""
    keys = table_keys(materialise(shared_halves(nodes), "shared-halves"))
    buckets = keys.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = materialise(keys.join(materialise(buckets, "buckets"), "key").select("key", "node", "lead"), "members")
    meeting = members.select("node").distinct()
    links = Links(nodes, materialise(sets_of(meeting.join(nodes, "node"), texts), "sets"))
    links.test(best_leaders(members))
    rest = materialise(contested(members, links.labels), "contested")
    able = materialise(linkable(rest, links.sets), "linkable")
    rest = materialise(divided(rest.join(able, "node")), "members")
    links.test(outsider_pairs(rest.where(F.col("n_outside") <= FEW)))
    crowded = materialise(rest.where(F.col("n_outside") > FEW).select("node").distinct().join(able, "node"), "crowded")
    if not crowded.isEmpty():
        finer = fine_keys(nodes.join(crowded.select("node"), "node")).join(crowded, "node").join(links.labels, "node", "left")
        finer = materialise(finer.withColumn("label", F.coalesce("label", "node")), "fine-keys")
        links.add(blocked_links(divided(finer), nodes, links.sets))
    return links.labels


def sets_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Full shingle sets of nodes, from the one text that stands for each."""
    wanted = nodes.select("node", F.col("sample.doc_id").alias("of_doc"), F.col("sample.text_hash").alias("of_hash"))
    same = (F.xxhash64("text") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    found = texts.join(wanted, same).select("node", full_sets(F.col("text").cast("binary")).alias("shingles"))
    return found.dropDuplicates(["node"])
