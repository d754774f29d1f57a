"""Join of documents by the Jaccard similarity of their word shingles, in metric space.

The Jaccard distance is a metric, so a document near a pivot's neighbour is near the pivot too. The
join works down from large regions to small ones:

1. Documents of equal shingle sets form a class; one stands for all.
2. Two documents without a common shingle are at distance 1, where no pivot tells them apart. So the
   first regions hold documents that share a rare shingle. By the usual prefix argument, a pair at the
   threshold meets in one of the rarest quarter of the shingles of either, counted over the documents;
   passages that many documents share are the commonest, and make no region for them. To spare the
   others the full count, documents first show a sketch, their ``SKETCH`` least shingle hashes. A pair
   at the threshold shares on average three in four of them, and fewer than ``SHARED`` with a chance
   of 4e-16, about that of a hash collision (short texts show all, where the bound is certain). Only
   documents whose sketch meets another's this way go on, and these with all their shingles.
3. First rounds: a region elects a few pivots, by a rank of all documents, so that regions with the
   same documents elect the same ones. Each pivot is compared with the members outside its component,
   and leaves with all its links found. Members of one component need not be compared, so most
   regions of near copies are done once their pivots have tied them together.
4. What a region holds beside its largest component are its outliers; every pair that is left has one.
   A region of many outliers elects ``PIVOTS``, and every member's distance to each is computed
   exactly. A core member's home is its nearest pivot, the Voronoi region; a linked pair lies within
   the radius, so by the triangle inequality the other is at most two radii further from that pivot
   than from its own home. Members inside that window are copied to the region; there they are
   compared with its core only. Such regions are joined by the same steps again.
5. A region of few pairs adds them to the distinct pairs of all such regions. The others, if their
   outliers are few, become one for each largest component, as its documents meet in many regions.
   There, blocks of outliers stay in a task while the members stream past: a member is a row for each
   block, never one for each pair. Only sets of fitting sizes, in different components, are compared,
   and a tile reports one link between two components.

Every link is decided by the exact shingle sets. Copies in one component are never compared with each
other. Outliers that share rare shingles with a large group and link with none of it are compared
with all of it: in tiles their time, not their rows, grows with the square of such a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.components import components
from martloom.llm.shingles import mix, shingle_sets
from martloom.operators.lookup import bounded
from martloom.session import written

# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
SKETCH = 48
SHARED = 10
# At first; each level elects this many times more, so that few levels exhaust a region whose
# members neither link nor lie apart.
PIVOTS = 8
MORE = 4
# Pivots of each region in the first rounds.
ROUNDS = (1, 4)
# Outliers of a region that is joined in tiles: at first, and later per pivot of the level.
LEAF = 1024
LEAF_PER_PIVOT = 128
# Pairs of a region that is not joined in tiles.
PAIRS = 1024
# Outliers of a tile, and members that pass them in one task.
BLOCK = 256
LOT = 2048
# Members compared with one copy of a pivot's set in one run.
RUN = 256


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the jobs so far given back.

    Spark deletes them once the driver's JVM has collected their plans, which a roomy heap puts off
    for as long as the join runs; so it is asked to collect now.
    """
    table = written(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return table


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def _utf8(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the size ``n`` of its shingle set, two digests of the set and its sketch."""

    def run(batches):
        for batch in batches:
            ns, h1, h2, least = [], [], [], []
            for s in shingle_sets(_utf8(batch.column("text"))):
                ns.append(len(s))
                h1.append(np.add.reduce(s, dtype=np.uint64).astype(np.int64))
                h2.append(np.bitwise_xor.reduce(mix(s), initial=np.uint64(0)).astype(np.int64))
                least.append(s[:SKETCH].view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n": ns, "h1": h1, "h2": h2, "sketch": least},
                schema=schema,
            )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())]
        + [("sketch", pa.list_(pa.int64()))]
    )
    ddl = "doc_id BIGINT, n BIGINT, h1 BIGINT, h2 BIGINT, sketch ARRAY<BIGINT>"
    return _texts(docs, doc_id, text).mapInArrow(run, ddl)


def _rarest(shown: DataFrame, shared: int | None) -> DataFrame:
    """``region`` and ``node``: the rarest hashes of each document that another one shows too.

    ``shown`` holds ``node``, its ``set`` (a doc_id may come with several) of size ``n``, and a
    ``region`` for each hash that it shows.
    A linked pair shares at least PERCENT of the larger set's hashes, or ``shared``, if fewer are
    sure. So of a document's hashes, rarest first, all but one fewer than that are enough.
    """
    counts = shown.groupBy("region").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    needed = F.ceil(F.col("n") * PERCENT / 100)
    if shared is not None:
        needed = F.least(F.lit(shared), needed)
    rank = F.row_number().over(Window.partitionBy("node", "set").orderBy("f", "region"))
    size = F.count(F.lit(1)).over(Window.partitionBy("node", "set"))
    return (
        shown.join(counts, "region")
        .select("region", "node", rank.alias("rank"), (size - needed + 1).alias("kept"))
        .filter("rank <= kept")
        .select("region", "node")
    )


def _shingles_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and its packed shingle set, where it has any."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                packed = [s.tobytes() for s in shingle_sets(_utf8(part.column("text")))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(packed, pa.binary())], ["node", "packed"]
                )

    wanted = docs.join(bounded(nodes.withColumnRenamed("node", "doc_id")), "doc_id")
    # A doc_id may come with a text without words beside one that has some.
    sets = wanted.select("doc_id", "text").mapInArrow(run, "node BIGINT, packed BINARY")
    return sets.filter(F.octet_length("packed") > 0)


def _meeting(regions: DataFrame) -> DataFrame:
    """The regions that hold more than one document."""
    several = regions.groupBy("region").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    return regions.join(several, "region", "left_semi")


def _unpacked(sets: DataFrame) -> DataFrame:
    """``node, set, n, region`` for each shingle of each set."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                rows = [np.frombuffer(p, dtype=np.int64) for p in part.column("packed").to_pylist()]
                n = np.array([len(r) for r in rows], dtype=np.int64)
                nodes = part.column("node").to_numpy()
                digest = np.array([np.add.reduce(r) for r in rows], dtype=np.int64)
                columns = [*(np.repeat(x, n) for x in (nodes, digest, n)), np.concatenate(rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["node", "set", "n", "region"]
                )

    return sets.mapInArrow(run, "node BIGINT, set BIGINT, n BIGINT, region BIGINT")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, shared, total``: the sizes of the intersection and union of each pair's sets.

    The sets of all ``a`` stream past the set of their ``b``; a ``b`` with many partners is dealt
    out in runs of ``RUN``, each with a copy of its set.
    """

    def run(batches):
        key, right = None, []
        for batch in batches:
            out = []
            for b, lot, a, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                s = np.frombuffer(packed, dtype=np.uint64)
                if a is None:
                    # Rows that repeat a doc_id bring a set each.
                    right = [s] if key != (b, lot) else [*right, s]
                    key = (b, lot)
                    continue
                best = (0, 1)
                for r in right if key == (b, lot) else []:
                    at = np.minimum(np.searchsorted(r, s), len(r) - 1)
                    shared = int(np.count_nonzero(r[at] == s))
                    total = len(r) + len(s) - shared
                    if shared * best[1] >= best[0] * total:
                        best = (shared, total)
                out.append((a, b, *best))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b", "shared", "total"]
            )

    lots = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / RUN).alias("lots"))
    left = (
        pairs.join(lots, "b")
        .select("a", "b", F.pmod(F.xxhash64("a"), "lots").alias("lot"))
        .join(sets.withColumnRenamed("node", "a"), "a")
        .select("b", "lot", "a", "packed")
    )
    right = lots.join(sets.withColumnRenamed("node", "b"), "b").select(
        "b",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lots") - 1)).alias("lot"),
        F.lit(None).cast("bigint").alias("a"),
        "packed",
    )
    rows = right.unionByName(left).repartition("b", "lot").sortWithinPartitions("b", "lot", "a")
    return rows.mapInArrow(run, "a BIGINT, b BIGINT, shared BIGINT, total BIGINT")


def _linked() -> F.Column:
    return F.col("shared") * 100 >= F.col("total") * PERCENT


def _windows(members: DataFrame, met: DataFrame, pivots: DataFrame) -> DataFrame:
    """The Voronoi regions of the pivots, with the members in their windows.

    A region is named after its pivot, so that the many regions that elected it become one.
    """
    distance = met.select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), (1 - F.col("shared") / F.col("total")).alias("d")
    )
    placed = (
        members.join(pivots, "region")
        .filter("node <> pivot")
        .join(distance, ["node", "pivot"])
        # Pivots have been compared with every member: they are done.
        .join(pivots.select("region", F.col("pivot").alias("node")), ["region", "node"], "left_anti")
    )
    home = Window.partitionBy("region", "node")
    radius = (100 - PERCENT) / 100
    return (
        placed.withColumn("home", F.min(F.struct("d", "pivot")).over(home))
        # The slack covers the rounding of distances in double precision.
        .filter(F.col("d") <= F.col("home.d") + 2 * radius + 1e-9)
        .groupBy(F.xxhash64("pivot").alias("region"), "node")
        .agg(F.max(F.col("core") & (F.col("home.pivot") == F.col("pivot"))).alias("core"))
    )


class _Block:
    """The sets of a block of outliers, by shingle."""

    def __init__(self, rows: list[tuple]):
        self.node, self.label = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1))
        self.core = np.array([r[2] for r in rows], dtype=bool)
        sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
        self.n = np.array([len(x) for x in sets], dtype=np.int64)
        shingles = np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        self.owner = np.repeat(np.arange(len(rows)), self.n)[order]
        self.shingle, self.start, self.many = np.unique(
            shingles[order], return_index=True, return_counts=True
        )
        self.reported: set[tuple[int, int]] = set()

    def linked(self, node: int, label: int, core: bool, main: bool, packed: bytes) -> np.ndarray:
        """The rows of the block that link with a member; pairs of outliers are decided once."""
        n = len(packed) // 8
        low, high = np.minimum(self.n, n), np.maximum(self.n, n)
        open_ = (self.label != label) & (low * 100 >= high * PERCENT)
        if not core:
            open_ &= self.core
        if not main:
            open_ &= self.node < node
        if not open_.any():
            return np.empty(0, dtype=np.int64)
        s = np.frombuffer(packed, dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.shingle, s), len(self.shingle) - 1)
        at = at[self.shingle[at] == s]
        many = self.many[at]
        ends = np.cumsum(many)
        places = np.arange(many.sum()) + np.repeat(self.start[at] - ends + many, many)
        shared = np.bincount(self.owner[places], minlength=len(self.n))
        return np.flatnonzero(open_ & (shared * 100 >= (self.n + n - shared) * PERCENT))


def _tile_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between the components of each region, at least one of any two that link.

    ``members`` holds ``largest``, the region's largest component, ``main`` for the members of it,
    ``node``, ``core`` and ``label``; a pair without a core member is left to other regions.
    """
    members = members.groupBy(F.col("largest").alias("region"), "node", "label", "main").agg(
        F.max("core").alias("core")
    )

    def run(batches):
        key, rows, block = None, [], None
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in range(batch.num_columns))
            for region, tile, lot, member, node, label, core, main, packed in zip(*columns):
                if key != (region, tile, lot):
                    key, rows, block = (region, tile, lot), [], None
                if not member:
                    rows.append((node, label, core, packed))
                    continue
                if not rows:
                    continue
                if block is None:
                    block = _Block(rows)
                for k in block.linked(node, label, core, main, packed).tolist():
                    tied = (int(block.label[k]), label)
                    if tied not in block.reported:
                        block.reported.add(tied)
                        out.append((int(block.node[k]), node))
            columns = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    sizes = members.groupBy("region").agg(
        F.ceil(F.count_if(~F.col("main")) / BLOCK).alias("tiles"),
        F.ceil(F.count(F.lit(1)) / LOT).alias("lots"),
    )
    dealt = members.join(sizes, "region")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    hashed = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), F.col(n))
    columns = ["node", "label", "core", "main"]
    outliers = dealt.filter("not main").select(
        "region", hashed("tiles").alias("tile"), each("lots").alias("lot"), F.lit(False).alias("member"), *columns
    )
    passing = dealt.select(
        "region", each("tiles").alias("tile"), hashed("lots").alias("lot"), F.lit(True).alias("member"), *columns
    )
    rows = (
        outliers.unionByName(passing)
        .join(sets, "node")
        .select("region", "tile", "lot", "member", *columns, "packed")
        .repartition("region", "tile", "lot")
        .sortWithinPartitions("region", "tile", "lot", "member")
    )
    return rows.mapInArrow(run, "a BIGINT, b BIGINT")


def _mixed(regions: DataFrame, found: DataFrame) -> DataFrame:
    """The members of regions where pairs are left: with their ``label``, the component so far,
    whether that is the region's ``largest``, ``main``, and the region's numbers of members, ``n``,
    and of ``outliers``."""
    label = F.coalesce("component", "node").alias("label")
    members = regions.join(found, "node", "left").select("region", "node", "core", label)
    of_label = members.groupBy("region", "label").agg(
        F.count(F.lit(1)).alias("n"), F.max("core").alias("core")
    )
    of_region = (
        of_label.groupBy("region")
        .agg(
            F.max(F.struct("n", "label")).alias("top"),
            F.sum("n").alias("n"),
            F.max("core").alias("core"),
        )
        .filter("core and n > top.n")
        .select(
            "region",
            F.col("top.label").alias("largest"),
            "n",
            (F.col("n") - F.col("top.n")).alias("outliers"),
        )
    )
    main = F.col("label") == F.col("largest")
    return members.join(of_region, "region").withColumn("main", main)


def _few_pairs(members: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of regions of few: an outlier ``b`` and a member outside its component."""
    outlier = members.filter("not main").select(
        "region",
        F.col("node").alias("b"),
        F.col("label").alias("label_b"),
        F.col("core").alias("core_b"),
    )
    return (
        members.join(outlier, "region")
        .filter("label <> label_b and (core or core_b) and (main or node < b)")
        .select(F.col("node").alias("a"), "b")
    )


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``a, b`` that tie together all nodes of each component.

    ``docs`` holds ``doc_id`` and ``text``; ``nodes`` holds ``node``, a doc_id, ``set``, ``n`` and
    ``sketch``.
    """
    spark = docs.sparkSession
    shown = nodes.select("node", "set", "n", F.explode("sketch").alias("region"))
    involved = _meeting(_rarest(shown, SHARED)).select("node").distinct()
    sets = _stored(_shingles_of(docs, _stored(involved, "involved")), "shingles")
    regions = _stored(_meeting(_rarest(_unpacked(sets), None)).withColumn("core", F.lit(True)), "regions")
    found = spark.createDataFrame([], "node BIGINT, component BIGINT")

    def with_links(new: DataFrame) -> DataFrame:
        if new.isEmpty():
            return found
        old = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(old.unionByName(new))

    for turn, wanted in enumerate(ROUNDS):
        members = _stored(_mixed(regions, found), "members")
        pivots = _stored(_elected(members, F.xxhash64("node", F.lit(-1 - turn)), wanted), "pivots")
        pairs = (
            members.join(pivots, "region")
            .filter("label <> pivot_label")
            .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        )
        found = with_links(_stored(_compared(pairs.distinct(), sets), "distances").filter(_linked()).select("a", "b"))
        regions = members.select("region", "node", "core").join(
            pivots.select("region", F.col("pivot").alias("node")), ["region", "node"], "left_anti"
        )
    level = 0
    while True:
        wanted = PIVOTS * MORE**level
        leaf_size = LEAF_PER_PIVOT * wanted if level else LEAF
        members = _stored(_mixed(regions, found), "members")
        if members.isEmpty():
            return found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        leaf = members.filter(F.col("outliers") <= leaf_size)
        large = members.filter(F.col("outliers") > leaf_size)
        if not level:
            # As long as all members are core, the outliers alone cover every pair that is left.
            large = large.withColumn("core", ~F.col("main"))
        few = F.col("outliers") * F.col("n") <= PAIRS
        tied = _stored(_tile_links(leaf.filter(~few), sets), "tile_links")
        pairs = _few_pairs(leaf.filter(few))
        pivots = _stored(_elected(large, F.xxhash64("node", F.lit(level)), wanted), "pivots")
        to_pivots = (
            large.join(pivots, "region")
            .filter("node <> pivot")
            .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        )
        met = _stored(_compared(pairs.unionByName(to_pivots).distinct(), sets), "distances")
        found = with_links(tied.unionByName(met.filter(_linked()).select("a", "b")))
        if pivots.isEmpty():
            return found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        regions = _stored(_windows(large.select("region", "node", "core"), met, pivots), "regions")
        level += 1


def _elected(members: DataFrame, rank: F.Column, wanted: int) -> DataFrame:
    """``region``, ``pivot`` and ``pivot_label``: of each region about ``wanted`` core members, those
    of least rank in each bin of the rank, so that electing is a plain aggregate."""
    return (
        members.filter("core")
        .groupBy("region", F.pmod(rank, F.lit(wanted)).alias("bin"))
        .agg(F.min(F.struct(rank.alias("rank"), "node", "label")).alias("least"))
        .select("region", F.col("least.node").alias("pivot"), F.col("least.label").alias("pivot_label"))
    )


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Documents link when their sets of distinct five-word shingles (words between ASCII white space,
    A-Z folded) have a Jaccard similarity of 0.75 or more; a document of one to four words has its
    whole sequence as its only shingle. ``component_id`` is the smallest doc_id that links reach.

    Edge cases: null, empty and blank texts have no shingles, link with nothing and are their own
    component. Repeated rows each get a result, the same one. Should a doc_id come with several
    texts, the links of each count for that doc_id. A null doc_id keeps its ``n_shingles``; it joins
    no group and has a null component, unless its set equals another document's. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    texts = _texts(docs, doc_id, text)
    shown = _stored(sketches(texts), "sketches")
    full = shown.filter("n > 0")
    classes = full.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("node"))
    classes = _stored(classes, "classes")
    nodes = (
        full.join(
            classes.select(F.col("node").alias("doc_id"), "h1", "h2", "n"), ["doc_id", "h1", "h2", "n"]
        )
        .select(F.col("doc_id").alias("node"), F.col("h1").alias("set"), "n", "sketch")
        .dropDuplicates(["node", "set"])
    )
    found = components(links(texts, nodes)).withColumnRenamed("component", "least")
    of_class = classes.join(found, "node", "left").select(
        "h1", "h2", "n", F.coalesce("least", "node").alias("least")
    )
    return (
        shown.select("doc_id", "n", "h1", "h2")
        .join(of_class, ["h1", "h2", "n"], "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
        )
    )
