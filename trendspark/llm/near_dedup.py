"""Near-duplicate documents by an inverted join on MinHash coordinates.

Every document has a signature of ``COORDINATES`` minima. It is posted under
its bands, each a hash of three coordinates; every coordinate is in one band of
each of two arrangements. Documents that share at least ``SHARED`` bands and
agree in at least ``MATCHES`` coordinates are compared on their full shingle
sets. At the similarity 0.8 a pair fails one of the two with a probability of
2e-6, and the more similar, the less.

Prefix: bands that occur once are dropped, and of its m others a document is
posted only under the m - SHARED + 1 rarest, one of which any document with
SHARED bands in common must share; documents with fewer drop out. A single
coordinate's value may be shared by a tenth of all documents, so that the more
documents there are, the more of them have most of their values in common with
some other by chance; three values together seldom are, so the share of
documents that is posted hardly grows with their number.

Bound: a shingle that no other posted document has is in no intersection. With
u of its n shingles being such, a document shares n - u at most, which refutes
most pairs of strongly edited copies without a look at their texts.

Skip: documents that are in one component need no comparison. Copies (equal
sets) are one node from the start. Then in each round every posting list names
one of its documents as its centre, another one each round; collisions with centres
are counted, every document is compared with the centre that agrees best with
it of those that it meets most often, and what is linked is merged and skipped from then on. These rounds are linear in the postings. Only
pairs of documents that are still in different components after them are then
compared one by one, so no link is lost; of those, the pairs whose sets have
no shingle in common among the rarest that a link must have one of are refuted
by their lists (the prefix filter again, on shingles).

Pivots: every document left is compared with the centre of most pairs among
those that the rounds compared it or its centres with, which most of a family
have in common, and merged with it if they are linked. What two documents share is in what both share with the pivot, or in what both have
besides it and besides their lonely shingles, which bounds the last pairs. A
document keeps which of the pivot's shingles it lacks, folded to ``64 * GAPS``
bits: what only one of two lacks, both don't share. So two copies of a text
that are edited in different places are refuted by their own rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import aliased, discard, likely_in, mapped, saved, spread, text_or_empty
from trendspark.llm.components import components
from trendspark.llm.shingles import shingle_hashes, word_hashes

COORDINATES, MATCHES = 48, 23
#: Coordinates of a band, and the bands that a pair must share.
BAND, SHARED = 3, 2
#: Centres whose signatures a document is compared with in a round; what a round misses is left to the next and to the pairs after them.
CENTRES = 4
#: Longs that hold which of a pivot's shingles a document lacks.
GAPS = 4
_rng = np.random.default_rng(15485863)
_A = (_rng.integers(0, 2**32, COORDINATES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32)
_ORDERS = (np.arange(COORDINATES), np.random.default_rng(5).permutation(COORDINATES))
#: The places of each band's coordinates.
BANDS = [tuple(int(x) for x in order[i:i + BAND]) for order in _ORDERS for i in range(0, COORDINATES, BAND)]
_MARKS = "doc_id long, tag long, n_shingles long, set_a long, set_b long, signature array<int>"


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct shingles of a text (A-Z folded) as sorted hashes."""
    return np.unique(shingle_hashes(word_hashes(text.encode(), lower=True), width))


def signature(shingles: np.ndarray, block: int = 2048) -> np.ndarray:
    low = np.full(COORDINATES, 2**32 - 1, np.uint32)
    points = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(points), block):
        x = np.multiply.outer(_A, points[i:i + block])
        x += _B[:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return low.view(np.int32)


def marks(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """One row for each document: size and 128-bit hash of its shingle set, and its signature (null without words)."""
    def mark(batches):
        for batch in batches:
            sizes, a, b, signatures = [], [], [], []
            for text in batch.column(2).to_pylist():
                found = shingle_set(text, width)
                whole = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                a.append(whole >> 64)
                b.append(whole & 0xFFFFFFFFFFFFFFFF)
                signatures.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(np.array(a, np.uint64).view(np.int64)),
                 pa.array(np.array(b, np.uint64).view(np.int64)), pa.array(signatures, pa.list_(pa.int32()))],
                ["doc_id", "tag", "n_shingles", "set_a", "set_b", "signature"])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    return mapped(rows, mark, _MARKS)


def postings(nodes: DataFrame) -> DataFrame:
    """``(node, tokens)``: the rarest of its bands, under which a node is posted."""
    bands = F.array(*(F.xxhash64(F.lit(i), *(F.col("signature")[place] for place in band)) for i, band in enumerate(BANDS)))
    tokens = nodes.select("node", F.explode(bands).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all"))
    few = ranked.where(F.size("all") >= SHARED).select("node", F.expr(f"slice(all, 1, size(all) - {SHARED - 1})").alias("rarest"))
    return few.select("node", F.col("rarest.token").alias("tokens"))


def short_signature(signature: str) -> Column:
    """A byte of each coordinate. Equal coordinates stay equal; 1 in 256 others agree as well, so no agreement is lost."""
    return F.transform(signature, lambda x: (x.bitwiseAND(F.lit(255)) - F.lit(128)).cast("tinyint"))


def lonely_shingles(bodies: DataFrame, width: int) -> DataFrame:
    """``(node, lonely)``: how many of a node's shingles no other node has (nodes without such are absent).

    Shingles that a task's batch has seen twice are sent once. They are cut to
    40 bits: a clash makes a lonely shingle look shared, which only weakens the
    bound.
    """
    def shingles(batches):
        for batch in batches:
            sets = [shingle_set(text, width) >> np.uint64(24) for text in batch.column(1).to_pylist()]
            if sets:
                owners = np.repeat(np.asarray(batch.column(0)), [len(x) for x in sets])
                found, first, counts = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
                owner = pa.array(owners[first], pa.int64(), mask=counts > 1)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), owner], ["shingle", "node"])

    found = mapped(bodies.select("node", "text"), shingles, "shingle long, node long")
    alone = found.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1 and node is not null")
    return alone.groupBy("node").agg(F.count("*").alias("lonely"))


def possible(n_a, lonely_a, n_b, lonely_b, percent: int) -> Column:
    """Whether sets of these sizes and lonely shingles can reach the similarity."""
    most = F.least(n_a - lonely_a, n_b - lonely_b)
    return 100 * most >= percent * (n_a + n_b - most)


def within_pivot(percent: int, gaps: bool = False) -> Column:
    """Whether two nodes of the last pairs can reach the similarity, going by what each has in common with a pivot of both (true without one).

    ``other`` is how many of a node's shingles are neither the pivot's nor
    lonely. With ``gaps``, the bits that are set in only one node's gaps stand
    for at least as many shingles that the other node shares with the pivot and
    this one doesn't.
    """
    def shared(x: str, y: str) -> Column:
        if not gaps:
            return F.col(f"common_{x}")
        only = [F.bit_count(F.col(f"gaps_{y}")[i].bitwiseAND(F.bitwise_not(F.col(f"gaps_{x}")[i]))) for i in range(GAPS)]
        return F.col(f"common_{x}") - sum(only[1:], only[0])

    most = F.least(shared("a", "b"), shared("b", "a")) + F.least("other_a", "other_b")
    enough = 100 * most >= percent * (F.col("n_a") + F.col("n_b") - most)
    return F.coalesce((F.col("pivot_a") != F.col("pivot_b")) | enough, F.lit(True))


def with_pivots(members: DataFrame, tested: DataFrame, bodies: DataFrame, width: int) -> DataFrame:
    """``members`` with ``pivot, n_pivot, common, other, gaps`` (null where a member was never compared).

    A member's pivot is the centre of most pairs among those that it was compared with, or that centre's own pivot.
    """
    times = tested.groupBy(F.col("b").alias("centre")).agg(F.count("*").alias("times"))
    own = F.struct(F.col("b").alias("node"), F.col("b").alias("centre"))
    met = tested.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("centre")), own)))
    chosen = met.join(times, "centre").groupBy("node").agg(F.max(F.struct("times", "centre")).getField("centre").alias("first"))
    chosen = saved(chosen, "pivots")
    further = chosen.select(F.col("node").alias("first"), F.col("first").alias("pivot"))
    placed = members.join(chosen, "node", "left").join(further, "first", "left").drop("first")
    placed = saved(placed, "placed-nodes")
    shared = intersections(placed.where("pivot != node").select(F.col("node").alias("a"), F.col("pivot").alias("b")), bodies, width, gaps=True)
    shared = shared.select(F.col("a").alias("node"), F.col("n_b").alias("_n"), F.col("common").alias("_common"), F.col("gaps").alias("_gaps"))
    itself = F.col("pivot") == F.col("node")
    found = placed.join(shared, "node", "left").withColumns({
        "n_pivot": F.when(itself, F.col("n")).otherwise(F.col("_n")),
        "common": F.when(itself, F.col("n")).otherwise(F.col("_common")),
        "gaps": F.when(itself, F.array_repeat(F.lit(0).cast("long"), GAPS)).otherwise(F.col("_gaps"))})
    found = found.drop("_n", "_common", "_gaps").withColumn("other", F.when(F.col("common").isNotNull(), F.greatest(F.col("n") - F.col("common") - F.col("lonely"), F.lit(0))))
    out = saved(found, "pivoted-nodes")
    discard(chosen, placed)
    return out


def rare_shingles(members: DataFrame, bodies: DataFrame, percent: int, width: int) -> DataFrame:
    """``members`` with ``token, place``: each of a node's rarest shingles that others have, and its place.

    Shingles are ordered by how many of these nodes have them. Two linked sets
    have a common shingle among the first of both, as many as may be missing
    from the other set, plus one.
    """
    def shingles(batches):
        for batch in batches:
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            if sets:
                owners = np.repeat(np.asarray(batch.column(0)), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.concatenate(sets).view(np.int64))], ["node", "token"])

    found = mapped(bodies.join(members.select("node"), "node", "left_semi").select("node", "text"), shingles, "node long, token long")
    counted = found.groupBy("token").agg(F.count("*").alias("many"))
    ordered = found.join(counted, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("many", "token"))).alias("all"))
    first = F.expr(f"slice(all, 1, size(all) - cast(ceil({percent} * size(all) / 100) as int) + 1)")
    chosen = ordered.select("node", F.posexplode(first).alias("at", "it"))
    chosen = chosen.where("it.many > 1").select("node", (F.col("at") + 1).alias("place"), F.col("it.token").alias("token"))
    return members.join(chosen, "node")


def agreeing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(a, b, matches)`` of the possible pairs whose signatures agree in enough coordinates."""
    def side(name):
        return nodes.select(F.col("node").alias(name), F.struct("signature", "n", "lonely").alias(f"_{name}"))
    matches = F.size(F.filter(F.zip_with("_a.signature", "_b.signature", lambda x, y: x == y), lambda same: same))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(possible(F.col("_a.n"), F.col("_a.lonely"), F.col("_b.n"), F.col("_b.lonely"), percent))
    return both.select("a", "b", matches.alias("matches")).where(F.col("matches") >= MATCHES)


def gap_bits(base: np.ndarray, found: np.ndarray) -> list[int]:
    """The places of those of ``base``'s shingles that ``found`` lacks, modulo the bits of ``GAPS`` longs."""
    bits = np.zeros(64 * GAPS, np.uint8)
    bits[np.flatnonzero(~np.isin(base, found, assume_unique=True)) % len(bits)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def intersections(pairs: DataFrame, bodies: DataFrame, width: int, gaps: bool = False) -> DataFrame:
    """``(a, b, n_a, n_b, common)`` of the pairs ``(a, b)``: the sizes of their full shingle sets and of what these have in common.

    With ``gaps``, also which of the shingles of ``b`` the ``a`` lacks. The texts
    of the ``a`` go where their ``b`` is; a task holds the set of one ``b`` at a
    time and streams the others past it.
    """
    names = ["a", "b", "n_a", "n_b", "common"]

    def check(batches):
        at, base = None, None
        for batch in batches:
            found_pairs, lacks = [], []
            for centre, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingle_set(text, width)
                if centre == node:
                    at, base = centre, found
                    continue
                assert at == centre
                found_pairs.append((node, centre, len(found), len(base), len(np.intersect1d(base, found, assume_unique=True))))
                if gaps:
                    lacks.append(gap_bits(base, found))
            if found_pairs:
                columns = [pa.array(x, pa.int64()) for x in zip(*found_pairs)] + [pa.array(lacks, pa.list_(pa.int64()))] * gaps
                yield pa.RecordBatch.from_arrays(columns, names + ["gaps"] * gaps)

    # the centres of many pairs are split over tasks; each part has its own copy of the centre
    parts = F.pmod(F.xxhash64("a"), F.lit(16)).cast("int")
    wanted = pairs.select(F.col("a").alias("node"), F.col("b").alias("centre"), parts.alias("part"))
    own = wanted.select(F.col("centre").alias("node"), "centre", "part").distinct()
    wanted = wanted.union(own)
    rows = wanted.join(likely_in(bodies, wanted.select("node"), "node"), "node")
    rows = rows.repartition(spread(pairs), "centre", "part").sortWithinPartitions("centre", "part", (F.col("node") != F.col("centre")))
    schema = ", ".join(f"{name} long" for name in names) + ", gaps array<long>" * gaps
    return mapped(rows.select("centre", "node", "text"), check, schema)


def verified(pairs: DataFrame, bodies: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets have ``100 * intersection >= percent * union``."""
    found = intersections(pairs, bodies, width)
    return found.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def near_components(docs: DataFrame, percent: int = 80, width: int = 5, star_rounds: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row.

    Documents are linked if their sets of ``width``-word shingles have
    ``100 * intersection >= percent * union``; a component's id is its smallest
    ``doc_id``, and the row of that id is kept. Null, empty and wordless texts
    have no shingles and are linked with nothing, equal texts always are. A row
    with a null id is linked with nothing, has a null ``component_id`` and is
    kept. Rows of one id are one document; of its texts, the one whose set sorts
    first is compared with others, and all get its component.
    """
    rows = saved(marks(docs, width, id_col, text_col), "minhash-marks")
    # a set's smallest id is its node; of an id with several sets the first one's row stays, so each node is one row
    known = rows.where("n_shingles > 0 and doc_id is not null")
    sets = known.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "tag", "n_shingles", "signature")).alias("it"))
    sets = saved(sets.select("set_a", "set_b", F.col("it.doc_id").alias("node"), F.col("it.tag").alias("tag"),
                             F.col("it.n_shingles").alias("n"), F.col("it.signature").alias("signature")), "shingle-sets")
    nodes = saved(sets.groupBy("node").agg(F.min(F.struct("set_a", "set_b", "tag", "n", "signature")).alias("it")).select(
        "node", "it.tag", "it.n", "it.signature"), "nodes")
    posted = saved(postings(nodes), "postings")
    posted_nodes = nodes.join(posted.select("node"), "node", "left_semi")
    candidates = saved(posted_nodes, "posted-nodes")
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.xxhash64(text).alias("tag"), text.alias("text"))
    texts = likely_in(texts.where(F.col("node").isNotNull()), candidates.select("node"), "node")
    # a node has one tag here, so that of each node one text is left; the semi join finds the texts dealt as it needs them
    bodies = texts.dropDuplicates(["node", "tag"]).join(candidates.select("node", "tag"), ["node", "tag"], "left_semi").select("node", "text")
    bodies = saved(bodies, "posted-texts")

    alone = lonely_shingles(bodies, width)
    bounded = candidates.join(alone, "node", "left").select("node", "n", F.coalesce("lonely", F.lit(0)).alias("lonely"), short_signature("signature").alias("signature"))
    # a link needs a document to share most of its own shingles
    every, candidates = candidates, saved(bounded.where(100 * (F.col("n") - F.col("lonely")) >= percent * F.col("n")), "candidate-nodes")
    listed = saved(posted.join(candidates.select("node", "n", "lonely"), "node"), "candidate-postings")
    discard(every, posted, nodes)

    labels = saved(candidates.select("node", F.col("node").alias("component")), "labels")
    tested, used = None, [bodies, candidates, listed]

    def merge(links: DataFrame):
        """Merges the components that these ``(a, b)`` link."""
        nonlocal labels
        end = labels.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        ends = links.join(labels.withColumnRenamed("node", "a"), "a").join(end, "b").select(F.col("component").alias("a"), F.col("_b").alias("b"))
        merged = components(ends).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        before, labels = labels, saved(labels.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("component")),
                                       "labels")
        discard(before)

    def test(pairs: DataFrame):
        """Verifies pairs and merges the components that they link."""
        nonlocal tested
        done = saved(pairs.select("a", "b"), "tested")
        used.append(done)
        tested = done if tested is None else tested.union(done)
        merge(verified(done, bodies, percent, width))

    def live() -> DataFrame:
        """Postings with the labels of their nodes."""
        return listed.join(labels, "node").select("node", "component", "n", "lonely", F.explode("tokens").alias("token"))

    def apart() -> DataFrame:
        """The nodes that share a band with one of another component."""
        rest = live()
        mixed = rest.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        return rest.join(mixed.select("token"), "token", "left_semi").select("node", "component", "n", "lonely").distinct()

    for turn in range(star_rounds):
        rest = live()
        # the centre: a document with few lonely shingles, as those have most links
        order = F.struct(F.floor(16 * F.col("lonely") / F.col("n")).alias("s"), F.xxhash64("node", F.lit(turn)).alias("h"), "node", "component", "n", "lonely")
        of_list = rest.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(order).alias("centre"))
        centres = of_list.where("low != high").select(
            "token", F.col("centre.node").alias("b"), *(F.col(f"centre.{c}").alias(f"{c}_b") for c in ("component", "n", "lonely")))
        worth = (F.col("component") != F.col("component_b")) & possible(F.col("n"), F.col("lonely"), F.col("n_b"), F.col("lonely_b"), percent)
        # dealt by document once: at most one centre for each of a document's lists
        met = rest.join(centres, "token").where(worth).select(F.col("node").alias("a"), "b").repartition(F.col("a"))
        met = met.groupBy("a", "b").agg(F.count("*").alias("met")).groupBy("a").agg(F.sort_array(F.collect_list(F.struct("met", "b")), asc=False).alias("all"))
        if tested is not None:
            known = tested.groupBy("a").agg(F.collect_set("b").alias("known"))
            met = met.join(known, "a", "left").select("a", F.filter("all", lambda x: ~F.coalesce(F.array_contains("known", x["b"]), F.lit(False))).alias("all"))
        # signatures move for those centres that a document meets in most of its lists
        pairs = met.select("a", F.explode(F.slice("all", 1, CENTRES)).alias("it")).select("a", F.col("it.b").alias("b"))
        best = agreeing(pairs, candidates, percent).groupBy("a").agg(F.max(F.struct("matches", "b")).alias("best"))
        test(best.select("a", F.col("best.b").alias("b")))
    # what is left: pairs of different components that share one of the rarest shingles; a pair that shares several is counted once
    members = saved(apart().select("node", "component", "n", "lonely"), "live-nodes")
    pivoted = with_pivots(members, tested, bodies, width)
    # most of a family are linked to the pivot that they have just been compared with
    merge(pivoted.where(100 * F.col("common") >= percent * (F.col("n") + F.col("n_pivot") - F.col("common"))).select(
        F.col("node").alias("a"), F.col("pivot").alias("b")))
    left = apart().select("node", "component")
    rest = saved(rare_shingles(pivoted.drop("component").join(left, "node"), bodies, percent, width), "rare-shingles")
    mixed = rest.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    lists = rest.join(mixed.select("token"), "token", "left_semi")
    one, two = (lists.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "component", "n", "lonely", "place", "pivot", "common", "other", "gaps")))
                for x in "ab")
    # a link has at least this many shingles in common, so the first one is no later than these places
    common = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    early = (F.col("place_a") <= F.col("n_a") - common + 1) & (F.col("place_b") <= F.col("n_b") - common + 1)
    pairs = one.join(two, (one["token"] == two["token"]) & (F.col("node_a") > F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
                     & early & within_pivot(percent, gaps=True) & possible(F.col("n_a"), F.col("lonely_a"), F.col("n_b"), F.col("lonely_b"), percent))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    test(agreeing(pairs.join(tested, ["a", "b"], "left_anti"), candidates, percent))
    discard(members, pivoted, rest, *used)

    return _labelled(rows, sets, labels)


def _labelled(rows: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with its set's component; a component's id is its smallest node, which is its smallest ``doc_id``."""
    of_set = sets.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("component_id"))
    known = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(of_set, ["set_a", "set_b"], "left")
    return known.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the row of the smallest id.

    Of rows equal in id and text, the one whose other columns come first as JSON stays. Columns may have any names.
    """
    rows, the_id, the_text = aliased(docs, id_col, text_col)
    kept = near_components(rows, percent, width, id_col=the_id, text_col=the_text).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    others = [c for c in rows.columns if c not in (the_id, the_text)]
    if others:
        rest = F.struct(*others)
        one = rows.groupBy(the_id, the_text).agg(F.min_by(rest, F.to_json(rest)).alias("_rest")).select(the_id, the_text, "_rest.*")
    else:
        one = rows.distinct()
    one = one.join(kept, F.col(the_id).cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    return one.select(*rows.columns).toDF(*docs.columns)
