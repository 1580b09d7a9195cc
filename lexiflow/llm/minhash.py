"""Near-duplicate linking: fast similarity sketching, banding, exact verification.

Sketch.  A set fills the coordinates of its sketch in rounds: in round i each element is hashed to one
coordinate and a value, and offers (i, value) there; each coordinate keeps its least offer, and the rounds
end when no coordinate is empty.  After as many rounds as there are coordinates, round i offers every
element to coordinate i only, so every coordinate of every non-empty set fills.  Agreement of two sketches
then concentrates around the Jaccard similarity as sharply as that of independent minima, at the price of
a few passes over the set.

Candidates.  ``BANDS`` bands of ``ROWS`` coordinates each; sets that agree on a band share a bucket.  Two
sets of similarity 0.8 share none with probability (1 - 0.8**7)**58 = 1.2e-6.  Sets that are equal are one
node from the start.  In each bucket every node is tied to the least one, so a bucket of n nodes makes
n - 1 ties, and the components of the ties (groups) hold all candidate pairs.

Verification, on the full sets.
1. Each node of a group is compared with the group's least node, its leader.
2. Nodes that aren't similar to their leader are compared with all nodes of their group, in pairs of
   blocks of at most ``BLOCK`` nodes.  Pairs of nodes that are both linked to the leader add nothing.
The links found are resolved into components.  A group whose nodes are all near its leader costs one
comparison a node, whatever its size.

The sets of grouped nodes are made again from the texts in a second scan rather than kept for all
documents; a bit map of fixed size (``BITMAP_BITS``) picks the documents for it, the join after it is exact.

Defined results: null and empty texts have an empty set, which is linked with nothing (their component is
their own id); ids may repeat or be null (rows are told apart by their sets; a null id never is a
component's id unless all are null); an empty table gives an empty table; texts of any length enter whole.
Further columns aren't read by ``link``, and kept by ``keep_one``, whatever their names.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, clean_text, map_texts, materialise, mix
from .components import components

ROWS, BANDS = 7, 58
#: A link needs 100 * common >= PERCENT * united shingles.
PERCENT = 80
BLOCK = 256
BITMAP_BITS = 1 << 26
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[str], width: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, sorted by both; A-Z in lower case."""
    owners, values = [], []
    for i, text in enumerate(texts):
        h = hashes.of(text.encode("utf-8").lower().split())
        if not len(h):
            continue
        span = min(width, len(h))
        with np.errstate(over="ignore"):
            s = mix(h[:len(h) - span + 1], span)
            for k in range(1, span):
                s = mix(s ^ h[k:len(h) - span + 1 + k], span)
        s = np.unique(s)
        owners.append(np.full(len(s), i, np.int64))
        values.append(s)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *owners]), np.concatenate([none.astype(np.uint64), *values])


def sketches(owner: np.ndarray, value: np.ndarray, n: int, size: int) -> np.ndarray:
    """n x size sketches of the sets given as sorted (owner, value) pairs; rows of empty sets are EMPTY."""
    out = np.full(n * size, EMPTY)
    o, v = owner, value
    for round_ in range(size):
        if not len(o):
            break
        h = mix(v, round_)
        at = o * size + ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(out, at, np.uint64(round_) << np.uint64(32) | h & np.uint64(0xFFFFFFFF))
        waiting = (out.reshape(n, size) == EMPTY).any(1)
        rest = waiting[o]
        o, v = o[rest], v[rest]
    out = out.reshape(n, size)
    for j in range(size if len(o) else 0):
        rest = out[o, j] == EMPTY
        if rest.any():
            np.minimum.at(out[:, j], o[rest], np.uint64(size + j) << np.uint64(32)
                          | mix(v[rest], size + j) & np.uint64(0xFFFFFFFF))
    return out


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """n x bands keys as signed integers."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64), 77), parts.shape[:2])
    for k in range(rows):
        key = mix(key ^ parts[:, :, k], k)
    return key.view(np.int64)


def digests(owner: np.ndarray, value: np.ndarray, n: int) -> list[np.ndarray]:
    """Two 64-bit sums that identify each set."""
    out = []
    for seed in (501, 502):
        total = np.zeros(n, np.uint64)
        np.add.at(total, owner, mix(value, seed))
        out.append(total.view(np.int64))
    return out


def _sketch_table(docs: DataFrame, keys: list[str], text_col: str, width: int) -> DataFrame:
    """keys..., n, d1, d2, bands of every row."""
    def make():
        hashes = WordHashes()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            size = part.num_rows
            owner, value = shingle_sets(part.column(len(keys)).to_pylist(), width, hashes)
            count = np.bincount(owner, minlength=size)
            bands = band_keys(sketches(owner, value, size, ROWS * BANDS), ROWS, BANDS)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [*part.columns[:len(keys)], pa.array(count), *map(pa.array, digests(owner, value, size)), lists],
                [*keys, "n", "d1", "d2", "bands"])
        return work

    types = dict(docs.dtypes)
    head = "".join(f"`{k}` {types[k]}, " for k in keys)
    return map_texts(docs, keys, text_col, head + "n long, d1 long, d2 long, bands array<long>", make)


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(node, band, key, least) for the buckets of at least two nodes; ``least`` is the bucket's least node."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = materialise(rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter(
        "least < most").select("key", "least"), "buckets")  # written, so that the join can split a large bucket
    return rows.join(shared, "key").select("node", "band", "key", "least")


def _ties(buckets: DataFrame) -> DataFrame:
    """(a, b): every node of a bucket and its least node."""
    return buckets.filter("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def _slots(d1: Column) -> Column:
    """Bit positions of an id."""
    return F.array(*[F.pmod(F.xxhash64(d1, F.lit(seed)), F.lit(BITMAP_BITS)) for seed in (1, 2)])


def _bitmap(ids: Column, rows: DataFrame) -> np.ndarray:
    """Bit map of BITMAP_BITS bits over the ids; bounded, 8 MB."""
    words = rows.select(F.explode(_slots(ids)).alias("s")).groupBy(F.floor(F.col("s") / 64).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(s % 64 AS INT))) AS bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, grp, n, set) of the ``wanted`` nodes (node, grp, id, d1, d2), from the texts."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(F.col("id").cast("string"), wanted))
    rows = docs.select(_slots(F.col(id_col).cast("string")).alias("slots"), clean_text(text_col).alias("t"))

    def make():
        hashes, bits = WordHashes(), bitmap.value

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            slots = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
            here = ((bits[slots >> 6] >> (slots & 63)) & 1).all(1).nonzero()[0]
            texts = part.column(1).take(pa.array(here)).to_pylist()
            owner, value = shingle_sets(texts, width, hashes)
            ends = np.searchsorted(owner, np.arange(len(texts) + 1))
            return pa.RecordBatch.from_arrays(
                [*map(pa.array, digests(owner, value, len(texts))), pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(value.view(np.int64)))], ["d1", "d2", "set"])
        return work

    found = map_texts(rows, ["slots"], "t", "d1 long, d2 long, set array<long>", make)
    joined = found.join(wanted.select("node", "grp", "d1", "d2"), ["d1", "d2"])
    return joined.groupBy("node", "grp").agg(F.any_value("set").alias("set")).withColumn(
        "n", F.size("set").cast("long"))


def _similar(common: Column, n1: Column, n2: Column) -> Column:
    return 100 * common >= PERCENT * (n1 + n2 - common)


def compare_blocks(table: pa.Table) -> pa.Table:
    """Links between the two blocks of a task (or inside its one block), without those that follow from
    others, of pairs that share no band before the task's (-1: of all pairs).  Columns: node, set, bands, band,
    first (bool)."""
    bands, band = np.array(table["bands"].to_pylist(), np.int64).reshape(len(table), -1), table["band"][0].as_py()
    sets = [np.sort(np.array(s, np.int64)) for s in table["set"].to_pylist()]
    node, first = table["node"].to_numpy(), table["first"].to_numpy(zero_copy_only=False).astype(bool)
    alone = first.all()
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((node, ~first))
    label = np.arange(len(node))
    a, b = [], []
    for place, i in enumerate(order):
        if not first[i]:
            break
        others = order[place + 1:] if alone else np.flatnonzero(~first)
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[(100 * low >= PERCENT * high) & (label[others] != label[i])]
        if band >= 0:
            others = others[(bands[others] == bands[i]).argmax(1) == band]
        if not len(others):
            continue
        flat = np.concatenate([sets[k] for k in others])
        at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
        starts = np.cumsum(sizes[others]) - sizes[others]
        common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), starts)
        for k in others[100 * common >= PERCENT * (sizes[i] + sizes[others] - common)]:
            if label[k] != label[i]:
                a.append(node[i])
                b.append(node[k])
                label[label == label[k]] = label[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links(sets: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(a, b): verified links that connect what is connected in each group of ``sets`` (node, grp, n, set);
    a group is named by its least node."""
    lead = sets.filter("node = grp").select("grp", F.col("set").alias("lead"), F.col("n").alias("lead_n"))
    near = materialise(sets.join(lead, "grp").select("node", "grp", (F.col("node") == F.col("grp")).alias("is_lead"), _similar(
        F.size(F.array_intersect("set", "lead")), F.col("n"), F.col("lead_n")).alias("near")), "near-leader")
    count = lambda c: F.sum(c.cast("long"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    # sets that are copied if all far nodes meet all others
    cost = F.col("far_n") * (blocks("far_n") + blocks("near_n")) + F.col("near_n") * blocks("far_n")
    groups = near.groupBy("grp").agg(count(~F.col("near")).alias("far_n"), count(F.col("near")).alias("near_n")).filter(
        "far_n > 0 AND far_n + near_n > 2")
    placed = buckets.select("node", "band", "key").join(near.select("node", "grp", "near"), "node")
    strange = materialise(placed.groupBy("grp", "key").agg(
        count(~F.col("near")).alias("far_n"), count(F.col("near")).alias("near_n")).filter("far_n > 0"), "far-buckets")
    costs = strange.groupBy("grp").agg(F.sum(cost).alias("apart"))
    groups = materialise(groups.join(costs, "grp").withColumn("by_bucket", F.col("apart") < cost), "far-groups")
    sizes = [blocks("far_n").alias("far"), blocks("near_n").alias("close")]
    whole = near.join(groups.filter("NOT by_bucket").select("grp", *sizes), "grp").select(
        "node", "near", F.lit(-1).alias("band"), F.col("grp").alias("key"), "far", "close")
    apart = placed.join(strange.join(groups.filter("by_bucket").select("grp"), "grp").select("key", *sizes), "key").select(
        "node", "near", "band", "key", "far", "close")
    rest = whole.unionByName(apart).withColumn("block", F.pmod(F.xxhash64("node"), F.when(
        F.col("near"), F.col("close")).otherwise(F.col("far"))).cast("int"))
    # tasks (x, y): x is a block of far nodes, y one of far nodes (y >= x) or, as -1 - y, of near nodes
    all_far = F.sequence(F.lit(0), F.col("far") - 1)
    all_close = F.when(F.col("close") > 0, F.sequence(F.lit(0), F.col("close") - 1)).otherwise(F.array().cast("array<int>"))
    task = lambda x, y, first: F.struct(x.alias("x"), y.alias("y"), F.lit(first).alias("first"))
    far_tasks = F.concat(
        F.transform(F.filter(all_far, lambda y: y >= F.col("block")), lambda y: task(F.col("block"), y, True)),
        F.transform(F.filter(all_far, lambda x: x < F.col("block")), lambda x: task(x, F.col("block"), False)),
        F.transform(all_close, lambda y: task(F.col("block"), -1 - y, True)))
    near_tasks = F.transform(all_far, lambda x: task(x, -1 - F.col("block"), False))
    dealt = rest.select("node", "band", "key", F.explode(F.when(F.col("near"), near_tasks).otherwise(far_tasks)).alias("t"))
    held = sets.select("node", "set").join(nodes.select("node", "bands"), "node")
    found = dealt.select("node", "band", "key", "t.*").join(held, "node").groupBy("band", "key", "x", "y").applyInArrow(
        compare_blocks, "a long, b long")
    return near.filter("near AND NOT is_lead").select(F.col("node").alias("a"), F.col("grp").alias("b")).unionByName(
        found)


def link(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
         also: tuple[str, ...] = ()) -> DataFrame:
    """id_col, ``also`` columns, n_shingles, component_id, kept of every row.

    Rows are linked if their sets of ``width``-word shingles have a Jaccard similarity of at least 0.8.
    """
    keys = [id_col, *also]
    rows = materialise(_sketch_table(docs, keys, text_col, width), "sketches")
    nodes = materialise(
        rows.filter("n > 0").groupBy("d1", "d2").agg(F.min(id_col).alias("id"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "sketch-nodes")
    buckets = materialise(_shared_buckets(nodes), "shared-buckets")
    groups = components(_ties(buckets))
    wanted = materialise(nodes.select("node", "id", "d1", "d2").join(
        groups.withColumnRenamed("component", "grp"), "node"), "grouped")
    sets = materialise(_full_sets(docs, wanted, id_col, text_col, width), "grouped-sets")
    found = components(_links(sets, nodes, buckets)).withColumnRenamed("component", "c")
    named = nodes.select("node", "d1", "d2", "id").join(found, "node", "left").withColumn(
        "c", F.coalesce("c", "node"))
    named = materialise(named, "named")
    least = materialise(named.groupBy("c").agg(F.min("id").alias("component_id")), "components")
    named = named.join(least, "c").select("d1", "d2", "component_id")
    out = rows.drop("bands").join(named, ["d1", "d2"], "left")  # empty sets find nothing
    return out.select(*keys, F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", F.col(id_col)).alias("component_id")).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near-duplicates, with all columns of ``docs``: that of the smallest id.

    Repeated rows are combined first; texts are shuffled once.
    """
    key = F.sha2(clean_text(text_col), 256)
    kept = link(docs.select(F.col(id_col).alias("_id"), clean_text(text_col).alias("_text"), key.alias("_key")),
                width, "_id", "_text", ("_key",)).filter("kept").select("_id", "_key").distinct()
    rows = docs.select(F.col(id_col).alias("_i"), key.alias("_k"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    once = rows.groupBy("_i", "_k").agg(F.any_value("_doc").alias("_doc"))
    return once.join(kept, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")),
                     "left_semi").select("_doc.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document, on 2-word shingles."""
    return link(docs, 2)


REPORT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE
           list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS x
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""
