"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of five words; it links to every document whose set has
a Jaccard similarity of THRESHOLD or more with its own. Documents of equal sets are one
class and are joined once, for one of them.

Sets are embedded as WIDTH minhashes, so that similarity is the share of equal places.
A run of the join splits all classes on a sampled place: those with the same value there
share a bucket. A bucket of 2 to SMALL classes is compared by brute force; a larger one
is split again on places sampled for it, 1 / THRESHOLD of them on average, so that a pair
as similar as the threshold is expected to survive each split. Runs are repeated until
such a pair meets with probability RECALL. A large bucket that a split leaves nearly as
large (a share of threshold - MARGIN or more of it), or that is left after DEPTH splits, is
a group of near copies, which no split would take apart; it goes on as it is.

Buckets compare short sketches, with a margin below the threshold, and say which classes
hang together; the pairs themselves are never written. Each group that hangs together
is then joined exactly on whole sets: each set goes once to its group, or, where a group
is large, to pairs of blocks of it, so that every pair meets in one task, which returns
sums of links. An exact join of a group also finds links that no bucket has shown.

Words are separated by white space; a text of fewer than five words is one run of all
of them. Documents without words (null text included) have no links and no class.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from footfall.conf import materialize
from footfall.llm.components import connected_components
from footfall.llm.hashing import mix, shingle_sets
from footfall.llm.session import carries_columns, tasks_for

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
WIDTH = 128
SMALL = 200
DEPTH = 8
#: Places of a sketch that have to agree: this much below the threshold is over five standard deviations.
MARGIN = 0.2
#: Sets and shingles in a block of a group that is too large for one task.
BLOCK_SETS, BLOCK_SHINGLES = 300, 200_000
U = np.uint64

_FACTORS = mix(np.arange(1, WIDTH + 1, dtype=U)) | U(1)


def minhashes(values: np.ndarray) -> np.ndarray:
    """WIDTH 32-bit minhashes of a set of hashes."""
    least = np.full(WIDTH, 2**64 - 1, U)
    for at in range(0, len(values), 4096):
        np.minimum(least, (values[at : at + 4096] * _FACTORS[:, None]).min(axis=1), out=least)
    return (least >> U(32)).astype(np.uint32)


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    both = (mix(values ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U), mix(values ^ U(0x3C3C3C3C3C3C3C3C)).sum(dtype=U))
    return tuple(int(x.astype(np.int64)) for x in both)


def runs_needed(threshold: float, depth: int, recall: float) -> int:
    """Runs after which a pair at the threshold has met in a bucket of `depth` splits with probability `recall`.

    A node splits on one place, or with probability 1 / threshold - 1 on two.
    """
    two, meet = 1 / threshold - 1, 1.0
    for _ in range(depth):
        x = threshold * meet
        meet = (1 - two) * x + two * (1 - (1 - x) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def split(nodes: np.ndarray, signatures: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for each row (a node and a signature): the node says on which places it is split."""
    drawn = mix(nodes ^ U(0x6A09E667F3BCC909))
    first = (drawn % U(WIDTH)).astype(np.int64)
    second = (first + 1 + ((drawn >> U(8)) % U(WIDTH - 1)).astype(np.int64)) % WIDTH
    twice = np.flatnonzero((drawn >> U(40)) < U(int((1 / threshold - 1) * 2**24)))
    rows = np.concatenate([np.arange(len(nodes)), twice])
    places = np.concatenate([first, second[twice]])
    values = signatures[rows, places].astype(U) | (places.astype(U) << U(32))
    return rows, mix(nodes[rows] * U(0x9E3779B97F4A7C15) + mix(values))


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, WIDTH)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, signatures = [], [], []
        for values in shingle_sets(batch.column("text"), SHINGLE):
            keys.append(set_key(values))
            sizes.append(len(values))
            signatures.append(minhashes(values).tobytes() if len(values) else None)
        columns = [
            batch.column("doc_id"), batch.column("row_key"), pa.array([k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "key1", "key2", "n", "signature"])


def _first_nodes(batches: Iterator[pa.RecordBatch], runs: int, threshold: float) -> Iterator[pa.RecordBatch]:
    roots = mix(np.arange(1, runs + 1, dtype=U) << U(20))
    for batch in batches:
        signatures, ids = _signatures(batch.column("signature")), batch.column("rid").to_numpy()
        for root in roots:
            rows, nodes = split(np.full(len(ids), root), signatures, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids[rows])], ["node", "rid"])


def _next_nodes(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column("node").to_numpy().view(U)
        rows, children = split(nodes, _signatures(batch.column("signature")), threshold)
        taken = [batch.column(c).to_numpy()[rows] for c in ("rid", "size")]
        yield pa.RecordBatch.from_arrays([pa.array(children.view(np.int64)), *map(pa.array, taken)], ["node", "rid", "whole"])


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal (integer) keys, group by group."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change |= values[1:] != values[:-1]
        heads = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(heads, heads[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(heads[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _labels(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least row it hangs together with."""
    labels = np.arange(len(near))
    near = near | np.eye(len(near), dtype=bool)
    while True:
        least = np.where(near, labels[None, :], len(near)).min(axis=1)
        if (least == labels).all():
            return labels
        labels = least


def _bucket_edges(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Edges from each class of a small bucket to one it hangs together with."""
    a, b = [], []
    for group in sorted_groups(batches, ["node"]):
        ids, order = np.unique(group.column("rid").to_numpy(), return_index=True)
        sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, WIDTH)[order]
        near = (sketches[:, None, :] == sketches[None, :, :]).sum(axis=2) >= least
        labels = _labels(near)
        hung = labels != np.arange(len(ids))
        a += ids[hung].tolist()
        b += ids[labels[hung]].tolist()
        if len(a) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sketch(signature: bytes) -> bytes:
    return np.frombuffer(signature, np.uint32).astype(np.uint8).tobytes()


def candidate_edges(classes: DataFrame, threshold: float, recall: float, depth: int = DEPTH) -> DataFrame:
    """a, b: which classes (rid, signature) hang together by buckets of chosen paths."""
    runs = runs_needed(threshold, depth, recall)
    least = math.floor((threshold - MARGIN) * WIDTH)
    spark = classes.sparkSession

    @F.arrow_udf("binary")
    def sketch(signatures: pa.Array) -> pa.Array:
        return pa.array([_sketch(s) for s in signatures.to_pylist()], pa.binary())

    whole = classes.select("rid", "signature")
    paths = whole.mapInArrow(lambda x: _first_nodes(x, runs, threshold), "node bigint, rid bigint")
    paths = paths.withColumn("whole", F.lit(None).cast("bigint"))
    found = spark.createDataFrame([], "a bigint, b bigint")
    rows = whole.count() * runs
    for level in range(1, depth + 1):
        sizes = paths.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("whole").alias("whole")).where("size > 1")
        shared = paths.select("node", "rid").join(sizes, "node").coalesce(tasks_for(rows))
        shared = materialize(shared, f"paths-{level}")
        small = shared.where(F.col("size") <= SMALL)
        large = shared.where(F.col("size") > SMALL)
        known = small.join(whole, "rid").select("node", "rid", sketch("signature").alias("sketch"))
        tasks = tasks_for(small.count())
        edges = known.repartition("node").sortWithinPartitions("node").coalesce(tasks).mapInArrow(
            lambda x: _bucket_edges(x, least), "a bigint, b bigint"
        )
        found = found.union(materialize(edges, f"edges-{level}"))
        stuck = F.coalesce(F.col("size") >= (threshold - MARGIN) * F.col("whole"), F.lit(False)) | (F.lit(level) == depth)
        group = large.where(stuck).groupBy("node").agg(F.min("rid").alias("b"))
        found = found.union(large.where(stuck).join(group, "node").select(F.col("rid").alias("a"), "b"))
        large = large.where(~stuck)
        rows = 2 * large.count()
        if not rows:
            break
        paths = large.join(whole, "rid").select("node", "rid", "size", "signature").coalesce(tasks_for(rows)).mapInArrow(
            lambda x: _next_nodes(x, threshold), "node bigint, rid bigint, whole bigint"
        )
    return found


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of classes that are to be compared, once for each pair of blocks they belong to."""
    names = ["grp", "i", "j", "block", "blocks", "rid", "rows", "shingles"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        out = []
        for row, values in zip(batch.drop_columns(["text"]).to_pylist(), shingle_sets(batch.column("text"), SHINGLE)):
            if set_key(values) == (row["key1"], row["key2"]):
                for other in range(row["blocks"]):
                    i, j = sorted((row["block"], other))
                    out.append((row["grp"], i, j, row["block"], row["blocks"], row["rid"], row["rows"], values.tobytes()))
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many values each two of some sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    useful = times[code] > 1
    owner, code = owner[useful], rank[code[useful]]
    at = np.argsort(code, kind="stable")
    owner, code = owner[at], code[at]
    out = np.zeros((len(sets), len(sets)))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, [low, low + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        out += part @ part.T
    return out


def _group_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """rid, links, label, parted: for each class of a pair of blocks the documents it links to, and what it hangs together with."""
    for group in sorted_groups(batches, ["grp", "i", "j"]):
        ids, first = np.unique(group.column("rid").to_numpy(), return_index=True)  # equal rows give a set twice
        group = group.take(pa.array(first))
        sets = [np.frombuffer(s, U) for s in group.column("shingles").to_pylist()]
        block, rows = group.column("block").to_numpy(), group.column("rows").to_numpy()
        sizes = np.array([len(s) for s in sets], float)
        shared = shared_counts(sets)
        near = shared / (sizes[:, None] + sizes[None, :] - shared) >= threshold
        np.fill_diagonal(near, False)
        if group.column("i")[0].as_py() != group.column("j")[0].as_py():
            near &= block[:, None] != block[None, :]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids), pa.array(near.astype(np.int64) @ rows), pa.array(ids[_labels(near)]),
                pa.array([group.column("blocks")[0].as_py() > 1] * len(ids)),
            ],
            ["rid", "links", "label", "parted"],
        )


def link_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, row_key, class_id, set_id, n_links of each row of `docs` (stored).

    n_links counts the documents other than itself that a document links to. class_id
    names what hangs together by links: its least doc_id (a negative number if none has
    one); set_id so names the documents of equal sets. Both are null without words.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keyed = keyed.withColumn("row_key", F.xxhash64("doc_id", "text"))
    sets = keyed.where("text is not null").mapInArrow(
        _sets, "doc_id bigint, row_key bigint, key1 bigint, key2 bigint, n int, signature binary"
    )
    sets = materialize(sets, "shingle-sets")
    classes = sets.where("n > 0").groupBy("key1", "key2").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("least_id"), F.min("row_key").alias("row_key"),
        F.first("n").alias("n"), F.first("signature").alias("signature"),
    )
    tasks = tasks_for(sets.count())
    classes = materialize(classes.coalesce(tasks).withColumn("rid", F.monotonically_increasing_id()), "set-classes")

    groups = connected_components(candidate_edges(classes, threshold, recall))
    sizes = groups.join(classes.select(F.col("rid").alias("id"), "n"), "id").groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    wanted = (
        groups.join(sizes, "label")
        .join(classes.select(F.col("rid").alias("id"), "key1", "key2", "rows", "row_key"), "id")
        .select(
            "row_key", F.col("id").alias("rid"), F.col("label").alias("grp"), "key1", "key2", "rows", "blocks",
            F.expr("cast(pmod(xxhash64(id), blocks) as int) as block"),
        )
    )
    wanted = materialize(wanted.coalesce(tasks), "groups")
    # Both sides are shuffled, whatever the size: no size of the groups is proven.
    compared = keyed.select("row_key", "text").join(wanted.hint("merge"), "row_key").mapInArrow(
        _whole_sets, "grp bigint, i int, j int, block int, blocks int, rid bigint, rows bigint, shingles binary"
    )
    to_compare = wanted.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    parts = compared.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").coalesce(tasks_for(to_compare, 500))
    links = parts.mapInArrow(
        lambda x: _group_links(x, threshold), "rid bigint, links bigint, label bigint, parted boolean"
    )
    links = materialize(links, "class-links")
    # What a group in one task hangs together with is known; labels from pairs of blocks are joined.
    whole = links.where("not parted").select(F.col("rid").alias("id"), "label")
    parted = links.where("parted").select(F.col("rid").alias("a"), F.col("label").alias("b"))
    joined = whole if parted.isEmpty() else whole.union(connected_components(parted))
    sums = links.groupBy("rid").agg(F.sum("links").alias("links"))
    named = docs.sparkSession.sql(
        """
        select c.key1, c.key2, c.rows, coalesce(c.least_id, -1 - c.rid) as set_id, coalesce(l.links, 0L) as links,
          coalesce(j.label, c.rid) as label
        from {classes} c left join {sums} l on c.rid = l.rid left join {joined} j on c.rid = j.id""",
        classes=classes,
        sums=sums,
        joined=joined,
    )
    named = materialize(named.coalesce(tasks), "linked-classes")
    least = named.groupBy("label").agg(F.min(F.when(F.col("set_id") >= 0, F.col("set_id"))).alias("a"), F.min("set_id").alias("b"))
    named = named.join(least.select("label", F.coalesce("a", "b").alias("class_id")), "label").select(
        "key1", "key2", "class_id", "set_id", (F.col("links") + F.col("rows") - 1).alias("n_links")
    )
    of_words = sets.where("n > 0").join(named, ["key1", "key2"]).coalesce(tasks)
    of_words = of_words.select("doc_id", "row_key", "class_id", "set_id", "n_links")
    none = F.lit(None).cast("bigint")
    no_words = sets.where("n = 0").select("doc_id", "row_key").union(
        keyed.where("text is null").select("doc_id", "row_key")
    )
    return of_words.union(no_words.select("doc_id", "row_key", none, none, F.lit(0).cast("bigint")))


def join_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, set_id, n_links for each row of `docs`."""
    return link_classes(docs, **options).select("doc_id", "class_id", "set_id", "n_links")


@carries_columns
def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each class: the one of the least doc_id (null last). Rows without words stay."""
    linked = link_classes(docs, **options)
    first = F.expr("min(struct(doc_id is null as unnamed, doc_id, row_key))")
    kept = linked.where("class_id is not null").groupBy("class_id").agg(first.alias("k")).select("k.row_key")
    kept = materialize(kept.withColumnRenamed("row_key", "_row_key").distinct(), "kept-rows")
    words = F.coalesce(F.col("text").rlike(r"[^\x09-\x0D\x20]"), F.lit(False))
    keyed = docs.withColumn("_row_key", F.xxhash64(F.col("doc_id").cast("bigint"), "text"))
    nth = F.row_number().over(Window.partitionBy("_row_key").orderBy(F.lit(1)))  # equal rows
    one = keyed.where(words).join(kept, "_row_key", "left_semi").withColumn("_nth", nth).where("_nth = 1")
    return one.select(*docs.columns).union(docs.where(~words))
