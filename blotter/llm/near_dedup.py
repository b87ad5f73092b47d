"""Near-duplicates by a chosen-path set similarity join.

A text is the set of its word shingles. Texts with the same set are one member
from the start. In each of ``TREES`` independent trees the members branch by a
minwise token of their set; nodes that are large branch again by tokens that
the node selects, small nodes are compared exhaustively. A sketch (the smallest
shingle in each of ``BINS`` ranges of hashes) first drops pairs far below the
threshold, every other pair is verified on the full sets, natively.

Only components are wanted, so each member is first held against the pivots of
its nodes (another in each tree), of which the nearest few are verified. A node
whose members are then in one component is settled; in the others members are
compared across components by sketch, and those with a near one again by their
full sets, in the task, which gives fewer links than the node has members. A
large node of which few members are outside its largest component meets just
these with all, in blocks; so do nodes that stay large on every level. No row
is made for a pair, so a node of near copies stays linear.

Recall: a pair at the threshold 0.8 shares the first token in a tree with
probability 0.8 and survives a further level with 0.96; in 12 trees fewer than
one such pair in 10^6 is missed without further levels, in 10^5 with five. The
sketch drops one such pair in 10^7. Pairs above the threshold do better.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.bloom import Filter
from blotter.llm.common import Words, documents, joined_hash, shuffle_width, with_text_columns, written
from blotter.llm.components import components

#: Percent of the union that the intersection must reach.
THRESHOLD = 80
TREES = 12
#: Minwise tokens of a member: one for each tree, the rest for further levels.
TOKENS = 28
BRANCHES = 2
LEVELS = 8
#: Ranges of hashes in a sketch; standard deviations below the threshold at which a pair is still verified.
BINS = 512
DEVIATIONS = 5.6
#: Members of a node that is compared at once.
SMALL = 2000
#: Pivots of its nodes that a member is verified with first, the nearest by sketch.
NEAREST = 2

_SEEDS = np.random.default_rng(80).integers(1, 2**63, (2, TOKENS)).astype(np.uint64)


# ------------------------------------------------------------------ sets


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the texts one after the other, and
    where each text's begin (one more at the end). A text with fewer words has
    their whole sequence, one without words has none."""
    words = Words(texts, lower=True)
    h, doc, n = words.hash, words.doc, len(words.hash)
    whole = max(n - size + 1, 0)
    inside = np.flatnonzero(doc[:whole] == doc[n - whole :]) if whole else np.zeros(0, np.int64)
    values = joined_hash([h[inside + k] for k in range(size)]) if len(inside) else np.zeros(0, np.uint64)
    owner = doc[inside]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = [joined_hash([h[i : i + 1] for i in range(words.first[d], words.first[d + 1])])[0] for d in short]
        values, owner = np.concatenate([values, np.array(extra, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def _tokens(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, TOKENS) smallest hashes; texts without shingles get zeros."""
    out = np.zeros((len(first) - 1, TOKENS), np.int32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for k in range(TOKENS):
            ranked = ((values ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint64(1))) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(ranked, first[:-1][full]).astype(np.uint32).view(np.int32)
    return out


def _sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, BINS): of the smallest hash in each range 1 to 255, 0 without
    one. Sorted hashes have the smallest of a range first."""
    out = np.zeros((len(first) - 1, BINS), np.uint8)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    new = np.ones(len(values), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    out[owner[new], at[new]] = (values[new] % np.uint64(255)).astype(np.uint8) + 1
    return out


def near_sketches(one: np.ndarray, many: np.ndarray, threshold: int = THRESHOLD, n_one=None, n_many=None) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``many`` may reach the threshold with ``one``, and the estimate:
    of the ranges that either has, the share with equal entries. The ranges are
    a sample without replacement of the union, whose size their number tells;
    small sets are sampled nearly whole, and so estimated more closely. The
    sizes of the sets, where given, rule out pairs that cannot reach it."""
    used = ((many | one) != 0).sum(axis=1)
    equal = ((many == one) & (one != 0)).sum(axis=1)
    t, free = threshold / 100, np.maximum(1 - used / BINS, 1 / (4 * BINS))
    sampled = np.where(used > 0, used / np.maximum(-BINS * np.log(free), 1), 1.0)
    spread = np.sqrt(t * (1 - t) * used * np.maximum(1 - sampled, 0))
    near = equal >= t * used - DEVIATIONS * spread - 1
    if n_one is not None:
        near &= 100 * np.minimum(n_one, n_many) >= threshold * np.maximum(n_one, n_many)
    return near, equal / np.maximum(used, 1)


def _describe(texts: list[str], size: int) -> list:
    values, first = shingle_sets(texts, size)
    keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])]
    return [np.diff(first), keys, list(_tokens(values, first)), [x.tobytes() for x in _sketches(values, first)]]


def _set_lists(texts: list[str], size: int) -> list:
    values, first = shingle_sets(texts, size)
    return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))]


# ------------------------------------------------------------------ nodes


def _branch(members: DataFrame, level: int) -> DataFrame:
    """Children (path, gid) of the nodes in ``members`` (path, gid, tokens):
    each node selects ``BRANCHES`` tokens by its path."""
    picks = [TREES + F.pmod(F.xxhash64("path", F.lit(level), F.lit(j)), F.lit(TOKENS - TREES)).cast("int") for j in range(BRANCHES)]
    child = lambda at: F.xxhash64("path", at, F.get("tokens", at))
    return members.select("gid", F.explode(F.array_distinct(F.array(*map(child, picks)))).alias("path"))


def _shared(nodes: DataFrame) -> DataFrame:
    """The rows (path, gid) of nodes with two members or more."""
    sizes = written(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("path"), "sizes")
    return written(nodes.join(sizes, "path"), "nodes")


def _sketch_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _pivot_pairs(rows: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """(a, b): each member with those pivots of its nodes that are nearest by sketch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (_sketch_matrix(batch.column(c)) for c in ("x", "y"))
                n, m = (batch.column(c).to_numpy() for c in ("n_x", "n_y"))
                tested = (near_sketches(x[i], y[i : i + 1], threshold, n[i], m[i : i + 1]) for i in range(len(x)))
                near, share = (np.concatenate(v) for v in zip(*tested))
                columns = [batch.column("gid"), batch.column("pivot"), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns, names=["gid", "pivot", "share"]).filter(pa.array(near))

    order = F.struct(F.xxhash64("gid", "path").alias("h"), "gid")
    pivots = written(rows.groupBy("path").agg(F.min(order).alias("p")).select("path", F.col("p.gid").alias("pivot")), "pivots")
    met = rows.join(pivots, "path").filter("gid <> pivot").select("gid", "pivot").distinct()
    one = members.select("gid", F.col("sketch").alias("x"), F.col("n").alias("n_x"))
    two = members.select(F.col("gid").alias("pivot"), F.col("sketch").alias("y"), F.col("n").alias("n_y"))
    near = met.join(one, "gid").join(two, "pivot").select("gid", "pivot", "x", "y", "n_x", "n_y").mapInArrow(run, "gid long, pivot long, share double")
    best = near.groupBy("gid").agg(F.slice(F.sort_array(F.collect_list(F.struct("share", "pivot")), False), 1, NEAREST).alias("best"))
    pair = best.select("gid", F.explode("best.pivot").alias("pivot"))
    return pair.select(F.least("gid", "pivot").alias("a"), F.greatest("gid", "pivot").alias("b")).distinct()


def _with_trees(members: DataFrame) -> DataFrame:
    """Nodes of the first level with ``tree``, their tree, and ``trees``, as
    bits, the trees in which each member has a node here."""
    paths = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: F.xxhash64(tree, F.get("tokens", tree)))
    rows = members.withColumn("tree", (F.array_position(paths, F.col("path")) - 1).cast("int"))
    own = rows.groupBy("gid").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("tree"))).alias("trees"))
    return rows.join(own, "gid")


_FLAGGED = "node long, side int, tree int, trees int, gid long"


def _by_node(rows: DataFrame, schema: str, answer) -> DataFrame:
    """``answer`` (a table of whole nodes) over ``rows``, which have a column ``node``."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            node = table.column("node").to_numpy()
            if not len(node):
                continue
            last = int(np.searchsorted(node, node[-1]))  # the last node may go on
            if last:
                yield from answer(table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield from answer(pa.Table.from_batches(held))

    dealt = rows.repartition(shuffle_width(rows.sparkSession), "node")
    return dealt.sortWithinPartitions("node").mapInArrow(run, schema)


class _Nodes:
    """The rows of some nodes, ``edges`` between them, and for each row those
    that it is compared with."""

    def __init__(self, table: pa.Table, threshold: int):
        self.node, self.side, self.gid, self.root, self.n, self.tree, self.trees = (
            table.column(c).to_numpy() for c in ("node", "side", "gid", "root", "n", "tree", "trees")
        )
        self.sketch, self.threshold = _sketch_matrix(table.column("sketch")), threshold
        self.tokens = table.column("tokens").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, TOKENS)[:, :TREES]
        self.edges = np.concatenate([[0], np.flatnonzero(self.node[1:] != self.node[:-1]) + 1, [len(self.node)]])

    def near(self, i: int, end: int, apart: np.ndarray) -> np.ndarray:
        """Rows after i, before ``end``, with another value of ``apart`` and a near
        sketch. Sides 1 and 2 meet each other only; a pair that shares nodes of
        several trees counts in the first of them; tree -1 (further levels)
        compares all."""
        other = np.flatnonzero(apart[i + 1 : end] != apart[i]) + i + 1
        if self.side[i] and len(other):
            other = other[self.side[other] != self.side[i]]
        if self.tree[i] >= 0 and len(other):
            shared = (self.tokens[other] == self.tokens[i]) & (self.trees[i] >> np.arange(TREES) & 1).astype(bool)
            other = other[shared.argmax(axis=1) == self.tree[i]]
        if not len(other):
            return other
        return other[near_sketches(self.sketch[i], self.sketch[other], self.threshold, self.n[i], self.n[other])[0]]


def _flagged(rows: DataFrame, threshold: int) -> DataFrame:
    """The rows (node, side, tree, trees, gid) that have a near sketch in their
    node and another component. At most all rows, whatever the pairs."""

    def answer(table: pa.Table):
        nodes = _Nodes(table, threshold)
        hit = np.zeros(len(nodes.node), bool)
        for s, e in zip(nodes.edges, nodes.edges[1:]):
            for i in range(s, e - 1):
                near = nodes.near(i, e, nodes.root)
                hit[near] = True
                hit[i] |= len(near) > 0
        if hit.any():
            yield from table.select([f.split()[0] for f in _FLAGGED.split(", ")]).filter(pa.array(hit)).combine_chunks().to_batches()

    return _by_node(rows, _FLAGGED, answer)


def _links_in_nodes(rows: DataFrame, threshold: int) -> DataFrame:
    """(a, b): links across components, as many as join the rows of a node to
    what they are linked with: fewer than it has rows. Pairs near by sketch are
    decided on the full sets (``shingles``), here in the task."""

    def answer(table: pa.Table):
        nodes = _Nodes(table, threshold)
        sets = table.column("shingles").combine_chunks()
        # the hashes ascend as unsigned numbers
        values, at = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])
        found = []
        for s, e in zip(nodes.edges, nodes.edges[1:]):
            group = nodes.root[:e].copy()  # components, joined as links are found
            for i in range(s, e - 1):
                near = nodes.near(i, e, group)
                if not len(near):
                    continue
                own = values[at[i] : at[i + 1]]
                theirs = np.concatenate([values[at[j] : at[j + 1]] for j in near])
                size = at[near + 1] - at[near]
                here = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                common = np.add.reduceat(here.astype(np.int64), np.cumsum(size) - size)
                for j in near[100 * common >= threshold * (len(own) + size - common)]:
                    if group[j] != group[i]:
                        found.append((nodes.gid[i], nodes.gid[j]))
                        part = group[s:e]
                        part[part == group[j]] = group[i]
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return _by_node(rows, "a long, b long", answer)


def _in_blocks(members: DataFrame) -> DataFrame:
    """Rows of larger nodes (path, size, main, outside, gid, root) in nodes of
    at most about 2 x ``SMALL``: the members (side 1) are dealt into blocks of
    that size, and those that are not in ``main``, the largest component, too
    (side 2); every block of the one meets every block of the other."""
    blocks, probes = (F.greatest(F.lit(1), F.ceil(F.col(c) / SMALL)).cast("int") for c in ("size", "outside"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = members.withColumn("x", F.pmod(F.xxhash64("gid"), blocks).cast("int")).withColumn("y", each(probes)).withColumn("side", F.lit(1))
    probe = members.filter("root <> main").withColumn("y", F.pmod(F.xxhash64("gid", F.lit(2)), probes).cast("int"))
    probe = probe.withColumn("x", each(blocks)).withColumn("side", F.lit(2))
    both = own.unionByName(probe).withColumns({"tree": F.lit(-1), "trees": F.lit(0)})
    return both.select(F.xxhash64("path", "x", "y").alias("node"), "side", "tree", "trees", "gid", "root")


# ------------------------------------------------------------------ join


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """gid and root (itself without links) of the members."""
    joined = members.select("gid").join(roots.withColumnRenamed("node", "gid"), "gid", "left")
    return written(joined.select("gid", F.coalesce("root", "gid").alias("root")), "labelled")


def _open(nodes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes with members in several components: the rows with their roots,
    and (path, size, main, outside), the members not in the largest component."""
    here = written(nodes.join(labels, "gid").select("path", "gid", "root"), "rooted")
    by_root = here.groupBy("path", "root").agg(F.count(F.lit(1)).alias("n"))
    node = by_root.groupBy("path").agg(
        F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots")
    )
    still = node.filter("roots > 1").select("path", "size", F.col("most.root").alias("main"), (F.col("size") - F.col("most.n")).alias("outside"))
    still = written(still, "open")
    return here, still


def _other_links(
    rows: DataFrame, still: DataFrame, members: DataFrame, labels: DataFrame, docs: DataFrame, sets: DataFrame | None, size: int, threshold: int
) -> DataFrame:
    """Links across components in the nodes that the pivots have not settled.
    Nodes are compared by sketch first; the members with near ones alone get
    their full sets, and are compared again."""
    sketches = members.select("gid", "tokens", "sketch", "n")
    found = None
    for level in range(1, LEVELS + 1):
        full = written(rows.join(still, "path"), "level")
        small = full.filter(F.col("size") <= SMALL).join(members.select("gid", "tokens"), "gid")
        placed = _with_trees(small) if level == 1 else small.withColumns({"tree": F.lit(-1), "trees": F.lit(0)})
        meeting = placed.select(F.col("path").alias("node"), F.lit(0).alias("side"), "tree", "trees", "gid", "root")
        any_large = still.filter(F.col("size") > SMALL).limit(1).count()
        if any_large:
            in_blocks = (F.col("size") > SMALL) & (F.lit(level == LEVELS) | (F.col("outside") <= SMALL))
            meeting = meeting.unionByName(_in_blocks(full.filter(in_blocks)))
        meeting = written(meeting, "meeting")
        near = written(_flagged(meeting.join(sketches, "gid"), threshold), "near")
        near = near.join(labels, "gid")
        found = near if found is None else found.unionByName(near)
        rest = full.filter((F.col("size") > SMALL) & ~in_blocks) if any_large else None
        if rest is None or not rest.limit(1).count():
            break
        further = rest.select("path", "gid").join(members.select("gid", "tokens"), "gid")
        rows, still = _open(_shared(_branch(further, level)), labels)
    sets = _with_sets(found.select("gid").distinct(), docs, members, sets, size)
    return _links_in_nodes(found.join(sketches, "gid").join(sets, "gid"), threshold)


def _with_sets(wanted: DataFrame, docs: DataFrame, members: DataFrame, sets: DataFrame | None, size: int) -> DataFrame:
    """(gid, shingles) of the ``wanted`` members and of those in ``sets``, each
    from one of its texts: texts that a filter of the wanted ones does not hold
    are not shuffled."""
    if sets is not None:
        wanted = wanted.join(sets.select("gid"), "gid", "left_anti")
    wanted = written(wanted.join(members.select("gid", "text_key"), "gid").select("gid", "text_key.*"), "wanted")
    entries = wanted.count()
    if sets is not None and not entries:
        return sets
    held = Filter(wanted.select(F.col("t1").alias("h")), entries)
    texts = docs.select("text", _text_key().alias("k")).select("text", "k.*")
    some = texts.mapInArrow(_holding(held), texts.schema).join(wanted, ["t1", "t2"]).dropDuplicates(["gid"]).select("gid", "text")
    new = written(with_text_columns(some, "shingles array<long>", lambda t: _set_lists(t, size)).drop("text"), "sets")
    return new if sets is None else sets.unionByName(new)


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, size: int, threshold: int):
    """The pairs that reach the threshold on their full sets, and those sets."""
    wanted = pairs.select(F.col("a").alias("gid")).unionByName(pairs.select(F.col("b").alias("gid"))).distinct()
    sets = _with_sets(wanted, docs, members, None, size)
    one = sets.select(F.col("gid").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("gid").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    reach = 100 * F.col("common") >= threshold * (F.size("x") + F.size("y") - F.col("common"))
    return written(both.filter(reach).select("a", "b"), "links"), sets


def _holding(held: Filter):
    """Rows whose key the filter holds; of those with one key in a batch, one."""

    def run(batches):
        for batch in batches:
            one, two = (batch.column(c).to_numpy().view(np.uint64) for c in ("t1", "t2"))
            at = np.flatnonzero(held.holds(one.view(np.int64)))
            _, first = np.unique(joined_hash([one[at], two[at]]), return_index=True)
            yield batch.take(pa.array(np.sort(at[first])))

    return run


def _text_key() -> Column:
    return F.struct(F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, threshold: int = THRESHOLD
) -> DataFrame:
    """A row for each row of ``docs``: id, n_shingles, component_id (the
    smallest id that links reach), kept (null-safe, id = component_id).

    Null and empty texts, and those without words, have no shingles and are
    linked with nothing. Null ids are no smallest id unless all are null. Rows
    that repeat an id have equal answers if their texts are equal. An empty
    table gives no rows. Other columns are not read.
    """
    return _answers(docs, id_col, text_col, shingle, threshold).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _answers(docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: int) -> DataFrame:
    """(id, text_key, n_shingles, component_id) for each row."""
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fields = "n_shingles long, key binary, tokens array<int>, sketch binary"
    described = with_text_columns(
        picked.withColumn("text_key", _text_key()), fields, lambda texts: _describe(texts, shingle)
    ).drop("text")
    rows = written(described.withColumn("row", F.monotonically_increasing_id()), "rows")
    members = written(
        rows.filter("n_shingles > 0").groupBy("key").agg(
            F.min("row").alias("gid"), F.min("id").alias("low_id"),
            F.min_by(F.struct("tokens", "sketch", "text_key", F.col("n_shingles").alias("n")), "row").alias("m"),
        ).select("key", "gid", "low_id", "m.*"), "members"
    )
    first = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: F.xxhash64(tree, F.get("tokens", tree)))
    rows_of_nodes = _shared(members.select("gid", F.explode(first).alias("path")))

    pairs = written(_pivot_pairs(rows_of_nodes, members, threshold), "pairs")
    links, sets = _verified(pairs, picked, members, shingle, threshold)
    labels = _labelled(members, components(links))
    more = written(_other_links(*_open(rows_of_nodes, labels), members, labels, picked, sets, shingle, threshold).distinct(), "links")
    # components of components: the roots stand for their members
    a, b = (labels.select(F.col("gid").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    between = more.join(a, "a").join(b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    top = components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))

    rooted = written(
        members.select("key", "gid", "low_id").join(labels, "gid").join(top, "root", "left")
        .select("key", "low_id", F.coalesce("top", "root").alias("root")), "rooted"
    )
    lowest = written(rooted.groupBy("root").agg(F.min("low_id").alias("component_id")), "lowest")
    answer = written(rooted.join(lowest, "root").select("key", "component_id"), "answer")
    columns = ["id", "text_key", "n_shingles", "component_id"]
    full = rows.filter("n_shingles > 0").join(answer, "key").select(*columns)
    alone = rows.filter("n_shingles = 0").withColumn("component_id", F.col("id")).select(*columns)
    return full.unionByName(alone)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: int = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, with their columns, that stay: of each component
    the text with its smallest id. Rows that repeat that id and text stay
    together, and rows with null ids stay."""
    answers = _answers(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, shingle, threshold)
    gone = written(answers.filter("id <> component_id").select("id", "text_key").distinct(), "gone")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("id"), text)
    kept = packed.withColumn("text_key", _text_key()).drop("text").join(gone, ["id", "text_key"], "left_anti")
    return kept.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))
