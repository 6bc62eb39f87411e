"""Near duplicates by a chosen-path set similarity join.

Each document is its set of word shingles. A tree branches the documents by selected minwise tokens: on each level a
document goes to the node of its smallest token under that level's hash. Nodes that are small, at whatever level, are
compared exhaustively on full sets; large ones branch on. A pair at the threshold shares a branch with that probability
on each level, and ``TREES`` independent trees bring the recall near 1.

Equal sets are one class from the start. The first trees give components; later ones only compare nodes in which two
components still meet, and only sets whose sketches come near the threshold. So a large group of near copies gives
about one link for each document and not one for each pair. A node that the last level leaves large is compared with
its first document in blocks, and, where components still meet, block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import BATCH_BYTES, map_batches, map_groups, stored
from billweave.llm.components import components

WORDS, PERCENT = 5, 85
TREES, FIRST_TREES, LEVELS = 16, 2, 4
#: A node is small with so many documents and shingles at most.
NODE_DOCS, NODE_SHINGLES = 256, 1_000_000
#: Chance that a pair at the threshold shows too few equal sketch positions for a comparison of full sets.
SKETCH_MISS = 2.5e-6

U = np.uint64
_RANDOM = np.random.default_rng(20240229)
_MULTIPLY = _RANDOM.integers(0, 2**63, (TREES * LEVELS, 1), dtype=U) * U(2) + U(1)
_FLIP = _RANDOM.integers(0, 2**63, (TREES * LEVELS, 1), dtype=U)


def sketch_least(percent: int) -> int:
    """Equal sketch positions that a pair at the threshold falls short of with chance ``SKETCH_MISS`` at most."""
    n, share = TREES * LEVELS, percent / 100
    p = share + (1 - share) / 256  # different tokens have one byte in 256 in common
    below, k = 0.0, 0
    while (below := below + comb(n, k) * p**k * (1 - p) ** (n - k)) <= SKETCH_MISS:
        k += 1
    return k


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; with fewer words the whole sequence is one."""
    import xxhash

    # On bytes, lower() changes A-Z only and split() cuts at the space and 09 to 0D only.
    split = text.encode().lower().split()
    n = len(split)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, split), U, n)
    if not n:
        return w
    if n < words:
        return np.array([xxhash.xxh3_64_intdigest(w.tobytes())], U)
    s = w[: n - words + 1].copy()
    for j in range(1, words):
        s *= U(0x9E3779B97F4A7C15)
        s ^= s >> U(29)
        s += w[j : n - words + 1 + j]
    s *= U(0xBF58476D1CE4E5B9)
    s ^= s >> U(31)
    return np.unique(s)


def minwise(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    """The smallest token under each hash, in blocks of shingles."""
    least = np.full(len(_FLIP), np.iinfo(U).max, U)
    for at in range(0, len(shingles), block):
        v = (shingles[None, at : at + block] ^ _FLIP) * _MULTIPLY
        v ^= v >> U(32)
        np.minimum(least, v.min(1), out=least)
    return least


def signatures(docs: DataFrame) -> DataFrame:
    """For ``docs(doc_id, text)``: set size, digest of the set, minwise tokens by tree and level, and two shorter forms
    of them that go where rows are moved: a byte of each token (sketch) and four bytes of each tree's first (firsts)."""

    def make() -> Callable[[dict], Iterable[dict]]:
        import xxhash

        def step(batch: dict) -> Iterable[dict]:
            sets = [shingle_set(t or "") for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            } | short_forms([minwise(s).view(np.int64) if len(s) else None for s in sets])

        return step

    ddl = "doc_id long, n_shingles long, digest binary, tokens binary, sketch binary, firsts binary"
    return map_batches(docs.select("doc_id", "text"), make, ddl, BATCH_BYTES)


def short_forms(tokens: list[np.ndarray | None]) -> dict:
    return {
        "tokens": [None if t is None else t.tobytes() for t in tokens],
        "sketch": [None if t is None else t.astype(np.uint8).tobytes() for t in tokens],
        "firsts": [None if t is None else t[::LEVELS].astype(np.uint32).tobytes() for t in tokens],
    }


def first_nodes(classes: DataFrame) -> DataFrame:
    """A row per class and tree with its node on the first level."""

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            n = len(batch["rep"])
            firsts = np.frombuffer(b"".join(batch["firsts"]), np.uint32).reshape(n, TREES).astype(np.int64)
            for tree in range(TREES):
                yield {"rep": batch["rep"], "n": batch["n"], "tree": [tree] * n, "node": firsts[:, tree]}

        return step

    return map_batches(classes.select("rep", "n", "firsts"), make, "rep long, n long, tree int, node long", BATCH_BYTES)


def with_paths(members: DataFrame, tokens: DataFrame) -> DataFrame:
    """Members with the tokens that lead on in their tree.

    A document's members, one a tree at most, are gathered before the join, so its tokens move once and not once a tree.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            every = np.frombuffer(b"".join(batch["tokens"]), np.int64).reshape(-1, TREES, LEVELS)
            rows = [(k, m) for k, own in enumerate(batch["own"]) for m in own]
            at, trees = (np.array(x) for x in zip(*((k, m["tree"]) for k, m in rows), strict=True))
            yield {
                "rep": [batch["rep"][k] for k in at], "n": [m["n"] for _, m in rows], "tree": trees,
                "node": [m["node"] for _, m in rows], "path": list(every[at, trees, 1:]),
            }

        return step

    ddl = "rep long, n long, tree int, node long, path array<long>"
    own = members.groupBy("rep").agg(F.collect_list(F.struct("n", "tree", "node")).alias("own"))
    return map_batches(own.join(tokens, "rep"), make, ddl, BATCH_BYTES)


def met(rows: DataFrame) -> DataFrame:
    """Rows of the nodes with two members or more, and whether their node is small."""
    sizes = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")).filter("size > 1")
    small = (F.col("size") == 2) | ((F.col("size") <= NODE_DOCS) & (F.col("weight") <= NODE_SHINGLES))
    return rows.join(sizes.select("tree", "node", small.alias("small")), ["tree", "node"])


def branch(classes: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (tree, node, rep, n, level) of all trees' small nodes, and of those that the last level leaves large."""
    level_rows = stored(met(stored(first_nodes(classes), "nodes")), "level0")
    leaves, level = [], 0
    while True:
        named = F.xxhash64("node", F.lit(level)).alias("node")
        leaves.append(level_rows.filter("small").select("tree", named, "rep", "n", F.lit(level).alias("level")))
        rows, level = level_rows.filter("not small").drop("small"), level + 1
        if level == LEVELS or rows.isEmpty():
            break
        rows = with_paths(rows, tokens) if level == 1 else rows
        rows = rows.withColumn("node", F.xxhash64("node", F.col("path")[level - 1]))
        level_rows = stored(met(stored(rows, "branched")), f"level{level}")
    return reduce(DataFrame.unionByName, leaves), rows.select("tree", "node", "rep", "n")


def union_links(reps: list[int], groups: list[int], shared: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links at the threshold that join parts not yet joined; ``groups`` says which already are."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    union = sizes[:, None] + sizes[None, :] - shared
    links = []
    for i, j in np.argwhere(np.triu(100 * shared >= percent * union, 1)):
        a, b = root(groups[i]), root(groups[j])
        if a != b:
            parent[b] = a
            links.append((reps[i], reps[j]))
    return links


def shared_counts(sets: list[np.ndarray], columns: int = 1 << 16) -> np.ndarray:
    """Sizes of all intersections, from blocks of the incidence matrix of sets and the shingles of two or more."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    common = count > 1
    number = np.cumsum(common) - 1
    keep = common[inverse]
    column, owner = number[inverse[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(common.sum()), columns):
        inside = (column >= at) & (column < at + columns)
        matrix = np.zeros((len(sets), min(columns, int(common.sum()) - at)), np.float32)
        matrix[owner[inside], column[inside] - at] = 1
        out += np.rint(matrix @ matrix.T).astype(np.int64)
    return out


def compare_node(rows: dict, percent: int = PERCENT) -> dict | None:
    """Exhaustive comparison of one small node on full sets."""
    if len(rows["rep"]) < 2:
        return None
    sets = [np.frombuffer(s, U) for s in rows["shingles"]]
    links = union_links(rows["rep"], rows["component"], shared_counts(sets), np.array([len(s) for s in sets]), percent)
    return {"a": [a for a, _ in links], "b": [b for _, b in links]} if links else None


def near_rows(rows: dict, percent: int = PERCENT) -> dict | None:
    """Members of one small node that have one of another component near them, by size and sketch, for the first time.

    Two that were together in the small first node of an earlier tree have been compared there.
    """
    n, part, tree = np.array(rows["n"]), np.array(rows["component"]), rows["tree"][0]
    if len(n) < 2:
        return None
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(n), -1)
    firsts = np.frombuffer(b"".join(rows["firsts"]), np.uint32).reshape(len(n), TREES)[:, :tree]
    small = (np.array(rows["small"])[:, None] >> np.arange(tree)) & 1 > 0
    near, least = np.zeros(len(n), bool), sketch_least(percent)
    for i in range(len(n) - 1):
        rest = slice(i + 1, None)
        fits = (part[rest] != part[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
        fits &= (sketch[rest] == sketch[i]).sum(1) >= least
        fits &= ~((firsts[rest] == firsts[i]) & small[i]).any(1)
        near[i] |= fits.any()
        near[rest] |= fits
    take = np.flatnonzero(near)
    return {c: [rows[c][k] for k in take] for c in ("tree", "node", "rep", "component")} if take.size else None


def with_forms(members: DataFrame, forms: DataFrame, ddl: str) -> DataFrame:
    """Members (tree, node, rep, component) joined to ``forms`` (rep and the columns of ``ddl``).

    As in ``with_paths``, a document's members are gathered first: the join has a row for each document, not for each tree.
    """
    names = [part.split()[0] for part in ddl.split(", ")]

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            # One member of each document at a time, so that what comes out is no larger than what went in.
            for j in range(max(map(len, batch["own"]), default=0)):
                at = [k for k, own in enumerate(batch["own"]) if len(own) > j]
                yield {c: [batch[c][k] for k in at] for c in ("rep", *names)} | {
                    c: [batch["own"][k][j][c] for k in at] for c in ("tree", "node", "component")
                }

        return step

    own = members.groupBy("rep").agg(F.collect_list(F.struct("tree", "node", "component")).alias("own"))
    given = own.join(forms.select("rep", *names), "rep")
    return map_batches(given, make, f"tree int, node long, rep long, component long, {ddl}", BATCH_BYTES)


def with_sets(members: DataFrame, docs: DataFrame) -> DataFrame:
    """``members`` with their full shingle sets, made anew from the texts of the wanted documents alone."""
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            yield {"rep": batch["doc_id"], "shingles": [shingle_set(t or "").tobytes() for t in batch["text"]]}

        return step

    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    sets = stored(map_batches(texts, make, "rep long, shingles binary", BATCH_BYTES), "sets")
    return with_forms(members, sets, "shingles binary")


def node_links(members: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links of small nodes: members (tree, node, rep, component)."""
    ddl = "tree int, node long, rep long, component long"
    shown = with_forms(members, classes, "n long, sketch binary, firsts binary, small long")
    near = stored(map_groups(shown, ["tree", "node"], partial(near_rows, percent=percent), ddl), "near")
    full = with_sets(near, docs)
    return map_groups(full, ["tree", "node"], partial(compare_node, percent=percent), "a long, b long")


def with_components(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members of the nodes in which more than one component is found."""
    known = stored(members.join(joined.select(F.col("a").alias("rep"), F.col("b").alias("component")), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    ), "members")
    nodes = known.groupBy("tree", "node").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(nodes.filter("low != high").select("tree", "node", F.col("low")), ["tree", "node"])


def blocks(dense: DataFrame, crossed: bool) -> DataFrame:
    """Large nodes as blocks of half a small node each, so that each can be compared as a node.

    Either every block gets the node's first member, or (``crossed``) each block meets each block of the members outside
    the component of the first one, the way that no pair of two components is missed.
    """
    half = NODE_DOCS // 2
    nodes = dense.groupBy("tree", "node").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("count"), F.max("n").alias("most"))
    # Blocks of longer sets hold fewer of them.
    share = F.greatest(F.lit(1), F.least(F.lit(half), F.lit(NODE_SHINGLES // 2) / F.col("most"))).cast("long")
    rows = dense.join(nodes.withColumn("share", share), ["tree", "node"])
    rows = rows.withColumn("width", F.ceil(F.col("count") / F.col("share"))).withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("width"))
    )
    columns = ["tree", "node", "rep", "component"]

    def as_node(frame: DataFrame, *parts: str) -> DataFrame:
        return frame.withColumn("node", F.xxhash64("node", F.lit(-1), *parts)).select(*columns)

    every = F.sequence(F.lit(0).cast("long"), F.col("width") - 1)
    if not crossed:
        first = rows.filter("rep = first").withColumn("block", F.explode(every))
        return as_node(rows.filter("rep != first").unionByName(first), "block")
    outside = rows.filter("component != low")
    counts = outside.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("outside"))
    rows = rows.join(counts, ["tree", "node"]).withColumn("others", F.ceil(F.col("outside") / F.col("share")))
    left = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    right = rows.filter("component != low").withColumn("other", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("others")))
    right = right.withColumn("block", F.explode(every))
    return as_node(left.unionByName(right).dropDuplicates(["tree", "node", "rep", "block", "other"]), "block", "other")


def class_components(classes: DataFrame, tokens: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(a, b): component b of each class a that isn't the first of its component.

    ``classes``: rep, n, sketch, firsts; ``tokens``: rep, tokens.
    """
    leaves, dense = branch(classes, tokens)
    bits = leaves.filter("level = 0").groupBy("rep").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("small"))
    classes = classes.join(bits, "rep", "left").withColumn("small", F.coalesce("small", F.lit(0).cast("long")))
    leaves, early = leaves.drop("level"), F.col("tree") < FIRST_TREES
    classes, alone = stored(classes, "class_forms"), F.col("rep").alias("component")
    first = leaves.filter(early).select("tree", "node", "rep", alone)
    first = first.unionByName(blocks(dense.filter(early).select("*", alone), crossed=False))
    joined = components(stored(node_links(first, classes, docs, percent), "first_links"))
    met_again = with_components(leaves.filter(~early), joined).select("tree", "node", "rep", "component")
    met_again = met_again.unionByName(blocks(with_components(dense, joined), crossed=True))
    more = stored(node_links(met_again, classes, docs, percent), "later_links")
    return components(joined.unionByName(more))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs(doc_id, text)``.

    Two rows are near when their shingle sets have ``percent`` of their union in common, or more.

    Null and empty texts, and those of white space alone, have no shingles and link with nothing. Repeated rows are
    copies. A row without an id stands in no component of its own: its component is that of its copies, and it isn't kept.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(signatures(docs), "signatures")
    full = rows.filter("digest is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = stored(classes, "classes")
    named = full.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "digest", "sketch", "firsts")
    # Ids that occur more than once are taken once.
    named = stored(named.join(reps, ["digest", "rep"], "left_semi").dropDuplicates(["digest", "rep"]).drop("digest"), "class_rows")
    tokens = full.select(F.col("doc_id").alias("rep"), "tokens")
    joined = class_components(named, tokens, docs, percent)
    labels = reps.join(joined.select(F.col("a").alias("rep"), F.col("b")), "rep", "left")
    labels = stored(labels.select("digest", F.coalesce("b", "rep").alias("component_id")), "labels")
    # Both sides come from tables, so adaptive execution may split a class with many copies.
    out = rows.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
